"""Every shape of the dimension cascade as raw text with numbers of the driver's rows, and what it must give."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import dimensions
from .catalogue import query, t

#: Text, pattern, values in hundredths; a to f are numbers of the row. h_w_space is tried after imperial_h_w, which takes its texts.
TEXTS = [
    ("{a} x {b} cm (about).", "simple_2d", "height=100a width=100b"),
    ("Image: {a} x {b} cm; Sheet: {c} x {d} cm", "image_sheet", "image.height=100a image.width=100b sheet.height=100c sheet.width=100d"),
    ("image: {a} x {b} cm, plate {c} x {d} cm; sheet: {e} x {f} cm", "image_plate_sheet", "image.height=100a image.width=100b plate.height=100c plate.width=100d sheet.height=100e sheet.width=100f"),
    ("{a} × {b} x {c} cm", "simple_3d", "height=100a width=100b depth=100c"),
    ("Plate: {a} x {b} cm Sheet: {c} x {d} cm.", "plate_sheet", "plate.height=100a plate.width=100b sheet.height=100c sheet.width=100d"),
    ("image/plate: {a} x {b} cm; sheet: {c} x {d} cm", "image_plate_combined_sheet", "image/plate.height=100a image/plate.width=100b sheet.height=100c sheet.width=100d"),
    ("H.: {b} cm", "height_only", "height=100b"),
    ("Diameter: {b} cm", "diameter_only", "diameter=100b"),
    ("{a} x {b} cm; diam. {c} cm", "2d_plus_diam", "height=100a width=100b diameter=100c"),
    ("Image/paper: {a} x {b} cm; Mount: {c} x {d} cm", "image_paper_mount", "image/paper.height=100a image/paper.width=100b mount.height=100c mount.width=100d"),
    ("Sheet: {a} x {b} cm (irregular)", "sheet_only", "sheet.height=100a sheet.width=100b"),
    ("Image/paper: {a} x {b} cm; Album page: {c} x {d} cm", "image_paper_album", "image/paper.height=100a image/paper.width=100b album page.height=100c album page.width=100d"),
    ("Sheet (folded): {a} x {b} cm", "folded_sheet", "folded sheet.height=100a folded sheet.width=100b"),
    ("height {a} mm x width {b} mm", "labelled_h_w", "height=10a width=10b"),
    ("diameter {a} mm × weight {b} g", "labelled_diam_weight", "diameter=10a weight=100b"),
    ("height {a} mm x width {b} mm x depth {c} mm", "labelled_h_w_d", "height=10a width=10b depth=10c"),
    ("height {a} mm x diameter {b} mm", "labelled_h_diam", "height=10a diameter=10b"),
    ("diameter {a} mm x height {b} mm", "labelled_diam_h", "diameter=10a height=10b"),
    ("length {a} mm x width {b} mm", "labelled_l_w", "length=10a width=10b"),
    ("height {a} mm x width {b} mm x thickness {c} mm", "labelled_h_w_t", "height=10a width=10b thickness=10c"),
    ("diameter {b} mm", "labelled_diam", "diameter=10b"),
    ("height {b} mm", "labelled_h", "height=10b"),
    ("width {a} mm x height {b} mm", "labelled_w_h", "width=10a height=10b"),
    ("diameter {a} mm x height {b} mm x weight {c} g", "labelled_diam_h_weight", "diameter=10a height=10b weight=100c"),
    ("height {a} mm, width {b} mm", "labelled_h_w_comma", "height=10a width=10b"),
    ("height {a} mm x width {b} mm x weight {c} g", "labelled_h_w_weight", "height=10a width=10b weight=100c"),
    ("height {a} mm x width {b} mm x depth {c} mm x weight {d}", "labelled_h_w_d_weight", "height=10a width=10b depth=10c weight=100d"),
    ("length {a} mm x width {b} mm x weight {c} g", "labelled_l_w_weight", "length=10a width=10b weight=100c"),
    ("length {b} mm", "labelled_l", "length=10b"),
    ("depth {a} mm , height {b} mm x width {c} mm", "labelled_d_h_w", "depth=10a height=10b width=10c"),
    ("length {a} mm x width {b} mm x thickness {c} mm", "labelled_l_w_t", "length=10a width=10b thickness=10c"),
    ("width {a} mm x height {b} mm x thickness {c} mm x weight {d} g", "labelled_w_h_t", "width=10a height=10b thickness=10c weight=100d"),
    ("Sheet: {c} 1/2 x {e} in. ({a} x {b} cm)", "imperial_sheet", "sheet.height=100a sheet.width=100b"),
    ("{c} x {e} 3/4 inches ({a} x {b} cm)", "imperial_2d", "height=100a width=100b"),
    ("H. {c} 1/8 in. ({b} cm)", "imperial_h", "height=100b"),
    ("Overall: {c}-1/2 x {e} in ({a} x {b} cm)", "imperial_overall", "overall.height=100a overall.width=100b"),
    ("Height: {c} in. ({b} cm)", "imperial_height", "height=100b"),
    ("Diameter: 3/4 in. ({b} cm)", "imperial_diameter", "diameter=100b"),
    ("Diam.: {c} in. ({b} cm)", "imperial_diam", "diameter=100b"),
    ("Sheet (trimmed to image): {c} x {e} in. ({a} x {b} cm)", "imperial_sheet_trimmed", "sheet.height=100a sheet.width=100b"),
    ("{c} x {e} x {f} in. ({a} x {b} x {d} cm)", "imperial_3d", "height=100a width=100b depth=100d"),
    ("H. {c} in. ({a} cm); Diam. {e} in. ({b} cm)", "imperial_h_diam", "height=100a diameter=100b"),
    ("H. {c} in. ({a} cm), W. {e} in. ({b} cm)", "imperial_h_w", "height=100a width=100b"),
    ("{c} 1/2 in. ({b} cm)", "imperial_single", "height=100b"),
    ("Plate: {c} x {e} in. ({a} x {b} cm); Sheet: {c} x {e} in. ({c} x {d} cm)", "imperial_plate_sheet", "plate.height=100a plate.width=100b sheet.height=100c sheet.width=100d"),
    ("Sheet: {c} x {e} in. ({a} x {b} cm) Plate: {c} x {e} in. ({c} x {d} cm)", "imperial_sheet_plate", "sheet.height=100a sheet.width=100b plate.height=100c plate.width=100d"),
    ("L. {c} x W. {e} in. ({a} x {b} cm)", "imperial_l_w", "length=100a width=100b"),
    ("Overall: {c} x {e} x {f} in. ({a} x {b} x {d} cm)", "imperial_overall_3d", "overall.height=100a overall.width=100b overall.depth=100d"),
    ("H. {c} in. ({a} cm) W. {e} in. ({b} cm)", "imperial_h_w", "height=100a width=100b"),
    ("H. {c} in. ({a} cm); W. {e} in. ({b} cm); D. {f} in. ({d} cm)", "imperial_h_w_d_space", "height=100a width=100b depth=100d"),
    ("Image: {c} x {e} in. ({a} x {b} cm); Sheet: {c} x {e} in. ({c} x {d} cm)", "imperial_image_sheet", "image.height=100a image.width=100b sheet.height=100c sheet.width=100d"),
    ("L. {a} x W. {b} cm", "imperial_l_w_plain", "length=100a width=100b"),
    ("Length: {c} in. ({b} cm)", "imperial_l", "length=100b"),
    ("H. {a} x W. {b} x D. {c} cm", "inline_metric_3d", "height=100a width=100b depth=100c"),
    ("about {a} by {b}", None, None),
]
#: The numbers of a row by its key, in Spark and in DuckDB: whole ones, and ones with a half.
NUMBERS = {"a": "k % 97 + 1", "b": "k % 89 + 2.5", "c": "k % 13 + 1", "d": "k % 7 + 1.5", "e": "k % 5 + 1", "f": "k % 3 + 1"}


def _expected(values: str | None) -> str:
    """SQL of the listed values."""
    if values is None:
        return "NULL"
    one = lambda m: f"'{m[1]}=' || CAST(({NUMBERS[m[3]]}) * {m[2]} AS BIGINT)"
    return " || ' ' || ".join(one(m) for m in re.finditer(r"([a-z/. ]+)=(\d+)([a-f])(?: |$)", values))


def _cases(column: int) -> str:
    sql = {1: lambda x: "NULL" if x[1] is None else f"'{x[1]}'", 2: lambda x: _expected(x[2])}[column]
    return "CASE " + " ".join(f"WHEN k % {len(TEXTS)} = {i} THEN {sql(x)}" for i, x in enumerate(TEXTS)) + " END"


def shaped_texts(spark, d):
    """(k, raw): a text of each shape in turn, one an order."""
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    numbers = {n: F.regexp_replace(F.expr(f"cast(cast({sql} as double) as string)"), r"\.0$", "") for n, sql in NUMBERS.items()}
    text = F.element_at(F.array(*[F.lit(raw) for raw, _, _ in TEXTS]), (F.col("k") % len(TEXTS) + 1).cast("int"))
    for n, value in numbers.items():
        text = F.replace(text, F.lit(f"{{{n}}}"), value)
    return rows.select("k", text.alias("raw"))


def _flat(p):
    """A result's measurements as text, in hundredths."""
    label = lambda part, m: F.concat(F.coalesce(F.concat(part, F.lit(".")), F.lit("")), m["attribute"], F.lit("="), F.round(m["value"] * 100).cast("long").cast("string"))
    return F.array_join(F.flatten(F.transform(p["dims"]["parts"], lambda x: F.transform(x["measurements"], lambda m: label(x["part"], m)))), " ")


@query("dimension_shapes", f"SELECT k, {_cases(1)} AS pattern_name, {_cases(2)} AS found FROM (SELECT o_orderkey AS k FROM orders)")
def dimension_shapes(spark, d):
    """All shapes of the cascade, by dispatch on masks."""
    out = dimensions.parse_table(shaped_texts(spark, d), "raw")
    return out.select("k", "p.pattern_name", _flat(F.col("p")).alias("found"))


@query("dimension_cascade", f"SELECT {_cases(1)} AS pattern_name, count(*) AS n FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1")
def dimension_cascade(spark, d):
    """The same texts through the expression, counted by shape."""
    return shaped_texts(spark, d).groupBy(dimensions.parse_dimensions(F.col("raw"))["pattern_name"].alias("pattern_name")).agg(F.count("*").alias("n"))


#: Artist text, status, makers, then the first one's nationality, begin and end as SQL. n is a name; a, b, y, d are years of the row.
MAKERS = [
    ("{n}\nDutch, {a}–{b}", "parsed", 1, "'Dutch'", "a", "b"),
    ("{n} (Dutch, {a}-{b})", "parsed", 1, "'Dutch'", "a", "b"),
    ("{n} (Dutch, ca. {a} – ca. {b})", "parsed", 1, "'Dutch'", "a", "b"),
    ("{n} (South Dutch, {a}–{y})", "parsed", 1, "'South Dutch'", "a", "b"),
    ("{n} (born {a})", "parsed", 1, "NULL", "a", "NULL"),
    ("{n} (French, died {b})", "parsed", 1, "'French'", "NULL", "b"),
    ("{n} (Flemish, active {d}s)", "parsed", 1, "'Flemish'", "d", "d + 9"),
    ("{n} (Italian, 16th century)", "parsed", 1, "'Italian'", "1500", "1599"),
    ("{n} (Italian, 16th–17th century)", "parsed", 1, "'Italian'", "1500", "1699"),
    ("{n} (Italian, founded {a})", "parsed", 1, "'Italian'", "a", "NULL"),
    ("{n} (Dutch, {a}/64–{b})", "parsed", 1, "'Dutch'", "a", "b"),
    ("{n} (Dutch, active ca. {a}-{b})", "parsed", 1, "'Dutch'", "a", "b"),
    ("{n} (Dutch, {a})", "parsed", 1, "'Dutch'", "a", "NULL"),
    ("{n} (Dutch, {a}-{b})\n\n Mary Stone (French, {a}-{b})", "parsed", 2, "'Dutch'", "a", "b"),
    ("Flemish", "non_artist", 0, "NULL", "NULL", "NULL"),
    ("Workshop of {n} (Dutch, {a}–{b})", "unparsed", 0, "NULL", "NULL", "NULL"),
    ("{n} (Dutch, {a}–{b}) and Jan Doe (Dutch, {a}-{b})", "unparsed", 0, "NULL", "NULL", "NULL"),
    ("{n}\n(odd)", "unparsed", 0, "NULL", "NULL", "NULL"),
    ("{n}", "unparsed", 0, "NULL", "NULL", "NULL"),
    (" ", None, None, "NULL", "NULL", "NULL"),
]
_YEARS = {"a": "1600 + k % 40", "b": "1650 + k % 40", "y": "50 + k % 40", "d": "1600 + k % 9 * 10"}


def _maker_cases(column: int, quote: bool = False) -> str:
    years = lambda x: re.sub(r"\b([abd])\b", lambda m: f"({_YEARS[m[1]]})", x)
    shown = lambda x: "NULL" if x is None else f"'{x}'" if quote else years(x) if isinstance(x, str) and not x.startswith("'") else str(x)
    return "CASE " + " ".join(f"WHEN k % {len(MAKERS)} = {i} THEN {shown(row[column])}" for i, row in enumerate(MAKERS)) + " END"


@query("artist_shapes", f"""
SELECT k, {_maker_cases(1, True)} AS status, CAST({_maker_cases(2)} AS INTEGER) AS makers, CASE WHEN {_maker_cases(2)} > 0 THEN 'Ann ' || translate(c_name, '#0123456789', ' abcdefghij') END AS name, {_maker_cases(3)} AS nationality,
  CAST({_maker_cases(4)} AS VARCHAR) AS begun, CAST({_maker_cases(5)} AS VARCHAR) AS ended FROM (SELECT c_custkey AS k, c_name FROM customer)""")
def artist_shapes(spark, d):
    """Names and details on a line or on two, dates of every form, several makers, places, attributions and what can't be read."""
    from ..operators.artist import parse_artist

    rows = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("Ann "), F.translate("c_name", "#0123456789", " abcdefghij")).alias("n"))
    raw = F.element_at(F.array(*[F.lit(x[0]) for x in MAKERS]), (F.col("k") % len(MAKERS) + 1).cast("int"))
    for name, sql in _YEARS.items():
        raw = F.replace(raw, F.lit(f"{{{name}}}"), F.expr(f"cast({sql} as string)"))
    out = rows.select("k", parse_artist(F.replace(raw, F.lit("{n}"), F.col("n"))).alias("p"))
    first = F.try_element_at("p.artists", F.lit(1))
    return out.select("k", "p.status", F.when(F.col("p").isNotNull(), F.size("p.artists")).alias("makers"), first["artist_name"].alias("name"), first["artist_nationality"].alias("nationality"), first["artist_date_begin"].alias("begun"), first["artist_date_end"].alias("ended"))
