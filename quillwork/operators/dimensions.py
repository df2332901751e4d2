"""Dimensions: an ordered table of shapes compiled to one CASE, a formatter, and a grammar re-parser.

Shapes are built from a few building blocks; only metric values are kept (cm and g).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, squeeze
from ..schema import DIMENSIONS

NUM = r"(\d+(?:\.\d+)?)"
ANY = r"\d+(?:\.\d+)?"
FRAC = r"(?:\d+(?:[\s\-]+\d+/\d+|\.\d+)?|\d+/\d+)"
X = r"\s*[x×]\s*"
IMP2, IMP3 = rf"{FRAC}{X}{FRAC}", rf"{FRAC}{X}{FRAC}{X}{FRAC}"
INCH = r"\s*in(?:ches|\.)?"
TAIL = rf"(?:\s*\([^()]*\))?\.?"
SEP = r"\s*[;,]?\s*"

Shape = tuple[str, str, list[tuple[str | None, list[tuple[str, int, float]]]]]


def _metric(n: int) -> str:
    return X.join([NUM] * n) + r"\s*cm"


def _part(label: str, n: int) -> str:
    return rf"{label}:?\s*{_metric(n)}{TAIL}"


def _imperial(n: int) -> str:
    """Inches first, metric values in brackets."""
    return X.join([FRAC] * n) + INCH + r"\s*\(" + _metric(n) + r"\)"


def _attrs(names: str, first: int = 1, scale: float = 1.0, grams: tuple[str, ...] = ("weight",)) -> list[tuple[str, int, float]]:
    return [(a, first + k, 1.0 if a in grams else scale) for k, a in enumerate(names.split())]


def _labelled(names: str, unit: str = "mm", sep: str = X) -> str:
    return sep.join(rf"{a}\s*{NUM}" + (r"(?:\s*g)?" if a == "weight" else rf"\s*{unit}") for a in names.split())


def shapes() -> list[tuple[str, str, str, list[tuple[str | None, list[tuple[str, int, float]]]]]]:
    """(name, family, pattern, parts) in priority order; parts are (label, [(attribute, group, factor)])."""
    out: list[tuple[str, str, str, list]] = []
    add = lambda family, name, pattern, *parts: out.append((name, family, rf"(?i)^{pattern}\.?$", list(parts)))
    hw, hwd = "height width", "height width depth"
    m = "metric first"
    add(m, "simple_2d", _metric(2) + TAIL, (None, _attrs(hw)))
    add(m, "image_sheet", _part("image", 2) + SEP + _part("sheet", 2), ("image", _attrs(hw)), ("sheet", _attrs(hw, 3)))
    add(m, "image_plate_sheet", SEP.join(_part(p, 2) for p in ("image", "plate", "sheet")), ("image", _attrs(hw)), ("plate", _attrs(hw, 3)), ("sheet", _attrs(hw, 5)))
    add(m, "simple_3d", _metric(3) + TAIL, (None, _attrs(hwd)))
    add(m, "plate_sheet", _part("plate", 2) + SEP + _part("sheet", 2), ("plate", _attrs(hw)), ("sheet", _attrs(hw, 3)))
    add(m, "image_plate_combined_sheet", _part("image/plate", 2) + SEP + _part("sheet", 2), ("image/plate", _attrs(hw)), ("sheet", _attrs(hw, 3)))
    add(m, "height_only", rf"h(?:eight|\.)?:?\s*{NUM}\s*cm{TAIL}", (None, _attrs("height")))
    add(m, "diameter_only", rf"diam(?:eter|\.)?:?\s*{NUM}\s*cm{TAIL}", (None, _attrs("diameter")))
    add(m, "2d_plus_diam", _metric(2) + TAIL + SEP + rf"diam(?:eter|\.)?:?\s*{NUM}\s*cm{TAIL}", (None, _attrs(hw + " diameter")))
    add(m, "image_paper_mount", _part("image/paper", 2) + SEP + _part("mount", 2), ("image/paper", _attrs(hw)), ("mount", _attrs(hw, 3)))
    add(m, "sheet_only", _part("sheet", 2), ("sheet", _attrs(hw)))
    add(m, "image_paper_album", _part("image/paper", 2) + SEP + _part("album page", 2), ("image/paper", _attrs(hw)), ("album page", _attrs(hw, 3)))
    add(m, "folded_sheet", _part(r"(?:folded sheet|sheet \(folded\))", 2), ("folded sheet", _attrs(hw)))
    g = "labelled"
    mm = lambda names: (None, _attrs(names, 1, 0.1))
    for name, names in (("h_w", hw), ("diam_weight", "diameter weight"), ("h_w_d", hwd), ("h_diam", "height diameter"), ("diam_h", "diameter height"), ("l_w", "length width"), ("h_w_t", "height width thickness"), ("diam", "diameter"), ("h", "height"), ("w_h", "width height"), ("diam_h_weight", "diameter height weight")):
        add(g, f"labelled_{name}", _labelled(names), mm(names))
    add(g, "labelled_h_w_comma", _labelled(hw, sep=r"\s*,\s*"), mm(hw))
    for name, names in (("h_w_weight", hw + " weight"), ("h_w_d_weight", hwd + " weight"), ("l_w_weight", "length width weight"), ("l", "length")):
        add(g, f"labelled_{name}", _labelled(names), mm(names))
    add(g, "labelled_d_h_w", rf"depth\s*{NUM}\s*mm\s*,\s*" + _labelled(hw), mm("depth height width"))
    add(g, "labelled_l_w_t", _labelled("length width thickness") + rf"(?:{X}weight\s*{NUM}(?:\s*g)?)?", mm("length width thickness weight"))
    add(g, "labelled_w_h_t", _labelled("width height thickness") + rf"(?:{X}weight\s*{NUM}(?:\s*g)?)?", mm("width height thickness weight"))
    i = "imperial first"
    one = rf"{FRAC}{INCH}\s*\({NUM}\s*cm\)"
    add(i, "imperial_sheet", r"sheet:?\s*" + _imperial(2), ("sheet", _attrs(hw)))
    add(i, "imperial_2d", _imperial(2), (None, _attrs(hw)))
    add(i, "imperial_h", rf"h\.?:?\s*{one}", (None, _attrs("height")))
    add(i, "imperial_overall", r"overall:?\s*" + _imperial(2), ("overall", _attrs(hw)))
    add(i, "imperial_height", rf"height:?\s*{one}", (None, _attrs("height")))
    add(i, "imperial_diameter", rf"diameter:?\s*{one}", (None, _attrs("diameter")))
    add(i, "imperial_diam", rf"diam\.?:?\s*{one}", (None, _attrs("diameter")))
    add(i, "imperial_sheet_trimmed", r"sheet \(trimmed[^()]*\):?\s*" + _imperial(2), ("sheet", _attrs(hw)))
    add(i, "imperial_3d", _imperial(3), (None, _attrs(hwd)))
    add(i, "imperial_h_diam", rf"h(?:eight|\.)?:?\s*{one}{SEP}diam(?:eter|\.)?:?\s*{one}", (None, _attrs("height diameter")))
    add(i, "imperial_h_w", rf"h(?:eight|\.)?:?\s*{one}{SEP}w(?:idth|\.)?:?\s*{one}", (None, _attrs(hw)))
    add(i, "imperial_single", one, (None, _attrs("height")))
    e = "imperial extended"
    add(e, "imperial_plate_sheet", r"plate:?\s*" + _imperial(2) + SEP + r"sheet:?\s*" + _imperial(2), ("plate", _attrs(hw)), ("sheet", _attrs(hw, 3)))
    add(e, "imperial_sheet_plate", r"sheet:?\s*" + _imperial(2) + SEP + r"plate:?\s*" + _imperial(2), ("sheet", _attrs(hw)), ("plate", _attrs(hw, 3)))
    add(e, "imperial_l_w", rf"l\.?\s*{FRAC}{X}w\.?\s*{FRAC}{INCH}\s*\({NUM}{X}{NUM}\s*cm\)", (None, _attrs("length width")))
    add(e, "imperial_overall_3d", r"overall:?\s*" + _imperial(3), ("overall", _attrs(hwd)))
    add(e, "imperial_h_w_space", rf"h\.?\s*{one}\s+w\.?\s*{one}", (None, _attrs(hw)))
    add(e, "imperial_h_w_d_space", rf"h\.?\s*{one}{SEP}w\.?\s*{one}{SEP}d\.?\s*{one}", (None, _attrs(hwd)))
    add(e, "imperial_image_sheet", r"image:?\s*" + _imperial(2) + SEP + r"sheet:?\s*" + _imperial(2), ("image", _attrs(hw)), ("sheet", _attrs(hw, 3)))
    add(e, "imperial_l_w_plain", rf"l\.?\s*{NUM}{X}w\.?\s*{NUM}\s*cm", (None, _attrs("length width")))
    add(e, "imperial_l", rf"l(?:ength|\.)?:?\s*{one}", (None, _attrs("length")))
    add(e, "inline_metric_3d", rf"h\.?\s*{NUM}{X}w\.?\s*{NUM}{X}d\.?\s*{NUM}\s*cm{TAIL}", (None, _attrs(hwd)))
    return out


def parse_dimensions(raw: Column, compat_zero: bool = False) -> Column:
    """(pattern_name, dims): the first shape that fits the whole text, its values in cm and g rounded to 2; null struct fields without one.

    Zero values are dropped in the labelled height and width shape; compat_zero keeps them elsewhere as they
    are, without it they are dropped everywhere.
    """
    return let(squeeze(raw), lambda s: _cascade(s, compat_zero))


def parse_table(df: DataFrame, raw: str, name: str = "p", compat_zero: bool = False, cut=None) -> DataFrame:
    """df with a column `name`, the same as parse_dimensions(raw), by dispatch on a text's shape.

    No shape depends on how many digits a number has, so a text fits the one that its mask, with each run of digits as one,
    fits. Masks are few where measures are many: only the different ones go through the cascade, and each row
    then evaluates the one pattern that its mask names. The table of masks that fit anything is written (cut: to the shared folder), so
    it is broadcast only if it is small.
    """
    from ..sources.sinks import cutter

    rows = df.withColumn("__text", squeeze(F.col(raw))).withColumn("__mask", F.regexp_replace("__text", r"[0-9]+", "0"))
    masks = rows.select("__mask").where("__mask is not null").distinct().withColumn("no", let(F.col("__mask"), _first_fit)).where("no is not null")
    known = (cut or cutter(df.sparkSession))(masks.join(F.broadcast(shape_table(df.sparkSession)), "no").select(F.col("__mask").alias("__m"), F.struct("name", "pattern", "parts").alias("__shape")))
    joined = rows.join(known, F.col("__mask") == F.col("__m"), "left")
    shape = F.col("__shape")
    drop_zero = F.lit(not compat_zero) | (shape["name"] == "labelled_h_w")

    def measured(v: Column) -> Column:
        value = F.call_function("regexp_extract", F.col("__text"), shape["pattern"], v["group"]).try_cast("double") * v["factor"]
        return F.struct(v["attribute"].alias("attribute"), F.round(value, 2).alias("value"), F.lit(None).cast("string").alias("note"))

    kept = lambda m: F.when(drop_zero, m["value"] > 0).otherwise(m["value"].isNotNull())
    parts = F.transform(shape["parts"], lambda p: F.struct(p["part"].alias("part"), F.filter(F.transform(p["values"], measured), kept).alias("measurements")))
    result = F.struct(shape["name"].alias("pattern_name"), F.struct(parts.alias("parts")).cast(DIMENSIONS).alias("dims"))
    return joined.withColumn(name, F.when(shape.isNotNull(), result)).drop("__text", "__mask", "__m", "__shape")


def shape_table(spark: SparkSession) -> DataFrame:
    """(no, name, pattern, parts): the shapes as rows; parts hold an attribute, the pattern's group and the factor of each value."""
    rows = [(no, name, pattern, [(label, values) for label, values in parts]) for no, (name, _, pattern, parts) in enumerate(shapes())]
    return spark.createDataFrame(rows, "no int, name string, pattern string, parts array<struct<part:string,values:array<struct<attribute:string,group:int,factor:double>>>>")


def _first_fit(s: Column) -> Column:
    """The number of the first shape that fits; families are tried in the order in which they are listed."""
    families = list(dict.fromkeys(x[1] for x in shapes()))
    ordered = sorted(enumerate(shapes()), key=lambda x: families.index(x[1][1]))
    return F.coalesce(*[F.when(s.rlike(x[2]), F.lit(no)) for no, x in ordered])


def _kept(drop_zero: bool):
    return lambda m: m["value"] > 0 if drop_zero else m["value"].isNotNull()


def _cascade(s: Column, compat_zero: bool) -> Column:
    def built(name: str, pattern: str, parts: list) -> Column:
        made = []
        for label, values in parts:
            items = F.array(*[F.struct(F.lit(a).alias("attribute"), F.round(F.regexp_extract(s, pattern, g).try_cast("double") * f, 2).alias("value"), F.lit(None).cast("string").alias("note")) for a, g, f in values])
            drop_zero = not compat_zero or name == "labelled_h_w"
            made.append(F.struct(F.lit(label).cast("string").alias("part"), F.filter(items, _kept(drop_zero)).alias("measurements")))
        return F.struct(F.lit(name).alias("pattern_name"), F.struct(F.array(*made).alias("parts")).cast(DIMENSIONS).alias("dims"))

    families: dict[str, list] = {}
    for name, family, pattern, parts in shapes():
        families.setdefault(family, []).append((pattern, built(name, pattern, parts)))
    chains = [reduce(lambda chain, x: F.when(s.rlike(x[0]), x[1]).otherwise(chain), reversed(rows), F.lit(None)) for rows in families.values()]
    return F.coalesce(*chains)


def format_dimensions(dims: Column) -> Column:
    """'part: attribute v cm x attribute v cm ; ...', weight in g; null if empty."""

    def number(v: Column) -> Column:
        return v.cast("string")

    def one(m: Column) -> Column:
        return F.concat(m["attribute"], F.lit(" "), number(m["value"]), F.when(m["attribute"] == "weight", " g").otherwise(" cm"))

    def part(p: Column) -> Column:
        body = F.array_join(F.transform(p["measurements"], one), " x ")
        return F.when(p["part"].isNotNull(), F.concat(p["part"], F.lit(": "), body)).otherwise(body)

    filled = F.filter(dims["parts"], lambda p: F.size(p["measurements"]) > 0)
    return F.nullif(F.array_join(F.transform(filled, part), " ; "), F.lit(""))


def reparse_dimensions(text: Column) -> Column:
    """The struct of a formatted text. mm become cm, kg become g; zeros go; one bad segment, inches too, makes the whole null."""
    segment = r"(?i)^(?:(max|min)\s+)?([a-z]+)\s+(\d+(?:\.\d+)?)\s*(cm|mm|g|kg)$"

    def measure(x: Column) -> Column:
        unit = F.lower(F.regexp_extract(x, segment, 4))
        value = F.regexp_extract(x, segment, 3).try_cast("double") * F.when(unit == "mm", 0.1).when(unit == "kg", 1000.0).otherwise(1.0)
        return F.when(x.rlike(segment), F.struct(F.lower(F.regexp_extract(x, segment, 2)).alias("attribute"), F.round(value, 2).alias("value"), F.nullif(F.lower(F.regexp_extract(x, segment, 1)), F.lit("")).alias("note")))

    lines = F.filter(F.transform(F.split(text, r"[;\n]"), lambda x: F.trim(x)), lambda x: x != "")
    label = r"^([^:]+):\s*(.*)$"

    def part(x: Column) -> Column:
        name = F.nullif(F.trim(F.regexp_extract(x, label, 1)), F.lit(""))
        body = F.when(x.rlike(label), F.regexp_extract(x, label, 2)).otherwise(x)
        return F.struct(name.alias("part"), F.transform(F.transform(F.split(body, r"\s+[xX×]\s+"), lambda x: F.trim(x)), measure).alias("measurements"))

    def checked(parts: Column) -> Column:
        bad = F.exists(parts, lambda p: F.exists(p["measurements"], lambda m: m.isNull()))
        clean = F.transform(parts, lambda p: F.struct(p["part"].alias("part"), F.filter(p["measurements"], lambda m: m["value"] > 0).alias("measurements")))
        return F.when((F.size(parts) > 0) & ~bad, F.struct(clean.alias("parts")).cast(DIMENSIONS))

    return let(F.transform(lines, part), checked)


#: Factors to cm, or to g for weights (fixed values).
UNITS = {"mm": 0.1, "cm": 1.0, "m": 100.0, "in": 2.54, "ft": 30.48, "g": 1.0, "kg": 1000.0, "lb": 453.592, "oz": 28.349}


def convert(value: Column, unit: Column, digits: int = 2) -> Column:
    """A value in cm or g from any known unit; null for others."""
    factor = reduce(lambda chain, u: F.when(F.lower(unit) == u[0], F.lit(u[1])).otherwise(chain), UNITS.items(), F.lit(None).cast("double"))
    return F.round(value * factor, digits)


def measures_in(text: Column) -> Column:
    """All 'number unit' pairs of a free text as (value in cm or g, kind, note): mixed fractions, feet with inches, hyphen ranges as min and max."""
    from ..functions.lists import parse_number

    token = r"(?i)((?:\d+[\s\-]+)?\d+/\d+|\d+(?:\.\d+)?)(?:\s*-\s*(\d+(?:\.\d+)?))?\s*(mm|cm|m|inches|in|ft|feet|kg|g|lb|oz)\b"
    found = F.regexp_extract_all(text, F.lit(token), F.lit(0))

    def one(x: Column) -> Column:
        unit = F.lower(F.regexp_extract(x, token, 3))
        unit = F.when(unit == "inches", "in").when(unit == "feet", "ft").otherwise(unit)
        kind = F.when(unit.isin("g", "kg", "lb", "oz"), "weight").otherwise("length")
        low, high = parse_number(F.regexp_extract(x, token, 1)), F.regexp_extract(x, token, 2).try_cast("double")
        single = F.array(F.struct(convert(low, unit).alias("value"), kind.alias("kind"), F.when(high.isNotNull(), "min").alias("note")))
        return F.when(high.isNull(), single).otherwise(F.concat(single, F.array(F.struct(convert(high, unit).alias("value"), kind.alias("kind"), F.lit("max").alias("note")))))

    return F.flatten(F.transform(found, one))


def first_part_pivot(dims: Column) -> dict[str, Column]:
    """Six attributes of the first part as numbers, the first value of each."""
    first = F.try_element_at(dims["parts"], F.lit(1))["measurements"]
    named = lambda a: lambda m: F.lower(m["attribute"]) == a
    return {a: F.try_element_at(F.filter(first, named(a)), F.lit(1))["value"] for a in ("height", "width", "depth", "diameter", "length", "weight")}
