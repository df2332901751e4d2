"""Scalar text functions as Column expressions. All are null-safe and stay in the JVM unless said otherwise."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that mean "no value" (fixed values).
NULLISH = ("", "nan", "none", "{}", "[]", "null")
#: The commonest named character references, for checks in SQL; `amp` comes last. references() knows all.
ENTITIES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "eacute": "é", "egrave": "è", "agrave": "à", "ccedil": "ç", "ouml": "ö", "uuml": "ü", "auml": "ä", "szlig": "ß", "ntilde": "ñ", "times": "×", "ndash": "–", "mdash": "—", "hellip": "…", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“", "copy": "©", "middot": "·", "amp": "&"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body mentions it."""
    return F.transform(F.array(value), body).getItem(0)


def trim_all(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space runs as one blank, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def nullish(c: Column) -> Column:
    """Whether a text means no value."""
    return c.isNull() | F.lower(trim_all(c.cast("string"))).isin(*NULLISH)


def real(c: Column) -> Column:
    """The text, or null if it means no value."""
    return F.when(~nullish(c), c)


def html_to_text(c: Column) -> Column:
    """Line breaks for <br> and </p>, other tags dropped (only those within a line), at most one empty line in a row."""
    c = F.regexp_replace(c, r"(?i)<br\s*/?>", "\n")
    c = F.regexp_replace(c, r"(?i)</p\s*>", "\n\n")
    c = F.regexp_replace(c, r"<[^>\n]+>", "")
    return trim_all(F.regexp_replace(c, r"\n{3,}", "\n\n"))


_REFERENCE = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def references(c: Column) -> Column:
    """Character references as the characters that they name: all named ones of HTML 5, &#233; and &#xe9;. What names none stays.

    The text is split at its references once and put together again; nothing is decoded twice. References without a semicolon stay.
    """
    names = F.from_json(F.lit(json.dumps({f"&{k}": v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")
    point = lambda x: F.when(F.lower(F.substring(x, 3, 1)) == "x", F.conv(F.regexp_extract(x, r"([0-9a-fA-F]+);$", 1), 16, 10)).otherwise(F.regexp_extract(x, r"(\d+);$", 1)).try_cast("int")
    letter = lambda n: F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    one = lambda x: F.coalesce(F.when(F.substring(x, 2, 1) == "#", letter(point(x))).otherwise(F.try_element_at(names, x)), x)
    found = F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), one)
    pieces = F.zip_with(F.split(c, _REFERENCE, -1), F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def parsed_once(df: DataFrame, column: str, name: str, parse: Callable[[Column], Column]) -> DataFrame:
    """df with a column `name`, parse(column), worked out once for each different text and joined back.

    For costly parsers over texts that repeat, as dates and measures do: few different texts are broadcast by
    the planner, many are joined by hash. A null text meets its own result too.
    """
    texts = df.select(F.col(column).alias("__text")).distinct().withColumn(name, parse(F.col("__text")))
    return df.join(texts, F.col(column).eqNullSafe(F.col("__text")), "left").drop("__text")


def strip_html(c: Column) -> Column:
    """One line per line of text: <br> is a blank, tags go (across lines too), references are decoded, blanks are squeezed. Null gives ''."""
    c = F.regexp_replace(c, r"(?i)<br\s*/?>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]+>", "")
    c = F.replace(let(c, references), F.lit("\u00a0"), F.lit(" "))
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.coalesce(trim_all(F.array_join(lines, "\n")), F.lit(""))


def list_to_str(c: Column) -> Column:
    """Items joined by ', ', nulls skipped; a null list is null."""
    return F.array_join(c, ", ")


def slugify(c: Column, most: int = 120) -> Column:
    """Lower case, blanks as '_', only word characters, '-' and '.'; at most `most` characters; empty gives 'unknown'."""
    slug = F.substring(F.lower(F.regexp_replace(F.regexp_replace(trim_all(c), r"\s+", "_"), r"[^\w\-.]", "")), 1, most)
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown"))


def resolve_language(m: Column) -> Column:
    """From language to texts: English, else Dutch, else undetermined; null if none has any."""
    pick = lambda k: F.when(F.size(m[k]) > 0, m[k])
    return F.coalesce(pick("English"), pick("Dutch"), pick("und"))


def source_prefix(c: Column, prefix: str) -> Column:
    """The id with its source's prefix, put once."""
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def source_of(c: Column) -> Column:
    return F.substring_index(c, "_", 1)


def unify_dashes(c: Column) -> Column:
    """All dashes and the minus sign as '-', slashes too."""
    return F.translate(c, "‐‑‒–—―−﹣－/", "-" * 10)


def nfkc(c: Column) -> Column:
    """Compatibility composition. Vectorised in Python: the JVM has no such function in SQL."""
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return run(c)


def finite_compat(c: Column) -> Column:
    """The part of NFKC that occurs in dates and measures, without Python: no-break and thin blanks, vulgar fractions, full-width digits."""
    c = F.translate(c, "     ０１２３４５６７８９", "     0123456789")
    for mark, text in {"½": "1/2", "¼": "1/4", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8", "⁄": "/"}.items():
        c = F.regexp_replace(c, rf"(?<=\d){mark}", f" {text}") if mark != "⁄" else F.replace(c, F.lit(mark), F.lit(text))
        c = F.replace(c, F.lit(mark), F.lit(text))
    return c


def quoted(c: Column) -> Column:
    """A pattern that matches exactly the text of c."""
    return F.regexp_replace(c, r"([\\.\[\]{}()*+\-?^$|/])", r"\\$1")


def propagate(text: Column, old: Column, new: Column) -> Column:
    """Every whole-word occurrence of old, in any case, replaced by new taken literally; nothing changes for a nullish old or null new."""
    pattern = F.concat(F.lit(r"(?i)\b"), quoted(old), F.lit(r"\b"))
    literal = F.regexp_replace(new, r"([\\$])", r"\\$1")
    return F.when(nullish(old) | new.isNull() | text.isNull(), text).otherwise(F.regexp_replace(text, pattern, literal))


def image_rendition(c: Column) -> Column:
    """URLs of known image services turned to a small rendition, by the form of the URL."""
    return (
        F.when(c.contains("/full/843,/"), F.replace(c, F.lit("/full/843,/"), F.lit("/full/224,/")))
        .when(c.contains("/full/max/"), F.replace(c, F.lit("/full/max/"), F.lit("/full/224,/")))
        .when(c.contains("/original/"), F.replace(c, F.lit("/original/"), F.lit("/web-large/")))
        .otherwise(c)
    )


def anonymous(c: Column) -> Column:
    """No name: empty, nan, or unknown or anonymous somewhere in it."""
    low = F.lower(trim_all(F.coalesce(c, F.lit(""))))
    return (low == "") | (low == "nan") | low.contains("unknown") | low.contains("anonymous")


#: What marks a name as no person's (fixed values), for injection and for profiles.
ANONYMOUS_TOKENS = ("unknown", "anonymous", "unidentified", "attributed to", "style of", "manner of")
ATTRIBUTION_TOKENS = ("unknown", "anonymous", "unidentified", "attributed to", "workshop of", "circle of", "school of", "style of", "follower of")


def anonymous_for_injection(c: Column, compat: bool = False) -> Column:
    """Any of the tokens in the name. compat also takes the letters 'nan' anywhere for no name."""
    low = F.lower(F.coalesce(c, F.lit("")))
    hit = reduce(lambda a, t: a | low.contains(t), ANONYMOUS_TOKENS, low == "")
    return hit | (low.contains("nan") if compat else low == "nan")


def attributed(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda a, t: a | low.contains(t), ATTRIBUTION_TOKENS, low == "")


def ambiguous(c: Column) -> Column:
    """Whether a value leaves a choice: or, and, ?, possibly, probably, maybe, a slash."""
    return F.coalesce(F.lower(c).rlike(r"\b(or|and|possibly|probably|maybe)\b|\?|/"), F.lit(False))


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"\w+"), F.lit(0))


def similar_loose(a: Column, b: Column) -> Column:
    """Blank, equal, one inside the other, or any word in common."""
    a, b = F.lower(trim_all(F.coalesce(a, F.lit("")))), F.lower(trim_all(F.coalesce(b, F.lit(""))))
    return (a == "") | (b == "") | a.contains(b) | b.contains(a) | F.arrays_overlap(words(a), words(b))


def similar_strict(a: Column, b: Column, share: float = 0.7) -> Column:
    """Equal, one inside the other, or more than a share of the longer's words in common."""
    a, b = F.lower(trim_all(F.coalesce(a, F.lit("")))), F.lower(trim_all(F.coalesce(b, F.lit(""))))
    x, y = F.array_distinct(F.split(a, r"\s+")), F.array_distinct(F.split(b, r"\s+"))
    return (a == b) | a.contains(b) | b.contains(a) | (F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)) > share)


def dedupe_artist(c: Column) -> Column:
    """Of comma-separated names in list clothes: the longest that holds all others, else the longest; ties to the first."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(c, r"[\[\]'\"]", ""), ","), lambda x: F.trim(x)), lambda p: p != "")
    holding = F.filter(parts, lambda x: F.forall(parts, lambda p: F.contains(x, p)))
    longest = lambda arr: F.reduce(arr, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return F.when(c.isNotNull(), F.when(F.size(holding) > 0, longest(holding)).when(F.size(parts) > 0, longest(parts)))


def combine_medium(*cs: Column) -> Column:
    """Values that are there joined by ' , '; null without any."""
    return F.nullif(F.concat_ws(" , ", *cs), F.lit(""))


def fold_case(columns: list[str], keep: tuple[str, ...] = ("object_ID", "title", "description", "inscriptions", "image_url", "cho_uri")) -> list[Column]:
    """All columns in lower case but those kept and raw_ ones."""
    return [F.col(c) if c in keep or c.startswith("raw_") else F.lower(F.col(c)).alias(c) for c in columns]


def effective(df_columns: list[str], c: str) -> Column:
    """The injected value if there is one, else the base value, else ''."""
    shadow = [F.col(f"{c}_error").cast("string")] if f"{c}_error" in df_columns else []
    return F.coalesce(*shadow, F.col(c).cast("string"), F.lit(""))


def date_label(begin: Column, end: Column, begin_bce: Column, end_bce: Column) -> Column:
    """'b', 'e' or 'b - e' when they differ, without '.0', with BCE where flagged."""
    side = lambda y, f: F.concat(F.regexp_replace(y.cast("string"), r"\.0$", ""), F.when(F.coalesce(f, F.lit(False)), " BCE").otherwise(""))
    b, e = side(begin, begin_bce), side(end, end_bce)
    return F.when(b.isNull() | e.isNull() | (b == e), F.coalesce(b, e)).otherwise(F.concat_ws(" - ", b, e))


def describe(title: Column, kind: Column, artist: Column, date: Column, material: Column, place: Column, text: Column, most: int = 70) -> Column:
    """A one-line description from optional clauses, the description cut with an ellipsis."""
    cut = F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)
    clause = lambda label, c: F.when(~nullish(c), F.concat(F.lit(label), c.cast("string")))
    return F.concat_ws(", ", clause("", kind), clause("titled ", title), clause("by ", artist), clause("dated ", date), clause("made of ", material), clause("from ", place), clause("", cut))


def metadata_prompt(fields: dict[str, Column], mode: str = "both") -> Column:
    """Labelled lines of the fields that have values, for a model that checks them; mode: table, image or both."""
    intro = {"table": "Check this record for a value that contradicts the others.", "image": "Check whether the image shows what the record says.", "both": "Check this record against itself and against its image."}[mode]
    return F.concat_ws("\n", F.lit(intro), *[F.when(~nullish(c), F.concat(F.lit(f"{k}: "), c.cast("string"))) for k, c in fields.items()])


def claim(target: str, value: Column) -> Column:
    """A statement about one field that a model can confirm or deny; null without a value."""
    return F.when(~nullish(value), F.concat(F.lit(f"The {target} of this object is "), value.cast("string"), F.lit(".")))


def json_from_model(c: Column, schema: str) -> Column:
    """A model's answer as a struct: without code fences, or the first {...} in it; null if it can't be read."""
    bare = trim_all(F.regexp_replace(c, r"(?s)^\s*```\w*\s*|\s*```\s*$", ""))
    block = F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))
    ok = F.try_parse_json(bare)
    return F.from_json(F.when(ok.isNotNull(), bare).otherwise(block), schema, {"mode": "PERMISSIVE"})


def fingerprint(**fields: Column) -> Column:
    """SHA-256 over the fields sorted by name, blanks squeezed: a key for caches."""
    return F.sha2(F.to_json(F.struct(*[squeeze(c.cast("string")).alias(k) for k, c in sorted(fields.items())])), 256)


def request_key(**params: Column) -> Column:
    """md5 over parameters sorted by name."""
    return F.md5(F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in sorted(params.items())])))
