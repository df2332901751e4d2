"""Lists, numbers and years that come as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import nullish, trim_all


def parse_list(c: Column, fallback: str = "whole") -> Column:
    """A list from JSON, a Python literal, or by fallback: whole (one item), lower (one item in lower case), commas. Nullish gives null."""
    s = trim_all(c.cast("string"))
    listed = s.startswith("[")
    as_json = F.from_json(F.when(listed, s), "array<string>")
    as_literal = F.from_json(F.when(listed, F.regexp_replace(F.regexp_replace(s, r"(?<=[\[,])\s*'|'\s*(?=[,\]])", '"'), r"\bNone\b", "null")), "array<string>")
    rest = {"whole": F.array(s), "lower": F.array(F.lower(s)), "commas": F.filter(F.transform(F.split(F.regexp_replace(s, r"[\[\]'\"]", ""), ","), lambda x: F.trim(x)), lambda x: x != "")}[fallback]
    good = lambda a: F.when(F.size(F.filter(a, lambda x: x.isNotNull())) > 0, a)
    return F.when(~nullish(c), F.coalesce(good(as_json), good(as_literal), rest))


def as_list(c: Column, is_list: bool) -> Column:
    """A scalar as a list of one; null as an empty list."""
    return F.coalesce(c, F.array()) if is_list else F.when(c.isNull(), F.array()).otherwise(F.array(c))


def clean_year(c: Column, empty: bool = False) -> Column:
    """The first 4-digit run, else the first run of 1 to 3 digits, else the text; nullish gives null, or '' with empty."""
    s = c.cast("string")
    found = F.coalesce(F.nullif(F.regexp_extract(s, r"(\d{4})", 1), F.lit("")), F.nullif(F.regexp_extract(s, r"(\d{1,3})", 1), F.lit("")), s)
    return F.when(~nullish(s), found).otherwise(F.lit("") if empty else F.lit(None))


def clean_role(c: Column) -> Column:
    """The role in lower case, or null for texts that mean none."""
    low = F.lower(F.trim(c))
    return F.when(~low.isin("", "nan", "none", "null", "unknown"), low)


def safe_json(c: Column, schema: str) -> Column:
    """A struct from JSON, else from a Python literal, else null."""
    literal = F.replace(F.replace(F.replace(F.replace(c, F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null")), F.lit("True"), F.lit("true")), F.lit("False"), F.lit("false"))
    ok = F.try_parse_json(c).isNotNull()
    return F.from_json(F.when(ok, c).otherwise(F.when(F.try_parse_json(literal).isNotNull(), literal)), schema)


def parse_number(c: Column) -> Column:
    """A decimal, a fraction a/b, or whole and fraction 'w a/b' or 'w-a/b'; null otherwise."""
    s = F.trim(c)
    whole = F.regexp_extract(s, r"^(?:(\d+)[\s\-]+)?(\d+)/(\d+)$", 1)
    top, low = (F.regexp_extract(s, r"^(?:(\d+)[\s\-]+)?(\d+)/(\d+)$", k).try_cast("double") for k in (2, 3))
    fraction = F.coalesce(whole.try_cast("double"), F.lit(0.0)) + F.try_divide(top, low)
    return F.when(s.rlike(r"^\d+(?:\.\d+)?$"), s.try_cast("double")).when(s.rlike(r"^(?:\d+[\s\-]+)?\d+/\d+$"), fraction)


def get_numbers(c: Column) -> Column:
    """All numbers of a text in order, mixed fractions as decimals."""
    found = F.regexp_extract_all(c, F.lit(r"\d+[\s\-]+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?"), F.lit(0))
    return F.filter(F.transform(found, parse_number), lambda x: x.isNotNull())


def get_strings(c: Column) -> Column:
    """Runs of a-z of the text in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0))


def signed_year(year: Column, bce: Column) -> Column:
    """BCE years as negative numbers; a null flag means CE."""
    return F.when(F.coalesce(bce, F.lit(False)), -year).otherwise(year)


def astronomical_year(year: Column, bce: Column) -> Column:
    """Years on a scale with a year 0: 1 BCE is 0."""
    return F.when(F.coalesce(bce, F.lit(False)), 1 - year).otherwise(year)


def from_astronomical(year: Column) -> tuple[Column, Column]:
    """(year, BCE flag) of an astronomical year."""
    return F.when(year <= 0, 1 - year).otherwise(year), year <= 0


def midpoint(begin: Column, end: Column, begin_bce: Column, end_bce: Column) -> Column:
    """The signed mean of both ends; a missing end is the begin."""
    return (signed_year(begin, begin_bce) + signed_year(F.coalesce(end, begin), F.when(end.isNull(), begin_bce).otherwise(end_bce))) / 2.0


def lunar_to_ce(year: Column) -> Column:
    """A lunar-calendar year in the common era."""
    return (year + 622 - F.floor(year / 33)).cast("int")


#: Scalar functions for SQL: head and body. Each says what the Column function of its name says.
SQL_FUNCTIONS = {
    "signed_year(y INT, bce BOOLEAN) RETURNS INT": "IF(coalesce(bce, false), -y, y)",
    "astronomical_year(y INT, bce BOOLEAN) RETURNS INT": "IF(coalesce(bce, false), 1 - y, y)",
    "midpoint(b INT, b_bce BOOLEAN, e INT, e_bce BOOLEAN) RETURNS DOUBLE": "(IF(coalesce(b_bce, false), -b, b) + IF(coalesce(IF(e IS NULL, b_bce, e_bce), false), -coalesce(e, b), coalesce(e, b))) / 2.0D",
    "lunar_to_ce(y INT) RETURNS INT": "CAST(y + 622 - floor(y / 33) AS INT)",
    "squeeze(s STRING) RETURNS STRING": "trim(regexp_replace(s, '\\\\s+', ' '))",
    "slugify(s STRING) RETURNS STRING": "coalesce(nullif(substring(lower(regexp_replace(regexp_replace(trim(s), '\\\\s+', '_'), '[^\\\\w\\\\-.]', '')), 1, 120), ''), 'unknown')",
    "nullish(s STRING) RETURNS BOOLEAN": "s IS NULL OR lower(regexp_replace(s, '^\\\\s+|\\\\s+$', '')) IN ('', 'nan', 'none', '{}', '[]', 'null')",
    "clean_text(s STRING) RETURNS STRING": "lower(trim(coalesce(s, '')))",
    "list_to_str(a ARRAY<STRING>) RETURNS STRING": "array_join(a, ', ')",
    "jaccard(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE": "coalesce(try_divide(size(array_intersect(a, b)), size(array_union(a, b))), 0.0D)",
    "century_of(y INT) RETURNS INT": "CAST(floor((y - 1) / 100) + 1 AS INT)",
    "decade_of(y INT) RETURNS INT": "CAST(floor(y / 10) * 10 AS INT)",
    "inches_to_cm(x DOUBLE) RETURNS DOUBLE": "round(x * 2.54D, 2)",
    "pounds_to_g(x DOUBLE) RETURNS DOUBLE": "round(x * 453.592D, 2)",
    "dot(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": "aggregate(zip_with(a, b, (x, y) -> x * y), 0.0D, (s, x) -> s + x)",
    "cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": "try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0.0D, (s, x) -> s + x), sqrt(aggregate(a, 0.0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0.0D, (s, x) -> s + x * x)))",
    "request_key(a STRING, b STRING) RETURNS STRING": "sha2(concat_ws('|', a, b), 256)",
    "last_segment(u STRING) RETURNS STRING": "nullif(element_at(split(regexp_replace(u, '[/#?]+$', ''), '[/#]'), -1), '')",
}


def register_sql(spark) -> list[str]:
    """Make these functions known to SQL as temporary SQL functions, which Catalyst inlines; returns their names."""
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in SQL_FUNCTIONS]
