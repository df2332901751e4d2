"""Template induction and projection: masks, frequency tables, and solved examples carried over to like texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import get_numbers, get_strings
from ..functions.text import nullish

#: Words behind each mask of the dimension template, in the order of the masks (fixed values).
MASK_WORDS = {
    "<CM>": "cm mm",
    "<IN>": "in inches",
    "<WT>": "g kg oz lb",
    "<H>": "h height heights hght",
    "<W>": "w width widths wdth",
    "<D>": "d depth dpth",
    "<L>": "l length len",
    "<DIAM>": "diam diameter dia",
    "<WEIGHT>": "wt weight",
    "<THICK>": "th thickness thick",
    "<MOD>": "max min overall sheet image plate paper mount mounts frame",
}
#: Patterns and masks in order: signs of multiplication, numbers and fractions, then words, whose dot, and a modifier's colon, go with them.
DIMENSION_MASKS: tuple[tuple[str, str], ...] = (
    (r"\s*[×x]\s*", " x "),
    (r"\d+[\s\-]+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?", "<NUM>"),
    *((rf"\b(?:{'|'.join(words.split())})\b\.?{':?' if mask == '<MOD>' else ''}", mask) for mask, words in MASK_WORDS.items()),
)
#: Unit factors by which an example's number may differ from its solution's (fixed values).
MULTIPLIERS = (1.0, 2.54, 0.1, 100.0, 30.48, 1000.0, 453.592, 28.349)


def mask_dimensions(c: Column) -> Column:
    """The template of a dimension text; a mask's own letters are safe from later masks, which match lower case only."""
    return F.trim(F.regexp_replace(reduce(lambda s, m: F.regexp_replace(s, m[0], m[1]), DIMENSION_MASKS, F.lower(c)), r"\s+", " "))


def mask_dates(c: Column, digits: str = r"\d{1,4}") -> Column:
    """A mask stands for four digits at most, so that longer numbers differ from years."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), digits, "<NUM>"), r"\s+", " "))


def mask_numbers(c: Column) -> Column:
    """A mask stands for a whole number, of any length."""
    return mask_dates(c, r"\d+")


def mask_artists(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), r"\d+", "<NUM>"), r"[a-z]+", "<STR>"), r"\s+", " "))


def residue(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows with a raw text that no parser has solved."""
    return df.where(~nullish(F.col(raw)) & nullish(F.col(parsed)))


def template_table(df: DataFrame, raw: str, mask, low: int = 1, high: int | None = None, top: int | None = None) -> DataFrame:
    """(template, n, example): templates by frequency, each with its smallest text; a frequency band and the top n on demand."""
    out = df.where(~nullish(F.col(raw))).groupBy(mask(F.col(raw)).alias("template")).agg(F.count("*").alias("n"), F.min(raw).alias("example")).where(F.col("n") >= low)
    out = out.where(F.col("n") <= high) if high is not None else out
    return out.orderBy(F.desc("n"), "template").limit(top) if top else out


def project_number(solved: Column, example: Column, target: Column, dates: bool = False) -> Column:
    """A solved number carried from its example's numbers to a like text's.

    It is matched to an example number times a unit factor within 0.1 and replaced by the target's number at
    that place times the factor. Dates over 100 that match nothing move with the nearest anchor above 10: a
    century number by its hundred, another year by its distance up to 100. Else the value is copied.
    """
    place = F.sequence(F.lit(1), F.size(example))
    tries = [F.transform(place, _attempt(example, target, solved, m)) for m in MULTIPLIERS]
    hits = F.filter(F.concat(*tries), lambda x: x["hit"])
    out = F.try_element_at(hits, F.lit(1))["value"]
    if dates:
        anchors = F.filter(F.transform(place, lambda i: F.struct(F.abs(solved - F.when(F.element_at(example, i).between(10, 21), F.element_at(example, i) * 100).otherwise(F.element_at(example, i))).alias("d"), F.element_at(example, i).alias("e"), F.element_at(target, i).alias("t"))), lambda x: (x["e"] > 10) & (x["d"] <= 100))
        nearest = F.array_min(anchors)
        shift = F.when(nearest["e"].between(10, 21), (nearest["t"] - nearest["e"]) * 100).otherwise(nearest["t"] - nearest["e"])
        out = F.coalesce(out, F.when(solved > 100, F.round(solved + shift, 2)))
    return F.when(F.size(example) == F.size(target), F.coalesce(out, solved))


def _attempt(example: Column, target: Column, solved: Column, factor: float):
    return lambda i: F.struct((F.abs(F.element_at(example, i) * factor - solved) <= 0.1).alias("hit"), F.round(F.element_at(target, i) * factor, 2).alias("value"))


def project_text(solved: Column, example: Column, target: Column) -> Column:
    """A solved text with the example's words replaced by the target's words at the same places, capitals kept, then its numbers."""
    old, new = get_strings(example), get_strings(target)
    pairs = F.array_distinct(F.filter(F.arrays_zip(old.alias("o"), new.alias("n")), lambda p: (p["o"] != p["n"]) & p["o"].isNotNull() & p["n"].isNotNull()))
    words = F.split(solved, r"(?<=[A-Za-z])(?=[^A-Za-z])|(?<=[^A-Za-z])(?=[A-Za-z])")

    def one(w: Column) -> Column:
        hit = F.try_element_at(F.filter(pairs, lambda p: p["o"] == F.lower(w)), F.lit(1))["n"]
        return F.when(hit.isNull(), w).when(w == F.upper(w), F.upper(hit)).when(F.substring(w, 1, 1) == F.upper(F.substring(w, 1, 1)), F.initcap(hit)).otherwise(hit)

    return F.array_join(F.transform(words, one), "")


def project(members: DataFrame, solutions: DataFrame, raw: str, mask, dates: bool = False) -> DataFrame:
    """members with projected: the numbers of their template's solved example carried over.

    solutions: (template, example, solved array<double>). Members whose count of numbers differs from the
    example's stay unsolved (null).
    """
    keyed = members.withColumn("template", mask(F.col(raw)))
    joined = keyed.join(solutions, "template", "left").withColumn("__e", get_numbers(F.col("example"))).withColumn("__t", get_numbers(F.col(raw)))
    out = F.when(F.size("__e") == F.size("__t"), F.transform("solved", lambda v: project_number(v, F.col("__e"), F.col("__t"), dates)))
    return joined.withColumn("projected", out).drop("__e", "__t", "solved", "example")


def artist_guard(name: Column, nationality: Column, text: Column) -> Column:
    """Whether a projected artist may be kept: one line, a short nationality, no attribution, brackets in balance."""
    from .artist import ATTRIBUTION

    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
    free = reduce(lambda a, w: a & ~F.lower(name).contains(w), ATTRIBUTION, F.lit(True))
    return ~text.contains("\n") & (F.length(F.coalesce(nationality, F.lit(""))) <= 30) & free & (count(name, "(") == count(name, ")"))
