"""Linked-data nodes: language tagging, grouping and pickers over arrays of structs.

A label is a struct (language, value, rank); a document's labels are an array of them, in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import squeeze

#: Language node ids and tags by name (fixed values).
LANGUAGES = {"English": ("300388277", "en"), "Dutch": ("300388256", "nl")}


def language_of(node: Column) -> Column:
    """English, Dutch or und, from a language node's id or an xml:lang tag."""
    out = F.lit("und")
    for name, (number, tag) in LANGUAGES.items():
        out = F.when(node.contains(number) | F.lower(node).rlike(rf"^{tag}(-|$)"), name).otherwise(out)
    return out


def classified_ids(nodes: Column) -> Column:
    """The distinct ids of classification nodes (array of struct with id)."""
    return F.array_distinct(F.filter(F.transform(nodes, lambda n: n["id"]), lambda x: x.isNotNull()))


def by_language(labels: Column) -> Column:
    """A map from language to values in order of first sight, without repeats."""
    langs = F.array_distinct(F.transform(labels, lambda x: x["language"]))
    return F.map_from_entries(F.transform(langs, lambda lang: F.struct(lang, F.array_distinct(F.transform(F.filter(labels, lambda x: x["language"] == lang), lambda x: x["value"])))))


def merge_by_language(a: Column, b: Column) -> Column:
    """Two such maps in one, values of both without repeats."""
    return F.map_zip_with(a, b, lambda _, x, y: F.array_distinct(F.concat(F.coalesce(x, F.array()), F.coalesce(y, F.array()))))


def pick_identifier(uri: Column) -> Column:
    """The last segment of a URI."""
    return F.nullif(F.element_at(F.split(F.regexp_replace(uri, r"[/#?]+$", ""), "[/#]"), -1), F.lit(""))


def pick_titles(labels: Column, title_kinds: list[str]) -> Column:
    """Values of labels that are classified as a title, else of all labels."""
    titled = F.filter(labels, lambda x: F.arrays_overlap(x["kinds"], F.array(*map(F.lit, title_kinds))))
    return F.transform(F.when(F.size(titled) > 0, titled).otherwise(labels), lambda x: squeeze(x["value"]))


def pick_artists(productions: Column) -> Column:
    """Names from productions (name, rejected, workshop) that aren't rejected, a workshop so called; without repeats, in order."""
    kept = F.filter(productions, lambda p: ~F.coalesce(p["rejected"], F.lit(False)) & p["name"].isNotNull())
    return F.array_distinct(F.transform(kept, lambda p: F.when(F.coalesce(p["workshop"], F.lit(False)), F.concat(F.lit("workshop of "), p["name"])).otherwise(p["name"])))


def scalar_if_single(a: Column) -> Column:
    """One value as it is, several joined, none null."""
    return F.when(F.size(a) > 0, F.array_join(a, "; "))


def pick_location(names: Column) -> Column:
    """The first name that is no room or code: without digits, hyphen, or a room word; else the first."""
    plain = F.filter(names, lambda x: ~x.rlike(r"[\d-]|^(?i)(room|gallery|zaal|depot)\b"))
    return F.coalesce(F.try_element_at(plain, F.lit(1)), F.try_element_at(names, F.lit(1)))


def looks_like_provenance(c: Column) -> Column:
    """A leading ellipsis, braces, or two semicolons and more."""
    return c.rlike(r"^\s*(\.\.\.|…)") | c.contains("{") | c.contains("}") | (F.length(c) - F.length(F.replace(c, F.lit(";"), F.lit(""))) >= 2)


#: Kinds of text that are no description (fixed values).
NO_DESCRIPTION = ("provenance", "inscription", "dimensions", "credit line", "bibliography", "copyright")


def pick_descriptions(texts: DataFrame) -> DataFrame:
    """(id, language, description) from rows (id, language, kind, is_label, classified, text).

    Texts classified as descriptions win. For languages without one, the longest fallback text does, labels
    first: of no excluded kind, of 40 characters or more, and not like a provenance. Ties go to the text that
    sorts first.
    """
    sound = F.coalesce("classified", F.lit(False)) | (~F.lower(F.coalesce("kind", F.lit(""))).isin(*NO_DESCRIPTION) & (F.length("text") >= 40) & ~looks_like_provenance(F.col("text")))
    order = [F.coalesce("classified", F.lit(False)).desc(), F.coalesce("is_label", F.lit(False)).desc(), F.length("text").desc(), F.col("text")]
    ranked = texts.where("text is not null").where(sound).withColumn("rank", F.row_number().over(Window.partitionBy("id", "language").orderBy(*order)))
    return ranked.where("rank = 1").select("id", "language", F.col("text").alias("description"))


def variant_list(v: Column) -> Column:
    """A variant that is one value or a list, as an array of strings."""
    is_array = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(v.isNull(), F.array()).when(is_array, F.try_variant_get(v, "$", "array<string>")).otherwise(F.array(F.try_variant_get(v, "$", "string")))
