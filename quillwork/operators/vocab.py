"""Controlled vocabularies: mapping lists and scalars, routing cultures, canonical places and artists.

Vocabularies are small DataFrames or dicts; keys are compared in lower case. A dict becomes a literal map, a
DataFrame a join that Spark broadcasts when it is small enough.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lists import clean_role, clean_year, parse_list
from ..functions.text import nullish

DISCARD = "discard"
#: Demonyms of countries, for locations given as an adjective.
DEMONYMS = {
    "american": "United States", "austrian": "Austria", "belgian": "Belgium", "brazilian": "Brazil", "british": "United Kingdom", "canadian": "Canada",
    "chinese": "China", "danish": "Denmark", "dutch": "Netherlands", "egyptian": "Egypt", "english": "United Kingdom", "flemish": "Belgium", "french": "France",
    "german": "Germany", "greek": "Greece", "hungarian": "Hungary", "indian": "India", "iranian": "Iran", "irish": "Ireland", "italian": "Italy",
    "japanese": "Japan", "korean": "Korea", "mexican": "Mexico", "peruvian": "Peru", "polish": "Poland", "portuguese": "Portugal", "russian": "Russia",
    "spanish": "Spain", "swiss": "Switzerland",
}


def literal_map(mapping: dict[str, str]) -> Column:
    """A map column with keys in lower case; an empty mapping gives an empty map."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for k, v in sorted({k.lower().strip(): v for k, v in mapping.items()}.items()) for x in (k, v)])


def look_up(c: Column, mapping: dict[str, str]) -> Column:
    return F.try_element_at(literal_map(mapping), F.lower(F.trim(c)))


def map_list(items: Column, mapping: dict[str, str]) -> Column:
    """Items by their mapping, unknown ones as they are, `discard` dropped, repeats dropped in order; null if none is left."""
    table = literal_map(mapping)
    mapped = F.transform(items, lambda x: F.coalesce(F.try_element_at(table, F.lower(F.trim(x))), x))
    kept = F.array_distinct(F.filter(mapped, lambda x: x.isNotNull() & (x != DISCARD)))
    return F.when(F.size(kept) > 0, kept)


def map_list_text(text: Column, mapping: dict[str, str]) -> Column:
    return map_list(parse_list(text), mapping)


def map_scalar(c: Column, mapping: dict[str, str]) -> Column:
    """The value by its mapping, else itself; `discard` gives null."""
    out = F.coalesce(look_up(c, mapping), c)
    return F.when(out != DISCARD, out)


def map_scalar_join(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """The same with a vocabulary table (key, value) of any size."""
    v = vocabulary.select(F.lower(F.trim("key")).alias("__key"), F.col("value").alias("__value")).dropDuplicates(["__key"])
    out = F.coalesce("__value", F.col(column))
    return df.join(v, F.lower(F.trim(df[column])) == v["__key"], "left").withColumn(column, F.when(out != DISCARD, out)).drop("__key", "__value")


def map_list_join(df: DataFrame, key: str, column: str, vocabulary: DataFrame) -> DataFrame:
    """map_list with a vocabulary table: exploded, joined, and collected in order."""
    v = vocabulary.select(F.lower(F.trim("key")).alias("__key"), F.col("value").alias("__value")).dropDuplicates(["__key"])
    long = df.select(key, F.posexplode(column).alias("__pos", "__item")).join(v, F.lower(F.trim("__item")) == F.col("__key"), "left")
    long = long.withColumn("__out", F.coalesce("__value", "__item")).where(F.col("__out") != DISCARD)
    back = long.groupBy(key).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__out"))), lambda x: x["__out"])).alias("__list"))
    return df.drop(column).join(back.withColumnRenamed("__list", column), key, "left")


def route_culture(culture: Column, location: Column, mapping: dict[str, str], suffixes: dict[str, str]) -> tuple[Column, Column]:
    """(culture, location): an exact mapping wins; else brackets become commas; a suffix behind the first comma is kept (action culture), moved to an empty location (city) or dropped (default)."""
    hit = look_up(culture, mapping)
    plain = F.trim(F.regexp_replace(F.regexp_replace(culture, r"\s*\(\s*", ", "), r"\s*\)", ""))
    head, tail = F.trim(F.substring_index(plain, ",", 1)), F.trim(F.regexp_extract(plain, r"^[^,]*,\s*(.*)$", 1))
    action = F.coalesce(look_up(tail, suffixes), F.lit(DISCARD))
    has_tail = plain.contains(",")
    mapped_head = F.coalesce(look_up(head, mapping), head)
    again = F.coalesce(look_up(plain, mapping), plain)
    out = F.when(hit.isNotNull(), hit).when(~has_tail, again).when(action == "culture", plain).otherwise(mapped_head)
    moved = hit.isNull() & has_tail & (action == "city") & nullish(location)
    return F.when(out != DISCARD, out), F.when(moved, tail).otherwise(location)


def canonical_location(c: Column, countries: dict[str, str], demonyms: dict[str, str] | None = None) -> Column:
    """The country, the demonym's country, or the text itself without empty brackets."""
    bare = F.trim(F.regexp_replace(c, r"\(\s*\)", ""))
    return F.nullif(F.coalesce(look_up(bare, countries), look_up(bare, demonyms or DEMONYMS), bare), F.lit(""))


ARTIST_FIELDS = ("artist_name", "artist_role", "artist_nationality", "artist_date_begin", "artist_date_end")


def artist_key(name: Column, role: Column, nationality: Column, begin: Column, end: Column) -> Column:
    """The 5-part key of an artist; missing parts are empty, so all keys have four bars."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat_ws("|", F.lower(F.trim(part(name))), part(clean_role(role)), F.lower(F.trim(part(nationality))), clean_year(begin, empty=True), clean_year(end, empty=True))


def canonical_artists(df: DataFrame, entities: DataFrame) -> DataFrame:
    """df with its five artist columns replaced where entities (key, and the five) knows their key."""
    e = entities.select(F.lower("key").alias("__key"), *[F.col(c).alias(f"__{c}") for c in ARTIST_FIELDS]).dropDuplicates(["__key"])
    out = df.withColumn("__k", F.lower(artist_key(*[F.col(c) for c in ARTIST_FIELDS]))).join(e, F.col("__k") == F.col("__key"), "left")
    return out.withColumns({c: F.when(F.col("__key").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in ARTIST_FIELDS}).select(df.columns)


def load_mapping(paths: list[str], root: str | None = None) -> dict[str, str]:
    """The first of the files that exists, its nested root if it has one, keys in lower case; {} without any. Driver side: vocabularies are small files."""
    for p in map(Path, paths):
        if p.exists():
            data = json.loads(p.read_text(encoding="utf-8"))
            data = data.get(root, data) if root else data
            return {str(k).lower().strip(): v for k, v in data.items()}
    return {}


def vocabulary_table(spark: SparkSession, kind: str, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([(kind, k.lower(), v) for k, v in sorted(mapping.items())], "kind string, key string, value string")
