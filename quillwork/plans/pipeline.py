"""The stages of record curation as one chain of transforms, and a command line to run it."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import combine_medium, dedupe_artist, fold_case, source_prefix
from ..operators import artist, consolidate, dates, dimensions, medium, profile, vocab
from ..schema import HARVESTED_COLUMNS, conform


def normalize(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """Dates and dimensions in canonical grammar beside the raw texts, ids with their source's prefix, texts in lower case."""
    out = conform(df).withColumn("raw_date", F.col("date")).withColumn("raw_dimensions", F.col("dimensions"))
    out = out.withColumn("date", dates.normalize_date(F.col("date"))).withColumn("dimensions", dimensions.format_dimensions(dimensions.parse_dimensions(F.col("dimensions"))["dims"]))
    out = out.withColumn("object_ID", source_prefix(F.col("object_ID"), prefix)) if prefix else out
    return out.select(fold_case(out.columns))


def parse(df: DataFrame, lists: bool = False, dictionary: dict | None = None) -> DataFrame:
    """Structs for date, dimensions, medium and artist; anomalous dates go. lists: media come as lists already split."""
    date = dates.sweep(dates.parse_with_fallback(F.col("raw_date"), F.col("date")))
    dims = F.coalesce(dimensions.reparse_dimensions(F.col("dimensions")), dimensions.reparse_dimensions(F.lower("raw_dimensions")))
    media = medium.route_terms(F.col("material"), F.col("technique"), dictionary) if lists else medium.extract_medium(combine_medium(F.col("medium"), F.col("material"), F.col("technique")), dictionary)
    return df.withColumn("parsed_date", date).withColumn("parsed_dimensions", dims).withColumn("parsed_medium", media).withColumn("parsed_artist", artist.parse_artist(F.coalesce("artist_display_bio", "artist_information"))).withColumn("artist_name", F.coalesce("artist_name", dedupe_artist(F.col("artist_titles"))))


def unify(df: DataFrame, maps: dict[str, dict[str, str]] | None = None, suffixes: dict[str, str] | None = None, entities: DataFrame | None = None) -> DataFrame:
    """Canonical vocabulary in lists, names, cultures and places; artists by entity table."""
    maps = maps or {}
    culture, place = vocab.route_culture(F.col("culture"), F.col("location"), maps.get("culture", {}), suffixes or {})
    out = df.withColumn("materials", vocab.map_list(F.col("materials"), maps.get("material", {}))).withColumn("techniques", vocab.map_list(F.col("techniques"), maps.get("technique", {}))).withColumn("object_name", vocab.map_scalar(F.col("object_name"), maps.get("object_name", {})))
    out = out.withColumns({"culture": culture, "location": place}).withColumn("location", vocab.canonical_location(F.col("location"), maps.get("country", {})))
    return vocab.canonical_artists(out, entities) if entities is not None else out


def curate(df: DataFrame, prefix: str | None = None, lists: bool = False, **vocabularies) -> DataFrame:
    """Harvested records to unified canonical ones: one lazy plan, no exchange but for vocabulary tables."""
    return unify(consolidate.consolidate(parse(normalize(df, prefix), lists)), **vocabularies)


def parse_summary(parsed: DataFrame, by: str = "source") -> DataFrame:
    """Attempted and parsed values by source and in all."""
    raw = lambda c: F.col(c).isNotNull()
    return profile.success_rollup(parsed, by, {"date": (raw("raw_date"), raw("parsed_date")), "dimensions": (raw("raw_dimensions"), raw("parsed_dimensions")), "medium": (raw("medium"), raw("parsed_medium"))})


def main(args: list[str] | None = None) -> None:
    """Run the curation over CSV directories."""
    from ..session import session
    from ..sources import scans, sinks

    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--prefix", help="put before ids")
    p.add_argument("--lists", action="store_true", help="media come as lists")
    a = p.parse_args(args)
    spark = session()
    sinks.write_stage(curate(scans.csv_strings(spark, a.input, HARVESTED_COLUMNS), a.prefix, a.lists), a.output)


if __name__ == "__main__":
    main()
