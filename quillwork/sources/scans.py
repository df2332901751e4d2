"""Scans: text, JSON, XML, CSV and image directories with explicit schemas; files and rows picked by manifest or id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import HARVESTED_COLUMNS


def json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a file. A file that can't be read is a row with load_error set, never a failure."""
    full = f"{schema}, _corrupt string"
    df = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.withColumn("file", F.col("_metadata.file_name")).withColumn("load_error", F.col("_corrupt").isNotNull()).drop("_corrupt")


def unwrap_envelope(df: DataFrame, fields: list[str], envelope: str = "data") -> DataFrame:
    """The envelope's fields where there is one, else the root's."""
    rest = [c for c in df.columns if c not in fields and c != envelope]
    return df.select(*rest, *[F.coalesce(F.col(f"{envelope}.{f}"), F.col(f)).alias(f) for f in fields])


def csv_strings(spark: SparkSession, paths: str | list[str], columns: list[str] | tuple[str, ...] = tuple(HARVESTED_COLUMNS)) -> DataFrame:
    """CSV with all columns as text, quotes doubled, line breaks allowed in quotes. Names beginning with _ are hidden from Spark."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return csv(spark, paths, schema)


def csv(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    """The same with any schema; never inferred, so that 1890 stays 1890. Columns are found by header."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("enforceSchema", False).option("ignoreCorruptFiles", True).csv(paths)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All frames below each other, by name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, prefix, size) of the CSV files of a directory: prefix is the name before _sample_; hidden and overview files are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    kept = files.where(~F.col("name").startswith("_") & ~F.col("name").startswith("overview"))
    return kept.withColumn("prefix", F.regexp_replace(F.substring_index("name", "_sample_", 1), r"\.csv$", ""))


def largest_per_prefix(files: DataFrame) -> DataFrame:
    """(file, prefix, size): of each prefix the largest file, ties to the first name."""
    key = "file" if "file" in files.columns else "path"
    best = files.groupBy("prefix").agg(F.min(F.struct((-F.col("size")).alias("s"), F.col(key).alias("f"))).alias("b"))
    return best.select(F.col("b.f").alias(key), "prefix", (-F.col("b.s")).alias("size"))


def load_all(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The largest file of each prefix, together; a location column also serves as country. The list of files is small and read on the driver."""
    chosen = [r["path"] for r in largest_per_prefix(manifest(spark, path)).collect()]
    df = csv_strings(spark, sorted(chosen), columns)
    return df.withColumn("country", F.coalesce("country", "location")) if {"country", "location"} <= set(df.columns) else df


def fetch(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is wanted."""
    return df.join(wanted.select(key), key, "left_semi")


def embeddings(spark: SparkSession, *paths: str, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(id, embedding) from tables or chunk directories; of repeated ids the first path's row stays."""
    frames = [spark.read.parquet(p).select(F.col(key).cast("string").alias("id"), F.col(vector).alias("embedding"), F.lit(k).alias("__rank")) for k, p in enumerate(paths)]
    return union_all(frames).groupBy("id").agg(F.min_by("embedding", "__rank").alias("embedding"))


def npy_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(id, embedding) from .npz archives with arrays ids and embeddings: read as binary, parsed in the workers."""
    import io
    from collections.abc import Iterator

    import numpy as np
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    yield pd.DataFrame({"id": z["ids"].astype(str), "embedding": list(z["embeddings"].astype(np.float32))})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("content").mapInPandas(run, "id string, embedding array<float>")


def image_index(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(id, path): of each image file's stem the one in the first folder that has it. Contents are not read."""
    frames = [spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(f).select("path", F.lit(k).alias("rank")) for k, f in enumerate(folders)]
    stem = F.regexp_extract("path", r"([^/]+)\.jpg$", 1)
    return union_all(frames).withColumn("id", stem).groupBy("id").agg(F.min_by("path", "rank").alias("path"))


def mapping_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(kind, key, value) of a JSON file with one object of texts."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return raw.select(F.lit(kind).alias("kind"), F.explode("m").alias("key", "value")).withColumn("key", F.lower("key"))


def place_edges(spark: SparkSession, path: str) -> DataFrame:
    """(kind, src, dst) of a place file: city_to_country, country_to_cities, country_neighbors, city_neighbors."""
    raw = spark.read.text(path, wholetext=True).select("value")
    one = raw.select(F.from_json("value", "city_to_country map<string,string>").alias("j")).select(F.lit("city_country").alias("kind"), F.explode("j.city_to_country").alias("src", "dst"))
    frames = [one]
    for field, kind in (("country_to_cities", "country_city"), ("country_neighbors", "country_neighbor"), ("city_neighbors", "city_neighbor")):
        many = raw.select(F.from_json("value", f"{field} map<string,array<string>>").alias("j")).select(F.explode(f"j.{field}").alias("src", "many"))
        frames.append(many.select(F.lit(kind).alias("kind"), "src", F.explode("many").alias("dst")))
    return union_all(frames)


def search(df: DataFrame, keep: Column, n: int, key: str = "id") -> DataFrame:
    """n distinct rows that meet the filters, in order of their id (a top-k report)."""
    return df.where(keep).dropDuplicates([key]).orderBy(key).limit(n)
