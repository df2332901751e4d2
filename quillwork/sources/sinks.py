"""Sinks: partitioned tables, exports, new versions in place of overwriting, append-only caches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where it is unset on one machine, as in tests. On a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillwork-"))
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def cutter(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a DataFrame to the shared folder and reads it again: cuts lineage, survives lost executors."""
    root = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    count = iter(range(1 << 30))

    def cut(df: DataFrame) -> DataFrame:
        path = f"{root}/{next(count)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return cut


def write_stage(df: DataFrame, path: str, by: str | None = "source") -> None:
    """A stage's table, partitioned by source where it has one."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by and by in df.columns else writer).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV directory with header; nested values as JSON text, empty ones as null."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("struct", "array", "map")]
    flat = df.withColumns({c: F.when(~F.to_json(c).isin("{}", "[]"), F.to_json(c)) for c in nested})
    flat.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def export_json(df: DataFrame, path: str, column: str = "json") -> None:
    """A text table of JSON, one object a line."""
    df.select(column).write.mode("overwrite").text(path)


def updated(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """old with the columns taken from new where new has a value: to be written as a new version, never over its own input."""
    n = new.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns]).dropDuplicates(["__k"])
    out = old.join(n, F.col(key) == F.col("__k"), "left").withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns})
    return out.select(old.columns)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table at path doesn't have."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        df = df.join(spark.read.parquet(path).select(key), key, "left_anti")
    df.write.mode("append").parquet(path)


def compact(spark: SparkSession, path: str, to: str, files: int = 1) -> None:
    """A table of many small files written again with few."""
    spark.read.parquet(path).coalesce(files).write.mode("overwrite").parquet(to)


def write_benchmark(train: DataFrame, test: DataFrame, path: str) -> None:
    """Both splits as one table partitioned by split."""
    train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True).write.mode("overwrite").partitionBy("split").parquet(path)


def write_index(eligibility: DataFrame, pairs: DataFrame, path: str) -> None:
    """The eligibility index and the swap pairs as two tables."""
    eligibility.write.mode("overwrite").parquet(f"{path}/eligibility")
    pairs.write.mode("overwrite").partitionBy("subtype").parquet(f"{path}/pairs")


def write_groups(df: DataFrame, group: str, path: str, slug) -> DataFrame:
    """One directory a group under its slug; returns the overview (group, slug, n)."""
    keyed = df.withColumn("slug", slug(F.col(group)))
    keyed.write.mode("overwrite").partitionBy("slug").parquet(path)
    return keyed.groupBy(group, "slug").agg(F.count("*").alias("n"))


def download(rows: DataFrame, key: str, url: str, fetch: Callable[[str], bytes | None], done: DataFrame | None = None, partitions: int = 16) -> DataFrame:
    """(key, content, error) of files not done yet, as many at once as partitions; failures are rows, not errors."""
    import pandas as pd

    rest = rows if done is None else rows.join(done.select(key), key, "left_anti")

    def run(frames):
        for pdf in frames:
            contents, errors = [], []
            for u in pdf[url]:
                try:
                    contents.append(fetch(u))
                    errors.append(None)
                except Exception as e:
                    contents.append(None)
                    errors.append(str(e)[:200])
            yield pd.DataFrame({key: pdf[key], "content": contents, "error": errors})

    kind = rows.schema[key].dataType.simpleString()
    return rest.select(key, url).repartition(partitions).mapInPandas(run, f"{key} {kind}, content binary, error string")
