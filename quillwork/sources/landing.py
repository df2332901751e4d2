"""Landing tables of remote sources: objects are fetched once and read from the table ever after; pages come with why they ended."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import first_of_each
from .sinks import append_new

Fetch = Callable[[str], str | None]


def enumerated(listings: DataFrame, fetch: Fetch, field: str = "objectIDs", partitions: int = 16) -> DataFrame:
    """(listing, id) of listings (listing, url): the ids that each listing's JSON document holds in a field. One id in several listings has their names joined by |.

    A listing that isn't there (None) or holds no ids gives no rows; any other failure is the run's.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"listing": pdf["listing"], "content": [fetch(u) for u in pdf["url"]]})

    pages = listings.select("listing", "url").repartition(partitions).mapInPandas(run, "listing string, content string")
    ids = pages.select("listing", F.explode(F.from_json("content", f"`{field}` array<string>")[field]).alias("id")).where("id is not null")
    return ids.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("listing")), "|").alias("listing")).select("listing", "id")


def land(spark: SparkSession, wanted: DataFrame, path: str, fetch: Fetch, limit: int | None = None, partitions: int = 16) -> DataFrame:
    """(id, content) of the wanted ids (id), read through the table at path: what it lacks is fetched and appended first.

    Each id is fetched once, in as many tasks as partitions. None, an object that isn't there, is kept as a null content and not
    asked for again. Any other failure ends the run; as the append is one commit, nothing of it is left in the table. limit: the most ids
    fetched in this run, by their hash; ids beyond it are missing from the result until a later run.
    """
    missing = wanted.where("id is not null").select(F.col("id").cast("string").alias("id")).distinct()
    known = landed(spark, path)
    fresh = missing if known is None else missing.join(known.select("id"), "id", "left_anti")
    if limit is not None:
        fresh = first_of_each(fresh, [], F.md5("id"), "id", spark.createDataFrame([(limit,)], "n int"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"id": pdf["id"], "content": [fetch(i) for i in pdf["id"]]})

    append_new(fresh.repartition(partitions).mapInPandas(run, "id string, content string"), path, "id")
    return landed(spark, path).join(missing, "id", "left_semi")


def landed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path, or None where there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema("id string, content string").parquet(path) if exists else None


def harvest(spark: SparkSession, sets: DataFrame, path: str, fetch: Callable[[str, str], str | None], next_token: Callable[[str], str], count: Callable[[str], int], limit: int | None = None) -> DataFrame:
    """(set, pages, records, reason) of sets (set): every set's pages, one after the other along their tokens, appended to the table (set, page, token, content) at path.

    Sets are harvested side by side, one task each. reason is why a set ended: `limit` (so many records or more), `no records`, `no token`,
    `gone` (no page), or the error of a fetch: what came before it is kept, and a later run goes on from the page that failed. Sets that ended
    otherwise are not asked again. A set's pages of a run are written in one commit with its end.
    """
    import uuid

    done = landed_pages(spark, path)
    start = sets.where("set is not null").select("set").distinct()
    if done is not None:
        last = done.groupBy("set").agg(F.max("page").alias("page"), F.max_by(F.struct("next", "reason"), "page").alias("l"), F.sum("records").alias("had"))
        start = start.join(last, "set", "left").where(F.col("l").isNull() | F.col("l.reason").startswith("error"))
        start = start.select("set", F.coalesce(F.col("page") + 1, F.lit(0)).alias("page"), F.coalesce("l.next", F.lit("")).alias("token"), F.coalesce("had", F.lit(0)).alias("had"))
    else:
        start = start.select("set", F.lit(0).alias("page"), F.lit("").alias("token"), F.lit(0).cast("long").alias("had"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                token, page, had, reason = row.token, int(row.page), int(row.had), None
                while reason is None:
                    content, records, following = None, 0, token
                    try:
                        content = fetch(row.set, token)
                    except Exception as e:  # kept as the reason; the page is asked for again by a later run
                        reason = f"error: {type(e).__name__}: {e}"[:200]
                    else:
                        following = next_token(content) if content is not None else ""
                        records = count(content) if content is not None else 0
                        had += records
                        reason = "gone" if content is None else "no records" if not records else "limit" if limit is not None and had >= limit else None if following else "no token"
                    yield pd.DataFrame([(row.set, page, token, content, records, following, reason)], columns=["set", "page", "token", "content", "records", "next", "reason"])
                    token, page = following, page + 1

    pages = start.repartition("set").mapInPandas(run, PAGES)
    pages.withColumn("run", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(path)
    return landed_pages(spark, path).groupBy("set").agg(F.count("content").alias("pages"), F.sum("records").alias("records"), F.max_by("reason", "page").alias("reason"))


PAGES = "set string, page int, token string, content string, records long, next string, reason string"


def landed_pages(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(PAGES).parquet(path) if exists else None
