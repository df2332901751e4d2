"""Model calls as a stream: one schedule of calls for all tasks, successes kept once, sub-batches that are written whole or not at all."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: What a provider gives for a prompt: the answer, and the tokens that it took.
Provider = Callable[[str], tuple[str, int]]


def scheduled_calls(requests: DataFrame, provider: Provider, per_minute: float = 1000.0, tasks: int = 4, attempts: int = 3, pause: float = 0.5, stamp: bool = False) -> DataFrame:
    """key, answer, ok, tokens, error for requests (key, prompt); with stamp also called, when the first try began.

    All tasks keep one schedule without talking to each other: rows are dealt out evenly, the j-th row of task p has slot
    j * tasks + p, and slot s may not begin before the run's start plus s / rate. So the rate holds for all tasks together,
    however many run at once, and a failing call that is tried again doesn't shift the others. A call that fails on all tries is a
    row with its error, not a failure of the run.
    """
    began, gap = time.time(), 60.0 / per_minute
    columns = f"key {requests.schema['key'].dataType.simpleString()}, answer string, ok boolean, tokens long, error string, called double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot = TaskContext.get().partitionId()
        for pdf in frames:
            out = []
            for key, prompt in zip(pdf["key"], pdf["prompt"], strict=True):
                time.sleep(max(0.0, began + slot * gap - time.time()))
                slot += tasks
                called, failure = time.time(), None
                for k in range(attempts):
                    try:
                        answer, tokens = provider(prompt)
                        out.append((key, answer, True, int(tokens), None, called))
                        break
                    except Exception as e:  # the provider's business; kept as a row
                        failure = f"{type(e).__name__}: {e}"[:200]
                        if k + 1 < attempts:
                            time.sleep(pause * 2**k)
                else:
                    out.append((key, None, False, 0, failure, called))
            yield pd.DataFrame(out, columns=["key", "answer", "ok", "tokens", "error", "called"])

    out = requests.select("key", "prompt").repartition(tasks).mapInPandas(run, columns)
    return out if stamp else out.drop("called")


def answered(spark, path: str) -> DataFrame | None:
    """The table of answers at path, or None before the first batch."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if system.exists(folder) and system.listStatus(folder) else None


def answer_batch(batch: DataFrame, number: int, path: str, provider: Provider, **schedule) -> None:
    """One sub-batch: keys that have no success yet are asked once each, the results replace partition `batch=number` in one commit.

    Run again with the same number, it doesn't see its own earlier results, so a batch that broke off leaves nothing
    half done and none of its rows twice. Failures are kept with their error and asked again when they come again.
    """
    spark = batch.sparkSession
    asked = batch.where("key is not null").groupBy("key").agg(F.min("prompt").alias("prompt"))
    known = answered(spark, path)
    if known is not None:
        asked = asked.join(known.where(F.col("ok") & (F.col("batch") != number)).select("key"), "key", "left_anti")
    done = scheduled_calls(asked, provider, **schedule).withColumn("batch", F.lit(int(number)))
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def answer_stream(requests: DataFrame, path: str, checkpoint: str, provider: Provider, **schedule) -> StreamingQuery:
    """Answers to a stream of requests (key, prompt), appended to the table at path batch by batch until what is there has been read.

    The source's own options bound a sub-batch (as maxFilesPerTrigger). After a restart the stream goes on behind the last
    batch that was written whole.
    """
    return requests.writeStream.foreachBatch(lambda batch, n: answer_batch(batch, n, path, provider, **schedule)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def successes(spark, path: str) -> DataFrame:
    """key, answer, tokens: each key's success of its first batch."""
    known = answered(spark, path)
    if known is None:
        raise FileNotFoundError(path)
    return known.where("ok").groupBy("key").agg(F.min_by(F.struct("answer", "tokens"), "batch").alias("a")).select("key", "a.*")


def totals(spark, path: str) -> DataFrame:
    """batch, asked, succeeded, tokens."""
    known = answered(spark, path)
    if known is None:
        raise FileNotFoundError(path)
    return known.groupBy("batch").agg(F.count("*").alias("asked"), F.count_if("ok").alias("succeeded"), F.sum("tokens").alias("tokens"))
