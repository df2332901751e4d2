"""Model calls: a pluggable provider run over rows in bounded batches, with a table as cache.

The default provider is offline and deterministic. A real one is any callable from prompts to answers; how
many run at once is the number of partitions, its rate is shared among them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Provider = Callable[[list[str]], list[str]]


def offline(prompts: list[str]) -> list[str]:
    """An empty answer to every prompt."""
    return ["{}"] * len(prompts)


def call(provider: Provider, prompts: list[str], attempts: int = 3, pause: float = 0.0) -> list[str]:
    """Answers to prompts. A failing batch is tried again, then item by item; what fails still gives '{}'."""
    for k in range(attempts):
        try:
            out = provider(prompts)
            if len(out) == len(prompts):
                return out
        except Exception:
            time.sleep(pause * 2**k)
    if len(prompts) == 1:
        return ["{}"]
    return [call(provider, [p], 1, pause)[0] for p in prompts]


class RateLimit:
    """At most n calls in each window of so many seconds."""

    def __init__(self, n: int, window: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.n, self.window, self.clock, self.sleep = n, window, clock, sleep
        self.began, self.used = clock(), 0

    def wait(self) -> None:
        now = self.clock()
        if now - self.began >= self.window:
            self.began, self.used = now, 0
        if self.used >= self.n:
            self.sleep(max(0.0, self.window - (now - self.began)))
            self.began, self.used = self.clock(), 0
        self.used += 1


def answers(requests: DataFrame, provider: Provider = offline, cache: DataFrame | None = None, partitions: int = 4, chunk: int = 20, per_minute: int = 1000) -> DataFrame:
    """(key, answer, fresh) of requests (key, prompt). Keys are asked once; a cache (key, answer) is read first, only its misses are asked.

    What is fresh and no '{}' belongs into the cache: append it with sinks.append_new.
    """
    asked = requests.groupBy("key").agg(F.min("prompt").alias("prompt"))
    known = None
    if cache is not None:
        known = asked.join(cache.select("key", "answer"), "key").select("key", "answer", F.lit(False).alias("fresh"))
        asked = asked.join(cache.select("key"), "key", "left_anti")
    limit = max(1, per_minute // partitions)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gate = RateLimit(limit)
        for pdf in frames:
            out: list[str] = []
            for lo in range(0, len(pdf), chunk):
                gate.wait()
                out += call(provider, pdf["prompt"].iloc[lo : lo + chunk].tolist())
            yield pd.DataFrame({"key": pdf["key"], "answer": out, "fresh": True})

    fresh = asked.repartition(partitions).mapInPandas(run, f"key {requests.schema['key'].dataType.simpleString()}, answer string, fresh boolean")
    return fresh if known is None else known.unionByName(fresh)


def flags(answered: DataFrame, claim_true: str = "supported") -> DataFrame:
    """(key, flag): whether the model denied the claim; an unreadable answer flags nothing."""
    verdict = F.try_variant_get(F.try_parse_json("answer"), f"$.{claim_true}", "boolean")
    return answered.select("key", F.coalesce(~verdict, F.lit(False)).alias("flag"))
