"""Neighbours in a global order, the first rows of each stratum, and greedy matching: against plain loops."""

from __future__ import annotations

import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from quillwork.operators import ordered, pairs, sampling
from quillwork.sources import sinks


def by_hash(x, seed=42) -> str:
    return md5(f"{x}|{seed}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_next_rows_are_those_of_one_sort(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]), i) for i in range(n)]
    df = spark.createDataFrame(rows, "a int, b string, key int").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2]))
    got = ordered.next_rows(df, ["a", "b", "key"], ["key", "b"])
    assert {r.key: (r.next_key, r.next_b) for r in got.collect()} == {x[2]: (y[2], y[1]) if y else (None, None) for x, y in zip(order, [*order[1:], None], strict=False)}


def test_hot_key_is_cut_into_ranges(spark):
    """Nearly all rows have one object; no range holds a third of them, and no pair is lost at a border."""
    n = 4_000
    df = spark.range(n).select("id", F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(-1).alias("object"), F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("year"), (F.col("id") % 9).alias("artist"))
    parts = []
    cut = sinks.cutter(spark)

    def watched(out):
        out = cut(out)
        parts.extend(r["count"] for r in out.groupBy("__part").count().collect())
        return out

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pairs.adjacent_pairs(df, ["object"], ["year"], "id", F.col("artist") != F.col("next_artist"), ["artist"], cut=watched)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted((r.object, r.year, r.id, r.artist) for r in df.collect())
    want = {(x[2], y[2]) for x, y in zip(rows, rows[1:], strict=False) if x[0] == y[0] and x[3] != y[3]}
    assert {(r.id_a, r.id_b) for r in got.collect()} == want and len(want) > 3_000
    assert len(parts) == 4 and max(parts) < n / 3


@pytest.mark.parametrize("digits", [1, 3])
def test_first_of_each_is_a_window(spark, digits):
    rng = random.Random(digits)
    rows = [(i, rng.choice([None, "a", "b", "c", "d"])) for i in range(900)]
    quota = {None: 40, "a": 1, "b": 0, "c": 10_000}
    df = spark.createDataFrame(rows, "id int, s string").repartition(5)
    take = spark.createDataFrame(list(quota.items()), "s string, n int")
    got = ordered.first_of_each(df, ["s"], sampling.hash_order("id"), "id", take, digits=digits)
    want = {i for s, n in quota.items() for i in sorted((i for i, x in rows if x == s), key=by_hash)[:n]}
    assert got.columns == ["id", "s"] and sorted(r.id for r in got.collect()) == sorted(want)


def test_first_rows_with_equal_hashes_and_repeats(spark):
    df = spark.createDataFrame([(i % 20,) for i in range(100)], "id int")
    got = ordered.first_of_each(df, [], F.md5(F.lit("one")), "id", spark.createDataFrame([(33,)], "n int"))
    assert sorted(r.id for r in got.collect()) == sorted(i % 20 for i in range(100))[:33]
    assert ordered.first_of_each(df.limit(0), [], F.md5(F.lit("one")), "id", spark.createDataFrame([(3,)], "n int")).count() == 0


def test_large_selection_of_one_stratum(spark):
    df = spark.range(200_000).withColumn("s", F.lit("all"))
    got = ordered.first_of_each(df, ["s"], sampling.hash_order("id"), "id", df.select("s").distinct().withColumn("n", F.lit(70_000)))
    rows = got.select("id").collect()
    assert len(rows) == 70_000 and {r.id for r in rows} == set(sorted(range(200_000), key=by_hash)[:70_000])


def greedy(edges):
    used, out = set(), []
    for s, a, b in sorted((-s, min(a, b), max(a, b)) for a, b, s in edges if a != b):
        if a not in used and b not in used:
            used |= {a, b}
            out.append((a, b, -s))
    return sorted(out)


def rounds_of(spark, edges):
    """The matching, and how many tables were written for it."""
    written = []
    cut = sinks.cutter(spark)
    got = pairs.disjoint_matching(spark.createDataFrame(edges, "id_a long, id_b long, score double"), lambda df: written.append(1) or cut(df))
    return sorted(map(tuple, got.collect())), len(written)


@pytest.mark.parametrize("rising", [True, False])
def test_long_chain_is_matched_in_few_rounds(spark, rising):
    path = [(i, i + 1, float(i) if rising else 1.0) for i in range(2_000)]
    got, written = rounds_of(spark, path)
    assert got == greedy(path) and written < 30


def test_matching_is_greedy(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60), float(rng.randrange(9))) for _ in range(400)]
    assert rounds_of(spark, edges)[0] == greedy(edges)
