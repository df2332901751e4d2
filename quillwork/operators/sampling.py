"""Samples and quotas, deterministic by hash and stable under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordered import first_of_each


def hash_order(key: str, seed: int | str = 42) -> Column:
    """The order that stands for a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def hash_sample(df: DataFrame, key: str, n: int, seed: int | str = 42, cut=None) -> DataFrame:
    """n rows, in the order of the shuffle."""
    take = df.sparkSession.range(1).select(F.lit(n).alias("n"))
    return first_of_each(df, [], hash_order(key, seed), key, take, cut=cut).orderBy(hash_order(key, seed), key)


def group_sample(df: DataFrame, group: str, key: str, keep: Column, scan: int, n: int, seed: int = 42, cut=None) -> DataFrame:
    """Of each group the first `scan` rows of a shuffle, and of those that meet `keep` the first n. Only what was scanned is ranked."""
    take = df.select(group).distinct().withColumn("n", F.lit(scan))
    seen = first_of_each(df, [group], hash_order(key, seed), key, take, cut=cut).where(keep)
    w = Window.partitionBy(group).orderBy(hash_order(key, seed), key)
    return seen.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def stratified_sample(df: DataFrame, strata: list[str], key: str, n: int, seed: int = 42, cut=None) -> DataFrame:
    """About n rows: of each stratum its share of n, at least one."""
    counts = df.groupBy(*strata).agg(F.count("*").alias("stratum"))
    total = df.agg(F.count("*").alias("total"))
    take = counts.join(F.broadcast(total)).select(*strata, F.greatest(F.lit(1), F.floor(F.col("stratum") * n / F.col("total"))).alias("n"))
    return first_of_each(df, strata, hash_order(key, seed), key, take, cut=cut)


def balanced_sample(df: DataFrame, label: Column, key: str, limit: int, seed: int = 42, cut=None) -> DataFrame:
    """min(dirty, limit / 2) rows with the label, filled up with rows without it."""
    marked = df.withColumn("__dirty", F.coalesce(label, F.lit(False)))
    dirty = marked.agg(F.least(F.count_if("__dirty"), F.lit(limit // 2)).alias("take"))
    take = dirty.select(F.explode(F.array(F.struct(F.lit(True).alias("__dirty"), F.col("take").alias("n")), F.struct(F.lit(False).alias("__dirty"), (F.lit(limit) - F.col("take")).alias("n")))).alias("s")).select("s.*")
    return first_of_each(marked, ["__dirty"], hash_order(key, seed), key, take, cut=cut).drop("__dirty")


def sizes(total: int, train: float = 0.6, error_rate: float = 50.0) -> dict[str, int]:
    """Rows for training and test, and errors in test."""
    n_train = int(total * train)
    n_test = total - n_train
    return {"train": n_train, "test": n_test, "errors": int(n_test * error_rate / 100)}


def quotas(weights: dict[str, float], errors: int) -> dict[str, int]:
    """Errors by subtype: rounded shares, the difference repaired one by one from the largest on."""
    total = sum(weights.values())
    out = {k: int(round(w / total * errors)) for k, w in weights.items()}
    order = sorted(out, key=lambda k: (-out[k], list(weights).index(k)))
    difference, i = errors - sum(out.values()), 0
    while difference and order:
        step = 1 if difference > 0 else -1
        k = order[i % len(order)]
        if out[k] + step >= 0:
            out[k] += step
            difference -= step
        i += 1
    return out


def assignment_order(quota: dict[str, int], first: tuple[str, ...] = ("culture_adjacent", "culture_continent", "country_neighbor", "city_neighbor")) -> list[str]:
    """Geography and culture first, then ascending quotas."""
    return [k for k in first if k in quota] + sorted((k for k in quota if k not in first), key=lambda k: (quota[k], k))


def assign(eligible: DataFrame, pairs: DataFrame, quota: dict[str, int], cut, seed: int = 42, filler: str = "scale_error") -> DataFrame:
    """(id, partner, subtype): each id once, swap subtypes in pairs, mutation subtypes from eligible ids; shortfalls go to the filler.

    eligible: (id, subtype); pairs: (subtype, id_a, id_b). cut writes a step's result and returns it read
    again. One step a subtype; all work is joins and order by hash.
    """
    from .pairs import disjoint_matching

    swaps = {r["subtype"] for r in pairs.select("subtype").distinct().collect()}
    used: DataFrame | None = None
    done: list[DataFrame] = []
    missing = 0
    for subtype in [*[s for s in assignment_order(quota) if s != filler], filler]:
        want = quota.get(subtype, 0) + (missing if subtype == filler else 0)
        if not want:
            continue
        if subtype in swaps:
            some = pairs.where(F.col("subtype") == subtype).select("id_a", "id_b")
            if used is not None:
                some = some.join(used.withColumnRenamed("id", "id_a"), "id_a", "left_anti").join(used.withColumnRenamed("id", "id_b"), "id_b", "left_anti")
            h = F.conv(F.substring(F.md5(F.concat_ws("|", "id_a", "id_b", F.lit(f"{seed}|{subtype}"))), 1, 13), 16, 10).cast("long")
            matched = disjoint_matching(some.withColumn("score", h), cut).orderBy(F.desc("score"), "id_a").limit(want // 2)
            rows = matched.select(F.explode(F.array(F.struct(F.col("id_a").alias("id"), F.col("id_b").alias("partner")), F.struct(F.col("id_b").alias("id"), F.col("id_a").alias("partner")))).alias("p")).select("p.id", "p.partner")
        else:
            some = eligible.where(F.col("subtype") == subtype).select("id").distinct()
            some = some.join(used, "id", "left_anti") if used is not None else some
            rows = hash_sample(some, "id", want, f"{seed}|{subtype}").select("id", F.lit(None).cast(some.schema["id"].dataType).alias("partner"))
        rows = cut(rows.withColumn("subtype", F.lit(subtype)))
        missing += max(0, quota.get(subtype, 0) - rows.count()) if subtype != filler else 0
        done.append(rows)
        ids = rows.select("id")
        used = ids if used is None else cut(used.unionByName(ids)) if len(done) % 4 == 0 else used.unionByName(ids)
    from functools import reduce

    return reduce(DataFrame.unionByName, done)


def split_clean(df: DataFrame, key: str, test_clean: int, train: int, seed: int = 42, cut=None) -> DataFrame:
    """The rows with a split column: the first in hash order to test, the next to train, the rest to neither (null). Keys are unique."""
    keys = df.select(key)
    marked = [hash_sample(keys, key, n, seed, cut).select(F.col(key).alias("__k"), F.lit(1).alias("n")) for n in (test_clean, test_clean + train)]
    times = marked[0].unionByName(marked[1]).groupBy("__k").agg(F.sum("n").alias("__n"))
    out = df.join(times, F.col(key) == F.col("__k"), "left")
    return out.withColumn("split", F.when(F.col("__n") == 2, "test").when(F.col("__n") == 1, "train")).drop("__k", "__n")


def sample_per_file(df: DataFrame, file: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """A sample of n rows in proportion to the files, at least one of each."""
    return stratified_sample(df, [file], key, n, seed)


def distinct_images(df: DataFrame, key: str, url: str, excluded_hosts: tuple[str, ...] = ()) -> DataFrame:
    """One row an id, with a url that isn't of an excluded host."""
    kept = df.where(F.col(url).isNotNull())
    for host in excluded_hosts:
        kept = kept.where(~F.col(url).contains(host))
    return kept.groupBy(key).agg(F.min(url).alias(url))
