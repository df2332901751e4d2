"""Vectors: normalisation, similarity, top-k neighbours, bands, alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def normalize(v: Column) -> Column:
    """The unit vector; null for zero vectors."""
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, y: acc + y.cast("double") * y.cast("double")))))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def encode(df: DataFrame, key: str, content: str, encoder: Callable[[list], np.ndarray], done: DataFrame | None = None, batch: int = 256) -> DataFrame:
    """(key, embedding) of rows not done yet: encoded in batches and L2-normalised. encoder maps a list of contents to a matrix."""
    rest = df.select(key, content) if done is None else df.select(key, content).join(done.select(key), key, "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for lo in range(0, len(pdf), batch):
                part = pdf.iloc[lo : lo + batch]
                m = np.asarray(encoder(part[content].tolist()), dtype=np.float32)
                m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(m)})

    return rest.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, embedding array<float>")


#: Rows of a block of vectors, vectors from which centres are fitted (about), rows a cluster on the average, and most clusters.
BLOCK, SAMPLE, A_CLUSTER, MOST_CLUSTERS = 4_096, 20_000, 2_048, 256
#: Tables of more blocks get larger blocks and clusters, up to so many times as large: each row is sent once to every block that it meets.
BLOCKS, LARGER = 12, 8
#: Angles are trusted to this much.
SLACK = 1e-6


def _units(v: pd.Series) -> np.ndarray:
    m = np.stack(v.to_numpy()).astype(np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def centres_of(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of unit vectors by spherical k-means, at most `count`."""
    rng = np.random.default_rng(42)
    centres = sample[rng.permutation(len(sample))[:count]]
    for _ in range(rounds):
        near = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-300), centres)
    return centres


def _assigned(df: DataFrame, centres: np.ndarray) -> DataFrame:
    """id, v, cluster, angle to the cluster's centre. A zero vector belongs to a cluster of its own kind, at any angle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for lo in range(0, len(pdf), BLOCK):
                part = pdf.iloc[lo : lo + BLOCK]
                cosines = np.clip(_units(part.v) @ centres.T, -1, 1)
                near = np.argmax(cosines, axis=1)
                zero = np.array([not np.any(x) for x in part.v])
                yield part.assign(cluster=np.where(zero, len(centres), near).astype(np.int32), angle=np.where(zero, np.pi, np.arccos(cosines[np.arange(len(part)), near])))

    return df.mapInPandas(run, df.select("id", "v", F.lit(0).alias("cluster"), F.lit(0.0).alias("angle")).schema)


def _best(ids: np.ndarray, x: np.ndarray, names: np.ndarray, y: np.ndarray, k: int, low: np.ndarray, high: float) -> pd.DataFrame:
    """The k best names for each id from its own low to high, equal scores by name; names ascend."""
    qs, ns, scores = [ids[:0]], [names[:0]], [np.zeros(0)]
    step = max(1, 512 * BLOCK // max(len(y), BLOCK))
    for lo in range(0, len(x), step):
        s = np.round(x[lo : lo + step] @ y.T, 12)
        s[(ids[lo : lo + step, None] == names[None, :]) | (s < low[lo : lo + step, None]) | (s > high)] = -9
        fits = s > -9
        if len(y) > k and fits.sum() > k * len(s):
            fits &= s >= np.partition(s, len(y) - k, axis=1)[:, len(y) - k, None]
        rows, cols = np.nonzero(fits)
        own = s[rows, cols]
        order = np.lexsort((-own, rows))
        rows, cols, own = rows[order], cols[order], own[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        qs.append(ids[lo + rows[first]])
        ns.append(names[cols[first]])
        scores.append(own[first])
    return pd.DataFrame({"query": np.concatenate(qs), "neighbour": np.concatenate(ns), "score": np.concatenate(scores)})


def top_k(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, low: float = -2.0, high: float = 2.0, cut=None, block: int | None = None, report: dict | None = None) -> DataFrame:
    """(query, neighbour, score, rank): each query's k best other vectors in a band of cosine. Exact; ties go to the smaller key.

    Vectors and queries fall into clusters around centres fitted on a sample, and clusters into blocks of about `block` rows (by default by
    the table's size: what is sent grows with the rows times the blocks), so
    tasks grow in number with the tables, and a cluster that a third of all vectors fall into is spread. A pair of blocks is one
    matrix product that returns at most k rows a query. First each query meets the blocks of its own cluster; its k-th
    score there is a floor. By the triangle inequality of angles, no vector of another cluster is nearer than the angle
    between the centres less both radii: pairs of clusters that can't reach the floor (or the band) are never
    formed, in those that are, queries that can't are left out one by one, and only scores that reach the floor come back. report gets the counts of block pairs
    compared and skipped.

    Null vectors are no rows; a zero vector scores 0 with all and is never skipped. Assigned rows are written to the shared folder (cut).
    """
    from pyspark.sql.window import Window

    from ..sources.sinks import cutter

    spark = vectors.sparkSession
    cut = cut or cutter(spark)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"query {kind}, neighbour {kind}, score double"
    plain = lambda df: df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    n = plain(vectors).count()
    if not n:
        return spark.createDataFrame([], schema + ", rank int")
    block = block or int(min(max(BLOCK, n // BLOCKS), LARGER * BLOCK))
    a_cluster = max(A_CLUSTER, block // 2)
    some = plain(vectors).where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / n) * (1 << 20)))
    sample = some.orderBy("id").select("v").toPandas().v if n > A_CLUSTER else None
    if sample is None or not len(sample):
        sample = plain(vectors).orderBy("id").limit(1).toPandas().v
    centres = centres_of(_units(sample), max(1, min(MOST_CLUSTERS, n // a_cluster)))
    sides = {}
    for side, df in (("q", queries), ("v", vectors)):
        rows = cut(_assigned(plain(df), centres))
        stats = {r.cluster: (r.n, r.radius) for r in rows.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
        blocks = F.create_map(*[F.lit(x) for c, (m, _) in sorted(stats.items()) for x in (c, -(-m // block))]) if stats else F.create_map()
        sides[side] = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.try_element_at(blocks.cast("map<int,int>"), F.col("cluster"))).cast("int")), stats
    (q, q_stats), (v, v_stats) = sides["q"], sides["v"]
    size = lambda stats, c: -(-stats[c][0] // block)

    def met(pairs: list[tuple[int, int]], q: DataFrame) -> DataFrame:
        """Results of all blocks of the pairs of clusters (of queries, of vectors)."""
        table = F.broadcast(spark.createDataFrame([(a, b, size(q_stats, a), size(v_stats, b)) for a, b in pairs], "qc int, vc int, qn int, vn int"))
        counted = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = q.join(table, F.col("cluster") == F.col("qc")).select("qc", F.col("block").alias("qb"), "vc", counted("vn").alias("vb"), "id", "v", "floor", F.lit(0).alias("side"))
        right = v.join(table, F.col("cluster") == F.col("vc")).select("qc", counted("qn").alias("qb"), "vc", F.col("block").alias("vb"), "id", "v", F.lit(-2.0).alias("floor"), F.lit(1).alias("side"))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b = pdf[pdf.side == 0].sort_values("id"), pdf[pdf.side == 1].sort_values("id")
            if a.empty or b.empty:
                return pd.DataFrame({"query": pd.Series(dtype=a.id.dtype), "neighbour": pd.Series(dtype=a.id.dtype), "score": pd.Series(dtype=float)})
            x, c = _units(a.v), int(pdf.vc.iloc[0])
            if c < len(centres):  # of this cluster nothing is nearer than its rim
                rim = np.arccos(np.clip(x @ centres[c], -1, 1)) - v_stats[c][1] - SLACK
                may = (np.cos(np.clip(rim, 0, np.pi)) >= a.floor.to_numpy()) | ~x.any(axis=1)
                a, x = a[may], x[may]
            return _best(a.id.to_numpy(), x, b.id.to_numpy(), _units(b.v), k, np.maximum(a.floor.to_numpy(), low), high)

        return left.unionByName(right).groupBy("qc", "qb", "vc", "vb").applyInPandas(run, schema)

    home = [(c, c) for c in q_stats if c in v_stats]
    first = cut(met(home, q.withColumn("floor", F.lit(-2.0)))) if home else spark.createDataFrame([], schema)
    kth = first.groupBy("query").agg(F.count("*").alias("found"), F.sort_array(F.collect_list("score"), False).alias("scores")).where(F.col("found") >= k).select(F.col("query").alias("id"), F.get("scores", F.lit(k - 1)).alias("kth"))
    floored = cut(q.join(kth, "id", "left").withColumn("floor", F.coalesce("kth", F.lit(-2.0))).drop("kth"))
    floors = {r.cluster: r.floor for r in floored.groupBy("cluster").agg(F.min("floor").alias("floor")).collect()}

    def possible(a: int, b: int) -> bool:
        if a == len(centres) or b == len(centres):
            return True
        between, reach = float(np.arccos(np.clip(centres[a] @ centres[b], -1, 1))), q_stats[a][1] + v_stats[b][1] + SLACK
        most, least = np.cos(max(0.0, between - reach)), np.cos(min(np.pi, between + reach))
        return most >= max(floors[a], low) and least <= high

    every = [(a, b) for a in q_stats for b in v_stats if a != b]
    rest = [x for x in every if possible(*x)]
    if report is not None:
        pairs_of = lambda pairs: sum(size(q_stats, a) * size(v_stats, b) for a, b in pairs)
        report |= {"compared": pairs_of(home) + pairs_of(rest), "skipped": pairs_of(every) - pairs_of(rest)}
    found = first.unionByName(met(rest, floored)) if rest else first
    w = Window.partitionBy("query").orderBy(F.desc("score"), "neighbour")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def band_pairs(vectors: DataFrame, key: str, vector: str, differ: str, low: float, high: float, k: int = 20, cut=None) -> DataFrame:
    """(id_a, id_b, score): of each vector's k nearest those in the band whose value of `differ` is another, each pair once."""
    found = top_k(vectors, vectors, key, vector, k, low, high, cut)
    side = lambda n: vectors.select(F.col(key).alias(n), F.col(differ).alias(f"{n}_d"))
    joined = found.join(side("query"), "query").join(side("neighbour"), "neighbour").where("query_d <> neighbour_d")
    return joined.select(F.least("query", "neighbour").alias("id_a"), F.greatest("query", "neighbour").alias("id_b"), "score").groupBy("id_a", "id_b").agg(F.max("score").alias("score"))


def align(rows: DataFrame, vectors: DataFrame, key: str, override: str, vector_key: str, dim: int) -> DataFrame:
    """rows with embedding and valid: by the overriding id if there is one, else the own; a zero vector where none is found."""
    v = vectors.select(F.col(vector_key).alias("__k"), F.col("embedding").alias("__v"))
    out = rows.withColumn("__id", F.coalesce(F.col(override), F.col(key))).join(v, F.col("__id") == F.col("__k"), "left")
    return out.withColumn("valid", F.col("__v").isNotNull()).withColumn("embedding", F.coalesce("__v", F.array_repeat(F.lit(0.0).cast("float"), dim))).drop("__id", "__k", "__v")


def mismatch(text_vector: Column, image_vector: Column, threshold: float = 0.25) -> Column:
    """Whether text and image disagree: their dot product is below the threshold; missing vectors tell nothing."""
    return F.coalesce(dot(text_vector, image_vector) < threshold, F.lit(False))
