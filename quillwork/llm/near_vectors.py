"""Embedding near-dedup with an inverted multi-index.

Each half of the vectors has a codebook of its own; the product of both is a grid of cells. A vector lives in
the cell of its two nearest centroids and visits the cells nearest to it, in the order of the summed distances
(multi-sequence order), up to the count that reaches the target recall for pairs just at the threshold. Met
vectors are verified by their cosine in double precision, so no reported link is below the threshold.

Equal vectors of a label are one class with a count. The classes of one grid column (a slab) are compared in
blocks of bounded size; a block returns sums and a spanning forest, never its pairs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_schema, components, unit_hash

THRESHOLD = 0.93
#: Share of the pairs just at the threshold that one side's traversal must meet.
RECALL = 0.98
#: Sampled vectors for each centroid of a codebook, vectors set apart to measure visits on, and the most that are sampled of one length.
A_CENTROID, MEASURED, SAMPLE = 30, 2_000, 32_000
#: Cells of a grid hold so many vectors on the average, as long as the sample suffices for its codebooks.
A_CELL = 500
#: Most vectors on a side of a block of comparisons.
BLOCK = 4_096


@dataclass
class Index:
    """Codebooks of both halves of vectors with one dimension, and how many cells a vector visits."""

    one: np.ndarray
    two: np.ndarray
    visits: int

    @property
    def size(self) -> int:
        return len(self.one)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.one.shape[1]
        return _distances(x[:, :h], self.one), _distances(x[:, h:], self.two)

    def limit(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """The cost up to which each vector visits cells: between its last visited cell and the next."""
        cells = len(self.one) * len(self.two)
        if self.visits >= cells:
            return np.full(len(d1), np.inf)
        one, two = np.sort(d1, axis=1), np.sort(d2, axis=1)
        return np.fromiter((_multi_sequence(x, y, self.visits) for x, y in zip(one.tolist(), two.tolist(), strict=True)), float, len(d1))


def _multi_sequence(one: list[float], two: list[float], visits: int) -> float:
    """The mean of the costs of the last visited cell and the next: multi-sequence traversal of two ascending lists.

    A heap holds, of each row of the grid that has been entered, the next cell; a row is entered when the row
    before it gives its first cell. So the cells come in the order of their cost, and no others are looked at.
    """
    heap, last = [(one[0] + two[0], 0, 0)], 0.0
    for _ in range(visits):
        last, i, j = heap[0]
        if j + 1 < len(two):
            heapq.heapreplace(heap, (one[i] + two[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))
    return (last + heap[0][0]) / 2


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        for c in range(k):
            own = x[near == c]
            centres[c] = own.mean(0) if len(own) else x[rng.integers(len(x))]
    return centres


def centroids(total: int) -> int:
    """Centroids of a codebook for so many vectors: the square root of the cells, as many at most as SAMPLE gives A_CENTROID vectors each. Beyond some 500 million vectors cells grow instead."""
    return min(max(4, int(math.sqrt(total / A_CELL))), (SAMPLE - MEASURED) // A_CENTROID)


def sample_size(total: int) -> int:
    """Vectors to sample of so many."""
    return A_CENTROID * centroids(total) + MEASURED


def fit_index(sample: np.ndarray, total: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 5) -> Index | None:
    """An index from unit vectors; None if there are too few, or of one dimension, for a grid to help.

    Codebooks are fitted on one part of the sample. The number of visits is measured on the other, whose vectors no
    centroid lies on: the rank, at the target recall, of the cell in which a copy turned away from its vector to just the
    threshold lies.
    """
    n, dim = sample.shape
    apart = min(MEASURED, n // 4)
    k = min(centroids(total), (n - apart) // 8)
    if dim < 2 or k < 2:
        return None
    rng = np.random.default_rng(seed)
    sample = sample[rng.permutation(n)]
    some, fitted = sample[:apart], sample[apart:]
    h = dim // 2
    index = Index(_kmeans(fitted[:, :h], k, rng), _kmeans(fitted[:, h:], k, rng), k * k)
    turn = rng.normal(size=some.shape)
    turn -= (turn * some).sum(1)[:, None] * some
    turn /= np.linalg.norm(turn, axis=1)[:, None] + 1e-300
    other = threshold * some + math.sqrt(1 - threshold**2) * turn
    o1, o2 = index.distances(other)
    d1, d2 = index.distances(some)
    own = d1[np.arange(len(some)), o1.argmin(1)] + d2[np.arange(len(some)), o2.argmin(1)]
    d2.sort(axis=1)
    # how many cells cost less: for each centroid of the first half, those of the second below what is left
    rank = np.array([np.searchsorted(two, cost - one).sum() + 1 for one, two, cost in zip(d1, d2, own, strict=True)])
    index.visits = int(np.sort(rank)[min(len(rank) - 1, math.ceil(recall * len(rank)))])
    return index


def _unit(rows) -> np.ndarray:
    """Unit vectors in doubles; scaled by the largest component first, so that no square over- or underflows."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


ASSIGNED = "label long, dim int, slab int, role int, id long, copies long, home1 int, home2 int, bound double, vector binary"


def _assign(indexes: dict[int, Index]):
    """Worker: each class once at home (role 0) and once in every slab that it visits (role 1)."""
    schema = arrow_schema(ASSIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2_000):
                batch = whole.slice(lo, 2_000)
                dims = batch.column("dim").to_numpy()
                vectors = batch.column("embedding").to_pylist()
                kind = "<f8" if batch.column("embedding").type.value_type == pa.float64() else "<f4"
                labels, ids, copies = (batch.column(c).to_numpy() for c in ("label", "id", "copies"))
                for dim in np.unique(dims).tolist():
                    own = np.flatnonzero(dims == dim)
                    x = _unit([vectors[i] for i in own.tolist()])
                    index = indexes.get(dim)
                    if index is None:
                        home1 = home2 = np.zeros(len(own), np.int64)
                        bound = np.full(len(own), np.inf)
                        which, slab = np.arange(len(own)), np.zeros(len(own), np.int64)
                    else:
                        d1, d2 = index.distances(x)
                        home1, home2, bound = d1.argmin(1), d2.argmin(1), index.limit(d1, d2)
                        which, slab = np.nonzero(d1 + d2.min(1)[:, None] <= bound[:, None])
                    role = np.concatenate([np.zeros(len(own), np.int32), np.ones(len(which), np.int32)])
                    at = np.concatenate([np.arange(len(own)), which])
                    slabs = np.concatenate([home1, slab]).astype(np.int32)
                    packed = [np.array(vectors[i], dtype=kind).tobytes() for i in own.tolist()]
                    columns = [labels[own][at].astype(np.int64), np.full(len(at), dim, np.int32), slabs, role, ids[own][at], copies[own][at], home1[at].astype(np.int32), home2[at].astype(np.int32), bound[at]]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([packed[i] for i in at.tolist()], pa.binary())], schema=schema)

    return run


FOUND = "kind int, a long, b long"


def _compare(indexes: dict[int, Index], threshold: float):
    """Worker for one block: kind 0: b more links of class a; kind 1: a is connected to b."""
    schema = arrow_schema(FOUND)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = pa.Table.from_batches(batches).combine_chunks()
        role = data.column("role").to_numpy()
        dim, slab = int(data.column("dim")[0].as_py()), int(data.column("slab")[0].as_py())
        x = _unit([np.frombuffer(v, dtype="<f8" if len(v) == 8 * dim else "<f4") for v in data.column("vector").to_pylist()])
        ids, copies, bound, home1, home2 = (data.column(c).to_numpy() for c in ("id", "copies", "bound", "home1", "home2"))
        home, guest = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(home) or not len(guest):
            return
        index = indexes.get(dim)
        d = index.distances(x) if index else (np.zeros((len(x), 1)), np.zeros((len(x), 1)))
        links = np.zeros(len(x), dtype=np.int64)
        names, place = np.unique(ids, return_inverse=True)
        root = np.arange(len(names))
        for column in np.unique(home2[home]).tolist():
            own = home[home2[home] == column]
            come = guest[d[0][guest, slab if index else 0] + d[1][guest, column if index else 0] <= bound[guest]]
            for lo in range(0, len(come), 512):
                part = come[lo : lo + 512]
                v, h = np.nonzero(x[part] @ x[own].T >= threshold)
                v, h = part[v], own[h]
                other = ids[v] != ids[h]
                v, h = v[other], h[other]
                if not len(v):
                    continue
                np.add.at(links, v, copies[h])
                # the one at home counts the guest here only if it doesn't visit the guest's own cell
                alone = d[0][h, home1[v]] + d[1][h, home2[v]] > bound[h]
                np.add.at(links, h[alone], copies[v[alone]])
                a, b = place[v], place[h]
                while True:
                    ra, rb = root[a], root[b]
                    apart = ra != rb
                    if not apart.any():
                        break
                    np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
                    while (root[root] != root).any():
                        root = root[root]
        some = np.flatnonzero(links)
        joined = np.flatnonzero(root != np.arange(len(root)))
        kinds = np.concatenate([np.zeros(len(some), np.int32), np.ones(len(joined), np.int32)])
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate([ids[some], names[joined]])), pa.array(np.concatenate([links[some], names[root[joined]]]))], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    A row whose id, label or vector is null, or whose vector is empty, zero or holds null or non-finite
    components, links with nothing: no links, its own component, kept (with a null id: component null, not
    kept). Vectors of different dimension never link. Equal vectors of a label link with each other.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)
    e = F.col("embedding")
    finite = ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0), F.lit(False))
    # components of float columns are floats; all others are taken as doubles
    held = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(held).alias("embedding")).withColumn("sound", sound)
    # copies meet by two hashes of the vector, so that long arrays needn't be sorted or shuffled as keys
    keyed = rows.withColumn("k1", F.xxhash64("label", "embedding")).withColumn("k2", F.xxhash64("embedding", "label", F.lit(7)))
    good = keyed.where("sound")
    reps = scratch.write(good.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.min_by("embedding", "vec_id").alias("embedding"), F.min("label").alias("label")).withColumn("dim", F.size("embedding")))
    # vectors of a length that fit one block are compared without an index
    sizes = {r["dim"]: r["n"] for r in reps.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > block).collect()}
    indexes: dict[int, Index] = {}
    for dim, n in sizes.items():
        share = min(1.0, sample_size(n) / len(sizes) / n)
        picked = reps.where((F.col("dim") == dim) & (unit_hash(F.col("id"), seed=8) < share)).select("id", "embedding").toArrow().sort_by("id")
        x = picked.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        if len(x) and (index := fit_index(_unit(x), n, threshold, recall)):
            indexes[dim] = index
    placed = scratch.write(reps.select("label", "dim", "id", "copies", "embedding").mapInArrow(_assign(indexes), ASSIGNED))
    by_slab = placed.groupBy("label", "dim", "slab").agg(F.ceil(F.count_if(F.col("role") == 0) / block).cast("int").alias("homes"), F.ceil(F.count_if(F.col("role") == 1) / block).cast("int").alias("guests")).where("homes > 0 and guests > 0")
    at = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    own = F.when(F.col("role") == 0, F.col("homes")).otherwise(F.col("guests"))
    facing = F.when(F.col("role") == 0, F.col("guests")).otherwise(F.col("homes"))
    dealt = placed.join(by_slab, ["label", "dim", "slab"]).withColumn("own", (at % own).cast("int")).withColumn("facing", F.explode(F.sequence(F.lit(0), facing - 1)))
    dealt = dealt.withColumn("h", F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("facing"))).withColumn("g", F.when(F.col("role") == 0, F.col("facing")).otherwise(F.col("own")))
    columns = [c.split()[0] for c in ASSIGNED.split(", ")]
    found = scratch.write(dealt.select(*columns, "h", "g").groupBy("label", "dim", "slab", "h", "g").applyInArrow(_compare(indexes, threshold), FOUND), "kind")
    scratch.drop(placed)
    links = found.where("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))
    joined = components(spark, scratch, found.where("kind = 1").select("a", "b"))
    named = scratch.write(reps.select("k1", "k2", "id", "copies").join(links, "id", "left").join(joined, "id", "left").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    scratch.keep_only(named)
    out = keyed.withColumn("k1", F.when(F.col("sound"), F.col("k1"))).join(named, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
