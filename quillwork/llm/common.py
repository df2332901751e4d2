"""Helpers shared by the training-data operators: tables, cut points, text buffers, hashing, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a worker handles at once; one longer text still makes one block of its own.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A session on one machine that names none gets a local one; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_already = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_already.isDefined():
            return set_already.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quillwork-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return folder


class Scratch:
    """Written tables in the shared folder. They cut lineage and outlive lost executors; drop() removes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/quillwork-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame, *partition_by: str) -> DataFrame:
        """df, written and read again."""
        path = f"{self.root}/{self.n}"
        self.n += 1
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._quillwork_path = path
        return out

    def keep_only(self, *kept: DataFrame) -> None:
        """Remove all written tables but these."""
        paths = {df._quillwork_path for df in kept}
        for k in range(self.n):
            if f"{self.root}/{k}" not in paths:
                self.delete(f"{self.root}/{k}")

    def drop(self, df: DataFrame) -> None:
        """Remove one written table that no later step reads."""
        self.delete(df._quillwork_path)

    def delete(self, where: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """The third of the rows that no model learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "short": pa.int16()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text, or one row."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as strings; null is empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


# ---------------------------------------------------------------- hashing of words and shingles

_RNG = np.random.default_rng(20240607)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A value for each place in a span and byte there, one row of 256 a place; places beyond the table get theirs from mix().
_PLACES = 64
_AT = _RNG.integers(0, 1 << 64, (_PLACES, 256), dtype=np.uint64)
_AT_FOLDED = _AT.copy()
_AT_FOLDED[:, 65:91] = _AT[:, 97:123]  # A-Z count as a-z


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of the byte spans, which ascend and don't overlap; none may be empty. fold: A-Z count as a-z.

    A span's hash is the sum of one random value for each place and byte there, mixed with its length, so that
    no rule of letters (as in words built by repetition) makes two spans alike.
    """
    sizes = ends - starts
    total = int(sizes.sum())
    if not total:
        return np.zeros(len(starts), np.uint64)
    first = np.cumsum(sizes) - sizes
    if total == len(data):
        own = data
        place = np.arange(total) - np.repeat(first, sizes)
    else:
        place = np.arange(total) - np.repeat(first, sizes)
        own = data[place + np.repeat(starts, sizes)]
    near = _AT_FOLDED if fold else _AT
    if int(sizes.max()) <= _PLACES:
        values = near.ravel()[(place << 8) | own]
    else:
        values = near.ravel()[(np.minimum(place, _PLACES - 1) << 8) | own]
        far = np.flatnonzero(place >= _PLACES)
        values[far] = mix(near[0][own[far]] ^ (place[far].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The order by row and value. Few rows are sorted by radix behind one sort of the values."""
    order = np.argsort(values)
    small = rows[order].astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows[order]
    return order[np.argsort(small, kind="stable")]


def word_hashes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ (A-Z as a-z) of all rows, and each word's row."""
    values = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(column).to_pylist()]
    data = np.frombuffer(b" ".join(values), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends_of_rows = np.cumsum(np.fromiter((len(v) + 1 for v in values), np.int64, len(values)))
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    hashes = span_hashes(data, starts, ends, fold=True)
    return hashes, np.searchsorted(ends_of_rows, starts, side="right")


def shingles(batch: pa.RecordBatch, size: int = 5, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Each row's set of `size`-word shingles as 64-bit hashes: (hashes, rows), sorted by row and hash.

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    words, rows = word_hashes(batch, column)
    n = batch.num_rows
    counts = np.bincount(rows, minlength=n)
    factors = [mix(np.array([k + 1], dtype=np.uint64))[0] | np.uint64(1) for k in range(size)]
    m = max(0, len(words) - size + 1)
    grams = np.zeros(m, dtype=np.uint64)
    for k in range(size):
        grams += words[k : k + m] * factors[k]
    inside = rows[:m] == rows[size - 1 :] if m else np.zeros(0, bool)
    found, where = [mix(grams[inside])], [rows[:m][inside]]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        values = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            values[has] += words[first[short[has]] + k] * factors[k]
        found.append(mix(values + counts[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        where.append(short)
    hashes, at = np.concatenate(found), np.concatenate(where)
    order = by_row(hashes, at)
    hashes, at = hashes[order], at[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (at[1:] != at[:-1])
    return hashes[new], at[new]


# ---------------------------------------------------------------- connected components

#: Edge tables of at most so many rows (16 bytes each) are solved by one task; larger ones by rounds of joins.
LOCAL_EDGES = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Worker: (id, component) of all edges (a, b) that it gets, by labels that sink along edges and jump to their label's label."""
    got = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not got:
        return
    a, b = (np.concatenate(side) for side in zip(*got, strict=True))
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]
    for lo in range(0, len(ids), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + 100_000]), pa.array(ids[label[lo : lo + 100_000]])], names=["id", "component"])


def components(spark: SparkSession, scratch: Scratch, edges: DataFrame, most: int = 60, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(id, component) of every id in edges (a, b): component is the smallest id reachable.

    An edge table of a bounded size is solved in one task. A larger one alternates large-star and small-star
    steps over a written edge table, each step one minimum per node and one join, until all edges are stars;
    the edge count never grows.
    """
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if now.count() <= local_edges:
        out = scratch.write(now.coalesce(1).mapInArrow(_forest, "id long, component long"))
        scratch.drop(now)
        return out
    for _ in range(most):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = scratch.write(small.select("e.a", "e.b").where("a <> b").distinct())
        scratch.drop(now)
        now = after
        ends = now.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        # done when every id has one edge up, or only edges from below
        if ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    tops = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(tops)
