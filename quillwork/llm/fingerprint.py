"""Document fingerprints: context-triggered piecewise hashing.

A rolling hash over 7 bytes cuts a text where it hits a residue of the block size; each piece gives one of
64 letters. The block size is 3 times the power of two that leads to 32 to 64 expected pieces; it depends on
the length alone. No piece is shorter than a quarter of the block size, but for the last, and none longer than
two block sizes, so that a text that repeats itself has neither too many pieces nor one alone. A signature is
also made at twice that size, so texts of similar length share one. Two fingerprints are compared by edit
distance at every block size they share; the best likeness counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, text_blocks, unit_hash

WINDOW = 7
#: Pieces to expect at the smaller block size: from this many to twice as many.
PIECES = 32
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Documents that one range of ids holds, about.
RANGE_ROWS = 4_000
#: Most ranges, and rows of the sample that gives their bounds for each.
RANGES, SAMPLED = 65_536, 16

_RNG = np.random.default_rng(99)
_ROLL = _RNG.integers(1, 1 << 32, 256, dtype=np.uint32)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_LETTERS = np.frombuffer(ALPHABET, dtype=np.uint8)
_TABLES: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _TABLES or len(_TABLES[key]) < n:
        out = np.full(max(n, 1 << 17), base, dtype=np.uint64)
        out[0] = 1
        _TABLES[key] = np.multiply.accumulate(out)
    return _TABLES[key][:n]


def block_size(n_bytes: int) -> int:
    size = 3
    while n_bytes // size >= 2 * PIECES:
        size *= 2
    return size


def fingerprint(text: str) -> str:
    """'size:signature:signature at twice the size'; an empty text gives '3::'."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n, size = len(data), block_size(len(data))
    if not n:
        return f"{size}::"
    roll = np.zeros(n, dtype=np.uint32)
    mapped = _ROLL[data]
    for k in range(min(WINDOW, n)):
        roll[k:] += (mapped[: n - k] >> np.uint32(k)) * np.uint32(2 * k + 1)
    roll *= np.uint32(0x9E3779B1)
    roll >>= np.uint32(8)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_P, n), out=sums[1:])
    inverse = _power(_P_INV, n)
    out = []
    for scale in (size, 2 * size):
        edges = np.array(_edges(np.flatnonzero(roll % np.uint32(scale) == 0) + 1, n, max(1, scale // 4), 2 * scale))
        pieces = (sums[edges[1:]] - sums[edges[:-1]]) * inverse[edges[:-1]] * np.uint64(0xD6E8FEB86659FD93)
        out.append(_LETTERS[(pieces >> np.uint64(58)).astype(np.int64)].tobytes().decode())
    return f"{size}:{out[0]}:{out[1]}"


def _edges(cuts: np.ndarray, n: int, least: int, most: int) -> list[int]:
    """Where pieces begin and end: at the first cut that is `least` or more behind the last edge, at the latest `most` behind it."""
    edges = [0]
    while edges[-1] < n:
        at = int(np.searchsorted(cuts, edges[-1] + least))
        edges.append(min(int(cuts[at]) if at < len(cuts) else n, edges[-1] + most, n))
    return edges


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements between two strings, by bit-parallel dynamic programming."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) or len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    top, mask = 1 << (len(a) - 1), (1 << len(a)) - 1
    plus, minus, distance = mask, 0, len(a)
    for c in b:
        eq = at.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(across | plus) & mask
        down = plus & across
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up = ((up << 1) | 1) & mask
        down = (down << 1) & mask
        straight = eq | minus
        plus = (down | ~(straight | up)) & mask
        minus = up & straight
    return distance


def likeness(one: str, two: str) -> float:
    """0 to 1: 1 less the edit distance as a share of the longer signature, at the best shared block size; 0 if none is shared."""
    if one == two:
        return 1.0
    (a, a1, a2), (b, b1, b2) = one.split(":"), two.split(":")
    sides = {int(a): a1, 2 * int(a): a2}, {int(b): b1, 2 * int(b): b2}
    best = 0.0
    for size in sides[0].keys() & sides[1].keys():
        x, y = sides[0][size], sides[1][size]
        if x and y:
            best = max(best, 1.0 - edit_distance(x, y) / max(len(x), len(y)))
    return best


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint for every row; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([fingerprint(t or "") for t in b.column("text").to_pylist()], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, ghost, part: rows dealt to ranges of ascending ids (equal ids by a hash of the text), with a ghost copy of the row that follows each range.

    The bounds come from a sample of about SAMPLED rows a range; a range is read row by row, so its size may
    vary. A range's ghost is the first row of the next range that has rows; the last range's is the first row of
    all. Only the sample and one first row's key a range reach the driver, for RANGES ranges at most.
    """
    spark = docs.sparkSession
    # a null id sorts before all others
    value = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    total = docs.count()
    n = min(RANGES, max(1, -(-total // range_rows)))
    keys = np.zeros(0, dtype=[("id", "<i8"), ("h", "<i8")])
    if n > 1:
        got = rows.where(unit_hash(F.col("doc_id"), F.col("h"), F.monotonically_increasing_id(), seed=4) < SAMPLED * n / total).select(value.alias("id"), "h").toArrow()
        keys = np.empty(got.num_rows, dtype=keys.dtype)
        keys["id"], keys["h"] = got.column("id").to_numpy(), got.column("h").to_numpy()
        keys = np.unique(np.sort(keys, order=("id", "h"))[SAMPLED::SAMPLED])
    ids, hashes = keys["id"].copy(), keys["h"].copy()

    @F.pandas_udf("int")
    def part_of(one: pd.Series, two: pd.Series) -> pd.Series:
        v, h = one.to_numpy(), two.to_numpy()
        low, part = np.searchsorted(ids, v, "left"), np.searchsorted(ids, v, "right")
        # ranges that begin within the rows of one id
        for i in np.unique(v[part > low]).tolist():
            own = np.flatnonzero(v == i)
            lo, hi = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            part[own] = lo + np.searchsorted(hashes[lo:hi], h[own], "right")
        return pd.Series(part.astype(np.int32))

    dealt = rows.withColumn("part", part_of(value, F.col("h")))
    firsts = rows.select(value.alias("id"), "h").withColumn("part", part_of(F.col("id"), F.col("h"))).groupBy("part").agg(F.min(F.struct("id", "h")).alias("first")).select("part", "first.*").orderBy("part").collect()
    if not firsts:
        return dealt.withColumn("ghost", F.lit(0))
    # the part before; the first row's ghost goes to the last part
    heads = spark.createDataFrame([(r["id"], r["h"], firsts[k - 1]["part"]) for k, r in enumerate(firsts)], "head long, head_h long, to int")
    found = rows.join(F.broadcast(heads), (value == F.col("head")) & (F.col("h") == F.col("head_h"))).groupBy("to").agg(F.min(F.struct("doc_id", "h", "text")).alias("r"))
    ghosts = found.select("r.doc_id", "r.text", "r.h", F.col("to").alias("part"), F.lit(1).alias("ghost"))
    return dealt.withColumn("ghost", F.lit(0)).select("doc_id", "text", "h", "part", "ghost").unionByName(ghosts)


def edited(text: str, following: str) -> str:
    """text with its last floor(n / 4) code points replaced by the first as many, or all, of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def compare_with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """For every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one that follows by ascending id (null ids first, equal ids by a hash of the text
    and the text), after the last the first; a single row follows itself. Null texts are empty. Other columns are not read.
    """
    out_schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # part, id, text, fingerprint of the row whose follower is still to come
        for batch in text_blocks(batches):
            rows = []
            for part, ghost, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "ghost", "doc_id", "text")), strict=True):
                mark = fingerprint(text)
                if before is not None and before[0] == part:
                    _, old_id, old, old_mark = before
                    other = edited(old, text)
                    other_mark = old_mark if other == old else fingerprint(other)
                    rows.append((old_id, len(old), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), old_mark, other_mark, likeness(old_mark, other_mark), likeness(old_mark, mark)))
                before = None if ghost else (part, doc_id, text, mark)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), names, strict=True)], schema=names)

    dealt = with_next(docs, range_rows)
    return dealt.repartition("part").sortWithinPartitions("part", "ghost", "doc_id", "h", "text").mapInArrow(run, out_schema)
