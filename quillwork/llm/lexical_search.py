"""Ranked lexical search by Fagin's threshold algorithm.

Documents are read twice: once for the counts that weigh terms, once for the search. In the second pass each
worker gathers segments of a bounded number of postings. A segment has one list per term, sorted by impact, and a
forward index from each document to its terms and impacts. For an item, the lists of its terms are read
round-robin from their tops; each document met is scored in full through the forward index. Reading stops once
the sum of the impacts last read, the threshold, falls strictly below the k-th score so far: no unread document
can reach it then, not even to tie. The k-th scores are carried from segment to segment of a task, so later
segments stop sooner. No posting is shuffled; a task hands on at most k rows an item.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, Scratch, arrow_schema, text_blocks

#: Postings of a segment, beyond those of the one block of texts that closes it.
SEGMENT = 1 << 20
#: Distinct terms and items that are searched for together: they go to every task, so their size is bounded.
BLOCK_TERMS, BLOCK_ITEMS = 200_000, 2_000
#: List entries read in an item's first round; rounds double up to the second.
STEP, MOST_STEP = 16, 4_096

_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[48:58] = _IN_TERM[65:91] = _IN_TERM[97:123] = _IN_TERM[128:] = True
_NO_ID = np.iinfo(np.int64).min


def terms_of(batch: pa.RecordBatch, column: str = "text") -> tuple[pa.Array, np.ndarray]:
    """All terms of the rows, A-Z lower-cased, with repeats, and each term's row. Null has none."""
    values = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(column).to_pylist()]
    data = np.frombuffer(b" ".join(values).lower(), dtype=np.uint8)
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    ends_of_rows = np.cumsum(np.fromiter((len(v) + 1 for v in values), np.int64, len(values)))
    inside = _IN_TERM[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])])
    return terms.cast(pa.binary()), np.searchsorted(ends_of_rows, starts, side="right")


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct, as bytes), for every row of items; null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            terms, rows = terms_of(block)
            found: list[set[bytes]] = [set() for _ in range(block.num_rows)]
            for t, r in zip(terms.to_pylist(), rows.tolist(), strict=True):
                found[r].add(t)
            yield pa.RecordBatch.from_arrays([block.column("item_id"), pa.array([sorted(s) for s in found], pa.list_(pa.binary()))], names=["item_id", "terms"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<binary>")


@dataclass
class Block:
    """Items that are searched for together: ids, all their terms, and the places of each item's terms therein."""

    item_ids: list
    terms: list[bytes]
    of_item: list[np.ndarray]


def blocks(rows: Iterator[Row], most_terms: int = BLOCK_TERMS, most_items: int = BLOCK_ITEMS) -> Iterator[Block]:
    """Blocks of bounded size, in the order of the rows; one item with more terms is a block of its own. Items without terms are left out."""
    ids, places, of_item = [], {}, []
    for row in rows:
        if ids and (len(ids) >= most_items or len(places) + len(row.terms) > most_terms):
            yield Block(ids, list(places), of_item)
            ids, places, of_item = [], {}, []
        if row.terms:
            ids.append(row.item_id)
            of_item.append(np.array([places.setdefault(bytes(t), len(places)) for t in row.terms]))
    if ids:
        yield Block(ids, list(places), of_item)


def _postings(block: pa.RecordBatch, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the rows in terms; row, term and occurrences of each of the wanted terms, by row and term."""
    found, rows = terms_of(block)
    lengths = np.bincount(rows, minlength=block.num_rows)
    at = pc.fill_null(pc.index_in(found, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    wanted = at >= 0
    keys, counts = np.unique(rows[wanted] * len(terms) + at[wanted], return_counts=True)
    return lengths, keys // len(terms), keys % len(terms), counts


def _counter(shared: Broadcast):
    """Worker: (term, n) with documents that hold it; term -1: documents with any term, -2: terms of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(shared.value.terms, pa.binary())
        df, documents, total = np.zeros(len(terms), np.int64), 0, 0
        for block in text_blocks(batches):
            lengths, _, term, _ = _postings(block, terms)
            df += np.bincount(term, minlength=len(terms))
            documents += int((lengths > 0).sum())
            total += int(lengths.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([held, [-1, -2]])), pa.array(np.concatenate([df[held], [documents, total]]))], names=["term", "n"])

    return run


@dataclass
class Weights:
    """Documents and terms of the corpus, and a weight for each of a block's terms (0 where no document holds it)."""

    documents: int
    total: int
    of_term: np.ndarray


def weights(docs: DataFrame, block: Broadcast) -> Weights:
    """Counts over all documents, one small row a term of the block."""
    n = {r.term: r.n for r in docs.select("text").mapInArrow(_counter(block), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents = n.get(-1, 0)
    of_term = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n[k] + 1))) if k in n else 0 for k in range(len(block.value.terms))], dtype=np.int64)
    return Weights(documents, n.get(-2, 0), of_term)


class Segment:
    """Impact-sorted lists and forward index of some documents."""

    def __init__(self, n_terms: int, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """doc, term, impact: postings by document; doc counts from 0 and each has some."""
        self.n_docs = len(ids)
        self.ids, self.f_term, self.f_impact = ids, term, impact
        self.f_start = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ids)))])
        order = np.lexsort((-impact, term))
        self.l_doc, self.l_impact = doc[order], impact[order]
        self.l_start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Random access: each document's sum of impacts of the wanted terms."""
        first, sizes = self.f_start[docs], self.f_start[docs + 1] - self.f_start[docs]
        before = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)
        return np.add.reduceat(np.where(wanted[self.f_term[at]], self.f_impact[at], 0), before)


def search_segment(segment: Segment, terms: np.ndarray, wanted: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of `best` and the segment: the threshold algorithm. wanted marks the terms."""
    starts, ends = segment.l_start[terms], segment.l_start[terms + 1]
    starts, ends = starts[ends > starts], ends[ends > starts]
    seen = np.zeros(segment.n_docs, dtype=bool)
    at, step, last = starts, STEP, segment.l_impact[starts] if len(starts) else starts
    while len(starts):
        if len(best[0]) == k and last.sum() < best[0][-1]:
            break
        till = np.minimum(at + step, ends)
        sizes = till - at
        if not sizes.any():
            break
        met = segment.l_doc[np.arange(int(sizes.sum())) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)]
        met = np.unique(met[~seen[met]])
        seen[met] = True
        if len(met):
            scores, ids = segment.scores(met, wanted), segment.ids[met]
            good = scores > 0
            if len(best[0]) == k:
                good &= scores >= best[0][-1]
            scores, ids = np.concatenate([best[0], scores[good]]), np.concatenate([best[1], ids[good]])
            top = np.lexsort((ids, -scores))[:k]
            best = scores[top], ids[top]
        at, step = till, min(2 * step, MOST_STEP)
        last = np.where(at < ends, segment.l_impact[np.maximum(at - 1, starts)], 0)
    return best


def _searcher(shared: Broadcast, w: Weights, k: int, size: int):
    """Worker: (item, doc_id, score), at most k rows for each item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        terms = pa.array(block.terms, pa.binary())
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in block.item_ids]
        wanted = np.zeros(len(terms), dtype=bool)
        held: list[tuple[np.ndarray, ...]] = []

        def close() -> None:
            ids, doc, term, impact = (np.concatenate(x) for x in zip(*held, strict=True))
            segment = Segment(len(terms), ids, doc, term, impact)
            for i, own in enumerate(block.of_item):
                wanted[own] = True
                best[i] = search_segment(segment, own, wanted, best[i], k)
                wanted[own] = False
            held.clear()

        n_docs = n_postings = 0
        for part in text_blocks(batches, limit=BLOCK_BYTES):
            lengths, rows, term, tf = _postings(part, terms)
            if not len(rows):
                continue
            m = 50 + (50 * lengths.astype(np.int64) * w.documents) // w.total
            impact = w.of_term[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[rows]))
            some, doc = np.unique(rows, return_inverse=True)
            ids = pc.fill_null(part.column("doc_id"), _NO_ID).to_numpy(zero_copy_only=False)[some]
            held.append((ids, doc + n_docs, term, impact))
            n_docs, n_postings = n_docs + len(some), n_postings + len(rows)
            if n_postings >= size:
                close()
                n_docs = n_postings = 0
        if held:
            close()
        for i, (scores, ids) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i)), pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], schema=arrow_schema("item long, doc_id long, score long"))

    return run


def _top(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows of each key, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 50, segment: int = SEGMENT, cut: Callable[[Iterator[Row]], Iterator[Block]] = blocks) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each row of items its k documents of highest score above 0, equal scores by ascending doc_id.

    docs has doc_id and text, items has item_id and text; other columns are not read. Null and empty texts have no
    terms: such documents are never found and not counted, such items find nothing. A null doc_id comes before all
    others among equal scores. Repeated rows of docs are documents of their own; a repeated row of items answers
    once for each row, under the same item_id. An empty table on either side gives no rows.

    Items are taken in blocks of at most BLOCK_TERMS terms and BLOCK_ITEMS items; each block is broadcast and reads
    docs twice. Several blocks' results are written to the shared folder one after the other.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scratch, parts = Scratch(spark), []
    kind = items.schema["item_id"].dataType.simpleString()
    for block in cut(item_terms(items).toLocalIterator()):
        if parts:
            parts[-1] = scratch.write(parts[-1])
        shared = spark.sparkContext.broadcast(block)
        w = weights(docs, shared)
        found = docs.mapInArrow(_searcher(shared, w, k, segment), "item long, doc_id long, score long")
        # a first round over shares of the tasks keeps any one item's rows from meeting in one task unthinned
        found = _top(found.withColumn("share", F.spark_partition_id() % 256), k, "item", "share").drop("share", "rank")
        names = spark.createDataFrame([(i, x) for i, x in enumerate(block.item_ids)], f"item long, item_id {kind}")
        parts.append(_top(found, k, "item").join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
