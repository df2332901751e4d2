"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Documents become pieces of at most `capacity` tokens; only longer documents are cut. Pieces are dealt to
groups of bounded size by a hash. In each group full pieces stand alone, the others are placed best fit by
decreasing length, and a local search then works on all underfull bins: it moves documents, exchanges one for
one, two for one or one for two, wherever that raises the sum of squared fills, until no step is left or
rounds empty no further bin.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import BATCH_BYTES, tokenizer, vocabulary_content
from .common import arrow_schema, text_blocks, texts

CAPACITY = 4096
#: Id that ends every document.
END = 1
#: Rows of documents that one group holds, about. A group is packed by one task.
GROUP_ROWS = 4_000
#: Rounds of local search without a bin emptied before a group is done.
PATIENCE = 3

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers), best fit by decreasing size. An index by free space finds the tightest bin."""
    by_free: dict[int, list[int]] = {}
    frees: list[int] = []
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        k = bisect.bisect_left(frees, size)
        if k == len(frees):
            bins.append([item])
            left, b = capacity - size, len(bins) - 1
        else:
            free = frees[k]
            b = by_free[free].pop()
            if not by_free[free]:
                del by_free[free]
                frees.pop(k)
            bins[b].append(item)
            left = free - size
        if left not in by_free:
            by_free[left] = []
            bisect.insort(frees, left)
        by_free[left].append(b)
    return bins


def local_search(bins: list[list[int]], sizes: list[int], capacity: int, patience: int = PATIENCE) -> list[list[int]]:
    """Fewer or fuller bins: documents are moved, exchanged one for one, two for one or one for two between underfull bins.

    Each round takes every underfull bin, the emptiest first, as a source, and gives its documents to the bins
    that an exchange fills best. A step is taken if it raises the sum of squared fills of the two bins, so the
    search ends; bins that get empty go. It stops when the bound on the number of bins is met, after a round
    without a step, or after `patience` rounds without a bin emptied. Only bins that are not full take part.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    held = [sorted(b, key=lambda i: (sizes[i], i)) for b in bins]
    open_ = [k for k, f in enumerate(fill) if f < capacity]
    idle = 0
    while len(open_) > 1 and idle < patience:
        before, filled = len(open_), sum(map(bool, held))
        if sum(fill[k] for k in open_) > capacity * (before - 1):
            break  # even one bin fewer can't hold them
        index = _Partners(open_, fill, held, sizes, capacity)
        stepped = False
        for source in sorted(open_, key=lambda k: (fill[k], k)):
            while held[source] and (step := index.best(source)):
                target, give, take = step
                for k, gone, come in ((source, give, take), (target, take, give)):
                    index.remove(k)
                    held[k] = sorted([*(i for i in held[k] if i not in gone), *come], key=lambda i: (sizes[i], i))
                    fill[k] += sum(sizes[i] for i in come) - sum(sizes[i] for i in gone)
                    index.add(k)
                stepped = True
        open_ = [k for k in open_ if held[k] and fill[k] < capacity]
        if not stepped:
            break
        idle = 0 if sum(map(bool, held)) < filled else idle + 1
    return [h for h in held if h]


class _Partners:
    """The documents, and pairs of neighbours in size, of underfull bins, by size, to find what fills a bin's space best."""

    def __init__(self, bins: list[int], fill: list[int], held: list[list[int]], sizes: list[int], capacity: int):
        self.fill, self.held, self.sizes, self.capacity = fill, held, sizes, capacity
        self.frees: list[tuple[int, int]] = []  # (free space, bin)
        self.gaps: list[tuple[int, int, int]] = []  # (free space + size of a document, bin, document): how large a document may be that takes its place
        for k in bins:
            self.add(k)

    def add(self, k: int) -> None:
        if not self.held[k] or self.fill[k] >= self.capacity:
            return
        free = self.capacity - self.fill[k]
        bisect.insort(self.frees, (free, k))
        for i in self.held[k]:
            bisect.insort(self.gaps, (free + self.sizes[i], k, i))

    def remove(self, k: int) -> None:
        free = self.capacity - self.fill[k]
        at = bisect.bisect_left(self.frees, (free, k))
        if at < len(self.frees) and self.frees[at] == (free, k):
            del self.frees[at]
        for i in self.held[k]:
            gap = (free + self.sizes[i], k, i)
            at = bisect.bisect_left(self.gaps, gap)
            if at < len(self.gaps) and self.gaps[at] == gap:
                del self.gaps[at]

    def best(self, source: int) -> tuple[int, list[int], list[int]] | None:
        """(target, documents that the source gives, documents that it takes): the step that raises the squares most."""
        sizes, load = self.sizes, self.fill[source]
        gain, found = 0, None
        own = self.held[source]
        # documents of one size are alike, and a bin has few sizes; own is in the order of size
        new = [i for n, i in enumerate(own) if not n or sizes[own[n - 1]] != sizes[i]]
        twins = [[x, y] for n, (x, y) in enumerate(zip(own, own[1:], strict=False)) if sizes[x] == sizes[y] and (not n or sizes[own[n - 1]] != sizes[x])]
        gives = [[i] for i in new] + [[new[x], new[y]] for x in range(len(new)) for y in range(x)] + twins
        for give in gives:
            total = sum(sizes[i] for i in give)
            # a move: the tightest space that holds what is given
            at = bisect.bisect_left(self.frees, (total, -1))
            while at < len(self.frees) and self.frees[at][1] == source:
                at += 1
            if at < len(self.frees):
                k = self.frees[at][1]
                won = self._won(load, self.fill[k], total)
                if won > gain:
                    gain, found = won, (k, give, [])
            # an exchange for one document: the place that just holds what is given
            at = bisect.bisect_left(self.gaps, (total, -1, -1))
            for gap, k, i in self.gaps[at : at + 3]:
                if k != source and sizes[i] < total:
                    won = self._won(load, self.fill[k], total - sizes[i])
                    if won > gain:
                        gain, found = won, (k, give, [i])
            # one for two: a target's free space and its two smallest make room
            if len(give) == 1:
                for _, k in self.frees[-3:]:
                    two = self.held[k][:2]
                    less = total - sum(sizes[i] for i in two)
                    if k != source and len(two) == 2 and 0 < less <= self.capacity - self.fill[k]:
                        won = self._won(load, self.fill[k], less)
                        if won > gain:
                            gain, found = won, (k, give, two)
        return found

    @staticmethod
    def _won(load: int, other: int, moved: int) -> int:
        """By how much the sum of both squared fills rises when so much goes from a bin of one load to one of the other."""
        return (other + moved) ** 2 + (load - moved) ** 2 - other**2 - load**2


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers whose sizes sum to at most capacity. No size may be over it."""
    single = [[i] for i, s in enumerate(sizes) if s >= capacity]
    rest = [i for i, s in enumerate(sizes) if s < capacity]
    small = [sizes[i] for i in rest]
    return single + [[rest[i] for i in b] for b in local_search(best_fit(small, capacity), small, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every document's pieces: doc_id, piece, start, length, ids_crc32. A null text is empty and is one piece of the end id alone."""
    content = vocabulary_content(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, schema, last = tokenizer(content), arrow_schema(PIECES), np.array([end], dtype=np.uint32)
        for block in text_blocks(batches, limit=BATCH_BYTES):
            rows = []
            for doc_id, ids in zip(block.column("doc_id").to_pylist(), tok.encode_batch(texts(block)), strict=True):
                ids = np.concatenate([ids, last]).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def place(cut: DataFrame, n_docs: int, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """cut (as pieces() gives it) with sequence_id and offset. Lengths and digests are shuffled, never ids."""
    groups = max(1, -(-n_docs // group_rows))
    schema = arrow_schema(PLACED)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = pa.Table.from_batches(batches).sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("length", "ascending")])
        lengths = data.column("length").to_pylist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for b, items in enumerate(pack(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = (key[0].as_py() << 32) + b, at
                at += lengths[i]
        columns = [data.column(f.name).combine_chunks().cast(f.type) for f in list(schema)[:5]] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
        yield from pa.Table.from_arrays(columns, schema=schema).to_batches(max_chunksize=10_000)

    # the row's number splits ids and texts that repeat; it is the same when a lost task runs again over its part of the input
    keyed = cut.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    return keyed.groupBy("g").applyInArrow(run, PLACED)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pack all rows of docs. One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most capacity tokens and have no gaps. Repeated rows are packed each. An empty table
    gives no rows.
    """
    return place(pieces(docs, vocabulary, capacity), docs.count(), capacity, group_rows)
