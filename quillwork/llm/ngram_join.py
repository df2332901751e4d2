"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the classes that its links form.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Steps:

1. One pass gives each document's set size, a signature of its set and a mark (a bitmap of the set's size, in
   which each shingle flips one bit), and a sketch of shingle counts over all documents. Equal sets are one
   class from here on.
2. Shingles are ordered by sketch count, rare ones first. A set of n shingles that must share a = ceil(0.75 n)
   keeps a prefix of n - a + l of them; l is 1 to 4, whichever the estimated candidate cost of its prefix
   favours. Two sets can only match if they share at least the smaller l of prefix shingles. Any order is
   right; where the sketch, whose size is bounded, is crowded, it only tells the frequent shingles apart.
3. Prefix shingles are dealt by hash to ranges in packed blocks. A shingle that only one set has is dropped.
   Sets that share a rare shingle give pairs. A shingle of more sets gives a star (each set with one hub) and
   is kept as a list; shingles that the sketch shows to be very common are also salted.
4. Candidates are settled: two marks differ in at most as many bits as the sets differ in shingles, so marks
   that differ too much rule a pair out exactly. Of the pairs left, each set has only its few first partners
   verified on the texts; the pairs that the links found so far have joined are done, the others go on.
5. In the lists only sets of different components can still matter. A list with many such pairs gets a few
   hubs a round, as long as rounds join its components; the others, and those that rounds don't help, give all
   remaining pairs with enough shingles behind the shared one, compared by mark in blocks. No pair is left out, and a group of near copies
   costs its stars.

Null ids can't be named by a component: such rows link with nothing and their component is null. Empty and
null texts have an empty set, link with nothing and are their own component. Repeated ids and rows are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import Scratch, arrow_schema, components, mix, shingles, text_blocks

SHINGLE = 5
#: Similarity as a fraction: intersection * DEN >= union * NUM.
NUM, DEN = 3, 4
#: Longest multi-match that a prefix may ask for.
MOST_MATCHES = 4
#: What verifying one candidate costs, in rows of a list read.
VERIFY_COST = 64.0
#: Prefix rows that one range holds, about.
RANGE_ROWS = 500_000
#: A list longer than this gives stars first, not pairs.
SMALL = 4
#: Hubs of a list in one round, and the most remaining pairs for each of a list's sets for which all are tested at once.
HUBS, FEW = 4, 4
#: Candidates for each set that are verified at once.
MANY = 4
#: Remaining pairs of all lists, for each document, that are tested at once.
EACH = 2
#: Entries of a part of a long list, and remaining pairs that one group of blocks compares, about.
BLOCK, GROUP_PAIRS = 1_024, 50_000
#: A further round of hubs must have left at most this share of a list's remaining pairs.
PROGRESS = 0.6
#: Buckets that one row of sketch counts holds.
CHUNK = 1 << 14

_ROW = np.dtype([("t", "<u8"), ("s", "<i8"), ("n", "<i4"), ("r", "<i4"), ("l", "u1")])


def _ceil_share(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return -(-n * num // den)


def signatures(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(set size, signature of the set) of each row."""
    n = np.bincount(rows, minlength=n_rows).astype(np.int64)
    total = np.zeros(n_rows, dtype=np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        total[some] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), (np.cumsum(n) - n)[some])
    return n, mix(total + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def marks(hashes: np.ndarray, rows: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A bitmap of each row's set, of 3 to 6 bits a shingle: a bit is set if an odd number of shingles fall on it.

    Its size is a power of two and a shingle's place its hash modulo that, so a mark folds to half its size by
    one exclusive or.
    """
    size = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(3 * n, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(size)])
    at = first[rows] + (hashes & (size[rows] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(first[-1])) & 1).astype(np.uint8)).tobytes()
    cuts = (first >> 3).tolist()
    return [packed[lo:hi] for lo, hi in zip(cuts, cuts[1:], strict=False)]


def differ_at_least(one: bytes, two: bytes) -> int:
    """A lower bound of the number of shingles that only one of two marked sets has."""
    if len(one) > len(two):
        one, two = two, one
    y = int.from_bytes(two, "big")
    # the places of a half are those of the whole modulo its size, and the first byte has the first places
    for k in range((len(two) // len(one)).bit_length() - 1):
        half = (len(two) * 8) >> (k + 1)
        y = (y >> half) ^ (y & ((1 << half) - 1))
    return (int.from_bytes(one, "big") ^ y).bit_count()


MEASURED = "kind int, a long, b long, n long, data binary"


def _measure(bits: int, size: int):
    """Worker: a row (0, doc_id, signature, size, mark or null) for each document, and the task's shingle counts as rows (1, chunk of buckets, counts)."""
    schema = arrow_schema(MEASURED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint32)
        seen: set[int] = set()
        for block in text_blocks(batches):
            hashes, rows = shingles(block, size)
            n, sig = signatures(hashes, rows, block.num_rows)
            fresh = _first_seen(sig, n, seen)
            kept = fresh[rows]
            hashes, rows = hashes[kept], rows[kept]
            data = [m if new else None for m, new in zip(marks(hashes, rows, np.where(fresh, n, 0)), fresh.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), block.column("doc_id"), pa.array(sig), pa.array(n), pa.array(data, pa.binary())], schema=schema)
            np.add.at(counts, (hashes & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
        for chunk, lo in enumerate(range(0, 1 << bits, CHUNK)):
            part = counts[lo : lo + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([chunk]), pa.array([0]), pa.array([0]), pa.array([part.tobytes()], pa.binary())], schema=schema)

    return run


def _add_up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Worker: the sum of one chunk's counts over all tasks, batch by batch."""
    total = None
    for b in batches:
        for x in b.column("data").to_pylist():
            part = np.frombuffer(x, dtype=np.uint32).astype(np.int64)
            total = part if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["a", "data"])


def _first_seen(sig: np.ndarray, n: np.ndarray, seen: set[int], bound: int = 500_000) -> np.ndarray:
    """Rows whose set this task hasn't met yet. The memory is bounded; beyond it a copy may pass again, which costs rows but no correctness."""
    out = np.zeros(len(sig), dtype=bool)
    if len(seen) > bound:
        seen.clear()
    for i, (s, k) in enumerate(zip(sig.tolist(), n.tolist(), strict=True)):
        if k and s not in seen:
            seen.add(s)
            out[i] = True
    return out


def estimates(counts: np.ndarray) -> np.ndarray:
    """How many sets hold a shingle of each bucket: counts less the mean load of a bucket and thrice its spread; 1 at least."""
    total, m = float(counts.sum()), len(counts)
    noise = (total - counts) / max(m - 1, 1)
    return np.maximum(1.0, counts - noise - 3.0 * np.sqrt(total / m))


def count_ranks(counts: np.ndarray) -> np.ndarray:
    """The place of each bucket's count among all different counts, as 16 bits: the order of rarity. Beyond the last place all are alike."""
    return np.minimum(np.searchsorted(np.unique(counts), counts), (1 << 16) - 1).astype(np.uint16)


def prefixes(hashes: np.ndarray, rows: np.ndarray, n_rows: int, ranks: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of each prefix shingle, how many shingles of its row come from it on, set size by row, l by row), prefix shingles sorted by row."""
    n = np.bincount(rows, minlength=n_rows).astype(np.int64)
    bucket = (hashes & np.uint64(len(ranks) - 1)).astype(np.int64)
    # the hashes of a row are sorted, so ties of the count stay in the order of their hash
    order = np.argsort(ranks[bucket], kind="stable")
    order = order[np.argsort(rows[order].astype(np.uint16) if n_rows <= 1 << 16 else rows[order], kind="stable")]
    first = np.cumsum(n) - n
    extra = np.concatenate([[0.0], np.cumsum(guess[bucket[order]] - 1.0)])
    base = n - _ceil_share(n, NUM, DEN)
    best, chosen = np.full(n_rows, np.inf), np.ones(n_rows, dtype=np.int64)
    for matches in range(1, MOST_MATCHES + 1):
        size = np.minimum(n, base + matches)
        others = extra[first + size] - extra[first]
        cost = size + others + VERIFY_COST * others / matches**2
        better = (cost < best) & (matches <= np.maximum(1, n - base))
        best[better], chosen[better] = cost[better], matches
    size = np.minimum(n, base + chosen)
    place = np.arange(len(order)) - np.repeat(first, n)
    kept = place < np.repeat(size, n)
    return order[kept], (np.repeat(n, n) - place)[kept], n, chosen


def _deal(size: int, counts: np.ndarray, ranges: int, hot: float):
    """Worker: prefix shingles of the sets that the task meets first, packed by range: (r, rows)."""
    guess = estimates(counts)
    ranks = count_ranks(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        kept: list[np.ndarray] = []
        waiting = 0

        def out() -> pa.RecordBatch:
            data = np.concatenate(kept)
            kept.clear()
            salts = np.maximum(1, np.ceil(guess[(data["t"] & np.uint64(len(guess) - 1)).astype(np.int64)] / hot)).astype(np.uint64)
            salt = mix(data["s"].view(np.uint64)) % salts
            r = ((mix(data["t"]) + salt) % np.uint64(ranges)).astype(np.int32)
            order = np.argsort(r.astype(np.uint16) if ranges <= 1 << 16 else r, kind="stable")
            data, r = data[order], r[order]
            cuts = np.flatnonzero(np.diff(r, prepend=-1))
            packed = [data[lo:hi].tobytes() for lo, hi in zip(cuts, np.append(cuts[1:], len(r)), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(r[cuts]), pa.array(packed, pa.binary())], names=["r", "rows"])

        for block in text_blocks(batches):
            hashes, rows = shingles(block, size)
            n, sig = signatures(hashes, rows, block.num_rows)
            fresh = _first_seen(sig, n, seen)[rows]
            hashes, rows = hashes[fresh], rows[fresh]
            if not len(hashes):
                continue
            at, left, n, matches = prefixes(hashes, rows, block.num_rows, ranks, guess)
            data = np.empty(len(at), dtype=_ROW)
            own = rows[at]
            data["t"], data["s"], data["n"], data["r"], data["l"] = hashes[at], sig[own], n[own], left, matches[own]
            kept.append(data)
            waiting += len(data)
            if waiting > 400_000:
                waiting = 0
                yield out()
        if kept:
            yield out()

    return run


PAIRS = "kind int, a long, b long, k int, l int"


def _pairs(counts: np.ndarray, hot: float):
    """Worker for one range: kind 0: pair (a, b) sharing k shingles, needing l; kind 1: star pair (hub a, set b); kind 2: list entry (shingle a, set b, its size k, how many of its shingles come from this one on in l); kind 3: set a has k entries in the range's lists before any is left out, for sets whose pairs can need more than one."""
    schema = arrow_schema(PAIRS)
    guess = estimates(counts)

    def rows_of(kind: int, a: np.ndarray, b: np.ndarray, k: np.ndarray, matches: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(a), 100_000):
            s = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a[s]), kind, np.int32)), pa.array(a[s].astype(np.int64)), pa.array(b[s].astype(np.int64)), pa.array(k[s].astype(np.int32)), pa.array(matches[s].astype(np.int32))], schema=schema)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(x for b in batches for x in b.column("rows").to_pylist()), dtype=_ROW)
        data = data[np.lexsort((data["s"], data["t"]))]
        same = (data["t"][1:] == data["t"][:-1]) & (data["s"][1:] == data["s"][:-1])
        data = data[np.concatenate([[True], ~same])]
        first = np.flatnonzero(np.concatenate([[True], data["t"][1:] != data["t"][:-1]]))
        sizes = np.diff(np.append(first, len(data)))
        salted = guess[(data["t"][first] & np.uint64(len(guess) - 1)).astype(np.int64)] > hot
        found = []
        for size in range(2, SMALL + 1):
            at = first[(sizes == size) & ~salted]
            found += [(at + i, at + j) for i in range(size) for j in range(i + 1, size)]
        if found:
            x, y = (data[np.concatenate(side)] for side in zip(*found, strict=True))
            near = _near(x["n"], y["n"])
            x, y = x[near], y[near]
            pair = np.empty(len(x), dtype=[("a", "<i8"), ("b", "<i8"), ("l", "u1")])
            pair["a"], pair["b"], pair["l"] = np.minimum(x["s"], y["s"]), np.maximum(x["s"], y["s"]), np.minimum(x["l"], y["l"])
            pair, k = np.unique(pair, return_counts=True)
            yield from rows_of(0, pair["a"], pair["b"], k, pair["l"])
        large = np.flatnonzero((sizes > SMALL) | salted)
        if len(large):
            group = np.repeat(np.arange(len(large)), sizes[large])
            listed = data[np.concatenate([np.arange(first[i], first[i] + sizes[i]) for i in large])]
            begin = np.cumsum(sizes[large]) - sizes[large]
            several, held = np.unique(listed["s"][listed["l"] > 1], return_counts=True)
            yield from rows_of(3, several, np.zeros(len(several)), held, np.zeros(len(several)))
            # an entry that has too few shingles left for even the smallest set of its list has no partner there
            least_n = np.minimum.reduceat(listed["n"], begin)[group].astype(np.int64)
            useful = salted[large][group] | (listed["r"].astype(np.int64) * (NUM + DEN) >= (listed["n"] + least_n) * NUM)
            useful &= salted[large][group] | (np.bincount(group[useful], minlength=len(large)) > 1)[group]
            entries = listed[useful]
            yield from rows_of(2, entries["t"].view(np.int64), entries["s"], entries["n"], entries["r"])
            # signatures are random numbers, so the least set of a list is the hub of most lists that it is in
            hub = begin[group]
            ok = (listed["s"][hub] != listed["s"]) & _near(listed["n"][hub], listed["n"]) & _enough(listed[hub], listed)
            pair = np.unique(np.stack([listed["s"][hub][ok], listed["s"][ok]], 1), axis=0)
            yield from rows_of(1, pair[:, 0], pair[:, 1], np.zeros(len(pair)), np.zeros(len(pair)))

    return run


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x, y).astype(np.int64) * DEN >= np.maximum(x, y).astype(np.int64) * NUM


def _enough(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the shingles from this one on could be as many as two similar sets share: at least NUM / (NUM + DEN) of both sizes together."""
    return np.minimum(x["r"], y["r"]).astype(np.int64) * (NUM + DEN) >= (x["n"].astype(np.int64) + y["n"]) * NUM


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Worker: the pairs (a, b) whose marks don't rule out that the sets are similar enough."""
    for batch in batches:
        n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        most = (n - 2 * _ceil_share(n, NUM, NUM + DEN)).tolist()
        ok = [differ_at_least(x, y) <= k for x, y, k in zip(batch.column("mark_a").to_pylist(), batch.column("mark_b").to_pylist(), most, strict=True)]
        kept = batch.filter(pa.array(ok, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


ALIKE = "hub long, own long"


def _list_pairs(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Worker for some blocks of lists: the pairs (hub, own) of a block that the sizes, what is left of both sets, and their marks don't rule out.

    A block (i, j) of a list compares its entries of parts i and j; a list of ordinary length is one block.
    """
    data = pa.Table.from_batches(batches).sort_by([("shingle", "ascending"), ("i", "ascending"), ("j", "ascending")])
    shingle, i, j, part, sig, n, left, component = (data.column(c).to_numpy() for c in ("shingle", "i", "j", "part", "sig", "n", "left", "component"))
    mark = data.column("mark").to_pylist()
    first = np.flatnonzero(np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
    found: set[tuple[int, int]] = set()
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(data)], strict=True):
        one, two = lo + np.flatnonzero(part[lo:hi] == i[lo]), lo + np.flatnonzero(part[lo:hi] == j[lo])
        for at in range(0, len(one), 256):
            x, y = one[at : at + 256, None], two[None, :]
            both = n[x].astype(np.int64) + n[y]
            ok = (component[x] != component[y]) & (np.minimum(n[x], n[y]).astype(np.int64) * DEN >= np.maximum(n[x], n[y]).astype(np.int64) * NUM)
            # the first shingle that two similar sets share has enough of both behind it
            ok &= np.minimum(left[x], left[y]).astype(np.int64) * (NUM + DEN) >= both * NUM
            ok &= (sig[x] < sig[y]) | (i[lo] != j[lo])
            a, b = np.nonzero(ok)
            most = both[a, b] - 2 * _ceil_share(both[a, b], NUM, NUM + DEN)
            for p, q, k in zip(x[a, 0].tolist(), two[b].tolist(), most.tolist(), strict=True):
                if differ_at_least(mark[p], mark[q]) <= k:
                    found.add((min(int(sig[p]), int(sig[q])), max(int(sig[p]), int(sig[q]))))
    hubs, owns = zip(*found, strict=True) if found else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(owns, pa.int64())], names=["hub", "own"])


def _verify(size: int):
    """Worker: the pairs (a, b) of texts whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for block in text_blocks([whole], "text_b"):
                # a hub's text comes often and is cut into shingles once
                _, first, same = np.unique(block.column("a").to_numpy(), return_index=True, return_inverse=True)
                (x, in_x), (y, in_y) = shingles(block.take(pa.array(first)), size, "text_a"), shingles(block, size, "text_b")
                at_x, at_y = np.searchsorted(in_x, np.arange(len(first) + 1)), np.searchsorted(in_y, np.arange(block.num_rows + 1))
                ok = np.zeros(block.num_rows, dtype=bool)
                for i, k in enumerate(same.tolist()):
                    one, two = x[at_x[k] : at_x[k + 1]], y[at_y[i] : at_y[i + 1]]
                    if len(one) and len(two):
                        shared = int((one[np.minimum(np.searchsorted(one, two), len(one) - 1)] == two).sum())
                        ok[i] = shared * DEN >= (len(one) + len(two) - shared) * NUM
                kept = block.filter(pa.array(ok))
                yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return run




class _Settler:
    """The components that the links found so far form, and the settling of candidate pairs."""

    def __init__(self, scratch: Scratch, docs: DataFrame, reps: DataFrame, marks_of: DataFrame):
        self.scratch, self.docs, self.reps, self.marks_of = scratch, docs, reps, marks_of
        self.texts: DataFrame | None = None
        self.found: DataFrame | None = None

    def with_component(self, rows: DataFrame, column: str) -> DataFrame:
        """rows, with the component of the set in a column as component_<column>."""
        if self.found is None:
            return rows.withColumn(f"component_{column}", F.col(column))
        return rows.join(self.found.select(F.col("id").alias(column), "component"), column, "left").withColumn(f"component_{column}", F.coalesce("component", column)).drop("component")

    def settle(self, candidates: DataFrame, turn: int, alike: DataFrame | None = None) -> None:
        """Verify candidates (hub, own) that lie in two components, until no such pair is left that isn't refuted. Those in `alike` have passed the marks.

        All are verified at once if they are few for each set; else a set's first hubs by a hash are verified,
        four times as many a round, and what they have joined is done.
        """
        scratch, most = self.scratch, 2
        side = lambda c, t: self.marks_of.select(F.col("sig").alias(c), F.col("n").alias(f"n_{t}"), F.col("mark").alias(f"mark_{t}"))
        marked = candidates.join(side("hub", "a"), "hub").join(side("own", "b"), "own")
        marked = marked.select(F.col("hub").alias("a"), F.col("own").alias("b"), "n_a", "n_b", "mark_a", "mark_b")
        passed = marked.mapInArrow(_alike, "a long, b long").select(F.col("a").alias("hub"), F.col("b").alias("own"))
        left = scratch.write(passed if alike is None else passed.unionByName(alike).distinct())
        fetched = False
        while True:
            n, owns = left.agg(F.count("*"), F.approx_count_distinct("own")).first()
            if not n:
                break
            if not fetched:
                self._fetch(left.select(F.col("hub").alias("sig")).distinct().unionByName(left.select(F.col("own").alias("sig")).distinct()).distinct())
                fetched = True
            all_ = n <= MANY * owns
            if all_:
                picked = left
            else:
                order = Window.partitionBy("own").orderBy(F.xxhash64("hub", F.lit(turn)), "hub")
                ranked = scratch.write(left.withColumn("k", F.row_number().over(order)))
                picked = ranked.where(F.col("k") <= most).select("hub", "own")
            text = lambda c, t: self.texts.select(F.col("sig").alias(c), F.col("text").alias(f"text_{t}"))
            pairs = picked.join(text("own", "b"), "own").join(text("hub", "a"), "hub")
            links = scratch.write(pairs.select(F.col("hub").alias("a"), F.col("own").alias("b"), "text_a", "text_b").mapInArrow(_verify(SHINGLE), "a long, b long"))
            edges = links if self.found is None else links.unionByName(self.found.select(F.col("id").alias("a"), F.col("component").alias("b")))
            self.found = components(self.docs.sparkSession, scratch, edges)
            scratch.drop(left)
            if all_:
                return
            rest = ranked.where(F.col("k") > most).select("hub", "own")
            left, most = scratch.write(self.with_component(self.with_component(rest, "hub"), "own").where("component_hub <> component_own").select("hub", "own")), most * 4
            scratch.drop(ranked)
        scratch.drop(left)

    def _fetch(self, needed: DataFrame) -> None:
        """Get the texts of sets that no earlier call got. The sets are written first, as three steps read them."""
        if self.texts is not None:
            needed = needed.join(self.texts.select("sig"), "sig", "left_anti")
        wanted = self.scratch.write(self.reps.join(needed, "sig", "left_semi"))
        more = self.scratch.write(_needed_texts(self.docs, wanted))
        self.texts = more if self.texts is None else self.texts.unionByName(more)
        self.scratch.drop(wanted)


def _classes(docs: DataFrame, scratch: Scratch, range_rows: int, hot: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sig, n) of every row, and (sig, rep, component) of every set that can be linked."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs = docs.count()
    bits = min(22, max(14, math.ceil(math.log2(max(n_docs, 2))) + 2))
    measured = scratch.write(docs.mapInArrow(_measure(bits, SHINGLE), MEASURED), "kind")
    sets = measured.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("sig"), "n")
    counts = np.zeros(1 << bits, dtype=np.int64)
    for r in measured.where("kind = 1").select("a", "data").groupBy("a").applyInArrow(_add_up, "a long, data binary").collect():
        part = np.frombuffer(r["data"], dtype=np.int64)
        counts[r["a"] * CHUNK : r["a"] * CHUNK + len(part)] = part
    total = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * (NUM / DEN)) + 2)).first()[0] or 0
    ranges = max(1, -(-int(total) // range_rows))
    reps = scratch.write(sets.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("rep")))

    dealt = docs.where("doc_id is not null").mapInArrow(_deal(SHINGLE, counts, ranges, hot), "r int, rows binary")
    found = scratch.write(dealt.groupBy("r").applyInArrow(_pairs(counts, hot), PAIRS), "kind")
    small = found.where("kind = 0").groupBy("a", "b").agg(F.sum("k").alias("k"), F.min("l").alias("l"))
    stars = found.where("kind = 1").select(F.col("a").alias("hub"), F.col("b").alias("own"))
    lists = found.where("kind = 2").select(F.col("a").alias("shingle"), F.col("b").alias("sig"), F.col("k").alias("n"), F.col("l").alias("left"), F.lit(None).cast("double").alias("before"))
    # a pair whose count falls short may share more in the lists, even by entries left out there, which are useful to a pair's first shared
    # shingle only: it is a candidate if both its sets had entries enough to make up for what is missing
    held = found.where("kind = 3").groupBy(F.col("a").alias("sig")).agg(F.sum("k").alias("held"))
    side = lambda c: held.select(F.col("sig").alias(c), F.col("held").alias(f"held_{c}"))
    short = small.where("k < l").join(side("a"), "a").join(side("b"), "b").where(F.col("k") + F.least("held_a", "held_b") >= F.col("l"))
    pairs = small.where("k >= l").select("a", "b").unionByName(short.select("a", "b"))
    candidates = scratch.write(pairs.select(F.col("a").alias("hub"), F.col("b").alias("own")).unionByName(stars).distinct())
    needed = candidates.select(F.explode(F.array("hub", "own")).alias("sig")).unionByName(lists.select("sig")).distinct()
    marked = measured.where("kind = 0 and data is not null").select(F.col("b").alias("sig"), "n", F.col("data").alias("mark"))
    marks_of = scratch.write(marked.join(needed, "sig", "left_semi").groupBy("sig").agg(F.first("n").alias("n"), F.first("mark").alias("mark")))
    settler = _Settler(scratch, docs, reps, marks_of)
    settler.settle(candidates, 0)
    turn = 0
    while True:
        turn += 1
        rest = settler.with_component(lists, "sig").withColumnRenamed("component_sig", "component")
        by_part = rest.groupBy("shingle", "component").agg(F.count("*").alias("n"), F.max("before").alias("before"))
        by_list = by_part.groupBy("shingle").agg(F.sum("n").alias("all"), F.sum(F.col("n").cast("double") * F.col("n")).alias("within"), F.max("before").alias("before"))
        open_ = scratch.write(by_list.select("shingle", "all", ((F.col("all").cast("double") * F.col("all") - F.col("within")) / 2).alias("cross"), "before").where("cross > 0"))
        cross = open_.agg(F.sum("cross")).first()[0]
        if not cross:
            break
        # hubs while they help; then, and where there is little left, all pairs
        hubbed = F.lit(cross > EACH * n_docs) & (F.col("cross") > FEW * F.col("all")) & (F.col("before").isNull() | (F.col("cross") <= PROGRESS * F.col("before")))
        rest = scratch.write(rest.drop("before").join(open_.select("shingle", "all", F.when(hubbed, F.col("cross")).alias("before")), "shingle"))
        fits = (F.least("x.n", "y.n") * DEN >= F.greatest("x.n", "y.n") * NUM) & (F.col("x.component") != F.col("y.component"))
        few, many = rest.where("before is null"), rest.where("before is not null")
        alike = _blocks(few, marks_of, cross).applyInArrow(_list_pairs, ALIKE)
        least = [F.min(F.struct(F.xxhash64("sig", F.lit(turn * HUBS + k)).alias("rank"), "sig", "n", "component")) for k in range(HUBS)]
        hubs = many.groupBy("shingle").agg(*[c.alias(f"h{k}") for k, c in enumerate(least)]).select("shingle", F.explode(F.array(*[F.col(f"h{k}") for k in range(HUBS)])).alias("h")).select("shingle", "h.sig", "h.n", "h.component").distinct()
        starred = many.alias("x").join(hubs.alias("y"), "shingle").where(fits).select(F.col("y.sig").alias("hub"), F.col("x.sig").alias("own"))
        settler.settle(starred.distinct(), turn, alike)
        lists = many.select("shingle", "sig", "n", "left", "before")
    named = reps if settler.found is None else reps.join(settler.found.select(F.col("id").alias("sig"), "component"), "sig", "left")
    named = scratch.write(named.select("sig", "rep", F.coalesce("component", "sig").alias("component") if settler.found is not None else F.col("sig").alias("component")))
    scratch.keep_only(measured, named)
    return sets, named


def _blocks(entries: DataFrame, marks_of: DataFrame, cross: float) -> GroupedData:
    """List entries with their marks, dealt to groups of blocks. Long lists are cut into parts, and each two parts are a block, so none is larger than two parts."""
    parts = F.ceil(F.col("all") / BLOCK).cast("int")
    rows = entries.join(marks_of.select("sig", "mark"), "sig").withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    groups = max(1, math.ceil(cross / GROUP_PAIRS))
    return rows.withColumn("g", F.pmod(F.xxhash64("shingle", "i", "j"), F.lit(groups)).cast("int")).select("g", "shingle", "i", "j", "part", "sig", "n", "left", "component", "mark").groupBy("g")


def classes(docs: DataFrame, scratch: Scratch | None = None, range_rows: int = RANGE_ROWS, hot: float | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs. Only bounded tables (the sketch, a bit filter, counts) reach the driver."""
    scratch = scratch or Scratch(docs.sparkSession)
    sets, named = _classes(docs, scratch, range_rows, hot or range_rows / 4.0)
    least = scratch.write(named.groupBy("component").agg(F.min("rep").alias("component_id")))
    of_sets = scratch.write(named.join(least, "component").select("sig", "component_id"))
    scratch.drop(named)
    scratch.drop(least)
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return sets.join(of_sets, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


#: Names of the columns that keep_one adds on the way.
_SIG, _KEY = "__quillwork_sig", "__quillwork_key"


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, without the copies: of each class one row stays, the smallest id's.

    Rows with a null id and rows without words stay. Of rows of one class that share its smallest id one stays,
    the one of the set with the smallest signature. Rows that repeat an id but aren't alike both stay. Only rows
    whose id passes a bit filter of the ids to be dropped are shuffled; the others go straight on.
    """
    scratch = Scratch(docs.sparkSession)
    sets, named = _classes(docs, scratch, RANGE_ROWS, RANGE_ROWS / 4.0)
    best = named.groupBy("component").agg(F.min(F.struct("rep", "sig")).alias("best")).select("component", F.col("best.rep").alias("stays"), F.col("best.sig").alias("stays_sig"))
    judged = named.join(best, "component").select("sig", "stays", (F.col("sig") == F.col("stays_sig")).alias("own"))
    rows = sets.where("n > 0 and doc_id is not null").groupBy("doc_id", "sig").agg(F.count("*").alias("copies"))
    rows = rows.join(judged, "sig").select("doc_id", "sig", "copies", (F.col("own") & (F.col("doc_id") == F.col("stays"))).alias("keep"))
    doubted = scratch.write(rows.where("not keep or copies > 1"))
    dropped = scratch.write(doubted.select("doc_id").distinct())
    scratch.keep_only(doubted, dropped)
    place, hit = _bit_filter(dropped, "doc_id")
    out = docs.withColumn(_KEY, place(F.col("doc_id").cast("long")))
    schema = T.StructType([*out.schema.fields, T.StructField(_SIG, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(hit(batch.column(_KEY))))
            for block in text_blocks([some]):
                _, sig = signatures(*shingles(block, SHINGLE), block.num_rows)
                yield block.append_column(_SIG, pa.array(sig))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~hit(batch.column(_KEY))))

    clear = out.mapInArrow(rest, out.schema).select(docs.columns)
    asked = out.mapInArrow(run, schema).withColumn(_KEY, F.col("doc_id").cast("long"))
    verdict = doubted.select(F.col("doc_id").alias(_KEY), F.col("sig").alias(_SIG), "keep", "copies").select(_KEY, _SIG, F.struct("keep", "copies").alias("__quillwork_verdict"))
    asked = asked.join(verdict, [_KEY, _SIG], "left")
    first = F.row_number().over(Window.partitionBy(_KEY, _SIG).orderBy("text"))
    single = asked.where("__quillwork_verdict is null")
    repeated = asked.where("__quillwork_verdict.keep").withColumn("__quillwork_k", first).where("__quillwork_k = 1")
    return clear.unionByName(single.select(docs.columns)).unionByName(repeated.select(docs.columns))


def _bit_filter(ids: DataFrame, column: str) -> tuple[Callable[[Column], Column], Callable[[pa.Array], np.ndarray]]:
    """(bit number of an id, test of bit numbers): ids pass, and others seldom. The filter has 16 bits an id, up to 16 MB; when crowded it lets more pass."""
    bits = 1 << min(27, max(12, math.ceil(math.log2(16 * max(ids.count(), 1)))))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = ids.select(place(F.col(column)).alias("p")).selectExpr("cast(shiftright(p, 5) as int) as w", "shiftleft(1L, cast(p % 32 as int)) as v").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    mask = np.zeros(bits // 32, dtype=np.uint32)
    mask[words.column("w").to_numpy()] = words.column("v").to_numpy()

    def hit(places: pa.Array) -> np.ndarray:
        at = places.to_numpy(zero_copy_only=False)
        return (mask[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1

    return place, hit


def _needed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, text) of one document for each wanted set (sig, rep). A bit filter keeps most other texts out of the shuffle."""
    place, hit = _bit_filter(wanted, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks([batch.filter(pa.array(hit(batch.column("place"))))]):
                hashes, rows = shingles(block, SHINGLE)
                _, sig = signatures(hashes, rows, block.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(sig), block.column("text")], names=["sig", "text"])

    placed = docs.where("doc_id is not null and text is not null").select("text", place(F.col("doc_id")).alias("place"))
    passed = placed.mapInArrow(run, "sig long, text string")
    return passed.join(wanted.select("sig"), "sig", "left_semi").groupBy("sig").agg(F.first("text").alias("text"))
