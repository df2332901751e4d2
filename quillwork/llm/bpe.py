"""BPE encoding and decoding by batched numpy merge rounds.

A block of texts becomes one array of code points. Words are cut by character classes, equal words are
found by hash and kept once, and all of them lie in one flat array of symbols. Each round looks up the
ranks of changed neighbour pairs by binary search over the sorted pair keys, takes each word's lowest rank,
and joins all its pairs of that rank at once; finished words leave the batch. Two published vocabulary
formats are read from a file whose path is a parameter: byte-level words with a leading blank, and
lower-cased words with an end-of-word mark. Nothing is trained.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import span_hashes, text_blocks, texts

#: Text bytes that one batch of merge rounds handles.
BATCH_BYTES = 2 << 20
#: About how many merged words a worker remembers.
MEMORY_WORDS = 300_000
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(0x110000, dtype=np.uint8)
    first = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x3400)])) + "".join(map(chr, range(0x3400, 0xD800)))
    for c in dict.fromkeys(first + "".join(map(chr, range(0xE000, 0x33480))) + "".join(map(chr, range(0xE0000, 0xE0200)))):
        kind = unicodedata.category(c)[0]
        if kind in "LN":
            out[ord(c)] = LETTER if kind == "L" else NUMBER
    out[WHITE_SPACE] = SPACE
    return out


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + sizes[i]] for all i, one after the other."""
    total = int(sizes.sum())
    if not total:
        return flat[:0]
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    at += np.arange(total)
    return flat[at]


class Tokenizer:
    """An encoder and decoder from the content of a vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.lower = bool(spec.get("normalizer"))
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces: list[bytes] = [b""] * size
        for token, i in vocab.items():
            end = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            pieces[i] = bytes(letters[c] for c in (token[: -len(self.suffix)] if end else token)) + b" " * end
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.pieces = pieces
        self.piece_sizes = np.fromiter(map(len, pieces), np.int64, size)
        self.piece_starts = np.concatenate([[0], np.cumsum(self.piece_sizes)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.start, self.last = np.zeros(256, dtype=np.int64), np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.start[b], self.last[b] = vocab[letter], vocab[letter + self.suffix]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.fromiter(((vocab[a] << 32) | vocab[b] for a, b in merges), np.int64, len(merges))
        self.joined = np.fromiter((vocab[a + b] for a, b in merges), np.int64, len(merges))
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.memory = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    # ------------------------------------------------------------ words

    def _segments(self, batch: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The texts cut at special tokens, each segment's text, and the special id that a segment is, or -1."""
        parts, owner, special = [], [], []
        for k, text in enumerate(batch):
            for s in self.cut_special.split(text) if self.cut_special and "<|" in text else (text,):
                i = self.special.get(s, -1) if s.startswith("<|") else -1
                if self.lower and i < 0:
                    if not s.isascii():
                        s = unicodedata.normalize("NFC", s).replace("Σ", "σ")
                    s = s.lower()
                parts.append("" if i >= 0 else s)
                owner.append(k)
                special.append(i)
        return parts, np.array(owner, dtype=np.int64), np.array(special, dtype=np.int64)

    def _words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """UTF-8 bytes of all parts, and each word's start, end and part."""
        joined = "".join(parts)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        n = len(codes)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        kind = char_classes()[codes]
        fresh = np.zeros(n + 1, dtype=bool)  # where a part begins
        fresh[0] = True
        fresh[ends] = True
        edge = fresh.copy()
        edge[1:n] |= kind[1:] != kind[:-1]
        begin = edge[:n].copy()
        space = kind == SPACE
        if self.lower:
            begin |= kind == NUMBER
        else:
            tail = space & edge[1:]  # the last blank of a run
            tail &= ~fresh[1:]  # with something behind it
            begin |= tail
            joins = np.flatnonzero(tail & (codes == 32)) + 1
            begin[joins] = False  # the blank belongs to the word behind it
        self._contractions(codes, kind, fresh, begin)
        starts = np.flatnonzero(begin)
        stops = np.append(starts[1:], n)
        if self.lower:
            real = ~space[starts]
            starts, stops = starts[real], stops[real]
        part = np.searchsorted(ends, starts, side="right")
        size = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        place = np.concatenate([[0], np.cumsum(size)])
        return np.frombuffer(joined.encode("utf-8"), dtype=np.uint8), place[starts], place[stops], part

    def _contractions(self, codes: np.ndarray, kind: np.ndarray, fresh: np.ndarray, begin: np.ndarray) -> None:
        """'s 't 'm 'd 're 've 'll are words of their own where the apostrophe begins a word; what follows begins another."""
        n = len(codes)
        for i in np.flatnonzero((codes[:-1] == 39) & begin[:-1] & (kind[1:] == LETTER)).tolist():
            tail = "".join(map(chr, codes[i + 1 : i + 3]))
            k = 2 if tail[0] in "stmd" else 3 if tail in ("re", "ve", "ll") else 0
            if not k or fresh[i + 1 : i + k].any():
                continue
            begin[i + 1 : i + k] = False
            if i + k < n and kind[i + k] == LETTER:
                begin[i + k] = True

    # ------------------------------------------------------------ merging

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], len(self.joined))

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one array, count for each word): merge rounds over the words' bytes."""
        none, n = len(self.joined), len(sizes)
        bytes_ = gather(data, starts, sizes)
        symbols, owner = self.start[bytes_], np.repeat(np.arange(n), sizes)
        final = np.cumsum(sizes) - 1
        symbols[final] = self.last[bytes_[final]]
        rank = np.full(len(symbols), none, dtype=np.int64)
        inner = np.ones(len(symbols), dtype=bool)
        inner[final] = False
        at = np.flatnonzero(inner)
        if len(at):
            rank[at] = self._rank(symbols[at], symbols[at + 1])
        done_ids, done_owner = [], []
        while len(symbols):
            new = np.ones(len(owner), dtype=bool)
            new[1:] = owner[1:] != owner[:-1]
            first = np.flatnonzero(new)
            low = np.minimum.reduceat(rank, first)
            width = np.diff(np.append(first, len(owner)))
            least = np.repeat(low, width)
            over = least == none
            if over.any():
                done_ids.append(symbols[over])
                done_owner.append(owner[over])
                stay = ~over
                symbols, owner, rank, least = symbols[stay], owner[stay], rank[stay], least[stay]
                if not len(symbols):
                    break
            hit = rank == least
            # of pairs that overlap, as in "aaa", every second one from the left counts
            run = hit[1:] & hit[:-1] & (owner[1:] == owner[:-1])
            if run.any():
                again = np.concatenate([[False], run])
                index = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~again, index, 0))
                hit &= (index - begin) % 2 == 0
            to = np.flatnonzero(hit)
            symbols[to] = self.joined[rank[to]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[to + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            to = place[to]
            touched = np.zeros(len(symbols), dtype=bool)
            touched[to] = True
            touched[to[to > 0] - 1] = True
            changed = np.flatnonzero(touched)
            last = changed == len(symbols) - 1
            behind = np.where(last, changed, changed + 1)
            linked = ~last & (owner[behind] == owner[changed])
            rank[changed[~linked]] = none
            changed = changed[linked]
            rank[changed] = self._rank(symbols[changed], symbols[changed + 1])
        ids, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_ids, done_owner))
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=n)

    def _known(self, words: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start and count for each word): words met before come from a bounded memory, the others are merged."""
        hashes, begins, counts, ids = self.memory
        at = np.minimum(np.searchsorted(hashes, words), max(len(hashes) - 1, 0))
        old = hashes[at] == words if len(hashes) else np.zeros(len(words), bool)
        new = np.flatnonzero(~old)
        fresh, n = self.merge(data, starts[new], sizes[new])
        pool = np.concatenate([ids, fresh])
        begin, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        begin[old], count[old] = begins[at[old]], counts[at[old]]
        begin[new], count[new] = len(ids) + np.cumsum(n) - n, n
        if len(hashes) < MEMORY_WORDS:
            all_hashes = np.concatenate([hashes, words[new]])
            order = np.argsort(all_hashes, kind="stable")
            self.memory = (all_hashes[order], np.concatenate([begins, begin[new]])[order], np.concatenate([counts, n])[order], pool)
        return pool, begin, count

    def encode_batch(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizers library gives them without added special tokens."""
        parts, owner, special = self._segments(batch)
        if not any(parts):
            flat, per_part = np.zeros(0, np.int64), np.zeros(len(parts), np.int64)
        else:
            data, starts, stops, part = self._words(parts)
            hashes = span_hashes(data, starts, stops)
            words, which, back = np.unique(hashes, return_index=True, return_inverse=True)
            pool, begins, counts = self._known(words, data, starts[which], (stops - starts)[which])
            sizes = counts[back]
            flat = gather(pool, begins[back], sizes)
            per_part = np.bincount(part, sizes, len(parts)).astype(np.int64)
        if (special >= 0).any():
            begins = np.concatenate([[0], np.cumsum(per_part)[:-1]])
            marked = np.flatnonzero(special >= 0)
            flat = np.insert(flat, begins[marked], special[marked])
            per_part[marked] = 1
        per_text = np.bincount(owner, per_part, len(batch)).astype(np.int64)
        return np.split(flat.astype(np.uint32), np.cumsum(per_text)[:-1]) if batch else []

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return gather(self.piece_bytes, self.piece_starts[ids], self.piece_sizes[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 give U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _byte_letters() -> dict[str, int]:
    """The printable letter that these vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


@lru_cache(maxsize=2)
def tokenizer(content: str) -> Tokenizer:
    """One tokenizer for each vocabulary and worker."""
    return Tokenizer(content)


def vocabulary_content(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int), decoded for every row: each whole text encoded and decoded again. Null texts are empty; repeated rows stay."""
    content = vocabulary_content(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(content)
        for block in text_blocks(batches, limit=BATCH_BYTES):
            ids = tok.encode_batch(texts(block))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([tok.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row, made beside the encoder so that ids needn't leave the worker."""
    content = vocabulary_content(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(content)
        decimal = [b"%d," % i for i in range(len(tok.pieces))]
        sizes = np.fromiter(map(len, decimal), np.int64, len(decimal))
        starts, flat = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.frombuffer(b"".join(decimal), dtype=np.uint8)
        for block in text_blocks(batches, limit=BATCH_BYTES):
            n, one, two = [], [], []
            for ids in tok.encode_batch(texts(block)):
                n.append(len(ids))
                one.append(hashlib.sha256(gather(flat, starts[ids], sizes[ids]).tobytes()[:-1]).hexdigest())
                two.append(hashlib.sha256(tok.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
