"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are n-grams of 2 to 4 over the lower-cased letters of a text, where each run of other characters
is one word edge. A text's vector is the mean of its subwords' embeddings, so its logits are a mean of
per-bucket logits. They are calibrated by a temperature on rows kept from training. A text without a letter
is rejected as `und`, and, if asked, one whose best probability is below a calibrated limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LETTER, char_classes
from .common import held_out, text_blocks, texts, unit_hash

BITS = 14
DIM = 16
#: Most training documents of one language.
SAMPLE = 1_000
#: Of a training document the driver gets so many passages of so many words of so many letters at most.
PASSAGES, PASSAGE_WORDS, MOST_LETTERS = 8, 60, 64
#: Share of the known-language documents that calibration lets the rejection turn away.
REJECTS = 0.001
UNKNOWN = "und"
_FACTOR, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def subwords(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of text) of every subword of the texts."""
    lowered = [t.lower() for t in batch]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in lowered), np.int64, len(batch)))
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = char_classes()[codes] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character behind a word is its edge
    at = np.flatnonzero(keep)
    codes, letter = np.where(letter, codes, 0)[at].astype(np.uint64), letter[at]
    owner = np.searchsorted(ends, at, side="right")
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, letter, owner = np.append(np.uint64(0), codes), np.append(False, letter), np.append(owner[:1], owner)
    out, rows = [], []
    for n in (2, 3, 4):
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h, inner = np.full(m, n, dtype=np.uint64), np.ones(m, dtype=bool)
        for k in range(n):
            h *= _FACTOR
            h += codes[k : k + m]
            if 0 < k < n - 1:
                inner &= letter[k : k + m]
        inner &= letter[:m] | letter[1 : m + 1]
        out.append(((h[inner] * _SPREAD) >> np.uint64(64 - BITS)).astype(np.int32))
        rows.append(owner[1 : m + 1][inner].astype(np.int32))
    return np.concatenate(out), np.concatenate(rows)


@dataclass
class Model:
    """shares: for each bucket its logits (embedding times weights); bias, temperature and limit of rejection."""

    langs: list[str]
    shares: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    limit: float = 0.0

    def logits(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean logits of whole texts, and their number of subwords."""
        bucket, row = subwords(batch)
        counts = np.bincount(row, minlength=len(batch))
        sums = np.stack([np.bincount(row, share[bucket], len(batch)) for share in self.shares.T.copy()], axis=1)
        return sums / np.maximum(counts, 1)[:, None] + self.bias, counts

    def probabilities(self, z: np.ndarray) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / self.temperature)
        return e / e.sum(1, keepdims=True)

    def judge(self, batch: list[str], reject: bool) -> tuple[list[str], list[float]]:
        z, counts = self.logits(batch)
        p = self.probabilities(z)
        best = p.max(1)
        known = (counts > 0) & ((best >= self.limit) | (not reject))
        langs = [self.langs[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1).tolist(), known.tolist(), strict=True)]
        return langs, np.where(counts > 0, best, 0.0).tolist()


def train(rows: list[tuple[str, str]], epochs: int = 4, seed: int = 7, rate: float = 0.5, passages: int = 10_000) -> Model:
    """A model from (text, lang) rows: embeddings and softmax weights by minibatch SGD over about so many passages of 6 to 60 words, as many from each row.

    A fifth of the rows is kept apart for the temperature and the limit. One language alone is allowed.
    """
    langs = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    where = {lang: i for i, lang in enumerate(langs)}
    order = rng.permutation(len(rows)).tolist()
    kept = set(order[: len(rows) // 5]) if len(rows) >= 20 else set()
    parts, ys, each = [], [], -(-passages // max(1, len(rows)))
    for i, (text, lang) in enumerate(rows):
        words = text.split()
        for _ in range(each if i not in kept and words else 0):
            n = int(rng.integers(6, 61))
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            parts.append(" ".join(words[at : at + n]))
            ys.append(where[lang])
    bucket, row = subwords(parts)
    order = np.argsort(row, kind="stable")
    bucket, row = bucket[order], row[order]
    edges = np.searchsorted(row, np.arange(len(parts) + 1))
    some, ys = np.flatnonzero(np.diff(edges)), np.array(ys, dtype=np.int64)
    emb = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    weights, bias, batch, step = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32), 32, 0
    total = max(1, epochs * -(-len(some) // batch))
    for _ in range(epochs):
        rng.shuffle(some)
        for lo in range(0, len(some), batch):
            ids = some[lo : lo + batch]
            flat = np.concatenate([bucket[edges[i] : edges[i + 1]] for i in ids])
            sizes = edges[ids + 1] - edges[ids]
            mean = np.add.reduceat(emb[flat], np.cumsum(sizes) - sizes) / sizes[:, None]
            z = mean @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(ids)), ys[ids]] -= 1
            pace = rate * (1 - step / total) / len(ids)
            back = np.repeat((p @ weights.T) / sizes[:, None], sizes, 0)
            weights -= pace * (mean.T @ p)
            bias -= pace * p.sum(0)
            turn = np.argsort(flat, kind="stable")
            flat = flat[turn]
            first = np.flatnonzero(np.diff(flat, prepend=-1))
            emb[flat[first]] -= (32 * pace * np.add.reduceat(back[turn], first)).astype(np.float32)
            step += 1
    model = Model(langs, (emb @ weights).astype(np.float32), bias.astype(np.float64))
    check = [rows[i] for i in sorted(kept)] or rows
    z, counts = model.logits([t for t, _ in check])
    has = counts > 0
    if has.any():
        truth = np.array([where[lang] for _, lang in check])[has]

        def loss(t: float) -> float:
            model.temperature = t
            return float(-np.log(model.probabilities(z[has])[np.arange(len(truth)), truth] + 1e-12).mean())

        model.temperature = min((float(t) for t in np.geomspace(0.05, 5, 41)), key=loss)
        best = np.sort(model.probabilities(z[has]).max(1))
        even = 1.0 / len(langs)
        model.limit = float(min(best[int(REJECTS * len(best))] * 0.8, even + 0.25 * (1 - even)))
    return model


def _passages(text: str) -> str:
    """What training sees of a text: all of it, or of a long one PASSAGES stretches of PASSAGE_WORDS words from its whole length."""
    words = text.split()
    if len(words) <= PASSAGES * PASSAGE_WORDS:
        return " ".join(w[:MOST_LETTERS] for w in words)
    step = (len(words) - PASSAGE_WORDS) / (PASSAGES - 1)
    return " ".join(w[:MOST_LETTERS] for k in range(PASSAGES) for w in words[int(k * step) : int(k * step) + PASSAGE_WORDS])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from text and non-null lang of the rows that are not held out; at most about `sample` documents a language, chosen by a hash of the id. None without such rows."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))]), F.col("lang"))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            yield block.set_column(1, "text", pa.array([_passages(t) for t in texts(block)], pa.string()))

    picked = rows.where(unit_hash(F.col("doc_id"), seed=5) < share).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInArrow(passages, "doc_id long, text string, lang string").collect()
    return train([(r["text"], r["lang"]) for r in sorted(picked, key=lambda r: (r["doc_id"], r["text"], r["lang"]))])


def identify(docs: DataFrame, model: Model | None, reject: bool = True) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs, whole texts.

    `und` with score 0 for null texts and texts without a letter; with reject also for texts whose best
    probability is below the calibrated limit (their score stays). Without any model all rows are `und`.
    Repeated rows are judged one by one, a null id is kept, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            langs, scores = model.judge(texts(block), reject) if model else ([UNKNOWN] * block.num_rows, [0.0] * block.num_rows)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, all their columns, that the model doesn't reject. Without any model no row can be identified and all rows stay.

    Null texts and texts without a letter go; repeated rows are judged one by one, null ids are kept.
    """
    if model is None:
        return docs
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            yield block.filter(pa.array([x != UNKNOWN for x in model.judge(texts(block), True)[0]], pa.bool_()))

    return docs.mapInArrow(run, schema)
