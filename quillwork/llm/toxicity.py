"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding undoes disguises word by word: compatibility forms, homoglyphs of other scripts, digits and signs
standing for letters, letters set apart by dots or hyphens. The lexicon holds a few seed words and the
words and word stems that the labelled training rows show to be toxic. Matches inside exception phrases
don't count. What a text scores depends on its text alone.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, held_out, text_blocks, texts, unit_hash

#: Seed words, with the weight that they have before any labels are seen.
SEEDS = {w: 3.0 for w in ("idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "imbecile", "bastard", "vermin", "dumbass")} | {"clown": 2.0, "trash": 2.0}
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "rodeo clown", "sore loser", "pond scum", "soap scum")
#: Letters of other scripts and their look-alikes.
HOMOGLYPHS = dict(zip("абвгеёикмнорстухіїјѕԁһӏαβεικνορτυχωℓıøđł", "abbreeukmhopctyxiijsdhlabeikvoptuxwliodl", strict=True))
#: Digits and signs that stand for letters inside a word.
DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"})
#: Most labelled rows of each kind that a lexicon is fitted on.
SAMPLE = 8_000
#: Most learned terms of a lexicon, and the terms, in the order of their gain, that are looked through for them.
LEXICON_SIZE, LOOKED_THROUGH = 2_000, 16_000

_PLAIN = re.compile(r"[a-z]+\Z")
_SIGNS = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])")
_INNER = re.compile(r"(?:[^\W_][.\-_*·]){2,}[^\W_]\Z")
_UNSEEN = str.maketrans(dict.fromkeys("\u200b\u200c\u200d\u2060\ufeff\u00ad"))
_ALIKE = str.maketrans(HOMOGLYPHS)
_LATIN = re.compile("[a-z]")
_AROUND = ".,;:!?\"'()[]{}*#%$&-_|"
_STEMS = range(4, 9)


def fold_word(word: str) -> str:
    """One whitespace-free word without its disguises; pieces around punctuation are set apart by blanks."""
    if _PLAIN.match(word):
        return word
    core = unicodedata.normalize("NFKC", word).lower().translate(_UNSEEN).strip(_AROUND)
    if _LATIN.search(core):  # a word wholly in another script is no disguise
        core = core.translate(_ALIKE)
    core = _SIGNS.sub(lambda m: m[0].translate(DIGITS), core)
    if any(c.isdigit() for c in core) and any(c.isalpha() for c in core):
        core = core.translate(DIGITS)
    if _INNER.match(core):
        core = re.sub(r"[.\-_*·]", "", core)
    return " ".join(re.findall(r"[^\W_]+", core))


class Folder:
    """Folds texts; remembers the words it has seen, within a bound."""

    def __init__(self, bound: int = 200_000):
        self.known: dict[str, str] = {}
        self.bound = bound

    def __call__(self, text: str) -> str:
        known, words = self.known, text.split()
        if len(known) > self.bound:
            known.clear()
        for w in set(words).difference(known):
            known[w] = fold_word(w)
        return f" {' '.join(map(known.__getitem__, words))} "


@dataclass
class Lexicon:
    """terms: ' word ' or ' stem' to weight. a, b, c: the calibration of count and density."""

    terms: dict[str, float] = field(default_factory=lambda: {f" {w} ": x for w, x in SEEDS.items()})
    exceptions: tuple[str, ...] = EXCEPTIONS
    coef: tuple[float, float, float] = (-2.0, 2.0, 1.0)

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            out.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            key = f" {phrase} "
            out.add_word(key, (len(key), None))
        out.make_automaton()
        return out


def measure(automaton, folded: str) -> tuple[float, int]:
    """Summed weight of the matches outside exception phrases, and their number. A word counts once, at its highest weight."""
    found = list(automaton.iter(folded))
    if not found:
        return 0.0, 0
    safe = sorted((end - n + 1, end) for end, (n, weight) in found if weight is None)
    begins, reach = [lo for lo, _ in safe], list(accumulate((hi for _, hi in safe), max))
    best: dict[int, float] = {}
    for end, (n, weight) in found:
        at = end - n + 1
        # of the phrases that begin here or before, the one that reaches furthest
        k = bisect.bisect_right(begins, at)
        if weight is not None and not (k and end <= reach[k - 1]):
            best[at] = max(best.get(at, 0.0), weight)
    return sum(best.values()), len(best)


def features(total: float, n_words: int) -> tuple[float, float]:
    """What the score is made of: summed weight, and weight per 1,000 words of a length smoothed by 20."""
    return math.log1p(total), math.log1p(1000.0 * total / (n_words + 20.0))


def score(total: float, n_words: int, coef: tuple[float, float, float]) -> float:
    x, y = features(total, n_words)
    z = coef[0] + coef[1] * x + coef[2] * y
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _terms_of(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in _STEMS if k <= len(w))
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    folder, schema = Folder(), arrow_schema("term string, pos long, neg long")
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}

    def out() -> pa.RecordBatch:
        terms = list(counts[True].keys() | counts[False].keys())
        batch = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[True][t] for t in terms], pa.int64()), pa.array([counts[False][t] for t in terms], pa.int64())], schema=schema)
        counts[True].clear()
        counts[False].clear()
        return batch

    for block in text_blocks(batches):
        for text, toxic in zip(texts(block), block.column("toxic").to_pylist(), strict=True):
            counts[toxic == 1].update(_terms_of(folder(text)))
        if len(counts[True]) + len(counts[False]) > 200_000:
            yield out()
    yield out()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = LEXICON_SIZE) -> Lexicon:
    """Learn a lexicon and its calibration from labelled rows that are not held out.

    Uses at most about `sample` toxic and `sample` clean documents, chosen by a hash of their id. A term
    enters if so many toxic rows with it, and so few clean ones, are no chance find among all the terms; `size`
    is the most learned terms that the model has, the strongest ones.
    Rows whose label or id is null, and ids labelled both ways, are not used. Where no documents of both kinds are
    left, as in an empty table, the seed words judge with the weights that they come with.
    """
    labels = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high").drop("high")
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return Lexicon()
    share = F.when(F.col("toxic") == 1, min(1.0, sample / pos)).otherwise(min(1.0, sample / neg))
    picked = labels.where(unit_hash(F.col("doc_id"), seed=2) < share)
    # the picked ids are bounded by the sample, so they go to the texts and no text is shuffled
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
    used_pos, used_neg = min(pos, sample), min(neg, sample)
    counted = rows.mapInArrow(_count_terms, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # how unlikely pos of pos + neg is where the rows with a term are drawn alike: log ratio of likelihoods
    rate = used_pos / (used_pos + used_neg)
    df, hit = F.col("pos") + F.col("neg"), F.col("pos")
    share_hit = hit / df
    gain = hit * F.log(share_hit / rate) + F.when(F.col("neg") > 0, F.col("neg") * F.log((F.col("neg") / df) / (1 - rate))).otherwise(0.0)
    strong = counted.where((hit >= 2) & (share_hit > 0.7)).withColumn("gain", gain).where(F.col("gain") > 7.0).orderBy(F.desc("gain"), F.desc(F.length("term")), "term").limit(LOOKED_THROUGH).collect()
    total = max(len(strong), 1)
    terms: dict[str, float] = {f" {w} ": x for w, x in SEEDS.items()}
    heads: set[str] = set()
    for r in strong:
        # as rare terms abound, one with a gain of g passes by chance about exp(-g) times as often as there are terms
        if r["gain"] < math.log(50 * total) or len(heads) >= size:
            continue
        if any(r["term"][:k] in heads for k in range(2, len(r["term"]) + 1)):
            continue
        heads.add(r["term"])
        terms[r["term"]] = max(terms.get(r["term"], 0.0), min(6.0, math.log((r["pos"] + 0.5) / used_pos) - math.log((r["neg"] + 0.5) / used_neg)))
    lexicon = Lexicon(terms)
    measured = rows.mapInArrow(_measurer(lexicon, ["toxic"]), "toxic long, total double, n_words long").groupBy("toxic", F.round("total", 1).alias("total"), (F.round(F.log1p("n_words") * 20) / 20).alias("words")).agg(F.count("*").alias("n")).collect()
    if {r["toxic"] for r in measured} != {0, 1}:  # labels of both kinds, but not of these documents
        return lexicon
    lexicon.coef = _calibrate([(features(r["total"], math.expm1(r["words"])), float(r["toxic"]), r["n"]) for r in measured])
    return lexicon


def _calibrate(rows: list[tuple[tuple[float, float], float, int]]) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with classes weighed alike and a light ridge; no slope may be negative."""
    x = np.array([(1.0, *f) for f, _, _ in rows])
    y, w = np.array([t for _, t, _ in rows]), np.array([float(n) for _, _, n in rows])
    for t in (0.0, 1.0):
        w[y == t] *= 500.0 / max(w[y == t].sum(), 1.0)
    use = [0, 1, 2]
    while True:
        beta, xs = np.zeros(len(use)), x[:, use]
        for _ in range(60):
            p = 1.0 / (1.0 + np.exp(-np.clip(xs @ beta, -30, 30)))
            ridge = 0.05 * np.array([i > 0 for i in range(len(use))])
            step = np.linalg.solve((xs * (w * p * (1 - p))[:, None]).T @ xs + np.diag(ridge + 1e-9), xs.T @ (w * (y - p)) - ridge * beta)
            beta += np.clip(step, -4, 4)
        low = [u for u, b in zip(use, beta, strict=True) if u and b < 0]
        if not low or len(use) == 1:
            break
        use = [u for u in use if u not in low]
    out = [0.0, 0.0, 0.0]
    for u, b in zip(use, beta, strict=True):
        out[u] = float(b)
    return tuple(out)


def _measurer(lexicon: Lexicon, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, folder = lexicon.automaton(), Folder()
        for block in text_blocks(batches):
            sums, sizes = [], []
            for text in texts(block):
                folded = folder(text)
                sums.append(measure(automaton, folded)[0])
                sizes.append(folded.count(" "))
            yield pa.RecordBatch.from_arrays([*(block.column(k).cast(pa.int64()) for k in keep), pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())], names=[*keep, "total", "n_words"])

    return run


def score_documents(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on), for every row of docs.

    Null and empty texts score as texts without matches. Repeated rows are scored one by one, a null id is
    kept, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = _measurer(lexicon, ["doc_id"])
        for b in measurer(batches):
            values = np.array([score(t, n, lexicon.coef) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)], dtype=float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values), pa.array((values >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all their columns, whose text is not toxic. Texts are judged row by row, without a join.

    Null and empty texts score as texts without matches; repeated rows and null ids are judged like any row.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, folder = lexicon.automaton(), Folder()
        for block in text_blocks(batches):
            mask = []
            for text in texts(block):
                folded = folder(text)
                mask.append(score(measure(automaton, folded)[0], folded.count(" "), lexicon.coef) < threshold)
            yield block.filter(pa.array(mask))

    return docs.mapInArrow(run, schema)
