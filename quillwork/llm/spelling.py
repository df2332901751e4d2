"""Spelling variants: words at one edit from each other, found by the parity of their letters.

A word's mask has one bit a letter: whether it occurs an odd number of times. One inserted or deleted code point
flips one bit, one replaced flips none or two. So of three bands of the mask at least one is the same in two near
words. Words are joined on an equal band, with a length filter and the masks' distance in the join itself, and what
is left is verified. As the edit lies in one half of a word, two near words also share the first or the last half;
that half is part of the join's key, so a band that a third of all words have in common falls apart into small groups.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, text_blocks

#: Shortest words, least occurrences, and how many times a word's count its form's must be.
SHORTEST, LEAST, TIMES = 6, 5, 5
#: One of so many different (document, word) pairs loses a code point.
MISSPELT = 199
#: Letters in the order in which they are dealt to the bands, so that frequent ones are spread; others share seven more bits.
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
BAND_BITS = 11
#: Distinct words that a worker counts before it hands them on, and the text length from which matches are not listed at once.
HELD, LONG = 200_000, 4_000_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def misspelt(word: str, prefix: int) -> str:
    """The word as it is counted: prefix is the crc32 of `<doc_id>:`; if 199 divides the crc32 with the word, one code point goes."""
    h = zlib.crc32(word.encode("utf-8"), prefix)
    if h % MISSPELT:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Worker: (word, n), a word once for every HELD distinct ones."""
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for block in text_blocks(batches):
        for doc_id, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True):
            if not text:
                continue
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: A-Z only
            runs = Counter(_RUN.findall(text)) if len(text) < LONG else Counter(m.group() for m in _RUN.finditer(text))
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs.items():
                if len(run) >= SHORTEST:
                    word = misspelt(run, prefix)
                    if len(word) >= SHORTEST:
                        held[word] += n
            if len(held) >= HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: the distinct words of at least 6 code points and 5 occurrences in all texts, misspelt ones as they are.

    Null and empty texts have no words. A null doc_id counts as the empty text. Repeated rows count again. Other
    columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def mask(word: Column) -> Column:
    """The parities of the word's letters: three bands of 11 bits in a long. Letters are dealt to the bands in turn."""
    bits = F.array(*[F.lit(1 << (rank % 3 * BAND_BITS + rank // 3)).cast("long") for rank in range(3 * BAND_BITS)])

    def bit(c: Column) -> Column:
        at = F.instr(F.lit(LETTERS), c)
        return F.element_at(bits, F.when(at > 0, at).otherwise(len(LETTERS) + 1 + F.ascii(c) % (3 * BAND_BITS - len(LETTERS))))

    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda m, c: m.bitwiseXOR(bit(c)))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every pair of words (word, n; distinct) that differ by exactly one inserted, deleted or replaced code point, once."""
    words = words.select("word", "n", F.length("word").alias("size"), mask(F.col("word")).alias("mask"))

    def keyed(size: Column, longer: int) -> DataFrame:
        """A row for each band and half, under the size of the shorter word of a pair."""
        half = F.floor(size / 2).cast("int")
        sides = F.array(F.struct(F.lit(0).alias("side"), F.left(F.col("word"), half).alias("half")), F.struct(F.lit(1).alias("side"), F.right(F.col("word"), half).alias("half")))
        bands = F.array(*[F.shiftright(F.col("mask"), i * BAND_BITS).bitwiseAND((1 << BAND_BITS) - 1) for i in range(3)])
        out = words.select("word", "n", "mask", size.alias("size"), F.lit(longer).alias("longer"), half.alias("k"), F.posexplode(bands).alias("band", "value"), sides.alias("sides"))
        return out.select("*", F.explode("sides").alias("s")).select("word", "n", "mask", "size", "longer", "k", "band", "value", "s.side", "s.half")

    own = keyed(F.col("size"), 0)
    left = own.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("mask").alias("a_mask"), "size", "k", "band", "value", "side", "half")
    right = own.unionByName(keyed(F.col("size") - 1, 1)).select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("mask").alias("b_mask"), "longer", "size", "band", "value", "side", "half")
    a, b = left.alias("l"), right.alias("r")
    differ = F.col("a_mask").bitwiseXOR(F.col("b_mask"))
    low = (1 << BAND_BITS) - 1
    # a pair is met at the first band that is the same, and at its last half only if the first differs
    first_band = F.when(F.col("l.band") == 0, True).when(F.col("l.band") == 1, differ.bitwiseAND(low) != 0).otherwise((differ.bitwiseAND(low) != 0) & (differ.bitwiseAND(low << BAND_BITS) != 0))
    first_side = (F.col("l.side") == 0) | (F.left(F.col("a"), F.col("k")) != F.left(F.col("b"), F.col("k")))
    same_key = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("band", "value", "size", "side", "half")]
    filters = [F.bit_count(differ) <= F.lit(2) - F.col("longer"), (F.col("longer") == 1) | (F.col("a") < F.col("b")), first_band, first_side]
    met = a.join(b, [*same_key, *filters])
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each word of word_counts().

    n_near counts the near words. form is the one of largest n (ties: the first in code-point order), if that is at
    least five times the word's own n, with form_n as its n; else null. root is the end of the chain of forms, the word itself
    if it has none. An empty table gives no rows; for nulls and repeats see word_counts().
    """
    scratch = Scratch(spark)
    words = scratch.write(word_counts(docs))
    pairs = near_pairs(words)
    ends = F.explode(F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("other")), F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("other"))))
    best = pairs.select(ends.alias("e")).groupBy("e.word").agg(F.count("*").alias("n_near"), F.min("e.other").alias("other"))
    found = words.join(best, "word", "left")
    takes = -F.col("other.n") >= TIMES * F.col("n")
    found = scratch.write(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("other.word")).alias("form"), F.when(takes, -F.col("other.n")).alias("form_n")))
    return found.join(_roots(scratch, found.where("form is not null").select("word", "form")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """word, root: the ends of the chains word to form. Counts rise five-fold a step, so chains have at most 27 steps and halve in each of at most 5 rounds."""
    now = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = scratch.write(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        scratch.drop(now)
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after
