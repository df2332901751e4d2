"""Personal data: patterns with exact spans, then information-theoretic sanitisation of the words of their texts.

A protected entity is one value found by the patterns: an address, a card number, a phone number. Its information
content is IC(c) = ln(N / documents with c). A word t of the same text, wherever it stands, discloses
PMI(c; t) = ln(N * both / (with c * with t)) of that; if both only ever occur together, that is all of it. Counts are taken
over all documents. A word whose disclosure reaches GENERALISE of IC(c), seen with c in at least SUPPORT different texts, is
generalised to its kind in all texts with c; one that reaches REMOVE is removed. Everything is DataFrame expressions; no Python
runs in the executors.

Entities that stand in the same texts are one class, and so are words: pairs are counted between classes, so that copied lists
of many addresses are not multiplied with all words around them.

Spans are found by splitting a text at the matches: lengths of gaps and matches, summed up, give the places, in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import Scratch

#: Kinds in the order in which spans that start together are listed; `term` is what the method adds.
KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)
#: Each kind's pattern. They match what the plain forms match; possessive parts and looks behind keep hostile runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Words, and as group 1 those that may disclose: letters only, between white space or brackets and the punctuation that ends
#: it. Others are matched as well, so that a search goes on behind them and hostile runs stay linear.
WORD = r"(?<![^\s(\[\"'])(?:(\p{L}[\p{L}'’-]{2,}+)(?=[.,;:!?)\]\"']*+(?:\s|$))|\p{L}[\p{L}'’-]{2,}+)"
#: Different texts that must show a word with an entity, and the shares of the entity's information from which it is generalised or removed.
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.95
#: Code points of a piece from which cleaned texts are put together.
CHUNK = 1_000

_KEY = ["doc_id", "text_hash", "text_check"]


def scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running op over an array, in log2(size) passes over it."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(30)]), lambda p: p < F.size(values))
    return F.aggregate(steps, values, lambda acc, p: F.transform(acc, lambda x, i: F.when(i >= p, op(x, F.get(acc, i - p))).otherwise(x)))


def _with_places(text: Column, pattern: str, body: Callable[[Column, Column, Column], Column]) -> Column:
    """body(matches, gaps, ends) of the pattern in text; each is computed once, however often body reads it."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = lambda f, g: F.transform(f, lambda m, i: F.length(F.get(g, i)) + F.length(m))
    return let(found, lambda f: let(gaps, lambda g: let(scan(steps(f, g), lambda a, b: a + b), lambda e: body(f, g, e))))


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (F.lit(1) + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is one."""
    if kind == "ip":
        part = "0*+(?:[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])?"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """A match as the value that it stands for, however it is written."""
    if kind == "email":
        return F.concat(F.lit("email:"), F.lower(value))
    return F.concat(F.lit(f"{kind}:"), value if kind == "ip" else F.regexp_replace(value, "[^0-9]", ""))


def _words(text: Column) -> Column:
    """(term, start, stop) of every word of text that may disclose."""
    plain = F.regexp_extract_all(text, F.lit(WORD), F.lit(1))

    def all_of(found: Column, _: Column, ends: Column) -> Column:
        one = lambda m, i: F.struct(F.lower(m).alias("term"), (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("stop"))
        return F.filter(F.transform(plain, one), lambda w: w["term"] != "")

    return _with_places(text, WORD, all_of)


def base_spans(docs: DataFrame) -> DataFrame:
    """Every row's doc_id with the key of its text, its base spans and, beside any, all words of its text.

    spans: (start, kind, stop, entity) by start and kind; words: (term, start, stop), null without spans. Places count code
    points, stop is exclusive. Null text is empty. Null ids and repeated rows are kept, other columns are not read.
    """

    def spans(no: int, kind: str) -> Column:
        def all_of(found: Column, _: Column, ends: Column) -> Column:
            one = lambda m, i: F.struct((F.get(ends, i) - F.length(m)).alias("start"), F.lit(no).alias("kind"), F.get(ends, i).alias("stop"), m.alias("entity"))
            held = F.filter(F.transform(found, one), lambda s: _valid(kind, s["entity"]))
            return F.transform(held, lambda s: s.withField("entity", _entity(kind, s["entity"])))

        return _with_places(F.col("text"), PATTERNS[kind], all_of)

    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    all_spans = F.sort_array(F.concat(*[spans(i, k) for i, k in enumerate(KINDS)]))
    both = let(all_spans, lambda s: F.struct(s.alias("spans"), F.when(F.size(s) > 0, _words(F.col("text"))).alias("words")))
    return text.select("doc_id", F.xxhash64("text").alias("text_hash"), F.hash("text").alias("text_check"), both.alias("b")).select(*_KEY, "b.*")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def _text_counts(rows: DataFrame, by: str, support: int) -> DataFrame:
    """by, n, texts, x, y of rows (key, by, n): rows, different texts, and a name of the set of keys, for what stands in `support` texts at least."""
    once = rows.groupBy(by, "key.text_hash", "key.text_check").agg(F.sum("n").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    out = once.groupBy(by).agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    return out.where(F.col("texts") >= support)


def disclosing(scratch: Scratch, docs: DataFrame, found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """key, start, stop, share: words that disclose an entity of their text, with the largest share of any's information, from GENERALISE on.

    Counts are over all rows of docs. Entities in fewer than `support` texts, words in fewer of their texts, and pairs that can't reach the share by what is
    counted so far, are left out on the way: they would fail at the end. Hot entities and words are counted map-side first.
    """
    total = F.lit(float(docs.count()))
    held = found.where(F.size("spans") > 0)
    in_rows = scratch.write(held.select("key", F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity")).groupBy("key", "entity").agg(F.count("*").alias("n")))
    entities = _text_counts(in_rows, "entity", support).where(F.col("n") < total)
    entities = entities.select("entity", F.struct("x", "y").alias("c"), F.col("n").alias("with_c"))
    classes = scratch.write(in_rows.join(entities, "entity").groupBy("key", "c", "with_c").agg(F.max("n").alias("n")))
    words = scratch.write(held.join(classes.select("key").distinct(), "key", "left_semi").select("key", F.explode("words").alias("w")).select("key", "w.*"))
    # rows that repeat a key repeat its words as often
    terms = _text_counts(words.groupBy("key", "term").agg(F.lit(1).alias("n")).join(classes.groupBy("key").agg(F.max("n").alias("rows")), "key").select("key", "term", F.col("rows").alias("n")), "term", support)
    plain = F.filter(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(1)), lambda m: m != "")
    in_text = docs.select(F.explode(F.array_distinct(F.transform(plain, F.lower))).alias("term")).groupBy("term").agg(F.count("*").alias("with_t"))
    terms = in_text.join(terms, "term").where(F.log(total / F.col("with_t")) >= GENERALISE * F.log(total / F.col("n")) - 1e-9)
    terms = scratch.write(terms.select("term", F.struct("x", "y").alias("t"), F.col("n").alias("t_beside"), "with_t"))
    placed = scratch.write(words.join(terms, "term").select("key", "t", "t_beside", "with_t", "start", "stop").distinct())
    scratch.drop(words)

    def share(both: Column) -> Column:
        return F.log(total * both / (F.col("with_c") * F.col("with_t"))) / F.log(total / F.col("with_c"))

    # no more rows can show both than show either
    pairs = placed.select("key", "t", "t_beside", "with_t").distinct().join(classes, "key").where(share(F.least("with_c", "t_beside")) >= GENERALISE - 1e-9)
    each = pairs.groupBy("c", "t", "with_c", "with_t", "key.text_hash", "key.text_check").agg(F.sum("n").alias("n"))
    strong = each.groupBy("c", "t", "with_c", "with_t").agg(F.sum("n").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    strong = scratch.write(strong.select("c", "t", "with_t", share(F.col("both")).alias("share")).where(F.col("share") >= GENERALISE))
    hits = pairs.join(strong, ["c", "t", "with_t"]).groupBy("key", "t", "with_t").agg(F.max("share").alias("share"))
    return placed.join(hits, ["key", "t", "with_t"]).select("key", "start", "stop", "share")


def find(spark: SparkSession, docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Key of each row's text, base (spans) and spans: base ones and those of disclosing terms, by start, kind and stop.

    A span's `share` is null for base kinds. Rows with the same id and text have the same spans. Null and empty texts
    have none, null ids are kept; an empty table gives no rows. The tables between are written to the shared folder.
    """
    scratch = Scratch(spark)
    found = scratch.write(base_spans(docs).withColumn("key", F.struct(*_KEY)))
    hits = disclosing(scratch, docs, found, support)
    span = F.struct("start", F.lit(TERM).alias("kind"), "stop", "share")
    hits = hits.groupBy("key").agg(F.collect_list(span).alias("terms"))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"), F.lit(None).cast("double").alias("share")))
    rows = found.select("key", *_KEY, base.alias("base")).join(hits, "key", "left")
    return rows.select(*_KEY, "base", F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "terms"))).alias("spans"))


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms: one row for each row of docs. For odd input see find()."""
    out = find(spark, docs)
    count = lambda no: F.size(F.filter("base", lambda s: s["kind"] == no)).cast("long")
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_terms"))


def _piece(chunks: Column, start: Column, stop: Column) -> Column:
    """Code points start to stop of the text that the chunks make up."""
    i, j = F.floor(start / CHUNK).cast("int"), F.floor(stop / CHUNK).cast("int")
    at, to = start % CHUNK, stop % CHUNK
    first, last = F.coalesce(F.get(chunks, i), F.lit("")), F.coalesce(F.get(chunks, j), F.lit(""))
    across = F.concat(F.substring(first, at + 1, F.lit(CHUNK)), F.array_join(F.slice(chunks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.left(last, to))
    return F.when(stop <= start, "").when(i == j, F.substring(first, at + 1, stop - start)).otherwise(across)


def sanitise(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with every column, its texts cleaned: base spans become [EMAIL], [IP], [CARD] or [PHONE]; terms that disclose become [NAME] or [WORD] by their first letter, or nothing if they disclose all but all.

    Overlapping spans are replaced as one. Null texts stay null, other rows keep their place and number. Columns may have any names but `quillwork_spans` and those of the key.
    """
    found = find(spark, docs).select(*[F.col(k).alias(f"quillwork_{k}") for k in _KEY], F.col("spans").alias("quillwork_spans")).where(F.size("quillwork_spans") > 0).dropDuplicates([f"quillwork_{k}" for k in _KEY])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.join(found, F.col("doc_id").eqNullSafe(F.col("quillwork_doc_id")) & (F.xxhash64(text) == F.col("quillwork_text_hash")) & (F.hash(text) == F.col("quillwork_text_check")), "left")
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def instead(pieces: Column, s: Column) -> Column:
        word = F.when(_piece(pieces, s["start"], s["start"] + 1).rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        return F.when(s["kind"] < TERM, F.get(labels, s["kind"])).when(s["share"] >= REMOVE, "").otherwise(word)

    def cleaned(spans: Column, pieces: Column, reach: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            done = F.when(i > 0, F.get(reach, i - 1)).otherwise(0)
            return F.concat(_piece(pieces, done, s["start"]), F.when(s["start"] >= done, instead(pieces, s)).otherwise(""))

        return F.concat(F.array_join(F.transform(spans, one), ""), _piece(pieces, F.element_at(reach, -1), F.length("text")))

    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    reach = lambda spans: scan(F.transform(spans, lambda s: s["stop"]), F.greatest)
    clean = let(F.col("quillwork_spans"), lambda s: let(chunks, lambda c: let(reach(s), lambda r: cleaned(s, c, r))))
    return rows.withColumn("text", F.when(F.col("quillwork_spans").isNull(), F.col("text")).otherwise(clean)).select(docs.columns)
