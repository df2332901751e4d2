"""Operators on single texts: brute force, exact round trips and held-out accuracy; odd inputs."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quillwork.llm import bpe, fingerprint, html_text, langid, lm_score, packing, queries, toxicity, url_filter

ODD = [(1, None, "x"), (2, "", "x"), (3, "same text here", "y"), (3, "same text here", "y"), (4, "  \n\t ", None), (5, "ÄÖÜ 漢字 😀", "x"), (None, "no id at all", "z"), (6, "word " * 30_000, "x")]
ODD_SCHEMA = "doc_id long, text string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def texts_of(spark, sf_dir, n=60):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("text").collect()][:n]


# ---------------------------------------------------------------- urls

def test_url_parts_and_rules(spark):
    rows = [(1, "https://Blog.Example.COM/en/1?x=/a#b"), (2, "http://www.example.com/en/"), (3, "http://www.example.com"), (4, "ftp://a.net/es/x"), (5, None), (6, "no scheme"), (7, ""), (8, "http://example.org://x?y"), (9, "http://net/fr/"), (9, "http://net/fr/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("score", F.lit("clash"))
    model = url_filter.train(url_filter.labelled_urls(spark, 300), trees=2)
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(pages, model).collect()}
    assert got == {
        1: ("blog.example.com", "/en/1", "example.com/en/"), 2: ("www.example.com", "/en/", "www.example.com/en/"), 3: ("www.example.com", "", None), 4: ("a.net", "/es/x", "net/es/"),
        5: ("", "", None), 6: ("", "", None), 7: ("", "", None), 8: ("example.org:", "//x", None), 9: ("net", "/fr/", "net/fr/"),
    }
    assert url_filter.judge(pages.limit(0), model).count() == 0 and url_filter.judge(pages, model).count() == len(rows)


def test_url_trees_learn(spark):
    data = url_filter.labelled_urls(spark, 1200).withColumn("page_id", F.col("label").cast("long"))
    fold = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    model = url_filter.train(data.where(~fold).select("url", "label"))
    right = url_filter.judge(data.where(fold), model, rules=()).agg(F.avg(((F.col("verdict") == "block") == (F.col("page_id") == 1)).cast("int"))).first()[0]
    assert right > 0.9
    assert url_filter.train(data.limit(0).select("url", "label")).trees == []


# ---------------------------------------------------------------- toxicity

def test_folding():
    assert [toxicity.fold_word(w) for w in ("1d10t", "іdіоt", "ID!OT!!", "i.d.i.o.t", "2024", "de,&&&", "Ｍｏｒｏｎ", "tra$h.", "idi0t!", "1d10t$", "нет", "ελλαδα")] == ["idiot", "idiot", "idiot", "idiot", "2024", "de", "moron", "trash", "idiot", "idiot", "нет", "ελλαδα"]


def test_exceptions_and_length():
    lexicon = toxicity.Lexicon()
    a = lexicon.automaton()
    fold = toxicity.Folder()
    assert toxicity.measure(a, fold("put it in the Trash can")) == (0.0, 0)
    assert toxicity.measure(a, fold("you trash"))[1] == 1
    assert toxicity.score(3, 10, lexicon.coef) > toxicity.score(3, 1000, lexicon.coef) > toxicity.score(0, 10, lexicon.coef)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = queries.op2_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    r = out.agg(F.count_if(F.expr("toxic = 1 and predicted = 1")).alias("tp"), F.count_if(F.expr("toxic = 1")).alias("p"), F.count_if(F.expr("toxic = 0 and predicted = 1")).alias("fp"), F.count_if(F.expr("toxic = 0")).alias("n")).first()
    assert r.tp / r.p > 0.7 and r.fp / r.n < 0.05
    assert all((zlib.crc32(str(x.doc_id).encode()) % 3 == 1) == x.held_out for x in queries.op2_toxicity(spark, "/root/testdata/sf0.001").collect())
    assert docs.count() == 1000


def test_toxicity_odd_inputs(spark, odd, empty):
    lexicon = toxicity.fit(odd, spark.createDataFrame([], "doc_id long, toxic int, text string"))
    assert toxicity.score_documents(odd, lexicon).count() == len(ODD)
    assert toxicity.score_documents(empty, lexicon).count() == 0
    assert toxicity.keep_clean(odd, lexicon).count() == len(ODD)
    assert toxicity.keep_clean(odd, lexicon).columns == odd.columns


# ---------------------------------------------------------------- language

def test_language_held_out(spark):
    out = queries.op5_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_language_odd_inputs(spark, odd, empty):
    model = langid.train([("the cat and the dog sat there", "en"), ("der hund und die katze", "de")] * 15)
    got = langid.identify(odd, model, reject=False).collect()
    assert len(got) == len(ODD)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 4)} == {1: "und", 2: "und", 4: "und"}
    assert all(0 <= r.score <= 1 for r in got) and all(r.lang_pred in ("en", "de") for r in got if r.doc_id in (3, 5, 6))
    assert langid.identify(empty, model).count() == 0 and langid.fit(empty.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


# ---------------------------------------------------------------- BPE

TRICKY = ["", "a", "  ", "   x  y ", " a\n b", "x \n\n  y\t\t z ", "aaa aaaa aaaaaaa", "it's we'll  '' 's I'mad x'' 'Tis 'S o're'll ' 's", "<|endoftext|> hi<|endoftext|>", "x'<|endoftext|>s 's", "naïve 漢字 😀👍🏽\x1c\x1d x", "12345 67a8", "ΣΑΣ é é ́x İ", "x y  z", "''s", "don't"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_equals_the_library(spark, sf_dir, name):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(name)
    theirs, mine = Tokenizer.from_file(path), bpe.Tokenizer(bpe.vocabulary_content(path))
    batch = TRICKY + texts_of(spark, sf_dir)
    for text, ids in zip(batch, mine.encode_batch(batch), strict=True):
        assert ids.tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text[:60])
        if name.startswith("byte"):
            assert mine.decode(ids) == theirs.decode(ids.tolist(), skip_special_tokens=False) == text


def test_bpe_odd_inputs(spark, odd, empty):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    got = {(r.doc_id, r.decoded): r.ids for r in bpe.encode_documents(odd, path).collect()}
    assert {(i, t or "") for i, t, _ in ODD} == set(got)
    digest = {r.doc_id: r for r in bpe.digest_documents(odd, path).collect()}
    assert digest[1].n_tokens == 0 and digest[1].ids_sha256 == digest[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert digest[3].ids_sha256 == hashlib.sha256(",".join(map(str, got[3, "same text here"])).encode()).hexdigest()
    assert bpe.digest_documents(empty, path).count() == 0


# ---------------------------------------------------------------- fingerprints

def levenshtein(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a):
        p, d = d, [i + 1]
        for j, y in enumerate(b):
            d.append(min(p[j] + (x != y), p[j + 1] + 1, d[j] + 1))
    return d[-1]


def test_edit_distance():
    import random

    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choices("abc", k=r.randint(0, n))) for n in (12, 90))
        assert fingerprint.edit_distance(a, b) == levenshtein(a, b)


def test_fingerprints_with_next(spark):
    ids = [5, 1, 9, 3, 3, None, 20, 21]
    rows = [(i, None if i == 9 else f"{i} " * (40 * k) + "ende", "x") for k, i in enumerate(ids)]
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        e = fingerprint.edited(t, after)
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest()] = (fingerprint.fingerprint(t), fingerprint.fingerprint(e), fingerprint.likeness(fingerprint.fingerprint(t), fingerprint.fingerprint(after)))
    df = spark.createDataFrame(rows, ODD_SCHEMA)
    for size in (2, 100):
        got = {(r.doc_id, r.n_chars, r.edited_sha256): (r.fingerprint, r.edited_fingerprint, r.near_next) for r in fingerprint.compare_with_next(df, size).collect()}
        assert got == want
    assert fingerprint.compare_with_next(df.limit(0)).count() == 0
    assert fingerprint.likeness("3::", "3::") == 1.0 and fingerprint.likeness("3::", "3:ab:c") == 0.0


def test_fingerprints_see_edits(spark, sf_dir):
    for t in texts_of(spark, sf_dir, 20):
        if len(t) > 1000:
            f = fingerprint.fingerprint(t)
            assert fingerprint.likeness(f, fingerprint.fingerprint(t[:-100])) > 0.6 > fingerprint.likeness(f, fingerprint.fingerprint(t[::-1]))


# ---------------------------------------------------------------- packing

def test_packing_search():
    import random

    r = random.Random(2)
    for low, high in ((1, 4095), (900, 3000), (1300, 1500)):
        sizes = [r.randint(low, high) for _ in range(400)] + [4096]
        bins = packing.pack(sizes)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in b) for b in bins) <= 4096
        assert len(bins) <= len(packing.best_fit(sizes, 4096))
    assert packing.local_search([[0], [1]], [3, 4], 10) in ([[0, 1]], [[1, 0]]), "a move empties a bin"
    sizes, squares = [6, 2, 5, 3, 4], lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert squares(packing.local_search([[0, 1], [2, 3], [4]], sizes, 10)) > squares([[0, 1], [2, 3], [4]]), "exchanges raise squared fill"
    assert sorted(sum([9, 1, 3, 4, 3][i] for i in b) for b in packing.local_search([[2], [3, 4]], [9, 1, 3, 4, 3], 10)) == [10]


def test_packing_documents(spark, odd, empty):
    import numpy as np

    path = queries.tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path, capacity=512, group_rows=3).collect()
    tok = bpe.tokenizer(bpe.vocabulary_content(path))
    for doc_id in (1, 5, 6):
        text = next(t for i, t, _ in ODD if i == doc_id) or ""
        ids = [*tok.encode_batch([text])[0].tolist(), 1]
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.piece)
        assert [r.start for r in mine] == list(range(0, len(ids), 512)) and sum(r.length for r in mine) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()) for r in mine)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 512
    assert len([r for r in rows if r.doc_id == 3]) == 2 and packing.pack_documents(empty, path).count() == 0


# ---------------------------------------------------------------- language model

def test_pseudo_likelihood_prefers_the_corpus(spark, sf_dir):
    import random

    texts = [t for t in texts_of(spark, sf_dir, 200) if len(t) > 300]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    model = lm_score.fit(df, words=80)
    shuffled = spark.createDataFrame([(k, " ".join(random.Random(k).sample(t.split(), len(t.split())))) for k, t in enumerate(texts)], "doc_id long, text string")
    mean = lambda d: lm_score.score_documents(d, model).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert mean(df) > mean(shuffled)


def test_pseudo_likelihood_is_the_sum_over_tokens(spark, odd, empty):
    import numpy as np
    import pyarrow as pa

    from quillwork.llm.common import word_hashes

    model = lm_score.build([b"word", b"text"], ["word text word other"] * 5)
    batch = pa.RecordBatch.from_arrays([pa.array(["word text odd", "text"])], names=["text"])
    words, rows = word_hashes(batch)
    tokens = model.tokens(words)
    got = model.log_probabilities(tokens, rows)
    for i in range(len(tokens)):
        sides = [np.array([tokens[i + d] if 0 <= i + d < len(tokens) and rows[i + d] == rows[i] else model.size]) for d in (-2, -1, 1, 2)]
        z = (model.hidden(sides) @ model.out + model.bias2)[0].astype(float)
        assert abs(got[i] - (z[tokens[i]] - np.log(np.exp(z).sum()))) < 1e-4
    out = {r.doc_id: r for r in lm_score.score_documents(odd, model).collect()}
    assert out[1].n_tokens == 0 and out[1].log_prob == 0 and out[1].mean_log_prob is None and out[6].n_tokens == 30_000
    assert lm_score.score_documents(empty, lm_score.fit(empty)).count() == 0


def test_rare_words_and_documents_beyond_the_sample_count(spark):
    import numpy as np
    import pyarrow as pa

    from quillwork.llm.common import word_hashes

    rows = [(i, f"{'often ' * 8}less{i % 3} word{i % 7} once{i}") for i in range(90)] + [(90 + i, "often less0") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.fit(docs, words=1, buckets=1, sample_docs=1)
    hashes = lambda *ws: word_hashes(pa.RecordBatch.from_arrays([pa.array(ws)], names=["text"]))[0]
    seen = hashes(*(f"less{i}" for i in range(3)), *(f"word{i}" for i in range(7)), *(f"once{i}" for i in range(90)))
    shares = np.exp(model.shares.of(seen))
    assert abs(shares.sum() - 1) < 1e-9 and abs(shares[0] - 230 / 470) < 1e-9 and abs(shares[-1] - 1 / 470) < 1e-9
    a, b = (lm_score.score_documents(spark.createDataFrame([(1, t)], "doc_id long, text string"), model).first().log_prob for t in ("often less0", "often once1"))
    assert abs(a - b - np.log(230)) < 1e-6, "words of one bucket differ by their counts"
    before = lm_score.build([b"often"], ["other words"], 1)
    after = lm_score.train_on_all(docs, lm_score.build([b"often"], ["other words"], 1))
    assert np.abs(after.out - before.out).max() > 0, "all documents train the network"


def test_every_word_has_its_exact_share(spark):
    """Words of one bucket differ by their counts however rare they are, whether tasks hold their shares or not."""
    import numpy as np

    rows = [(i, f"{'often ' * 8}twice{i // 2} thrice{i // 3} once{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    probes = [(1, "often once1"), (1, "often twice1"), (2, "often thrice1"), (None, "often thrice1 once1 once1"), (4, "often never"), (5, None)]
    found = []
    for held in (1 << 20, 40, 0):
        model = lm_score.fit(docs, words=1, buckets=1, sample_docs=1, most_held=held)
        assert (model.rest is None) == (held > 1000) and len(model.shares.hashes) == {1 << 20: 165, 40: 30, 0: 0}[held]
        out = lm_score.score_documents(spark.createDataFrame(probes, "doc_id long, text string"), model).collect()
        assert len(out) == len(probes)
        found.append(sorted((r.doc_id or 0, r.n_tokens, r.log_prob) for r in out))
    for (_, n, a), (_, m, b), (_, k, c) in zip(*found, strict=True):
        assert n == m == k and abs(a - b) < 1e-4 and abs(a - c) < 1e-4
    scores = sorted(x for d, n, x in found[0] if n == 2 and d in (1, 2))
    assert abs(scores[1] - scores[0] - np.log(2)) < 1e-4 and abs(scores[2] - scores[0] - np.log(3)) < 1e-4


# ---------------------------------------------------------------- html

PAGES = [
    ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies here on this site</div><article><h1>Head &amp; more</h1><p>One <a href=x>link</a>\n text<br>two<p>Be.</article><aside>side box</aside><div id=comments><p>Nice article, thanks a lot</div><footer>&copy; x</footer>", "Head & more\nOne link text two\nBe."),
    ("<body><script>var t='<p>x</p>'</script><main><p>a<li>b</main><form>Name <input></form>", "a\nb"), ("", ""), (None, ""), ("plain words only, no markup", "plain words only, no markup"), ("<p>a &lt;b&gt; c</p><!-- <p>no</p> -->", "a <b> c"),
]


def test_html(spark):
    rows = [(k, f"u{k}", h, "clash") for k, (h, _) in enumerate(PAGES)] + [(None, None, "<p>x</p>" * 20_000, None)]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert [got[k].text for k in range(len(PAGES))] == [t for _, t in PAGES]
    assert got[None].n_chars == 2 * 20_000 - 1


def test_html_tree_fits_its_table():
    tree = html_text.default_tree()
    assert sum(tree.main(tuple(map(float, r[:-1]))) == bool(r[-1]) for r in html_text.LABELLED) >= 0.95 * len(html_text.LABELLED)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_of_words_of_one_rule(name):
    """Thue-Morse words and their complements, which a polynomial hash modulo a power of two takes for equal."""
    from tokenizers import Tokenizer as Library

    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), f"{word} x {word[::-1]}"]
    library, own = Library.from_file(queries.tokenizer_path(name)), bpe.Tokenizer(bpe.vocabulary_content(queries.tokenizer_path(name)))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] != want[1] and [x.tolist() for x in own.encode_batch(texts)] == want


def test_local_search_wins_bins_where_best_fit_is_not_optimal():
    import random

    for lo, hi, least in ((1_000, 2_200, 20), (300, 2_500, 2)):
        r = random.Random(1)
        sizes = [r.randint(lo, hi) for _ in range(3_000)]
        start = packing.best_fit(sizes, 4096)
        got = packing.local_search(start, sizes, 4096)
        assert sorted(i for b in got for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 4096 for b in got)
        assert len(got) <= len(start) - least, (len(start), len(got))


def seconds(run, *args):
    import time

    began = time.time()
    run(*args)
    return time.time() - began


def test_hostile_pages_take_linear_time():
    pages = ["<a " * 300_000, "<div>" * 60_000 + "</p>" * 60_000, "<button>x" * 100_000, '<a " ' * 200_001 + ">", "<!-" * 300_000, "<" * 500_000, "<svg>x" * 100_000, '<p class="' + "nav_" * 200_000 + '">x</p>']
    for page in pages:
        assert seconds(html_text.main_text, page) < 5, page[:20]
    assert html_text.blocks('<p>one <b>two</p><p title="a > b">three</p>')[1].text == "three"
    assert [b.text for b in html_text.blocks('<p>1 < 2</p><p title="open>x</p><p>y</p>')] == ["1 < 2", "x", "y"]


def test_hostile_texts_take_linear_time():
    lexicon = toxicity.Lexicon()
    automaton, folder = lexicon.automaton(), toxicity.Folder()
    assert seconds(lambda: toxicity.measure(automaton, folder("trash can " * 100_000))) < 5
    one, two = "abcdefg " * 50_000, "word " * 80_000
    other = fingerprint.edited(two, "another text that is quite unlike it " * 4_000)
    assert seconds(lambda: fingerprint.likeness(fingerprint.fingerprint(one), fingerprint.fingerprint(two))) < 2
    assert fingerprint.likeness(fingerprint.fingerprint(two), fingerprint.fingerprint(other)) > 0.6


def test_measure_is_a_naive_search():
    import random

    r = random.Random(4)
    terms = {" ab": 1.0, " abc ": 2.5, " ca ": 1.5, " b": 0.5}
    lexicon = toxicity.Lexicon(terms, exceptions=("abc ca", "ca ab b"))
    automaton = lexicon.automaton()
    for _ in range(300):
        text = " " + " ".join(r.choice(["ab", "abc", "ca", "b", "abcd", "x"]) for _ in range(r.randint(0, 12))) + " "
        safe = [(i, i + len(p) + 2) for p in lexicon.exceptions for i in range(len(text)) if text.startswith(f" {p} ", i)]
        best = {}
        for term, weight in terms.items():
            for i in range(len(text)):
                if text.startswith(term, i) and not any(lo <= i and i + len(term) <= hi for lo, hi in safe):
                    best[i] = max(best.get(i, 0.0), weight)
        assert toxicity.measure(automaton, text) == (sum(best.values()), len(best))


def test_fingerprint_is_a_naive_rolling_hash():
    import random

    r = random.Random(6)
    mask = (1 << 32) - 1
    for _ in range(12):
        text = "".join(r.choice("abc deé中") for _ in range(r.randint(1, 900)))
        data = text.encode()
        size = 3
        while len(data) // size >= 64:
            size *= 2
        signatures = []
        for scale in (size, 2 * size):
            letters, begin = "", 0
            for at in range(len(data)):
                rolled = sum((int(fingerprint._ROLL[data[at - k]]) >> k) * (2 * k + 1) for k in range(7) if at >= k) & mask
                hit = (((rolled * 0x9E3779B1) & mask) >> 8) % scale == 0
                length = at + 1 - begin
                if hit and length >= max(1, scale // 4) or length == 2 * scale or at == len(data) - 1:
                    value = 0
                    for k, b in enumerate(data[begin : at + 1]):
                        value += int(fingerprint._BYTE[b]) * pow(0x9E3779B97F4A7C15, k, 1 << 64)
                    letters += chr(fingerprint.ALPHABET[((value * 0xD6E8FEB86659FD93) % (1 << 64)) >> 58])
                    begin = at + 1
            signatures.append(letters)
        assert fingerprint.fingerprint(text) == f"{size}:{signatures[0]}:{signatures[1]}"


def test_next_rows_across_many_ranges(spark):
    """Ranges of a few rows, ids that repeat over several of them, null ids: every row meets the next one."""
    import random

    r = random.Random(3)
    rows = [(r.choice([None, 5, 5, 5, 6, *range(10, 60)]), f"text {i} {r.random()}" if i % 7 else "same") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = [(x.doc_id, x.text) for x in df.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_first(), "h", "text").collect()]
    want = sorted((-1 if i is None else i, hashlib.sha256(fingerprint.edited(t, order[(k + 1) % len(order)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order))
    for size in (7, 50, 4_000):
        got = sorted((-1 if x.doc_id is None else x.doc_id, x.edited_sha256) for x in fingerprint.compare_with_next(df, size).collect())
        assert got == want, size
