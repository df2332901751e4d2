"""Lexical search, spelling variants and personal data: against brute force, and on odd input."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillwork.llm import lexical_search, pii, spelling

DOCS = "doc_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---------------------------------------------------------------- lexical search


def ranked(docs, items, k):
    """Every document scored for every item."""
    terms = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    n = {id(c): sum(c.values()) for _, c in terms}
    documents, total = sum(1 for _, c in terms if c), sum(n.values())
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in terms:
            if not c:
                continue
            m = 50 + (50 * n[id(c)] * documents) // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(TERM.findall(lower(text or ""))) if c[t])
            if score > 0:
                found.append((-score, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(found)[:k])]
    return sorted(out)


def corpus(n: int, seed: int = 1) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(900)] + ["Überfluß", "x9", "日本"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 80)))) for i in range(n)]


@pytest.mark.parametrize("segment", [1, 300, 1 << 20])
def test_search_is_brute_force(spark, segment):
    docs = corpus(400)
    docs += [(1000 + i, docs[i][1]) for i in range(60)]  # ties
    items = [(i, docs[7 * i][1] + " unheard") for i in range(12)]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    got = lexical_search.search(spark, df, spark.createDataFrame(items, "item_id long, text string"), k=9, segment=segment)
    assert sorted(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == ranked(docs, items, 9)


def test_search_in_several_blocks_of_items(spark):
    docs, items = corpus(120), [(f"i{i}", t) for i, t in corpus(7, seed=5)]
    got = lexical_search.search(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id string, text string"), k=4, cut=lambda rows: lexical_search.blocks(rows, most_terms=30, most_items=3))
    assert sorted(tuple(r) for r in got.collect()) == ranked(docs, items, 4)


def test_search_of_odd_input(spark):
    docs = [(None, "one two"), (3, "one two"), (3, "one two"), (4, None), (5, ""), (6, "... !"), (7, "ONE " * 50_000)]
    df = spark.createDataFrame([(*d, "one", 1) for d in docs], DOCS + ", item_id string, score int")
    items = spark.createDataFrame([(1, "one?", 9), (2, None, 9), (3, "", 9), (None, "two", 9)], "item_id long, text string, rank int")
    got = lexical_search.search(spark, df, items).orderBy(F.asc_nulls_first("item_id"), "rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [(None, 1, None), (None, 2, 3), (None, 3, 3), (1, 1, 7), (1, 2, None), (1, 3, 3), (1, 4, 3)]
    assert lexical_search.search(spark, df.limit(0), items).count() == 0
    assert lexical_search.search(spark, df, items.limit(0)).count() == 0


def test_threshold_stops_before_the_end_of_the_lists():
    """One strong document at the top of a list of many weak ones: only a first round of entries is scored."""
    import numpy as np

    n = 50_000
    impact = np.full(n, 10)
    impact[123] = 1000
    segment = lexical_search.Segment(1, np.arange(n), np.arange(n), np.zeros(n, np.int64), impact)
    scored = []
    inner = segment.scores
    segment.scores = lambda docs, wanted: scored.append(len(docs)) or inner(docs, wanted)
    none = np.zeros(0, np.int64)
    scores, ids = lexical_search.search_segment(segment, np.array([0]), np.array([True]), (none, none), 1)
    assert (scores.tolist(), ids.tolist()) == ([1000], [123]) and sum(scored) <= lexical_search.STEP


# ---------------------------------------------------------------- spelling variants


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(docs):
    n = Counter()
    for doc, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    beside = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if near(a, b):
            beside[a].append(b)
            beside[b].append(a)
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(beside[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def test_variants_are_brute_force(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdeéïz") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    words = list(stems)
    for w in stems:  # families of edits of edits
        for _ in range(4):
            i = rng.randrange(len(w) + 1)
            words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("xyÿ") + w[i + 1 :]]))
            w = words[-1]
    docs = [(i, " ".join(rng.choices(words, [len(words) ** 2 / (k + 1) ** 1.3 for k in range(len(words))], k=400))) for i in range(40)]
    docs += [(90, "chained " * 300), (91, "chaimed " * 50), (92, "chaime " * 7)]
    got = spelling.variants(spark, spark.createDataFrame(docs, DOCS))
    want = variants(docs)
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr) == want
    assert sum(1 for r in want if r[1]) > 20 and any(r[2] != r[1] for r in want if r[1])


def test_variants_of_odd_input(spark):
    docs = [(None, "kettle " * 7), (1, None), (2, ""), (3, "Kettles KETTLES kettles! kettles-kettles"), (3, "Kettles " * 30), (3, "Kettles " * 30), (4, "1234 日本日本日本 " + "a" * 300_000)]
    df = spark.createDataFrame([(*d, "kettle", 5) for d in docs], DOCS + ", word string, n int")
    got = spelling.variants(spark, df)
    assert sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr) == variants(docs)
    assert got.count() == 2 and spelling.variants(spark, df.limit(0)).count() == 0


def test_chain_of_forms_ends_at_its_root(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    rows = [(w, 5 ** (i + 1)) for i, w in enumerate(chain)]
    pairs = sorted((min(r.a, r.b), max(r.a, r.b)) for r in spelling.near_pairs(spark.createDataFrame(rows, "word string, n long")).collect())
    assert pairs == sorted(zip(chain, chain[1:], strict=False))
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    assert {r.root for r in spelling._roots(spelling.Scratch(spark), forms).collect()} == {chain[-1]}


# ---------------------------------------------------------------- personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(text: str) -> list[tuple[int, int, int]]:
    out = []
    for no, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0 if len(digits) < 40 else False
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), no, m.end()))
    return sorted(out)


TEXTS = [
    "a@b.c+d@e.f, x@y, é a.b%c@d-e.co.uk. 日本 tail@x.y.z@w.v",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 9.9.9.9é",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 12 3456  7890",
    "+1 (502) 555-6996 +1 5 +123456789012345678 ++49 30.1234567-",
    "😀 4111 1111 1111 1111 😀 a@b.cd 😀",
    "", "no data at all", "+" * 2000, "@" * 2000, "a" * 60_000, "1." * 30_000, "1 " * 30_000, "a@" * 20_000, "a@b" + ".c" * 20_000, "+1" + " " * 30_000,
]


def random_texts(n: int) -> list[str]:
    rng = random.Random(11)
    return ["".join(rng.choice("aB1.2@+- ()%_é😀4") for _ in range(rng.randrange(60))) for _ in range(n)]


def test_base_spans_are_those_of_plain_patterns(spark):
    texts = [*TEXTS, *random_texts(1500)]
    got = {r.doc_id: [(s.start, s.kind, s.stop) for s in r.spans] for r in pii.base_spans(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == base(t), t[:80]


def letters() -> list[tuple[int, str]]:
    """Jane Quill stands beside one address in different letters, other words do everywhere."""
    rng = random.Random(2)
    common = ["write", "to", "the", "office", "please", "about", "your", "order", "today", "thanks"]
    line = lambda: " ".join(rng.choices(common, k=8))
    out = [(i, f"{line()} Jane Quill jane@quill.example {line()}") for i in range(6)]
    out += [(10 + i, f"{line()} clerk{i}@quill.example {line()}") for i in range(20)]
    return out + [(100 + i, f"{line()} {line()}") for i in range(300)]


def test_terms_that_disclose_an_entity(spark):
    docs = spark.createDataFrame(letters(), DOCS)
    rows = {r.doc_id: r for r in pii.report(spark, docs).collect()}
    texts = dict(letters())
    for i in range(6):
        terms = [x.split(":") for x in rows[i].spans.split(",") if x.startswith("term")]
        assert [texts[i][int(a) : int(b)] for _, a, b in terms] == ["Jane", "Quill"] and rows[i].n_email == 1
    assert all(r.n_terms == 0 for d, r in rows.items() if d >= 6) and all(rows[d].spans == "" for d in rows if d >= 100)
    clean = {r.doc_id: r.text for r in pii.sanitise(spark, docs).collect()}
    assert all(clean[d] == t for d, t in texts.items() if d >= 100)
    assert clean[0].split("  ")[1].startswith(" [EMAIL]") or "[EMAIL]" in clean[0]
    assert not any(w in clean[0] for w in ("Jane", "Quill", "jane@"))


def test_disclosure_counts_all_documents(spark):
    """A word as near to the entity as before no longer discloses it once it is common elsewhere."""
    docs = letters() + [(1000 + i, "Jane came") for i in range(200)]
    rows = {r.doc_id: r for r in pii.report(spark, spark.createDataFrame(docs, DOCS)).collect()}
    texts = dict(docs)
    assert {texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for i in range(6) for s in rows[i].spans.split(",") if s[0] == "t"} == {"Quill"}


def test_terms_far_from_the_entity(spark):
    """A name disclosed thousands of letters before or behind the address is found like one beside it; lists of addresses and hostile runs too."""
    far = "so it was at the office that day and on all other days as well, " * 40
    texts = [(i, f"{far}{i} to Mabel Thorn ({i}): {far * (i + 1)} thorn@quill.example {far} Yorick! {i}") for i in range(4)]
    texts += [(50 + i, " ".join(f"u{k}@list.example" for k in range(300)) + f" {i} " + far + " ".join("Word" + chr(97 + k % 26) + chr(97 + k // 26) for k in range(600))) for i in range(3)]
    texts += [(60, "thorn@quill.example " + "'ab" * 3_000 + "@ Mabel")] + [(100 + i, f"{far} {i}") for i in range(200)]
    rows = {r.doc_id: r for r in pii.report(spark, spark.createDataFrame(texts, DOCS)).collect()}
    for i, text in texts:
        terms = [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in rows[i].spans.split(",") if x) if k == "term"]
        assert len(terms) == rows[i].n_terms
        assert terms == (["Mabel", "Thorn", "Yorick"] if i < 4 else ["Mabel"] if i == 60 else []) or (50 <= i < 53 and len(terms) == 600), i


def test_disclosing_terms_are_those_of_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["Élan", "İsa", "o'Neil", "naïve"]
    mails = [f"p{i}@x.yz" for i in range(9)]
    docs = []
    for i in range(300):
        has = [m for m in mails if rng.random() < 0.02]
        own = [words[(mails.index(m) * 11 + k) % len(words)] for m in has for k in range(3) if rng.random() < 0.9]
        body = own + has + [words[int(rng.random() ** 2 * len(words))] for _ in range(rng.randrange(0, 3))]
        rng.shuffle(body)
        docs.append((i, " ".join(w + rng.choice(["", ",", "!)", "x1", "-"]) if w in words else w for w in body)))
    docs += [docs[k] for k in range(20)] + [(900 + k, docs[k][1]) for k in range(20, 50)] + [(None, docs[60][1])] * 2 + [(None, None)]
    word = re.compile(r"(?<![^\s(\[\"'])[^\W\d_](?:[^\W\d_]|['’-]){2,}+(?=[.,;:!?)\]\"']*+(?:\s|$))")
    terms_of = [{m.lower() for m in word.findall(t or "")} for _, t in docs]
    held = [set(re.findall(r"p\d@x\.yz", t or "")) for _, t in docs]
    with_t, with_c = Counter(w for t in terms_of for w in t), Counter(c for h in held for c in h)
    both = Counter((c, w) for h, t in zip(held, terms_of, strict=True) for c in h for w in t)
    texts = Counter((c, w) for c, w, _ in {(c, w, d[1]) for d, h, t in zip(docs, held, terms_of, strict=True) for c in h for w in t})
    share = {p: math.log(len(docs) * n / (with_c[p[0]] * with_t[p[1]])) / math.log(len(docs) / with_c[p[0]]) for p, n in both.items() if texts[p] >= pii.SUPPORT}
    strong = {p for p, x in share.items() if x >= pii.GENERALISE}
    spans = lambda t, h: ",".join(f"term:{m.start()}:{m.end()}" for m in word.finditer(t or "") if any((c, m[0].lower()) in strong for c in h))
    want = sorted((str(d), spans(t, h)) for (d, t), h in zip(docs, held, strict=True))
    got = pii.report(spark, spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((str(r.doc_id), ",".join(x for x in r.spans.split(",") if x[:1] == "t")) for r in got) == want
    assert len(strong) > 10


def test_clean_texts_are_whole(spark):
    """Spans over the edges of chunks, overlapping kinds, code points beyond 16 bits."""
    rng = random.Random(4)
    texts = [("😀" * rng.randrange(3) + "x " * rng.randrange(900) + "4111 1111 1111 1111 a.b@c.de +1 (502) 555-6996 ") * rng.randrange(1, 4) for _ in range(30)] + [t for t in TEXTS if len(t) < 5000]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r.text for r in pii.sanitise(spark, df).collect()}
    for i, t in enumerate(texts):
        out, done = [], 0
        for start, no, stop in base(t):
            if start >= done:
                out += [t[done:start], f"[{pii.KINDS[no].upper()}]"]
            done = max(done, stop)
        assert got[i] == "".join(out) + t[done:]


def test_personal_data_of_odd_input(spark):
    rows = [(None, "mail a@b.cd now"), (1, None), (1, ""), (2, "mail a@b.cd now"), (2, "mail a@b.cd now"), (3, "a@b.cd " * 20_000)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], DOCS + ", n_email int, spans string")
    got = sorted((r.doc_id or 0, r.n_email, r.n_terms) for r in pii.report(spark, df).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 0), (1, 0), (2, 1), (2, 1), (3, 20_000)]
    clean = pii.sanitise(spark, df)
    assert clean.columns == df.columns and clean.count() == len(rows) and clean.where("text is null").count() == 1
    assert pii.report(spark, df.limit(0)).count() == 0 and pii.sanitise(spark, df.limit(0)).count() == 0
