"""Operators on pairs against brute force, the pipeline's stages, and the guard around this subpackage."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillwork.llm import near_vectors, ngram_join
from quillwork.llm.common import Scratch, components


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else (tuple(words[i : i + 5]) for i in range(len(words) - 4)))


def brute_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    links = [(a, b) for (a, b), k in shared.items() if 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k)]
    return {i: (len(sets[i]), c) for i, c in union_find(sets, links).items()}


def hard_rows(n=400, seed=4):
    """Chains of edits, boilerplate that many share, tiny texts, copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdef", k=4))
    bases = [[word() for _ in range(r.randint(6, 60))] for _ in range(12)]
    plate = [word() for _ in range(40)]
    rows = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = word()
        if r.random() < 0.3:
            w = plate + w[: r.randint(0, 12)]
        if r.random() < 0.1:
            w = w[: r.randint(0, 4)]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("range_rows", "hot", "few"), [(500_000, None, 4), (300, 3.0, 0), (2_000, 50.0, 10**9)])
def test_ngram_join_is_brute_force(spark, monkeypatch, range_rows, hot, few):
    """As it is; with hubs wherever a list has anything left, and shingles dealt by salt; with all pairs at once."""
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", 1_024 if hot is None else 7)
    monkeypatch.setattr(ngram_join, "EACH", 0 if few == 0 else ngram_join.EACH)
    rows = hard_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), range_rows=range_rows, hot=hot).collect()}
    assert got == brute_classes(rows)


def template_rows():
    """Texts that share one shingle with two others, in a short list, and all further ones with everybody, in lists whose entries have few shingles left."""
    return [(i, f"p{i % 2} {' '.join(f'm{k}' for k in range(2, 11))} s{i}") for i in range(6)]


def test_ngram_join_short_lists_of_templates(spark):
    r = random.Random(11)
    rows = template_rows()
    for t in range(30):  # more of the kind, with other lengths and groups, apart by their words
        m = [f"t{t}m{k}" for k in range(r.randint(7, 30))]
        rows += [(len(rows) + i, " ".join([f"t{t}p{i % 3}", *m, f"t{t}s{i}"])) for i in range(r.randint(5, 12))]
    for some in (template_rows(), rows):
        want = brute_classes(some)
        assert len({c for _, c in want.values()}) < len(some)
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.classes(spark.createDataFrame(some, "doc_id long, text string")).collect()}
        assert got == want


def test_marks_never_rule_out_more_than_differs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, shared = int(rng.integers(1, 300)), rng.integers(0, 1 << 63, 400).astype(np.uint64)
        sets = [np.unique(np.concatenate([shared[:n], rng.integers(0, 1 << 63, int(rng.integers(0, 120))).astype(np.uint64)])) for _ in range(2)]
        one, two = (ngram_join.marks(x, np.zeros(len(x), np.int64), np.array([len(x)]))[0] for x in sets)
        assert ngram_join.differ_at_least(one, two) == ngram_join.differ_at_least(two, one) <= len(np.setxor1d(*sets))
        assert ngram_join.differ_at_least(one, one) == 0


def test_ngram_join_of_a_large_group_verifies_few_pairs(spark, tmp_path, monkeypatch):
    """600 near copies, each like a part of the others only: the classes are those of brute force, with few verified pairs for each text."""
    r = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600):
        w = list(base)
        for _ in range(r.randint(0, 2)):
            w[r.randrange(60)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(5_000 + i, " ".join(base[:12]) + " " + " ".join(f"o{i}q{k}" for k in range(40))) for i in range(100)]
    verify = ngram_join._verify

    def counted(size):
        run = verify(size)

        def counting(batches):
            for b in batches:
                (tmp_path / f"{random.Random().random()}").write_text(str(b.num_rows))
                yield from run(iter([b]))

        return counting

    monkeypatch.setattr(ngram_join, "_verify", counted)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    verified = sum(int(p.read_text()) for p in tmp_path.iterdir())
    assert verified < 20 * len(rows)
    assert got == brute_classes(rows)


def thue_morse(letters, n=11):
    word = letters[0]
    for _ in range(n):
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


def test_words_of_one_rule_are_not_alike(spark):
    """Thue-Morse words and their complements, which a polynomial hash modulo a power of two takes for equal."""
    one, two = thue_morse("ab"), thue_morse("ba")
    rows = [(1, f"{one} x y z u"), (2, f"{two} x y z u"), (3, f"{one.upper()} x y z u")]
    got = {r.doc_id: r.component_id for r in ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_keep_one_with_repeated_ids(spark):
    long = " ".join(f"k{i}" for i in range(40))
    rows = [(1, long, 1), (1, "quite another text that nothing is like", 1), (2, long + " more", 2), (3, long, 3), (3, "alone it stands here and stays", 3), (4, "alone it stands here and stays", 4), (4, "", 4), (None, long, 5), (5, None, 6), (6, "twice the very same row here", 7), (6, "twice the very same row here", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __rank int")
    got = Counter((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect())
    assert got == Counter([(1, long), (1, rows[1][1]), (3, rows[4][1]), (4, ""), (None, long), (5, None), (6, rows[9][1])])


def test_ngram_join_odd_inputs(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "A b", "x"), (4, "a  B", "x"), (5, "a b c", "x"), (7, "w " * 9, "y"), (7, "w " * 9, "y"), (None, "a b", "z"), (8, "long text here " * 20_000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sig string")
    got = Counter(map(tuple, ngram_join.classes(df).collect()))
    assert got == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 1, 3): 1, (4, 1, 3): 1, (5, 1, 5): 1, (7, 1, 7): 2, (None, 1, None): 1, (8, 3, 8): 1})
    assert sorted((r.doc_id or -1) for r in ngram_join.keep_one(df).collect()) == [-1, 1, 2, 3, 5, 7, 8]
    assert ngram_join.keep_one(df).columns == df.columns
    assert ngram_join.classes(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(5)
    for links in ([(i, i + 1) for i in range(60)], [(r.randrange(200), r.randrange(200)) for _ in range(150)], [(0, i) for i in range(1, 40)], []):
        for local in (0, 1 << 20):
            got = {x.id: x.component for x in components(spark, Scratch(spark), spark.createDataFrame(links, "a long, b long"), local_edges=local).collect()}
            want = union_find({n for e in links for n in e}, links)
            assert all(want[n] == c for n, c in got.items()) and all(n in got for a, b in links if a != b for n in (a, b))


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 32))
    x = np.concatenate([np.repeat(base[:8], 12, axis=0) + 0.06 * rng.normal(size=(96, 32)), np.repeat(base[8:10], 5, axis=0), base]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, [1.0, None], 1), (904, [1.0] * 32, None), (905, [2.0] * 7, 0), (906, [3.0] * 7, 0), (None, [1.0] * 32, 1), (907, [], 1)]
    want = {r[0]: [0, r[0]] for r in rows}
    good = [(i, np.array(v, dtype=np.float64), lab) for i, v, lab in rows if i is not None and i < 900] + [(905, np.full(7, 2.0), 0), (906, np.full(7, 3.0), 0)]
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[:k] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93]
    for a, b in links:
        want[a][0] += 1
        want[b][0] += 1
    for i, c in union_find([g[0] for g in good], links).items():
        want[i][1] = c
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("clash"))
    for block in (4096, 16):
        got = {r.vec_id: [r.n_links, r.component_id] for r in near_vectors.near_duplicates(df, block=block).collect()}
        assert set(got) == set(want)
        found = sum(n for n, _ in got.values())
        assert found >= 0.9 * sum(n for n, _ in want.values()), "recall"
        assert all(got[i][0] <= want[i][0] for i in want), "no link below the threshold"
        assert all(got[i] == want[i] for i in want if i is None or i >= 900)
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize(("dim", "total"), [(64, 200_000), (256, 2_000_000), (256, 30_000_000), (768, 300_000_000)])
def test_index_recall_of_pairs_just_above_the_threshold(dim, total):
    """Grids of up to 774 x 774 cells on vectors without any structure, the hardest case: pairs at cosine 0.935 are met 9 times of 10 at least."""
    rng = np.random.default_rng(2)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    index = near_vectors.fit_index(unit(rng.normal(size=(near_vectors.sample_size(total), dim))), total)
    assert 1 <= index.visits < index.size**2
    one = unit(rng.normal(size=(2_000, dim)))
    turn = rng.normal(size=one.shape)
    two = 0.935 * one + np.sqrt(1 - 0.935**2) * unit(turn - (turn * one).sum(1)[:, None] * one)
    d, e = index.distances(one), index.distances(two)
    bounds = index.limit(*d), index.limit(*e)
    cells = d[0][:40, :, None] + d[1][:40, None, :]
    assert ((cells <= bounds[0][:40, None, None]).sum((1, 2)) == index.visits).all(), "the traversal visits that many cells, the nearest ones"
    n = np.arange(len(one))
    met = (d[0][n, e[0].argmin(1)] + d[1][n, e[1].argmin(1)] <= bounds[0]) | (e[0][n, d[0].argmin(1)] + e[1][n, d[1].argmin(1)] <= bounds[1])
    assert met.mean() >= 0.9, met.mean()


def test_near_vectors_in_doubles(spark):
    """A pair whose cosine passes the threshold in doubles only."""
    c = 0.93 + 1e-10
    rows = [(1, [1.0, 0.0], 0), (2, [c, float(np.sqrt(1 - c * c))], 0), (3, [0.93 - 1e-10, -float(np.sqrt(1 - (0.93 - 1e-10) ** 2))], 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_near_vectors_of_any_length(spark):
    """Components whose squares over- or underflow still link by their direction."""
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1.01e-300], 0), (3, [-1e300, 1e300], 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scratch, now = Scratch(spark), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = scratch.write(stage(spark, now, sf))
        assert after.columns == docs.columns, name
        assert after.exceptAll(now).count() == 0 and after.count() > 0.5 * now.count(), name
        if name == "ngram_join":
            classes = brute_classes([(r.doc_id, r.text) for r in now.collect()])
            assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in classes.items() if i == c}
        now = after
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in now.collect()}
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_the_rest_does_not_need_this_subpackage():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[2]
    for p in (root / "quillwork").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import)\s.*\bllm\b", p.read_text(), re.M), p
