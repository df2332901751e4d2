"""Properties and small cases of the other operators."""

from __future__ import annotations

import html
import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.functions import lists, text
from quillwork.operators import evaluate, inject, knowledge, pairs, providers, sampling, templates, vectors, vocab
from quillwork.plans import pipeline
from quillwork.schema import CANONICAL_COLUMNS, HARVESTED_COLUMNS
from quillwork.sources import records, remote, scans, sinks


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, text.similar_strict(F.lit("new york"), F.lit("new delhi"))) is False
    assert one(spark, text.similar_loose(F.lit("new york"), F.lit("new delhi"))) is True
    assert one(spark, text.dedupe_artist(F.lit("[rembrandt, rembrandt van rijn]"))) == "rembrandt van rijn"
    assert [one(spark, lists.clean_year(F.lit(x))) for x in ("ca. 1850s", "87 AD", "{}")] == ["1850", "87", None]
    assert one(spark, text.propagate(F.lit("Monet's garden, by MONET"), F.lit("monet"), F.lit("A. $1 B"))) == "A. $1 B's garden, by A. $1 B"
    assert one(spark, text.strip_html(F.lit("<p>a&nbsp;b<br>c &amp; d</p>"))) == "a b c & d"
    for raw in ("&lt;b&gt; &euro;&Aacute;&CounterClockwiseContourIntegral;&amp;lt;&#233;&#xE9;", "&fjlig; & &no; &#1114112; &;", "&bne;&amp;#65;", "none", ""):
        assert one(spark, text.references(F.lit(raw))) == (raw if "&no;" in raw else html.unescape(raw)).replace("&fjlig;", "fj")
    assert one(spark, text.nfkc(F.lit("½ ﬁ"))) == "1⁄2 fi"
    assert one(spark, text.date_label(F.lit(300.0), F.lit(200.0), F.lit(True), F.lit(True))) == "300 BCE - 200 BCE"
    assert one(spark, text.json_from_model(F.lit("```json\n{\"a\": 1}\n```"), "a int")["a"]) == 1
    assert one(spark, lists.parse_number(F.lit("5 1/2"))) == 5.5
    assert one(spark, text.anonymous_for_injection(F.lit("fernando"))) is False
    assert one(spark, text.anonymous_for_injection(F.lit("fernando"), compat=True)) is True


def test_century_shift_has_no_year_zero(spark):
    def shift(y, bce, s):
        r = spark.range(1).select(inject.century_shift(F.lit(y), F.lit(y), F.lit(bce), F.lit(bce), F.lit(s)).alias("s")).first().s
        return r and (r.date_begin, r.date_begin_bce)

    assert shift(100, False, -100) == (1, True)
    assert shift(50, True, 100) == (51, False)
    assert shift(2000, False, 100) is None


def test_quotas_and_assignment(spark):
    assert sampling.quotas({"a": 50, "b": 30, "c": 20}, 7) == {"a": 4, "b": 2, "c": 1}
    assert sum(sampling.quotas({f"s{k}": k + 1 for k in range(19)}, 1003).values()) == 1003
    eligible = spark.range(200).select(F.col("id"), F.explode(F.array(F.lit("mut"), F.lit("scale_error"))).alias("subtype"))
    edges = spark.range(0, 198).select(F.lit("swap").alias("subtype"), F.col("id").alias("id_a"), (F.col("id") + 1).alias("id_b"))
    out = sampling.assign(eligible, edges, {"swap": 21, "mut": 10, "scale_error": 5}, sinks.cutter(spark)).collect()
    assert len({r.id for r in out}) == len(out), "each id once"
    assert {s: sum(r.subtype == s for r in out) for s in ("swap", "mut", "scale_error")} == {"swap": 20, "mut": 10, "scale_error": 6}
    partner = {r.id: r.partner for r in out if r.subtype == "swap"}
    assert all(partner[p] == i for i, p in partner.items())


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    assert [r.id for r in sampling.hash_sample(df, "id", 20).collect()] == [r.id for r in sampling.hash_sample(df.repartition(7), "id", 20).collect()]


def test_matching_is_the_sequential_one(spark):
    rng = np.random.default_rng(3)
    edges = sorted({(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 60, (400, 2)) if a != b})
    scored = [(a, b, round(float(rng.random()), 3)) for a, b in edges]
    used, want = set(), set()
    for a, b, _ in sorted(scored, key=lambda e: (-e[2], e[0], e[1])):
        if not {a, b} & used:
            used |= {a, b}
            want.add((a, b))
    got = pairs.disjoint_matching(spark.createDataFrame(scored, "id_a long, id_b long, score double"), sinks.cutter(spark)).collect()
    assert {(r.id_a, r.id_b) for r in got} == want


def test_shares_stop_behind_the_crossing_row(spark):
    df = spark.createDataFrame([("t", r) for r, n in (("a", 60), ("b", 25), ("c", 10), ("d", 5)) for _ in range(n)], "term string, region string")
    assert {r.region: r.n for r in knowledge.regional_share(df, "term", "region").collect()} == {"a": 60, "b": 25, "c": 10}


def test_cooccurrence(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "c")], "r int, term string")
    got = {(r.term, r.neighbour): (r.n, r.probability) for r in knowledge.cooccurrence(df, "r", "term", 1, 2).collect()}
    assert got == {("a", "b"): (2, 0.6667), ("b", "a"): (2, 1.0)}


def test_jaccard_must_be_over_the_limit(spark):
    df = spark.createDataFrame([("p", ["x", "y", "z"]), ("q", ["y", "z", "w"])], "k string, items array<string>")
    assert knowledge.jaccard_adjacency(df, "k", "items").count() == 0


def test_swap_twice_is_identity(spark):
    df = spark.createDataFrame([(1, "Ann", "c1"), (2, "Bob", "c2")], "object_ID int, culture string, location string")
    edges = spark.createDataFrame([(1, 2)], "id_a int, id_b int")
    once = inject.swap(df, edges, "culture").select("object_ID", F.col("culture_error").alias("culture"), F.col("location_error").alias("location"))
    assert sorted(map(tuple, inject.swap(once, edges, "culture").select("object_ID", "culture_error", "location_error").collect())) == sorted(map(tuple, df.collect()))


def test_shadows_leave_clean_rows_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "object_ID int, culture string")
    out = inject.shadows(df, spark.createDataFrame([(1, "x")], "object_ID int, culture_error string"), "culture", "culture_adjacent").orderBy("object_ID").collect()
    assert [(r.culture_error, r.error_type) for r in out] == [("x", "culture"), (None, None)]


def test_templates(spark):
    assert one(spark, templates.mask_dimensions(F.lit("Diam. 5 1/2 in. (14 cm)"))) == "<DIAM> <NUM> <IN> (<NUM> <CM>)"
    assert one(spark, templates.project_number(F.lit(10.0), F.array(F.lit(10.0)), F.array(F.lit(12.0)))) == 12.0
    assert one(spark, templates.project_text(F.lit("Paris, France"), F.lit("made in paris france"), F.lit("made in rome italy"))) == "Rome, Italy"


def test_vocabulary(spark):
    assert one(spark, vocab.map_list(F.array(F.lit("Oil "), F.lit("x"), F.lit("oil"), F.lit("y")), {"oil": "oil paint", "y": "discard"})) == ["oil paint", "x"]
    assert one(spark, vocab.artist_key(F.lit("A"), F.lit(None), F.lit("French"), F.lit("b. 1840"), F.lit(None))) == "a||french|1840|"
    assert one(spark, vocab.canonical_location(F.lit("Dutch ()"), {})) == "Netherlands"


def test_evaluation(spark):
    r = evaluate.confusion(spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "t boolean, p boolean"), F.col("t"), F.col("p")).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.f1, r.accuracy) == (1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5)
    empty = evaluate.confusion(spark.createDataFrame([], "t boolean, p boolean"), F.col("t"), F.col("p")).first()
    assert (empty.precision, empty.recall, empty.accuracy) == (0, 0, 0)


def test_providers_use_the_cache(spark):
    asked = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("a", "p1")], "key string, prompt string")
    cache = spark.createDataFrame([("a", "known")], "key string, answer string")
    got = {r.key: (r.answer, r.fresh) for r in providers.answers(asked, cache=cache).collect()}
    assert got == {"a": ("known", False), "b": ("{}", True)}
    assert providers.call(lambda ps: 1 / 0, ["x", "y"], attempts=1) == ["{}", "{}"]


def test_top_k_is_brute_force(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(60)
    rows = e.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    got = vectors.top_k(e, e, "vec_id", "embedding", 2, block=200).orderBy("query", "rank").collect()
    want = [rows[j].vec_id for i in range(len(rows)) for j in np.argsort(-s[i])[:2]]
    assert [r.neighbour for r in got] == want


def test_pipeline_end_to_end(spark, tmp_path):
    row = {c: None for c in HARVESTED_COLUMNS} | {"object_ID": "7", "title": "View", "date": "c. 1725–45", "medium": "Oil on canvas", "dimensions": "5 in. (12.7 cm)", "culture": "French", "country": "France", "artist_display_bio": "Claude Monet\nFrench, 1840–1926"}
    df = spark.createDataFrame([tuple(row[c] for c in HARVESTED_COLUMNS)], ", ".join(f"{c} string" for c in HARVESTED_COLUMNS))
    sinks.export_csv(df, str(tmp_path / "in"))
    out = pipeline.curate(scans.csv_strings(spark, str(tmp_path / "in")), "MET_")
    assert out.columns == CANONICAL_COLUMNS
    r = out.first()
    assert (r.object_ID, r.date_begin, r.date_end, r.materials, r.artist_name, r.artist_date_begin) == ("MET_7", 1725, 1745, ["canvas", "oil"], "claude monet", 1840)
    assert r.dimensions_json.parts[0].measurements[0].value == 12.7


def test_json_scan_counts_unreadable_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": {"id": 1, "title": "t", "date_start": 0, "date_end": 1900, "image_id": None, "alt_image_ids": ["z"], "is_public_domain": True, "description": "<p>x</p>"}}))
    (tmp_path / "b.json").write_text("{broken")
    fields = "id long, title string, date_start int, date_end int, date_display string, image_id string, alt_image_ids array<string>, is_public_domain boolean, description string"
    df = scans.unwrap_envelope(scans.json_objects(spark, str(tmp_path), f"data struct<{fields.replace(' ', ':').replace(',:', ',')}>, {fields}"), [f.split()[0] for f in fields.split(", ")])
    got = {r.file: r.reason for r in df.select("file", records.dump_skip_reason().alias("reason")).collect()}
    assert got == {"a.json": None, "b.json": "load_error"}


def test_rdf_fills_only_gaps(spark):
    xml = '<rdf:RDF xmlns:rdf="r" xmlns:dc="d"><ore:Aggregation rdf:about="u:1"><edm:isShownBy rdf:resource="http://i/1.jpg"/></ore:Aggregation><dc:medium>paper</dc:medium><dc:date>1700</dc:date></rdf:RDF>'
    df = spark.createDataFrame([("kept", None, None, xml)], "date string, material string, image_url string, xml string")
    r = records.fill_from_rdf(df).withColumn("uri", records.aggregated_uri(F.col("xml"))).first()
    assert (r.date, r.material, r.image_url, r.uri) == ("kept", "paper", "http://i/1.jpg", "u:1")


def test_fetcher_retries_and_sources_list_ids():
    class Opener:
        def __init__(self, log):
            self.log = log

        def open(self, url, timeout):
            self.log.append(url)
            if len(self.log) < 3:
                raise OSError("down")
            return io.BytesIO(b"ok")

    log = []
    assert remote.Fetcher(opener=lambda: Opener(log), sleep=lambda s: None)("u") == "ok" and len(log) == 3
    reader = remote.ObjectReader({"url": "http://x/{id}", "ids": "1,2|2,3", "chunk": "2"})
    assert [p.ids for p in reader.partitions()] == [["1", "2"], ["3"]]
    assert remote.next_token('{"resumptionToken": "abc"}', "resumptionToken") == "abc"
    assert remote.next_token("<oai:resumptionToken size='2'>t</oai:resumptionToken>", "resumptionToken") == "t"


def test_stream_resume_appends_once(spark, tmp_path):
    from quillwork.streaming.resume import append_stream

    src, out = tmp_path / "src", tmp_path / "out"
    spark.range(5).write.parquet(str(src))
    for k in range(2):
        append_stream(spark.readStream.schema("id long").parquet(str(src)), str(out), "id", str(tmp_path / f"cp{k}")).awaitTermination(60)
    assert spark.read.parquet(str(out)).count() == 5


def test_updates_keep_what_is_there(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b")], "k int, v string")
    assert sorted(map(tuple, sinks.updated(old, new, "k", ["v"]).collect())) == [(1, "a"), (2, "b")]


def test_disjoint_matching_never_leaves_edges_silently(spark):
    path = spark.createDataFrame([(i, i + 1, 1.0) for i in range(5)], "id_a long, id_b long, score double")
    assert sorted((r.id_a, r.id_b) for r in pairs.disjoint_matching(path, sinks.cutter(spark)).collect()) == [(0, 1), (2, 3), (4, 5)]
    with pytest.raises(RuntimeError):
        two = spark.createDataFrame([(1, 2, 10.0), (3, 4, 10.0), (0, 1, 5.0), (0, 3, 4.0), (0, 5, 3.0)], path.schema)
        pairs.disjoint_matching(two, sinks.cutter(spark), most_rounds=1)


@pytest.mark.parametrize("above", [0.0, 0.25, 0.5, 0.8, 0.99])
def test_like_sets_are_found_by_prefixes(spark, above):
    rng = np.random.default_rng(4)
    sets = [(f"k{i}", sorted({"common", *(f"i{j}" for j in rng.zipf(1.4, rng.integers(1, 12)) % 40)})) for i in range(80)] + [("e", []), ("n", ["x", None]), ("n2", ["x", None])]
    got = {(r.a, r.b): round(r.jaccard, 9) for r in knowledge.jaccard_adjacency(spark.createDataFrame(sets, "k string, items array<string>"), "k", "items", above).collect()}
    want = {}
    for a, x in sets:
        for b, y in sets:
            same = len({*x} & {*y} - {None})
            if a != b and same and same / (len(x) + len(y) - same) > above:
                want[a, b] = round(same / (len(x) + len(y) - same), 9)
    assert got == want
