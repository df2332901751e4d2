"""Nulls, empty and long texts, repeats, ties, empty tables and clashing columns, through stages and operators that had no such test."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillwork.llm import html_text, langid, url_filter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, sequence_id string"


@pytest.fixture(scope="module")
def hostile(spark):
    """Some rows of the smallest documents among nulls, blanks, repeats of ids and rows, a long text and columns that operators make themselves."""
    some = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 0.5, 7, "x") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    text = some[0][1]
    odd = [(None, text, "fr", None, None, None, None, None), (9001, None, None, None, None, None, None, None), (9002, "", "en", "s", 0, 1.0, 1, ""), (9003, " \n\t ", "en", "s", 4, 1.0, 1, ""), (9004, "1234 5678 !", "en", "s", 11, 1.0, 1, "")]
    odd += [some[3], some[3], (some[4][0], some[5][1], "en", "again", 1, 0.0, 0, "y"), (9005, "the word " * 12_000, "en", "s", 1, 1.0, 1, "z"), (9006, text, "fr", "copy", 1, 1.0, 1, "z")]
    return spark.createDataFrame(some + odd, SCHEMA).repartition(3)


def test_stages_on_hostile_rows(spark, hostile):
    toxicity, language, near, packing = (f for _, f in corpus_pipeline.STAGES)
    clean = toxicity(spark, hostile, SF)
    assert clean.columns == hostile.columns and clean.exceptAll(hostile).count() == 0
    assert clean.where("doc_id in (9001, 9002, 9003, 9004) or doc_id is null").count() == 5
    known = language(spark, hostile, SF)
    assert known.columns == hostile.columns and known.exceptAll(hostile).count() == 0
    assert known.where("doc_id in (9001, 9002, 9003, 9004)").count() == 0 and known.where("doc_id is null").count() == 1
    kept = near(spark, hostile, SF)
    assert kept.columns == hostile.columns and kept.exceptAll(hostile).count() == 0
    assert kept.where("doc_id in (9001, 9002, 9003) or doc_id is null").count() == 4 and kept.where("doc_id = 9006").count() == 0
    pieces = packing(spark, hostile, SF)
    assert pieces.where("length > 4096 or offset + length > 4096").count() == 0
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in hostile.select("doc_id").distinct().collect()}


def test_stages_on_empty_tables(spark, hostile):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, hostile.limit(0), SF)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == hostile.columns, name


def test_pages_without_rows_repeated_and_null(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><p>" + "Many words stand in this paragraph of the text. " * 5 + "</p></article></body></html>"
    rows = [(1, "u", page, "clash", 5), (1, "u", page, "clash", 5), (None, None, page, "c", 1), (2, "v", None, "c", 1), (3, "w", "", "c", 1), (4, "x", page.replace("this", "that " * 40_000), "c", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(pages).collect()
    assert len(got) == 6 and sum(r.page_id == 1 for r in got) == 2 and len({r.text for r in got if r.page_id in (1, None)}) == 1
    assert {r.page_id: r.n_chars for r in got if r.page_id in (2, 3)} == {2: 0, 3: 0} and next(r for r in got if r.page_id == 4).n_chars > 100_000
    assert html_text.extract(pages.limit(0)).count() == 0


def test_very_long_urls(spark):
    long = "http://" + "a." * 50_000 + "example.com/en/" + "x" * 200_000 + "?q#f"
    pages = spark.createDataFrame([(1, long), (1, long), (2, "x" * 100_000), (3, None), (4, "")], "page_id long, url string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    rule, verdict = url_filter.rule_for(host, path)
    got = pages.select("page_id", F.length(host).alias("h"), F.length(path).alias("p"), rule.alias("rule"), verdict.alias("verdict")).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, 100_011, 200_004, "example.com/en/", "block")] * 2 + [(2, 0, 0, None, None), (3, 0, 0, None, None), (4, 0, 0, None, None)]


def test_no_model_identifies_nothing(spark, hostile):
    assert langid.fit(hostile.withColumn("lang", F.lit(None).cast("string"))) is None
    assert langid.keep_identified(hostile, None).count() == hostile.count()
