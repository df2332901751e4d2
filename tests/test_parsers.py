"""Golden values for dates, dimensions, media, artists; properties of the normalisers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillwork.operators import artist, dates, dimensions, medium

DATES = [
    ("1885", "1885", 1885, 1885), ("c. 1885", "ca. 1885", 1885, 1885), ("1885 (?)", "ca. 1885", 1885, 1885), ("ca. 1725–45", "ca. 1725-1745", 1725, 1745), ("1736–95", "1736-1795", 1736, 1795),
    ("1442/43", "1442-1443", 1442, 1443), ("2001-5", "2001-2005", 2001, 2005), ("1598-02", "1598-1602", 1598, 1602), ("1870s", "1870-1879", 1870, 1879), ("17th–18th centuries", "17th-18th century", 1601, 1800),
    ("16th century-17th century", "16th-17th century", 1501, 1700), ("first half of the 16th century", "1st half of the 16th century", 1501, 1550), ("second quarter 18th century", "2nd quarter of the 18th century", 1726, 1750),
    ("last quarter of the 18th century", "last quarter of the 18th century", 1776, 1800), ("early 18th century", "early 18th century", 1701, 1733), ("mid-19th century", "mid 19th century", 1834, 1866), ("late 18th century", "late 18th century", 1767, 1800),
    ("3rd century B.C.", "3rd century BCE", 300, 201), ("early 3rd century BCE", "early 3rd century BCE", 300, 268), ("5th-4th century BCE", "5th-4th century BCE", 500, 301), ("100 BCE-100 CE", "100 BCE-100 CE", 100, 100),
    ("before 1600", "before 1600", 1600, 1600), ("2nd millennium BCE", None, 2000, 1001), ("1905-06-12", None, 1905, 1905), ("n.d.", None, None, None), ("", None, None, None), (None, None, None, None),
]


def test_dates(spark):
    rows = spark.createDataFrame([(r[0],) for r in DATES], "raw string").coalesce(1).withColumn("n", dates.normalize_date(F.col("raw"))).withColumn("again", dates.normalize_date(F.col("n")))
    found = rows.withColumn("p", dates.parse_with_fallback(F.col("raw"), F.col("n"))).collect()
    for want, r in zip(DATES, found, strict=True):
        assert (r.n, r.p and r.p.date_begin, r.p and r.p.date_end) == want[1:], want[0]
        assert r.again == r.n, "a normalised date stays as it is"
        assert not r.p or (r.p.date_begin >= r.p.date_end if r.p.date_begin_bce and r.p.date_end_bce else r.p.date_begin_bce or r.p.date_begin <= r.p.date_end)


def test_anomalies(spark):
    rows = [(1900, 1800, False, False, True), (2027, 2027, False, False, True), (100, 200, True, True, True), (100, 100, False, True, True), (2000, 1500, True, False, True), (500, 301, True, True, False), (1900, None, False, False, False)]
    df = spark.createDataFrame(rows, "date_begin int, date_end int, date_begin_bce boolean, date_end_bce boolean, want boolean")
    for r in df.withColumn("got", dates.anomalous(F.struct(*df.columns[:4]))).collect():
        assert r.got == r.want, r


DIMENSIONS = [
    ("24.7 × 35.9 cm (9 3/4 × 14 3/16 in.)", "height 24.7 cm x width 35.9 cm"), ("height 130 mm x width 80 mm", "height 13.0 cm x width 8.0 cm"), ("diameter 24 mm x weight 6.5", "diameter 2.4 cm x weight 6.5 g"),
    ("Sheet: 10 1/2 x 8 in. (26.7 x 20.3 cm)", "sheet: height 26.7 cm x width 20.3 cm"), ("5 in. (12.7 cm)", "height 12.7 cm"), ("height 0 mm x width 80 mm", "width 8.0 cm"), ("H. 5 in. (12.7 cm); Diam. 3 in. (7.6 cm)", "height 12.7 cm x diameter 7.6 cm"), ("unknown", None), (None, None),
]


def test_dimensions(spark):
    df = spark.createDataFrame(DIMENSIONS, "raw string, want string").withColumn("got", dimensions.format_dimensions(dimensions.parse_dimensions(F.col("raw"))["dims"]))
    for r in df.withColumn("again", dimensions.format_dimensions(dimensions.reparse_dimensions(F.col("got")))).collect():
        assert r.got == r.want == r.again, r
    assert len(dimensions.shapes()) == 54 and len({s[0] for s in dimensions.shapes()}) == 54


def test_reparse_rejects(spark):
    df = spark.createDataFrame([("a: height 10 cm ; b: height 5 in",), ("weight 1.5 kg",), ("",)], "t string").select(dimensions.format_dimensions(dimensions.reparse_dimensions(F.col("t"))).alias("x"))
    assert [r.x for r in df.collect()] == [None, "weight 1500.0 g", None]


@pytest.mark.parametrize(("text", "materials", "techniques"), [("Oil on canvas", "canvas,oil", ""), ("Oil paint on canvas", "canvas,oil paint", ""), ("Etching (gouache)", "", "etching,gouache"), ("gouache laid down on canvas", "canvas,gouache", "gouache"), ("plain", None, None)])
def test_medium(spark, text, materials, techniques):
    m = medium.extract_medium(F.lit(text))
    r = spark.range(1).select(F.array_join(m["materials"], ",").alias("m"), F.array_join(m["techniques"], ",").alias("t")).first()
    assert (r.m, r.t) == (materials, techniques)


ARTISTS = [
    ("Pablo Picasso (Spanish, 1881–1973)", "parsed", ("Pablo Picasso", "primary", "Spanish", "1881", "1973")), ("Claude Monet\nFrench, 1840–1926", "parsed", ("Claude Monet", "primary", "French", "1840", "1926")),
    ("Jane Doe (French, active 1850s)", "parsed", ("Jane Doe", "primary", "French", "1850", "1859")), ("Jane Doe (French, 19th century)", "parsed", ("Jane Doe", "primary", "French", "1800", "1899")),
    ("Workshop of X (Flemish, 1568–1594)", "unparsed", None), ("A (French, 1800–1850) and B (French, 1810–1860)", "unparsed", None), ("China", "non_artist", None),
]


def test_artists(spark):
    for want, r in zip(ARTISTS, spark.createDataFrame([(a[0],) for a in ARTISTS], "t string").coalesce(1).select(artist.parse_artist(F.col("t")).alias("p")).collect(), strict=True):
        assert r.p.status == want[1] and ([tuple(a) for a in r.p.artists] == [want[2]] if want[2] else not r.p.artists), want


def test_dispatch_by_shape_equals_the_cascade(spark):
    """Whatever the numbers, zeros and repeats included: the table form gives what the expression gives."""
    from quillwork.operators import dimensions
    from quillwork.plans.catalogue_shapes import TEXTS

    numbers = [dict(zip("abcdef", x, strict=True)) for x in (("1", "22.5", "3", "4.75", "5", "6"), ("0", "0.0", "10", "007", "1", "2"), ("123456789", "1", "0", "9.99", "12", "3"))]
    texts = [raw.format(**n) for raw, _, _ in TEXTS for n in numbers] + [None, "", "12", "x 1 cm", "1 x 2 x 3 x 4 cm", "height ٣ mm", "1" * 5000 + " x 2 cm"]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "k int, raw string").repartition(3)
    for compat in (False, True):
        out = dimensions.parse_table(df, "raw", compat_zero=compat).withColumn("same", F.col("p").eqNullSafe(dimensions.parse_dimensions(F.col("raw"), compat)))
        rows = out.collect()
        assert len(rows) == 2 * len(texts) and all(r.same for r in rows), [r.raw for r in rows if not r.same][:3]
    assert dimensions.parse_table(df.limit(0), "raw").count() == 0
