"""Every query of the catalogue against DuckDB on the smallest tables."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

from quillwork.plans import catalogue, catalogue_linked, catalogue_records, catalogue_shapes, catalogue_tables  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    return int(v) if isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in catalogue.ORACLE:
        found = duck.execute(catalogue.ORACLE[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == columns
        assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)


def test_template_induction_of_long_ids(spark, duck, tmp_path):
    """Numbers of five digits and more are one mask in a conversation's line, as in the SQL."""
    duck.execute(f"copy (select conv_id + n * 100000 as conv_id, turn, role, text from conversations, range(2) t(n)) to '{tmp_path}/conversations.parquet' (format parquet)")
    got = sorted(tuple(r) for r in catalogue.QUERIES["template_induction"](spark, str(tmp_path)).select("template", "n", "example").collect())
    sql = catalogue.ORACLE["template_induction"].replace("FROM conversations", f"FROM '{tmp_path}/conversations.parquet'")
    assert got == sorted(tuple(r) for r in duck.execute(f"select template, n, example from ({sql})").fetchall())
