"""Table functions and linked-data records: hand-made documents with every branch, and odd input."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from quillwork.functions import tables
from quillwork.sources import linked_data as ld

EN, NL = ld.ENGLISH, ld.DUTCH


def name(text, *languages):
    return {"type": "Name", "content": text, "language": [{"id": x} for x in languages]}


DOCUMENTS = {
    "u/o1": {
        "id": "u/o1", "identified_by": [name("One", EN), name("Een", NL), name(" One ", EN), name("none", "x"), {"type": "Identifier", "content": "7"}],
        "produced_by": {
            "carried_out_by": {"id": "u/p1", "type": "Person"},
            "assigned_by": [{"assigned_property": "carried_out_by", "classified_as": [{"id": ld.REJECTED}], "assigned": {"id": "u/p2", "type": "Person"}}, {"assigned_property": "other", "assigned": {"id": "u/p2", "type": "Person"}}, {"assigned_property": "carried_out_by", "assigned": [{"type": "Production", "carried_out_by": {"id": "u/p1", "type": "Actor"}}, {"type": "Group", "formed_by": {"influenced_by": {"id": "u/lost", "type": "Person"}}}]}],
        },
        "subject_of": {"type": "LinguisticObject", "language": [{"id": NL}], "part": [{"type": "LinguisticObject", "content": "Over <b>een</b><br/>ding", "classified_as": ld.DESCRIPTION}, {"type": "LinguisticObject", "content": "later", "classified_as": [ld.DESCRIPTION]}]},
        "referred_to_by": [{"content": "x" * 50, "language": {"id": EN}}, {"content": "y" * 45, "language": {"id": EN}, "classified_as": {"id": ld.LABEL}}, {"content": "z" * 60, "language": {"id": EN}, "classified_as": {"id": ld.CREDIT}}],
        "current_location": {"identified_by": [{"type": "Name", "content": "Room 4", "part": [{"type": "Name", "content": "HG-2"}, {"type": "Name", "content": "Gallery"}]}]},
    },
    "u/o2": {"id": "u/o2", "produced_by": {"carried_out_by": [{"id": "u/p1", "type": "Person"}, {"id": "u/p2", "type": "Person"}], "part": {"took_place_at": "https://x/pl"}}, "current_location": "https://x/pl", "subject_of": {"subject_to": {"classified_as": {"_label": "open"}}}},
    "u/p1": {"identified_by": name("Ann", EN), "born": {"timespan": {"begin_of_the_begin": "1601", "end_of_the_end": "1602"}, "took_place_at": {"id": "https://x/pl"}}, "carried_out": [{"classified_as": [{"id": "u/c1"}, {"id": "u/c2"}]}]},
    "u/p2": {"identified_by": name("Bob", EN)},
    "u/c1": {"identified_by": name("weaver", EN)}, "u/c2": {"identified_by": name("dyer", EN, NL)},
    "https://x/pl": {"identified_by": name("Town", EN)},
}


def test_wide_records(spark):
    rows = [(u, json.dumps(d)) for u, d in DOCUMENTS.items()] + [("u/o3", "[1]"), ("u/o4", "{"), ("u/o4", None), ("u/o1", "~ sorts behind")]
    documents = spark.createDataFrame(rows, "uri string, doc string")
    objects = spark.createDataFrame([("u/o1",), ("u/o1",), ("u/o2",), ("u/o3",), ("u/o4",), ("u/none",)], "uri string")
    got = {r.uri: r for r in ld.records(objects, documents).collect()}
    assert sorted(got) == ["u/none", "u/o1", "u/o2", "u/o3", "u/o4"]
    one, two = got["u/o1"], got["u/o2"]
    assert one.object_ID == "o1" and one.title == {"English": ["One"], "Dutch": ["Een"]} and one.cho_uri == "u/o1"
    assert one.artist_name == {"English": ["Ann"]} and one.artist_role == {"English": ["dyer", "weaver"], "Dutch": ["dyer"]} and one.artist_date_begin == "1601" and one.artist_place_of_birth == {"English": ["Town"]} and one.artist_date_end is None
    assert one.description == {"Dutch": "Over een ding", "English": "y" * 45} and one.current_location == {"und": ["Gallery"]}
    assert two.artist_name is None and two.country == two.current_location == {"English": ["Town"]} and two.rights == "open"
    assert all(v is None for k, v in got["u/o3"].asDict().items() if k not in ("object_ID", "uri"))
    assert ld.records(objects.limit(0), documents).count() == 0


def test_wide_records_join_no_part_and_hold_no_document_twice(spark):
    """A join for each part held a sort for each in one task, and documents were sorted as they were read."""
    docs = spark.createDataFrame([(f"u/{i}", json.dumps({"id": f"u/{i}", "classified_as": [{"_label": "cup"}]})) for i in range(50)] + [(None, "{}"), ("u/0", "{")], "uri string, doc string")
    objects = docs.select("uri").unionByName(spark.createDataFrame([("u/none",), ("u/1",)], "uri string"))
    out = ld.records(objects, docs)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "LeftOuter" in x]
    rows = {r.object_ID: r for r in out.collect()}
    assert out.count() == len(rows) == 52 and rows["1"].object_name == {"und": ["cup"]} and rows["none"].cho_uri is None and rows[None].cho_uri is None
    few = ld._dealt(docs, 40_000, 1_000)
    assert few.rdd.getNumPartitions() == 40 and ld._dealt(docs, 0, 1_000).count() == 52


def test_makers_in_order(spark):
    made = {"produced_by": {"part": [{"assigned_by": {"assigned_property": "carried_out_by", "assigned": {"type": "Group", "formed_by": {"influenced_by": [{"id": "w", "type": "Person"}]}}}, "carried_out_by": {"id": "b", "type": "Person"}}], "assigned_by": {"assigned_property": "carried_out_by", "assigned": {"id": "a", "type": "Actor"}}, "carried_out_by": {"id": "z", "type": "Person"}}}
    rows = ld.nodes(spark.createDataFrame([("u", json.dumps(made))], "uri string, doc string"))
    assert [(r.person, r.workshop) for r in ld.makers(rows).orderBy("o").collect()] == [("z", False), ("a", False), ("b", False), ("w", True)]


def test_table_functions_pass_over_what_they_cannot_read(spark):
    tables.register(spark)
    deep = '{"a":' * 400 + "{}" + "}" * 400
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "[]"), (4, "{"), (5, deep), (6, '["x", 3, null, {"raw": "y", "numbers": [1, true, "2", 2.5]}, {"raw": 1}]'), (7, "<a><b c='d'>t</b><b/></a>")], "k int, x string")
    def count(fn):
        return {r.k: r.n for r in spark.sql(f"SELECT d.k, count(*) AS n FROM {{texts}} d, LATERAL {fn}(d.x) t GROUP BY d.k", texts=texts).collect()}

    assert count("ld_nodes") == {5: 401} and count("xml_tree") == {7: 3}
    assert sorted(map(tuple, spark.sql("SELECT t.* FROM {texts} d, LATERAL template_members(d.x) t WHERE d.k = 6", texts=texts).collect())) == [(0, "x", None), (3, "y", [1.0, 2.5])]


def test_tree_with_rings_and_two_roots(spark):
    sets = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("c", "d"), ("d", "gone"), ("x", "y"), ("y", "x"), ("b", "c")], "id string, parent string")
    assert sorted(map(tuple, ld.tree_listing(sets).collect())) == [("a", "a", 0), ("b", "a", 1), ("b", "d", 2), ("c", "a", 2), ("c", "d", 1), ("d", "d", 0)]
    assert ld.tree_listing(sets.where(F.lit(False))).count() == 0


def test_values_of_xml_are_those_of_xpath(spark):
    """One parse of a record finds what XPath finds; broken records give nothing and stop nothing."""
    from quillwork.sources import records

    good = [
        '<r xmlns:dc="urn:d"><dc:medium> oil </dc:medium><medium>on<!-- c --> wood<b>x</b> panel</medium><w><medium><![CDATA[a & b]]></medium></w></r>',
        '<r><Agg rdf:about="" dc:medium="m"/><Agg about="u&amp;v"/><medium/><medium> </medium></r>', "<medium>top</medium>", "<r/>",
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(good)], "id int, xml string")
    paths = ["//medium/text()", "//Agg/@about"]
    want = {r.id: [r.a, r.b] for r in df.select("id", *[F.xpath(records.plain_xml(F.col("xml")), F.lit(p)).alias(n) for n, p in zip("ab", paths, strict=True)]).collect()}
    assert {r.id: r.v for r in df.select("id", records.values_at(F.col("xml"), paths).alias("v")).collect()} == want
    odd = spark.createDataFrame([(1, "<r><medium>", "nan"), (2, None, "kept"), (3, "", None), (4, "<r><medium>ink</medium></r>", "")], "id int, xml string, material string")
    assert [r.material for r in records.fill_from_rdf(odd).orderBy("id").collect()] == [None, "kept", None, "ink"]
    assert [r.u for r in odd.select(records.aggregated_uri(F.col("xml")).alias("u")).collect()] == [None] * 4


def test_set_catalogue_parses_a_page_once_and_shuffles_nothing(spark):
    xml = "<l xmlns:o='urn:o'><o:set><setSpec>a</setSpec><o:setName> Paintings </o:setName></o:set><x/><set><setName>b</setName><setName>c</setName><in><setSpec>z</setSpec></in></set></l>"
    pages = spark.createDataFrame([(1, xml), (1, xml), (2, "<l><set>"), (3, None), (None, "<set/>")], "page int, xml string")
    out = ld.set_catalogue(pages)
    got = sorted((r.page or 0, r.position, r.spec, r.name, r.important) for r in out.collect())
    one = [(1, 1, "a", "Paintings", True), (1, 5, "", "c", False)]
    assert got == sorted([(0, 0, "", "", False), *one, *one])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
