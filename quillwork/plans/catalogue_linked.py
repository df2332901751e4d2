"""Linked data and table functions in the catalogue: nested documents are rendered from the driver's tables, records and listings walked out of them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tables
from ..sources import linked_data
from .catalogue import query, t

_BASE = "https://ld.example/"
_EN, _NL = linked_data.ENGLISH, linked_data.DUTCH


def _text(c: str):
    """A column as JSON text in quotes."""
    return F.to_json(F.array(F.col(c).cast("string"))).substr(F.lit(2), F.length(F.to_json(F.array(F.col(c).cast("string")))) - 2)


def _json(pattern: str, **values):
    """JSON text with <name> replaced by each value; ' stands for a double quote."""
    pattern = pattern.replace("'", '"').replace("EN", _EN).replace("NL", _NL).replace("BASE/", _BASE)
    pieces = re.split(f"<({'|'.join(values)})>", pattern)
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(pieces)])


def linked_documents(spark, d) -> DataFrame:
    """(uri, doc): parts as objects in four shapes, suppliers as people, nations as places, part sizes as concepts."""
    p = t(spark, d, "part").withColumn("s", F.col("p_partkey") % 10).withColumn("n", F.col("p_partkey") % 25).withColumn("k", F.col("p_partkey") % 4)
    v = {c: F.col(c).cast("string") for c in ("p_partkey", "p_size", "s", "n")} | {"name": _text("p_name"), "brand": _text("p_brand"), "type": _text("p_type"), "set": F.col("p_brand"), "other": ((F.col("s") + 1) % 10).cast("string")}
    made = (
        F.when(F.col("k") == 0, _json("{'assigned_by':[{'assigned_property':'carried_out_by','classified_as':'AAT300404908','assigned':[{'id':'BASE/person/<other>','type':'Person'}]}],'carried_out_by':{'id':'BASE/person/<s>','type':'Person'}}", **v))
        .when(F.col("k") == 1, _json("{'carried_out_by':[{'id':'BASE/person/<s>','type':'Actor'},{'id':'BASE/person/<other>','type':'Person'}]}", **v))
        .when(F.col("k") == 2, _json("{'part':[{'took_place_at':['BASE/nowhere',{'id':'BASE/place/<n>'}],'assigned_by':{'assigned_property':'carried_out_by','assigned':{'type':'Group','formed_by':{'influenced_by':[{'id':'BASE/person/<s>','type':'Person'}]}}}}]}", **v))
        .otherwise(_json("{'part':{'took_place_at':{'_label':'Here','id':'BASE/place/<n>'},'carried_out_by':[{'id':'BASE/unknown','type':'Person'},'x']}}", **v))
    )
    made = F.replace(made, F.lit("AAT3"), F.lit(f"{linked_data.AAT}3"))
    kind = F.when(F.col("p_partkey") % 2 == 0, _json("[{'_label':<type>}]", **v)).otherwise(_json("['plain',{'id':'BASE/concept/<p_size>'}]", **v))
    told = F.when(F.col("p_partkey") % 3 == 0, _json("[{'type':'LinguisticObject','language':'EN','part':[{'type':'LinguisticObject','content':'<i>About</i> <name_plain>','classified_as':[{'id':'DESC'}]}]}]", name_plain=F.col("p_name"), **v)).otherwise(F.lit("null"))
    told = F.replace(told, F.lit("DESC"), F.lit(linked_data.DESCRIPTION))
    said = _json("[{'content':' mark <p_partkey> ','classified_as':['INSC'],'language':{'id':'EN'}},{'content':'A longer remark on the part called <plain>, number <p_partkey>','language':[{'id':'NL'}]},{'content':'a; b; c; and so on, a provenance in truth, of <plain>','language':'EN'}]", plain=F.col("p_name"), **v)
    said = F.replace(said, F.lit("INSC"), F.lit(linked_data.INSCRIPTION))
    place = F.when(F.col("p_partkey") % 5 == 0, _json("{'id':'BASE/place/<n>'}", **v)).otherwise(_json("{'identified_by':[{'type':'Name','content':'Zaal <p_size>','part':[{'type':'Name','content':'HG-1'}]},{'type':'Name','content':'Depot'}]}", **v))
    doc = _json("{'id':'BASE/part/<p_partkey>','type':'HumanMadeObject','identified_by':[{'type':'Identifier','content':'x'},{'type':'Name','content':<name>,'language':[{'id':'EN'}]},{'type':'Name','content':[<brand>,'!'],'language':'NL'},{'type':'Name','content':<name>,'language':'EN'}],'member_of':[{'id':'BASE/set/<set>'},{'id':'BASE/set/all'}],", **v)
    doc = F.concat(doc, F.lit('"classified_as":'), kind, F.lit(',"produced_by":'), made, F.lit(',"subject_of":'), told, F.lit(',"referred_to_by":'), said, F.lit(',"current_location":'), place, F.lit(',"shows":[{"subject_to":{"classified_as":[{"id":"free"}]}}]}'))
    objects = p.select(F.concat(F.lit(f"{_BASE}part/"), F.col("p_partkey")).alias("uri"), doc.alias("doc"))
    s = t(spark, d, "supplier")
    w = {"k": F.col("s_suppkey").cast("string"), "name": _text("s_name"), "n": F.col("s_nationkey").cast("string"), "y": (F.lit(1600) + F.col("s_suppkey") % 300).cast("string")}
    person = _json("{'id':'BASE/person/<k>','type':'Person','identified_by':{'type':'Name','content':<name>,'language':'EN'},'born':{'timespan':{'end_of_the_end':'<y>'},'took_place_at':[{'id':'BASE/nowhere'},{'id':'BASE/place/<n>'}]},'died':{'timespan':{'begin_of_the_begin':'no','end_of_the_end':'<y>-12'}},'carried_out':{'classified_as':[{'id':'BASE/concept/2'},{'id':'BASE/concept/1'}]},'equivalent':[{'id':'e<k>'},{}]}", **w)
    people = s.select(F.concat(F.lit(f"{_BASE}person/"), F.col("s_suppkey")).alias("uri"), person.alias("doc"))
    n = t(spark, d, "nation").withColumn("low", F.lower("n_name"))
    places = n.select(F.concat(F.lit(f"{_BASE}place/"), F.col("n_nationkey")).alias("uri"), _json("{'identified_by':[{'type':'Name','content':<name>,'language':['EN','NL']},{'type':'Name','content':<low>,'language':'NL'}]}", name=_text("n_name"), low=_text("low")).alias("doc"))
    concepts = t(spark, d, "part").select("p_size").distinct().select(F.concat(F.lit(f"{_BASE}concept/"), F.col("p_size")).alias("uri"), _json("{'identified_by':[{'type':'Name','content':'size <k>','language':'EN'}]}", k=F.col("p_size").cast("string")).alias("doc"))
    return objects.unionByName(people).unionByName(places).unionByName(concepts)


@query("linked_wide_records", f"""
WITH p AS (SELECT *, p_partkey % 10 AS s, p_partkey % 25 AS n, p_partkey % 4 AS k FROM part),
place AS (SELECT n_nationkey AS n, '{{"Dutch":["' || n_name || '","' || lower(n_name) || '"],"English":["' || n_name || '"]}}' AS labels FROM nation),
who AS (SELECT s_suppkey, s_name, s_nationkey, 1600 + s_suppkey % 300 AS y FROM supplier),
sizes AS (SELECT string_agg('"size ' || z || '"', ',' ORDER BY z) AS w FROM (SELECT DISTINCT p_size AS z FROM part WHERE p_size IN (1, 2))), size AS (SELECT DISTINCT p_size FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS object_ID, '{{"Dutch":["' || p_brand || ' !"],"English":["' || p_name || '"]}}' AS title,
  CASE WHEN p_partkey % 2 = 0 THEN '{{"und":["' || p_type || '"]}}' ELSE '{{"English":["size ' || p_size || '"]}}' END AS object_name, '["{_BASE}set/' || p_brand || '","{_BASE}set/all"]' AS department,
  CASE k WHEN 2 THEN here.labels WHEN 3 THEN '{{"und":["Here"]}}' END AS country, '{{"English":["mark ' || p_partkey || '"]}}' AS inscriptions,
  '{{"Dutch":"A longer remark on the part called ' || p_name || ', number ' || p_partkey || '"' || CASE WHEN p_partkey % 3 = 0 THEN ',"English":"About ' || p_name || '"' ELSE '' END || '}}' AS description,
  CASE WHEN p_partkey % 5 = 0 THEN here.labels ELSE '{{"und":["Depot"]}}' END AS current_location, '{_BASE}part/' || p_partkey AS cho_uri, 'free' AS rights,
  CASE WHEN k IN (0, 2) THEN '{{"English":["' || s_name || '"]}}' END AS artist_name, CASE WHEN k IN (0, 2) AND s_name IS NOT NULL AND sizes.w IS NOT NULL THEN '{{"English":[' || sizes.w || ']}}' END AS artist_role,
  CASE WHEN k IN (0, 2) THEN birth.labels END AS artist_place_of_birth, CAST(NULL AS VARCHAR) AS artist_place_of_death, CASE WHEN k IN (0, 2) THEN CAST(y AS VARCHAR) END AS artist_date_begin, CASE WHEN k IN (0, 2) THEN y || '-12' END AS artist_date_end, CASE WHEN k IN (0, 2) THEN '["e' || s_suppkey || '"]' END AS artist_equivalent
FROM p LEFT JOIN place here ON here.n = p.n LEFT JOIN who ON s_suppkey = s LEFT JOIN place birth ON birth.n = s_nationkey, sizes""")
def linked_wide_records(spark, d):
    documents = linked_documents(spark, d)
    out = linked_data.records(documents.where(F.col("uri").contains("/part/")), documents).drop("uri")
    return out.select(*[F.to_json(c).alias(c) if out.schema[c].dataType.typeName() in ("map", "array") else c for c in out.columns])


@query("linked_nodes", f"""
WITH s AS (SELECT s_suppkey AS k, s_name FROM supplier), n AS (SELECT k, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]) AS node, s_name FROM s)
SELECT '{_BASE}person/' || k AS uri, CAST(node AS INTEGER) AS node, CAST([NULL, 0, 0, 2, 2, 2, 0, 6, 0, 8, 8, 0, 0, 0][node + 1] AS INTEGER) AS parent, ['', 'identified_by', 'born', 'born/timespan', 'born/took_place_at', 'born/took_place_at', 'died', 'died/timespan', 'carried_out', 'carried_out/classified_as', 'carried_out/classified_as', 'equivalent', 'equivalent', ''][node + 1] AS path,
  CASE node WHEN 1 THEN s_name END AS content FROM n WHERE node < 13""")
def linked_nodes(spark, d):
    """Every node of the documents of people, by the table function in SQL."""
    tables.register(spark)
    people = linked_documents(spark, d).where(F.col("uri").contains("/person/"))
    return spark.sql("SELECT p.uri, n.node, n.parent, n.path, n.content FROM {people} p, LATERAL ld_nodes(p.doc) n", people=people)


_SETS = """s AS (SELECT 'r' || r_regionkey AS id, CASE WHEN r_regionkey = 1 THEN 'gone' END AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'o' || c_custkey, 'c' || c_custkey FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'o' || c_custkey, 'r0' FROM customer WHERE c_custkey % 6 = 0 UNION ALL SELECT 'x' || n_nationkey, 'x' || ((n_nationkey + 1) % 25) FROM nation)"""


@query("set_tree", f"""WITH RECURSIVE {_SETS}, w(id, root, depth) AS (SELECT id, id, 0 FROM s WHERE parent IS NULL OR parent NOT IN (SELECT id FROM s) UNION ALL SELECT s.id, w.root, w.depth + 1 FROM s JOIN w ON s.parent = w.id)
SELECT id, root, min(depth) AS depth FROM w GROUP BY 1, 2""")
def set_tree(spark, d):
    """Regions, nations, customers and some of their baskets as sets within sets; some have two parents, a ring has no root."""
    def key(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    none = F.lit(None).cast("string")
    r, n, c = t(spark, d, "region"), t(spark, d, "nation"), t(spark, d, "customer")
    sets = [
        r.select(key("r", "r_regionkey").alias("id"), F.when(F.col("r_regionkey") == 1, "gone").otherwise(none).alias("parent")), n.select(key("n", "n_nationkey"), key("r", "n_regionkey")), c.select(key("c", "c_custkey"), key("n", "c_nationkey")),
        c.where("c_custkey % 3 = 0").select(key("o", "c_custkey"), key("c", "c_custkey")), c.where("c_custkey % 6 = 0").select(key("o", "c_custkey"), F.lit("r0")), n.select(key("x", "n_nationkey"), F.concat(F.lit("x"), ((F.col("n_nationkey") + 1) % 25).cast("string"))),
    ]
    out = sets[0]
    for more in sets[1:]:
        out = out.union(more)
    return linked_data.tree_listing(out)


@query("set_catalogue", r"""
SELECT p_partkey AS page, spec, name, important FROM (SELECT p_partkey, p_brand AS spec, p_name AS name, false AS important FROM part UNION ALL SELECT p_partkey, 'all', 'Paintings of ' || p_size, true FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, '', 'repaintings', false FROM part WHERE p_partkey % 2 = 1)""")
def set_catalogue(spark, d):
    """A list response for each part, with two sets."""
    p = t(spark, d, "part")
    second = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<setSpec> all</setSpec><setName>Paintings of "), F.col("p_size"), F.lit("</setName>"))).otherwise("<setName>repaintings</setName><setDescription>paintings</setDescription>")
    xml = F.concat(F.lit('<oai:OAI-PMH xmlns:oai="urn:oai"><oai:ListSets><oai:set><oai:setSpec>'), "p_brand", F.lit("</oai:setSpec><oai:setName>"), "p_name", F.lit("</oai:setName></oai:set><set>"), second, F.lit("</set></oai:ListSets></oai:OAI-PMH>"))
    return linked_data.set_catalogue(p.select(F.col("p_partkey").alias("page"), xml.alias("xml"))).drop("position")


@query("template_members", """
WITH m AS (SELECT p_brand, p_partkey, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS position FROM part)
SELECT p_brand, CAST(position AS INTEGER) AS position, 'h ' || p_size || ' cm' AS member, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS number FROM m WHERE p_partkey % 5 <> 0""")
def template_members(spark, d):
    """A solved template a brand, with its members as one JSON list: texts, texts with numbers, and what is neither."""
    tables.register(spark)
    raw = F.concat(F.lit("h "), F.col("p_size").cast("string"), F.lit(" cm"))
    member = F.when(F.col("p_partkey") % 5 == 0, "17").when(F.col("p_partkey") % 2 == 0, F.to_json(F.struct(raw.alias("raw"), F.array("p_size").alias("numbers")))).otherwise(F.concat(F.lit('"'), raw, F.lit('"')))
    solved = t(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", member.alias("m"))))["m"].alias("m")).select("p_brand", F.concat(F.lit("["), F.array_join("m", ","), F.lit("]")).alias("members"))
    return spark.sql("SELECT s.p_brand, m.position, m.member, m.numbers[0] AS number FROM {solved} s, LATERAL template_members(s.members) m", solved=solved)
