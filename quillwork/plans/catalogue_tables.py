"""Sinks and scans as round trips through the shared folder, and operators on lists, terms, places and quotas that had no query."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import linked, lists, text
from ..operators import dates, inject, knowledge, medium, pairs, sampling, vocab
from ..sources import scans, sinks
from .catalogue import query, t


def _folder(spark, name: str) -> str:
    """A new folder among the shared ones."""
    return f"{sinks.shared_folder(spark)}/trip-{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", """
SELECT CAST(p_partkey AS VARCHAR) AS id, 'a "quoted", ' || p_name || CASE WHEN p_partkey % 3 = 0 THEN E'\\nsecond line' ELSE '' END AS title, CASE WHEN p_partkey % 2 = 0 THEN '{"type":"' || p_type || '","sizes":[' || p_size || ']}' END AS nested, lpad(CAST(p_size AS VARCHAR), 4, '0') AS year, CAST(NULL AS VARCHAR) AS absent FROM part""")
def csv_round_trip(spark, d):
    """Exported with nested values as JSON text, read again as text: quotes, line breaks and leading zeros survive."""
    p = t(spark, d, "part")
    title = F.concat(F.lit('a "quoted", '), "p_name", F.when(F.col("p_partkey") % 3 == 0, "\nsecond line").otherwise(""))
    nested = F.when(F.col("p_partkey") % 2 == 0, F.struct(F.col("p_type").alias("type"), F.array("p_size").alias("sizes")))
    path = _folder(spark, "csv")
    sinks.export_csv(p.select(F.col("p_partkey").alias("id"), title.alias("title"), nested.alias("nested"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("year")), path)
    kept = ["id", "title", "nested", "year"]
    return scans.union_all([scans.csv_strings(spark, path, kept), spark.createDataFrame([], "absent string")])


@query("csv_typed", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_custkey FROM orders")
def csv_typed(spark, d):
    """Written and read with a schema that prunes columns; nothing is inferred."""
    path = _folder(spark, "typed")
    o = t(spark, d, "orders")
    sinks.export_csv(o.select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_custkey", "o_orderpriority"), path)
    kinds = {f.name: f.dataType.simpleString() for f in o.schema}
    return scans.csv(spark, path, f"o_orderkey {kinds['o_orderkey']}, o_totalprice string, o_orderstatus string, o_orderdate date, o_custkey {kinds['o_custkey']}, o_orderpriority string").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")


@query("json_object_files", "SELECT CASE WHEN n_nationkey % 5 <> 4 THEN n_nationkey END AS id, CASE WHEN n_nationkey % 5 <> 4 THEN n_name END AS name, n_nationkey % 5 = 4 AS load_error FROM nation")
def json_object_files(spark, d):
    """One object a file, some in an envelope, some broken: those are rows with an error."""
    n, path = t(spark, d, "nation"), _folder(spark, "json")
    plain = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
    shape = F.when(F.col("n_nationkey") % 5 == 4, F.substring(plain, 1, 8)).when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit('{"data": '), plain, F.lit("}"))).otherwise(plain)
    n.select(F.col("n_nationkey").alias("k"), shape.alias("value")).repartition("k").write.partitionBy("k").text(path)
    read = scans.json_objects(spark, f"{path}/*", "data struct<id:long,name:string>, id long, name string")
    return scans.unwrap_envelope(read, ["id", "name"]).select("id", "name", "load_error")


@query("append_only_table", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM orders")
def append_only_table(spark, d):
    """Two runs over overlapping rows: each key is kept from the run that brought it first."""
    o, path = t(spark, d, "orders"), _folder(spark, "append")
    sinks.append_new(o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("first").alias("run")), path, "o_orderkey")
    sinks.append_new(o.select("o_orderkey", F.lit("second").alias("run")), path, "o_orderkey")
    return spark.read.parquet(path)


@query("staged_table", "SELECT lang AS source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE lang <> 'en' GROUP BY 1")
def staged_table(spark, d):
    """A stage's table by source, compacted, one source pruned when read again."""
    path = _folder(spark, "stage")
    sinks.write_stage(t(spark, d, "documents").select("doc_id", F.col("lang").alias("source"), "n_chars").where("source is not null"), path)
    sinks.compact(spark, path, f"{path}-few", 2)
    return spark.read.parquet(f"{path}-few").where("source <> 'en'").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("benchmark_splits", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS label FROM orders")
def benchmark_splits(spark, d):
    o, path = t(spark, d, "orders"), _folder(spark, "splits")
    sinks.write_benchmark(o.where("o_orderkey % 3 <> 0").select("o_orderkey"), o.where("o_orderkey % 3 = 0").select("o_orderkey", F.col("o_orderstatus").alias("label")), path)
    return spark.read.parquet(path).select("o_orderkey", "split", "label")


@query("index_tables", "SELECT subtype, count(*) AS pairs, count(*) FILTER (o_orderstatus = 'F') AS eligible FROM (SELECT o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS subtype FROM orders) GROUP BY 1")
def index_tables(spark, d):
    """The eligibility index and the pairs by subtype, written and joined again."""
    o, path = t(spark, d, "orders"), _folder(spark, "index")
    subtype = F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd")
    sinks.write_index(o.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("flag")), o.select(F.col("o_orderkey").alias("id_a"), F.col("o_custkey").alias("id_b"), subtype.alias("subtype")), path)
    both = spark.read.parquet(f"{path}/pairs").join(spark.read.parquet(f"{path}/eligibility"), F.col("id_a") == F.col("o_orderkey"))
    return both.groupBy("subtype").agg(F.count("*").alias("pairs"), F.count_if("flag").alias("eligible"))


@query("group_folders", "SELECT p_brand, lower(replace(p_brand, '#', '')) AS slug, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS sizes FROM part GROUP BY 1, 2")
def group_folders(spark, d):
    """One folder a brand, its overview joined with what lies in the folders."""
    path = _folder(spark, "groups")
    overview = sinks.write_groups(t(spark, d, "part").select("p_brand", "p_size"), "p_brand", path, text.slugify)
    held = spark.read.parquet(path).groupBy(F.col("slug").alias("s")).agg(F.sum("p_size").alias("sizes"))
    return overview.join(held, F.col("slug") == F.col("s")).select("p_brand", "slug", "n", "sizes")


@query("place_knowledge", """
SELECT 'city_country' AS kind, n_name AS src, r_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'country_city', r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'city_neighbor', x.n_name, y.n_name FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_name <> y.n_name""")
def place_knowledge(spark, d):
    """Regions and nations written as one place file, read as edges."""
    both = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sib = knowledge.siblings(both, "n_name", "r_name").groupBy("a").agg(F.array_sort(F.collect_list("b")).alias("b"))
    as_map = lambda df, k, v: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias("m"))
    one = as_map(both, "n_name", "r_name").select(F.col("m").alias("city_to_country"))
    many = as_map(both.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("v")), "r_name", "v").select(F.col("m").alias("country_to_cities"))
    near = as_map(sib, "a", "b").select(F.col("m").alias("city_neighbors"))
    path = _folder(spark, "places")
    # three objects of one row each, a few hundred places
    sinks.export_json(one.join(many).join(near).select(F.to_json(F.struct("city_to_country", "country_to_cities", "city_neighbors")).alias("json")).coalesce(1), path)
    return scans.place_edges(spark, path)


@query("mapping_files", "SELECT 'culture' AS kind, lower(n_name) AS key, n_name || ' people' AS value FROM nation")
def mapping_files(spark, d):
    path = _folder(spark, "mapping")
    entries = t(spark, d, "nation").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("n_name", F.concat("n_name", F.lit(" people")).alias("v"))))).alias("m"))
    sinks.export_json(entries.select(F.to_json("m").alias("json")).coalesce(1), path)
    return scans.mapping_table(spark, path, "culture")


@query("embedding_tables", "SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN vec_id % 3 = 0 THEN 'first' ELSE 'second' END AS origin, round(CAST(embedding[1] AS DOUBLE), 5) AS x FROM embeddings")
def embedding_tables(spark, d):
    """Two tables that share ids: the first one's vector stays. The last component of each vector names its table."""
    e, path = t(spark, d, "embeddings"), _folder(spark, "vectors")
    of = lambda mark: F.concat("embedding", F.array(F.lit(float(mark)).cast("float")))
    e.where("vec_id % 3 = 0").select(F.col("vec_id").alias("id"), of(1).alias("embedding")).write.parquet(f"{path}/a")
    e.select(F.col("vec_id").alias("id"), of(2).alias("embedding")).write.parquet(f"{path}/b")
    out = scans.embeddings(spark, f"{path}/a", f"{path}/b")
    return out.select("id", F.when(F.element_at("embedding", -1) == 1, "first").otherwise("second").alias("origin"), F.round(F.get("embedding", F.lit(0)).cast("double"), 5).alias("x"))


@query("value_lists", """
SELECT p_partkey, concat_ws(', ', p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_type END, 'x') AS joined, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS scalars, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 2 END AS listed,
  CASE WHEN p_size % 2 = 0 THEN 'k' || p_size ELSE 'k' || p_size || '|k0' END AS kinds FROM part""")
def value_lists(spark, d):
    p = t(spark, d, "part")
    node = lambda c: F.struct(c.alias("id"))
    nodes = F.array(node(F.concat(F.lit("k"), F.col("p_size").cast("string"))), node(F.lit(None).cast("string")), node(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("k"), F.col("p_size").cast("string"))).otherwise("k0")))
    return p.select(
        "p_partkey", text.list_to_str(F.array("p_brand", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")), F.lit("x"))).alias("joined"),
        F.size(lists.as_list(F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")), False)).alias("scalars"), F.size(lists.as_list(F.when(F.col("p_partkey") % 4 != 0, F.array("p_name", "p_type")), True)).alias("listed"),
        F.array_join(linked.classified_ids(nodes), "|").alias("kinds"),
    )


@query("clean_columns", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE lower(c_mktsegment) END AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def clean_columns(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", pairs.clean(F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))).alias("segment"), pairs.clean(F.col("c_nationkey")).alias("nation"))


@query("routed_locations", """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'France' WHEN 1 THEN 'Italy' WHEN 2 THEN 'Atlantis' WHEN 3 THEN 'United Kingdom' END AS location FROM customer""")
def routed_locations(spark, d):
    """Countries by their names, demonyms, and places that are neither; empty brackets go."""
    raw = F.element_at(F.array(*map(F.lit, ("FRANCE ()", "italian", "Atlantis ( )", "british", "()"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    return t(spark, d, "customer").select("c_custkey", vocab.canonical_location(raw, {"france": "France"}, {"italian": "Italy", "british": "United Kingdom"}).alias("location"))


@query("set_operations", """
WITH s AS (SELECT p_brand, list_sort(list(DISTINCT p_size) FILTER (p_partkey % 2 = 0)) AS a, list_sort(list(DISTINCT p_size) FILTER (p_partkey % 3 = 0)) AS b FROM part GROUP BY 1), c AS (SELECT p_brand, coalesce(a, []) AS a, coalesce(b, []) AS b FROM s)
SELECT p_brand, CAST(len(list_intersect(a, b)) AS INTEGER) AS both_n, CAST(len(list_distinct(list_concat(a, b))) AS INTEGER) AS either_n, CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS INTEGER) AS only_a, len(list_intersect(a, b)) > 0 AS touch FROM c""")
def set_operations(spark, d):
    sets = t(spark, d, "part").groupBy("p_brand").agg(F.collect_set(F.when(F.col("p_partkey") % 2 == 0, F.col("p_size"))).alias("a"), F.collect_set(F.when(F.col("p_partkey") % 3 == 0, F.col("p_size"))).alias("b"))
    return sets.select("p_brand", F.size(F.array_intersect("a", "b")).alias("both_n"), F.size(F.array_union("a", "b")).alias("either_n"), F.size(F.array_except("a", "b")).alias("only_a"), F.arrays_overlap("a", "b").alias("touch"))


@query("routed_terms", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN array_to_string(list_sort(['bronze', lower(p_name)]), '|') WHEN 1 THEN 'bronze' ELSE '' END AS materials, CASE p_partkey % 3 WHEN 0 THEN 'engraving' WHEN 1 THEN array_to_string(list_sort(['engraving', lower(p_name)]), '|') ELSE '' END AS techniques FROM part""")
def routed_terms(spark, d):
    """Comma lists whose known terms stand in the wrong column; unknown ones stay."""
    p, k = t(spark, d, "part"), F.col("p_partkey") % 3
    m = F.when(k == 0, F.concat(F.lit("Engraving (fine), ["), "p_name", F.lit("]"))).when(k == 1, "engraving")
    n = F.when(k == 0, "bronze").when(k == 1, F.concat(F.lit("Bronze, 'engraving', "), "p_name"))
    out = medium.route_terms(m, n, {"bronze": ("material", "bronze"), "engraving": ("technique", "engraving")})
    shown = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    return p.select("p_partkey", out.alias("r")).select("p_partkey", shown("r.materials").alias("materials"), shown("r.techniques").alias("techniques"))


_QUOTA = {"swap_a": 40, "swap_b": 60, "scale_error": 30}


@query("subtype_assignment", """
WITH e AS (SELECT o_orderkey AS id, 'swap_a' AS s FROM orders WHERE o_orderkey % 100 = 0 AND o_orderkey < 3000 UNION ALL SELECT o_orderkey, 'swap_b' FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey, 'scale_error' FROM orders),
a AS (SELECT id FROM (SELECT id FROM e WHERE s = 'swap_a') ORDER BY md5(concat(id, '|42|swap_a')), id LIMIT 40),
b AS (SELECT id FROM (SELECT id FROM e WHERE s = 'swap_b' AND id NOT IN (SELECT id FROM a)) ORDER BY md5(concat(id, '|42|swap_b')), id LIMIT 60),
c AS (SELECT id, row_number() OVER (ORDER BY md5(concat(id, '|42|scale_error')), id) AS rn FROM e WHERE s = 'scale_error' AND id NOT IN (SELECT id FROM a) AND id NOT IN (SELECT id FROM b))
SELECT id, 'swap_a' AS subtype FROM a UNION ALL SELECT id, 'swap_b' FROM b UNION ALL SELECT id, 'scale_error' FROM c WHERE rn <= 30 + 40 - (SELECT count(*) FROM a) + 60 - (SELECT count(*) FROM b)""")
def subtype_assignment(spark, d):
    """Quotas over all orders, each order once; what one subtype lacks goes to the filler."""
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    eligible = o.where("id % 100 = 0 AND id < 3000").withColumn("subtype", F.lit("swap_a")).unionByName(o.where("id % 5 = 0").withColumn("subtype", F.lit("swap_b"))).unionByName(o.withColumn("subtype", F.lit("scale_error")))
    none = spark.createDataFrame([], "subtype string, id_a long, id_b long")
    return sampling.assign(eligible, none, _QUOTA, sinks.cutter(spark)).select("id", "subtype")


@query("artist_errors", """
WITH r AS (SELECT s_suppkey AS id, s_nationkey % 5 AS object, s_name AS name, 1900 + s_suppkey % 7 AS year FROM supplier), p AS (SELECT n_nationkey % 5 AS object, CASE WHEN n_nationkey % 4 = 0 THEN 'Supplier#000000003' ELSE n_name END AS name, 1880 + n_nationkey * 3 AS year FROM nation)
SELECT r.id AS object_ID, min_by(p.name, md5(concat_ws('|', r.id, p.name, '42'))) AS artist_name_error FROM r JOIN p ON r.object = p.object AND abs(r.year - p.year) <= 50 AND lower(r.name) <> lower(p.name) GROUP BY 1""")
def artist_errors(spark, d):
    fields = {c: F.lit(None).cast("string").alias(c) for c in ("artist_role", "artist_date_begin", "artist_date_end", "artist_nationality")}
    r = t(spark, d, "supplier").select(F.col("s_suppkey").alias("object_ID"), (F.col("s_nationkey") % 5).alias("object_name"), F.col("s_name").alias("artist_name"), (F.lit(1900) + F.col("s_suppkey") % 7).alias("year"))
    n = F.col("n_nationkey")
    pool = t(spark, d, "nation").select((n % 5).alias("object_name"), F.when(n % 4 == 0, "Supplier#000000003").otherwise(F.col("n_name")).alias("artist_name"), (n * 3 + 1880).alias("year"), *fields.values())
    return inject.artist_error(r, pool, 2).select("object_ID", "artist_name_error")


@query("date_bounds", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN y || '-' || (y + 5) WHEN 1 THEN y || '-' || (y + 9) WHEN 2 THEN y || '-' || (y + 3) ELSE 'before ' || y END AS normalized FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders)""")
def date_bounds(spark, d):
    """Open bounds at either end of a range, at both, and alone with month and day."""
    o = t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    y = lambda n=0: (F.col("y") + n).cast("string")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("in or before "), y(), F.lit(" - "), y(5))).when(k == 1, F.concat(F.lit("In or after "), y(), F.lit(" – in or before "), y(9))).when(k == 2, F.concat(y(), F.lit(" - in or after "), y(3))).otherwise(F.concat(F.lit("in or before "), y(), F.lit("-05-12")))
    return o.select("o_orderkey", dates.normalize_date(raw).alias("normalized"))


@query("sql_functions_by_name", """
SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN -p_size ELSE p_size END AS INTEGER) AS signed, CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 - p_size ELSE p_size END AS INTEGER) AS astronomical, CASE WHEN p_partkey % 2 = 0 THEN -p_size ELSE p_size END / 1.0 AS middle,
  CAST(p_size + 622 - p_size // 33 AS INTEGER) AS lunar, 'a ' || p_name AS squeezed, lower(replace(p_name, ' ', '_')) AS slug, p_partkey % 3 = 0 AS empty, lower(p_brand) AS cleaned, p_brand || ', x' AS listed, 1 / 3.0 AS alike,
  CAST((p_size + 99) // 100 AS INTEGER) AS century, CAST(p_size // 10 * 10 AS INTEGER) AS decade, round(p_size * 2.54, 2) AS cm, round(p_size * 453.592, 2) AS grams, CAST(p_size * 2 AS DOUBLE) AS product, 1.0 AS angle, CAST(p_partkey AS VARCHAR) AS segment FROM part""")
def sql_functions_by_name(spark, d):
    """The scalar functions by their names in SQL."""
    lists.register_sql(spark)
    return spark.sql("""SELECT p_partkey, signed_year(k, p_partkey % 2 = 0) AS signed, astronomical_year(k, p_partkey % 2 = 0) AS astronomical, midpoint(k, p_partkey % 2 = 0, NULL, NULL) AS middle, lunar_to_ce(k) AS lunar,
        squeeze('  a \n' || p_name || ' ') AS squeezed, slugify(' ' || p_name) AS slug, nullish(IF(p_partkey % 3 = 0, ' NaN', p_name)) AS empty, clean_text(' ' || p_brand) AS cleaned, list_to_str(array(p_brand, NULL, 'x')) AS listed,
        jaccard(array(p_brand, 'x'), array('x', 'y')) AS alike, century_of(k) AS century, decade_of(k) AS decade, inches_to_cm(k) AS cm, pounds_to_g(k) AS grams, dot(array(1D, 0D), array(k * 2D, 5D)) AS product, cosine(array(1D, 1D), array(2D, 2D)) AS angle,
        last_segment('http://x/y#' || p_partkey || '/') AS segment FROM (SELECT *, CAST(p_size AS INT) AS k FROM {part})""", part=t(spark, d, "part"))
