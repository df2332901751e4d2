"""More of the catalogue: sources, linked data, text helpers and small reports on the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import linked, lists, text
from ..operators import consolidate, evaluate, inject, profile, sampling, vectors
from ..sources import records, scans, sinks
from .catalogue import query, t


def s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---------------------------------------------------------------- sources

@query("dump_records", """
SELECT CAST(p_partkey AS VARCHAR) AS object_ID, p_name AS title, p_type AS object_name, CASE WHEN p_size % 3 = 0 THEN 'about ' || p_size WHEN p_size % 3 = 1 THEN p_size || '-' || (p_size + 5) ELSE CAST(p_size + 5 AS VARCHAR) END AS date,
  replace(p_name, ' ', ', ') AS material, 'first' || chr(10) || p_brand AS description, CASE WHEN p_partkey % 2 = 0 THEN 'https://images.example.org/iiif/2/' || p_brand || '/full/843,/0/default.jpg' WHEN p_partkey % 3 = 0 THEN 'https://images.example.org/iiif/2/' || p_type || '/full/843,/0/default.jpg' END AS image_url FROM part""")
def dump_records(spark, d):
    none, k, n = F.lit(None).cast("string"), F.col("p_partkey"), F.col("p_size")
    objects = t(spark, d, "part").select(
        k.alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("artwork_type_title"), F.array("p_type").alias("classification_titles"),
        F.when(n % 3 == 0, F.concat(F.lit("about "), s(n))).alias("date_display"), F.when(n % 3 == 1, n).otherwise(0).alias("date_start"), (n + 5).alias("date_end"), none.alias("medium_display"),
        F.split("p_name", " ").alias("material_titles"), F.array(none).alias("technique_titles"), none.alias("dimensions"), none.alias("place_of_origin"), none.alias("artist_display"),
        F.array(none).alias("artist_titles"), F.array(none).alias("subject_titles"), none.alias("inscriptions"), F.concat(F.lit("<p>first<br/>"), F.col("p_brand"), F.lit("</p>")).alias("description"),
        F.when(k % 2 == 0, F.col("p_brand")).alias("image_id"), F.when(k % 3 == 0, F.array("p_type")).alias("alt_image_ids"),
    )
    return records.flatten_dump(objects).select("object_ID", "title", "object_name", "date", "material", "description", "image_url")


@query("rest_records", """
WITH n AS (SELECT o_custkey, max_by(o_orderstatus || '-' || o_orderkey, o_orderkey) AS description FROM orders GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS object_ID, c_name AS title, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'maker ' || c_nationkey END AS artist_name, CASE WHEN c_custkey % 3 <> 0 THEN 'a, ' || c_mktsegment ELSE 'a' END AS subjects, description FROM customer LEFT JOIN n ON o_custkey = c_custkey""")
def rest_records(spark, d):
    none, k = F.lit(None).cast("string"), F.col("c_custkey")
    bare = "objectName classification department objectDate objectBeginDate objectEndDate medium dimensions culture country region city period dynasty reign artistRole artistNationality artistBeginDate artistEndDate artistDisplayBio primaryImage"
    tag = lambda c: F.struct(c.alias("term"))
    objects = t(spark, d, "customer").select(
        k.alias("objectID"), F.col("c_name").alias("title"), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("artistDisplayName"), F.array(F.struct(F.concat(F.lit("maker "), s("c_nationkey")).alias("name"))).alias("constituents"),
        F.array(tag(F.lit("a")), tag(F.when(k % 3 != 0, F.col("c_mktsegment")))).alias("tags"), *[none.alias(c) for c in bare.split()],
    )
    side = t(spark, d, "orders").select(F.col("o_custkey").alias("object_id"), F.col("o_orderkey").alias("line"), F.concat_ws("-", "o_orderstatus", s("o_orderkey")).alias("description"))
    return records.flatten_rest(objects, side, "line").select("object_ID", "title", "artist_name", "subjects", "description")


@query("image_urls", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'i/' || c_mktsegment || '/full/843,/0/default.jpg' WHEN c_custkey % 3 = 1 THEN 'i/' || c_name || '/full/843,/0/default.jpg' END AS url FROM customer")
def image_urls(spark, d):
    k = F.col("c_custkey") % 3
    return t(spark, d, "customer").select("c_custkey", records.image_url(F.when(k == 0, F.col("c_mktsegment")).otherwise("nan"), F.when(k == 1, F.array("c_name", "c_mktsegment")).otherwise(F.array()), "i").alias("url"))


def rdf(spark, d):
    body = F.concat(
        F.lit('<rdf:RDF xmlns:rdf="urn:r" xmlns:dc="urn:d"><ore:Aggregation xmlns:ore="urn:o" rdf:about="urn:agg:'), s("p_partkey"), F.lit('">'),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('<edm:aggregatedCHO xmlns:edm="urn:e" rdf:resource="urn:cho:'), s("p_partkey"), F.lit('"/>'))).otherwise(""),
        F.lit("</ore:Aggregation><dc:medium> "), F.col("p_name"), F.lit(" </dc:medium><dc:medium>"), F.col("p_type"), F.lit("</dc:medium><dc:date>"), F.when(F.col("p_size") % 2 == 0, s("p_size")).otherwise(" "), F.lit("</dc:date></rdf:RDF>"),
    )
    return t(spark, d, "part").withColumn("xml", body)


@query("aggregated_uris", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'urn:cho:' ELSE 'urn:agg:' END || p_partkey AS uri, p_name || ', ' || p_type AS media FROM part")
def aggregated_uris(spark, d):
    return rdf(spark, d).select("p_partkey", records.aggregated_uri(F.col("xml")).alias("uri"), records.literals(F.col("xml"), "//medium/text()").alias("media"))


@query("rdf_gap_filling", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name || ', ' || p_type END AS material, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS date FROM part")
def rdf_gap_filling(spark, d):
    rows = rdf(spark, d).withColumns({"material": F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise("nan"), "date": F.lit(None).cast("string")})
    return records.fill_from_rdf(rows).select("p_partkey", "material", "date")


@query("reference_resolution", """
SELECT o_orderkey AS id, 'maker' AS field, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus WHEN o_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS value FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 4 = 0 OR c_custkey IS NOT NULL""")
def reference_resolution(spark, d):
    c = F.col("c_custkey")
    nodes = t(spark, d, "customer").select(F.concat(F.lit("urn:"), s(c)).alias("about"), F.when(c % 2 == 0, F.col("c_name")).alias("prefLabel"), F.lit("").alias("label"), F.col("c_mktsegment").alias("title"))
    found = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("maker").alias("field"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).alias("text"), F.concat(F.lit("urn:"), s("o_custkey")).alias("resource"))
    return records.resolve_references(nodes, found)


@query("linked_entities", "SELECT o_orderkey, c_name AS customer FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def linked_entities(spark, d):
    return records.dereference(t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", t(spark, d, "customer").select(F.col("c_custkey").alias("uri"), F.col("c_name").alias("doc")), "customer").drop("o_custkey")


@query("image_chain", "SELECT l_orderkey AS id, min(n_name) AS image_url FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def image_chain(spark, d):
    hops = [t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("visual")), t(spark, d, "supplier").select(F.col("s_suppkey").alias("uri"), F.col("s_nationkey").alias("digital")), t(spark, d, "nation").select(F.col("n_nationkey").alias("uri"), F.col("n_name").alias("access_point"))]
    return records.image_chain(*hops)


@query("extent_text", """
WITH x AS (SELECT o_custkey AS id, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS r, o_orderkey % 3 AS number, o_orderpriority AS text FROM orders)
SELECT id, text AS extent FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY r, number, length(text), text) = 1""")
def extent_text(spark, d):
    language = F.when(F.col("o_orderstatus") == "F", "English").when(F.col("o_orderstatus") == "O", "Dutch").otherwise("und")
    return records.extent(t(spark, d, "orders").select(F.col("o_custkey").alias("id"), language.alias("language"), (F.col("o_orderkey") % 3).alias("number"), F.col("o_orderpriority").alias("text")))


@query("iso_spans", "SELECT o_custkey AS id, min(year(o_orderdate)) AS date_begin, max(year(o_orderdate)) AS date_end FROM orders GROUP BY 1")
def iso_spans(spark, d):
    out = records.iso_span(t(spark, d, "orders").select(F.col("o_custkey").alias("id"), s("o_orderdate").alias("date")))
    return out.select("id", F.col("date_begin").cast("long").alias("date_begin"), F.col("date_end").cast("long").alias("date_end"))


@query("filtered_search", "SELECT page_id, url FROM pages WHERE contains(url, '/en/') ORDER BY page_id LIMIT 25")
def filtered_search(spark, d):
    return scans.search(t(spark, d, "pages").select("page_id", "url"), F.col("url").contains("/en/"), 25, "page_id")


@query("union_missing_columns", "SELECT c_custkey AS k, c_name AS name, NULL AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def union_missing_columns(spark, d):
    return scans.union_all([t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))])


@query("update_columns", "SELECT c_custkey, coalesce(s_name, c_name) AS name, c_acctbal FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def update_columns(spark, d):
    old = t(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), "c_acctbal")
    return sinks.updated(old, t(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name")), "c_custkey", ["name"])


# ---------------------------------------------------------------- linked data and text

@query("identifiers", "SELECT page_id, nullif(list_extract(regexp_split_to_array(regexp_replace(url, '[/#?]+$', ''), '[/#]'), -1), '') AS identifier FROM pages")
def identifiers(spark, d):
    return t(spark, d, "pages").select("page_id", linked.pick_identifier(F.col("url")).alias("identifier"))


@query("description_picker", r"""
WITH x AS (SELECT doc_id // 4 AS id, lang AS language, text, doc_id % 7 = 0 AS classified, doc_id % 3 = 0 AS is_label, CASE WHEN doc_id % 5 = 0 THEN 'Provenance' ELSE source END AS kind FROM documents WHERE text IS NOT NULL),
k AS (SELECT * FROM x WHERE classified OR (lower(coalesce(kind, '')) <> 'provenance' AND length(text) >= 40 AND NOT (regexp_matches(text, '^\s*(\.\.\.|…)') OR contains(text, '{') OR contains(text, '}') OR length(text) - length(replace(text, ';', '')) >= 2)))
SELECT id, language, text AS description FROM k QUALIFY row_number() OVER (PARTITION BY id, language ORDER BY classified DESC, is_label DESC, length(text) DESC, text) = 1""")
def description_picker(spark, d):
    k = F.col("doc_id")
    kind = F.when(k % 5 == 0, "Provenance").otherwise(F.col("source"))
    return linked.pick_descriptions(t(spark, d, "documents").select(F.floor(k / 4).alias("id"), F.col("lang").alias("language"), kind.alias("kind"), (k % 3 == 0).alias("is_label"), (k % 7 == 0).alias("classified"), "text"))


@query("labels_by_language", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand || '|' || p_type ELSE p_name END AS shown, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_brand || '|' || p_type END AS dutch FROM part")
def labels_by_language(spark, d):
    first = linked.language_of(F.when(F.col("p_size") % 3 == 0, "urn:aat:300388277").otherwise("nl-BE"))
    second = linked.language_of(F.when(F.col("p_size") % 3 == 0, "nl").otherwise("EN-gb"))
    label = lambda lang, value: F.struct(lang.alias("language"), F.col(value).alias("value"))
    many = linked.by_language(F.array(label(first, "p_brand"), label(first, "p_type"), label(first, "p_brand")))
    merged = linked.merge_by_language(many, linked.by_language(F.array(label(second, "p_name"))))
    rows = t(spark, d, "part").withColumn("m", merged)
    return rows.select("p_partkey", F.array_join(text.resolve_language(F.col("m")), "|").alias("shown"), F.array_join(F.col("m")["Dutch"], "|").alias("dutch"))


@query("clean_roles", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE lower(o_orderpriority) END AS role FROM orders")
def clean_roles(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 8 == 0, " Unknown ").when(k % 8 == 4, "NaN").otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")))
    return t(spark, d, "orders").select("o_orderkey", lists.clean_role(raw).alias("role"))


@query("parse_numbers", """
SELECT p_partkey, round(CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 1 THEN p_retailprice WHEN 2 THEN p_size / 8.0 WHEN 3 THEN p_partkey + p_size / 16.0 WHEN 4 THEN p_partkey + 3.0 / p_size END, 6) AS number FROM part""")
def parse_numbers(spark, d):
    n, k = s("p_size"), s("p_partkey")
    kinds = [n, F.format_string("%.2f", "p_retailprice"), F.concat(n, F.lit("/8")), F.concat(k, F.lit(" "), n, F.lit("/16")), F.concat(F.lit(" "), k, F.lit("-3/"), n), F.concat(n, F.lit(" pieces"))]
    raw = F.element_at(F.array(*kinds), (F.col("p_partkey") % 6 + 1).cast("int"))
    return t(spark, d, "part").select("p_partkey", F.round(lists.parse_number(raw), 6).alias("number"))


@query("fold_case", "SELECT CAST(c_custkey AS VARCHAR) AS object_ID, c_name AS title, lower(c_mktsegment) AS segment, c_name AS raw_name, 'SRC_' || c_custkey AS prefixed FROM customer")
def fold_case(spark, d):
    rows = t(spark, d, "customer").select(s("c_custkey").alias("object_ID"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("raw_name"))
    return rows.select(*text.fold_case(rows.columns), text.source_prefix(text.source_prefix(F.col("object_ID"), "SRC_"), "SRC_").alias("prefixed"))


@query("dedupe_names", "SELECT c_custkey, c_name || CASE WHEN c_custkey % 2 = 0 THEN ' of ' || c_mktsegment ELSE '' END AS name FROM customer")
def dedupe_names(spark, d):
    longer = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.col("c_name"), F.lit(" of "), F.col("c_mktsegment"))).otherwise(F.col("c_name"))
    return t(spark, d, "customer").select("c_custkey", text.dedupe_artist(F.concat(F.lit("['"), F.col("c_name"), F.lit("', '"), longer, F.lit("', 'x']"))).alias("name"))


@query("combined_medium", "SELECT o_orderkey, nullif(concat_ws(' , ', CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END), '') AS medium FROM orders")
def combined_medium(spark, d):
    k = F.col("o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", text.combine_medium(F.when(k % 2 == 0, F.col("o_orderstatus")), F.when(k % 3 == 0, F.col("o_orderpriority"))).alias("medium"))


_HITS = lambda tokens: " OR ".join(f"contains(n, '{x}')" for x in tokens)
_NAMES = ("", "NaN", "Unknown maker", "anonymous hand", "Unidentified", "Attributed to", "Style of", "Manner of", "workshop of", "Circle of", "school of", "Follower of", "Nancy")


@query("anonymous_names", "WITH x AS (SELECT c_custkey, lower(['" + "', '".join(_NAMES) + f"""'][c_custkey % {len(_NAMES)} + 1] || CASE WHEN c_custkey % {len(_NAMES)} > 1 THEN ' ' || c_name ELSE '' END) AS n FROM customer)
SELECT c_custkey, n IN ('', 'nan') OR contains(n, 'unknown') OR contains(n, 'anonymous') AS plain, n IN ('', 'nan') OR {_HITS(text.ANONYMOUS_TOKENS)} AS injection, n = '' OR {_HITS(text.ATTRIBUTION_TOKENS)} AS attribution FROM x""")
def anonymous_names(spark, d):
    k = (F.col("c_custkey") % len(_NAMES)).cast("int")
    name = F.concat(F.element_at(F.array(*map(F.lit, _NAMES)), k + 1), F.when(k > 1, F.concat(F.lit(" "), F.col("c_name"))).otherwise(""))
    return t(spark, d, "customer").select("c_custkey", text.anonymous(name).alias("plain"), text.anonymous_for_injection(name).alias("injection"), text.attributed(name).alias("attribution"))


@query("ambiguous_values", r"SELECT page_id, regexp_matches(lower(url), '\b(or|and|possibly|probably|maybe)\b|\?|/') AS ambiguous, regexp_matches(lower(split_part(url, '/', 3)), '\b(or|and|possibly|probably|maybe)\b|\?|/') AS ambiguous_host FROM pages")
def ambiguous_values(spark, d):
    return t(spark, d, "pages").select("page_id", text.ambiguous(F.col("url")).alias("ambiguous"), text.ambiguous(F.split_part("url", F.lit("/"), F.lit(3))).alias("ambiguous_host"))


@query("image_renditions", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'i/a/full/224,/0' WHEN 1 THEN 'i/b/full/224,/0' WHEN 2 THEN 'i/web-large/c' ELSE c_name END AS url FROM customer")
def image_renditions(spark, d):
    k = F.col("c_custkey") % 4
    return t(spark, d, "customer").select("c_custkey", text.image_rendition(F.when(k == 0, "i/a/full/843,/0").when(k == 1, "i/b/full/max/0").when(k == 2, "i/original/c").otherwise(F.col("c_name"))).alias("url"))


@query("one_line_descriptions", """
SELECT doc_id, concat_ws(', ', lang, 'titled ' || source, CASE WHEN doc_id % 2 = 0 THEN 'by maker ' || doc_id END, 'from here', CASE WHEN lower(trim(text, E' \\t\\n\\r')) NOT IN ('', 'nan') THEN CASE WHEN length(text) > 70 THEN substr(text, 1, 70) || '...' ELSE text END END) AS line FROM documents""")
def one_line_descriptions(spark, d):
    none, k = F.lit(None).cast("string"), F.col("doc_id")
    return t(spark, d, "documents").select("doc_id", text.describe(F.col("source"), F.col("lang"), F.when(k % 2 == 0, F.concat(F.lit("maker "), s(k))), F.lit("nan"), none, F.lit("here"), F.col("text")).alias("line"))


@query("model_answers", "SELECT e.event_id, CASE WHEN event_id % 3 <> 2 THEN CAST(props ->> '$.k' AS INT) END AS k FROM events e")
def model_answers(spark, d):
    k = F.col("event_id") % 3
    answer = F.when(k == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(k == 1, F.concat(F.lit("It is "), F.col("props"), F.lit(" I think"))).otherwise("no idea")
    return t(spark, d, "events").select("event_id", text.json_from_model(answer, "k int")["k"].alias("k"))


@query("cache_keys", """SELECT c_custkey, sha256('{"name":"' || c_name || '","segment":"x ' || c_mktsegment || '"}') AS fingerprint, md5('{"page":"' || c_custkey || '","q":"' || c_mktsegment || '"}') AS request FROM customer""")
def cache_keys(spark, d):
    return t(spark, d, "customer").select("c_custkey", text.fingerprint(segment=F.concat(F.lit(" x \t "), F.col("c_mktsegment")), name=F.col("c_name")).alias("fingerprint"), text.request_key(q=F.col("c_mktsegment"), page=F.col("c_custkey")).alias("request"))


@query("claims", "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'The culture of this object is ' || c_mktsegment || '.' END AS claim FROM customer")
def claims(spark, d):
    return t(spark, d, "customer").select("c_custkey", text.claim("culture", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).otherwise("nan")).alias("claim"))


# ---------------------------------------------------------------- consolidation, injection, reports

@query("unwrapped_dates", "SELECT o_orderkey, abs(y) AS date_begin, y < 0 AS bce, CASE WHEN o_orderkey % 5 > 0 THEN 1900 END AS date_end FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) ELSE -(o_orderkey % 900) - 1 END AS y FROM orders)")
def unwrapped_dates(spark, d):
    k = F.col("o_orderkey")
    parsed = F.struct(F.when(k % 2 == 0, F.year("o_orderdate")).alias("date_begin"), F.lit(None).cast("int").alias("date_end"), F.lit(False).alias("date_begin_bce"), F.lit(False).alias("date_end_bce"))
    out = consolidate.unwrap_date(parsed, -(k % 900) - 1, F.when(k % 5 > 0, "1900.0").otherwise("late"))
    return t(spark, d, "orders").select("o_orderkey", out["date_begin"].cast("long").alias("date_begin"), out["date_begin_bce"].alias("bce"), out["date_end"].alias("date_end"))


@query("unwrapped_media", "SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_name END AS media, CASE WHEN p_size % 2 = 0 THEN '{\"height\":\"' || p_size || '\"}' ELSE p_size || ' cm' END AS dimensions FROM part")
def unwrapped_media(spark, d):
    n = F.col("p_size")
    items = F.array(F.lit(" "), F.when(n % 4 > 0, F.col("p_name")), F.lit(None).cast("string"))
    measures = F.when(n % 2 == 0, F.concat(F.lit('{"scratchpad": "think", "height": "'), s(n), F.lit('"}'))).otherwise(F.concat(s(n), F.lit(" cm")))
    return t(spark, d, "part").select("p_partkey", F.array_join(consolidate.unwrap_list(items), ",").alias("media"), consolidate.unwrap_dimensions(measures).alias("dimensions"))


@query("unwrapped_artists", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Source ' || c_nationkey END AS artist_name, CASE WHEN c_custkey % 3 > 0 THEN lower(c_mktsegment) END AS artist_role, 1500 + CAST(c_custkey % 400 AS INT) AS born FROM customer")
def unwrapped_artists(spark, d):
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    one = F.struct(F.col("c_name").alias("artist_name"), F.lit("nan").alias("artist_role"), none.alias("artist_nationality"), none.alias("artist_date_begin"), none.alias("artist_date_end"))
    source = {"artist_name": F.concat(F.lit("Source "), s("c_nationkey")), "artist_role": F.when(k % 3 > 0, F.col("c_mktsegment")).otherwise("Unknown"), "artist_nationality": none, "artist_date_begin": F.concat(F.lit("c. "), s(k % 400 + 1500)), "artist_date_end": none}
    out = consolidate.unwrap_artist(F.when(k % 2 == 0, F.array(one)).otherwise(F.filter(F.array(one), lambda _: F.lit(False))), source)
    return t(spark, d, "customer").select("c_custkey", out["artist_name"].alias("artist_name"), out["artist_role"].alias("artist_role"), out["artist_date_begin"].alias("born"))


@query("error_shadows", "SELECT c_custkey AS object_ID, s_name AS name_error, CASE WHEN s_suppkey IS NOT NULL THEN 'name' END AS error_type, CASE WHEN s_suppkey IS NOT NULL THEN 'swap' END AS error_subtype FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def error_shadows(spark, d):
    base = t(spark, d, "customer").select(F.col("c_custkey").alias("object_ID"))
    return inject.shadows(base, t(spark, d, "supplier").select(F.col("s_suppkey").alias("object_ID"), F.col("s_name").alias("name_error")), "name", "swap")


@query("error_report", "SELECT count(*) AS rows, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS errors, round(count_if(o_orderstatus = 'F') * 100.0 / count(*), 2) AS pct FROM orders")
def error_report(spark, d):
    return profile.error_share(t(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "date").alias("error_type")))


@query("pair_counts", "SELECT o_orderpriority AS subtype, count(*) AS n FROM orders GROUP BY 1")
def pair_counts(spark, d):
    return profile.pair_counts(t(spark, d, "orders").select(F.col("o_orderpriority").alias("subtype")))


@query("distinct_images", "SELECT user_id, min(event_type) AS url FROM events WHERE NOT contains(event_type, 'err') GROUP BY 1")
def distinct_images(spark, d):
    return sampling.distinct_images(t(spark, d, "events").select("user_id", F.col("event_type").alias("url")), "user_id", "url", ("err",))


@query("vector_mismatch", """
SELECT a.vec_id, coalesce(list_dot_product(list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)), list_transform(b.embedding, lambda x: CAST(x AS DOUBLE))) < 0.25, false) AS mismatch FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_mismatch(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", "embedding")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(following, "vec_id", "left").select("vec_id", vectors.mismatch(F.col("embedding"), F.col("other")).alias("mismatch"))


@query("feature_columns", "SELECT * FROM (VALUES ('c_acctbal'), ('c_mktsegment'), ('c_nationkey')) AS x(name)")
def feature_columns(spark, d):
    columns = t(spark, d, "customer").withColumnsRenamed({"c_name": "culture", "c_custkey": "object_ID"}).withColumns({"culture_error": F.lit(1), "location": F.lit(1), "title": F.lit(1)}).columns
    return spark.createDataFrame([(c,) for c in evaluate.feature_columns(columns, "culture")], "name string")


@query("first_rows", "SELECT CAST(page_id AS VARCHAR) AS page_id, url FROM pages ORDER BY pages.page_id LIMIT 20")
def first_rows(spark, d):
    return evaluate.head(t(spark, d, "pages").select("page_id", "url"), "page_id", 20)
