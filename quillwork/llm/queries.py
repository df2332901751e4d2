"""The registered queries of this subpackage: thin digests over the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, html_text, langid, lexical_search, lm_score, near_vectors, ngram_join, packing, pii, spelling, toxicity, url_filter
from .common import held_out, table


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies. Its place is the installed package's business; pass another path to the operators at will."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the rules, else by trees trained on labelled URLs. For odd input see url_filter.judge()."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity. For odd input see toxicity.score_documents()."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, lexicon).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and the next document's. For odd input see fingerprint.compare_with_next()."""
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 4,096 tokens. For odd input see packing.pack_documents()."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, none rejected. For odd input see langid.identify()."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return langid.identify(docs, model, reject=False).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and digests of its ids and of what they decode to. For odd input see bpe.digest_documents()."""
    return bpe.digest_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pseudo-likelihood. For odd input see lm_score.score_documents()."""
    docs = table(spark, sf_dir, "documents")
    return lm_score.score_documents(docs, lm_score.fit(docs))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component. For odd input see near_vectors.near_duplicates()."""
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component. For odd input see ngram_join.classes()."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text. For odd input see html_text.extract()."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item. For odd input see lexical_search.search()."""
    return lexical_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base spans and terms that disclose them. For odd input see pii.find()."""
    return pii.report(spark, table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents with its form and root. For odd input see spelling.word_counts()."""
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op12 the patterns alone decide."""
    return op12_pii(spark, sf_dir).drop("spans", "n_terms")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op1 no model decides: host, path and rule of every page."""
    parts = table(spark, sf_dir, "pages").select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    rule, _ = url_filter.rule_for(F.col("host"), F.col("path"))
    return parts.select("page_id", "host", "path", rule.alias("rule"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op3 is no fingerprint: every document's length and edited text."""
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_toxicity": op2_toxicity,
        "op3_fingerprints": op3_fingerprints,
        "op4_packing": op4_packing,
        "op5_language_id": op5_language_id,
        "op6_bpe": op6_bpe,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_ngram_join": op9_ngram_join,
        "op10_html_extraction": op10_html_extraction,
        "op11_lexical_search": op11_lexical_search,
        "op12_pii": op12_pii,
        "op13_spelling_variants": op13_spelling_variants,
        "pii_base": pii_base,
        "url_rules": url_rules,
        "edited_texts": edited_texts,
    }


_OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1), degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept FROM v JOIN low l ON v.vec_id = l.vec_id LEFT JOIN degree d ON v.vec_id = d.vec_id"""

_OP9_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM u x JOIN u y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2, 3, 4),
link AS (SELECT a, b FROM shared WHERE 100 * c >= 75 * (na + nb - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, low.component_id FROM s JOIN low ON s.doc_id = low.doc_id"""

_RULES_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(h, p) AS (VALUES ('com', '/'), ('example.com', '/en/'), ('www.example.com', '/en/'), ('net', '/es/'), ('net', '/fr/')),
m AS (SELECT page_id, max_by(h || r.p, length(h || r.p)) AS rule FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p) GROUP BY 1)
SELECT p.page_id, host, path, rule FROM p LEFT JOIN m ON p.page_id = m.page_id"""

_EDITED_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER w, first_value(t) OVER w) AS follows, length(t) // 4 AS k FROM t WINDOW w AS (ORDER BY doc_id NULLS FIRST))
SELECT doc_id, length(t) AS n_chars, sha256(substr(t, 1, length(t) - k) || substr(follows, 1, k)) AS edited_sha256 FROM n"""


_OP11_SQL = """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
size AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
s AS (SELECT q.item_id, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * size.n * total.docs) // total.terms)))) AS BIGINT) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN w ON w.term = tf.term JOIN size ON size.doc_id = tf.doc_id, total GROUP BY 1, 2),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50"""


_PII_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (SELECT doc_id, 0 AS no, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+') AS f, string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+') AS g FROM t
  UNION ALL SELECT doc_id, 1, regexp_extract_all(t, '[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)'), string_split_regex(t, '[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)') FROM t
  UNION ALL SELECT doc_id, 2, regexp_extract_all(t, '[0-9]([\\x20-]?[0-9])+'), string_split_regex(t, '[0-9]([\\x20-]?[0-9])+') FROM t
  UNION ALL SELECT doc_id, 3, regexp_extract_all(t, '\\+[0-9][\\x20().0-9-]+[0-9]'), string_split_regex(t, '\\+[0-9][\\x20().0-9-]+[0-9]') FROM t),
m AS (SELECT doc_id, no, f[i] AS m, list_sum(list_transform(f[1:i], lambda x: length(x))) + list_sum(list_transform(g[1:i], lambda x: length(x))) AS stop FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM raw)),
digits AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM m),
good AS (SELECT doc_id, no, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM digits WHERE CASE no WHEN 0 THEN true
  WHEN 1 THEN len(list_filter(string_split(m, '.'), lambda x: NOT regexp_full_match(x, '0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])'))) = 0
  WHEN 2 THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(d), i, 1) AS INTEGER) WHEN CAST(substr(reverse(d), i, 1) AS INTEGER) > 4 THEN 2 * CAST(substr(reverse(d), i, 1) AS INTEGER) - 9 ELSE 2 * CAST(substr(reverse(d), i, 1) AS INTEGER) END)) % 10 = 0
  ELSE length(d) BETWEEN 9 AND 15 END),
s AS (SELECT doc_id, count(*) FILTER (no = 0) AS n_email, count(*) FILTER (no = 1) AS n_ip, count(*) FILTER (no = 2) AS n_card, count(*) FILTER (no = 3) AS n_phone,
  string_agg(['email', 'ip', 'card', 'phone'][no + 1] || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans FROM good GROUP BY 1)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256 FROM t LEFT JOIN s ON t.doc_id = s.doc_id"""

_OP13_SQL = """
WITH RECURSIVE tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) t(i)),
run AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
d AS (SELECT doc_id, w, count(*) AS n FROM run WHERE length(w) >= 6 GROUP BY 1, 2),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM d, tab),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n FROM h),
word AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cut AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS p FROM word)),
near AS (SELECT x.word AS a, y.word AS b, y.n AS n FROM cut x JOIN cut y ON x.rest = y.rest AND x.p = y.p AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN word y ON x.rest = y.word UNION SELECT y.word, x.word, x.n FROM cut x JOIN word y ON x.rest = y.word),
best AS (SELECT a, CAST(count(*) AS BIGINT) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n FROM near GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM word LEFT JOIN best ON word = a),
way(word, stop) AS (SELECT word, word FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.stop = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT way.word, stop AS root FROM way JOIN f ON way.stop = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends ON f.word = ends.word"""


def oracle_sql() -> dict[str, str]:
    """The exact joins, and what of op1 and op3 is a rule. Trained models, tokenizers and piecewise hashes have no SQL form; tests hold them against brute force."""
    return {"op8_embedding_dedup": _OP8_SQL, "op9_ngram_join": _OP9_SQL, "op11_lexical_search": _OP11_SQL, "op13_spelling_variants": _OP13_SQL, "pii_base": _PII_SQL, "url_rules": _RULES_SQL, "edited_texts": _EDITED_SQL}
