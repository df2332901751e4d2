"""Linked data as a relation: documents are walked to rows of nodes once, records and labels are joins over them."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import register
from ..functions.text import strip_html, trim_all

#: Ids of kinds and languages (fixed values).
AAT = "http://vocab.getty.edu/aat/"
ENGLISH, DUTCH = f"{AAT}300388277", f"{AAT}300388256"
DESCRIPTION, DIMENSIONS, MEDIUM, CREDIT = f"{AAT}300048722", f"{AAT}300435430", f"{AAT}300435429", f"{AAT}300026687"
PROVENANCE, LABEL, INSCRIPTION, REJECTED = f"{AAT}300444174", f"{AAT}300417268", f"{AAT}300435414", f"{AAT}300404908"
PEOPLE = ("Person", "Actor")
LABELS = "map<string,array<string>>"


#: Letters of documents, and rows of a wide table, in a task that sorts them.
DOCUMENTS, RECORDS = 1 << 25, 200_000


def _dealt(rows: DataFrame, size: float, most: int) -> DataFrame:
    """rows by uri, in so many partitions that each has about `most` of their size: a grouping by uri sorts no more than that in a task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(n, -int(-size // most)), "uri")


def nodes(documents: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """uri and the node columns of ld_nodes(), for each of documents (uri, doc as JSON text). Repeated uris: the document that sorts first.

    With objects (uri) also `mine`: whether the document is that of an object.
    """
    register(documents.sparkSession)
    size = documents.agg(F.sum(F.length("doc"))).first()[0] or 0
    if objects is None:
        one = _dealt(documents, size, DOCUMENTS).groupBy("uri").agg(F.min("doc").alias("doc"))
        return documents.sparkSession.sql("SELECT d.uri, n.* FROM {docs} d, LATERAL ld_nodes(d.doc) n", docs=one)
    marks = objects.where("uri IS NOT NULL").select("uri", F.lit(None).cast("string").alias("doc"), F.lit(True).alias("mine"))
    both = documents.select("uri", "doc", F.lit(False).alias("mine")).unionByName(marks)
    one = _dealt(both, size, DOCUMENTS).groupBy("uri").agg(F.min("doc").alias("doc"), F.max("mine").alias("mine"))
    return documents.sparkSession.sql("SELECT d.uri, d.mine, n.* FROM {docs} d, LATERAL ld_nodes(d.doc) n", docs=one)


def tags(languages: Column) -> Column:
    """English, Dutch or und for each language id; und without any."""
    each = F.transform(languages, lambda x: F.when(x == ENGLISH, "English").when(x == DUTCH, "Dutch").otherwise("und"))
    return F.when(F.size(languages) > 0, each).otherwise(F.array(F.lit("und")))


def _one_language(languages: Column) -> Column:
    return F.when(F.array_contains(languages, ENGLISH), "English").when(F.array_contains(languages, DUTCH), "Dutch")


def _by_language(rows: DataFrame, keys: list[str], distinct: bool = True) -> DataFrame:
    """keys and labels, a map from language to texts in order (of rows keys, language, text, node), without repeats if distinct."""
    rows = rows.groupBy(*keys, "language", "text").agg(F.min("node").alias("node")) if distinct else rows
    each = rows.groupBy(*keys, "language").agg(F.array_sort(F.collect_list(F.struct("node", "text"))).alias("found"))
    return each.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", F.col("found.text").alias("texts"))))).alias("labels"))


def names(rows: DataFrame, at: str = "identified_by") -> DataFrame:
    """(uri, labels): English and Dutch names of each document, in order, without repeats; no row without any."""
    named = rows.where((F.col("path") == at) & (F.col("type") == "Name")).select("uri", "node", trim_all(F.col("content")).alias("text"), F.explode(tags(F.col("languages"))).alias("language"))
    return _by_language(named.where((F.col("text") != "") & F.col("language").isin("English", "Dutch")), ["uri"])


def _first(rows: DataFrame, value: Column, *order: str) -> DataFrame:
    """(uri, value): each document's value that comes first in the order, nulls left out."""
    return rows.select("uri", F.struct(*order).alias("o"), value.alias("value")).where(F.col("value").isNotNull()).groupBy("uri").agg(F.min_by("value", "o").alias("value"))


def _or_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with found: the node's own label under und, else the labels of the document that its id names."""
    looked_up = labels.select(F.col("uri").alias("id"), F.col("labels").alias("__l"))
    own = F.map_from_arrays(F.array(F.lit("und")), F.array(F.array("label")))
    has = rows.where(F.col("label").isNotNull()).withColumn("found", own)  # not joined: most have no id, and would meet in one task
    return has.unionByName(rows.where(F.col("label").isNull() & F.col("id").isNotNull()).join(looked_up, "id").withColumnRenamed("__l", "found"))


def people(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(uri, names, activities, birth_place, death_place, birth, death, equivalent) of every document, as if it were a person's."""

    def dated(what: str, first: str, second: str) -> DataFrame:
        return _first(rows.where(F.col("path") == f"{what}/timespan"), F.coalesce(F.nullif(F.col("spans")[first], F.lit("")), F.nullif(F.col("spans")[second], F.lit(""))), "node")

    def place(what: str) -> DataFrame:
        at = rows.where((F.col("path") == f"{what}/took_place_at") & F.col("spans").isNotNull())
        return _first(at.join(labels.select(F.col("uri").alias("id"), "labels"), "id"), F.col("labels"), "node")

    done = rows.where((F.col("path") == "carried_out/classified_as") & F.col("spans").isNotNull()).join(labels.select(F.col("uri").alias("id"), "labels"), "id")
    words = done.select("uri", F.explode("labels").alias("language", "texts")).select("uri", "language", F.explode("texts").alias("text")).withColumn("node", F.col("text"))
    parts = {
        "names": names(rows).select("uri", F.col("labels").alias("value")), "activities": _by_language(words, ["uri"]).select("uri", F.col("labels").alias("value")),
        "birth_place": place("born"), "death_place": place("died"), "birth": dated("born", "begin_of_the_begin", "end_of_the_end"), "death": dated("died", "end_of_the_end", "begin_of_the_begin"),
        "equivalent": rows.where((F.col("path") == "equivalent") & F.col("spans").isNotNull() & F.col("id").isNotNull()).groupBy("uri").agg(F.array_sort(F.collect_list(F.struct("node", "id")))["id"].alias("value")),
    }
    return _widen(rows.where("node = 0").select("uri"), parts)


def _widen(base: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Each uri of base once, with each part's value (uri, value) of it: one grouping, as a join for each part holds a sort for each in one task.

    base should not come straight from a grouping by uri: parts dealt out like it are all made in one task.
    """
    each = [rows.select("uri", F.col("value").alias(name)) for name, rows in parts.items()]
    rows = reduce(lambda out, more: out.unionByName(more, allowMissingColumns=True), each, base.select("uri"))
    return _dealt(rows, base.count() * (len(parts) + 1), RECORDS).groupBy("uri").agg(*[F.first(name, ignorenulls=True).alias(name) for name in parts])


def makers(rows: DataFrame) -> DataFrame:
    """(uri, person, workshop): the people that a document's production names, in order, each once; assignments that are rejected don't count.

    A production's own people come first, then those assigned to it, then the same of each part. A group formed under somebody's
    influence stands for that person's workshop.
    """
    part = F.when(F.col("path").startswith("produced_by/part/"), F.get("ancestors", F.lit(2)).cast("int")).otherwise(-1)
    p = rows.where(F.col("path").startswith("produced_by/")).withColumn("short", F.regexp_replace("path", "^produced_by/(part/)?", "")).withColumn("part", part)
    named = F.col("type").isin(*PEOPLE) & F.col("id").isNotNull()
    own = p.where((F.col("short") == "carried_out_by") & named).select("uri", "part", F.lit(0).alias("step"), "node", F.col("id").alias("person"), F.lit(False).alias("workshop"))
    sound = p.where((F.col("short") == "assigned_by") & (F.col("assigned_property") == "carried_out_by") & ~F.array_contains("kinds", REJECTED)).select("uri", F.col("node").alias("by"))
    by = F.get("ancestors", F.when(F.col("part") >= 0, F.lit(3)).otherwise(F.lit(2)))
    found = p.where(F.col("short").isin("assigned_by/assigned", "assigned_by/assigned/carried_out_by", "assigned_by/assigned/formed_by/influenced_by") & F.col("type").isin(*PEOPLE) & F.col("id").isNotNull())
    kinds = p.where(F.col("short") == "assigned_by/assigned").select("uri", F.col("node").alias("of"), F.col("type").alias("of_type"))
    found = found.withColumn("by", by).join(sound, ["uri", "by"], "left_semi")
    above = F.get("ancestors", F.when(F.col("part") >= 0, F.lit(4)).otherwise(F.lit(3)))
    found = found.withColumn("of", F.when(F.col("short") == "assigned_by/assigned", F.col("node")).otherwise(above)).join(kinds, ["uri", "of"])
    group = (F.col("short") == "assigned_by/assigned/formed_by/influenced_by") & (F.col("of_type") == "Group") & (F.col("type") == "Person")
    fits = (F.col("short") == "assigned_by/assigned") | ((F.col("short") == "assigned_by/assigned/carried_out_by") & (F.col("of_type") == "Production")) | group
    given = found.where(fits).select("uri", "part", F.lit(1).alias("step"), "node", F.col("id").alias("person"), group.alias("workshop"))
    both = own.unionByName(given).withColumn("o", F.struct("part", "step", "node"))
    return both.groupBy("uri", "person").agg(F.min("o").alias("o"), F.min_by("workshop", "o").alias("workshop"))


def _provenance(c: Column) -> Column:
    """A leading ellipsis, a pair of braces, or two semicolons and more."""
    return c.rlike(r"^\s*(\.\.\.|…)") | (c.contains("{") & c.contains("}")) | (F.length(c) - F.length(F.replace(c, F.lit(";"), F.lit(""))) >= 2)


def descriptions(rows: DataFrame) -> DataFrame:
    """(uri, value): a map from language to text. The first described text of each language; for English or Dutch without one, a label or else the longest other text that is no known kind and no provenance."""
    said = rows.where(F.col("path").rlike("^subject_of(/part)*$") & (F.col("type") == "LinguisticObject") & F.array_contains("kinds", DESCRIPTION))
    said = said.select("uri", "node", strip_html(trim_all(F.col("content"))).alias("text"), F.explode(tags(F.col("inherited"))).alias("language")).where(F.col("text") != "")
    first = said.groupBy("uri", "language").agg(F.min_by("text", "node").alias("text"))
    known = F.array(*map(F.lit, (DIMENSIONS, MEDIUM, DESCRIPTION, CREDIT, PROVENANCE, INSCRIPTION)))
    other = rows.where((F.col("path") == "referred_to_by") & ~F.arrays_overlap("kinds", known) & (F.length(trim_all(F.col("content"))) >= 40))
    other = other.select("uri", "node", _one_language(F.col("languages")).alias("language"), strip_html(trim_all(F.col("content"))).alias("text"), F.array_contains("kinds", LABEL).alias("label")).where(F.col("language").isNotNull() & (F.col("text") != "") & ~_provenance(F.col("text")))
    best = other.groupBy("uri", "language").agg(F.min_by("text", F.struct((~F.col("label")).alias("l"), (-F.length("text")).alias("n"), "node")).alias("text"))
    missing = best.join(first, ["uri", "language"], "left_anti")
    both = first.unionByName(missing)
    return both.groupBy("uri").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "text")))).alias("value"))


def records(objects: DataFrame, documents: DataFrame) -> DataFrame:
    """The wide multilingual record of each object (uri), from documents (uri, doc) of objects, people, places and concepts.

    Every document is walked once; labels, people and places are looked up by join, once each. Artist columns are filled if exactly one
    maker's document is known. An object without a readable document has its object_ID only. Repeated uris give one record.
    """
    from .sinks import cutter

    cut = cutter(documents.sparkSession)
    rows = cut(nodes(documents, objects))
    mine = rows.where("mine").drop("mine")
    rows = rows.drop("mine")
    # labels are only looked up by id: those of documents that no other names, as of most objects, are not made
    labels = cut(names(rows.join(rows.where("node > 0 AND id IS NOT NULL").select(F.col("id").alias("uri")).distinct(), "uri", "left_semi")))
    at = lambda *paths: mine.where(F.col("path").isin(*paths))
    resolved = lambda *paths: _or_label(at(*paths), labels)
    plain = F.col("spans").isNotNull()
    made = makers(mine).join(rows.where("node = 0").select(F.col("uri").alias("person")), "person", "left_semi")
    single = made.groupBy("uri").agg(F.count("*").alias("n"), F.min("person").alias("person")).where("n = 1").select("uri", "person")
    single = cut(single)
    known = people(cut(rows.join(single.select(F.col("person").alias("uri")).distinct(), "uri", "left_semi")), labels).withColumnRenamed("uri", "person")
    artist = single.join(cut(known), "person").drop("person")
    where = at("current_location", "current_location/identified_by", "current_location/identified_by/part")
    named = where.where((F.col("path") != "current_location") & (F.col("type") == "Name")).withColumn("text", trim_all(F.col("content"))).where(F.col("text") != "")
    room = F.col("text").rlike(r"\p{Nd}|-") | F.lower("text").rlike("^(hg|zaal|room)")
    inner = F.col("path").endswith("/part")  # a name's parts come before it
    named = named.select("uri", "text", room.alias("room"), F.when(inner, F.col("parent")).otherwise(F.col("node")).alias("of"), (~inner).alias("whole"), "node")
    spoken = _first(named, F.map_from_arrays(F.array(F.lit("und")), F.array(F.array("text"))), "room", "of", "whole", "node")
    held = _first(where.where((F.col("path") == "current_location") & F.col("id").isNotNull()).join(labels.select(F.col("uri").alias("id"), "labels"), "id"), F.col("labels"), "node")
    place = held.select("uri", F.col("value").alias("a")).join(spoken.select("uri", F.col("value").alias("b")), "uri", "full").select("uri", F.coalesce("a", "b").alias("value"))
    right = at("shows/subject_to/classified_as", "subject_of/subject_to/classified_as").where(plain).withColumn("later", F.col("path").startswith("subject_of"))
    written = mine.where((F.col("path") == "referred_to_by") & F.array_contains("kinds", INSCRIPTION)).select("uri", "node", trim_all(F.col("content")).alias("text"), _one_language(F.col("languages")).alias("language")).where((F.col("text") != "") & F.col("language").isNotNull())
    country = resolved("produced_by/part/took_place_at", "shows/represents").withColumn("later", F.col("path").startswith("shows"))
    parts = {
        "title": names(mine).select("uri", F.col("labels").alias("value")),
        "object_name": _first(resolved("classified_as").where(plain), F.col("found"), "node"),
        "department": at("member_of").where(plain & F.col("id").isNotNull()).groupBy("uri").agg(F.array_sort(F.collect_list(F.struct("node", "id")))["id"].alias("value")),
        "country": _first(country, F.col("found"), "later", "node"),
        "inscriptions": _by_language(written, ["uri"], distinct=False).select("uri", F.col("labels").alias("value")),
        "description": descriptions(mine), "current_location": place,
        "cho_uri": _first(mine.where("node = 0"), F.col("id"), "node"),
        "rights": _first(right, F.coalesce("label", "id"), "later", "node"),
    }
    of_artist = [c for c in artist.columns if c != "uri"]
    parts_and_artist = parts | {"artist": artist.select("uri", F.struct(*of_artist).alias("value"))}
    out = _widen(objects, parts_and_artist).select("uri", *parts, "artist.*")
    out = out.withColumn("object_ID", F.element_at(F.split("uri", "/"), -1))
    return out.select("object_ID", *parts, *[F.col(c).alias(f"artist_{a}") for c, a in (("names", "name"), ("activities", "role"), ("birth_place", "place_of_birth"), ("death_place", "place_of_death"), ("birth", "date_begin"), ("death", "date_end"), ("equivalent", "equivalent"))], "uri")


#: Words that mark a set worth a look (fixed values).
IMPORTANT = r"(?i)\b(public|domain|painting|paintings|schilderij|schilderijen|sculpture|beeldhouwwerken|keramiek|porselein|porcelain)\b"


def _listed_sets(pages: pd.Series) -> pd.Series:
    """The sets of each list response, with the number of their element in document order; null for null and broken XML."""

    def plain(tag: str) -> str:
        return tag.rsplit("}", 1)[-1]

    def greatest(of: ET.Element, tag: str) -> str:
        return max(((e.text or "").strip() for e in of if plain(e.tag) == tag), default="")

    def one(xml: str | None) -> list[dict] | None:
        try:
            root = ET.fromstring(xml) if xml else None
        except ET.ParseError:
            return None
        if root is not None:
            return [{"position": i, "spec": greatest(e, "setSpec"), "name": greatest(e, "setName")} for i, e in enumerate(root.iter()) if plain(e.tag) == "set"]
        return None

    return pd.Series([one(x) for x in pages], dtype=object)


def set_catalogue(pages: DataFrame) -> DataFrame:
    """(spec, name, important) of the sets in list responses (page, xml), in the order of pages and elements as `position`; broken pages give no rows."""
    listed = F.pandas_udf(_listed_sets, "array<struct<position:int,spec:string,name:string>>")
    sets = pages.select("page", F.explode(listed("xml")).alias("s")).select("page", "s.*")
    return sets.select("page", "position", "spec", "name", F.col("name").rlike(IMPORTANT).alias("important"))


def tree_listing(sets: DataFrame, cut=None) -> DataFrame:
    """(id, root, depth): every set (id, parent) below the roots, by a frontier of joins; one written table a level.

    Roots have a null parent or one that is no id. Sets on a cycle hang on no root and are left out. An id with several parents
    has a row for each root and its least depth there.
    """
    from .sinks import cutter

    cut = cut or cutter(sets.sparkSession)
    edges = cut(sets.select("id", "parent").distinct())
    top = edges.join(edges.select(F.col("id").alias("parent")).distinct(), "parent", "left_anti")
    levels = [cut(top.select("id", F.col("id").alias("root"), F.lit(0).alias("depth")).distinct())]
    while not levels[-1].isEmpty():
        below = edges.join(levels[-1].withColumnRenamed("id", "parent"), "parent").select("id", "root", (F.col("depth") + 1).alias("depth")).distinct()
        seen = reduce(DataFrame.unionByName, levels).select("id", "root")
        levels.append(cut(below.join(seen, ["id", "root"], "left_anti")))
    return reduce(DataFrame.unionByName, levels)
