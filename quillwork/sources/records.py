"""Records from museum APIs and dumps: flattening, gap filling, eligibility."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_to_text, list_to_str, real, source_prefix
from ..schema import HARVESTED_COLUMNS, conform

IMAGE_SIZE = 843


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The first reason whose condition holds; null keeps the row."""
    return reduce(lambda chain, r: F.when(F.coalesce(r[1], F.lit(False)), r[0]).otherwise(chain), reversed(reasons), F.lit(None).cast("string"))


def image_url(image_id: Column, alternatives: Column, base: str, size: int = IMAGE_SIZE) -> Column:
    """The image service's URL of the image, else of its first alternate; null without both."""
    chosen = F.coalesce(real(image_id), F.try_element_at(alternatives, F.lit(1)))
    return F.when(chosen.isNotNull(), F.format_string(f"{base}/%s/full/{size},/0/default.jpg", chosen))


def flatten_dump(df: DataFrame, base: str = "https://images.example.org/iiif/2") -> DataFrame:
    """Records of a JSON dump's objects. A missing display date is made of begin and end; a year 0 means none."""
    year = lambda c: F.nullif(F.col(c).cast("int"), F.lit(0)).cast("string")
    shown = F.coalesce(real(F.col("date_display")), F.nullif(F.concat_ws("-", year("date_start"), year("date_end")), F.lit("")))
    out = df.select(
        F.col("id").cast("string").alias("object_ID"), "title", F.col("artwork_type_title").alias("object_name"), list_to_str(F.col("classification_titles")).alias("classification"),
        shown.alias("date"), year("date_start").alias("date_begin"), year("date_end").alias("date_end"), F.col("medium_display").alias("medium"),
        list_to_str(F.col("material_titles")).alias("material"), list_to_str(F.col("technique_titles")).alias("technique"), "dimensions", F.col("place_of_origin").alias("country"),
        html_to_text(F.col("artist_display")).alias("artist_display_bio"), list_to_str(F.col("artist_titles")).alias("artist_titles"), list_to_str(F.col("subject_titles")).alias("subjects"),
        "inscriptions", html_to_text(F.col("description")).alias("description"), image_url(F.col("image_id"), F.col("alt_image_ids"), base).alias("image_url"),
    )
    return conform(out)


def dump_skip_reason() -> Column:
    """Why an object of a dump is left out, in the order of the checks."""
    return first_reason([
        ("load_error", F.col("load_error")), ("not_public_domain", ~F.coalesce(F.col("is_public_domain"), F.lit(False))),
        ("no_image", F.col("image_id").isNull() & (F.coalesce(F.size("alt_image_ids"), F.lit(0)) <= 0)), ("flatten_error", F.col("id").isNull()),
        ("no_description", real(F.col("description")).isNull()),
    ])


def flatten_rest(df: DataFrame, descriptions: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Records of a REST API's objects; an artist's name falls back to the first constituent, tags become a list, descriptions come from a side table: an id's last by the order column, or the greatest text without one."""
    tags = F.array_join(F.transform(F.filter("tags", lambda x: x["term"].isNotNull()), lambda x: x["term"]), ", ")
    out = df.select(
        F.col("objectID").cast("string").alias("object_ID"), "title", F.col("objectName").alias("object_name"), "classification", "department", F.col("objectDate").alias("date"),
        F.col("objectBeginDate").cast("string").alias("date_begin"), F.col("objectEndDate").cast("string").alias("date_end"), "medium", "dimensions", "culture", "country", "region", "city", "period", "dynasty", "reign",
        F.coalesce(real(F.col("artistDisplayName")), F.try_element_at("constituents", F.lit(1))["name"]).alias("artist_name"), F.col("artistRole").alias("artist_role"), F.col("artistNationality").alias("artist_nationality"),
        F.col("artistBeginDate").alias("artist_date_begin"), F.col("artistEndDate").alias("artist_date_end"), F.col("artistDisplayBio").alias("artist_display_bio"), F.nullif(tags, F.lit("")).alias("subjects"), F.col("primaryImage").alias("image_url"),
    )
    if descriptions is not None:
        side = descriptions.where("description is not null").groupBy(F.col("object_id").cast("string").alias("object_ID")).agg(F.max_by("description", F.struct(*[F.col(order)] * (order is not None), "description")).alias("description"))
        out = out.join(side, "object_ID", "left")
    return conform(out)


RDF_PATHS = {
    "image_url": ("//isShownBy/@resource", "//WebResource/@about"), "date": ("//created/text()", "//date/text()", "//issued/text()"), "material": ("//medium/text()",), "technique": ("//technique/text()",),
    "dimensions": ("//extent/text()",), "country": ("//spatial/text()", "//coverage/text()"), "subjects": ("//subject/text()",), "object_ID": ("//identifier/text()",),
}


def plain_xml(xml: Column) -> Column:
    """XML without namespace prefixes and declarations, so that paths are simple."""
    bare = F.regexp_replace(xml, r"\sxmlns(?::\w+)?=\"[^\"]*\"", "")
    return F.regexp_replace(F.regexp_replace(bare, r"<(/?)\w+:", "<$1"), r"\s\w+:(\w+=)", " $1")


def _found(root: ET.Element, path: str) -> list[str]:
    """The texts or attributes at //tag/text() or //tag/@name, in the order of the document; comments part texts, as in XPath."""
    tag, what = path.removeprefix("//").split("/")
    if what.startswith("@"):
        return [e.attrib[what[1:]] for e in root.iter(tag) if what[1:] in e.attrib]
    return [x for e in root.iter(tag) for x in (e.text, *(c.tail for c in e)) if x]


def values_at(xml: Column, paths: list[str]) -> Column:
    """For each of the paths, of the forms //tag/text() and //tag/@name, all that it finds; each record is parsed once. Null for null and broken XML."""

    def one(text: str | None) -> list[list[str]] | None:
        if text is None:
            return None
        try:
            root = ET.fromstring(text, ET.XMLParser(target=ET.TreeBuilder(insert_comments=True, insert_pis=True)))
        except ET.ParseError:
            return None
        return [_found(root, p) for p in paths]

    return F.pandas_udf(lambda texts: pd.Series([one(x) for x in texts], dtype=object), "array<array<string>>")(plain_xml(xml))


def _joined(found: Column) -> Column:
    """Found texts without white space at their ends and empty ones, joined by ', '; null without any."""
    return F.nullif(F.array_join(F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != ""), ", "), F.lit(""))


def aggregated_uri(xml: Column) -> Column:
    """The URI of the object that a record aggregates, else of the aggregation itself."""
    found = values_at(xml, ["//aggregatedCHO/@resource", "//Aggregation/@about"])
    return F.coalesce(*[F.nullif(F.get(F.get(found, F.lit(i)), F.lit(0)), F.lit("")) for i in range(2)])


def literals(xml: Column, path: str) -> Column:
    """All texts at a path, joined by ', '; null without any."""
    return _joined(F.get(values_at(xml, [path]), F.lit(0)))


def fill_from_rdf(df: DataFrame, xml: str = "xml") -> DataFrame:
    """df with its empty fields filled from the record's XML, each from the first path that has something; filled ones stay. A record is parsed once, and only if a field is empty."""
    fields = [f for f in RDF_PATHS if f in df.columns]
    if not fields:
        return df
    paths = [p for f in fields for p in RDF_PATHS[f]]
    empty = reduce(lambda a, b: a | b, [real(F.col(f)).isNull() for f in fields])
    found = df.withColumn("__found", values_at(F.when(empty, F.col(xml)), paths))
    return found.withColumns({f: F.coalesce(real(F.col(f)), *[_joined(F.get("__found", F.lit(paths.index(p)))) for p in RDF_PATHS[f]]) for f in fields}).drop("__found")


def resolve_references(nodes: DataFrame, references: DataFrame) -> DataFrame:
    """(id, field, value): references (id, field, text, resource) by their own text, else by the label of the node (about, prefLabel, label, title) that they name."""
    labels = nodes.select(F.col("about").alias("resource"), F.coalesce(real(F.col("prefLabel")), real(F.col("label")), real(F.col("title"))).alias("named")).groupBy("resource").agg(F.min("named").alias("named"))
    return references.join(labels, "resource", "left").select("id", "field", F.coalesce(real(F.col("text")), F.col("named")).alias("value")).where("value is not null")


def dereference(df: DataFrame, column: str, entities: DataFrame, into: str) -> DataFrame:
    """df with the document of the linked entity (uri, doc); each uri is looked up once, as a join."""
    e = entities.select(F.col("uri").alias("__uri"), F.col("doc").alias(into)).dropDuplicates(["__uri"])
    return df.join(e, F.col(column) == F.col("__uri"), "left").drop("__uri")


def image_chain(objects: DataFrame, visuals: DataFrame, digitals: DataFrame) -> DataFrame:
    """(id, image_url) over three hops: object (id, visual), visual (uri, digital), digital (uri, access_point)."""
    v = visuals.select(F.col("uri").alias("visual"), "digital")
    g = digitals.select(F.col("uri").alias("digital"), F.col("access_point").alias("image_url"))
    return objects.select("id", "visual").join(v, "visual", "left").join(g, "digital", "left").groupBy("id").agg(F.min("image_url").alias("image_url"))


def linked_record(documents: DataFrame) -> DataFrame:
    """A wide record of each linked-data document (uri, doc as JSON text): id, titles, type, image, places; no object gives nulls."""
    v = F.try_parse_json("doc")
    get = lambda p: F.try_variant_get(v, p, "string")
    from ..functions.linked import pick_identifier

    out = documents.select(pick_identifier(F.coalesce(get("$.id"), F.col("uri"))).alias("object_ID"), get("$.identified_by[0].content").alias("title"), get("$.classified_as[0]._label").alias("object_name"), get("$.produced_by.timespan._label").alias("date"), get("$.current_location._label").alias("city"), get("$.subject_of[0].content").alias("description"), F.col("uri").alias("cho_uri"))
    return conform(out, HARVESTED_COLUMNS)


def extent(texts: DataFrame) -> DataFrame:
    """(id, extent): of extent texts (id, language, number, text) the best by language, then number, then length."""
    rank = F.when(F.col("language") == "English", 0).when(F.col("language") == "Dutch", 1).otherwise(2)
    return texts.groupBy("id").agg(F.min_by("text", F.struct(rank.alias("r"), "number", F.length("text").alias("n"), "text")).alias("extent"))


def iso_span(dates: DataFrame) -> DataFrame:
    """(id, date_begin, date_end): least and greatest year of ISO dates (id, date)."""
    y = F.regexp_extract("date", r"^(-?\d{1,4})", 1).try_cast("int")
    return dates.groupBy("id").agg(F.min(y).alias("date_begin"), F.max(y).alias("date_end"))


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("object_ID", source_prefix(F.col("object_ID"), prefix))
