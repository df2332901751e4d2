"""Error injection: labelled errors in shadow columns, by mutation or by swapping pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lists import astronomical_year, from_astronomical
from ..functions.text import ambiguous, anonymous_for_injection, nullish, propagate, similar_loose
from .ordered import first_of_each

#: Columns that may get a shadow.
SHADOWED = (
    "date_begin date_end date_begin_bce date_end_bce materials techniques dimensions_json culture location artist_name artist_role "
    "artist_nationality artist_date_begin artist_date_end image image_object_id"
).split()
#: What each kind of error changes.
ERROR_COLUMNS = {
    "date": ("date_begin", "date_end", "date_begin_bce", "date_end_bce"), "material": ("materials",), "technique": ("techniques",), "dimension": ("dimensions_json",),
    "culture": ("culture", "location"), "place": ("culture", "location"), "artist": ("artist_name", "artist_role", "artist_nationality", "artist_date_begin", "artist_date_end"), "image": ("image", "image_object_id"),
}
SHIFTS = (-300, -200, -100, 100, 200, 300)
#: Technique pairs that never replace each other.
FORBIDDEN = (("painting", "oil painting"), ("print", "printmaking"))


def choice(n: int | Column, *key: Column, seed: int | str = 42) -> Column:
    """A number from 1 to n that depends on the key only."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return (F.pmod(h, n if isinstance(n, Column) else F.lit(n)) + 1).cast("int")


def century_shift(begin: Column, end: Column, begin_bce: Column, end_bce: Column, shift: Column, latest: int = 2025) -> Column:
    """Both bounds moved by whole centuries on a scale with a year 0; null if one would lie beyond the latest year."""
    b, e = astronomical_year(begin, begin_bce) + shift, astronomical_year(F.coalesce(end, begin), F.when(end.isNull(), begin_bce).otherwise(end_bce)) + shift
    (by, bf), (ey, ef) = from_astronomical(b), from_astronomical(e)
    return F.when((b <= latest) & (e <= latest), F.struct(by.cast("int").alias("date_begin"), ey.cast("int").alias("date_end"), bf.alias("date_begin_bce"), ef.alias("date_end_bce")))


def century_shift_anonymous(df: DataFrame, key: str = "object_ID", seed: int = 42) -> DataFrame:
    """df with shifted: a century shift of anonymous dated records, chosen by a hash of the id; null elsewhere."""
    drawn = F.element_at(F.array(*map(F.lit, SHIFTS)), choice(len(SHIFTS), F.col(key), seed=seed))
    ok = anonymous_for_injection(F.col("artist_name")) & F.col("date_begin").isNotNull()
    return df.withColumn("shifted", F.when(ok, century_shift(*[F.col(c) for c in ("date_begin", "date_end", "date_begin_bce", "date_end_bce")], drawn)))


def scale_error(dims: Column, factor: Column) -> Column:
    """All values times the factor, rounded to 2."""
    measure = lambda m: m.withField("value", F.round(m["value"] * factor, 2))
    return dims.withField("parts", F.transform(dims["parts"], lambda p: p.withField("measurements", F.transform(p["measurements"], measure))))


def aspect_swap(dims: Column) -> Column:
    """Height and width exchanged where there is one part with two or three measures, both among them; null otherwise."""
    first = F.try_element_at(dims["parts"], F.lit(1))["measurements"]
    of = lambda a: F.try_element_at(F.filter(first, lambda m: m["attribute"] == a), F.lit(1))["value"]
    h, w = of("height"), of("width")
    swapped = lambda m: m.withField("value", F.when(m["attribute"] == "height", w).when(m["attribute"] == "width", h).otherwise(m["value"]))
    out = dims.withField("parts", F.transform(dims["parts"], lambda p: p.withField("measurements", F.transform(p["measurements"], swapped))))
    return F.when((F.size(dims["parts"]) == 1) & F.size(first).between(2, 3) & h.isNotNull() & w.isNotNull() & (h != w), out)


def dimension_error(dims: Column, subtype: Column, key: Column, seed: int = 42, compat: bool = False) -> Column:
    """(dims, subtype): the requested error. compat draws the subtype by hash instead and reports what it drew."""
    kind = F.when(choice(2, key, seed=f"{seed}|kind") == 1, "scale_error").otherwise("aspect_swap") if compat else subtype
    factor = F.when(choice(2, key, seed=seed) == 1, F.lit(0.1)).otherwise(F.lit(10.0))
    return F.struct(F.when(kind == "scale_error", scale_error(dims, factor)).when(kind == "aspect_swap", aspect_swap(dims)).alias("dims"), kind.alias("subtype"))


def replace_item(items: Column, old: Column, new: Column) -> Column:
    """The list with the first occurrence of old replaced."""
    at = F.array_position(items, old)
    return F.when(at > 0, F.concat(F.slice(items, 1, F.greatest(at - 1, F.lit(0)).cast("int")), F.array(new), F.slice(items, (at + 1).cast("int"), F.size(items)))).otherwise(items)


def term_candidates(records: DataFrame, items: str, neighbours: DataFrame, timelines: DataFrame, with_object: DataFrame, key: str = "object_ID", margin: int = 50) -> DataFrame:
    """Anachronisms (key, old, new): neighbours of a record's term that aren't like it, leave no choice, start later than the record's year plus a margin, and go with its object."""
    long = records.select(key, "year", "object_name", F.explode(items).alias("old"), F.col(items).alias("own"))
    found = long.join(neighbours.select(F.col("term").alias("old"), F.col("neighbour").alias("new")), "old").join(timelines.select(F.col("term").alias("new"), "start_year"), "new").join(with_object.select(F.col("term").alias("new"), F.col("neighbour").alias("object_name")).distinct(), ["new", "object_name"])
    ok = ~similar_loose(F.col("old"), F.col("new")) & ~ambiguous(F.col("new")) & ~F.array_contains("own", F.col("new")) & (F.col("start_year") > F.col("year") + margin)
    return found.where(ok).select(key, "old", "new")


def interchange_candidates(records: DataFrame, items: str, neighbours: DataFrame, object_score: DataFrame, other_score: DataFrame, key: str = "object_ID", other: str = "other", least: int = 5, top: int = 3) -> DataFrame:
    """(key, old, new, score, rank): the top candidates by the sum of their counts with the object and with the other term, one of which must be over the limit."""
    long = records.select(key, "object_name", other, F.explode(items).alias("old"), F.col(items).alias("own"))
    o = object_score.select(F.col("term").alias("new"), F.col("neighbour").alias("object_name"), F.col("n").alias("so"))
    t = other_score.select(F.col("term").alias("new"), F.col("neighbour").alias(other), F.col("n").alias("st"))
    found = long.join(neighbours.select(F.col("term").alias("old"), F.col("neighbour").alias("new")), "old").join(o, ["new", "object_name"], "left").join(t, ["new", other], "left").fillna(0, ["so", "st"])
    forbidden = F.lit(False)
    for a, b in FORBIDDEN:
        forbidden = forbidden | ((F.col("old") == a) & (F.col("new") == b)) | ((F.col("old") == b) & (F.col("new") == a))
    ok = ((F.col("so") > least) | (F.col("st") > least)) & ~similar_loose(F.col("old"), F.col("new")) & ~ambiguous(F.col("new")) & ~F.array_contains("own", F.col("new")) & ~forbidden
    scored = found.where(ok).withColumn("score", F.col("so") + F.col("st"))
    w = Window.partitionBy(key, "old").orderBy(F.desc("score"), "new")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(key, "old", "new", "score", "rank")


def pick_one(candidates: DataFrame, key: str = "object_ID", seed: int = 42) -> DataFrame:
    """One candidate a key, by hash."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), "old", "new", F.lit(str(seed))))
    return candidates.groupBy(key).agg(F.min_by(F.struct("old", "new"), h).alias("c")).select(key, "c.old", "c.new")


def list_error(records: DataFrame, items: str, picked: DataFrame, key: str = "object_ID") -> DataFrame:
    """records with <items>_error where a candidate was picked."""
    return records.join(picked, key, "left").withColumn(f"{items}_error", F.when(F.col("new").isNotNull(), replace_item(F.col(items), F.col("old"), F.col("new")))).drop("old", "new")


def artist_error(records: DataFrame, pool: DataFrame, tier: int, key: str = "object_ID", years: int = 50, seed: int = 42) -> DataFrame:
    """(key, artist_*_error): another artist from the pool (object_name, technique, artist_*, year) by tier as in pairs.artist_tier."""
    on = {4: ["object_name", "technique", "artist_nationality"], 3: ["object_name", "technique"], 2: ["object_name"]}[tier]
    fields = ("artist_name", "artist_role", "artist_nationality", "artist_date_begin", "artist_date_end")
    p = pool.select(*[F.col(c).alias(f"p_{c}") for c in dict.fromkeys([*fields, *on, "year"])])
    cond = [F.col(c) == F.col(f"p_{c}") for c in on] + [F.abs(F.col("year") - F.col("p_year")) <= years, F.lower("artist_name") != F.lower("p_artist_name")]
    if tier == 3:
        cond.append(F.col("artist_nationality") != F.col("p_artist_nationality"))
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), "p_artist_name", F.lit(str(seed))))
    best = records.join(p, cond).groupBy(key).agg(F.min_by(F.struct(*[F.col(f"p_{c}").alias(f"{c}_error") for c in fields]), h).alias("e"))
    return best.select(key, "e.*")


def neighbour_error(records: DataFrame, column: str, edges: DataFrame, key: str = "object_ID", seed: int = 42) -> DataFrame:
    """(key, <column>_error): a neighbouring culture or place by hash, sharing no word with the own one and leaving no choice."""
    found = records.select(key, column).join(edges.select(F.col("a").alias(column), "b"), column).where(~similar_loose(F.col(column), F.col("b")) & ~ambiguous(F.col("b")))
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), "b", F.lit(str(seed))))
    return found.groupBy(key).agg(F.min_by("b", h).alias(f"{column}_error"))


def image_error(records: DataFrame, pool: DataFrame, on: str, key: str = "object_ID", seed: int = 42) -> DataFrame:
    """(key, image_error, image_object_id_error): another record's image of the same artist or object, by hash."""
    p = pool.select(F.col(on), F.col(key).alias("p_key"), F.col("image_url").alias("p_image"), F.col("title").alias("p_title"))
    found = records.join(p, on).where((F.col(key) != F.col("p_key")) & (F.col("image_url") != F.col("p_image")) & (F.col("title") != F.col("p_title")))
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("p_key").cast("string"), F.lit(str(seed))))
    return found.groupBy(key).agg(F.min_by(F.struct(F.col("p_image").alias("image_error"), F.col("p_key").cast("string").alias("image_object_id_error")), h).alias("e")).select(key, "e.*")


SWAP_COLUMNS = {
    "artist": ("artist_name", "artist_role", "artist_nationality", "artist_date_begin", "artist_date_end"),
    "image": ("image_url",),
    "culture": ("culture", "location"),
}


def swap(df: DataFrame, pairs: DataFrame, kind: str, key: str = "object_ID", columns: tuple[str, ...] | None = None) -> DataFrame:
    """(key, partner, <c>_error ...): each paired row with its partner's values; artist swaps also carry the name into title and description.

    Swapping twice gives the original values.
    """
    columns = columns or SWAP_COLUMNS[kind]
    both = pairs.select(F.col("id_a").alias(key), F.col("id_b").alias("partner")).unionByName(pairs.select(F.col("id_b").alias(key), F.col("id_a").alias("partner")))
    theirs = df.select(F.col(key).alias("partner"), *[F.col(c).alias(f"{c}_error") for c in columns])
    out = both.join(theirs, "partner")
    if kind == "artist" and {"title", "description"} <= set(df.columns):
        out = out.join(df.select(key, "artist_name", "title", "description"), key)
        out = out.withColumns({f"{c}_error": propagate(F.col(c), F.col("artist_name"), F.col("artist_name_error")) for c in ("title", "description")}).drop("artist_name", "title", "description")
    if kind == "image":
        out = out.withColumn("image_object_id_error", F.col("partner").cast("string"))
    return out


def shadows(df: DataFrame, errors: DataFrame, error_type: str, subtype: str, key: str = "object_ID") -> DataFrame:
    """df with the errors' shadow columns, error_type and error_subtype set for the rows that have one; clean rows keep nulls."""
    new = [c for c in errors.columns if c.endswith("_error")]
    out = df.join(errors.select(key, *new, F.lit(True).alias("__hit")), key, "left")
    return out.withColumn("error_type", F.when(F.col("__hit"), error_type)).withColumn("error_subtype", F.when(F.col("__hit"), subtype)).drop("__hit")


def null_base_where_null(df: DataFrame, c: str) -> Column:
    """A culture's or location's base value, nulled where its swapped value is null although the row has an error."""
    return F.when(F.col("error_type").isin("culture", "place") & F.col(f"{c}_error").isNull(), F.lit(None).cast("string")).otherwise(F.col(c))


def take_quota(candidates: DataFrame, subtype: str, key: str, quotas: dict[str, int], seed: int = 42, cut=None) -> DataFrame:
    """Of oversampled successes, as many of each subtype as its quota asks for: no refill loop is needed."""
    table = F.create_map(*[F.lit(x) for k, v in sorted(quotas.items()) for x in (k, v)])
    take = candidates.select(subtype).distinct().withColumn("n", F.coalesce(F.try_element_at(table, F.col(subtype)), F.lit(0)))
    return first_of_each(candidates, [subtype], F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key, take, cut=cut)


def is_nullish(c: str) -> Column:
    return nullish(F.col(c))
