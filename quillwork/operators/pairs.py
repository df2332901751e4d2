"""Swap pairs: neighbours in a sorted group, positional zips, vector neighbours, disjoint matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import similar_loose
from .ordered import next_rows


def clean(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))


def eligibility(df: DataFrame) -> DataFrame:
    """One flag a subtype and id: what errors a record can carry."""
    from ..functions.text import anonymous

    dims = F.lower(F.coalesce(F.col("dimensions").cast("string"), F.lit("")))
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    dated = F.col("date_begin").cast("string").try_cast("int").isNotNull()
    return df.select(
        "object_ID",
        (anonymous(F.col("artist_name")) & dated).alias("century_shift"),
        (dims.contains("height") & dims.contains("width")).alias("aspect_swap"),
        dims.contains("value").alias("scale_error"),
        some("materials").alias("material_anachronism"), some("materials").alias("material_interchange"),
        some("techniques").alias("technique_anachronism"), some("techniques").alias("technique_interchange"),
    )


def adjacent_pairs(df: DataFrame, equal: list[str], order: list[str], key: str, where: Column | None = None, columns: list[str] = (), cut=None) -> DataFrame:
    """(id_a, id_b) of rows that follow each other in the order within equal keys and meet a condition on c and next_c.

    Neighbours are those of one global order, by the equal keys first, so a key that many rows share is spread over
    tasks. Null keys equal each other. cut: see ordered.next_rows.
    """
    wanted = [key, *dict.fromkeys(c for c in (*equal, *order, *columns) if c != key)]
    rows = df.select(*dict.fromkeys([*equal, *order, *wanted]))
    out = next_rows(rows, list(dict.fromkeys([*equal, *order, key])), wanted, cut).where(F.col(f"next_{key}").isNotNull())
    for c in equal:
        out = out.where(F.col(c).eqNullSafe(F.col(f"next_{c}")))
    out = out.where(where) if where is not None else out
    return out.select(F.col(key).alias("id_a"), F.col(f"next_{key}").alias("id_b"))


def artist_tier(df: DataFrame, tier: int, years: int = 50, seed: int = 42) -> DataFrame:
    """Artist swap pairs of rows (id, object, technique, nationality, artist, year) by tier, 4 the hardest.

    4: same object, technique and nationality; 3: same object and technique, other nationality; 2: same
    object; each with another artist and at most so many years apart. 1: shuffled, another artist.
    """
    other = F.col("artist") != F.col("next_artist")
    close = F.abs(F.col("year") - F.col("next_year")) <= years
    if tier == 4:
        return adjacent_pairs(df, ["object", "technique", "nationality"], ["year"], "id", other & close, ["artist"])
    if tier == 3:
        return adjacent_pairs(df, ["object", "technique"], ["year"], "id", other & close & (F.col("nationality") != F.col("next_nationality")), ["artist", "nationality"])
    if tier == 2:
        return adjacent_pairs(df, ["object"], ["year"], "id", other & close, ["artist"])
    return shuffled_pairs(df, "id", "artist", seed)


def image_tier(df: DataFrame, tier: int, seed: int = 42) -> DataFrame:
    """Image swap pairs of rows (id, artist, object, title, image): 3 same artist, 2 same object, each with another image and title; 1 shuffled, another object and title."""
    differ = lambda *cs: F.reduce(F.array(*[F.col(c) != F.col(f"next_{c}") for c in cs]), F.lit(True), lambda a, b: a & b)
    if tier == 3:
        return adjacent_pairs(df, ["artist"], ["image"], "id", differ("image", "title"), ["title"])
    if tier == 2:
        return adjacent_pairs(df, ["object"], ["image"], "id", differ("image", "title"), ["title"])
    return shuffled_pairs(df, "id", "object", seed, also=["title"])


def shuffled_pairs(df: DataFrame, key: str, differ: str, seed: int = 42, also: list[str] = (), cut=None) -> DataFrame:
    """(id_a, id_b) of neighbours in one order by hash over all rows whose values differ."""
    wide = df.withColumn("h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    cond = F.col(differ) != F.col(f"next_{differ}")
    for c in also:
        cond = cond & (F.col(c) != F.col(f"next_{c}"))
    return adjacent_pairs(wide, [], ["h"], key, cond, [differ, *also], cut)


def zip_pairs(rows: DataFrame, edges: DataFrame, key: str, group: str, most: int = 1000, name: bool = True) -> DataFrame:
    """(a, b, id_a, id_b): the k-th row of one group with the k-th of a neighbouring one, k up to `most` (the operator's own limit).

    edges holds (a, b); names that resemble each other are skipped.
    """
    ranked = rows.where(F.col(group).isNotNull()).withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("rn") <= most).select(F.col(group).alias("g"), F.col(key).alias("k"), "rn")
    kept = edges.where(~similar_loose(F.col("a").cast("string"), F.col("b").cast("string"))) if name else edges
    left = kept.join(ranked.select(F.col("g").alias("a"), F.col("k").alias("id_a"), "rn"), "a")
    return left.join(ranked.select(F.col("g").alias("b"), F.col("k").alias("id_b"), "rn"), ["b", "rn"]).select("a", "b", "id_a", "id_b")


def continent_pairs(primary: DataFrame) -> DataFrame:
    """(a, b), a before b, of cultures with the same primary continent."""
    return primary.alias("x").join(primary.alias("y"), "continent").where(F.col("x.culture") < F.col("y.culture")).select(F.col("x.culture").alias("a"), F.col("y.culture").alias("b"))


def _first_two(ends: DataFrame) -> DataFrame:
    """id, first, second: each id's best edge and the one after it, by two minima; no id's edges are ranked in one group."""
    first = ends.groupBy("id").agg(F.min("edge").alias("first"))
    second = ends.join(first, "id").where(F.col("edge") != F.col("first")).groupBy("id").agg(F.min("edge").alias("second"))
    return first.join(second, "id", "left")


def _settled(rest: DataFrame, cut) -> DataFrame:
    """Edges of `rest` (edge) that are surely taken.

    An edge that is first at both ends is taken. One that is first at an end and second at the other hangs on a single
    edge, the other end's first: it is taken just if that one isn't. So such edges form chains, however long; pointer
    jumping settles them in as many rounds as their length has binary digits, with the parity of the steps.
    """
    ends = rest.select(F.explode(F.array("edge.id_a", "edge.id_b")).alias("id"), "edge")
    two = cut(_first_two(ends))
    firsts = two.select(F.col("first").alias("edge"), F.col("id").alias("at")).groupBy("edge").agg(F.count("*").alias("n"))
    taken = firsts.where("n = 2").select("edge", F.lit(None).cast(rest.schema["edge"].dataType).alias("on"), F.lit(0).alias("odd"))
    hanging = two.where("second is not null").select(F.col("second").alias("edge"), F.col("first").alias("on"))
    hanging = hanging.join(firsts.where("n = 1").select("edge"), "edge", "left_semi").select("edge", "on", F.lit(1).alias("odd"))
    now = cut(taken.unionByName(hanging))
    while True:
        step = now.select(F.col("edge").alias("on"), F.col("on").alias("further"), F.col("odd").alias("more"), F.lit(True).alias("known"))
        after = now.join(step, "on", "left").select("edge", F.when(F.col("known"), F.col("further")).otherwise(F.col("on")).alias("on"), (F.col("odd") + F.coalesce("more", F.lit(0))).alias("odd"), (F.coalesce("known", F.lit(False)) & F.col("further").isNotNull()).alias("moved"))
        now = cut(after.withColumn("odd", F.col("odd") % 2))
        if now.where("moved").isEmpty():
            # chains that end at an edge which is neither wait for a later round
            return now.where(F.col("on").isNull() & (F.col("odd") == 0)).select("edge")
        now = now.drop("moved")


def disjoint_matching(edges: DataFrame, checkpoint=None, most_rounds: int | None = None) -> DataFrame:
    """Edges (id_a, id_b, score) such that every id is used once: the result of taking edges by (score desc, id_a, id_b).

    Each round takes the edges that are surely taken (_settled) and drops all that touch them. checkpoint is
    how a round's rest is cut from its lineage; by default DataFrame.checkpoint. Every round takes an edge at least,
    so the rounds end; if more than most_rounds are needed, it is an error. Edges from an id to itself go, of repeated
    ones the best score counts, null ids or scores are no edges.
    """
    cut = checkpoint or (lambda df: df.checkpoint())
    both = edges.where("id_a <> id_b and score is not null").groupBy(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).agg(F.max("score").alias("score"))
    rest = cut(both.select(F.struct((-F.col("score")).alias("s"), "id_a", "id_b").alias("edge")))
    out, rounds = None, 0
    while not rest.isEmpty():
        if rounds == most_rounds:
            raise RuntimeError("disjoint_matching did not settle")
        rounds += 1
        won = cut(_settled(rest, cut))
        out = won if out is None else cut(out.unionByName(won)) if rounds % 8 == 0 else out.unionByName(won)
        used = won.select(F.explode(F.array("edge.id_a", "edge.id_b")).alias("id"))
        for end in ("id_a", "id_b"):
            rest = rest.join(used, F.col(f"edge.{end}") == F.col("id"), "left_anti")
        rest = cut(rest)
    return (rest if out is None else out).select("edge.id_a", "edge.id_b", (-F.col("edge.s")).alias("score"))
