"""Knowledge tables: timelines, regional shares, co-occurrence, entity profiles, adjacency.

Inputs are long tables (record, term, ...); outputs stay relational. Ties are broken by value, never by the
order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def mean_year(begin: Column, end: Column, begin_bce: Column, end_bce: Column) -> Column:
    """The signed mean of both ends; null if one is no number."""
    side = lambda y, f: F.when(F.coalesce(f, F.lit(False)), -y.cast("string").try_cast("double")).otherwise(y.cast("string").try_cast("double"))
    return (side(begin, begin_bce) + side(end, end_bce)) / 2.0


def timelines(df: DataFrame, term: str, year: str, least: int = 10, shares: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """(term, start, end, n): exact 1st and 99th percentiles of the years, truncated, for terms with enough of them."""
    kept = df.where(F.col(term).isNotNull() & F.col(year).isNotNull())
    q = kept.groupBy(term).agg(F.percentile(year, F.array(*map(F.lit, shares))).alias("q"), F.count("*").alias("n")).where(F.col("n") >= least)
    return q.select(F.col(term).alias("term"), F.col("q")[0].cast("int").alias("start_year"), F.col("q")[1].cast("int").alias("end_year"), "n")


def regional_share(df: DataFrame, term: str, region: str, least: int = 10, until: float = 90.0) -> DataFrame:
    """(term, region, n, pct): regions by descending count until their summed rounded share passes the limit, the crossing row included."""
    counts = df.where(F.col(term).isNotNull() & F.col(region).isNotNull()).groupBy(F.col(term).alias("term"), F.col(region).alias("region")).agg(F.count("*").alias("n"))
    total = Window.partitionBy("term")
    ordered = Window.partitionBy("term").orderBy(F.desc("n"), "region").rowsBetween(Window.unboundedPreceding, -1)
    shares = counts.withColumn("total", F.sum("n").over(total)).where(F.col("total") >= least).withColumn("pct", F.round(F.col("n") * 100.0 / F.col("total"), 1))
    return shares.withColumn("before", F.coalesce(F.sum("pct").over(ordered), F.lit(0.0))).where(F.round("before", 1) <= until).select("term", "region", "n", "pct")


def cooccurrence(df: DataFrame, record: str, term: str, least_total: int = 10, least_pair: int = 2) -> DataFrame:
    """(term, neighbour, n, probability) of terms in the same record, both ways; totals count repeats, pairs count records."""
    totals = df.where(F.col(term).isNotNull()).groupBy(F.col(term).alias("term")).agg(F.count("*").alias("total")).where(F.col("total") >= least_total)
    terms = df.where(F.col(term).isNotNull()).groupBy(F.col(record).alias("r")).agg(F.array_sort(F.collect_set(term)).alias("ts")).where(F.size("ts") > 1)
    pair = F.flatten(F.transform("ts", lambda a: F.transform(F.filter("ts", lambda b: b != a), lambda b: F.struct(a.alias("term"), b.alias("neighbour")))))
    pairs = terms.select(F.explode(pair).alias("p")).groupBy("p.term", "p.neighbour").agg(F.count("*").alias("n")).where(F.col("n") >= least_pair)
    return pairs.join(totals, "term").select("term", "neighbour", "n", F.round(F.col("n") / F.col("total"), 4).alias("probability"))


def cross_cooccurrence(df: DataFrame, left: str, right: str, least_row: int = 10, least_cell: int = 2) -> DataFrame:
    """(term, neighbour, n, probability) of two kinds of terms in the same row; missing terms are not counted."""
    cells = df.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(F.col(left).alias("term"), F.col(right).alias("neighbour")).agg(F.count("*").alias("n"))
    rows = cells.withColumn("total", F.sum("n").over(Window.partitionBy("term")))
    return rows.where((F.col("total") >= least_row) & (F.col("n") >= least_cell)).select("term", "neighbour", "n", F.round(F.col("n") / F.col("total"), 4).alias("probability"))


def modal(df: DataFrame, key: str, value: str, least: int = 1) -> DataFrame:
    """(key, value, n): the most frequent value of each key, ties to the smallest value."""
    counts = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("b"))
    return best.select(key, F.col("b.v").alias(value), (-F.col("b.m")).alias("n")).where(F.col("n") >= least)


def entity_profiles(df: DataFrame, name: str, numbers: list[str], modes: list[str], least: int = 2, skip: Column | None = None) -> DataFrame:
    """(name, n, truncated mean of each number, mode of each mode column) for names with enough rows."""
    kept = df.where(F.col(name).isNotNull())
    kept = kept.where(~skip) if skip is not None else kept
    out = kept.groupBy(name).agg(F.count("*").alias("n"), *[F.avg(c).cast("int").alias(c) for c in numbers]).where(F.col("n") >= least)
    for c in modes:
        out = out.join(modal(kept, name, c).drop("n"), name, "left")
    return out


def era_clusters(profiles: DataFrame, name: str, year: str, kind: str, width: int = 50) -> DataFrame:
    """(cluster, names): sorted names that share an era of so many years and a kind, where there is more than one."""
    key = F.concat_ws("_", (F.floor(F.col(year) / width) * width).cast("string"), F.col(kind))
    return profiles.where(F.col(year).isNotNull() & F.col(kind).isNotNull()).groupBy(key.alias("cluster")).agg(F.array_sort(F.collect_set(name)).alias("names")).where(F.size("names") > 1)


def significant_values(df: DataFrame, key: str, value: str, least_rows: int = 10, least: int = 2, share: float = 0.05) -> DataFrame:
    """(key, value, n): values with a count and a share of the key's rows that matter; keys that name a choice are left out."""
    rows = df.where(F.col(key).isNotNull() & ~F.col(key).cast("string").contains(" or "))
    counts = rows.groupBy(key, value).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(key)))
    return counts.where(F.col(value).isNotNull() & (F.col("total") >= least_rows) & (F.col("n") >= least) & (F.col("n") >= F.col("total") * share)).select(key, value, "n")


def jaccard_adjacency(sets: DataFrame, key: str, items: str, above: float = 0.5) -> DataFrame:
    """(a, b, jaccard), both ways, of keys whose item sets are more alike than the limit. Keys that share no item are never paired.

    Items are ordered by the number of sets that hold them, rare ones first. Two sets that are alike enough share
    one of their first size - ceil(limit * size) + 1 items, and their sizes are within the limit of each other; only
    such pairs are formed, each once, and verified on the whole sets. So the items that most sets hold pair nothing.
    Keys are unique; null items count in a set's size and are shared by none.
    """
    own = sets.select(F.col(key).alias("k"), F.array_distinct(items).alias("items")).withColumn("size", F.size("items"))
    long = own.select("k", "size", F.explode(F.array_compact("items")).alias("i"))
    ranked = long.join(long.groupBy("i").agg(F.count("*").alias("held")), "i")
    prefix = F.col("size") - F.ceil(F.lit(above) * F.col("size") - 1e-9).cast("int") + 1
    firsts = ranked.groupBy("k", "size").agg(F.array_sort(F.collect_list(F.struct("held", "i"))).alias("order")).select("k", "size", F.explode(F.slice("order", F.lit(1), F.greatest(prefix, F.lit(0))))).select("k", "size", "col.i")
    x, y = firsts.alias("x"), firsts.alias("y")
    sized = (F.col("x.size") >= F.col("y.size") * above) & (F.col("y.size") >= F.col("x.size") * above)
    pairs = x.join(y, (F.col("x.i") == F.col("y.i")) & (F.col("x.k") < F.col("y.k")) & sized).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
    side = lambda n: own.select(F.col("k").alias(n), F.array_compact("items").alias(f"i{n}"), F.col("size").alias(f"s{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("both", F.size(F.array_intersect("ia", "ib")))
    scored = both.withColumn("jaccard", F.col("both") / (F.col("sa") + F.col("sb") - F.col("both"))).where(F.col("jaccard") > above)
    return scored.select(F.explode(F.array(F.struct("a", "b", "jaccard"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))).alias("p")).select("p.*")


def culture_adjacency(cultures: DataFrame, above: float = 0.5) -> DataFrame:
    """(a, b), both ways, of rows (culture, countries, continents, eras, materials) that share a country, or a continent and an era with like materials.

    The table has one row a culture, a few hundred at most; candidates share a country or a continent.
    """
    places = cultures.select("culture", F.explode(F.array_union(F.transform("countries", lambda c: F.concat(F.lit("c:"), c)), F.transform("continents", lambda c: F.concat(F.lit("k:"), c)))).alias("place"))
    pairs = places.alias("x").join(places.alias("y"), "place").where(F.col("x.culture") < F.col("y.culture")).select(F.col("x.culture").alias("a"), F.col("y.culture").alias("b")).distinct()
    side = lambda s: cultures.select(*[F.col(c).alias(s if c == "culture" else f"{c}_{s}") for c in ("culture", "countries", "continents", "eras", "materials")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    like = F.coalesce(F.try_divide(F.size(F.array_intersect("materials_a", "materials_b")), F.size(F.array_union("materials_a", "materials_b"))), F.lit(0.0)) > above
    kept = both.where(F.arrays_overlap("countries_a", "countries_b") | (F.arrays_overlap("continents_a", "continents_b") & F.arrays_overlap("eras_a", "eras_b") & like))
    return kept.select("a", "b").unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))


def primary_continent(cultures: DataFrame) -> DataFrame:
    """The alphabetically first continent of each culture."""
    return cultures.select("culture", F.array_min("continents").alias("continent")).where("continent is not null")


def siblings(df: DataFrame, child: str, parent: str) -> DataFrame:
    """(a, b): all ordered pairs of different children of one parent."""
    kids = df.select(F.col(child).alias("k"), F.col(parent).alias("p")).where("p is not null").distinct()
    return kids.alias("x").join(kids.alias("y"), "p").where(F.col("x.k") != F.col("y.k")).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))


def export_json(table: DataFrame, key: str, value: Column) -> DataFrame:
    """One JSON object text a key, for export: (key, json)."""
    return table.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(value))).alias("json"))
