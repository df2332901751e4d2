"""Quality reports: completeness, success rates, coverage of mappings, hits by pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(c: str) -> Column:
    """Whether a value is there and not only blanks."""
    return F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, filled, total, pct) for every column, in one pass."""
    columns = columns or df.columns
    row = df.agg(F.count("*").alias("total"), *[F.count_if(filled(c)).alias(f"f{k}") for k, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"f{k}").alias("filled")) for k, c in enumerate(columns)])
    out = row.select("total", F.explode(pairs).alias("p")).select("p.column", "p.filled", "total")
    return out.withColumn("pct", F.round(F.coalesce(F.try_divide(F.col("filled") * 100.0, F.col("total")), F.lit(0.0)), 2))


def cells_by_group(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, rows, filled, missing) cells of the columns by group and in all (group null), most missing first."""
    n = sum((filled(c).cast("long") for c in columns), F.lit(0).cast("long"))
    counted = df.withColumn("n", n).rollup(group).agg(F.count("*").alias("rows"), F.sum("n").alias("filled"))
    return counted.withColumn("missing", F.col("rows") * len(columns) - F.col("filled")).orderBy(F.desc("missing"), group)


def run_counters(df: DataFrame, reason: str = "skip_reason") -> DataFrame:
    """How many rows each reason turned away; null is what was collected."""
    return df.groupBy(reason).agg(F.count("*").alias("n"))


def success_rollup(df: DataFrame, by: str, attempts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Attempted and successful rows of each attribute by group and in all: (by, attribute, attempted, success, ratio)."""
    aggs = [x for k, (tried, won) in attempts.items() for x in (F.count_if(tried).alias(f"{k}_a"), F.count_if(tried & won).alias(f"{k}_s"))]
    wide = df.rollup(by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(k).alias("attribute"), F.col(f"{k}_a").alias("attempted"), F.col(f"{k}_s").alias("success")) for k in attempts])
    out = wide.select(by, F.explode(rows).alias("r")).select(by, "r.*")
    return out.withColumn("ratio", F.round(F.coalesce(F.try_divide(F.col("success"), F.col("attempted")), F.lit(0.0)), 4))


def mapping_coverage(df: DataFrame, by: str, before: Column, after: Column) -> DataFrame:
    """(by, total, both_n, coverage, changed): shares in percent, rounded to 1, of rows with both values and of changes among them."""
    both = before.isNotNull() & after.isNotNull()
    differs = both & (F.lower(F.trim(before)) != F.lower(F.trim(after)))
    counted = df.groupBy(by).agg(F.count("*").alias("total"), F.count_if(both).alias("both_n"), F.count_if(differs).alias("differs"))
    pct = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a) * 100.0, F.col(b)), F.lit(0.0)), 1)
    return counted.select(by, "total", "both_n", pct("both_n", "total").alias("coverage"), pct("differs", "both_n").alias("changed"))


def mean_over_files(coverage: DataFrame) -> DataFrame:
    """The unweighted mean over files."""
    return coverage.agg(F.round(F.avg("coverage"), 2).alias("coverage"), F.round(F.avg("changed"), 2).alias("changed"))


def non_null_counts(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.count(c).alias(c) for c in columns])


def pattern_hits(df: DataFrame, pattern: str = "pattern_name") -> DataFrame:
    """(pattern, n, rate): hits by pattern, null for no match, rate in percent of all rows."""
    from pyspark.sql.window import Window

    counted = df.groupBy(pattern).agg(F.count("*").alias("n"))
    return counted.withColumn("rate", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2))


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("subtype").agg(F.count("*").alias("n"))


def error_share(test: DataFrame) -> DataFrame:
    return test.agg(F.count("*").alias("rows"), F.count("error_type").alias("errors"), F.round(F.coalesce(F.try_divide(F.count("error_type") * 100.0, F.count("*")), F.lit(0.0)), 2).alias("pct"))
