"""Global orders without a global sort in one task: the next row of all rows, the first rows of each stratum."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Cut = Callable[[DataFrame], DataFrame]


def _cutter(df: DataFrame, cut: Cut | None) -> Cut:
    from ..sources.sinks import cutter

    return cut or cutter(df.sparkSession)


def next_rows(df: DataFrame, order: list[str], wanted: list[str], cut: Cut | None = None) -> DataFrame:
    """df with next_<c> for each wanted column: its value in the row that follows in the order over all rows; null in the last.

    Rows are dealt to ranges of the order and written once with their range's number (cut: by default to the shared
    folder), so the ranges can't change between reads. A range's last row looks at a ghost of the first row of the next range
    that has any; ghosts are one row a range. The order should be unique, nulls come first. An equal key
    that a third of all rows have is cut into ranges by the columns that follow it in the order. An empty table stays empty.
    """
    held = list(dict.fromkeys([*order, *wanted]))
    ranged = _cutter(df, cut)(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    first = ranged.groupBy("__part").agg(F.min_by(F.struct(*held), F.struct(*order)).alias("first"))
    ghosts = first.select(F.lag("__part").over(Window.orderBy("__part")).alias("__part"), "first.*", F.lit(True).alias("__ghost")).where(F.col("__part").isNotNull())
    both = ranged.withColumn("__ghost", F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    w = Window.partitionBy("__part").orderBy("__ghost", *order)
    # a plain row's next is a plain row, the last one's the ghost
    return both.withColumns({f"next_{c}": F.lead(c).over(w) for c in wanted}).where(~F.col("__ghost")).drop("__part", "__ghost")


def first_of_each(df: DataFrame, strata: list[str], h: Column, key: str, take: DataFrame, digits: int = 3, cut: Cut | None = None) -> DataFrame:
    """Of each stratum the `n` rows that come first by (h, key); take has one row (strata..., n) for each stratum that gives any.

    h is a hash as hexadecimal text. Rows are counted by its first digits, and those of the group in which a stratum's
    threshold falls by the next digits. What lies before the threshold is a plain filter; only the few rows that share all
    counted digits with it are ranked. So no task sees more than its partition and one row a group of digits. Nulls in strata are strata of their own;
    df's columns are kept, `take` and the bounds are joined by strata, of which there may be many.
    """
    cut = _cutter(df, cut)
    names = [f"__s{i}" for i in range(len(strata))]
    rows = df.withColumns({"__h": h} | {n: F.col(s) for n, s in zip(names, strata, strict=True)})
    head, next_head = F.substring("__h", 1, digits), F.substring("__h", digits + 1, digits)
    # written, so that its size is known and it is broadcast only if small
    wanted = cut(take.select(*[F.col(s).alias(n) for n, s in zip(names, strata, strict=True)], F.col("n").cast("long").alias("__n")).where("__n > 0"))

    def on(a: DataFrame, b: DataFrame) -> DataFrame:
        """a joined with bounds b by strata, nulls included."""
        if not names:
            return a.join(b)
        renamed = b.select(*[F.col(n).alias(f"{n}b") for n in names], *[c for c in b.columns if c not in names])
        cond = F.lit(True)
        for n in names:
            cond = cond & F.col(n).eqNullSafe(F.col(f"{n}b"))
        return a.join(renamed, cond).drop(*[f"{n}b" for n in names])

    def threshold(some: DataFrame, prefix: Column, bounds: DataFrame, name: str) -> DataFrame:
        """bounds with the prefix in which the n-th row lies (null if there are fewer), and what is left to take within it."""
        counts = some.groupBy(*names, prefix.alias(name)).agg(F.count("*").alias("c"))
        w = Window.partitionBy(*names).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        sums = on(counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0))), bounds)
        found = sums.where((F.col("before") < F.col("__n")) & (F.col("before") + F.col("c") >= F.col("__n")))
        return found.withColumn("__n", F.col("__n") - F.col("before")).drop("before", "c")

    # strata with fewer rows than they are to give: all of them
    some = on(rows, wanted)
    one = cut(threshold(rows, head, wanted, "__p"))
    two = cut(threshold(on(rows, one).where(head == F.col("__p")).select(*names, "__h"), next_head, one, "__q"))
    bounds = two.select(*names, F.concat("__p", "__q").alias("__bound"), F.col("__n").alias("__left"))
    if names:
        marks = bounds.select(*[F.col(n).alias(f"{n}c") for n in names], "__bound", "__left")
        cond = F.lit(True)
        for n in names:
            cond = cond & F.col(n).eqNullSafe(F.col(f"{n}c"))
        some = some.join(marks, cond, "left").drop(*[f"{n}c" for n in names])
    else:
        some = some.join(bounds, F.lit(True), "left")
    own = F.substring("__h", 1, 2 * digits)
    sure = some.where(F.col("__bound").isNull() | (own < F.col("__bound")))
    edge = some.where(own == F.col("__bound")).withColumn("__rn", F.row_number().over(Window.partitionBy(*names).orderBy("__h", key))).where("__rn <= __left")
    return sure.select(df.columns).unionByName(edge.select(df.columns))
