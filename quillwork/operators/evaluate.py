"""Evaluation: effective values, ground truth, confusion metrics, multi-pass audits, features and label issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GROUND_TRUTH_COLUMNS = ("date_begin_error", "materials_error", "techniques_error", "dimensions_json_error", "culture_error", "location_error", "artist_name_error", "image_error", "image_object_id_error")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; of rows alike in order the one whose values sort last."""
    rest = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("r"))
    return last.select(key, *[F.col(f"r.{c}") for c in rest])


def merge_checkpoint(rows: DataFrame, checkpoint: DataFrame, key: str, order: str) -> DataFrame:
    """rows with the newest checkpoint entry of their key."""
    return rows.join(latest_per_key(checkpoint, key, order), key, "left")


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows that are still to be done."""
    return rows.join(done.select(key), key, "left_anti")


def ground_truth(columns: list[str] | None = None) -> Column:
    """Whether a row is an error: its type is set, or any of the shadow columns given."""
    if columns is None:
        return F.col("error_type").isNotNull()
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNotNull()
    return out


def confusion(df: DataFrame, truth: Column, predicted: Column, by: list[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 and accuracy, by groups on demand; divisions by zero give 0; digits rounded to 6."""
    t, p = F.coalesce(truth, F.lit(False)), F.coalesce(predicted, F.lit(False))
    counts = [F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn")]
    out = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)
    ratio = lambda a, b: F.coalesce(F.try_divide(a * 1.0, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return out.withColumns({"precision": F.round(precision, 6), "recall": F.round(recall, 6), "f1": F.round(ratio(2 * tp, 2 * tp + fp + fn), 6), "accuracy": F.round(ratio(tp + tn, tp + fp + fn + tn), 6)})


def recall_by(df: DataFrame, by: str, truth: Column, predicted: Column) -> DataFrame:
    """(by, support, hits, recall) over the rows that are errors."""
    out = df.where(truth).groupBy(by).agg(F.count("*").alias("support"), F.count_if(F.coalesce(predicted, F.lit(False))).alias("hits"))
    return out.withColumn("recall", F.round(F.col("hits") / F.col("support"), 6))


def recall_by_category(df: DataFrame, categories: dict[str, list[str]], predicted: Column) -> DataFrame:
    """The same with categories that each are any of some shadow columns; a row may count in several."""
    rows = F.filter(F.array(*[F.when(ground_truth(cols), F.lit(name)) for name, cols in categories.items()]), lambda x: x.isNotNull())
    return recall_by(df.withColumn("category", F.explode(rows)), "category", F.lit(True), predicted)


def system_flag(flags: DataFrame, key: str, flag: str) -> DataFrame:
    """(key, flagged): whether any pass flagged the row; missing flags count as no."""
    return flags.groupBy(key).agg(F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias("flagged"))


def unpivot_flags(df: DataFrame, key: str, targets: list[str]) -> DataFrame:
    """Wide flags to (key, target, flag)."""
    return df.select(key, F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("flag")) for t in targets])).alias("x")).select(key, "x.*")


def one_hot(df: DataFrame, key: str, term: str, vocabulary: list[str]) -> DataFrame:
    """(key, one 0/1 column a term) from long rows; terms outside the vocabulary, which comes from training rows, are ignored."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(term) == t, 1).otherwise(0)).alias(t) for t in vocabulary])


def vocabulary_of(train: DataFrame, term: str) -> list[str]:
    return [r[0] for r in train.where(F.col(term).isNotNull()).select(term).distinct().orderBy(term).collect()]


def drop_rare(train: DataFrame, label: str, least: int = 5) -> DataFrame:
    """Training rows whose class has enough of them."""
    return train.join(train.groupBy(label).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(label), label, "left_semi")


def drop_unseen(test: DataFrame, train: DataFrame, label: str) -> DataFrame:
    return test.join(train.select(label).distinct(), label, "left_semi")


def feature_columns(columns: list[str], target: str, leaks: dict[str, tuple[str, ...]] | None = None) -> list[str]:
    """Columns that may predict the target: not the target, its shadow, the truth, an id, or what gives it away."""
    leaks = leaks or {"culture": ("location",), "location": ("culture",), "artist_name": ("artist_nationality", "artist_role", "artist_date_begin", "artist_date_end"), "date_begin": ("date_end", "date_begin_bce", "date_end_bce")}
    out = {target, "object_ID", "error_type", "error_subtype", "title", "description", *leaks.get(target, ())}
    return [c for c in columns if c not in out and not c.endswith("_error")]


def label_issues(df: DataFrame, key: str, label: str, probabilities: str, classes: list[str]) -> DataFrame:
    """(key, given, suggested, issue) by confident learning: a class's threshold is the mean self-confidence of the rows given it; a row is an issue if its best class is another and reaches that class's threshold."""
    table = F.create_map(*[F.lit(x) for k, c in enumerate(classes) for x in (c, k)])
    own = F.element_at(F.col(probabilities), F.try_element_at(table, F.col(label)) + 1)
    thresholds = df.groupBy(label).agg(F.avg(own).alias("t")).select(F.col(label).alias("c"), "t")
    best = F.array_max(F.transform(F.arrays_zip(F.col(probabilities).alias("p"), F.array(*map(F.lit, classes)).alias("c")), lambda x: F.struct(x["p"], x["c"])))
    scored = df.select(key, F.col(label).alias("given"), best["p"].alias("p"), best["c"].alias("suggested"))
    return scored.join(thresholds, scored["suggested"] == thresholds["c"], "left").select(key, "given", "suggested", F.coalesce((F.col("suggested") != F.col("given")) & (F.col("p") >= F.col("t")), F.lit(False)).alias("issue"))


def cross_validated_probabilities(df: DataFrame, key: str, label: str, features: str, folds: int = 5, seed: int = 42) -> tuple[DataFrame, list[str]]:
    """(key, label, probabilities) out of fold by logistic regression, and the classes in order. features is a vector column."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    classes = vocabulary_of(df, label)
    table = F.create_map(*[F.lit(x) for k, c in enumerate(classes) for x in (c, float(k))])
    fold = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long"), F.lit(folds))
    rows = df.withColumn("y", F.try_element_at(table, F.col(label))).withColumn("fold", fold)
    out = None
    for k in range(folds):
        model = LogisticRegression(featuresCol=features, labelCol="y", maxIter=50).fit(rows.where(F.col("fold") != k))
        scored = model.transform(rows.where(F.col("fold") == k)).select(key, label, vector_to_array("probability").alias("probabilities"))
        out = scored if out is None else out.unionByName(scored)
    return out, classes


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by id, ids as text."""
    return df.orderBy(key).limit(n).withColumn(key, F.col(key).cast("string"))


def proportions(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n")).withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))
