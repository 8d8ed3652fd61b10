"""Label dictionaries, confusion tables and the metrics derived from them.

Everything starts from one pre-aggregated table (``split_cells`` for the rule-based predictors, the
confusion table for models) whose size depends on the number of classes and groups, not on the rows. The
branches below keep its grouping keys and filter inside aggregates, so their shuffles are the same and Spark
runs the pass over the rows once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.operators.split import in_train

Labels = Sequence[str] | DataFrame


def split_cells(
    df: DataFrame, by: Iterable[str], key: str = "A_INCIDENT_ID", train: float = 0.8
) -> DataFrame:
    """Row counts by group, label and part of the split: the one pass over the incidents."""
    return df.groupBy(*by, "INCIDENT_TYPE", in_train(F.col(key), train).alias("is_train")).agg(
        F.count("*").alias("n")
    )


def cell_counts(cells: DataFrame) -> DataFrame:
    """Rows read, processed, for training and for testing, from cells that were also split by ``VALID``."""

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    valid, train = F.col("VALID"), F.col("is_train")
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_total"),
        rows(valid).alias("records_processed"),
        rows(valid & train).alias("train_rows"),
        rows(valid & ~train).alias("test_rows"),
    )


def label_dictionary(cells: DataFrame) -> DataFrame:
    """Training labels, numbered by frequency and then by name.

    The unpartitioned window ranks one row per label.
    """
    order = Window.orderBy(F.desc("count"), "INCIDENT_TYPE")
    return (
        cells.groupBy("INCIDENT_TYPE")
        .agg(F.sum(F.when(F.col("is_train"), F.col("n"))).alias("count"))
        .filter((F.col("count") > 0) & F.col("INCIDENT_TYPE").isNotNull())
        .select((F.row_number().over(order) - 1).cast("double").alias("label"), "INCIDENT_TYPE", "count")
    )


def category_index(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Index of each value of each column by frequency and then by value, nulls left out.

    Combinations are counted first; the columns are then taken apart on that small table.
    """
    columns = list(columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    order = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("n"))
        .select(F.inline(pairs), "n")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("n").alias("count"))
        .withColumn("idx", (F.row_number().over(order) - 1).cast("double"))
    )


def majority_predictions(cells: DataFrame, by: Iterable[str]) -> DataFrame:
    """Predict the most frequent training label of the group for the test rows: label, prediction, n.

    Ties go to the first name; a group not in the training part gets the overall most frequent label.
    The window gathers one row per label of a group.
    """
    by = list(by)
    n_train = F.sum(F.when(F.col("is_train"), F.col("n")).otherwise(0))
    n_test = F.sum(F.when(~F.col("is_train"), F.col("n")).otherwise(0))
    groups = cells.groupBy(*by, "INCIDENT_TYPE").agg(n_train.alias("n_train"), n_test.alias("n_test"))
    rank = F.when(F.col("n_train") > 0, F.struct((-F.col("n_train")).alias("k"), F.col("INCIDENT_TYPE").alias("v")))
    overall = (
        cells.groupBy("INCIDENT_TYPE")
        .agg(n_train.alias("n_train"))
        .agg(F.min(rank)["v"].alias("v"))
        .scalar()
    )
    return (
        groups.withColumn("best", F.min(rank).over(Window.partitionBy(*by)))
        .filter(F.col("n_test") > 0)
        .select(
            F.col("INCIDENT_TYPE").alias("label"),
            F.coalesce(F.col("best.v"), overall).alias("prediction"),
            F.col("n_test").alias("n"),
        )
    )


def _names(labels: Labels) -> Column:
    """Class index -> name as a map; one entry per label."""
    if isinstance(labels, DataFrame):
        entries = F.collect_list(F.struct("label", "INCIDENT_TYPE"))
        return labels.agg(F.map_from_entries(entries)).scalar()
    return F.create_map(*[x for i, name in enumerate(labels) for x in (F.lit(float(i)), F.lit(name))])


def name_to_index(preds: DataFrame, labels: DataFrame) -> DataFrame:
    """Label and prediction names to class indexes; rows with a label not in the dictionary are dropped."""
    entries = F.collect_list(F.struct("INCIDENT_TYPE", "label"))
    index = labels.agg(F.map_from_entries(entries)).scalar()
    return preds.withColumns(
        {c: F.try_element_at(index, F.col(c)) for c in ("label", "prediction")}
    ).filter(F.col("label").isNotNull())


def index_to_name(confusion: DataFrame, labels: Labels) -> DataFrame:
    """Class names for the indexes; an unknown index shows as its number."""
    names = _names(labels)

    def named(c: str) -> Column:
        return F.coalesce(F.try_element_at(names, F.col(c)), F.col(c).cast("int").cast("string"))

    return confusion.select(named("label").alias("true_label"), named("prediction").alias("pred_label"), "count")


def confusion(preds: DataFrame, weight: str | None = None, also: str | None = None) -> DataFrame:
    """Non-empty confusion cells. ``weight`` names the row count when the input is already aggregated.

    ``also`` names a column that is summed up beside the count, such as the weight of a row (``reweighted``).
    """
    count = F.count("*") if weight is None else F.sum(weight)
    more = [F.sum(also).alias(also)] if also else []
    return preds.groupBy("label", "prediction").agg(count.alias("count"), *more)


def reweighted(cells: DataFrame, weight: str = "weight") -> DataFrame:
    """Confusion cells that count the sum of the weights of their rows instead of the rows."""
    return cells.select("label", "prediction", F.col(weight).cast("double").alias("count"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _class_totals(cells: DataFrame) -> DataFrame:
    """Each confusion cell once for its true and once for its predicted class."""
    count = F.col("count")
    zero = F.lit(0).cast(cells.schema["count"].dataType)
    hit = F.when(F.col("label") == F.col("prediction"), count).otherwise(zero)
    return cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("label"), count.alias("actual"), zero.alias("predicted"), hit.alias("tp")),
                F.struct(F.col("prediction").alias("label"), zero.alias("actual"), count.alias("predicted"), zero.alias("tp")),
            )
        )
    )


def _with_scores(totals: DataFrame) -> DataFrame:
    precision, recall = F.col("precision"), F.col("recall")
    return totals.withColumns(
        {"precision": _ratio(F.col("tp"), F.col("predicted")), "recall": _ratio(F.col("tp"), F.col("actual"))}
    ).withColumn("f1", _ratio(2 * precision * recall, precision + recall))


def per_class_metrics(cells: DataFrame, labels: Labels) -> DataFrame:
    """Support, precision, recall and F1 of every label of the dictionary, by class index."""
    zero = F.lit(0).cast(cells.schema["count"].dataType)
    if isinstance(labels, DataFrame):
        rows = labels.select("label", F.col("INCIDENT_TYPE").alias("class"))
    else:
        entries = [F.struct(F.lit(float(i)).alias("label"), F.lit(n).alias("class")) for i, n in enumerate(labels)]
        rows = cells.sparkSession.range(1).select(F.inline(F.array(*entries)))
    rows = rows.withColumns({"actual": zero, "predicted": zero, "tp": zero})
    totals = (
        _class_totals(cells)
        .withColumn("class", F.lit(None).cast("string"))
        .unionByName(rows)
        .groupBy("label")
        .agg(F.max("class").alias("class"), *[F.sum(c).alias(c) for c in ("actual", "predicted", "tp")])
        .filter(F.col("class").isNotNull())
    )
    return (
        _with_scores(totals)
        .orderBy("label")
        .select("class", F.col("actual").alias("support"), *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])
    )


def global_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1 as one row, from the confusion table alone."""
    totals = (
        _class_totals(cells).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "tp")])
    )
    return _with_scores(totals).agg(
        F.sum("actual").alias("scored_rows"),
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        (F.sum(F.col("actual") * F.col("f1")) / F.sum("actual")).alias("f1"),
    )


def accuracy(preds: DataFrame, weight: str | None = None) -> DataFrame:
    return global_metrics(confusion(preds, weight)).select("accuracy")


def weighted_f1(preds: DataFrame, weight: str | None = None) -> DataFrame:
    return global_metrics(confusion(preds, weight)).select("f1")


class Evaluation(NamedTuple):
    confusion: DataFrame
    named: DataFrame
    per_class: DataFrame
    overall: DataFrame

    def as_table(self) -> DataFrame:
        """All metrics in one table: scope (class name or "all"), metric, value."""
        classes = self.per_class.withColumn("support", F.col("support").cast("double")).unpivot(
            "class", ["support", "precision", "recall", "f1"], "metric", "value"
        )
        overall = self.overall.select(
            F.lit("all").alias("class"),
            F.col("scored_rows").cast("double").alias("support"),
            F.round("accuracy", 6).alias("accuracy"),
            F.round("f1", 6).alias("f1"),
        ).unpivot("class", ["support", "accuracy", "f1"], "metric", "value")
        return classes.unionByName(overall)


def evaluate(preds: DataFrame, labels: Labels, weight: str | None = None) -> Evaluation:
    """Confusion, named confusion, per-class and overall metrics; the scored rows are aggregated once."""
    cells = confusion(preds, weight)
    return Evaluation(cells, index_to_name(cells, labels), per_class_metrics(cells, labels), global_metrics(cells))
