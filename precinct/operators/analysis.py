"""Counts, sums, pivots and rankings of derived incidents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.functions import whole_number
from precinct.operators.split import in_train
from precinct.schema import FLAGS, FOCUS_LABELS, MULTIPLE, PIVOT_LABELS, RANKED_LABELS
from precinct.sources.readers import resolve_col


def _count(weight: str | None) -> Column:
    """Row count, or the sum of ``weight`` when the input is already aggregated."""
    return (F.count("*") if weight is None else F.sum(weight)).alias("count")


def row_counts(raw: DataFrame, key: str = "incident_number", train: float = 0.8) -> DataFrame:
    """Rows read, processed, for training and for testing, in one pass over the raw incidents."""
    offenses = whole_number(F.col("total_offense"), dict(raw.dtypes)["total_offense"])
    valid = F.coalesce(offenses > 0, F.lit(False))
    train_row = in_train(F.col(key), train)
    return raw.agg(
        F.count("*").alias("records_total"),
        F.count_if(valid).alias("records_processed"),
        F.count_if(valid & train_row).alias("train_rows"),
        F.count_if(valid & ~train_row).alias("test_rows"),
    )


def offenses_by_state_daytype(df: DataFrame, n: int | None = None) -> DataFrame:
    """Sum of offenses by state and day type, largest first; ``n`` keeps the top rows."""
    out = (
        df.groupBy("state", "TIPO_DIA")
        .agg(F.sum("TOTAL_DELITOS").alias("Suma_Total_Delitos"))
        .orderBy(F.desc("Suma_Total_Delitos"), "state", "TIPO_DIA")
    )
    return out if n is None else out.limit(n)


def label_distribution(df: DataFrame, n: int | None = 10, weight: str | None = None) -> DataFrame:
    """Incidents per label, most frequent first."""
    out = df.groupBy("INCIDENT_TYPE").agg(_count(weight)).orderBy(F.desc("count"), "INCIDENT_TYPE")
    return out if n is None else out.limit(n)


def type_by_state(df: DataFrame, label: str = "THEFT", weight: str | None = None) -> DataFrame:
    """Number of incidents with one label by state, largest first."""
    of_label = df.filter(F.col("INCIDENT_TYPE") == label)
    return of_label.groupBy("state").agg(_count(weight)).orderBy(F.desc("count"), "state")


def types_by_state(
    df: DataFrame, labels: Iterable[str] = PIVOT_LABELS, weight: str | None = None
) -> DataFrame:
    """One row per state with a count per label, 0 where there is none.

    The labels are given, so conditional counts do the pivot in a single partial/final aggregation.
    """
    labels = list(labels)

    def count_of(label: str) -> Column:
        same = F.col("INCIDENT_TYPE") == label
        return F.count_if(same) if weight is None else F.sum(F.when(same, F.col(weight)).otherwise(0))

    return (
        df.filter(F.col("INCIDENT_TYPE").isin(labels))
        .groupBy("state")
        .agg(*[count_of(label).alias(label) for label in labels])
    )


def focus_top(by_state: DataFrame, focus: Iterable[str] = FOCUS_LABELS, n: int = 10) -> DataFrame:
    """Top states with the focus columns, by the first of them that the table has."""
    state = resolve_col(by_state, "state") or "state"
    present = {label: name for label in focus if (name := resolve_col(by_state, label))}
    if not present:
        raise ValueError("none of the focus columns is in the table")
    order = present.get("THEFT") or next(iter(present.values()))
    return (
        by_state.orderBy(F.desc(f"`{order}`"), F.col(f"`{state}`"))
        .limit(n)
        .select(F.col(f"`{state}`").alias("state"), *[F.col(f"`{c}`").alias(k) for k, c in present.items()])
    )


def top_states_per_type(by_state: DataFrame, labels: Iterable[str] = RANKED_LABELS, n: int = 10) -> DataFrame:
    """Top states for each label. The rank filter lets Spark cut each partition to n rows before the shuffle."""
    state = resolve_col(by_state, "state") or "state"
    present = {label: name for label in labels if (name := resolve_col(by_state, label))}
    long = by_state.select(
        F.col(f"`{state}`").alias("state"), *[F.col(f"`{c}`").alias(k) for k, c in present.items()]
    ).unpivot("state", list(present), "INCIDENT_TYPE", "count")
    order = Window.partitionBy("INCIDENT_TYPE").orderBy(F.desc("count"), "state")
    return long.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def month_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("MONTH").count()


def hour_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("HOUR_BUCKET").count()


def multiple_profile(df: DataFrame) -> DataFrame:
    """The MULTIPLE incidents by state: how many, their offenses, and how often each flag is set."""
    return (
        df.filter(F.col("INCIDENT_TYPE") == MULTIPLE)
        .groupBy("state")
        .agg(
            F.count("*").alias("count"),
            F.sum("TOTAL_DELITOS").alias("offenses"),
            *[F.sum(flag).alias(flag) for flag in FLAGS],
        )
    )


