"""End-to-end jobs: aggregate analysis, training with evaluation, reports."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from precinct.functions import day_type, incident_date
from precinct.operators import analysis, clean, metrics, ml, reports, split
from precinct.schema import ALGORITHM_NAMES, CATEGORICAL, NUMERIC, WEEKEND_DAYS
from precinct.session import scratch_tables, shuffle_partitions
from precinct.sources import (
    read_result_csv,
    read_run_summaries,
    write_csv,
    write_summary,
    write_text,
)

DISTRIBUTION_SCHEMA = "INCIDENT_TYPE string, count bigint"
BY_STATE_SCHEMA = "state string, count bigint"
PER_CLASS_SCHEMA = "class string, support bigint, precision double, recall double, f1 double"


def aggregate_analysis(raw: DataFrame, n: int | None = None, weekend=WEEKEND_DAYS) -> DataFrame:
    """Sum of offenses by state and day type; reads four columns and shuffles partial sums only."""
    df = clean.standardize(clean.filter_valid(raw))
    df = df.withColumn("TIPO_DIA", day_type(incident_date(F.col("INCIDENT_DATE_RAW")), weekend))
    return analysis.offenses_by_state_daytype(df, n)


def train_and_evaluate(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    algorithm: str = "lr",
    data_file: str = "",
    train: float = 0.8,
    random: bool = False,
    seed: int = 42,
    key: str = "A_INCIDENT_ID",
    partitions: int | Callable[[int], int] | None = None,
    shuffles: int | None = None,
    weighted: bool = False,
    **params,
) -> DataFrame:
    """Derive features, write the result tables, fit, score, evaluate, save; returns the run summary.

    The raw rows are read once: the derived columns go to a table in the shared scratch folder, counted on
    the way, and all later passes read the columns they need from there. The test rows are scored once; every
    metric comes from their confusion table. ``partitions`` is how many the training rows are brought into (as
    they are stored if None), or a function from their count to it (``ml.train_partitions``), ``shuffles`` the initial shuffle partitions of the job (the session's if None);
    ``session.partitions_for`` gives a number for an input size. ``weighted`` balances the labels: each training row
    weighs rows / (labels * rows of its label), and the metrics weigh the test rows alike; the tables of plain counts
    are written as well. ``numeric`` among ``params`` may name further columns of the raw rows.
    """
    timings: dict[str, float] = {}
    started = time.time()

    @contextmanager
    def phase(name: str):
        begin = time.time()
        yield
        timings[name] = time.time() - begin

    model_path = f"{out}/models/{algorithm}"
    with shuffle_partitions(spark, shuffles), scratch_tables(spark) as table:
        with phase("feature_engineering_seconds"):
            seen = Observation()
            counted = raw.observe(seen, F.count("*").alias("records_total"))
            numeric = params.get("numeric", NUMERIC)
            keep = [*ml.input_columns(ml.build_pipeline(algorithm, **params)), key]
            derived = clean.derive(counted, numeric=numeric).withColumn("is_train", split.in_train(F.col(key), train))
            features = table(derived.select(*dict.fromkeys(keep), "is_train"), "features")
            records_total = seen.get["records_total"]

        with phase("label_distribution_seconds"):
            cells = table(
                features.groupBy("state", "INCIDENT_TYPE", "is_train").agg(F.count("*").alias("n")), "cells"
            )
            write_csv(analysis.label_distribution(cells, 10, weight="n"), f"{out}/incident_type_distribution")
            write_csv(analysis.type_by_state(cells, "THEFT", weight="n"), f"{out}/theft_by_state")
            write_csv(analysis.types_by_state(cells, weight="n"), f"{out}/incident_types_by_state")

        with phase("split_seconds"):
            if random:
                train_rows, test_rows = split.random_split(features, (train, 1 - train), seed)
                sizes = {"train_rows": train_rows.count(), "test_rows": test_rows.count()}
            else:
                train_rows, test_rows = features.filter("is_train"), features.filter("not is_train")
                sizes = (
                    cells.agg(
                        F.coalesce(F.sum(F.when(F.col("is_train"), F.col("n"))), F.lit(0)).alias("train_rows"),
                        F.coalesce(F.sum(F.when(~F.col("is_train"), F.col("n"))), F.lit(0)).alias("test_rows"),
                    )
                    .first()
                    .asDict()
                )

        if weighted:
            counts = train_rows.groupBy("INCIDENT_TYPE").count() if random else _label_counts(cells.filter("is_train"))
            weights = table(ml.balanced_weights(counts), "weights")
            train_rows, test_rows = ml.add_weights(train_rows, weights), ml.add_weights(test_rows, weights)
            params["weightCol"] = "weight"

        if callable(partitions):
            partitions = partitions(sizes["train_rows"])

        with phase("fit_seconds"):
            model = ml.fit(ml.build_pipeline(algorithm, **params), train_rows, partitions, (key,))

        with phase("evaluate_seconds"):
            confusion = table(metrics.confusion(ml.score(model, test_rows), also="weight" if weighted else None), "confusion")
            labels = ml.label_names(model)
            if weighted:
                balanced = metrics.reweighted(confusion)
                write_csv(metrics.per_class_metrics(balanced, labels), f"{out}/per_class_metrics_{algorithm}_weighted")
            write_csv(metrics.index_to_name(confusion, labels), f"{out}/confusion_{algorithm}")
            write_csv(metrics.per_class_metrics(confusion, labels), f"{out}/per_class_metrics_{algorithm}")
            overall = metrics.global_metrics(balanced if weighted else confusion)

        with phase("save_model_seconds"):
            ml.save_model(model, model_path)

        counts = spark.createDataFrame(
            [(records_total, sum(sizes.values()), sizes["train_rows"], sizes["test_rows"])],
            "records_total bigint, records_processed bigint, train_rows bigint, test_rows bigint",
        )
        summary = reports.run_summary(
            overall,
            counts,
            ALGORITHM_NAMES[algorithm],
            F.create_map(*[x for k, v in timings.items() for x in (F.lit(k), F.lit(v))]),
            data_file,
            model_path,
            F.lit(time.time() - started),
            params.get("categorical", CATEGORICAL),
            numeric,
        )
        write_summary(summary, f"{out}/summary_{algorithm}")

    stored = read_run_summaries(spark, f"{out}/summary_{algorithm}")
    write_text(reports.summary_lines(stored), f"{out}/summary_{algorithm}_text")
    return stored


def _label_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("INCIDENT_TYPE").agg(F.sum("n").alias("count"))


def report(spark: SparkSession, out: str, algorithm: str = "lr") -> DataFrame:
    """Text report of a finished run, from the tables it wrote. Tables that are missing are left out."""
    distribution = read_result_csv(spark, f"{out}/incident_type_distribution", DISTRIBUTION_SCHEMA)
    if distribution is None:
        raise FileNotFoundError(f"no label distribution in {out}: run train_and_evaluate first")
    return reports.text_report(
        read_run_summaries(spark, f"{out}/summary_{algorithm}"),
        distribution,
        read_result_csv(spark, f"{out}/theft_by_state", BY_STATE_SCHEMA),
        read_result_csv(spark, f"{out}/incident_types_by_state"),
    )


def comparison(spark: SparkSession, out: str, algorithms=("lr", "rf")) -> tuple[DataFrame, DataFrame]:
    """Overall and per-class metrics of several finished runs side by side."""
    summaries = read_run_summaries(spark, [f"{out}/summary_{a}" for a in algorithms])
    classes = {a: read_result_csv(spark, f"{out}/per_class_metrics_{a}", PER_CLASS_SCHEMA) for a in algorithms}
    return (
        reports.compare_models(summaries),
        reports.compare_classes({a: df for a, df in classes.items() if df is not None}),
    )
