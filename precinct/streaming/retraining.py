"""Models that are trained again when new incidents have arrived."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.operators import metrics, ml, reports
from precinct.schema import ALGORITHM_NAMES, CATEGORICAL, NUMERIC
from precinct.session import scratch_tables
from precinct.sources import publish_metrics, read_run_summaries, write_summary
from precinct.streaming.ingest import KEY, Ingested, ingest, read_store, store_cells


class Retrained(NamedTuple):
    """The batches that arrived, and the model and its summary, which are None if nothing was new."""

    batches: list[Ingested]
    model: PipelineModel | None
    summary: DataFrame | None


def retrain(
    spark: SparkSession,
    source: str,
    out: str,
    algorithm: str = "lr",
    numeric: Sequence[str] = NUMERIC,
    train: float = 0.8,
    partitions: int | Callable[[int], int] | None = None,
    file_filter: str = "*.csv",
    most_files: int | None = None,
    **params,
) -> Retrained:
    """Takes in the files below ``source`` that are new, and trains anew on all incidents of the store if there were any.

    Without new files nothing is trained, written or published. Dictionaries come from the counts that the store keeps, so
    only the classifier passes over the training rows; the test rows are scored once. The model, its summary and its published
    metrics are those of the last batch: done again, they replace themselves. In the summary ``records_total`` are the rows
    of the new files, the other counts those of the store.
    """
    timings: dict[str, float] = {}

    @contextmanager
    def phase(name: str):
        begin = time.time()
        yield
        timings[name] = time.time() - begin

    store = f"{out}/store"
    with phase("ingest_seconds"):
        batches = ingest(spark, source, store, f"{out}/checkpoint", numeric, train, file_filter, most_files)
    if not batches:
        return Retrained([], None, None)
    last = batches[-1].batch
    model_path, summary_path = (f"{out}/{kind}/{algorithm}/batch={last}" for kind in ("models", "summaries"))
    with scratch_tables(spark) as table:
        cells = table(store_cells(spark, store), "cells")
        rows = read_store(spark, store, numeric)
        with phase("fit_seconds"):
            pipeline = ml.pipeline_with_counts(algorithm, cells.filter("is_train"), CATEGORICAL, numeric, **params)
            model = ml.fit(pipeline, rows.filter("is_train"), partitions, (KEY,))
            ml.save_model(model, model_path)
        with phase("evaluate_seconds"):
            confusion = table(metrics.confusion(ml.score(model, rows.filter("not is_train"))), "confusion")

        def size(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

        counts = cells.agg(
            F.lit(sum(b.records_total for b in batches)).cast("long").alias("records_total"),
            size(F.lit(True)).alias("records_processed"),
            size(F.col("is_train")).alias("train_rows"),
            size(~F.col("is_train")).alias("test_rows"),
        )
        spent = F.create_map(*[x for k, v in timings.items() for x in (F.lit(k), F.lit(v))])
        overall = metrics.global_metrics(confusion)
        write_summary(
            reports.run_summary(overall, counts, ALGORITHM_NAMES[algorithm], spent, source, model_path, numeric=numeric), summary_path
        )
    summary = read_run_summaries(spark, summary_path)
    publish_metrics(summary, f"{out}/metrics", F.lit(f"{algorithm}-{last}"))
    return Retrained(batches, model, summary)
