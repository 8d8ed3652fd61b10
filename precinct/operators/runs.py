"""Statistics of repeated runs per worker count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.functions import run_seconds


def with_run_seconds(runs: DataFrame) -> DataFrame:
    return runs.withColumn(
        "runtime_seconds",
        run_seconds(F.col("total_runtime_seconds"), F.col("timings_seconds"), F.col("wall_seconds")),
    )


def run_series(runs: DataFrame) -> DataFrame:
    """One record per run, by worker count and run number."""
    return (
        with_run_seconds(runs)
        .select("run", "workers", "runtime_seconds", "wall_seconds", "summary_file")
        .orderBy("workers", "run")
    )


def run_stats(runs: DataFrame) -> DataFrame:
    """Number, minimum, maximum and mean of the run times per worker count."""
    seconds = F.col("runtime_seconds")
    return (
        with_run_seconds(runs)
        .groupBy("workers")
        .agg(
            F.count("*").alias("runs"),
            F.min(seconds).alias("min_seconds"),
            F.max(seconds).alias("max_seconds"),
            F.avg(seconds).alias("avg_seconds"),
        )
        .orderBy("workers")
    )


def phase_timings(runs: DataFrame, *keys: str) -> DataFrame:
    """Phases with their seconds, slowest first; ``keys`` are columns of the run to keep."""
    return runs.select(*keys, F.explode("timings_seconds").alias("phase", "seconds")).orderBy(
        *keys, F.desc("seconds"), "phase"
    )


def recorded_runs(planned: DataFrame, summaries: DataFrame) -> DataFrame:
    """One record for each planned run: its time, and where that comes from.

    ``planned`` has run, workers, summary_file, started (timestamp) and wall_seconds; ``summaries`` is what
    ``read_run_summaries(rejects=True)`` gives. A run counts with the total of its summary, else with the sum of its phases;
    without a summary that says either, or with 0, it falls back to its wall time. So it does if the summary is broken or
    if the file is older than the run, hence left by an earlier one. Of several records in a file the first by time counts.

    ``source`` is "total", "phases" or "wall"; ``summary`` is "good", "empty", "broken", "stale" or "missing".
    """
    whole = F.col("broken").isNull()
    files = summaries.groupBy("file_name").agg(
        F.max("file_time").alias("file_time"),
        F.min_by(F.struct("total_runtime_seconds", "timings_seconds"), F.struct(~whole, "run_timestamp", "total_runtime_seconds")).alias("best"),
        F.max(whole).alias("readable"),
    )
    runs = planned.join(files, planned["summary_file"] == files["file_name"], "left")
    stale = F.col("file_time") < F.date_trunc("second", "started")
    usable = F.col("readable") & ~stale
    total = F.when(usable, F.nullif(F.col("best.total_runtime_seconds"), F.lit(0.0)))
    phases = F.when(usable & F.col("best.total_runtime_seconds").isNull(), F.nullif(run_seconds(F.lit(None).cast("double"), F.col("best.timings_seconds")), F.lit(0.0)))
    source = F.when(total.isNotNull(), "total").when(phases.isNotNull(), "phases").otherwise("wall")
    state = (
        F.when(F.col("file_name").isNull(), "missing")
        .when(stale, "stale")
        .when(~F.col("readable"), "broken")
        .when(source == "wall", "empty")
        .otherwise("good")
    )
    return runs.select(
        "run", "workers", F.coalesce(total, phases, F.col("wall_seconds")).alias("runtime_seconds"), "wall_seconds", "summary_file",
        source.alias("source"), state.alias("summary"),
    )


def metric_trend(metrics: DataFrame, runs: int = 3) -> DataFrame:
    """Each published run beside the one before it of the same algorithm, and the means of the last ``runs``.

    ``metrics`` is what ``read_metrics`` gives. Runs go by time stamp, equal ones by run key. The window sees one row for each run.
    """
    order = Window.partitionBy("algorithm").orderBy("run_timestamp", "run_key")
    last = order.rowsBetween(1 - runs, 0)
    return metrics.select(
        "algorithm",
        "run_key",
        F.row_number().over(order).alias("run"),
        F.col("metrics.accuracy").alias("accuracy"),
        F.col("metrics.f1").alias("f1"),
        *[(F.col(f"metrics.{c}") - F.lag(f"metrics.{c}").over(order)).alias(f"{c}_change") for c in ("accuracy", "f1")],
        *[F.avg(f"metrics.{c}").over(last).alias(f"{c}_mean") for c in ("accuracy", "f1")],
        (F.col("metrics.f1") >= F.max("metrics.f1").over(order)).alias("is_best"),
    )
