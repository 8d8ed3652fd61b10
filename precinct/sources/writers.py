"""Writers for result tables, summaries and reports.

None of them forces the output through one task: adaptive execution merges the partitions of a small
result into one file by itself, and a large result is written in parallel.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Run summaries as JSON, nested fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_text(lines: DataFrame, path: str) -> None:
    """Report lines of ``reports.text_report`` in their order; files sort by name in the same order."""
    lines.orderBy("section", "seq", "name").select("line").write.mode("overwrite").text(path)


def write_incidents_parquet(
    df: DataFrame, path: str, partition_by: str | None = "MONTH", rebalance: bool = True
) -> None:
    """Incidents as Parquet, one folder per month.

    Rebalancing gathers a month in files of the advisory size and splits a month that holds a large share
    of the rows over many tasks. Without it there is no shuffle, but each task writes a file per month.
    """
    if partition_by:
        if rebalance:
            df = df.hint("rebalance", partition_by)
        df.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_metrics(summaries: DataFrame, path: str) -> None:
    """Append run summaries to the Parquet table of published metrics."""
    summaries.write.mode("append").parquet(path)


def publish_metrics(summaries: DataFrame, path: str, run_key: Column | None = None) -> None:
    """Publish run summaries so that each run counts once, as it was published last (``read_metrics``): Parquet.

    ``run_key`` names a run (a digest of algorithm, time stamp and model path by default; an empty one is null). Rows are
    added with the ``published`` number of the call, which is above all before it, so a call writes its own runs only,
    in as few files as they need. What ``read_metrics`` gives of a run is all of the last call that had it.
    """
    if run_key is None:
        run_key = F.sha1(F.concat_ws("|", "algorithm", "run_timestamp", "model_path"))
    rows = summaries.withColumn("run_key", F.nullif(run_key.cast("string"), F.lit("")))
    number = max(_last_published(summaries.sparkSession, path) + 1, time.time_ns())
    rows.withColumn("published", F.lit(number).cast("bigint")).write.mode("append").parquet(path)


def _last_published(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.schema("published bigint").parquet(path).agg(F.max("published")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
