"""Ranks and indexes of columns with many values, without a task or a driver that sees all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.session import materialize


def ranked_values(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(column, value, count, idx): each value's place by frequency and then by value, nulls left out.

    The order of ``category_index``, for keys as well: the counted values are cut into ranges of that order, each range
    is numbered by itself, and the values before it are added. A column with one value for each row is spread like
    any other; windows see one range, or one row for each range. ``partitions`` is the number of ranges (the session's
    shuffle partitions if None). The ranges are stored in the shared folder, so both passes see the same ones.
    """
    columns = list(columns)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
        .withColumn("less", -F.col("count"))
    )
    order = ["column", "less", "value"]
    ranges = materialize(counts.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("column", "range").agg(F.count("*").alias("size"))
    before = sizes.select("column", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("column", "range").orderBy("less", "value")
    numbered = ranges.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(before, ["column", "range"]).select(
        "column", "value", "count", (F.col("place") + F.col("before")).cast("double").alias("idx")
    )


def with_ranks(df: DataFrame, ranks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_idx``: the index of its value in ``ranks``.

    Null and unknown values have the place behind the last one, as an indexer that keeps them gives it. The values are joined, not
    sent to the driver; Spark broadcasts those of a small column and splits hot values of a large one.
    """
    for column in columns:
        own = ranks.filter(F.col("column") == column)
        size = own.agg(F.count("*").cast("double")).scalar()
        index = own.select(F.col("value").alias(f"__{column}"), F.col("idx").alias(f"{column}_idx"))
        joined = df.join(index, df[column].cast("string") == index[f"__{column}"], "left").drop(f"__{column}")
        df = joined.withColumn(f"{column}_idx", F.coalesce(f"{column}_idx", size))
    return df
