"""A store of derived incidents that new files are added to.

A file stream with a checkpoint finds the files that no earlier run has seen. Each batch of them writes only folders of its
own, month by month, so the work follows what is new, and a batch that is done again after a failure replaces what it
wrote before. The store has three tables:

* ``incidents``: derived rows by MONTH and BATCH;
* ``superseded``: ids of earlier batches that a later one delivers again (its rows count, the earlier ones do not);
* ``cells``: changes of the row counts by category values, label and part of the split, negative for superseded rows. Label
  and category dictionaries are sums of these small tables; no pass over the rows is needed for them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from precinct.operators import clean
from precinct.operators.split import in_train
from precinct.schema import CATEGORICAL, DOUBLES, INCIDENT_SCHEMA, NUMERIC
from precinct.session import exists
from precinct.sources import read_incidents_csv

FILES = "path string, modificationTime timestamp, length long, content binary"
CELLS = ", ".join(f"{c} string" for c in (*CATEGORICAL, "INCIDENT_TYPE")) + ", is_train boolean, n long"
KEY = "A_INCIDENT_ID"


class Ingested(NamedTuple):
    """What one batch has brought: files, rows read, rows kept, and earlier rows that they replace."""

    batch: int
    files: int
    records_total: int
    records_processed: int
    replaced: int


def new_files(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    file_filter: str = "*.csv",
    most_files: int | None = None,
) -> None:
    """Calls ``handle(files, batch)`` for the files (path, length) below ``source`` that are new, until none is left.

    The content of the files is not read by the stream. With ``most_files`` they come in batches of so many. After a
    failure the unfinished batch comes again with the same number and files.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).option("pathGlobFilter", file_filter)
    if most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    files = reader.load(source).select("path", "length")
    stream = files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(handle)
    stream.start().awaitTermination()


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table of the store, or None before the first batch."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


def _columns(numeric: Sequence[str]) -> dict[str, str]:
    """Columns of the incidents in the store, with their types."""
    texts = dict.fromkeys([KEY, *CATEGORICAL, "INCIDENT_TYPE"], "string")
    numbers = {c: "double" if c in DOUBLES else "int" for c in numeric}
    return {**texts, **numbers, "is_train": "boolean", "BATCH": "int"}


def _rows(spark: SparkSession, store: str, numeric: Sequence[str]) -> DataFrame | None:
    return _stored(spark, f"{store}/incidents", ", ".join(f"`{c}` {t}" for c, t in _columns(numeric).items()))


def read_store(
    spark: SparkSession, store: str, numeric: Sequence[str] = NUMERIC, before: int | None = None
) -> DataFrame | None:
    """The incidents of the store, each id as its last batch delivered it; None if nothing has arrived.

    Rows without an id are never superseded. ``before`` leaves out that batch and later ones.
    """
    rows = _rows(spark, store, numeric)
    if rows is None:
        return None
    gone = _stored(spark, f"{store}/superseded", f"{KEY} string, OLD int, BATCH int")
    if before is not None:
        rows = rows.filter(F.col("BATCH") < before)
        gone = None if gone is None else gone.filter(F.col("BATCH") < before)
    if gone is None:
        return rows
    # The ids that were delivered again are few beside the store; adaptive execution broadcasts them if they are.
    gone = gone.select(F.col(KEY).alias("gone_id"), F.col("OLD").alias("gone_batch")).distinct()
    return rows.join(gone, (F.col(KEY) == F.col("gone_id")) & (F.col("BATCH") == F.col("gone_batch")), "left_anti")


def store_cells(spark: SparkSession, store: str) -> DataFrame | None:
    """Row counts by category values, label and part of the split, over all batches."""
    cells = _stored(spark, f"{store}/cells", f"{CELLS}, BATCH int")
    if cells is None:
        return None
    keys = [*CATEGORICAL, "INCIDENT_TYPE", "is_train"]
    return cells.groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


def _replace(df: DataFrame, path: str, *folders: str) -> None:
    """Write ``df`` over the folders that it has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def _cells(rows: DataFrame, sign: int) -> DataFrame:
    keys = [*CATEGORICAL, "INCIDENT_TYPE", "is_train"]
    return rows.groupBy(*keys).agg((sign * F.count("*")).cast("long").alias("n"))


def ingest(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    numeric: Sequence[str] = NUMERIC,
    train: float = 0.8,
    file_filter: str = "*.csv",
    most_files: int | None = None,
) -> list[Ingested]:
    """Adds the incident files below ``source`` that are new to the ``store``; a record for each batch of them.

    Files are read by their own headers. The split is by id, so an incident never changes its part. A file that has
    been seen is not looked at again, even if its content has changed.
    """
    done: list[Ingested] = []

    def handle(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.select("path").collect()]  # names of the new files alone
        if not paths:
            return
        seen = Observation()
        raw = read_incidents_csv(spark, paths, by_header=True)
        missing = [f for f in INCIDENT_SCHEMA.fields if f.name not in raw.columns]
        raw = raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        rows = clean.derive(raw.observe(seen, F.count("*").alias("n")), numeric=numeric).withColumns(
            {"is_train": in_train(F.col(KEY), train), "BATCH": F.lit(batch)}
        )
        # A month with many rows is dealt to several tasks; a null month has a folder, too.
        _replace(rows.select(*_columns(numeric)).hint("rebalance", "MONTH"), f"{store}/incidents", "MONTH", "BATCH")
        new = _rows(spark, store, numeric).filter(F.col("BATCH") == batch)
        old = read_store(spark, store, numeric, batch)
        ids = new.filter(F.col(KEY).isNotNull()).select(F.col(KEY).alias("new_id")).distinct()
        again = old.join(ids, F.col(KEY) == F.col("new_id"), "left_semi")
        gone = again.select(KEY, F.col("BATCH").alias("OLD"), F.lit(batch).alias("BATCH")).distinct()
        _replace(gone, f"{store}/superseded", "BATCH")
        # What the batch brings and what it replaces: the earlier rows of its ids.
        changes = _cells(new, 1).unionByName(_cells(again, -1)).withColumn("BATCH", F.lit(batch))
        _replace(changes, f"{store}/cells", "BATCH")
        brought = _stored(spark, f"{store}/cells", f"{CELLS}, BATCH int").filter(F.col("BATCH") == batch)
        counts = brought.agg(
            F.sum(F.when(F.col("n") > 0, F.col("n"))).alias("new"), F.sum(F.when(F.col("n") < 0, -F.col("n"))).alias("old")
        ).first()
        done.append(Ingested(batch, len(paths), seen.get["n"], counts["new"] or 0, counts["old"] or 0))

    new_files(spark, source, checkpoint, handle, file_filter, most_files)
    return done
