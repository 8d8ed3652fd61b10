"""Session helpers: a local session, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Input per shuffle partition. The columns that get shuffled are about a quarter of the input, so this gives
# partitions of some 128 MB.
SHUFFLE_INPUT_BYTES = 512 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def local_session(app: str = "precinct", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def partitions_for(nbytes: int) -> int:
    """Shuffle partitions for a job over ``nbytes`` of input."""
    return max(1, -(-nbytes // SHUFFLE_INPUT_BYTES))


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Runs the jobs inside with ``n`` initial shuffle partitions, or as the session says if it is None.

    Adaptive execution merges partitions that turn out small but never splits an ordinary one, so the
    initial number has to be high enough for the data. The session's own setting is put back at the end.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        if n is not None:
            spark.conf.set(INITIAL_PARTITIONS, str(n))
        yield
    finally:
        if n is not None and before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        elif n is not None:
            spark.conf.set(INITIAL_PARTITIONS, before)


def spread_evenly(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """``df`` in so many partitions by its keys, each in their order; as it is stored if ``partitions`` is None.

    What depends on partitions, such as the bootstrap of a forest, then depends on this number alone.
    """
    return df if partitions is None else df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="precinct-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that materializes tables and removes them all at the end."""
    paths: list[str] = []

    def table(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return materialize(df, path=paths[-1])

    try:
        yield table
    finally:
        for path in paths:
            remove(spark, path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system it is."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def materialize(df: DataFrame, name: str = "table", path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, with the writer's ``options``, and read it back.

    Cuts the lineage, survives the loss of executors and gives later passes a columnar, prunable scan.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
