"""Readers for incident files and for the artefacts that runs leave behind."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precinct.functions import whole_number
from precinct.schema import INCIDENT_SCHEMA, SUMMARY_SCHEMA


def _file_schema(header: list[str], schema: T.StructType) -> T.StructType:
    """Types for the columns of a file in the file's own order; unknown columns stay text.

    Whole numbers are read as doubles, so that a cell such as "2.0" is not lost.
    """
    known = {f.name.lower(): f.dataType for f in schema.fields}
    whole = (T.IntegerType, T.ShortType, T.ByteType)

    def file_type(name: str) -> T.DataType:
        dtype = known.get(name.strip().lower(), T.StringType())
        return T.DoubleType() if isinstance(dtype, whole) else dtype

    return T.StructType([T.StructField(name, file_type(name)) for name in header])


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns under the names of ``schema``, whole numbers as such; unknown columns stay as they are."""
    df = trim_names(df)
    wanted = {f.name.lower(): f for f in schema.fields}

    def typed(name: str, dtype: str):
        field = wanted.get(name.lower())
        if field is None:
            return F.col(f"`{name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return whole_number(F.col(f"`{name}`"), dtype).alias(field.name)
        return F.col(f"`{name}`").alias(field.name)

    return df.select(*[typed(name, dtype) for name, dtype in df.dtypes])


def data_files(spark: SparkSession, path: str | list[str], file_filter: str | None = None) -> list[str]:
    """The files below ``path``, in the order of their names. They are listed, not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    return [r["path"] for r in reader.load(path).select("path").orderBy("path").collect()]


def csv_headers(spark: SparkSession, files: Sequence[str], at_once: int = 16) -> list[tuple[str, ...]]:
    """The header of each file; a small job of its own reads its first line, ``at_once`` of them at a time."""

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(file).columns)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(header, files))


def _read_by_header(spark: SparkSession, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """Files that share a header are read and typed together; the groups are united by column name."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, csv_headers(spark, files)):
        if header:  # an empty file has none
            groups.setdefault(header, []).append(file)
    if not groups:
        return spark.createDataFrame([], schema)
    spelling = {f.name.lower(): f.name for f in schema.fields}
    parts = []
    for header, own in groups.items():
        reader = spark.read.option("header", True).schema(_file_schema(list(header), schema)).option("enforceSchema", False)
        df = _typed(reader.csv(own), schema)
        parts.append(df.toDF(*[spelling.setdefault(c.lower(), c) for c in df.columns]))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.select(*[f"`{c}`" for c in spelling.values() if c in df.columns])


def read_incidents_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = INCIDENT_SCHEMA,
    infer: bool = False,
    file_filter: str | None = None,
    by_header: bool = False,
) -> DataFrame:
    """Incident CSV files with a header.

    ``path`` is one path, a glob or a list; ``file_filter`` restricts folders to a file-name pattern.
    Columns are matched to ``schema`` by header name, whatever their order, without a pass over the data:
    only the first line of one file is looked at. The id is text, so ids of any form are kept. ``infer=True`` infers the
    types instead (one more pass).

    ``by_header`` is for files of several years: each is read by its own header, so order and columns may differ. The
    result has the columns of all files, those of ``schema`` first; a column that a file lacks is null in its rows.
    Empty files are skipped; columns that differ in case or outer blanks only are the same. Folder names give no columns.
    """
    if by_header:
        return _read_by_header(spark, data_files(spark, path, file_filter), schema)
    reader = spark.read.option("header", True)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if infer:
        return trim_names(reader.option("inferSchema", True).csv(path))
    header = reader.csv(path).columns
    return _typed(reader.schema(_file_schema(header, schema)).option("enforceSchema", False).csv(path), schema)


def read_incidents_parquet(spark: SparkSession, path: str | list[str], text: tuple[str, ...] = ("MONTH",)) -> DataFrame:
    """Incidents stored as Parquet: vectorised, pruned and filtered in the scan.

    Folders named by a column give it back as a number; the ``text`` columns become text again.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if c in text and kind != "string"})


def _run_name() -> Column:
    """Name of the file that a row is from, or of its folder (behind a ``key=``) if Spark has named the file."""
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"(?:[^/=]*=)?([^/]*)/[^/]*$", 1)
    return F.when(F.col("_metadata.file_name").startswith("part-"), folder).otherwise(F.col("_metadata.file_name"))


def read_run_summaries(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, rejects: bool = False
) -> DataFrame:
    """Run-summary JSON files; ``path`` may be a glob over many runs.

    By default each line is one object, as ``write_summary`` puts them; ``multi_line`` suits one indented object
    per file. A record that is no summary (broken JSON, another type in a field, or none of the fields) is no run and is left
    out. With ``rejects`` such records stay, as nulls with their text in ``broken``, and each record has the ``file_name``
    (the folder's, for the part files that Spark writes) and ``file_time`` of its file; ``runs.recorded_runs`` takes it
    from there.
    """
    broken = T.StructField("broken", T.StringType())
    reader = spark.read.schema(T.StructType([*SUMMARY_SCHEMA.fields, broken]))
    df = reader.json(path, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord="broken")
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in SUMMARY_SCHEMA.names])
    if not rejects:
        return df.filter(F.col("broken").isNull() & ~empty).drop("broken")
    whole = F.col("broken").isNull() & ~empty
    kept = [F.when(whole, F.col(c)).alias(c) for c in SUMMARY_SCHEMA.names]
    text = F.when(~whole, F.coalesce("broken", F.lit("{}"))).alias("broken")
    return df.select(*kept, text, _run_name().alias("file_name"), F.col("_metadata.file_modification_time").alias("file_time"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Run summaries that ``publish_metrics`` has written, each run as it was published last, with their ``run_key`` as text."""
    own = [T.StructField("run_key", T.StringType()), T.StructField("published", T.LongType())]
    rows = spark.read.schema(T.StructType([*SUMMARY_SCHEMA.fields, *own])).parquet(path)
    last = rows.groupBy(F.col("run_key").alias("last_key")).agg(F.max("published").alias("last_published"))
    kept = rows.join(last, F.col("run_key").eqNullSafe(F.col("last_key")) & (F.col("published") == F.col("last_published")))
    return kept.select(*SUMMARY_SCHEMA.names, "run_key")


def trim_names(df: DataFrame) -> DataFrame:
    names = [c.strip() for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def read_result_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """A result table with trimmed header names, or None when there is no such file.

    Without a schema the types are inferred, which suits small result tables.
    """
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    try:
        return trim_names(reader.csv(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def resolve_col(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that equals ``name`` but for case and outer blanks, or None."""
    wanted = name.strip().lower()
    return next((c for c in df.columns if c.strip().lower() == wanted), None)


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and types as a table."""
    fields = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.lit(t).alias("type"))
              for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))
