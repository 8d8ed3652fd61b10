"""Cleaning and derivation of incident rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.functions import day_type, flag_sum, hour_bucket, incident_date, incident_type, month_key, whole_number
from precinct.schema import DOUBLES, FLAGS, NUMERIC, RENAMES, WEEKEND_DAYS


def standardize(df: DataFrame) -> DataFrame:
    """Rename the key columns; a missing one is left out."""
    for old, new in RENAMES.items():
        df = df.withColumnRenamed(old, new)
    return df


def filter_valid(df: DataFrame) -> DataFrame:
    """Rows with at least one offense. Works on raw and on standardised columns; null counts are dropped."""
    names = {c.lower(): c for c in df.columns}
    name = names.get("total_delitos") or names["total_offense"]
    return df.filter(whole_number(F.col(name), dict(df.dtypes)[name]) > 0)


def cast_numeric(df: DataFrame, columns: Iterable[str] = NUMERIC) -> DataFrame:
    """Numeric features to int, property value to double; what cannot be read becomes null."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.col(c).try_cast("double") if c in DOUBLES else whole_number(F.col(c), types[c]) for c in columns}
    )


def impute_zero(df: DataFrame, columns: Iterable[str] = NUMERIC) -> DataFrame:
    """Null (and NaN in doubles) to 0."""
    return df.fillna({c: 0 for c in columns})


def derive(
    df: DataFrame,
    weekend: Iterable[int] = WEEKEND_DAYS,
    numeric: Iterable[str] = NUMERIC,
    keep_invalid: bool = False,
) -> DataFrame:
    """All derived columns of valid incidents, as one projection over one filter.

    The filter goes before the imputation: a count imputed with 0 would be dropped anyway, and a filter on
    the stored column reaches the scan while one on the imputed column does not. ``keep_invalid`` keeps all
    rows and marks them in a column ``VALID``, for jobs that count both kinds in one pass.
    """
    df = standardize(df if keep_invalid else filter_valid(df))
    types = dict(df.dtypes)
    df = cast_numeric(df, numeric).withColumns({f: whole_number(F.col(f), types[f]) for f in FLAGS})
    df = df.withColumns(
        {
            "INCIDENT_DATE": incident_date(F.col("INCIDENT_DATE_RAW")),
            "HOUR_BUCKET": hour_bucket(F.col("hour")),
            "OFFENSE_FLAGS_SUM": flag_sum(),
        }
    ).withColumns(
        {
            "TIPO_DIA": day_type(F.col("INCIDENT_DATE"), weekend),
            "MONTH": month_key(F.col("INCIDENT_DATE")),
            "INCIDENT_TYPE": incident_type(F.col("OFFENSE_FLAGS_SUM")),
        }
    )
    df = impute_zero(df, numeric)
    return df.withColumn("VALID", F.col("TOTAL_DELITOS") > 0) if keep_invalid else df
