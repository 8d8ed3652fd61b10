"""Derived incident columns as native expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from precinct.schema import (
    DATE_PATTERN,
    FLAG_LABELS,
    FLAGS,
    HOUR_PATTERN,
    MULTIPLE,
    UNKNOWN,
    UNKNOWN_HOUR,
    WEEKDAY,
    WEEKEND,
    WEEKEND_DAYS,
)


def whole_number(c: Column, dtype: str) -> Column:
    """``c`` as int, null where it is no number. Text such as "2.0" counts as 2.

    ``dtype`` is the type the column has; an int column stays as it is, so that filters on it are pushed
    down to the scan.
    """
    if dtype in ("int", "smallint", "tinyint"):
        return c.cast("int")
    if dtype == "string":
        c = c.try_cast("double")
    return c.try_cast("int")


def incident_date(c: Column) -> Column:
    """Whole number ``yyyyMMdd`` to date; null when it is no valid date."""
    return F.try_to_date(c.try_cast("int").cast("string"), DATE_PATTERN)


def day_type(date: Column, weekend: Iterable[int] = WEEKEND_DAYS) -> Column:
    """Weekend or weekday; a null date counts as a weekday. Days are numbered from Sunday = 1."""
    return F.when(F.dayofweek(date).isin(list(weekend)), F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def month_key(date: Column) -> Column:
    return F.month(date).cast("string")


def hour_bucket(c: Column) -> Column:
    """First two digits of the first four-digit run; "00" for midnight, "UNK" without digits, null for null."""
    digits = F.regexp_extract(c, HOUR_PATTERN, 1)
    found = F.when(F.length(digits) == 0, F.lit(UNKNOWN_HOUR)).otherwise(digits)
    return F.when(F.lower(c).contains("midnight"), F.lit("00")).otherwise(found)


def hour_band(bucket: Column, hours: int = 6) -> Column:
    """Number of the band of ``hours`` hours that an hour bucket lies in; null without an hour."""
    return F.floor(bucket.try_cast("int") / hours).cast("int")


def flag_sum(flags: Iterable[Column | str] = FLAGS) -> Column:
    """Number of set flags; null when any flag is null."""
    return reduce(add, [F.col(f) if isinstance(f, str) else f for f in flags])


def incident_type(total: Column | None = None) -> Column:
    """Label of an incident: MULTIPLE when more than one flag is set, else that of the first set flag."""
    label = F.when((flag_sum() if total is None else total) > 1, F.lit(MULTIPLE))
    for flag, name in FLAG_LABELS.items():
        label = label.when(F.col(flag) == 1, F.lit(name))
    return label.otherwise(F.lit(UNKNOWN))
