"""Number and line formatting, run-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c: Column, decimals: int) -> Column:
    """Text with a fixed number of decimals, rounded half-even on the exact binary value."""
    return F.call_function("format_number", c, F.lit("0." + "0" * decimals if decimals else "0"))


def thousands(c: Column) -> Column:
    """Whole number as text with thousands separators."""
    return F.format_number(c, 0)


def key_values(pairs: dict[str, Column], sep: str = ", ") -> Column:
    """``k=v`` pairs joined in the given order."""
    return F.concat_ws(sep, *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in pairs.items()])


def minutes(seconds: Column) -> Column:
    """Seconds to minutes, 0 when missing."""
    return F.coalesce(seconds / 60, F.lit(0.0))


def run_seconds(total: Column, timings: Column, wall: Column | None = None) -> Column:
    """Recorded total, else the sum of the phase timings; 0 or nothing falls back to wall time."""
    phases = F.aggregate(F.map_values(timings), F.lit(0.0), lambda acc, s: acc + F.coalesce(s, F.lit(0.0)))
    seconds = F.coalesce(total, phases)
    return seconds if wall is None else F.coalesce(F.nullif(seconds, F.lit(0.0)), wall)


def run_stamp() -> Column:
    """Current time as ISO text in UTC."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
