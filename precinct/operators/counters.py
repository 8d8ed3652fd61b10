"""Counters of the persons of an incident as further numeric features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.schema import MINOR_AGE


def demographic_conditions() -> dict[str, Column]:
    """Minors and sexes of victims and offenders, as conditions on a person (role, age, sex)."""
    out = {}
    for role in ("victim", "offender"):
        is_role = F.col("role") == role
        out[f"minor_{role}s"] = is_role & (F.col("age") < MINOR_AGE)
        out[f"female_{role}s"] = is_role & (F.col("sex") == "F")
        out[f"male_{role}s"] = is_role & (F.col("sex") == "M")
    return out


def conditional_counters(rows: DataFrame, key: str, conditions: dict[str, Column]) -> DataFrame:
    """For each ``key`` how many rows meet each condition; an unknown condition is not met. Rows without a key are left out.

    Rows are counted before anything is joined, so an incident with many persons is summed up where they are.
    """
    counters = [F.count_if(F.coalesce(c, F.lit(False))).cast("int").alias(name) for name, c in conditions.items()]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*counters)


def add_counters(df: DataFrame, counters: DataFrame, key: str) -> DataFrame:
    """``df`` with the counters of its key, 0 where there are none."""
    names = [c for c in counters.columns if c != key]
    return df.join(counters, key, "left").fillna(0, names)
