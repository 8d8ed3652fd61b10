"""Train/test splits and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each use puts before the key, so that a sample does not decide about the split.
SPLIT, SAMPLE = "split", "sample"
_RANGE = 1 << 32


def hash_bucket(key: Column, salt: str) -> Column:
    """32 bits from the MD5 of the salted key's text: the same under any partitioning and in any engine.

    A null key counts as an empty text.
    """
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def in_train(key: Column, train: float = 0.8) -> Column:
    return hash_bucket(key, SPLIT) < F.lit(train * _RANGE)


def hash_split(df: DataFrame, key: str = "A_INCIDENT_ID", train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Reproducible train and test parts; disjoint, and together all rows."""
    train_row = in_train(F.col(key), train)
    return df.filter(train_row), df.filter(~train_row)


def random_split(
    df: DataFrame, weights: tuple[float, ...] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Spark's own random split; its rows depend on the partitioning of the input."""
    return df.randomSplit(list(weights), seed=seed)


def stratified_sample(
    df: DataFrame, fractions: dict[str, float], label: str = "INCIDENT_TYPE", key: str = "A_INCIDENT_ID"
) -> DataFrame:
    """A share of each label's rows, reproducible by key; labels without a fraction are left out."""
    share = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v * _RANGE)))])
    return df.filter(hash_bucket(F.col(key), SAMPLE) < F.try_element_at(share, F.col(label)))
