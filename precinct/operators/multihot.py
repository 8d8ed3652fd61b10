"""One multi-hot vector for several columns that share a dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of known values and of the place for all others, so that no value can be taken for that place.
_KNOWN, RARE = "=", "?"


def present_values(columns: Sequence[str]) -> Column:
    """The distinct values of a row in these columns, as texts; nulls are none."""
    every = F.array(*[F.col(c).cast("string") for c in columns])
    return F.array_distinct(F.filter(every, lambda v: v.isNotNull()))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value, count): the rows that have the value in at least one of the columns."""
    return df.select(F.explode(present_values(columns)).alias("value")).groupBy("value").agg(F.count("*").alias("count"))


class _MultiHotParams(HasInputCols, HasOutputCol):
    minShare = Param(Params._dummy(), "minShare", "least share of the rows that a value of its own is in", TypeConverters.toFloat)
    maxValues = Param(Params._dummy(), "maxValues", "most values with places of their own", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(minShare=0.001, maxValues=10_000)

    def getMinShare(self) -> float:
        return self.getOrDefault(self.minShare)

    def getMaxValues(self) -> int:
        return self.getOrDefault(self.maxValues)


class MultiHot(Estimator, _MultiHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the dictionary that several columns share: values by frequency and then by name.

    Values in less than ``minShare`` of the rows, and those beyond the first ``maxValues``, share one last place. Only
    the values with places of their own come to the driver.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, minShare=None, maxValues=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MultiHotModel:
        rows = dataset.agg(F.count("*")).scalar()
        counts = value_counts(dataset, self.getInputCols()).filter(F.col("count") >= self.getMinShare() * rows)
        kept = counts.orderBy(F.desc("count"), "value").limit(self.getMaxValues()).collect()
        model = MultiHotModel(inputCols=self.getInputCols(), outputCol=self.getOutputCol(), values=[r["value"] for r in kept])
        return model._resetUid(self.uid)


class MultiHotModel(Model, _MultiHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """A sparse vector with a one for each value of the row's columns, and at the last place for any value without its own.

    A value that stands in two columns counts once; a row without values is all zeros.
    """

    values = Param(Params._dummy(), "values", "values with places of their own", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, values=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getValues(self) -> list[str]:
        return self.getOrDefault(self.values)

    def size(self) -> int:
        return len(self.getValues()) + 1

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values, out = self.getValues(), self.getOutputCol()
        mark = lambda v: F.when(v.isin(values), F.concat(F.lit(_KNOWN), v)).otherwise(F.lit(RARE))
        marks = F.transform(present_values(self.getInputCols()), mark)
        places = CountVectorizerModel.from_vocabulary([_KNOWN + v for v in values] + [RARE], f"{out}__marks", out)
        return places.setBinary(True).transform(dataset.withColumn(f"{out}__marks", marks)).drop(f"{out}__marks")
