"""Classification of incident types with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.operators.multihot import MultiHot
from precinct.schema import CATEGORICAL, NUMERIC
from precinct.session import spread_evenly

# Training rows of a partition: a forest of 50 trees keeps some 1.4 KB for each and reads that again for every group of nodes.
PARTITION_ROWS = 1 << 17
# Partitions for few training rows.
LEAST_PARTITIONS = 8


def train_partitions(rows: int) -> int:
    """Partitions for so many training rows: they grow in number and not in size, and depend on the data alone."""
    return max(LEAST_PARTITIONS, -(-rows // PARTITION_ROWS))


def category_indexer(columns: Sequence[str] = CATEGORICAL) -> StringIndexer:
    """One indexer for all categorical columns, so that one pass fits them all; unseen and null get an index."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def encoder(columns: Sequence[str] = CATEGORICAL) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns], dropLast=True
    )


def assembler(
    categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC, vectors: Sequence[str] = ()
) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[f"{c}_ohe" for c in categorical] + list(numeric) + list(vectors), outputCol="features", handleInvalid="keep"
    )


def label_indexer(column: str = "INCIDENT_TYPE") -> StringIndexer:
    """Labels by frequency; rows with a label unseen in training are dropped when scoring."""
    return StringIndexer(inputCol=column, outputCol="label", handleInvalid="skip")


def _logistic(max_iter: int = 50, **params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="label", family="multinomial", maxIter=max_iter, **params
    )


def _forest(
    num_trees: int = 50, max_depth: int = 12, seed: int = 42, cacheNodeIds: bool = True, **params
) -> RandomForestClassifier:
    """Rows remember the node they are in (one int per tree), which saves walking all trees again for each
    level; the ids are checkpointed in ``spark.checkpoint.dir`` as the levels go on."""
    return RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        cacheNodeIds=cacheNodeIds,
        **params,
    )


CLASSIFIERS = {"lr": _logistic, "rf": _forest}


def classifier(name: str, **params) -> Estimator:
    """"lr" or "rf"; further parameters (``weightCol``, ``aggregationDepth``, ...) go to the estimator."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown algorithm: {name}")
    return CLASSIFIERS[name](**params)


def build_pipeline(
    name: str = "lr",
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    multi_hot: dict[str, Sequence[str]] | None = None,
    min_share: float = 0.001,
    **params,
) -> Pipeline:
    """Indexers, encoder, assembler and classifier; further ``params`` go to the classifier.

    ``multi_hot`` gives further features: the name of a vector and the columns whose values it holds; values in less than
    ``min_share`` of the training rows share a place.
    """
    multi_hot = multi_hot or {}
    return Pipeline(
        stages=[
            category_indexer(categorical),
            encoder(categorical),
            *[MultiHot(inputCols=list(columns), outputCol=out, minShare=min_share) for out, columns in multi_hot.items()],
            assembler(categorical, numeric, list(multi_hot)),
            label_indexer(),
            classifier(name, **params),
        ]
    )


def labels_by_count(cells: DataFrame, columns: Sequence[str], weight: str = "n") -> dict[str, list[str]]:
    """The values of each column by frequency and then by name, nulls left out, from counted cells.

    The order of a fitted indexer; the dictionaries come to the driver, as every indexer's do.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = cells.select(F.inline(pairs), weight).filter("value is not null").groupBy("column", "value")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(counts.agg(F.sum(weight).alias("n")).filter("n > 0").collect(), key=lambda r: (-r["n"], r["value"])):
        out[row["column"]].append(row["value"])
    return out


def pipeline_with_counts(
    name: str,
    cells: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    weight: str = "n",
    **params,
) -> Pipeline:
    """``build_pipeline`` with indexers from the counted ``cells`` of the training rows: only the classifier is left to fit."""
    values = labels_by_count(cells, [*categorical, "INCIDENT_TYPE"], weight)
    categories = [StringIndexerModel.from_labels(values[c], c, f"{c}_idx", "keep") for c in categorical]
    labels = StringIndexerModel.from_labels(values["INCIDENT_TYPE"], "INCIDENT_TYPE", "label", "skip")
    return Pipeline(
        stages=[*categories, encoder(categorical), assembler(categorical, numeric), labels, classifier(name, **params)]
    )


def input_columns(pipeline: Pipeline | PipelineModel) -> list[str]:
    """Columns of the incidents that the stages read, in order of first use."""
    stages = pipeline.stages if isinstance(pipeline, PipelineModel) else pipeline.getStages()
    made: set[str] = set()
    needed: list[str] = []
    for stage in stages:
        for param in ("inputCols", "inputCol", "weightCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                needed += [value] if isinstance(value, str) else value
        for param in ("outputCols", "outputCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                made.update([value] if isinstance(value, str) else value)
    return [c for c in dict.fromkeys(needed) if c and c not in made]


def ordered_flags(rows: DataFrame, max_bins: int, column: str = "features") -> DataFrame:
    """``rows`` whose vector declares more values for its 0/1 places than MLlib tries in all subsets for several classes.

    With so many values a forest adds each row to a bin by the value, where it would ask sets of values otherwise, which takes
    most of the time of its passes. Values beyond 1 do not occur and their bins stay empty, so that the one split of a
    place, 0 against 1, and its gain are the same. There have to be ``max_bins`` rows.
    """
    attributes = dict(rows.schema[column].metadata.get("ml_attr", {}))
    kinds = dict(attributes.get("attrs", {}))
    values = (max_bins // 2 + 1).bit_length() + 1
    if "binary" not in kinds or values > max_bins:
        return rows
    flags = [{k: v for k, v in a.items() if k in ("idx", "name")} | {"num_vals": values} for a in kinds.pop("binary")]
    attributes["attrs"] = kinds | {"nominal": [*kinds.get("nominal", []), *flags]}
    return rows.withMetadata(column, rows.schema[column].metadata | {"ml_attr": attributes})


@contextmanager
def _forest_rows(rows: DataFrame, forest: RandomForestClassifier) -> Iterator[DataFrame]:
    """The columns that a forest reads, assembled once and kept on the executors' disks in their partitions: it passes over
    them four times before it has rows of its own in memory."""
    columns = [forest.getLabelCol(), forest.getFeaturesCol()]
    if forest.isDefined("weightCol") and forest.getWeightCol():
        columns.append(forest.getWeightCol())
    kept = rows.select(*columns).persist(StorageLevel.DISK_ONLY)
    try:
        enough = kept.limit(forest.getMaxBins()).count() == forest.getMaxBins()
        yield ordered_flags(kept, forest.getMaxBins(), forest.getFeaturesCol()) if enough else kept
    finally:
        kept.unpersist()


def _fit_last(estimator: Estimator, rows: DataFrame) -> Model:
    if not isinstance(estimator, RandomForestClassifier):
        return Pipeline(stages=[estimator]).fit(rows).stages[0]
    with _forest_rows(rows, estimator) as kept:
        return estimator.fit(kept)


def fit(
    pipeline: Pipeline,
    train: DataFrame,
    partitions: int | Callable[[int], int] | None = None,
    keys: Sequence[str] = ("A_INCIDENT_ID",),
) -> PipelineModel:
    """Fit on the columns the pipeline needs.

    With ``partitions`` the rows are first brought into that many partitions by ``keys``, so that the model does
    not depend on how they are stored; a function (``train_partitions``) gives the number for the count of the rows. Only
    the last estimator sees these partitions: the stages before it count values, which take one narrow pass each over the
    rows as they are stored. Only a forest's assembled rows are persisted here, on disk while it is fitted; the estimators
    keep their own blocks. A ``train`` that is costly to compute should be a table (``session.materialize``).
    """
    needed = input_columns(pipeline)
    *before, last = pipeline.getStages()
    if partitions is None:
        rows = train.select(*needed)
        prepared = Pipeline(stages=before).fit(rows)
    else:
        if callable(partitions):
            partitions = partitions(train.count())
        prepared = Pipeline(stages=before).fit(train.select(*needed))
        rows = spread_evenly(train.select(*dict.fromkeys([*needed, *keys])), partitions, *keys)
    return PipelineModel(stages=[*prepared.stages, _fit_last(last, prepared.transform(rows))])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def label_names(model: PipelineModel) -> list[str]:
    """Label names of a fitted pipeline; the stage is found by its output column."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isDefined("outputCol") and stage.getOutputCol() == "label":
            return list(stage.labels)
    raise ValueError("the pipeline has no label indexer")


def category_sizes(model: PipelineModel) -> dict[str, int]:
    """Number of known values of each categorical column of a fitted pipeline."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet("inputCols"):
            return {c: len(v) for c, v in zip(stage.getInputCols(), stage.labelsArray)}
    raise ValueError("the pipeline has no category indexer")


def vector_size(scored: DataFrame, column: str = "features") -> int:
    """Width of an assembled vector column, from its metadata."""
    return int(scored.schema[column].metadata["ml_attr"]["num_attrs"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def class_weights(train: DataFrame, label: str = "INCIDENT_TYPE") -> DataFrame:
    """Balanced weight per label: rows / (labels * rows of the label)."""
    return balanced_weights(train.groupBy(label).agg(F.count("*").alias("count")), label)


def balanced_weights(counts: DataFrame, label: str = "INCIDENT_TYPE") -> DataFrame:
    """``class_weights`` from the number of training rows of each label."""
    counts = counts.filter(F.col(label).isNotNull())
    total = counts.agg(F.struct(F.sum("count").alias("rows"), F.count("*").alias("labels"))).scalar()
    return counts.select(
        label, "count", (total["rows"] / (total["labels"] * F.col("count"))).alias("weight")
    )


def add_weights(train: DataFrame, weights: DataFrame, label: str = "INCIDENT_TYPE") -> DataFrame:
    """Rows with the weight of their label, null for a label without one. The weights hold one entry per label, as a map."""
    entries = F.collect_list(F.struct(label, "weight"))
    weight = weights.agg(F.map_from_entries(entries)).scalar()
    return train.withColumn("weight", F.try_element_at(weight, F.col(label)))
