import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from precinct.operators import (
    add_weights,
    build_pipeline,
    category_index,
    class_weights,
    classifier,
    confusion,
    fit,
    global_metrics,
    hash_split,
    label_dictionary,
    label_names,
    load_model,
    random_split,
    save_model,
    score,
    split_cells,
    stratified_sample,
)
from precinct.operators import ml
from precinct.schema import CATEGORICAL, NUMERIC


@pytest.fixture(scope="module")
def parts(features):
    return hash_split(features)


@pytest.fixture(scope="module")
def lr(parts):
    return fit(build_pipeline("lr"), parts[0])


def test_split_is_a_partition(features, parts):
    train, test = parts
    assert train.count() + test.count() == features.count()
    assert train.join(test, "A_INCIDENT_ID").count() == 0
    again = hash_split(features.repartition(5))[0]
    assert again.select("A_INCIDENT_ID").exceptAll(train.select("A_INCIDENT_ID")).count() == 0


def test_random_split_covers(features):
    train, test = random_split(features)
    assert train.count() + test.count() == features.count()


def test_stratified_sample(features):
    sample = stratified_sample(features, {"THEFT": 1.0, "OTHER": 0.5})
    got = {r[0]: r[1] for r in sample.groupBy("INCIDENT_TYPE").count().collect()}
    full = {r[0]: r[1] for r in features.groupBy("INCIDENT_TYPE").count().collect()}
    assert set(got) == {"THEFT", "OTHER"} and got["THEFT"] == full["THEFT"] and got["OTHER"] < full["OTHER"]


def test_label_order_is_the_dictionary(features, lr):
    labels = [r["INCIDENT_TYPE"] for r in label_dictionary(split_cells(features, [])).orderBy("label").collect()]
    assert label_names(lr) == labels


def test_category_order_is_the_index(parts, lr):
    rows = category_index(parts[0], CATEGORICAL).orderBy("column", "idx").collect()
    indexer = next(s for s in lr.stages if isinstance(s, StringIndexerModel) and s.isSet("inputCols"))
    for name, values in zip(indexer.getInputCols(), indexer.labelsArray):
        assert list(values) == [r["value"] for r in rows if r["column"] == name]


def test_feature_vector(parts, lr):
    scored = score(lr, parts[1])
    sizes = ml.category_sizes(lr)
    assert ml.vector_size(scored) == sum(sizes.values()) + len(NUMERIC)
    unseen = parts[1].limit(1).withColumn("state", F.lit("nowhere")).withColumn("HOUR_BUCKET", F.lit(None).cast("string"))
    row = score(lr, unseen).select("state_idx", "state_ohe", "HOUR_BUCKET_ohe").first()
    assert row["state_idx"] == sizes["state"] and row["state_ohe"].numNonzeros() == 0 and row["HOUR_BUCKET_ohe"].numNonzeros() == 0


def test_unseen_label_is_dropped(parts, lr):
    three = parts[1].limit(3).withColumn(
        "INCIDENT_TYPE", F.when(F.monotonically_increasing_id() % 2 == 0, F.lit("NEW")).otherwise(F.col("INCIDENT_TYPE"))
    )
    known = three.filter("INCIDENT_TYPE <> 'NEW'").count()
    assert score(lr, three).count() == known


def test_lr_learns_the_planted_signal(parts, lr):
    assert global_metrics(confusion(score(lr, parts[1]))).first()["accuracy"] > 0.5


def test_rf_learns_the_planted_signal(parts):
    model = fit(build_pipeline("rf", num_trees=10, max_depth=6), parts[0])
    assert global_metrics(confusion(score(model, parts[1]))).first()["accuracy"] > 0.5


def test_model_roundtrip(parts, lr, tmp_path):
    path = str(tmp_path / "model")
    save_model(lr, path)
    save_model(lr, path)  # overwrites
    a, b = (score(m, parts[1]).select("A_INCIDENT_ID", "prediction") for m in (lr, load_model(path)))
    assert a.exceptAll(b).count() == 0


def test_defaults_and_choice():
    assert classifier("rf").getNumTrees() == 50 and classifier("rf").getMaxDepth() == 12 and classifier("rf").getSeed() == 42
    assert classifier("lr").getMaxIter() == 50 and classifier("lr").getFamily() == "multinomial"
    with pytest.raises(ValueError):
        classifier("svm")


def test_only_needed_columns_are_kept():
    assert ml.input_columns(build_pipeline("lr")) == [*CATEGORICAL, *NUMERIC, "INCIDENT_TYPE"]
    assert ml.input_columns(build_pipeline("lr", weightCol="weight"))[-1] == "weight"


def test_class_weights(parts):
    weights = class_weights(parts[0])
    rows = weights.collect()
    total = sum(r["count"] for r in rows)
    assert all(r["weight"] == pytest.approx(total / len(rows) / r["count"]) for r in rows)
    weighted = add_weights(parts[0], weights)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(total)
    model = fit(build_pipeline("lr", max_iter=3, weightCol="weight"), weighted)
    assert score(model, parts[1]).count() > 0


def test_forest_depends_on_the_partitions_parameter_alone(features, parts):
    """The same rows, stored in other partitions, give the same predictions."""
    train, test = parts
    columns = [*CATEGORICAL, *NUMERIC, "INCIDENT_TYPE", "A_INCIDENT_ID"]
    found = []
    for stored in (2, 7):
        model = fit(build_pipeline("rf", num_trees=5, max_depth=5), train.select(*columns).repartition(stored), 4)
        found.append({r[0]: r[1] for r in score(model, test).select("A_INCIDENT_ID", "prediction").collect()})
    assert found[0] == found[1]


def _known_rows(spark, n):
    """Incidents of three types that state, month and offenses tell apart, with some noise."""
    i = F.col("id")
    kind = F.when(i % 13 == 0, "OTHER").when((i % 5 == 0) | (i % 7 == 3), "THEFT").otherwise("VIOLENCE")
    return spark.range(n).select(
        (i % 5).cast("string").alias("state"), F.when(i % 2 == 0, "FIN_SEMANA").otherwise("DIA_SEMANA").alias("TIPO_DIA"),
        (i % 11).cast("string").alias("HOUR_BUCKET"), (i % 7).cast("string").alias("MONTH"),
        *[((i * 31 + k) % (k + 2)).cast("int").alias(c) for k, c in enumerate(NUMERIC)],
        kind.alias("INCIDENT_TYPE"), i.cast("string").alias("A_INCIDENT_ID"),
    )


def test_forest_gets_ordered_flags_from_kept_rows(spark, monkeypatch):
    """A forest sees no place of two values, which it would try in all subsets, and rows that are assembled once and given back."""
    seen = {}
    whole = ml.RandomForestClassifier._fit

    def spied(self, dataset):
        attributes = dataset.schema["features"].metadata["ml_attr"]["attrs"]
        seen.update(kinds=set(attributes), values={a["num_vals"] for a in attributes.get("nominal", [])})
        seen.update(parts=dataset.rdd.getNumPartitions(), plan=dataset._jdf.queryExecution().executedPlan().toString())
        return whole(self, dataset)

    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", spied)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = _known_rows(spark, 600)
    model = fit(build_pipeline("rf", num_trees=3, max_depth=3), rows, 5)
    assert seen["kinds"] == {"nominal", "numeric"} and seen["values"] == {6} and seen["parts"] == 5
    assert "InMemoryTableScan" in seen["plan"]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert model.stages[-1].getNumTrees == 3 and score(model, rows).count() == 600


def test_ordered_flags_give_the_same_tree(spark):
    """Without chance (one tree, all features) each row has the same probabilities, and the tree the same size."""
    rows = _known_rows(spark, 900)
    *before, forest = build_pipeline("rf", num_trees=1, max_depth=6, featureSubsetStrategy="all").getStages()
    prepared = ml.Pipeline(stages=before).fit(rows).transform(rows)
    plain, ordered = forest.fit(prepared), forest.fit(ml.ordered_flags(prepared, forest.getMaxBins()))
    assert "binary" in prepared.schema["features"].metadata["ml_attr"]["attrs"]
    assert plain.totalNumNodes == ordered.totalNumNodes > 9 and plain.trees[0].depth == ordered.trees[0].depth
    found = [{r[0]: tuple(r[1]) for r in m.transform(prepared).select("A_INCIDENT_ID", "probability").collect()} for m in (plain, ordered)]
    assert found[0] == found[1]


@pytest.mark.parametrize("n", [4, 31, 32])
def test_forest_of_few_rows(spark, n):
    model = fit(build_pipeline("rf", num_trees=2, max_depth=2), _known_rows(spark, n), 2)
    assert score(model, _known_rows(spark, n)).count() == n


def test_small_fractions_and_null_keys(spark):
    df = spark.range(20_000).selectExpr("id AS k", "'A' AS label").unionByName(
        spark.range(5).selectExpr("CAST(NULL AS BIGINT) AS k", "'A' AS label")
    )
    train, test = hash_split(df, "k", 0.999)
    assert train.count() + test.count() == 20_005 and 5 <= test.count() <= 45
    sample = stratified_sample(df, {"A": 0.004}, "label", "k")
    assert 45 <= sample.count() <= 125
    assert stratified_sample(df, {"A": 1.0}, "label", "k").count() == 20_005
    inside = stratified_sample(df, {"A": 0.5}, "label", "k")
    share = hash_split(inside, "k")[1].count() / inside.count()
    assert 0.17 < share < 0.23  # the sample does not decide about the split
