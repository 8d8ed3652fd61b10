"""Metrics against MLlib's evaluator and against plain Python on random predictions."""

import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from precinct.operators import (
    accuracy,
    category_index,
    confusion,
    evaluate,
    global_metrics,
    index_to_name,
    label_dictionary,
    majority_predictions,
    name_to_index,
    per_class_metrics,
    split_cells,
    weighted_f1,
)

NAMES = ["OTHER", "THEFT", "DRUG", "SEX"]


@pytest.fixture(scope="module")
def preds(spark):
    rng = random.Random(7)
    rows = [(float(rng.choice([0, 0, 0, 1, 1, 2])), float(rng.choice([0, 1, 1, 2]))) for _ in range(500)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_equal_to_mllib(preds):
    got = global_metrics(confusion(preds)).first()
    for metric, value in (("accuracy", got["accuracy"]), ("f1", got["f1"])):
        assert MulticlassClassificationEvaluator(metricName=metric).evaluate(preds) == pytest.approx(value, abs=1e-12)
    assert accuracy(preds).first()[0] == got["accuracy"]
    assert weighted_f1(preds).first()[0] == got["f1"]
    assert got["scored_rows"] == 500


def test_per_class(preds):
    rows = [(int(r[0]), int(r[1])) for r in preds.collect()]
    actual, predicted = Counter(a for a, _ in rows), Counter(p for _, p in rows)
    hit = Counter(a for a, p in rows if a == p)
    got = per_class_metrics(confusion(preds), NAMES).collect()
    assert [r["class"] for r in got] == NAMES
    for i, r in enumerate(got):
        p = hit[i] / predicted[i] if predicted[i] else 0.0
        q = hit[i] / actual[i] if actual[i] else 0.0
        f = 2 * p * q / (p + q) if p + q else 0.0
        assert (r["support"], r["precision"], r["recall"], r["f1"]) == (actual[i], round(p, 6), round(q, 6), round(f, 6))


def test_weighted_cells_equal_rows(preds):
    cells = preds.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    assert sorted(confusion(cells, "n").collect()) == sorted(confusion(preds).collect())


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    got = {r["class"]: r for r in per_class_metrics(confusion(df), NAMES[:2]).collect()}
    assert tuple(got["OTHER"])[1:] == (1, 0.0, 0.0, 0.0)


def test_unknown_index_shows_as_number(spark):
    df = spark.createDataFrame([(0.0, 9.0)], "label double, prediction double")
    assert tuple(index_to_name(confusion(df), NAMES).first()) == ("OTHER", "9", 1)


def test_evaluation_bundle(preds):
    e = evaluate(preds, NAMES)
    table = {(r["class"], r["metric"]): r["value"] for r in e.as_table().collect()}
    assert table["all", "support"] == 500
    assert len(table) == 4 * len(NAMES) + 3
    assert e.named.count() == e.confusion.count()


def test_majority_with_unseen_group_and_label(spark):
    rows = [("a", "X", True, 3), ("a", "Y", True, 3), ("b", "Z", True, 1), ("a", "Z", False, 2), ("c", "Q", False, 1),
            (None, "Y", True, 9), (None, "X", False, 4)]
    cells = spark.createDataFrame(rows, "g string, INCIDENT_TYPE string, is_train boolean, n bigint")
    got = {(r["label"], r["prediction"], r["n"]) for r in majority_predictions(cells, ["g"]).collect()}
    # a: X and Y tie, the first name wins; c is not in training: overall most frequent; null is a group
    assert got == {("Z", "X", 2), ("Q", "Y", 1), ("X", "Y", 4)}
    labels = label_dictionary(cells)
    assert [tuple(r) for r in labels.orderBy("label").collect()] == [(0.0, "Y", 12), (1.0, "X", 3), (2.0, "Z", 1)]
    indexed = name_to_index(majority_predictions(cells, ["g"]), labels)
    assert {tuple(r) for r in indexed.collect()} == {(2.0, 1.0, 2), (1.0, 0.0, 4)}  # Q was never seen in training


def test_cells_equal_row_level_predictions(features):
    """The confusion table from aggregated cells equals that of predictions joined row by row."""
    rows = features.select("A_INCIDENT_ID", "state", "INCIDENT_TYPE").toPandas()
    import hashlib

    part = rows["A_INCIDENT_ID"].map(lambda i: int(hashlib.md5(f"split{i}".encode()).hexdigest()[:8], 16) / 2**32)
    train, test = rows[part < 0.8], rows[part >= 0.8]
    best = {}
    for state, part in train.groupby("state"):
        best[state] = min(Counter(part["INCIDENT_TYPE"]).items(), key=lambda kv: (-kv[1], kv[0]))[0]
    expected = Counter((t, best[s]) for s, t in zip(test["state"], test["INCIDENT_TYPE"]))
    preds = majority_predictions(split_cells(features, ["state"]), ["state"])
    got = {(r["label"], r["prediction"]): r["count"] for r in confusion(preds, "n").collect()}
    assert got == dict(expected)


def test_category_index_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None), ("b", "2")], "x string, y string")
    got = {(r["column"], r["value"]): r["idx"] for r in category_index(df, ["x", "y"]).collect()}
    assert got == {("x", "b"): 0.0, ("x", "a"): 1.0, ("y", "1"): 0.0, ("y", "2"): 1.0}
