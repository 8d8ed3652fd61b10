"""Mixed headers, broken summaries, trends, multi-hot features, counters, weights and spread ranks."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from precinct.operators import counters, metrics, ml, rank, runs, split
from precinct.operators.multihot import MultiHot
from precinct.plans import train_and_evaluate
from precinct.schema import CATEGORICAL, SUMMARY_SCHEMA
from precinct.sources import incidents, publish_metrics, read_incidents_csv, read_metrics, read_result_csv, read_run_summaries


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_files_with_their_own_headers(spark, tmp_path):
    put(tmp_path / "a.csv", "incident_number,state,total_offense,hour\n001,Ohio,2,10\nx2,Utah,NA,\n")
    put(tmp_path / "b.csv", "hour, State ,ORI,total_offense,incident_number\n11,Iowa,O7,3.0,9\n")
    put(tmp_path / "deep" / "c.csv", "ori,incident_number\nO8,10\n")
    put(tmp_path / "d.csv", "")
    put(tmp_path / "e.csv", "total_offense,incident_number\n")
    put(tmp_path / "f.txt", "no,csv\n1,2\n")
    df = read_incidents_csv(spark, str(tmp_path), file_filter="*.csv", by_header=True)
    assert df.columns == ["incident_number", "state", "hour", "total_offense", "ORI"]
    assert dict(df.dtypes)["total_offense"] == "int" and dict(df.dtypes)["incident_number"] == "string"
    assert sorted(map(tuple, df.collect())) == sorted(
        [("001", "Ohio", "10", 2, None), ("x2", "Utah", None, None, None), ("9", "Iowa", "11", 3, "O7"), ("10", None, None, None, "O8")]
    )


def test_no_files(spark, tmp_path):
    put(tmp_path / "a.csv", "")
    assert read_incidents_csv(spark, str(tmp_path), by_header=True).count() == 0


def test_many_headers_are_read_in_groups(spark, tmp_path):
    for i in range(30):
        names = ["incident_number", "state"] if i % 2 else ["state", "incident_number"]
        put(tmp_path / f"{i}.csv", ",".join(names) + f"\n{i},{i}\n")
    df = read_incidents_csv(spark, str(tmp_path), by_header=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert df.filter("state = incident_number").count() == 30


GOOD = '{"algorithm": "a", "run_timestamp": "%s", "total_runtime_seconds": %s, "timings_seconds": {"x": 1.5, "y": 2}}'


def test_broken_summaries_are_no_runs(spark, tmp_path):
    put(tmp_path / "good.json", GOOD % ("1", "7") + "\n" + GOOD % ("0", "null") + "\n")
    put(tmp_path / "cut.json", GOOD[:30] + "\n")
    put(tmp_path / "typed.json", '{"algorithm": "a", "records_total": "many"}\n')
    put(tmp_path / "other.json", '{"something": 1}\n')
    put(tmp_path / "blank.json", "")
    assert read_run_summaries(spark, str(tmp_path)).count() == 2
    every = read_run_summaries(spark, str(tmp_path), rejects=True).collect()
    assert sorted((r["file_name"], r["broken"] is None) for r in every) == [
        ("cut.json", False), ("good.json", True), ("good.json", True), ("other.json", False), ("typed.json", False)
    ]
    assert all(r["algorithm"] is None for r in every if r["broken"])
    put(tmp_path / "indented" / "one.json", (GOOD % ("1", "7")).replace(",", ",\n"))
    assert read_run_summaries(spark, str(tmp_path / "indented"), multi_line=True).count() == 1


def test_runs_fall_back_to_wall_time(spark, tmp_path):
    now = datetime.now()
    names = ["total", "phases", "zero", "broken", "stale", "two"]
    for name, total in (("total", "7"), ("phases", "null"), ("zero", "0"), ("stale", "7")):
        put(tmp_path / f"{name}.json", GOOD % ("1", total) + "\n")
    put(tmp_path / "broken.json", "{")
    put(tmp_path / "two.json", "oops\n" + GOOD % ("2", "8") + "\n" + GOOD % ("1", "9") + "\n")
    old = time.time() - 7200
    os.utime(tmp_path / "stale.json", (old, old))
    rows = [(i, 2, f"{n}.json", now - timedelta(hours=1), 100.0) for i, n in enumerate([*names, "missing"])]
    planned = spark.createDataFrame(rows, "run int, workers int, summary_file string, started timestamp, wall_seconds double")
    found = runs.recorded_runs(planned, read_run_summaries(spark, str(tmp_path), rejects=True)).orderBy("run").collect()
    assert [(r["runtime_seconds"], r["source"], r["summary"]) for r in found] == [
        (7.0, "total", "good"), (3.5, "phases", "good"), (100.0, "wall", "empty"), (100.0, "wall", "broken"),
        (100.0, "wall", "stale"), (9.0, "total", "good"), (100.0, "wall", "missing"),
    ]


def summaries(spark, rows):
    df = spark.createDataFrame(rows, "algorithm string, run_timestamp string, accuracy double, f1 double")
    df = df.withColumn("metrics", F.struct("accuracy", "f1"))
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])


def test_publishing_again_replaces_and_trends_follow(spark, tmp_path):
    path = str(tmp_path / "metrics")
    first = summaries(spark, [("lr (x)", "t1", 0.5, 0.4), ("lr (x)", "t2", 0.7, 0.6), ("rf", "t1", 0.1, 0.1)])
    publish_metrics(first, path)
    publish_metrics(first, path)
    publish_metrics(summaries(spark, [("lr (x)", "t3", 0.6, 0.5), ("lr (x)", "t4", 0.8, 0.2)]), path)
    got = runs.metric_trend(read_metrics(spark, path), 2).orderBy("algorithm", "run").collect()
    assert [(r["algorithm"], r["run"]) for r in got] == [("lr (x)", 1), ("lr (x)", 2), ("lr (x)", 3), ("lr (x)", 4), ("rf", 1)]
    assert got[0]["f1_change"] is None and got[1]["f1_change"] == pytest.approx(0.2) and got[3]["accuracy_change"] == pytest.approx(0.2)
    assert [r["accuracy_mean"] for r in got] == pytest.approx([0.5, 0.6, 0.65, 0.7, 0.1])
    assert [r["is_best"] for r in got] == [True, True, False, False, True]


def test_publishing_many_runs_writes_few_files(spark, tmp_path):
    """No folder or file for each run; keys that are null or repeat within a call are one run with all rows of its last call."""
    path = tmp_path / "metrics"
    first = summaries(spark, [("a", f"t{i % 300}", i / 1000, 0.5) for i in range(302)]).coalesce(2)
    key = F.when(F.col("run_timestamp") != "t7", F.col("run_timestamp"))
    publish_metrics(first, str(path), key)
    assert len(list(path.rglob("*.parquet"))) <= 2
    publish_metrics(first.filter("run_timestamp in ('t1', 't2', 't7')").withColumn("metrics", F.struct(F.lit(1.0).alias("accuracy"), F.lit(2.0).alias("f1"))), str(path), key)
    got = read_metrics(spark, str(path))
    assert got.columns == [*SUMMARY_SCHEMA.names, "run_key"] and got.count() == 302
    found = {(r["run_key"], r["accuracy"]): r["count"] for r in got.groupBy("run_key", "metrics.accuracy").count().collect()}
    assert found[("t1", 1.0)] == 2 and found[("t2", 1.0)] == 1 and found[(None, 1.0)] == 1 and ("t1", 0.001) not in found
    assert found[("t0", 0.0)] == found[("t0", 0.3)] == found[("t8", 0.008)] == 1


def test_multi_hot(spark, tmp_path):
    rows = [(1, "a", "b"), (2, "b", "a"), (3, "a", "a"), (4, "rare", "also rare"), (5, None, None), (6, "a", "="), (7, None, "b")]
    df = spark.createDataFrame(rows, "id int, x string, y string")
    model = Pipeline(stages=[MultiHot(inputCols=["x", "y"], outputCol="v", minShare=0.3)]).fit(df)
    assert model.stages[0].getValues() == ["a", "b"] and model.stages[0].size() == 3
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        out = m.transform(spark.createDataFrame([*rows, (8, "new", "b")], df.schema))
        got = {r["id"]: r["v"] for r in out.select("id", vector_to_array("v").alias("v")).collect()}
        assert got == {
            1: [1, 1, 0], 2: [1, 1, 0], 3: [1, 0, 0], 4: [0, 0, 1], 5: [0, 0, 0], 6: [1, 0, 1], 7: [0, 1, 0], 8: [0, 1, 1]
        }
        assert out.columns == ["id", "x", "y", "v"] and out.schema["v"].metadata["ml_attr"]["num_attrs"] == 3
    most = MultiHot(inputCols=["x", "y"], outputCol="v", minShare=0.0, maxValues=1).fit(df)
    assert most.getValues() == ["a"]
    nothing = MultiHot(inputCols=["x", "y"], outputCol="v").fit(df.limit(0)).transform(df)
    assert {tuple(r[0]) for r in nothing.select(vector_to_array("v")).collect()} == {(1.0,), (0.0,)}


def test_counters(spark):
    rows = [(1, "victim", 5, "F"), (1, "victim", 40, "M"), (1, "offender", 17, None), (2, "victim", None, "F"), (None, "victim", 3, "F")]
    persons = spark.createDataFrame(rows, "k int, role string, age int, sex string")
    found = counters.conditional_counters(persons, "k", counters.demographic_conditions())
    df = counters.add_counters(spark.range(1, 4).select(F.col("id").cast("int").alias("k")), found, "k")
    names = ["minor_victims", "female_victims", "male_victims", "minor_offenders", "female_offenders", "male_offenders"]
    assert df.columns == ["k", *names]
    assert {r[0]: tuple(r[1:]) for r in df.collect()} == {1: (1, 1, 1, 1, 0, 0), 2: (0, 1, 0, 0, 0, 0), 3: (0,) * 6}


def test_spread_ranks_equal_the_window(spark, features):
    from precinct.operators import category_index

    got = rank.ranked_values(features, CATEGORICAL, 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, category_index(features, CATEGORICAL).select(*got.columns).collect()))


def test_ranks_of_a_key(spark):
    """Ties by the thousand and one hot value: places are dense and no window sees a whole column."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 2000).cast("string")).alias("k"), F.when(F.col("id") > 5, "s").alias("c")
    )
    ranks = rank.ranked_values(df, ["k", "c"], 7)
    rows = [r for r in ranks.collect() if r["column"] == "k"]
    order = sorted(rows, key=lambda r: (-r["count"], r["value"]))
    assert [r["idx"] for r in order] == list(range(len(order))) and order[0]["value"] == "hot"
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    indexed = rank.with_ranks(df.union(spark.createDataFrame([("never", None)], df.schema)), ranks, ["k", "c"])
    assert indexed.count() == 20_001
    assert indexed.filter("k = 'never'").first()["k_idx"] == len(order) and indexed.filter("c is null").first()["c_idx"] == 1.0


def test_weighted_job(spark, folder, tmp_path):
    raw = incidents(spark, folder)
    summary = train_and_evaluate(spark, raw, str(tmp_path), "lr", partitions=2, weighted=True, max_iter=5).first()
    plain = read_result_csv(spark, f"{tmp_path}/per_class_metrics_lr")
    weighted = read_result_csv(spark, f"{tmp_path}/per_class_metrics_lr_weighted")
    both = plain.select("class", F.col("support").alias("n")).join(weighted, "class").collect()
    assert sum(r["n"] for r in both) == summary["test_rows"]
    model = ml.load_model(summary["model_path"])
    from precinct.operators import derive

    train, test = split.hash_split(derive(raw))
    weights = {r["INCIDENT_TYPE"]: r["weight"] for r in ml.class_weights(train).collect()}
    assert {r["class"]: r["support"] for r in both} == pytest.approx({r["class"]: r["n"] * weights[r["class"]] for r in both}, rel=1e-5)
    scored = ml.score(model, ml.add_weights(test, ml.class_weights(train)))
    for name in ("accuracy", "f1"):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", weightCol="weight", metricName=name)
        assert summary["metrics"][name] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


def test_weighted_cells(spark):
    df = spark.createDataFrame([(0.0, 0.0, 2.0), (0.0, 1.0, 1.0), (1.0, 1.0, 0.5)], "label double, prediction double, weight double")
    cells = metrics.confusion(df, also="weight")
    assert metrics.global_metrics(metrics.reweighted(cells)).first()["accuracy"] == pytest.approx(2.5 / 3.5)
    assert metrics.global_metrics(cells).first()["accuracy"] == pytest.approx(2 / 3)
