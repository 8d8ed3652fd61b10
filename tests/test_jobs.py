import pytest
from pyspark.sql import functions as F

from oracle import assert_same
from precinct.operators import first_available, focus_top, label_distribution, summary_lines, top_states_per_type, types_by_state
from precinct.plans import aggregate_analysis, comparison, report, train_and_evaluate
from precinct.plans.oracle import ORACLE
from precinct.sources import incidents, write_text


@pytest.fixture(scope="module")
def finished(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    raw = incidents(spark, folder)
    lr = train_and_evaluate(spark, raw, out, "lr", "orders", max_iter=10)
    train_and_evaluate(spark, raw, out, "rf", "orders", random=True, num_trees=5, max_depth=4)
    return out, lr


def test_aggregate_analysis(spark, folder):
    assert_same(aggregate_analysis(incidents(spark, folder)), ORACLE["weekly_offenses"], folder)
    values = [r[2] for r in aggregate_analysis(incidents(spark, folder), 10).collect()]
    assert len(values) == 10 and values == sorted(values, reverse=True)


def test_summary_counts(spark, folder, finished):
    from oracle import duck_rows

    row = finished[1].first()
    names, [expected] = duck_rows(ORACLE["row_counts"], folder)
    assert tuple(row[n] for n in names) == expected
    assert row["metrics"]["accuracy"] > 0.5 and row["algorithm"] == "LogisticRegression(multinomial)"
    assert set(row["timings_seconds"]) == {
        "feature_engineering_seconds", "label_distribution_seconds", "split_seconds", "fit_seconds", "evaluate_seconds", "save_model_seconds",
    }
    assert row["total_runtime_seconds"] >= sum(row["timings_seconds"].values()) * 0.99


def test_result_tables(spark, folder, finished, features):
    from precinct.sources import read_result_csv

    out = finished[0]
    dist = read_result_csv(spark, f"{out}/incident_type_distribution")
    assert sorted(map(tuple, dist.collect())) == sorted(map(tuple, label_distribution(features).collect()))
    by_state = read_result_csv(spark, f"{out}/incident_types_by_state")
    assert sorted(map(tuple, by_state.collect())) == sorted(map(tuple, types_by_state(features).collect()))
    classes = read_result_csv(spark, f"{out}/per_class_metrics_lr")
    assert classes.columns == ["class", "support", "precision", "recall", "f1"]
    cells = read_result_csv(spark, f"{out}/confusion_lr")
    assert cells.agg(F.sum("count")).first()[0] == finished[1].first()["test_rows"]


def test_report(spark, finished, tmp_path):
    out = finished[0]
    lines = [r["line"] for r in report(spark, out).orderBy("section", "seq", "name").collect()]
    assert lines[1] == "Fuente: orders" and lines[2].startswith("Algoritmo: Logistic")
    order = [lines.index(x) for x in (
        "Tiempos por etapa (s):", "Distribución INCIDENT_TYPE (ordenada):", "THEFT por estado (ordenado):",
        "Tipos clave por estado (top 10 ordenado):", "THEFT por estado (top 10):", "OTHER por estado (top 10):",
    )]
    assert order == sorted(order)
    write_text(report(spark, out), str(tmp_path / "report"))
    assert spark.read.text(str(tmp_path / "report")).count() == len(lines)
    with pytest.raises(FileNotFoundError):
        report(spark, str(tmp_path))


def test_summary_text(finished):
    lines = [r["line"] for r in summary_lines(finished[1]).orderBy("section", "seq", "name").collect()]
    assert lines[2] == "Archivo: orders" and lines[-1].startswith("Modelo: ") and len(lines) == 16


def test_report_without_optional_parts(spark, finished):
    from precinct.operators import text_report

    summary = finished[1].withColumn("timings_seconds", F.lit(None).cast("map<string,double>"))
    empty = spark.createDataFrame([], "INCIDENT_TYPE string, count bigint")
    lines = [r["line"] for r in text_report(summary, empty).orderBy("section", "seq", "name").collect()]
    assert "  (No se encontraron timings)" in lines and "  (No se encontró distribución)" in lines
    assert not any("por estado" in x for x in lines)


def test_comparison(spark, finished):
    models, classes = comparison(spark, finished[0])
    assert sorted(r["algorithm"] for r in models.collect()) == ["LogisticRegression(multinomial)", "RandomForestClassifier"]
    assert {r["algorithm"] for r in classes.collect()} == {"lr", "rf"}


def test_focus_without_theft(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 4)], "State string, sex int, drug int")
    rows = focus_top(df, n=1).collect()
    assert rows[0].asDict() == {"state": "b", "SEX": 2, "DRUG": 4}
    assert top_states_per_type(df, n=1).count() == 2


def test_first_available(spark):
    df = spark.createDataFrame([("x", 2, "legacy"), ("x", 1, "new"), ("y", 2, "legacy")], "k string, p int, v string")
    assert first_available(df, "p").first()["v"] == "new"
    assert sorted(r["v"] for r in first_available(df, "p", "k").collect()) == ["legacy", "new"]
    assert first_available(df.filter("p > 5"), "p").count() == 0


def test_retraining_on_some_months(spark, features, tmp_path):
    """A stored table partitioned by month is a job input again; other months are not read."""
    from precinct.sources import read_incidents_parquet, write_incidents_parquet

    path = str(tmp_path / "stored")
    write_incidents_parquet(features, path)
    months = read_incidents_parquet(spark, path).filter(F.col("MONTH").isin(1, 2, 3))
    row = train_and_evaluate(spark, months, str(tmp_path / "out"), "lr", max_iter=2).first()
    assert row["records_total"] == row["records_processed"] == features.filter("MONTH in ('1', '2', '3')").count()


def test_scratch_tables_are_removed(spark, tmp_path):
    from pathlib import Path

    from precinct.session import scratch_tables

    with scratch_tables(spark) as table:
        df = table(spark.range(10).toDF("x"), "numbers")
        file = Path(df.inputFiles()[0].removeprefix("file://"))
        assert df.count() == 10 and file.exists()
    assert not file.exists() and not file.parent.exists()
