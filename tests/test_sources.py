import json

import pytest
from pyspark.sql import functions as F

from precinct.operators import derive, label_distribution, standardize
from precinct.schema import INCIDENT_SCHEMA
from precinct.session import materialize, scratch_path
from precinct.sources import (
    describe_schema,
    incidents,
    read_incidents_csv,
    read_incidents_parquet,
    read_result_csv,
    read_run_summaries,
    resolve_col,
    write_csv,
    write_incidents_parquet,
    write_metrics,
    write_summary,
    write_text,
)

HEADER = "ORI, State ,incident_number,TOTAL_OFFENSE,date_HRF,hour,property_value,violence_offense"


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "a_2020.csv").write_text(f"{HEADER}\nX1,UT,1,2,20200210,7 pm,10.5,1\nX2,CO,2,NA,20200211,,bad,0\n")
    (tmp_path / "b_2021.csv").write_text(f"{HEADER}\nX3,UT,3,4.0,20210210,On or between 1900 and 1959,,NA\n")
    return tmp_path


def test_csv_columns_are_matched_by_name(spark, csv_dir):
    df = read_incidents_csv(spark, str(csv_dir))
    types = dict(df.dtypes)
    assert types["total_offense"] == "int" and types["ORI"] == "string" and types["incident_number"] == "string"
    rows = {r["incident_number"]: r for r in df.collect()}
    assert rows["1"]["state"] == "UT" and rows["1"]["total_offense"] == 2 and rows["1"]["property_value"] == 10.5
    assert rows["2"]["total_offense"] is None and rows["2"]["property_value"] is None and rows["2"]["hour"] is None
    assert rows["3"]["total_offense"] == 4 and rows["3"]["violence_offense"] is None


def test_csv_paths_and_patterns(spark, csv_dir):
    def ids(df):
        return sorted(r[0] for r in df.select("incident_number").collect())

    assert ids(read_incidents_csv(spark, str(csv_dir / "*_2020.csv"))) == ["1", "2"]
    assert ids(read_incidents_csv(spark, [str(csv_dir / "a_2020.csv"), str(csv_dir / "b_2021.csv")])) == ["1", "2", "3"]
    assert ids(read_incidents_csv(spark, str(csv_dir), file_filter="*_2021.csv")) == ["3"]


def test_csv_files_with_another_header_are_refused(spark, csv_dir):
    """A file whose columns are in another order fails; it is not read by position."""
    names = HEADER.split(",")
    (csv_dir / "c_2022.csv").write_text(",".join(reversed(names)) + "\n1,1.5,x,20220101,1,9,UT,X\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_incidents_csv(spark, [str(csv_dir / "a_2020.csv"), str(csv_dir / "c_2022.csv")]).collect()


def test_csv_inference(spark, csv_dir):
    types = dict(read_incidents_csv(spark, str(csv_dir), infer=True).dtypes)
    assert types["State"] == "string" and types["incident_number"] in ("int", "bigint")
    assert types["TOTAL_OFFENSE"] == "string"  # one "NA" makes the column text


def test_csv_scan_is_pruned(spark, csv_dir):
    df = read_incidents_csv(spark, str(csv_dir)).select("state", "total_offense").filter("total_offense > 0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1]
    assert "TOTAL_OFFENSE" in schema and "hour" not in schema and "ORI" not in schema


def test_csv_and_tables_agree(spark, folder, tmp_path):
    path = str(tmp_path / "incidents")
    raw = incidents(spark, folder)
    raw = raw.withColumn("incident_number", raw["incident_number"].cast("string"))
    write_csv(raw, path)
    back = read_incidents_csv(spark, path)
    assert back.dtypes == raw.dtypes == [(f.name, f.dataType.simpleString()) for f in INCIDENT_SCHEMA.fields]
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_parquet_by_month(spark, features, tmp_path):
    path = str(tmp_path / "incidents")
    write_incidents_parquet(features, path)
    one = read_incidents_parquet(spark, path).filter("MONTH = 3")
    assert one.count() == features.filter("MONTH = '3'").count()
    assert "PartitionFilters: [isnotnull(MONTH" in one._jdf.queryExecution().executedPlan().toString()
    write_incidents_parquet(features, path, rebalance=False)
    assert read_incidents_parquet(spark, path).count() == features.count()
    write_incidents_parquet(features, path, partition_by=None)
    assert read_incidents_parquet(spark, [path]).count() == features.count()


def test_stored_incidents_are_filtered_in_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "raw")
    write_incidents_parquet(incidents(spark, folder), path, partition_by=None)
    plan = derive(read_incidents_parquet(spark, path)).select("state")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(total_offense,0)" in plan
    assert plan.split("ReadSchema: ")[1].startswith("struct<state:string,total_offense:int>")


def test_result_csv(spark, features, tmp_path):
    path = str(tmp_path / "dist")
    write_csv(label_distribution(features), path)
    back = read_result_csv(spark, path)
    assert sorted(back.collect()) == sorted((r[0], r[1]) for r in label_distribution(features).collect())
    assert read_result_csv(spark, str(tmp_path / "nothing")) is None
    messy = tmp_path / "messy.csv"
    messy.write_text(" State , Count\nUT,3\n")
    df = read_result_csv(spark, str(messy))
    assert df.columns == ["State", "Count"]
    assert resolve_col(df, "state") == "State" and resolve_col(df, " COUNT ") == "Count" and resolve_col(df, "x") is None


def test_summaries(spark, tmp_path):
    record = {"algorithm": "LR", "metrics": {"accuracy": 0.5, "f1": 0.25}, "timings_seconds": {"fit": 2.0}, "train_rows": 8}
    for i in range(2):
        (tmp_path / f"s{i}.json").write_text(json.dumps(record | {"records_total": i}, indent=2))
    df = read_run_summaries(spark, str(tmp_path / "s*.json"), multi_line=True)
    rows = df.orderBy("records_total").collect()
    assert [r["records_total"] for r in rows] == [0, 1]
    assert rows[0]["metrics"]["f1"] == 0.25 and rows[0]["timings_seconds"] == {"fit": 2.0} and rows[0]["features"] is None
    write_summary(df.coalesce(1), str(tmp_path / "out"))
    assert read_run_summaries(spark, str(tmp_path / "out")).count() == 2
    write_metrics(df, str(tmp_path / "m"))
    write_metrics(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 4


def test_text_keeps_the_order(spark, tmp_path):
    lines = spark.createDataFrame([(i % 3, i, "", f"{i % 3}-{i:03d}") for i in range(50)], "section int, seq bigint, name string, line string")
    write_text(lines.repartition(7), str(tmp_path / "t"))
    files = sorted((tmp_path / "t").glob("part-*"))
    got = [x for f in files for x in f.read_text().splitlines()]
    assert got == sorted(got) and len(got) == 50


def test_schema_report(spark, folder):
    rows = describe_schema(standardize(incidents(spark, folder))).orderBy("position").collect()
    assert (rows[0]["name"], rows[0]["type"]) == ("A_INCIDENT_ID", "bigint")
    assert len(rows) == len(INCIDENT_SCHEMA.fields)


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    path = scratch_path(spark, "a")
    assert path.startswith(f"{shared}/a-") and path != scratch_path(spark, "a")
    assert materialize(spark.range(3), "numbers").inputFiles()[0].startswith(f"file://{shared}/numbers-")


def test_summaries_and_text_round_trip(spark, tmp_path):
    """Written and read back with the defaults: every record, and equal counts in the order of their names."""
    rows = spark.range(3).selectExpr("CAST(id AS STRING) AS algorithm", "id AS records_total")
    write_summary(rows.coalesce(1), str(tmp_path / "summaries"))
    assert read_run_summaries(spark, str(tmp_path / "summaries")).count() == 3
    lines = spark.createDataFrame([(0, -5, n, n) for n in "dbca"], "section int, seq long, name string, line string")
    write_text(lines.coalesce(1), str(tmp_path / "lines"))
    assert "".join(r[0] for r in spark.read.text(str(tmp_path / "lines")).collect()) == "abcd"


def test_text_ids_are_kept(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("incident_number,total_offense\nAB-1,1\n007,2\n")
    rows = read_incidents_csv(spark, str(tmp_path / "ids.csv")).collect()
    assert sorted(r["incident_number"] for r in rows) == ["007", "AB-1"]


def test_features_are_native(features):
    assert "Python" not in features._jdf.queryExecution().executedPlan().toString()
    assert features.filter(F.col("INCIDENT_TYPE").isNull()).count() == 0
