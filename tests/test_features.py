"""One small table per rule of the derived columns."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from precinct import functions as fx
from precinct.operators import cast_numeric, derive, filter_valid, impute_zero, standardize
from precinct.schema import INCIDENT_SCHEMA

BASE = {f.name: 0 for f in INCIDENT_SCHEMA.fields} | {
    "state": "A", "date_HRF": 20240105, "hour": "On or between 1900 and 1959", "total_offense": 1, "property_value": 1.5,
}


def make(spark, *rows):
    full = [BASE | {"incident_number": i} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in INCIDENT_SCHEMA.fields) for r in full], INCIDENT_SCHEMA)


def column(df, name, key="A_INCIDENT_ID"):
    return [r[name] for r in df.orderBy(key).select(name).collect()]


def test_dates(spark):
    df = derive(make(spark, *[{"date_HRF": d} for d in (20201332, 20240105, 20240106, 20240107, None, 20230229, 1)]))
    assert column(df, "INCIDENT_DATE") == [
        None, dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), None, None, None,
    ]
    assert column(df, "TIPO_DIA") == [
        "DIA_SEMANA", "FIN_SEMANA", "FIN_SEMANA", "DIA_SEMANA", "DIA_SEMANA", "DIA_SEMANA", "DIA_SEMANA",
    ]
    assert column(df, "MONTH") == [None, "1", "1", "1", None, None, None]


def test_weekend_parameter(spark):
    df = derive(make(spark, {"date_HRF": 20240107}, {"date_HRF": 20240105}), weekend=(1, 7))
    assert column(df, "TIPO_DIA") == ["FIN_SEMANA", "DIA_SEMANA"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(
    st.integers(-(10**9), 2 * 10**9),
    st.builds(lambda y, m, d: y * 10000 + m * 100 + d, st.integers(0, 9999), st.integers(0, 14), st.integers(0, 33)),
), min_size=20, max_size=60))
def test_date_equals_pattern_parsing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d int")
    both = df.select("d", fx.incident_date(F.col("d")).alias("a"), F.try_to_date(F.col("d").cast("string"), "yyyyMMdd").alias("b"))
    assert both.filter("not (a <=> b)").collect() == []


def test_hours(spark):
    texts = ["On or between 2300 and midnight", "1900–1959", "7 pm", "", None, "On or between MIDNIGHT and 0059", "x 123 4567", "12345"]
    assert column(derive(make(spark, *[{"hour": t} for t in texts])), "HOUR_BUCKET") == [
        "00", "19", "UNK", "UNK", None, "00", "45", "12",
    ]


def test_hour_band(spark):
    df = spark.createDataFrame([("00",), ("05",), ("23",), ("UNK",), (None,)], "b string")
    assert [r[0] for r in df.select(fx.hour_band(F.col("b"))).collect()] == [0, 0, 3, None, None]


def test_labels(spark):
    df = derive(make(
        spark,
        {"violence_offense": 1, "theft_offense": 1, "drug_offense": None},
        {},
        {"theft_offense": 1, "other_offense": 1},
        {"drug_offense": None},
        {"violence_offense": 1}, {"theft_offense": 1}, {"drug_offense": 1}, {"sex_offense": 1},
        {"kidnapping_trafficking": 1}, {"other_offense": 1},
    ))
    assert column(df, "OFFENSE_FLAGS_SUM") == [None, 0, 2, None, 1, 1, 1, 1, 1, 1]
    assert column(df, "INCIDENT_TYPE") == [
        "VIOLENCE", "UNKNOWN", "MULTIPLE", "UNKNOWN", "VIOLENCE", "THEFT", "DRUG", "SEX", "KIDNAPPING_TRAFFICKING", "OTHER",
    ]


def test_quality_filter_and_imputation(spark):
    raw = make(spark, {"total_offense": None}, {"total_offense": 0}, {"total_offense": 1, "total_victim": None, "property_value": None},
               {"total_offense": 2, "property_value": float("nan")})
    df = derive(raw)
    assert column(df, "TOTAL_DELITOS") == [1, 2]
    assert column(df, "total_victim") == [0, 0]
    assert column(df, "property_value") == [0.0, 0.0]
    late = impute_zero(cast_numeric(standardize(raw))).filter("TOTAL_DELITOS > 0")
    assert column(late, "TOTAL_DELITOS") == column(standardize(filter_valid(raw)), "TOTAL_DELITOS")
    marked = derive(raw, keep_invalid=True)
    assert column(marked, "VALID") == [False, False, True, True]


def test_text_input(spark):
    """Columns that came in as text: bad numbers become null, whole numbers with a fraction part count."""
    raw = make(spark, {}, {}, {}).drop("total_offense", "violence_offense").join(
        spark.createDataFrame([(0, "2.0", "1"), (1, "NA", "0"), (2, "3", "x")], "incident_number int, total_offense string, violence_offense string"),
        "incident_number",
    )
    df = derive(raw)
    assert column(df, "TOTAL_DELITOS") == [2, 3]
    assert column(df, "INCIDENT_TYPE") == ["VIOLENCE", "UNKNOWN"]


def test_standardize_without_a_column(spark):
    df = make(spark, {}).drop("date_HRF")
    assert "A_INCIDENT_ID" in standardize(df).columns and "INCIDENT_DATE_RAW" not in standardize(df).columns


@pytest.mark.parametrize("value", [0.015, 0.125, 2.675, 0.5, 1.005, 1234.5678, 0.0, 99.995, 13.1])
@pytest.mark.parametrize("decimals", [2, 4])
def test_fixed_formats_like_printf(spark, value, decimals):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(fx.fixed(F.col("x"), decimals)).first()[0] == f"{value:.{decimals}f}"


def test_text_helpers(spark):
    df = spark.createDataFrame([(9130711, 786.0), (None, None)], "n bigint, s double")
    rows = df.select(fx.thousands(F.col("n")), fx.minutes(F.col("s")), fx.key_values({"A": F.col("n"), "B": F.lit(1)})).collect()
    assert tuple(rows[0]) == ("9,130,711", 13.1, "A=9130711, B=1")
    assert rows[1][1] == 0.0
    stamp = spark.range(1).select(fx.run_stamp()).first()[0]
    assert dt.datetime.strptime(stamp, "%Y-%m-%dT%H:%M:%S.%fZ")


def test_run_seconds(spark):
    df = spark.createDataFrame(
        [(5.0, {"a": 1.0}, 9.0), (None, {"a": 1.0, "b": 2.5}, 9.0), (None, None, 9.0), (0.0, {"a": 1.0}, 9.0), (None, {}, 9.0)],
        "total double, timings map<string,double>, wall double",
    )
    got = df.select(fx.run_seconds(F.col("total"), F.col("timings"), F.col("wall"))).collect()
    assert [r[0] for r in got] == [5.0, 3.5, 9.0, 9.0, 9.0]
