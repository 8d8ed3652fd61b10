"""Plans and skew: one pass per query, no Python in the plan, right results with hot keys."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import assert_same
from precinct.operators import ml
from precinct.session import INITIAL_PARTITIONS, materialize, partitions_for, shuffle_partitions
from precinct.sources import incidents, load_tables

LAZY = [n for n in entry.queries() if n not in ("lr_metrics", "rf_metrics", "scored", "model_roundtrip", "feature_width")]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["weekly_offenses", "features_base", "evaluation", "row_counts", "run_stats", "top_states_per_type"])
def test_native_plans(spark, folder, name):
    plan = executed(entry.queries()[name](spark, folder))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in plan


def test_flagship_reads_only_its_columns(spark, folder):
    plan = executed(entry.entry(spark))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "l_suppkey" not in plan


@pytest.mark.parametrize("name", ["confusion_counts", "per_class_metrics", "global_metrics", "evaluation"])
def test_metrics_share_one_pass(spark, folder, name):
    """Every branch of a metric query reuses the exchange of the one aggregate over the incidents."""
    df = entry.queries()[name](spark, folder)
    tracker = spark.sparkContext.statusTracker()
    group = f"one-pass-{name}"
    spark.sparkContext.setJobGroup(group, group)
    df.collect()
    assert tracker.getJobIdsForGroup(group)
    final = executed(df)
    assert "ReusedExchange" in final or "ReusedQueryStage" in final or "TableCacheQueryStage" in final


def test_rank_is_cut_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in executed(entry.queries()["top_states_per_type"](spark, folder))


def test_top_ten_needs_no_full_sort(spark, folder):
    assert "TakeOrderedAndProject" in executed(entry.queries()["weekly_top10"](spark, folder))


def test_shuffle_size_belongs_to_a_job(spark):
    assert [partitions_for(n) for n in (0, 1, 2**40, 100 * 2**40)] == [1, 1, 2048, 204_800]
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    with shuffle_partitions(spark, 77):
        assert spark.conf.get(INITIAL_PARTITIONS) == "77"
    with pytest.raises(ZeroDivisionError), shuffle_partitions(spark, 78):
        1 / 0
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_queries_leave_the_session_as_it_is(spark, folder):
    settings = lambda: {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql")}
    before = settings()
    for name in ("weekly_offenses", "run_stats", "retrained", "training_job"):
        entry.queries()[name](spark, folder).count()
    assert settings() == before


def test_line_items_are_not_expanded(spark, folder):
    assert "Expand" not in executed(entry.queries()["features_base"](spark, folder))


def test_line_items_are_hashed_and_not_sorted(spark, folder):
    plan = executed(incidents(spark, folder))
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_training_partitions_grow_with_the_rows():
    assert [ml.train_partitions(n) for n in (0, 1, 8 << 17, (8 << 17) + 1, 360 * 120_000)] == [8, 8, 8, 9, 330]


@pytest.fixture(scope="module")
def skewed(spark, folder, tmp_path_factory):
    """The tables with a hot customer (and so a hot state), a hot order and a hot user: a third of the rows each."""
    out = tmp_path_factory.mktemp("skewed")
    orders, lineitem, events, customer, nation = load_tables(spark, folder, "orders", "lineitem", "events", "customer", "nation")
    hot = {
        "orders": orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")).cast("bigint")),
        "lineitem": lineitem.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")).cast("bigint")),
        "events": events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(4)).otherwise(F.col("user_id")).cast("bigint")),
        "customer": customer,
        "nation": nation,
    }
    for name, df in hot.items():
        df.repartition(8).write.parquet(str(out / f"{name}.parquet"))
    return str(out)


SKEW_KEYS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("name", ["weekly_offenses", "features_base", "evaluation", "top_states_per_type", "run_stats", "row_counts"])
def test_hot_keys(spark, skewed, name, monkeypatch):
    """Right results from shuffled, skew-split joins with a third of the rows on one key."""
    import oracle

    monkeypatch.setattr(oracle, "TABLES", ["orders", "lineitem", "events", "customer", "nation"])
    sql = entry.oracle_sql()[name]
    for key, value in SKEW_KEYS.items():
        spark.conf.set(key, value)
    try:
        df = entry.queries()[name](spark, skewed)
        rows_folder = skewed
        # DuckDB reads the folders that Spark wrote
        monkeypatch.setattr(oracle, "duck_rows", _duck_over_folders)
        assert_same(df, sql, rows_folder)
        if name == "features_base":
            assert "skew=true" in executed(df)
    finally:
        for key in SKEW_KEYS:
            spark.conf.unset(key)


def _duck_over_folders(sql, folder):
    import duckdb

    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def test_materialized_table_has_no_lineage(spark, folder):
    df = materialize(spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count())
    plan = executed(df)
    assert "FileScan parquet" in plan and "Exchange" not in plan
    assert json.loads(df.schema.json())["fields"][0]["name"] == "o_orderstatus"
