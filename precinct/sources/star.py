"""Incidents and runs derived from the star-schema tables (see ``FIXTURES.md``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.schema import INCIDENT_SCHEMA


def load_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """One incident per order, with the customer's nation as its state.

    Line items are aggregated by order before the join, so a hot order is summed up map-side first; suppliers and flags are
    counted in an aggregate each, on (order, supplier) and (order, flag) pairs: two distinct counts in one would copy each
    line item, and a set of flags has no fixed size, so that its groups would be sorted instead of hashed. Join strategies are left to Catalyst, which knows the
    table sizes, and skewed join partitions are split by adaptive execution.
    """
    orders, customer, nation, lineitem = load_tables(spark, folder, "orders", "customer", "nation", "lineitem")
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("state")
    )
    items = lineitem.groupBy("l_orderkey").agg(
        F.count("*").cast("int").alias("total_offense"),
        F.count_distinct("l_suppkey").cast("int").alias("total_victim"),
    )
    flags = lineitem.groupBy(F.col("l_orderkey").alias("flags_orderkey")).agg(
        F.count_distinct("l_returnflag").cast("int").alias("total_offender")
    )
    key, date, price = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_totalprice")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    slot = key % 26
    hh = F.lpad(slot.cast("string"), 2, "0")

    def flag(condition):
        return F.when(condition, F.lit(1)).otherwise(F.lit(0))

    columns = {
        "incident_number": key,
        "state": F.col("state"),
        "date_HRF": (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int"),
        "hour": F.when(slot == 24, F.lit("Unknown"))
        .when(slot == 0, F.lit("On or between midnight and 0059"))
        .when(slot != 25, F.concat(F.lit("On or between "), hh, F.lit("00 and "), hh, F.lit("59"))),
        "total_offense": F.col("total_offense"),
        "total_victim": F.col("total_victim"),
        "total_offender": F.col("total_offender"),
        "gun_involvement": flag((priority == "1-URGENT") & (key % 4 != 0)),
        "drug_involvement": flag((priority == "3-MEDIUM") & (key % 5 != 0)),
        "stolen_motor": flag((priority == "2-HIGH") & (key % 3 != 0)),
        "property_value": F.when(key % 7 != 0, price),
        "violence_offense": flag(priority == "1-URGENT"),
        "theft_offense": flag(priority == "2-HIGH"),
        "drug_offense": F.when(priority == "3-MEDIUM", F.lit(1)).when(key % 17 != 0, F.lit(0)),
        "sex_offense": flag((priority == "5-LOW") & (status == "F")),
        "kidnapping_trafficking": flag((priority == "5-LOW") & (status == "P")),
        "other_offense": flag((priority == "4-NOT SPECIFIED") | (price > 450000)),
    }
    return (
        orders.join(places, orders.o_custkey == places.c_custkey)
        .join(items, orders.o_orderkey == items.l_orderkey, "left")
        .join(flags, orders.o_orderkey == flags.flags_orderkey, "left")
        .select(*[columns[f.name].alias(f.name) for f in INCIDENT_SCHEMA.fields])
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One benchmark run per user of the events table; phases are the event types.

    Events are summed by (user, phase) first, which spreads a hot user over the cluster; only one entry
    per phase is gathered into the map.
    """
    (events,) = load_tables(spark, folder, "events")
    phases = events.groupBy("user_id", "event_type").agg(
        F.sum(F.col("value").cast("decimal(12,2)")).alias("seconds")
    )
    user, total = F.col("user_id"), F.col("total").cast("double")
    workers = F.when(user % 3 == 0, F.lit(2)).when(user % 3 == 1, F.lit(4)).otherwise(F.lit(8))
    return (
        phases.groupBy("user_id")
        .agg(
            F.map_from_entries(
                F.sort_array(F.collect_list(F.struct(F.col("event_type"), F.col("seconds").cast("double"))))
            ).alias("timings_seconds"),
            F.sum("seconds").alias("total"),
        )
        .select(
            user.alias("run"),
            workers.alias("workers"),
            "timings_seconds",
            F.when(user % 5 != 0, total).alias("total_runtime_seconds"),
            (total + 1).alias("wall_seconds"),
            F.format_string("run_workers%d_iter%d.json", workers, user).alias("summary_file"),
        )
    )


def incident_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Property descriptions and completion marks of each incident, from its first three line items and their parts.

    Line items are aggregated by order before anything else is joined to them; a number that stands twice gives the
    smaller value.
    """
    lineitem, part = load_tables(spark, folder, "lineitem", "part")
    kinds = part.select("p_partkey", F.concat_ws("/", "p_type", "p_brand").alias("kind"))
    items = lineitem.filter(F.col("l_linenumber") <= 3).join(kinds, lineitem["l_partkey"] == kinds["p_partkey"], "left")
    mark = F.when(F.col("l_linestatus") == "F", "C").when(F.col("l_linestatus") == "O", "A")

    def of_line(number: int, value: Column) -> Column:
        return F.min(F.when(F.col("l_linenumber") == number, value))

    return items.groupBy(F.col("l_orderkey").alias("incident_number")).agg(
        *[of_line(i, F.col("kind")).alias(f"property_description{i}") for i in (1, 2, 3)],
        *[of_line(i, mark).alias(f"completed_attempted{i}") for i in (2, 3)],
    )


def incident_persons(spark: SparkSession, folder: str) -> DataFrame:
    """A person for each line item: incident_number, role, age (unknown for some) and sex."""
    (lineitem,) = load_tables(spark, folder, "lineitem")
    return lineitem.select(
        F.col("l_orderkey").alias("incident_number"),
        F.when(F.col("l_returnflag") == "R", "offender").otherwise("victim").alias("role"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_quantity").cast("int")).alias("age"),
        F.when(F.col("l_linestatus") == "F", "F").when(F.col("l_linestatus") == "O", "M").alias("sex"),
    )
