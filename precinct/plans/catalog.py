"""One query per operator over the star-schema tables: name -> callable(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct import functions as fx
from precinct.operators import analysis, clean, counters, metrics, ml, multihot, rank, reports, split
from precinct.operators import runs as run_ops
from precinct.plans import jobs
from precinct.plans.jobs import aggregate_analysis
from precinct.schema import ALGORITHM_NAMES, ATTEMPT_COLUMNS, CATEGORICAL, NUMERIC, PROPERTY_COLUMNS, SUMMARY_SCHEMA
from precinct.session import materialize, scratch_path
from precinct.sources import (
    describe_schema,
    incident_persons,
    incident_properties,
    incidents,
    load_tables,
    publish_metrics,
    read_incidents_csv,
    read_incidents_parquet,
    read_metrics,
    read_result_csv,
    read_run_summaries,
    resolve_col,
    runs,
    write_csv,
    write_incidents_parquet,
    write_metrics,
    write_summary,
    write_text,
)
from precinct.streaming import read_store, retrain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The two rule-based predictors: the columns whose majority label each predicts.
BY_STATE = ("state",)
BY_INVOLVEMENT = ("gun_involvement", "drug_involvement", "stolen_motor")
ID = "A_INCIDENT_ID"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def features(spark: SparkSession, folder: str) -> DataFrame:
    return clean.derive(incidents(spark, folder))


# --- Sources and sinks ---


@query
def csv_roundtrip_count(spark, folder):
    path = scratch_path(spark, "incidents-csv")
    write_csv(incidents(spark, folder), path)
    back = read_incidents_csv(spark, path)
    return back.agg(
        F.count("*").alias("rows"),
        F.count("hour").alias("hours"),
        F.sum("total_offense").alias("offenses"),
        F.count("drug_offense").alias("drug_flags"),
        F.sum(F.col("property_value").cast("decimal(18,2)")).cast("double").alias("property_value"),
    )


@query
def csv_weekly_offenses(spark, folder):
    path = scratch_path(spark, "incidents-csv")
    write_csv(incidents(spark, folder), path)
    return aggregate_analysis(read_incidents_csv(spark, path, file_filter="*.csv"))


@query
def standardized(spark, folder):
    return clean.standardize(incidents(spark, folder))


@query
def resolve_columns(spark, folder):
    messy = analysis.type_by_state(features(spark, folder), "THEFT").toDF(" State ", "COUNT")
    return messy.select(
        *[F.col(f"`{resolve_col(messy, c)}`").alias(c) for c in ("state", "count")]
    )


@query
def parquet_month_counts(spark, folder):
    path = scratch_path(spark, "incidents-parquet")
    write_incidents_parquet(features(spark, folder), path)
    return analysis.month_counts(read_incidents_parquet(spark, path))


@query
def csv_text_ids(spark, folder):
    """Ids that are no numbers survive the trip through CSV and the split."""
    path = scratch_path(spark, "incidents-csv")
    ids = F.concat(F.lit("AB-"), F.lpad(F.col("incident_number").cast("string"), 9, "0"))
    write_csv(incidents(spark, folder).withColumn("incident_number", ids), path)
    back = clean.derive(read_incidents_csv(spark, path)).withColumn("is_train", split.in_train(F.col(ID)))
    return back.agg(
        F.count("*").alias("rows"), F.count_distinct(ID).alias("ids"), F.min(ID).alias("first_id"),
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows"),
    )


@query
def csv_mixed_headers(spark, folder):
    """Files of three deliveries: one as written, one with the columns turned round, one with a column more and one less."""
    path = scratch_path(spark, "incidents-csv")
    df = incidents(spark, folder)
    third = F.col("incident_number") % 3
    write_csv(df.filter(third == 0), f"{path}/a")
    write_csv(df.filter(third == 1).select(*reversed(df.columns)), f"{path}/b")
    office = F.concat(F.lit("ORI"), (F.col("incident_number") % 10).cast("string"))
    write_csv(df.filter(third == 2).drop("stolen_motor").withColumn(" ori ", office), f"{path}/c")
    back = read_incidents_csv(spark, path, file_filter="*.csv", by_header=True)
    return back.groupBy("ori").agg(
        F.count("*").alias("rows"),
        F.count("hour").alias("hours"),
        F.sum("total_offense").alias("offenses"),
        F.count("stolen_motor").alias("with_motor"),
        F.sum("stolen_motor").alias("stolen_motor"),
        F.sum("theft_offense").alias("thefts"),
        F.sum(F.col("property_value").cast("decimal(18,2)")).cast("double").alias("property_value"),
    )


@query
def schema_report(spark, folder):
    """Columns and types of the derived incidents, beside their number of rows."""
    df = features(spark, folder).select("state", "INCIDENT_DATE", "TOTAL_DELITOS", "property_value", "INCIDENT_TYPE")
    rows = df.agg(F.count("*").alias("rows"))
    return describe_schema(df).join(rows)


@query
def result_csv(spark, folder):
    """A result table written as CSV and read back with trimmed names; a missing one is None."""
    path = scratch_path(spark, "result-csv")
    write_csv(analysis.type_by_state(features(spark, folder), "THEFT").toDF(" state ", "count"), path)
    absent = read_result_csv(spark, path + "-absent") is None
    back = read_result_csv(spark, path, "state string, count bigint")
    return back.select("state", "count", F.lit(absent).alias("absent_is_none"))


@query
def summaries_roundtrip(spark, folder):
    """Several summaries in one file, read back with the defaults."""
    a, b = _summaries(spark, folder)
    path = scratch_path(spark, "summaries")
    every = a.unionByName(b).unionByName(a.withColumn("algorithm", F.lit("again")))
    write_summary(every.coalesce(1), path)
    return read_run_summaries(spark, path).groupBy("algorithm").agg(
        F.count("*").alias("records"), F.max("records_total").alias("records_total"), F.round(F.max("metrics.f1"), 6).alias("f1")
    )


@query
def text_roundtrip(spark, folder):
    """Report lines as text files, read back in the order of the files; equal counts stand in the order of names."""
    counts = features(spark, folder).groupBy("state").agg(F.count("*").alias("n"))
    coarse = F.floor(F.col("n") / 10).cast("bigint")
    lines = counts.select(
        F.lit(0).alias("section"), (-coarse).alias("seq"), F.col("state").alias("name"),
        F.concat_ws(": ", F.col("state"), coarse.cast("string")).alias("line"),
    )
    path = scratch_path(spark, "report-text")
    write_text(lines, path)
    back = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    # One line for each state: the window sees a report, not the incidents.
    return back.select((F.row_number().over(Window.orderBy("file", "at")) - 1).cast("bigint").alias("line_number"), F.col("value").alias("line"))


# --- Projections, filters, derived columns ---


@query
def valid_incidents(spark, folder):
    return clean.filter_valid(incidents(spark, folder)).select("incident_number", "state", "total_offense")


@query
def numeric_features(spark, folder):
    df = clean.standardize(incidents(spark, folder))
    return clean.impute_zero(clean.cast_numeric(df)).select(ID, *NUMERIC)


@query
def incident_dates(spark, folder):
    return features(spark, folder).select(ID, "INCIDENT_DATE_RAW", "INCIDENT_DATE")


@query
def day_type(spark, folder):
    return features(spark, folder).select(ID, "INCIDENT_DATE", "TIPO_DIA")


@query
def month_counts(spark, folder):
    return analysis.month_counts(features(spark, folder))


@query
def hour_bucket(spark, folder):
    return analysis.hour_counts(features(spark, folder))


@query
def flag_sum(spark, folder):
    return features(spark, folder).select(ID, "OFFENSE_FLAGS_SUM")


@query
def incident_type(spark, folder):
    return features(spark, folder).select(ID, "INCIDENT_TYPE")


@query
def features_base(spark, folder):
    return features(spark, folder).select(
        ID, "state", "INCIDENT_DATE", "TIPO_DIA", "HOUR_BUCKET", "MONTH", "OFFENSE_FLAGS_SUM", "INCIDENT_TYPE", *NUMERIC
    )


@query
def calendar_bands(spark, folder):
    df = features(spark, folder)
    keys = [F.dayofweek("INCIDENT_DATE").alias("day_of_week"), fx.hour_band(F.col("HOUR_BUCKET")).alias("hour_band")]
    return df.groupBy(*keys).count()


# --- Aggregates, pivots, rankings ---


@query
def row_counts(spark, folder):
    return analysis.row_counts(incidents(spark, folder))


@query
def weekly_offenses(spark, folder):
    return aggregate_analysis(incidents(spark, folder))


@query
def weekly_top10(spark, folder):
    return aggregate_analysis(incidents(spark, folder), 10)


@query
def label_distribution(spark, folder):
    return analysis.label_distribution(features(spark, folder))


@query
def theft_by_state(spark, folder):
    return analysis.type_by_state(features(spark, folder), "THEFT")


@query
def types_by_state(spark, folder):
    return analysis.types_by_state(features(spark, folder))


@query
def focus_top10(spark, folder):
    return analysis.focus_top(analysis.types_by_state(features(spark, folder)))


@query
def top_states_per_type(spark, folder):
    return analysis.top_states_per_type(analysis.types_by_state(features(spark, folder)))


@query
def multiple_profile(spark, folder):
    return analysis.multiple_profile(features(spark, folder))


# --- Splits and samples ---


@query
def split_sizes(spark, folder):
    df = features(spark, folder).withColumn("is_train", split.in_train(F.col(ID)))
    return df.agg(
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows")
    )


@query
def random_split_sizes(spark, folder):
    """Rows of both parts together, and whether the training share is within five standard deviations."""
    df = materialize(features(spark, folder).select(ID), "split")
    train, test = split.random_split(df)
    both = train.select(F.lit(1).alias("t")).unionByName(test.select(F.lit(0).alias("t")))
    n, t = F.count("*"), F.sum("t")
    return both.agg(n.alias("rows"), (F.abs(t - 0.8 * n) <= 5 * F.sqrt(0.16 * n)).alias("share_is_near"))


@query
def random_split_cover(spark, folder):
    df = materialize(features(spark, folder).select(ID), "split")
    train, test = split.random_split(df)
    both = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    return (
        both.groupBy(ID)
        .agg(F.count("*").alias("times"))
        .agg(F.sum("times").alias("rows"), F.count("*").alias("incidents"), F.max("times").alias("most_times"))
    )


@query
def stratified_sample(spark, folder):
    sample = split.stratified_sample(features(spark, folder), {"THEFT": 0.5, "OTHER": 0.1, "SEX": 1.0})
    return sample.groupBy("INCIDENT_TYPE").count()


@query
def fine_split(spark, folder):
    """A test part of a thousandth."""
    train, test = split.hash_split(features(spark, folder), train=0.999)
    rows = train.select(F.lit(1).alias("t")).unionByName(test.select(F.lit(0).alias("t")))
    return rows.agg(F.sum("t").alias("train_rows"), F.sum(1 - F.col("t")).alias("test_rows"))


@query
def sample_then_split(spark, folder):
    """Every label of a sample is in both parts of its split."""
    sample = split.stratified_sample(features(spark, folder), {"THEFT": 0.5, "OTHER": 0.25, "SEX": 1.0})
    return sample.groupBy("INCIDENT_TYPE", split.in_train(F.col(ID)).alias("is_train")).count()


# --- Metrics on the rule-based predictors ---


def _cells(spark, folder, by=BY_STATE):
    return metrics.split_cells(features(spark, folder), by)


def _predicted(cells, by):
    """(label, prediction, n) as class indexes, and the label dictionary."""
    labels = metrics.label_dictionary(cells)
    return metrics.name_to_index(metrics.majority_predictions(cells, by), labels), labels


@query
def label_dictionary(spark, folder):
    return metrics.label_dictionary(_cells(spark, folder, ()))


@query
def category_index(spark, folder):
    df = features(spark, folder).filter(split.in_train(F.col(ID)))
    return metrics.category_index(df, CATEGORICAL)


@query
def class_weights(spark, folder):
    df = features(spark, folder).filter(split.in_train(F.col(ID)))
    return ml.class_weights(df).withColumn("weight", F.round("weight", 6))


@query
def confusion_counts(spark, folder):
    preds, _ = _predicted(_cells(spark, folder), BY_STATE)
    return metrics.confusion(preds, "n")


@query
def confusion_named(spark, folder):
    preds, labels = _predicted(_cells(spark, folder, BY_INVOLVEMENT), BY_INVOLVEMENT)
    return metrics.index_to_name(metrics.confusion(preds, "n"), labels)


@query
def per_class_metrics(spark, folder):
    preds, labels = _predicted(_cells(spark, folder, BY_INVOLVEMENT), BY_INVOLVEMENT)
    return metrics.per_class_metrics(metrics.confusion(preds, "n"), labels)


@query
def global_metrics(spark, folder):
    preds, _ = _predicted(_cells(spark, folder, BY_INVOLVEMENT), BY_INVOLVEMENT)
    out = metrics.global_metrics(metrics.confusion(preds, "n"))
    return out.select("scored_rows", F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query
def evaluation(spark, folder):
    preds, labels = _predicted(_cells(spark, folder), BY_STATE)
    return metrics.evaluate(preds, labels, "n").as_table()


# --- Models ---

# Property values in a smaller share of the training rows are rare.
PROPERTY_SHARE = 0.007


def _split_features(spark, folder):
    """Train and test rows of a table with the columns that models need; the joins run once."""
    columns = [*CATEGORICAL, *NUMERIC, "INCIDENT_TYPE", ID]
    return split.hash_split(materialize(features(spark, folder).select(*columns), "features"))


def _fitted(train, algorithm, **params):
    return ml.fit(ml.build_pipeline(algorithm, **params), train, ml.train_partitions)


def _model_metrics(spark, folder, algorithm):
    """Support of each class, and whether the fitted model beats the majority label and agrees with MLlib's evaluator."""
    train, test = _split_features(spark, folder)
    model = _fitted(train, algorithm)
    scored = materialize(ml.score(model, test).select("label", "prediction"), "scored")
    cells = materialize(metrics.confusion(scored), "confusion")
    overall = metrics.global_metrics(cells).first()
    same = True
    for name, value in (("accuracy", overall["accuracy"]), ("f1", overall["f1"])):
        found = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(scored)
        same = same and abs(found - value) < 1e-9
    table = metrics.per_class_metrics(cells, ml.label_names(model))
    share = table.agg((F.max("support") / F.sum("support")).alias("share")).first()["share"]
    return table.select(
        "class", "support", F.lit(overall["scored_rows"]).alias("scored_rows"),
        F.lit(overall["accuracy"] > share).alias("beats_majority"), F.lit(same).alias("equals_evaluator"),
    )


@query
def lr_metrics(spark, folder):
    return _model_metrics(spark, folder, "lr")


@query
def rf_metrics(spark, folder):
    return _model_metrics(spark, folder, "rf")


@query
def scored(spark, folder):
    """Scored rows by true label; the confusion cells are named, not the rows."""
    train, test = _split_features(spark, folder)
    model = _fitted(train, "lr")
    cells = metrics.index_to_name(metrics.confusion(ml.score(model, test)), ml.label_names(model))
    return cells.groupBy("true_label").agg(F.sum("count").alias("count"))


@query
def model_roundtrip(spark, folder):
    train, test = _split_features(spark, folder)
    model = _fitted(train, "lr")
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    once = ml.score(model, test).select(*test.columns, F.col("prediction").alias("before"))
    return ml.score(ml.load_model(path), once).agg(
        F.count("*").alias("scored_rows"), F.count_if(F.col("before") != F.col("prediction")).alias("different")
    )


@query
def algorithm_choice(spark, folder):
    """The estimator that each name stands for, beside the training rows it would see; an unknown name is refused."""
    train, _ = _split_features(spark, folder)
    names = {name: type(ml.classifier(name)).__name__ for name in ALGORITHM_NAMES}
    try:
        ml.classifier("other")
    except ValueError:
        names["other"] = "refused"
    entries = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(v).alias("estimator")) for k, v in names.items()])
    return train.agg(F.count("*").alias("train_rows")).select(F.inline(entries), "train_rows")


def _positions(spark, values: dict[str, list[str]]) -> DataFrame:
    """(column, value, idx) of the labels of fitted indexers: one row for each distinct value."""
    rows = [(c, v, float(i)) for c, labels in values.items() for i, v in enumerate(labels)]
    return spark.createDataFrame(rows, "column string, value string, idx double")


@query
def fitted_labels(spark, folder):
    """The label order that the fitted indexer has and the model's names use."""
    train, _ = _split_features(spark, folder)
    model = ml.Pipeline(stages=[ml.label_indexer()]).fit(train)
    return _positions(spark, {"INCIDENT_TYPE": ml.label_names(model)})


@query
def fitted_categories(spark, folder):
    """The index of each value in the fitted category indexer, without its place for unseen values."""
    train, _ = _split_features(spark, folder)
    model = ml.Pipeline(stages=[ml.category_indexer()]).fit(train)
    (stage,) = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    return _positions(spark, dict(zip(stage.getInputCols(), map(list, stage.labelsArray))))


@query
def calendar_features(spark, folder):
    """Day of week and hour band as further categories of a model."""
    df = features(spark, folder).withColumns(
        {"day_of_week": F.dayofweek("INCIDENT_DATE").cast("string"), "hour_band": fx.hour_band(F.col("HOUR_BUCKET")).cast("string")}
    )
    columns = (*CATEGORICAL, "day_of_week", "hour_band")
    train, test = split.hash_split(materialize(df.select(*columns, *NUMERIC, "INCIDENT_TYPE", ID), "features"))
    model = _fitted(train, "lr", categorical=columns)
    widths = ml.category_sizes(model)
    rows = ml.score(model, test).agg(F.count("*").alias("scored_rows"))
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(widths[c]).cast("bigint").alias("width")) for c in columns])
    return rows.select(F.inline(entries), "scored_rows")


@query
def property_features(spark, folder):
    """Two multi-hot vectors, of property descriptions and of completion marks, in the features of a fitted model.

    For each test incident the values that are set, whether one of them is rare, and the width of all features.
    """
    raw = incidents(spark, folder).join(incident_properties(spark, folder), "incident_number", "left")
    columns = [*CATEGORICAL, *NUMERIC, *PROPERTY_COLUMNS, *ATTEMPT_COLUMNS, "INCIDENT_TYPE", ID]
    train, test = split.hash_split(materialize(clean.derive(raw).select(*columns), "features"))
    vectors = {"properties": PROPERTY_COLUMNS, "attempts": ATTEMPT_COLUMNS}
    model = _fitted(train, "lr", multi_hot=vectors, min_share=PROPERTY_SHARE)
    scored = ml.score(model, test)
    places = {s.getOutputCol(): s.size() for s in model.stages if isinstance(s, multihot.MultiHotModel)}
    set_values = {c: F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, x: a + x).cast("bigint") for c in places}
    return scored.select(
        ID,
        *[n.alias(f"n_{c}") for c, n in set_values.items()],
        (F.get(vector_to_array("properties"), places["properties"] - 1) == 1).alias("has_rare"),
        *[F.lit(n).cast("bigint").alias(f"{c}_width") for c, n in places.items()],
        F.lit(ml.vector_size(scored)).cast("bigint").alias("features_width"),
    )


@query
def demographic_features(spark, folder):
    """Counters of victims and offenders as further numeric features of a fitted model: sums over the scored rows."""
    conditions = counters.demographic_conditions()
    found = counters.conditional_counters(incident_persons(spark, folder), "incident_number", conditions)
    raw = counters.add_counters(incidents(spark, folder), found, "incident_number")
    numeric = (*NUMERIC, *conditions)
    columns = [*CATEGORICAL, *numeric, "INCIDENT_TYPE", ID]
    train, test = split.hash_split(materialize(clean.derive(raw, numeric=numeric).select(*columns), "features"))
    scored = ml.score(_fitted(train, "lr", numeric=numeric), test)
    return scored.groupBy("INCIDENT_TYPE").agg(
        F.count("*").alias("scored_rows"),
        *[F.sum(c).alias(c) for c in conditions],
        F.lit(ml.vector_size(scored)).cast("bigint").alias("features_width"),
    )


@query
def weighted_metrics(spark, folder):
    """A model fitted with balanced labels: support and weight of each class, and whether MLlib's weighted evaluator agrees."""
    train, test = _split_features(spark, folder)
    weights = materialize(ml.class_weights(train), "weights")
    model = _fitted(ml.add_weights(train, weights), "lr", weightCol="weight")
    scored = materialize(ml.score(model, ml.add_weights(test, weights)).select("label", "prediction", "weight"), "scored")
    cells = materialize(metrics.confusion(scored, also="weight"), "confusion")
    balanced = metrics.reweighted(cells)
    overall = metrics.global_metrics(balanced).first()
    same = True
    for name, value in (("accuracy", overall["accuracy"]), ("f1", overall["f1"])):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", weightCol="weight", metricName=name)
        same = same and abs(evaluator.evaluate(scored) - value) < 1e-9
    names = ml.label_names(model)
    plain = metrics.per_class_metrics(cells.drop("weight"), names).select("class", "support")
    # With equal weight for each class, a model that always says the same is right in about one of as many cases.
    beats = overall["accuracy"] > 1.5 / len(names)
    weighted = metrics.per_class_metrics(balanced, names).select("class", F.round("support", 6).alias("weight"))
    return plain.join(weighted, "class").withColumns({"beats_one_class": F.lit(beats), "equals_evaluator": F.lit(same)})


@query
def customer_ranks(spark, folder):
    """Customers and states by their number of incidents: a key with one value in ten rows beside a small column."""
    return rank.ranked_values(_with_customer(spark, folder), ["customer", "state"])


@query
def customer_index(spark, folder):
    """Each test incident with the places of its customer and state among the training rows."""
    df = _with_customer(spark, folder).withColumn("is_train", split.in_train(F.col("incident_number")))
    df = materialize(df, "customers")
    ranks = materialize(rank.ranked_values(df.filter("is_train"), ["customer", "state"]), "ranks")
    test = df.filter("not is_train").select("incident_number", "customer", "state")
    return rank.with_ranks(test, ranks, ["customer", "state"]).drop("customer", "state")


def _with_customer(spark, folder):
    (orders,) = load_tables(spark, folder, "orders")
    customers = orders.select(F.col("o_orderkey").alias("incident_number"), F.concat(F.lit("C"), "o_custkey").alias("customer"))
    return clean.filter_valid(incidents(spark, folder)).select("incident_number", "state").join(customers, "incident_number")


# --- Whole jobs ---


@query
def training_job(spark, folder):
    """The training job with its default model: counts of the summary and of every table that it wrote, read back."""
    out = scratch_path(spark, "job")
    jobs.train_and_evaluate(spark, incidents(spark, folder), out, "lr", "orders", key=ID, partitions=ml.train_partitions)
    summary = read_run_summaries(spark, f"{out}/summary_lr")
    counts = ("records_total", "records_processed", "train_rows", "test_rows")
    parts = [summary.select(F.inline(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in counts])))]
    for name, value in (
        ("incident_type_distribution", F.sum("count")), ("theft_by_state", F.sum("count")), ("incident_types_by_state", F.sum("THEFT")),
        ("per_class_metrics_lr", F.sum("support")), ("confusion_lr", F.sum("count")),
    ):
        table = read_result_csv(spark, f"{out}/{name}")
        parts.append(table.agg(F.lit(name).alias("item"), value.cast("bigint").alias("value")))
    report = jobs.report(spark, out)
    parts.append(report.filter("section = 3").agg(F.lit("report_lines").alias("item"), F.count("*").alias("value")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


@query
def model_comparison(spark, folder):
    """Both fitted models side by side, with their default parameters."""
    out = scratch_path(spark, "jobs")
    raw = materialize(incidents(spark, folder), "incidents")
    for algorithm in ALGORITHM_NAMES:
        jobs.train_and_evaluate(spark, raw, out, algorithm, "orders", key=ID, partitions=ml.train_partitions)
    models, classes = jobs.comparison(spark, out)
    classes = classes.groupBy("algorithm").agg(F.count("*").alias("classes"), F.sum("support").cast("bigint").alias("support"))
    names = F.create_map(*[x for k, v in ALGORITHM_NAMES.items() for x in (F.lit(k), F.lit(v))])
    classes = classes.withColumn("algorithm", names[F.col("algorithm")])
    in_range = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    return models.select("algorithm", "train_rows", "test_rows", in_range.alias("in_range")).join(classes, "algorithm")


@query
def retrained(spark, folder):
    """Training on the first half of the months only, from incidents stored by month."""
    path = scratch_path(spark, "incidents-parquet")
    columns = [*CATEGORICAL, *NUMERIC, "INCIDENT_TYPE", ID]
    write_incidents_parquet(features(spark, folder).select(*columns), path)
    rows = read_incidents_parquet(spark, path).filter(F.col("MONTH").isin([str(m) for m in range(1, 7)]))
    train, test = split.hash_split(rows)
    model = _fitted(train, "lr")
    months = ml.category_sizes(model)["MONTH"]
    return ml.score(model, test).agg(F.count("*").alias("scored_rows"), F.lit(months).cast("bigint").alias("months"))


@query
def incremental_retraining(spark, folder):
    """Two deliveries of incident files, and a third run that finds nothing new.

    The second delivery has the rest of the incidents, in another order of columns, and corrects some of the first. A row for
    each run: what it read, what the store holds then, and whether a model was trained (with the default iterations).
    """
    source, out = scratch_path(spark, "deliveries"), scratch_path(spark, "retraining")
    df = incidents(spark, folder)
    key = F.col("incident_number")
    first, rest = df.filter(key % 3 != 0), df.filter(key % 3 == 0)
    corrected = first.filter(key % 10 == 1).withColumn("total_offense", F.col("total_offense") + 1)
    second = rest.unionByName(corrected).select(*reversed(df.columns))
    rows = []
    for run, delivery in enumerate((first, second, None), 1):
        if delivery is not None:
            write_csv(delivery, f"{source}/delivery{run}")
        found = retrain(spark, source, out, "lr", partitions=ml.train_partitions)
        store = read_store(spark, f"{out}/store").agg(F.count("*"), F.sum("TOTAL_DELITOS")).first()
        summary = found.summary.first() if found.summary else None
        rows.append(
            (
                run, sum(b.records_total for b in found.batches), sum(b.replaced for b in found.batches), store[0], store[1],
                summary["train_rows"] if summary else None, summary["test_rows"] if summary else None,
                found.model.stages[-1].getMaxIter() if found.model else None,
            )
        )
    published = read_metrics(spark, f"{out}/metrics").agg(F.count("*").alias("published_models"))
    schema = "run int, read_rows bigint, replaced_rows bigint, stored_rows bigint, offenses bigint, train_rows bigint, test_rows bigint, iterations int"
    return spark.createDataFrame(rows, schema).join(published)


@query
def feature_width(spark, folder):
    train, _ = _split_features(spark, folder)
    stages = [ml.category_indexer(), ml.encoder(), ml.assembler()]
    model = ml.Pipeline(stages=stages).fit(train)
    widths = ml.category_sizes(model)
    widths["features"] = ml.vector_size(model.transform(train))
    entries = F.array(*[F.struct(F.lit(k).alias("column"), F.lit(v).cast("bigint").alias("width")) for k, v in widths.items()])
    return train.agg(F.count("*").alias("train_rows")).select(F.inline(entries), "train_rows")


# --- Summaries and reports ---


def _timings(spark, folder):
    """Seconds per phase over all runs as one map; one entry per phase."""
    (events,) = load_tables(spark, folder, "events")
    return (
        events.groupBy("event_type")
        .agg(F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("seconds"))
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "seconds")))))
        .scalar()
    )


def _report_cells(spark, folder):
    """Cells for counts, distributions and both predictors, as a table made in one pass over the incidents."""
    df = clean.derive(incidents(spark, folder), keep_invalid=True)
    return materialize(metrics.split_cells(df, (*BY_STATE, *BY_INVOLVEMENT, "VALID")), "cells")


def _summaries(spark, folder, cells=None):
    """Summary records of the two predictors."""
    cells = _report_cells(spark, folder) if cells is None else cells
    counts = metrics.cell_counts(cells)
    cells = cells.filter("VALID")
    timings = _timings(spark, folder)
    parts = []
    for name, keys in (("state", BY_STATE), ("involvement", BY_INVOLVEMENT)):
        preds, _ = _predicted(cells, keys)
        overall = metrics.global_metrics(metrics.confusion(preds, "n"))
        parts.append(
            reports.run_summary(overall, counts, f"majority by {name}", timings, "orders", f"models/{name}")
        )
    return parts


@query
def run_summary(spark, folder):
    a, b = _summaries(spark, folder)
    stamp = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$"
    return a.unionByName(b).select(
        F.col("run_timestamp").rlike(stamp).alias("stamped"), "data_file", "records_total", "records_processed", "train_rows",
        "test_rows", "algorithm", "model_path", F.round("metrics.accuracy", 6).alias("accuracy"),
        F.round("metrics.f1", 6).alias("f1"), F.size("timings_seconds").cast("bigint").alias("phases"),
        F.array_join("features.numeric", ",").alias("numeric"), F.round("total_runtime_seconds", 2).alias("total_runtime_seconds"),
    )


@query
def run_summary_read(spark, folder):
    a, b = _summaries(spark, folder)
    path = scratch_path(spark, "summaries")
    write_summary(a.unionByName(b), path)
    return read_run_summaries(spark, path).select(
        "algorithm",
        "data_file",
        "records_total",
        "records_processed",
        "train_rows",
        "test_rows",
        F.round("metrics.accuracy", 6).alias("accuracy"),
        F.round("metrics.f1", 6).alias("f1"),
        F.size("timings_seconds").cast("bigint").alias("phases"),
        F.round(fx.run_seconds(F.lit(None).cast("double"), F.col("timings_seconds")), 2).alias("phase_seconds"),
        F.round("total_runtime_seconds", 2).alias("total_runtime_seconds"),
        F.array_join("features.categorical", ",").alias("categorical"),
    )


@query
def published_metrics(spark, folder):
    path = scratch_path(spark, "metrics")
    for part in _summaries(spark, folder):
        write_metrics(part, path)
    return (
        spark.read.parquet(path)
        .groupBy("algorithm")
        .agg(F.count("*").alias("runs"), F.round(F.max("metrics.f1"), 6).alias("best_f1"))
    )


def _event_metrics(spark, folder):
    """A run summary for each user of the events: shares of its events as metrics, three algorithms."""
    (events,) = load_tables(spark, folder, "events")
    runs_of = events.groupBy("user_id").agg(
        F.min("ts").alias("ts"), F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    values = {
        "run_timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "algorithm": F.concat(F.lit("model "), (F.col("user_id") % 3).cast("string")),
        "model_path": F.col("user_id").cast("string"),
        "metrics": F.struct((F.col("clicks") / F.col("n")).alias("accuracy"), (F.col("views") / F.col("n")).alias("f1")),
        "records_total": F.col("n"),
    }
    return runs_of.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])


@query
def metric_trend(spark, folder):
    """Every run is published, some of them again and some with a corrected figure: each counts once, as it was last."""
    path = scratch_path(spark, "metrics")
    summaries = materialize(_event_metrics(spark, folder), "summaries")
    key = F.col("model_path")
    publish_metrics(summaries, path, key)
    publish_metrics(summaries.filter(key.cast("int") % 2 == 0), path, key)
    better = F.struct(F.col("metrics.accuracy").alias("accuracy"), (F.col("metrics.f1") + 0.125).alias("f1"))
    publish_metrics(summaries.filter(key.cast("int") % 5 == 0).withColumn("metrics", better), path, key)
    found = run_ops.metric_trend(read_metrics(spark, path))
    return found.withColumns({c: F.round(c, 6) for c, kind in found.dtypes if kind == "double"})


@query
def broken_summaries(spark, folder):
    """Runs whose summaries are good, without a total, broken, of another form, missing, empty, or left by an earlier run."""
    path = scratch_path(spark, "summaries")
    kind = F.col("run") % 7
    planned = runs(spark, folder).withColumn(
        "started", F.when(kind == 6, F.lit("2200-01-01 00:00:00")).otherwise(F.lit("2000-01-01 00:00:00")).cast("timestamp")
    )
    record = F.to_json(F.struct(F.lit("x").alias("algorithm"), F.col("total_runtime_seconds"), "timings_seconds"))
    line = (
        F.when(kind == 1, F.to_json(F.struct("timings_seconds")))
        .when(kind == 2, F.substring(record, 1, 20))
        .when(kind == 3, F.lit('{"algorithm": "x", "total_runtime_seconds": "soon"}'))
        .when(kind == 5, F.lit('{"algorithm": "x", "total_runtime_seconds": 0}'))
        .otherwise(record)
    )
    files = planned.filter(kind != 4).select(line.alias("line"), "summary_file")
    files.write.partitionBy("summary_file").text(path)
    found = read_run_summaries(spark, path, rejects=True)
    return run_ops.recorded_runs(planned, found).withColumns({c: F.round(c, 2) for c in ("runtime_seconds", "wall_seconds")})


@query
def latest_summary(spark, folder):
    legacy, current = _summaries(spark, folder)
    candidates = legacy.withColumn("priority", F.lit(2)).unionByName(current.withColumn("priority", F.lit(1)))
    return reports.first_available(candidates, "priority").select(
        "algorithm", "priority", F.round("metrics.accuracy", 6).alias("accuracy"), "train_rows", "test_rows"
    )


@query
def run_kpis(spark, folder):
    a, b = _summaries(spark, folder)
    return reports.run_kpis(a.unionByName(b))


@query
def compare_models(spark, folder):
    a, b = _summaries(spark, folder)
    return reports.compare_models(a.unionByName(b)).withColumns(
        {c: F.round(c, 6) for c in ("accuracy", "f1")}
    )


@query
def compare_classes(spark, folder):
    cells = materialize(_cells(spark, folder, (*BY_STATE, *BY_INVOLVEMENT)), "cells")
    tables = {}
    for name, keys in (("state", BY_STATE), ("involvement", BY_INVOLVEMENT)):
        preds, labels = _predicted(cells, keys)
        tables[f"majority by {name}"] = metrics.per_class_metrics(metrics.confusion(preds, "n"), labels)
    return reports.compare_classes(tables)


@query
def report_lines(spark, folder):
    cells = _report_cells(spark, folder)
    _, summary = _summaries(spark, folder, cells)
    cells = cells.filter("VALID")
    return reports.text_report(
        materialize(summary, "summary"),
        analysis.label_distribution(cells, weight="n"),
        analysis.type_by_state(cells, "THEFT", weight="n"),
        materialize(analysis.types_by_state(cells, weight="n"), "by-state"),
    )


# --- Repeated runs ---


@query
def run_seconds(spark, folder):
    return run_ops.with_run_seconds(runs(spark, folder)).select(
        "run", F.round("runtime_seconds", 2).alias("runtime_seconds")
    )


@query
def run_series(spark, folder):
    return run_ops.run_series(runs(spark, folder)).withColumns(
        {c: F.round(c, 2) for c in ("runtime_seconds", "wall_seconds")}
    )


@query
def run_stats(spark, folder):
    return run_ops.run_stats(runs(spark, folder)).withColumns(
        {c: F.round(c, 4) for c in ("min_seconds", "max_seconds", "avg_seconds")}
    )


@query
def phase_timings(spark, folder):
    return run_ops.phase_timings(runs(spark, folder), "run").withColumn("seconds", F.round("seconds", 2))


@query
def formatted_runs(spark, folder):
    df = run_ops.with_run_seconds(runs(spark, folder))
    return df.select("run", fx.fixed(F.col("runtime_seconds"), 3).alias("runtime_seconds"), fx.fixed(F.col("wall_seconds"), 3).alias("wall_seconds"))
