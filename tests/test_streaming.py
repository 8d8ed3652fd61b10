"""New files find their way into the store once, corrections win, and models follow."""

import importlib

import pytest
from pyspark.sql import functions as F

from precinct.operators import clean, ml, split
from precinct.schema import CATEGORICAL, NUMERIC
from precinct.sources import incidents, read_metrics, write_csv
from precinct.streaming import ingest, read_store, retrain, store_cells
from precinct.streaming.ingest import KEY


@pytest.fixture(scope="module")
def raw(spark, folder, tmp_path_factory):
    from precinct.session import materialize

    return materialize(incidents(spark, folder), path=str(tmp_path_factory.mktemp("raw") / "table"))


def live(spark, store):
    return {r[KEY]: r["TOTAL_DELITOS"] for r in read_store(spark, store).collect()}


def plain_cells(rows):
    keys = [*CATEGORICAL, "INCIDENT_TYPE", "is_train"]
    return sorted(map(str, (tuple(r) for r in rows.groupBy(*keys).agg(F.count("*")).collect())))


def test_batches_corrections_and_repeats(spark, raw, tmp_path):
    source, store, checkpoint = (str(tmp_path / x) for x in ("in", "store", "checkpoint"))
    assert read_store(spark, store) is None and store_cells(spark, store) is None
    write_csv(raw.filter("incident_number % 2 = 0"), f"{source}/1")
    (one,) = ingest(spark, source, store, checkpoint)
    first = live(spark, store)
    assert one.batch == 0 and one.replaced == 0 and one.records_processed == len(first)
    assert one.records_total == raw.filter("incident_number % 2 = 0").count()
    assert ingest(spark, source, store, checkpoint) == []

    changed = raw.filter("incident_number % 4 = 0").withColumn("total_offense", F.lit(9))
    write_csv(raw.filter("incident_number % 2 = 1").unionByName(changed).select(*reversed(raw.columns)), f"{source}/2")
    (two,) = ingest(spark, source, store, checkpoint)
    second = live(spark, store)
    whole = clean.derive(raw).withColumn(KEY, F.col(KEY).cast("string"))
    ids = {r[KEY] for r in whole.select(KEY).collect()}
    assert set(second) == ids | {str(r[0]) for r in changed.select("incident_number").collect()}
    assert all(n == (9 if int(k) % 4 == 0 else first.get(k, n)) for k, n in second.items())
    assert two.replaced == sum(int(k) % 4 == 0 for k in first)
    rows = read_store(spark, store)
    assert plain_cells(rows) == sorted(map(str, (tuple(r) for r in store_cells(spark, store).collect())))


def test_a_batch_that_is_done_again_changes_nothing(spark, raw, tmp_path, monkeypatch):
    """What the stream does after a failure: the same files with the same number."""
    module = importlib.import_module("precinct.streaming.ingest")
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for i in range(2):
        write_csv(raw.filter((F.col("incident_number") % 3 >= i) & (F.col("incident_number") % 3 <= i + 1)), f"{source}/{i}")

    def twice(spark, source, checkpoint, handle, *rest):
        for i in (0, 1):
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{source}/{i}").select("path", "length")
            handle(files, i)
            handle(files, i)

    monkeypatch.setattr(module, "new_files", twice)
    a, b, c, d = ingest(spark, source, store, "unused")
    assert a == b and c == d and c.replaced > 0
    assert read_store(spark, store).count() == clean.filter_valid(raw).count()
    assert plain_cells(read_store(spark, store)) == sorted(map(str, (tuple(r) for r in store_cells(spark, store).collect())))


def test_few_files_at_a_time(spark, raw, tmp_path):
    write_csv(raw.repartition(5), str(tmp_path / "in"))
    done = ingest(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "c"), most_files=2)
    assert [b.files for b in done] == [2, 2, 1] and sum(b.records_total for b in done) == raw.count()
    assert read_store(spark, str(tmp_path / "store")).count() == clean.filter_valid(raw).count()


def test_files_without_some_columns(spark, raw, tmp_path):
    write_csv(raw.drop("stolen_motor", "hour").withColumn("more", F.lit(1)), str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "c"))
    rows = read_store(spark, str(tmp_path / "store"))
    assert rows.filter("stolen_motor <> 0 or HOUR_BUCKET is not null").count() == 0 and rows.count() > 0


def test_retraining_follows_the_store(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(raw.filter("incident_number % 2 = 0"), f"{source}/1")
    first = retrain(spark, source, out, partitions=2, max_iter=3)
    assert retrain(spark, source, out, partitions=2, max_iter=3) == ([], None, None)
    write_csv(raw.filter("incident_number % 2 = 1"), f"{source}/2")
    second = retrain(spark, source, out, partitions=2, max_iter=3)
    a, b = first.summary.first(), second.summary.first()
    rows = clean.derive(raw)
    train, test = split.hash_split(rows)
    assert (b["train_rows"], b["test_rows"]) == (train.count(), test.count())
    assert a["train_rows"] < b["train_rows"] and b["records_total"] == raw.filter("incident_number % 2 = 1").count()
    published = read_metrics(spark, f"{out}/metrics").select("run_key").collect()
    assert sorted(r[0] for r in published) == ["lr-0", "lr-1"]
    # The counted dictionaries are those that indexers would have learned from the rows.
    cells = store_cells(spark, f"{out}/store").filter("is_train")
    counted = ml.labels_by_count(cells, [*CATEGORICAL, "INCIDENT_TYPE"])
    model = ml.Pipeline(stages=[ml.category_indexer(), ml.label_indexer()]).fit(train)
    assert [list(x) for x in model.stages[0].labelsArray] == [counted[c] for c in CATEGORICAL]
    assert list(model.stages[1].labels) == counted["INCIDENT_TYPE"] == ml.label_names(second.model)
    assert ml.load_model(b["model_path"]).transform(test.select(*CATEGORICAL, *NUMERIC, "INCIDENT_TYPE")).count() == b["test_rows"]
