from __future__ import annotations

import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.operators import dense, refresh
from stacklore.operators.dedup import latest_per_key
from stacklore.sources import csv_drop
from stacklore.streaming import ingest, latest

DOC = "id int, text string, price int"


def test_index_changes(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1), (4, None, 1), (6, "x", 1), (6, "x", 1)], DOC)
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, "", 1), (5, "e", 1), (6, "x", 1)], DOC)
    assert rows(refresh.index_changes(old, new, "id", ["text", "price"])) == [
        (2, "update"), (3, "delete"), (4, "update"), (5, "insert"), (6, "update")
    ]
    assert refresh.index_changes(old, old, "id", ["text", "price"]).count() == 0


def test_refresh_embeds_only_changes(spark, tmp_path):
    path = f"{tmp_path}/index"
    seen = spark.sparkContext.accumulator(0)

    def embedder(texts):
        seen.add(len(texts))
        return texts.map(lambda t: [float(len(t)), 1.0])

    def run(data, version, **how):
        docs = spark.createDataFrame(data, DOC)
        before = seen.value
        log = rows(refresh.refresh_index(docs, path, "id", "text", embedder, version, **how))
        return log, seen.value - before

    assert run([(1, "a", 1), (2, "bb", 1), (3, "c", 1)], 0) == ([(1, "upsert"), (2, "upsert"), (3, "upsert")], 3)
    changed = [(1, "a", 1), (2, "bbbb", 1), (4, "d", 1)]
    want = ([(2, "upsert"), (3, "delete"), (4, "upsert")], 2)
    assert run(changed, 1) == want
    assert run(changed, 1) == want  # a retry of the version
    assert run(changed, 2) == ([], 0)
    live = refresh.current_index(spark, path, "id").rows
    assert sorted((r.id, r.text, list(r.embedding)) for r in live.collect()) == [
        (1, "a", [1.0, 1.0]), (2, "bbbb", [4.0, 1.0]), (4, "d", [1.0, 1.0])
    ]
    assert run([(3, "back", 1)], 3, deletes=False) == ([(3, "upsert")], 1)
    refresh.compact_index(spark, path, "id", f"{tmp_path}/compact")
    assert sorted(r.id for r in refresh.current_index(spark, f"{tmp_path}/compact", "id").rows.collect()) == [1, 2, 3, 4]


def test_refresh_on_arrival(spark, tmp_path):
    docs, path = f"{tmp_path}/docs", f"{tmp_path}/index"

    def arrive(data):
        spark.createDataFrame(data, DOC).coalesce(1).write.mode("append").parquet(docs)
        stream = spark.readStream.schema(DOC).parquet(docs)

        def apply(batch, version):
            refresh.refresh_index(batch, path, "id", "text", dense.hashing_embedder(8), version, deletes=False)

        refresh.refresh_on_arrival(stream, apply, f"{tmp_path}/cp", available_now=True).awaitTermination()

    arrive([(1, "a", 1), (2, "b", 1)])
    arrive([(2, "changed", 1), (3, "c", 1)])
    live = refresh.current_index(spark, path, "id").rows
    assert rows(live.select("id", "text")) == [(1, "a"), (2, "changed"), (3, "c")]


def csv_files(root):
    return [f for _, _, files in os.walk(root) for f in files if f.endswith(".csv")]


def test_incremental_load_once_then_removed(spark, tmp_path):
    root, target, checkpoint = f"{tmp_path}/drop", f"{tmp_path}/raw", f"{tmp_path}/cp"

    def arrive(n, stamp):
        df = spark.createDataFrame([(i, f"c{i}", datetime(2024, 1, 1)) for i in range(n)], schemas.RAW_CATEGORIES)
        csv_drop.write_raw_csv(df.repartition(3), root, "categories", stamp)

    def load():
        return ingest.ingest_new_files(
            spark, f"{root}/categories", schemas.RAW_CATEGORIES, target, checkpoint, files_per_batch=1
        )

    arrive(6, "a")
    assert load().count() == 6
    assert csv_files(root) == []
    assert load().count() == 6
    arrive(3, "b")
    stored = load()
    assert stored.count() == 9 and csv_files(root) == []
    assert sorted(r.category_id for r in stored.collect()) == sorted([*range(6), *range(3)])


def test_file_delivered_again_under_its_name_is_loaded(spark, tmp_path):
    root, target, checkpoint = f"{tmp_path}/drop", f"{tmp_path}/raw", f"{tmp_path}/cp"
    os.makedirs(root)
    for n, body in enumerate(("1,a", "2,bb", "3,ccc"), 1):
        with open(f"{root}/same {{name}}.csv", "w") as f:
            f.write(f"category_id,category_name,extracted_at\n{body},2024-01-01T00:00:00Z\n")
        stored = ingest.ingest_new_files(spark, root, schemas.RAW_CATEGORIES, target, checkpoint)
        assert sorted(r.category_id for r in stored.collect()) == [*range(1, n + 1)] and csv_files(root) == []


def test_load_that_was_not_recorded_is_loaded_once(spark, tmp_path):
    """Rows written before a crash that came ahead of the record are replaced."""
    root, target, checkpoint = f"{tmp_path}/drop", f"{tmp_path}/raw", f"{tmp_path}/cp"
    df = spark.createDataFrame([(1, "c", datetime(2024, 1, 1))], schemas.RAW_CATEGORIES)
    csv_drop.write_raw_csv(df, root, "categories", "a")
    csv_drop.read_raw_csv(spark, root, schemas.RAW_CATEGORIES).write.parquet(f"{target}/load=0")
    for _ in range(2):
        assert ingest.ingest_new_files(spark, root, schemas.RAW_CATEGORIES, target, checkpoint).count() == 1


def test_incremental_load_takes_old_and_empty_files(spark, tmp_path):
    root, target, checkpoint = f"{tmp_path}/drop", f"{tmp_path}/raw", f"{tmp_path}/cp"
    os.makedirs(root)
    for name, body, at in (
        ("old", "1,a,2024-01-01T00:00:00Z\n", 1_000_000_000), ("new", "2,b,2024-01-01T00:00:00Z\n", None), ("empty", "", None)
    ):
        with open(f"{root}/{name}.csv", "w") as f:
            f.write("category_id,category_name,extracted_at\n" + body)
        if at:
            os.utime(f"{root}/{name}.csv", (at, at))
    for _ in range(2):
        stored = ingest.ingest_new_files(spark, root, schemas.RAW_CATEGORIES, target, checkpoint, files_per_batch=1)
        assert sorted(r.category_id for r in stored.collect()) == [1, 2] and csv_files(root) == []


def test_stream_latest_equals_batch(spark, tmp_path):
    """Ties, late rows and NULL times, over several micro-batches and a restart."""
    data = [
        (f"k{i % 7}", None if i in (20, 41) else datetime(2024, 1, 1 + (i * 5) % 9), i, f"v{i}") for i in range(60)
    ]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, n int, v string")
    source, target, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        state = latest.latest_state(stream, ["k"], "ts", ["n"])
        latest.write_latest(state, target, checkpoint, ["k"], compact_every=2).awaitTermination()

    df.filter("n < 40").repartition(3).write.parquet(source)
    run()
    df.filter("n >= 40").repartition(2).write.mode("append").parquet(source)
    run()
    assert rows(latest.read_latest(spark, target, ["k"])) == rows(latest_per_key(df, "k", "ts", ["n"]))
    # Five batches, compacted after the second and the fourth: a read takes the last compaction and one batch.
    assert sorted(os.listdir(f"{target}/_current")) == ["upto=1", "upto=3"]
    read = latest.read_latest(spark, target, ["k"]).inputFiles()
    assert {f.split("/out/")[1].split("/part")[0] for f in read} == {"_current/upto=3", "batch_id=4"}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "int", "bigint", "double", "decimal(9,2)"])
def test_stream_order_equals_batch_order(spark, kind):
    """Ties and NULLs, in the order column and in the tie-break; the state of one batch is the batch form."""
    at = "null" if kind == "x" else f"cast(case when id % 9 = 0 then null else {'date_add(date\'1969-12-30\', cast(id % 5 as int))' if kind[:2] in ('ti', 'da') else 'id % 5 - 2'} end as {kind})"
    df = spark.range(90).selectExpr("id % 4 as k", f"{at} as at", "case when id % 7 = 0 then null else id % 6 end as n")
    state = latest.latest_state(df, ["k"], "at", ["n"])
    assert rows(state) == rows(latest_per_key(df, "k", "at", ["n"]))


def test_stream_refuses_an_order_by_text(spark):
    with pytest.raises(TypeError, match="string"):
        latest.latest_state(spark.createDataFrame([("a", "b")], "k string, at string"), ["k"], "at")


def test_file_replaced_between_listing_and_reading_is_loaded_once(spark, tmp_path, monkeypatch):
    root, target, checkpoint = f"{tmp_path}/drop", f"{tmp_path}/raw", f"{tmp_path}/cp"
    os.makedirs(root)

    def deliver(name, body):
        with open(f"{root}/{name}.csv", "w") as f:
            f.write(f"category_id,category_name,extracted_at\n{body},2024-01-01T00:00:00Z\n")

    deliver("same", "1,a")
    deliver("other", "2,b")
    real, calls = ingest.load_csv, []

    def replace_then_read(*args):
        if not calls:
            deliver("same", "33,longer")
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(ingest, "load_csv", replace_then_read)
    seen = [sorted(r.category_id for r in ingest.ingest_new_files(spark, root, schemas.RAW_CATEGORIES, target, checkpoint).collect())
            for _ in range(3)]
    assert seen == [[2], [2, 33], [2, 33]] and csv_files(root) == []
