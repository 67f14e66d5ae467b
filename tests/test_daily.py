from __future__ import annotations

import os
import threading

import pytest
from conftest import BOOKS, CATEGORIES, INVENTORY, rows
from test_models import BANDS

from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.operators import blockmax, postings_log, search
from stacklore.plans import daily
from stacklore.sources import tables
from stacklore.sources.csv_drop import write_raw_csv


def drops(spark, root, books=BOOKS):
    for name, data in (("raw_books", books), ("raw_categories", CATEGORIES), ("raw_inventory", INVENTORY)):
        write_raw_csv(spark.createDataFrame(data, schemas.RAW_TABLES[name]), root, name)


def test_run_from_csv_to_marts(spark, tmp_path):
    root = str(tmp_path)
    drops(spark, root)
    raw = daily.load_all(spark, root)
    assert not [f for _, _, files in os.walk(root) for f in files if f.endswith(".csv")]
    built = daily.build(spark, raw, target="ci", strict=False)
    assert rows(spark.table("MARTS_CI.mart_price_bands")) == sorted(BANDS, key=repr)
    assert built.report.filter("failures > 0").count() == 2
    with pytest.raises(AssertionError, match="relationships"):
        daily.build(spark, raw, target="ci")


def test_layer_by_layer_stops_before_the_marts(spark, tmp_path):
    bad = [("Alpha", "£-1.00", "Three", 2, "u", BOOKS[0][-1])]
    root = str(tmp_path)
    drops(spark, root, bad)
    raw = daily.load_all(spark, root)
    with pytest.raises(AssertionError, match="stg_books.price_gbp expression_is_true: 1"):
        daily.build(spark, raw, target="prod", layer_by_layer=True)
    assert not spark.catalog.tableExists("MARTS.dim_books")


def test_another_session_reads_the_layers(spark, tmp_path):
    drops(spark, str(tmp_path))
    daily.build(spark, daily.load_all(spark, str(tmp_path)), target="ci", strict=False)
    other = spark.newSession()
    assert rows(other.table("MARTS_CI.mart_price_bands")) == sorted(BANDS, key=repr)
    assert other.table("STAGING_CI.stg_books").count() == 7


def test_readers_during_rebuilds_never_miss_a_table(spark):
    spark.sql("create schema if not exists rebuilt")
    name = tables.qualified("rebuilt", "t")
    tables.overwrite_table(spark.range(10), name)  # as stored by an earlier release
    tables.publish(spark.range(10), name)
    stop, seen, failed = threading.Event(), [], []

    def read():
        session = spark.newSession()
        while not stop.is_set():
            try:
                seen.append(session.table(name).count())
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in (20, 30, 40):
        tables.publish(spark.range(n), name, keep=5)
    broken = spark.range(5).select(F.raise_error(F.lit("broken build")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken build"):
        tables.publish(broken, name, keep=5)
    stop.set()
    reader.join()
    assert not failed and set(seen) <= {10, 20, 30, 40} and seen == sorted(seen)
    assert spark.table(name).count() == 40
    tables.publish(spark.range(50), name)
    assert spark.table(name).count() == 50 and len(tables.builds(spark, name)) == 2


def test_search_index_follows_the_daily_run(spark, tmp_path):
    def search_now():
        index = blockmax.block_index(postings_log.open_postings(spark, f"{tmp_path}/index", search.KEY))
        asked = spark.createDataFrame([(1, "a quiet walk"), (2, "new text")], "qid long, question string")
        return {r.qid: r.book_title for r in search.search(asked, index, k=1).collect()}

    drops(spark, f"{tmp_path}/a")
    daily.build(spark, daily.load_all(spark, f"{tmp_path}/a"), target="ci", strict=False, search_index=f"{tmp_path}/index")
    assert search_now() == {1: "Alpha", 2: "Echo"}
    drops(spark, f"{tmp_path}/b", [r for r in BOOKS if r[0] != "Alpha"])
    daily.build(spark, daily.load_all(spark, f"{tmp_path}/b"), target="ci", strict=False, search_index=f"{tmp_path}/index")
    assert postings_log.versions(spark, f"{tmp_path}/index") == [0, 1]
    assert search_now().get(1) != "Alpha" and search_now()[2] == "Echo"
