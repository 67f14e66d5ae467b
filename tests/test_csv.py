from __future__ import annotations

import os
from datetime import datetime

import pytest
from conftest import BOOKS, rows

from stacklore import schemas
from stacklore.sources import csv_drop, tables

HEADER = "book_url,upc,num_in_stock,num_reviews,description,extracted_at\n"
GOOD = HEADER + (
    'u1,abc,3,0,"He said ""hi"",\nnew line",2024-01-01T10:00:00.123456+00:00\n'
    'u2,NULL,,0,"",2024-01-02T10:00:00+00:00\n'
    "u3,null,1,0,x,2024-01-02T15:00:00+05:00\n"
)
EXPECTED = [
    ("u1", "abc", 3, 0, 'He said "hi",\nnew line', datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ("u2", None, None, 0, None, datetime(2024, 1, 2, 10)),
    ("u3", None, 1, 0, "x", datetime(2024, 1, 2, 10)),
]


def drop(root, name, text):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_contract(spark, tmp_path):
    drop(tmp_path, "inventory/run=1/a.csv", GOOD)
    drop(tmp_path, "inventory/notes.txt", "not,a,table")
    got = csv_drop.read_raw_csv(spark, f"{tmp_path}/inventory", schemas.RAW_INVENTORY)
    assert rows(got.drop(csv_drop.SOURCE_FILE)) == EXPECTED
    listed = [os.path.basename(r.path) for r in csv_drop.list_stage(spark, f"{tmp_path}/inventory").collect()]
    assert sorted(listed) == ["a.csv", "notes.txt"]


@pytest.mark.parametrize("line", ["u4,abc,1\n", "u4,abc,1,0,x,2024-01-01T10:00:00+00:00,extra\n"])
def test_changed_column_count_fails_even_for_a_count(spark, tmp_path, line):
    drop(tmp_path, "t/a.csv", GOOD)
    drop(tmp_path, "t/b.csv", HEADER + line)
    loaded = csv_drop.read_raw_csv(spark, f"{tmp_path}/t", schemas.RAW_INVENTORY)
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        loaded.count()


def test_columns_bind_by_position(spark, tmp_path):
    drop(tmp_path, "t/a.csv", "x,y,z\n7,Travel,2024-01-01T10:00:00+00:00\n")
    got = csv_drop.read_raw_csv(spark, f"{tmp_path}/t", schemas.RAW_CATEGORIES)
    assert got.select("category_id", "category_name").first() == (7, "Travel")


def test_text_that_is_no_number_fails(spark, tmp_path):
    drop(tmp_path, "t/a.csv", "id,name,at\nseven,Travel,2024-01-01T10:00:00+00:00\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_drop.read_raw_csv(spark, f"{tmp_path}/t", schemas.RAW_CATEGORIES).collect()


def test_roundtrip_keeps_blanks_quotes_and_line_ends(spark, tmp_path):
    texts = ["  lead", "trail  ", 'q"u"o', "a,b", "l1\nl2", "l1\r\nl2", "back\\slash", "\\\"", "nUll"]
    data = [(i, t, datetime(2024, 1, 1, 1, 2, 3, 456789)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, schemas.RAW_CATEGORIES)
    path = csv_drop.write_raw_csv(df, str(tmp_path), "categories", "20240101_0000")
    assert path.endswith("/categories/run=20240101_0000")
    csv_drop.write_raw_csv(df, str(tmp_path), "categories", "20240101_0000")
    got = csv_drop.read_raw_csv(spark, path, schemas.RAW_CATEGORIES).drop(csv_drop.SOURCE_FILE)
    assert rows(got) == sorted(data, key=repr)


def test_load_replace_append_purge(spark, tmp_path):
    spark.sql("create schema if not exists load_test")
    root = str(tmp_path)
    books = spark.createDataFrame(BOOKS, schemas.RAW_BOOKS)

    def load(**how):
        return csv_drop.load_raw(spark, root, "raw_books", schemas.RAW_BOOKS, "load_test", **how)

    csv_drop.write_raw_csv(books.coalesce(1), root, "raw_books", "1", max_records_per_file=2)
    drop(root, "raw_books/keep.txt", "other")
    first = load(purge_files=False)
    assert rows(first.table) == sorted(BOOKS, key=repr)
    assert first.table.schema == schemas.RAW_BOOKS
    report = {r.file_name: r.rows_loaded for r in first.report.collect()}
    assert sum(report.values()) == len(BOOKS) and max(report.values()) == 2
    assert set(report) <= {os.path.basename(f) for f in first.files}
    again = load()
    assert again.table.count() == len(BOOKS)
    left = [f for _, _, files in os.walk(root) for f in files if f.endswith((".csv", ".txt"))]
    assert left == ["keep.txt"]
    csv_drop.write_raw_csv(books.limit(3), root, "raw_books", "2")
    appended = load(mode="append")
    assert appended.table.count() == len(BOOKS) + 3
    assert sum(r.rows_loaded for r in appended.report.collect()) == 3
    csv_drop.write_raw_csv(books.limit(3), root, "raw_books", "3")
    assert load(mode="replace").table.count() == 3


def test_failed_load_keeps_files_and_table(spark, tmp_path):
    spark.sql("create schema if not exists failed_load")
    root = str(tmp_path)
    how = (spark, root, "raw_inventory", schemas.RAW_INVENTORY, "failed_load")
    drop(root, "raw_inventory/a.csv", GOOD)
    csv_drop.load_raw(*how)
    drop(root, "raw_inventory/b.csv", HEADER + "u4,abc,1\n")
    with pytest.raises(Exception):
        csv_drop.load_raw(*how)
    assert os.path.exists(f"{root}/raw_inventory/b.csv")
    assert spark.table("failed_load.raw_inventory").count() > 0


def test_namespaces_and_tables(spark):
    assert tables.layer_schema(None, "dev", "main") == "main"
    assert tables.layer_schema(" STAGING ", "prod", "main") == "STAGING"
    assert tables.layer_schema("MARTS", "ci", "main") == "MARTS_CI"
    assert tables.ensure_namespaces(spark, "ci") == ["RAW", "STAGING_CI", "MARTS_CI"]
    tables.ensure_namespaces(spark, "ci")
    name = tables.qualified("RAW", "raw_books")
    tables.ensure_table(spark, name, schemas.RAW_BOOKS)
    tables.ensure_table(spark, name, schemas.RAW_BOOKS)
    assert spark.table(name).schema == schemas.RAW_BOOKS
    tables.overwrite_table(spark.createDataFrame(BOOKS, schemas.RAW_BOOKS), name)
    assert tables.preview(spark, name, 5).count() == 5
    tables.truncate_table(spark, name)
    assert spark.table(name).count() == 0
    view = tables.publish_view(spark.createDataFrame(BOOKS, schemas.RAW_BOOKS), "stg_view")
    assert view.count() == len(BOOKS)


CATEGORY = "category_id,category_name,extracted_at\n"


def files_in(root):
    return sorted(f for _, _, files in os.walk(root) for f in files if f.endswith(".csv"))


def load_categories(spark, root, space, **how):
    return csv_drop.load_raw(spark, str(root), "raw_categories", schemas.RAW_CATEGORIES, space, **how)


def ids(loaded):
    return sorted(r.category_id for r in loaded.table.collect())


def test_file_replaced_during_a_load_is_neither_lost_nor_mixed(spark, tmp_path, monkeypatch):
    """The other file is loaded and deleted; the replaced one waits in its new form."""
    spark.sql("create schema if not exists replaced_load")
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    drop(tmp_path, "raw_categories/b.csv", CATEGORY + "2,b,\n")
    real = csv_drop.load_csv

    def read_then_deliver(*args):
        rows = real(*args)
        if not os.path.exists(f"{tmp_path}/once"):
            drop(tmp_path, "once", "")
            drop(tmp_path, "raw_categories/b.csv", CATEGORY + "22,new,\n")
        return rows

    monkeypatch.setattr(csv_drop, "load_csv", read_then_deliver)
    first = load_categories(spark, tmp_path, "replaced_load", mode="append")
    assert ids(first) == [1] and first.rows == 1 and files_in(tmp_path) == ["b.csv"]
    second = load_categories(spark, tmp_path, "replaced_load", mode="append")
    assert ids(second) == [1, 22] and files_in(tmp_path) == []


def test_file_delivered_again_after_the_read_is_not_deleted(spark, tmp_path, monkeypatch):
    spark.sql("create schema if not exists again_load")
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    real = csv_drop.overwrite_table

    def store_then_deliver(*args):
        drop(tmp_path, "raw_categories/a.csv", CATEGORY + "2,second,\n")
        return real(*args)

    monkeypatch.setattr(csv_drop, "overwrite_table", store_then_deliver)
    assert ids(load_categories(spark, tmp_path, "again_load")) == [1]
    assert files_in(tmp_path) == ["a.csv"]


@pytest.mark.parametrize("step", ["_append", "purge"])
def test_append_after_a_crash_loads_once(spark, tmp_path, monkeypatch, step):
    space = f"crash_{step.strip('_')}"
    spark.sql(f"create schema if not exists {space}")
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    owner = csv_drop if step == "_append" else csv_drop.deliveries

    def crash(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(owner, step, crash)
        load_categories(spark, tmp_path, space, mode="append")
    assert files_in(tmp_path) == ["a.csv"]
    for _ in range(2):
        assert ids(load_categories(spark, tmp_path, space, mode="append")) == [1]
    assert files_in(tmp_path) == []
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    assert ids(load_categories(spark, tmp_path, space, mode="append")) == [1, 1]


def test_append_to_a_declared_table(spark, tmp_path):
    spark.sql("create schema if not exists declared_load")
    name = tables.qualified("declared_load", "raw_categories")
    tables.ensure_table(spark, name, schemas.RAW_CATEGORIES)
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    assert ids(load_categories(spark, tmp_path, "declared_load", mode="append")) == [1]


def test_replace_without_files_keeps_the_table(spark, tmp_path):
    spark.sql("create schema if not exists empty_load")
    drop(tmp_path, "raw_categories/a.csv", CATEGORY + "1,a,\n")
    load_categories(spark, tmp_path, "empty_load")
    with pytest.raises(FileNotFoundError):
        load_categories(spark, tmp_path, "empty_load")
    assert spark.table("empty_load.raw_categories").count() == 1
