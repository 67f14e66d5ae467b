from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stacklore.operators import quality as q
from stacklore.plans.suite import BOOK_SUITE


def test_suite_has_all_declared_tests():
    counts = {table: len(tests) for table, tests in BOOK_SUITE.items()}
    assert counts == {
        "stg_books": 11, "stg_categories": 4, "stg_inventory": 8, "dim_books": 8,
        "mart_category_summary": 5, "mart_price_bands": 5,
    }


def test_report_on_fixture(built):
    report = q.report(built, BOOK_SUITE)
    assert report.count() == 41
    assert rows(report.filter("failures > 0")) == [
        ("dim_books", "category_id", "relationships", 1),
        ("mart_category_summary", "category_name", "not_null", 1),
    ]
    with pytest.raises(AssertionError, match="dim_books.category_id relationships: 1"):
        q.enforce(report)


def test_every_kind_can_fail(spark):
    child = spark.createDataFrame(
        [(1, "a", 5), (1, "b", -1), (None, "zz", None), (7, "zz", 2), (7, "yy", 1)], "id int, v string, n int"
    )
    parent = spark.createDataFrame([(1,)], "pk int")
    tables = {"child": child, "parent": parent}
    tests = [
        q.NotNull("id"), q.Unique("id"), q.AcceptedValues("v", ("a", "b")),
        q.Relationships("id", "parent", "pk"), q.ExpressionIsTrue("n", ">= 0"),
    ]
    failures = {r.test_name: r.failures for r in q.report(tables, {"child": tests}).collect()}
    assert failures == {
        "not_null": 1, "unique": 2, "accepted_values": 2, "relationships": 2, "expression_is_true": 1
    }
    found = {t.kind: rows(q.violations(tables, "child", t)) for t in tests}
    assert found["not_null"] == [(None, "zz", None)]
    assert found["unique"] == [(1, 2), (7, 2)]
    assert found["accepted_values"] == [("yy", 1), ("zz", 2)]
    assert found["relationships"] == [(7, "yy", 1), (7, "zz", 2)]
    assert found["expression_is_true"] == [(1, "b", -1)]


def test_passing_suite_does_not_raise(built):
    q.enforce(q.report(built, {"stg_books": BOOK_SUITE["stg_books"]}))
    empty = built["stg_books"].filter(F.lit(False))
    assert q.report({"stg_books": empty}, {"stg_books": BOOK_SUITE["stg_books"]}).agg(F.sum("failures")).first()[0] == 0
