"""The physical plans the operators were written for."""

from __future__ import annotations

import pytest
from conftest import BOOKS, CATEGORIES, INVENTORY, plan
from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.operators import lexical
from stacklore.operators.dedup import latest_per_key
from stacklore.operators.joins import keep_keys
from stacklore.operators.quality import relationships
from stacklore.plans import marts, staging
from stacklore.workload import tables as t
from stacklore.workload.queries import REGISTRY

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def fresh(spark):
    """Fresh tables: no plan over them is cached."""
    return {
        "raw_books": spark.createDataFrame(BOOKS, schemas.RAW_BOOKS),
        "raw_categories": spark.createDataFrame(CATEGORIES, schemas.RAW_CATEGORIES),
        "raw_inventory": spark.createDataFrame(INVENTORY, schemas.RAW_INVENTORY),
    }


@pytest.fixture
def merge_joins(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_dedup_cuts_rows_before_the_shuffle(fresh):
    text = plan(latest_per_key(fresh["raw_books"], "book_url", "extracted_at"))
    final, exchange, partial = text.index("Final"), text.index("Exchange hashpartitioning"), text.index("Partial")
    assert final < exchange < partial


def test_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    df = latest_per_key(hot, "k", "id")
    df.collect()
    assert _shuffle_rows(df._jdf.queryExecution().executedPlan().finalPhysicalPlan()) == 60_000 + 6


def _shuffle_rows(node):
    if "ShuffleQueryStage" in node.nodeName():
        return node.plan().metrics().apply("shuffleRecordsWritten").value()
    children = node.children()
    return next((n for n in (_shuffle_rows(children.apply(i)) for i in range(children.size())) if n is not None), None)


def test_inventory_join_reuses_the_dedup_shuffle(merge_joins, fresh):
    dim = marts.dim_books(
        staging.stg_books(fresh["raw_books"]), staging.stg_categories(fresh["raw_categories"]),
        staging.stg_inventory(fresh["raw_inventory"]),
    )
    text = plan(dim)
    # One exchange per deduplicated table, and one of the joined rows for the category join.
    assert text.count("Exchange hashpartitioning(book_url") == 2
    assert text.count("Exchange hashpartitioning") == 4


def test_late_text_is_neither_sorted_nor_windowed(spark):
    """Texts are joined to the latest rows only, which a broadcast cuts out before."""
    df = staging.stg_inventory(t.raw_inventory(spark, DATA), late_text=True)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Sort" not in text
    assert text.index("LeftOuter") < text.index("LeftSemi")  # from the top: the winners first, then their texts


def test_unused_dimensions_are_not_joined(fresh):
    s = [f(fresh[n]) for f, n in (
        (staging.stg_books, "raw_books"), (staging.stg_categories, "raw_categories"),
        (staging.stg_inventory, "raw_inventory"),
    )]
    assert "Join" not in plan(marts.dim_books(*s, columns=("book_title", "price_gbp")))


def test_hot_category_is_split_in_the_skew_join(merge_joins):
    spark = merge_joins
    tuned = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in tuned.items():
        spark.conf.set(key, value)
    try:
        books = spark.range(0, 60_000, 1, 12).select(
            F.concat(F.lit("t"), F.col("id").cast("string")).alias("book_title"),
            F.when(F.col("id") % 3 > 0, 1).otherwise((F.col("id") % 97).cast("int")).alias("category_id"),
        )
        cats = spark.range(97).select(
            F.col("id").cast("int").alias("category_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("category_name")
        )
        dim = marts.dim_books(books, cats, None, columns=("book_title", "category_id", "category_name"))
        counted = dim.groupBy("category_id", "category_name").agg(
            F.count(F.lit(1)).alias("n"), F.max("book_title").alias("t")
        )
        assert counted.agg(F.sum("n")).first()[0] == 60_000
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in tuned:
            spark.conf.unset(key)


def test_child_rows_are_not_shuffled_to_find_orphans(spark):
    orders, customer = t.table(spark, DATA, "orders"), t.table(spark, DATA, "customer")
    text = plan(relationships(orders, "o_custkey", customer, "c_custkey"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    many = keep_keys(orders, orders.select("o_custkey"), "o_custkey", limit=10)
    assert many.count() == orders.count()


def test_price_bands_need_no_window(spark, built):
    dim = spark.createDataFrame([], built["dim_books"].schema)
    assert "Window" not in plan(marts.mart_price_bands(dim))


def test_no_cross_joins(spark):
    for name in ("mart_price_bands", "price_rank", "dq_report", "search_lexical_topk", "search_vector_topk",
                 "answer_batch", "books_from_pages", "inventory_from_pages", "index_refresh_diff"):
        text = plan(REGISTRY[name](spark, DATA))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_scans_read_needed_columns_only(spark):
    text = plan(REGISTRY["mart_price_bands"](spark, DATA))
    assert "text" not in "".join(line for line in text.splitlines() if "ReadSchema" in line)
    lines = plan(t.raw_inventory(spark, DATA, with_text=False).filter("num_reviews = 1"))
    assert "PushedFilters: [IsNotNull(l_linenumber), EqualTo(l_linenumber,1)]" in lines


def test_scores_are_summed_where_the_postings_lie(merge_joins):
    spark = merge_joins
    docs = spark.createDataFrame([(i, f"w{i % 5} the x{i}") for i in range(50)], "id long, body string")
    q = spark.createDataFrame([(1, "w1 x3 the")], "qid long, question string")
    text = plan(lexical.search_lexical(q, lexical.build_lexical_index(docs, "id", "body")))
    before_scores = text[: text.index("BroadcastHashJoin")]
    # Above the join with the question terms only the k best rows are shuffled, by question.
    assert before_scores.count("Exchange") == 1 and "Exchange hashpartitioning(qid" in before_scores
    assert "WindowGroupLimit" in before_scores
