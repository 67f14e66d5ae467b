from __future__ import annotations

from datetime import datetime
from decimal import Decimal as D

import pytest
from conftest import BOOKS, T1, T2, rows
from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.functions.measures import cosine, exact_mean, plain_price
from stacklore.operators.dedup import first_seen, latest_per_key, latest_then_wide
from stacklore.plans import marts, staging


def test_categories(built):
    assert rows(built["stg_categories"]) == [
        (2, "Travel", T2), (3, "Mystery", T1), (4, "Historical Fiction", T1)
    ]


def test_dimension(built):
    got = rows(
        built["dim_books"].select(
            "book_title", "price_gbp", "rating_stars", "category_name", "upc", "num_in_stock",
            "description", "stock_status",
        )
    )
    assert got == [
        ("Alpha", D("10.00"), 3, "Travel", "ABC001", 0, "A quiet walk.", "Out of Stock"),
        ("Bravo", D("9.99"), 5, "Mystery", "ABC002", 4, None, "Low Stock"),
        ("Charlie", D("15.00"), 5, "Travel", "ABC003", 5, 'It\'s a "long" road.', "Available"),
        ("Delta", D("15.00"), 5, "Mystery", "ABC004", 22, "A locked room.", "Available"),
        ("Echo", D("40.00"), 1, "Historical Fiction", "ABC005", 1, "New text.", "Low Stock"),
        ("Foxtrot", D("39.99"), 2, "Historical Fiction", None, None, None, "Available"),
        ("Golf", D("30.00"), 4, None, "ABC007", 3, None, "Low Stock"),
    ]
    assert tuple(built["dim_books"].columns) == marts.DIM_COLUMNS


def test_summary(built):
    assert rows(built["mart_category_summary"]) == [
        (2, "Travel", 2, 12.5, D("10.00"), D("15.00"), 4.0, 5, 1, 0),
        (3, "Mystery", 2, 12.5, D("9.99"), D("15.00"), 5.0, 26, 0, 1),
        (4, "Historical Fiction", 2, 40.0, D("39.99"), D("40.00"), 1.5, 1, 0, 1),
        (99, None, 1, 30.0, D("30.00"), D("30.00"), 4.0, 3, 0, 1),
    ]


BANDS = [
    ("A: Under £10", 1, 9.99, 5.0, "Bravo", "Mystery"),
    ("B: £10–£20", 3, 13.33, 4.33, "Delta", "Travel"),
    ("D: £30–£40", 2, 35.0, 3.0, "Golf", None),
    ("E: £40 and above", 1, 40.0, 1.0, "Echo", "Historical Fiction"),
]


def test_bands(built):
    assert [tuple(r) for r in built["mart_price_bands"].collect()] == BANDS


def test_bands_single_row(built):
    got = marts.mart_price_bands(built["dim_books"], tie="single_row").collect()
    assert tuple(got[1]) == ("B: £10–£20", 3, 13.33, 4.33, "Delta", "Mystery")


def test_bands_equal_the_window_form_with_nulls(spark):
    data = [
        (f"t{i}", D(i % 7 * 9) if i % 5 else None, i % 4 or None, f"c{i % 3}") for i in range(200)
    ]
    dim = spark.createDataFrame(
        data, "book_title string, price_gbp decimal(10,2), rating_stars int, category_name string"
    )
    dim.createOrReplaceTempView("dim_with_nulls")
    window_form = spark.sql(
        """
        select price_band, count(*) n,
               max(case when r = 1 then book_title end) t, max(case when r = 1 then category_name end) c
        from (select *, rank() over (partition by price_band
                     order by rating_stars desc nulls first, price_gbp asc nulls last) r
              from (select *, case when price_gbp < 10 then 'A: Under £10' when price_gbp < 20 then 'B: £10–£20'
                    when price_gbp < 30 then 'C: £20–£30' when price_gbp < 40 then 'D: £30–£40'
                    else 'E: £40 and above' end price_band from dim_with_nulls))
        group by price_band"""
    )
    ours = marts.mart_price_bands(dim).select(
        "price_band", "total_books", "top_rated_book", "top_rated_book_category"
    )
    assert rows(ours) == rows(window_form)
    ranked = marts.price_rank(dim).select("book_title", "rank_in_band")
    by_window = spark.sql(
        """
        select book_title, rank() over (partition by case when price_gbp < 10 then 1 when price_gbp < 20 then 2
               when price_gbp < 30 then 3 when price_gbp < 40 then 4 else 5 end
               order by rating_stars desc nulls first, price_gbp asc nulls last) rank_in_band
        from dim_with_nulls"""
    )
    assert rows(ranked) == rows(by_window)


def test_rank_across_buckets(spark):
    data = [(f"t{i}", D(i * 37 % 9000), i % 3) for i in range(300)]
    dim = spark.createDataFrame(data, "book_title string, price_gbp decimal(10,2), rating_stars int")
    ranked = {r.book_title: r.rank_in_band for r in marts.price_rank(dim).collect() if r.price_band[0] == "E"}
    top = [(t, p, s) for t, p, s in data if p >= 40]
    want = {t: 1 + sum((s2 > s) or (s2 == s and p2 < p) for _, p2, s2 in top) for t, p, s in top}
    assert ranked == want


def test_latest_is_independent_of_partitioning(spark):
    """Equal times are settled by the other columns; a NULL time counts as newest."""
    data = [
        ("X", f"£{i % 9}.00", "One", 1, f"u{i % 11}", None if i % 13 == 0 else datetime(2024, 1, 1 + i % 3))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, schemas.RAW_BOOKS)
    results = [
        rows(latest_per_key(df.orderBy(F.rand(seed)).repartition(n), "book_url", "extracted_at"))
        for seed, n in ((1, 1), (2, 5), (3, 13))
    ]
    assert results[0] == results[1] == results[2]
    want = {}
    for r in data:
        key = (r[5] is not None, -(r[5].timestamp() if r[5] else 0), r[:4])
        if r[4] not in want or key < want[r[4]][0]:
            want[r[4]] = (key, r)
    assert results[0] == sorted((r for _, r in want.values()), key=repr)


def test_long_columns_read_late_give_the_same(spark):
    """Ties in everything but the text, repeated rows, NULL keys, times and texts."""
    def row(i, texts):
        at = None if i % 13 == 0 else datetime(2024, 1, 1 + i % 3)
        return (None if i % 17 == 0 else f"u{i % 11}", "upc", i % 2, i % 3, texts[i % len(texts)], at)

    ties = [row(i, ["b", "a", None, "", "c" * 5000]) for i in range(400)]
    apart = [(f"u{i // 2}", "upc", 1, 1, "old" if i % 2 else "new", datetime(2024, 1, 2 - i % 2)) for i in range(60)]
    for data in (ties, apart, ties + ties, []):
        df = spark.createDataFrame(data, schemas.RAW_INVENTORY).repartition(5)
        late = latest_then_wide(df, "book_url", "extracted_at", ["description"])
        assert late.columns == df.columns
        assert rows(late) == rows(latest_per_key(df, "book_url", "extracted_at"))
        assert rows(staging.stg_inventory(df, late_text=True)) == rows(staging.stg_inventory(df))


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, ts int")
    assert rows(latest_per_key(df, "k", "ts")) == [("a", 1), (None, 2)]


def test_first_seen_order(spark):
    df = spark.createDataFrame(
        [("t", 1, 0, 0), ("t", 0, 2, 0), ("t", 0, 1, 5), ("s", 3, 0, 0)], "title string, c int, p int, i int"
    )
    for n in (1, 3, 8):
        assert rows(first_seen(df.repartition(n), "title", ["c", "p", "i"])) == [("s", 3, 0, 0), ("t", 0, 1, 5)]


def test_bad_price_is_an_error(spark):
    bad = spark.createDataFrame([(*BOOKS[0][:1], "£abc", *BOOKS[0][2:])], schemas.RAW_BOOKS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_books(bad).collect()


def test_unknown_rating_word_is_null(spark):
    odd = spark.createDataFrame([(*BOOKS[0][:2], "Six", *BOOKS[0][3:])], schemas.RAW_BOOKS)
    assert staging.stg_books(odd).first().rating_stars is None


def test_exact_mean_and_price_text(spark):
    df = spark.createDataFrame([(D("39.99"),), (D("40.00"),)], "p decimal(10,2)")
    mean = df.agg(exact_mean(F.sum("p"), F.count("p")).alias("m")).first().m
    assert mean == 40.0
    assert df.filter("p > 99").agg(exact_mean(F.sum("p"), F.count("p")).alias("m")).first().m is None
    shown = {p: spark.range(1).select(plain_price(F.lit(D(p))).alias("v")).first().v for p in ("44.10", "10.00", "9.99")}
    assert shown == {"44.10": "44.1", "10.00": "10.0", "9.99": "9.99"}


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert abs(got[0] - 0.5**0.5) < 1e-12 and got[1] is None
