"""Mart models: the joined dimension, the category summary and the price bands."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.functions.measures import band, exact_mean, mean2
from stacklore.operators.dedup import with_lookup
from stacklore.operators.ranking import rank_in_group

# Stock labels and price bands of the mart layer.
OUT_OF_STOCK, LOW_STOCK, AVAILABLE = "Out of Stock", "Low Stock", "Available"
LOW_STOCK_BELOW = 5
PRICE_EDGES = (10, 20, 30, 40)
PRICE_LABELS = (
    "A: Under £10",
    "B: £10–£20",
    "C: £20–£30",
    "D: £30–£40",
    "E: £40 and above",
)

CATEGORY_COLUMNS = {"category_name"}
INVENTORY_COLUMNS = {"upc", "num_in_stock", "num_reviews", "description", "stock_status"}
DIM_COLUMNS = (
    "book_title", "price_gbp", "rating_stars", "rating_word", "category_id", "category_name",
    "upc", "num_in_stock", "num_reviews", "description", "stock_status", "extracted_at",
)


def stock_status(num_in_stock: Column) -> Column:
    """Stock label; an unknown stock counts as available."""
    return (
        F.when(num_in_stock == 0, OUT_OF_STOCK)
        .when(num_in_stock < LOW_STOCK_BELOW, LOW_STOCK)
        .otherwise(AVAILABLE)
    )


def price_band(price: Column) -> Column:
    return band(price, PRICE_EDGES, PRICE_LABELS)


def dim_books(
    books: DataFrame, categories: DataFrame, inventory: DataFrame, columns: tuple[str, ...] = DIM_COLUMNS,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Books left-joined to inventory and categories.

    Inventory comes first: both sides leave staging partitioned by `book_url`, so that
    join needs no further shuffle. Categories are broadcast when measured small; else a
    hot category is split by the skew join. A dimension none of whose `columns` is asked
    for is not joined (staging keys are unique, so the rows are the same). With `texts`
    (text_key, description) the inventory has a `text_key` in place of descriptions, and
    those are joined last: the long column is dealt once, and the rows it meets are hashed.
    """
    wanted = set(columns)
    out = books
    if wanted & INVENTORY_COLUMNS:
        stock = inventory.drop("extracted_at").withColumnRenamed("book_url", "_stock_url")
        out = out.join(stock, F.col("book_url") == F.col("_stock_url"), "left")
        out = out.withColumn("stock_status", stock_status(F.col("num_in_stock")))
    if wanted & CATEGORY_COLUMNS:
        names = categories.select(F.col("category_id").alias("_category"), "category_name")
        out = out.join(names, F.col("category_id") == F.col("_category"), "left")
    if texts is not None and "description" in wanted:
        out = with_lookup(out, texts, "text_key")
    return out.select(*columns)


def mart_category_summary(dim: DataFrame) -> DataFrame:
    """One row per category, most books first."""
    return (
        dim.groupBy("category_id", "category_name")
        .agg(
            F.count(F.lit(1)).alias("total_books"),
            mean2(F.col("price_gbp")).alias("avg_price_gbp"),
            F.min("price_gbp").alias("min_price_gbp"),
            F.max("price_gbp").alias("max_price_gbp"),
            mean2(F.col("rating_stars")).alias("avg_rating_stars"),
            F.sum("num_in_stock").alias("total_stock"),
            F.count_if(F.col("stock_status") == OUT_OF_STOCK).alias("out_of_stock_count"),
            F.count_if(F.col("stock_status") == LOW_STOCK).alias("low_stock_count"),
        )
        .orderBy(F.desc("total_books"), "category_id", "category_name")
    )


def mart_price_bands(dim: DataFrame, tie: str = "independent") -> DataFrame:
    """One row per price band with its best book: highest rating, then lowest price.

    `tie="independent"` takes the largest title and the largest category among equally
    ranked books, each on its own; `tie="single_row"` takes both from one book.

    Only the rank-1 books of a band matter, and they share one (rating, price). So the
    rows are aggregated per (band, rating, price) with map-side combine, and the few
    resulting rows per band are aggregated again. No window over a band is needed: five
    bands would mean five tasks sorting the whole table.
    """
    if tie not in ("independent", "single_row"):
        raise ValueError(f"unknown tie rule {tie!r}")
    banded = dim.select(
        price_band(F.col("price_gbp")).alias("price_band"),
        "price_gbp",
        "rating_stars",
        "book_title",
        "category_name",
    )
    best = F.struct(F.col("book_title").alias("title"), F.col("category_name").alias("category"))
    per_key = banded.groupBy("price_band", "rating_stars", "price_gbp").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("book_title").alias("_title"),
        F.max("category_name").alias("_category"),
        F.max(best).alias("_book"),
    )
    if tie == "independent":
        leader = F.struct(F.col("_title").alias("title"), F.col("_category").alias("category"))
    else:
        leader = F.col("_book")
    # Largest value wins; NULL is the largest rating and the largest (worst) price.
    standing = F.struct(
        F.col("rating_stars").isNull().alias("a"),
        F.col("rating_stars").alias("b"),
        F.col("price_gbp").isNotNull().alias("c"),
        (-F.col("price_gbp")).alias("d"),
    )
    rows = F.col("_n").cast("decimal(18,0)")
    priced = F.sum(F.when(F.col("price_gbp").isNotNull(), F.col("_n")))
    rated = F.sum(F.when(F.col("rating_stars").isNotNull(), F.col("_n")))
    return (
        per_key.groupBy("price_band")
        .agg(
            F.sum("_n").alias("total_books"),
            exact_mean(F.sum(F.col("price_gbp") * rows), priced).alias("avg_price_gbp"),
            exact_mean(F.sum(F.col("rating_stars") * rows), rated).alias("avg_rating_stars"),
            F.max_by(leader, standing).alias("_leader"),
        )
        .select(
            "price_band",
            "total_books",
            "avg_price_gbp",
            "avg_rating_stars",
            F.col("_leader.title").alias("top_rated_book"),
            F.col("_leader.category").alias("top_rated_book_category"),
        )
        .orderBy("price_band")
    )


def price_rank(dim: DataFrame) -> DataFrame:
    """Every book with its rank inside its price band."""
    banded = dim.withColumn("price_band", price_band(F.col("price_gbp")))
    return rank_in_group(
        banded,
        by=["price_band"],
        order=[("rating_stars", "desc"), ("price_gbp", "asc")],
        bucket=F.floor(F.col("price_gbp") / Decimal(1000)),
        out="rank_in_band",
    )
