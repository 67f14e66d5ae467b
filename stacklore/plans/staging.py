"""Staging models: latest row per key, cleaned and typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.functions.measures import lookup
from stacklore.operators.dedup import latest_links, latest_per_key, latest_then_lookup, latest_then_wide

# Rating words of the listing markup.
RATING_STARS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
CURRENCY = "£"


def stg_books(raw_books: DataFrame) -> DataFrame:
    latest = latest_per_key(raw_books, "book_url", "extracted_at")
    return latest.select(
        F.col("product_name").alias("book_title"),
        F.replace("price", F.lit(CURRENCY), F.lit("")).cast("decimal(10,2)").alias("price_gbp"),
        "rating_word",
        lookup(F.col("rating_word"), RATING_STARS).alias("rating_stars"),
        "category_id",
        "book_url",
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )


def stg_categories(raw_categories: DataFrame) -> DataFrame:
    latest = latest_per_key(raw_categories, "category_id", "extracted_at")
    return latest.select(
        "category_id",
        F.trim("category_name").alias("category_name"),
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )


def stg_inventory(raw_inventory: DataFrame, late_text: bool = False, texts: DataFrame | None = None) -> DataFrame:
    """Latest inventory per book. Without a `description` column the rest is the same.

    The text is the last tie-break, so leaving it out (for marts that do not use it) picks
    rows with the same other values, and the text is then neither read nor sorted. With
    `late_text` the texts are read for the latest rows only, in a second pass: for tables
    with many scrapes per book. Where the texts are a table of their own, `texts` (text_key,
    description), the scrapes have a `text_key` in place of them, and no second pass is needed.
    """
    if texts is not None:
        latest = latest_then_lookup(raw_inventory, "book_url", "extracted_at", "text_key", texts, ["description"])
    elif late_text and "description" in raw_inventory.columns:
        latest = latest_then_wide(raw_inventory, "book_url", "extracted_at", ["description"])
    else:
        latest = latest_per_key(raw_inventory, "book_url", "extracted_at")
    return _inventory(latest, *([_text()] if "description" in latest.columns else []))


def stg_inventory_linked(raw_inventory: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inventory, texts): `stg_inventory` with `text_key` in place of the description, and the texts by that key.

    For models that join more to the inventory: the texts are joined last, so that they are moved once.
    """
    latest, texts = latest_links(raw_inventory, "book_url", "extracted_at", "text_key", texts, ["description"])
    return _inventory(latest, "text_key"), texts.select("text_key", _text())


def _text() -> Column:
    return F.nullif(F.trim("description"), F.lit("")).alias("description")


def _inventory(latest: DataFrame, *more: str | Column) -> DataFrame:
    return latest.select(
        "book_url",
        F.upper("upc").alias("upc"),
        "num_in_stock",
        "num_reviews",
        *more,
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )
