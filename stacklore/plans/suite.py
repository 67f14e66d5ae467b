"""The data tests declared for the book models, in the order the models are built."""

from __future__ import annotations

from stacklore.operators.quality import (
    AcceptedValues,
    ExpressionIsTrue,
    NotNull,
    Relationships,
    Unique,
)
from stacklore.plans.marts import AVAILABLE, LOW_STOCK, OUT_OF_STOCK
from stacklore.plans.staging import RATING_STARS


def _key(column: str) -> list:
    return [NotNull(column), Unique(column)]


def _count(column: str, expression: str) -> list:
    return [NotNull(column), ExpressionIsTrue(column, expression)]


_STARS = tuple(RATING_STARS.values())

BOOK_SUITE = {
    "stg_books": [
        *_key("book_title"),
        *_count("price_gbp", ">= 0"),
        NotNull("rating_word"),
        AcceptedValues("rating_word", tuple(RATING_STARS)),
        NotNull("rating_stars"),
        AcceptedValues("rating_stars", _STARS),
        NotNull("category_id"),
        *_key("book_url"),
    ],
    "stg_categories": [*_key("category_id"), *_key("category_name")],
    "stg_inventory": [
        *_key("book_url"),
        *_key("upc"),
        *_count("num_in_stock", ">= 0"),
        *_count("num_reviews", ">= 0"),
    ],
    "dim_books": [
        *_key("book_title"),
        NotNull("category_id"),
        Relationships("category_id", "stg_categories", "category_id"),
        NotNull("rating_stars"),
        AcceptedValues("rating_stars", _STARS),
        Unique("upc"),
        AcceptedValues("stock_status", (AVAILABLE, LOW_STOCK, OUT_OF_STOCK)),
    ],
    "mart_category_summary": [
        *_key("category_id"),
        NotNull("category_name"),
        *_count("total_books", "> 0"),
    ],
    "mart_price_bands": [
        *_key("price_band"),
        *_count("total_books", "> 0"),
        NotNull("avg_price_gbp"),
    ],
}
