"""Declared schemas. Raw CSV columns bind to these by position."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_STR, _INT, _TS = T.StringType(), T.IntegerType(), T.TimestampNTZType()

RAW_BOOKS = _struct(
    product_name=_STR, price=_STR, rating_word=_STR, category_id=_INT, book_url=_STR, extracted_at=_TS
)
RAW_CATEGORIES = _struct(category_id=_INT, category_name=_STR, extracted_at=_TS)
RAW_INVENTORY = _struct(
    book_url=_STR, upc=_STR, num_in_stock=_INT, num_reviews=_INT, description=_STR, extracted_at=_TS
)
RAW_TABLES = {
    "raw_books": RAW_BOOKS,
    "raw_categories": RAW_CATEGORIES,
    "raw_inventory": RAW_INVENTORY,
}

PAGES = _struct(url=_STR, html=_STR, fetched_at=_TS)

# One entry of a search hit as it leaves the question-answering step.
BOOK_RESULT = _struct(
    book_title=_STR,
    category_name=_STR,
    price_gbp=T.DoubleType(),
    rating_stars=_INT,
    description=_STR,
)
