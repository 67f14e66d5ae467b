from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stacklore import schemas  # noqa: E402
from stacklore.plans import marts, staging  # noqa: E402
from stacklore.session import get_session  # noqa: E402

T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def url(slug):
    return f"catalogue/{slug}/index.html"


CATEGORIES = [(2, "Travel", T1), (2, " Travel ", T2), (3, "Mystery", T1), (4, "Historical Fiction", T1)]
BOOKS = [
    ("Alpha", "£12.99", "Three", 2, url("alpha_1"), T1),
    ("Alpha", "£10.00", "Three", 2, url("alpha_1"), T2),
    ("Bravo", "£9.99", "Five", 3, url("bravo_2"), T1),
    ("Charlie", "£15.00", "Five", 2, url("charlie_3"), T1),
    ("Delta", "£15.00", "Five", 3, url("delta_4"), T1),
    ("Echo", "£40.00", "One", 4, url("echo_5"), T1),
    ("Foxtrot", "£39.99", "Two", 4, url("foxtrot_6"), T1),
    ("Golf", "£30.00", "Four", 99, url("golf_7"), T1),
]
INVENTORY = [
    (url("alpha_1"), "abc001", 0, 0, "A quiet walk.", T1),
    (url("bravo_2"), "abc002", 4, 1, "   ", T1),
    (url("charlie_3"), "abc003", 5, 0, 'It\'s a "long" road.', T1),
    (url("delta_4"), "abc004", 22, 2, "A locked room.", T1),
    (url("echo_5"), "abc005", 9, 0, "Old text.", T1),
    (url("echo_5"), "abc005", 1, 0, "New text.", T2),
    (url("golf_7"), "abc007", 3, 0, None, T1),
]


@pytest.fixture(scope="session")
def raw(spark):
    return {
        "raw_books": spark.createDataFrame(BOOKS, schemas.RAW_BOOKS),
        "raw_categories": spark.createDataFrame(CATEGORIES, schemas.RAW_CATEGORIES),
        "raw_inventory": spark.createDataFrame(INVENTORY, schemas.RAW_INVENTORY),
    }


@pytest.fixture(scope="session")
def built(raw):
    tables = {
        "stg_books": staging.stg_books(raw["raw_books"]),
        "stg_categories": staging.stg_categories(raw["raw_categories"]),
        "stg_inventory": staging.stg_inventory(raw["raw_inventory"]),
    }
    tables["dim_books"] = marts.dim_books(
        tables["stg_books"], tables["stg_categories"], tables["stg_inventory"]
    ).cache()
    tables["mart_category_summary"] = marts.mart_category_summary(tables["dim_books"])
    tables["mart_price_bands"] = marts.mart_price_bands(tables["dim_books"])
    return tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
