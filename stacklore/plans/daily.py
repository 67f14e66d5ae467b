"""The daily run: load, stage, build marts, bring the search index up to date, test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stacklore import schemas
from stacklore.operators import postings_log, quality, search
from stacklore.plans import marts, staging
from stacklore.plans.suite import BOOK_SUITE
from stacklore.sources.csv_drop import load_raw
from stacklore.sources.tables import ensure_namespaces, layer_schema, publish, qualified

STAGING = {
    "stg_books": (staging.stg_books, "raw_books"),
    "stg_categories": (staging.stg_categories, "raw_categories"),
    "stg_inventory": (staging.stg_inventory, "raw_inventory"),
}


@dataclass(frozen=True)
class Built:
    """Tables of a finished run and the data-test report."""

    tables: dict[str, DataFrame]
    report: DataFrame


def load_all(
    spark: SparkSession, root: str, mode: str = "replace", purge_files: bool = True
) -> dict[str, DataFrame]:
    """Load the three drops below `root` into the raw layer."""
    ensure_namespaces(spark)
    return {
        table: load_raw(spark, root, table, schema, "RAW", mode, purge_files).table
        for table, schema in schemas.RAW_TABLES.items()
    }


def refresh_search(spark: SparkSession, staged: dict[str, DataFrame], path: str) -> DataFrame:
    """Bring the search index to the state of the staged tables; gives what changed."""
    dim = marts.dim_books(*(staged[name] for name in STAGING), (*marts.DIM_COLUMNS, search.KEY))
    past = postings_log.versions(spark, path)
    docs = search.build_search_docs(dim)
    return postings_log.refresh_postings(docs, path, search.KEY, "search_text", past[-1] + 1 if past else 0)


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    target: str = "dev",
    default: str = "default",
    layer_by_layer: bool = False,
    strict: bool = True,
    search_index: str | None = None,
) -> Built:
    """Staging and mart builds behind views, the search index, then the data tests.

    Failures raise when `strict`; `layer_by_layer` tests staging before any mart is built.
    `search_index` is the folder of the postings log that is kept in step with the dimension.
    """
    ensure_namespaces(spark, target, default)
    staged, space = layer_schema("STAGING", target, default), layer_schema("MARTS", target, default)
    tables = {
        name: publish(model(raw[source]), qualified(staged, name)) for name, (model, source) in STAGING.items()
    }

    def tested(names: list[str]) -> DataFrame:
        result = quality.report(tables, {n: BOOK_SUITE[n] for n in names})
        if strict:
            quality.enforce(result)
        return result

    if layer_by_layer:
        tested(list(STAGING))
    dim = marts.dim_books(*(tables[name] for name in STAGING))
    tables["dim_books"] = publish(dim, qualified(space, "dim_books"))
    for name, model in (
        ("mart_category_summary", marts.mart_category_summary),
        ("mart_price_bands", marts.mart_price_bands),
    ):
        tables[name] = publish(model(tables["dim_books"]), qualified(space, name))
    if search_index is not None:
        refresh_search(spark, tables, search_index)
    return Built(tables, tested(list(BOOK_SUITE)))
