"""Registered queries: every operator over the given tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.functions.json import json_field
from stacklore.functions.text import element_body, inner_text, from_end
from stacklore.operators import blockmax, dense, extract, hyperplane, lexical, postings_log, quality, refresh, search
from stacklore.operators.dedup import first_seen, latest_per_key
from stacklore.plans import answer as answers
from stacklore.plans import marts, suite
from stacklore.session import materialise, scratch_path, tune
from stacklore.sources import csv_drop
from stacklore.streaming import ingest, latest
from stacklore.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    REGISTRY[function.__name__] = run
    return function


# --- latest and first rows ---------------------------------------------------------------


@query
def dedup_latest(spark, d):
    return latest_per_key(t.table(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query
def dedup_first_seen(spark, d):
    return first_seen(t.table(spark, d, "part"), "p_name", ["p_partkey"])


# --- staging and marts -------------------------------------------------------------------


@query
def stg_books(spark, d):
    return t.staged(spark, d)["stg_books"]


@query
def stg_categories(spark, d):
    return t.staged(spark, d)["stg_categories"]


@query
def stg_inventory(spark, d):
    return t.staged(spark, d)["stg_inventory"]


@query
def dim_books(spark, d):
    return t.dimension(spark, d)


@query
def stock_status_counts(spark, d):
    dim = t.dimension(spark, d, ("stock_status",))
    return dim.groupBy("stock_status").agg(F.count(F.lit(1)).alias("n_books"))


@query
def mart_category_summary(spark, d):
    return marts.mart_category_summary(t.dimension(spark, d, t.NARROW))


@query
def mart_price_bands(spark, d):
    return marts.mart_price_bands(t.dimension(spark, d, t.NARROW))


@query
def mart_price_bands_single_row(spark, d):
    return marts.mart_price_bands(t.dimension(spark, d, t.NARROW), tie="single_row")


@query
def price_rank(spark, d):
    columns = ("book_title", "price_gbp", "rating_stars", "category_name")
    dim = materialise(t.dimension(spark, d, columns), "dim-books")
    return marts.price_rank(dim)


# --- files and streams -------------------------------------------------------------------


def _documents_as_inventory(spark, d):
    return t.table(spark, d, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("book_url"),
        F.col("source").alias("upc"),
        F.col("n_chars").cast("int").alias("num_in_stock"),
        F.lit(None).cast("int").alias("num_reviews"),
        F.col("text").alias("description"),
        F.expr("timestamp_ntz'2024-01-01 10:00:00.123456'").alias("extracted_at"),
    )


@query
def csv_roundtrip(spark, d):
    path = csv_drop.write_raw_csv(
        _documents_as_inventory(spark, d), scratch_path(spark, "csv"), "inventory"
    )
    return csv_drop.read_raw_csv(spark, path, schemas.RAW_INVENTORY).drop(csv_drop.SOURCE_FILE)


@query
def load_report(spark, d):
    path = csv_drop.write_raw_csv(
        t.raw_books(spark, d), scratch_path(spark, "csv"), "books", max_records_per_file=1000
    )
    report = csv_drop.load_report(csv_drop.read_raw_csv(spark, path, schemas.RAW_BOOKS))
    return report.agg(F.sum("rows_loaded").alias("rows_loaded"), F.max("rows_loaded").alias("largest_file"))


def _loads(spark, d, mode, purge_files, deliveries):
    """The raw table after loading book files, one load per delivered part of them."""
    space, root = f"loads_{uuid.uuid4().hex}", scratch_path(spark, "drops")
    spark.sql(f"CREATE SCHEMA `{space}` LOCATION '{scratch_path(spark, 'tables')}'")
    books = t.raw_books(spark, d)
    for stamp, part in enumerate(deliveries):
        if part is not None:
            csv_drop.write_raw_csv(books.filter(part), root, "raw_books", str(stamp))
        loaded = csv_drop.load_raw(spark, root, "raw_books", schemas.RAW_BOOKS, space, mode, purge_files)
    return loaded


@query
def load_replace(spark, d):
    """Two loads; the second one's files are all the table holds."""
    return _loads(spark, d, "replace", True, ["category_id < 10", "category_id >= 10"]).table


@query
def load_append(spark, d):
    return _loads(spark, d, "append", True, ["category_id < 10", "category_id >= 10"]).table


@query
def load_redelivered(spark, d):
    """Files stay after their load: a load that finds nothing new adds nothing, the next one only what is new."""
    loaded = _loads(spark, d, "append", False, ["category_id < 10", None, "category_id >= 10"])
    rows = loaded.table.groupBy("category_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("last_load", F.lit(loaded.rows))


@query
def incremental_load(spark, d):
    events = t.table(spark, d, "events")
    root = scratch_path(spark, "incremental")
    target, checkpoint = scratch_path(spark, "loaded"), scratch_path(spark, "checkpoint")
    # Two arrivals, two runs on one checkpoint: the second loads only what is new.
    for stamp, arrived in (("a", events.filter("ts < '2024-01-15'")), ("b", events.filter("ts >= '2024-01-15' or ts is null"))):
        csv_drop.write_raw_csv(arrived, root, "events", stamp)
        stored = ingest.ingest_new_files(spark, f"{root}/events", events.schema, target, checkpoint)
    return stored.drop(csv_drop.SOURCE_FILE)


@query
def stream_latest(spark, d):
    events = t.table(spark, d, "events")
    arrivals = scratch_path(spark, "arrivals")
    events.repartition(4, "event_id").write.parquet(arrivals)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    keys = ["user_id", "event_type"]
    state = latest.latest_state(stream, keys, "ts", ["event_id"])
    target = scratch_path(spark, "latest")
    latest.write_latest(state, target, scratch_path(spark, "checkpoint"), keys).awaitTermination()
    return latest.read_latest(spark, target, keys)


# --- pages as given ----------------------------------------------------------------------


@query
def page_links(spark, d):
    links = extract.page_links(t.text_table(spark, d, "pages", "page_id"))
    return links.select("url", "pos", "href")


@query
def url_resolve(spark, d):
    links = extract.page_links(t.text_table(spark, d, "pages", "page_id"))
    return links.groupBy("target").agg(F.count(F.lit(1)).alias("n_links"))


@query
def page_heading(spark, d):
    pages = t.text_table(spark, d, "pages", "page_id")
    return pages.select(
        "page_id",
        inner_text(element_body(F.col("html"), "h1")).alias("heading"),
        from_end(F.col("url"), "/", 2).alias("lang_part"),
        F.regexp_extract(from_end(F.col("url"), "/", 1), r"\d+", 0).alias("number_part"),
    )


@query
def page_blocks(spark, d):
    blocks = F.regexp_extract_all(F.col("html"), F.lit(r"(?s)<p>(.*?)</p>"), F.lit(1))
    found = t.text_table(spark, d, "pages", "page_id").select("page_id", F.posexplode(blocks).alias("pos", "block"))
    return found.select("page_id", "pos", inner_text(F.col("block")).alias("block_text"))


@query
def page_quarantine(spark, d):
    parsed = extract.parse_detail(t.text_table(spark, d, "pages", "page_id"))
    return parsed.filter("reason is not null").select("url", "reason")


# --- the shop's pages --------------------------------------------------------------------


def _crawl(spark, d):
    pages = materialise(extract.read_pages(t.shop_pages(spark, d)), "shop-pages")
    links = extract.extract_category_links(pages, t.SHOP, max_categories=None)
    order = extract.page_order(extract.next_page_edges(pages), links)
    return pages, links, extract.crawl_listing(pages, order, t.SHOP)


@query
def category_links(spark, d):
    return extract.extract_category_links(t.home_page(spark, d), t.SHOP, max_categories=None)


@query
def category_links_first_three(spark, d):
    return extract.extract_category_links(t.home_page(spark, d), t.SHOP, max_categories=3)


@query
def categories_from_pages(spark, d):
    pages = t.home_page(spark, d).unionByName(t.shelf_pages(spark, d))
    links = extract.extract_category_links(t.home_page(spark, d), t.SHOP, max_categories=None)
    return extract.extract_categories(pages, links).select("category_id", "category_name")


@query
def next_page_edges(spark, d):
    return extract.next_page_edges(t.shelf_pages(spark, d))


@query
def page_order(spark, d):
    home, pages = t.home_page(spark, d), t.shelf_pages(spark, d)
    links = extract.extract_category_links(home, t.SHOP, max_categories=None)
    return extract.page_order(extract.next_page_edges(pages), links)


@query
def books_from_pages(spark, d):
    _, _, crawl = _crawl(spark, d)
    return extract.extract_listing(crawl)


@query
def inventory_from_pages(spark, d):
    pages, _, crawl = _crawl(spark, d)
    good, _ = extract.extract_detail(pages, extract.detail_urls(crawl), t.SHOP)
    return good


@query
def inventory_quarantine(spark, d):
    pages, _, crawl = _crawl(spark, d)
    _, bad = extract.extract_detail(pages, extract.detail_urls(crawl), t.SHOP)
    return bad


@query
def bands_from_pages(spark, d):
    """Pages to price bands in one go: crawl, extract, stage, join, aggregate."""
    from stacklore.plans import staging

    pages, links, crawl = _crawl(spark, d)
    crawl = materialise(crawl, "crawl")  # read by two models
    books = staging.stg_books(extract.extract_listing(crawl))
    categories = staging.stg_categories(extract.extract_categories(pages, links))
    good, _ = extract.extract_detail(pages, extract.detail_urls(crawl), t.SHOP)
    dim = marts.dim_books(books, categories, staging.stg_inventory(good))
    return marts.mart_price_bands(dim)


# --- JSON, search and answers ------------------------------------------------------------


@query
def json_field_totals(spark, d):
    parsed = t.table(spark, d, "events").select(
        "event_type", json_field(F.parse_json("props"), "$.k", "int").alias("k")
    )
    return parsed.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.max("k").alias("max_k"))


def _questions(spark, d):
    return t.table(spark, d, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def _search_docs(spark, d):
    return search.build_search_docs(t.dimension(spark, d, (*marts.DIM_COLUMNS, search.KEY)))


def _book_index(spark, d):
    # The text to index repeats the description: it is put together when read.
    dim = t.dimension(spark, d, (*marts.DIM_COLUMNS, search.KEY)).filter(F.col("description").isNotNull())
    docs = search.build_search_docs(materialise(dim, "search-docs"))
    return lexical.build_lexical_index(docs, search.KEY, "search_text")


@query
def search_docs(spark, d):
    return _search_docs(spark, d)


@query
def search_lexical_topk(spark, d):
    index = lexical.build_lexical_index(t.text_table(spark, d, "documents", "doc_id"), "doc_id", "text")
    hits = lexical.search_lexical(_questions(spark, d), index, k=5)
    return hits.select("qid", "doc_id", "rank", F.round("score", 6).alias("score"))


@query
def search_blocks_topk(spark, d):
    """The same hits from an index in blocks, those out of reach left out."""
    index = lexical.build_lexical_index(t.text_table(spark, d, "documents", "doc_id"), "doc_id", "text")
    hits = blockmax.search_blocks(_questions(spark, d), blockmax.block_index(index), k=5)
    return hits.select("qid", "doc_id", "rank", F.round("score", 6).alias("score"))


@query
def search_refreshed(spark, d):
    """Search of an index that was written once and refreshed once, documents changed, new and gone."""
    old, new = _snapshots(spark, d)
    path = scratch_path(spark, "postings")
    postings_log.refresh_postings(old, path, "doc_id", "text", version=0)
    postings_log.refresh_postings(new, path, "doc_id", "text", version=1)
    index = blockmax.block_index(postings_log.open_postings(spark, path, "doc_id"))
    hits = blockmax.search_blocks(_questions(spark, d), index, k=5)
    return hits.select("qid", "doc_id", "rank", F.round("score", 6).alias("score"))


@query
def search_filter(spark, d):
    """Search among affordable books in stock only."""
    where = (F.col("price_gbp") < 20) & (F.col("stock_status") != "Out of Stock")
    hits = search.search(
        _questions(spark, d), _book_index(spark, d), columns=("book_title", "price_gbp"), where=where
    )
    return hits.select("qid", "rank", "book_title", "price_gbp", F.round("score", 6).alias("score"))


@query
def search_preview(spark, d):
    """Search by JSON request, hits unwrapped from the JSON response."""
    fields = F.array(*(F.lit(c) for c in search.PREVIEW_FIELDS))
    request = F.struct(F.col("question").alias("query"), fields.alias("columns"), F.lit(3).alias("limit"))
    requests = _questions(spark, d).select("qid", F.to_json(request).alias("request"))
    responses = search.search_preview(requests, _book_index(spark, d))
    return search.flatten_results(responses)


def _label_means(spark, d):
    """One question vector per label: the mean of its vectors."""
    vectors = t.table(spark, d, "embeddings").select("label", array_to_vector("embedding").alias("v"))
    means = vectors.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select(F.col("label").alias("qid"), vector_to_array("m").alias("vector"))


@query
def search_vector_topk(spark, d):
    index = dense.build_dense_index(t.table(spark, d, "embeddings"), "vec_id")
    hits = dense.search_dense(_label_means(spark, d), index, k=5)
    return hits.select("qid", "doc_id", "rank", F.round("score", 6).alias("score"))


@query
def search_vector_approx(spark, d):
    index = dense.build_dense_index(t.table(spark, d, "embeddings"), "vec_id")
    cells = dense.build_cells(index, cells=16)
    hits = dense.search_dense(_label_means(spark, d), cells, k=5, probes=8)
    return hits.select("qid", "doc_id", "rank", F.round("score", 6).alias("score"))


@query
def search_vector_multiprobe(spark, d):
    """Search through hyperplane tables held against the exact one: recall and rows scored."""
    index = dense.build_dense_index(t.table(spark, d, "embeddings"), "vec_id")
    asked = materialise(_label_means(spark, d), "label-means")
    found, scored = hyperplane.search_hyperplanes(asked, hyperplane.build_hyperplanes(index), k=5)
    exact = dense.search_dense(asked, index, k=5).select("qid", "doc_id", F.lit(1).alias("hit"))
    hits = exact.join(found.select("qid", "doc_id", F.lit(1).alias("seen")), ["qid", "doc_id"], "left")
    recall = hits.agg((F.sum("seen") / F.sum("hit")).alias("recall"), F.count_distinct("qid").alias("n_questions"))
    work = scored.agg(F.sum("scored").alias("scored"))
    rows = index.rows.agg(F.count(F.lit(1)).alias("n"))
    figures = recall.unionByName(work, allowMissingColumns=True).unionByName(rows, allowMissingColumns=True)
    joined = figures.agg(*[F.max(c).alias(c) for c in figures.columns])  # one row of each
    return joined.select(
        "n_questions", (F.col("recall") >= 0.9).alias("recall_reached"),
        (F.col("scored") < 0.6 * F.col("n") * F.col("n_questions")).alias("fewer_scored"),
    )


def _snapshots(spark, d):
    """Documents before and after a change: one language arrives, one source leaves, one is edited."""
    docs = t.text_table(spark, d, "documents", "doc_id").select("doc_id", "lang", "source", "text")
    old = docs.filter("lang <> 'de'")
    edited = F.when(F.col("source") == "src2", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    new = docs.filter("source <> 'src3'").withColumn("text", edited)
    return old, new


@query
def index_refresh_diff(spark, d):
    old, new = _snapshots(spark, d)
    return refresh.index_changes(old, new, "doc_id", ["lang", "source", "text"])


@query
def index_refresh_log(spark, d):
    """Two refreshes of a stored index: what the second one wrote, counted by operation."""
    old, new = _snapshots(spark, d)
    path, embedder = scratch_path(spark, "index"), dense.hashing_embedder()
    refresh.refresh_index(old, path, "doc_id", "text", embedder, version=0)
    changes = refresh.refresh_index(new, path, "doc_id", "text", embedder, version=1)
    return changes.groupBy("_op").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("_op", "op")


def _prompts(spark, d):
    questions = _questions(spark, d)
    return answers.build_prompt(questions, search.search(questions, _book_index(spark, d)))


@query
def prompt_build(spark, d):
    return _prompts(spark, d).select("qid", "prompt")


@query
def answer_batch(spark, d):
    answered = answers.answer(_prompts(spark, d), answers.first_listed)
    titles = F.array_join(F.transform("books", lambda b: b.book_title), " | ")
    return answered.select("qid", "answer", F.size("books").alias("n_books"), titles.alias("titles"))


@query
def answer_records(spark, d):
    """Answer records flattened to one row per returned book."""
    answered = answers.answer(_prompts(spark, d), answers.first_listed)
    flat = answered.select("qid", "answer", F.posexplode("books").alias("pos", "book"))
    return flat.select("qid", "answer", "pos", "book.*")


# --- data quality ------------------------------------------------------------------------


@query
def dq_not_null(spark, d):
    return quality.not_null(t.dimension(spark, d, ("book_title", "category_id", "upc")), "upc").select("book_title", "category_id")


@query
def dq_unique(spark, d):
    return quality.unique(t.table(spark, d, "part"), "p_name")


@query
def dq_accepted_values(spark, d):
    return quality.accepted_values(t.table(spark, d, "orders"), "o_orderstatus", ("F", "O"))


@query
def dq_relationships(spark, d):
    s = t.staged(spark, d, with_text=False)
    orphans = quality.relationships(s["stg_books"], "category_id", s["stg_categories"], "category_id")
    return orphans.select("book_title", "category_id")


@query
def dq_expression(spark, d):
    bad = quality.expression_is_true(t.table(spark, d, "customer"), "c_acctbal", ">= 0")
    return bad.select("c_custkey", "c_acctbal")


def _built(spark, d):
    staged = {
        name: materialise(df, name) for name, df in t.staged(spark, d, with_text=False).items()
    }
    dim = materialise(
        marts.dim_books(staged["stg_books"], staged["stg_categories"], staged["stg_inventory"], t.NARROW),
        "dim_books",
    )
    return {
        **staged,
        "dim_books": dim,
        "mart_category_summary": marts.mart_category_summary(dim),
        "mart_price_bands": marts.mart_price_bands(dim),
    }


@query
def dq_report(spark, d):
    return quality.report(_built(spark, d), suite.BOOK_SUITE)
