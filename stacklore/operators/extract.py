"""Records out of a table of fetched pages `(url, html[, fetched_at])`.

Each extractor is a projection over the page's elements (`functions/markup.py`), so it runs
where the page is read and only narrow records move between executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stacklore.functions import markup
from stacklore.functions.text import from_end, leading_int, strip_base, url_join
from stacklore.operators.dedup import first_seen, latest_per_key
from stacklore.session import scratch_path


def required(value: Column, message: str) -> Column:
    """Fail the job when `value` is missing."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("string"))


def _extracted_at(pages: DataFrame) -> Column:
    if "fetched_at" in pages.columns:
        return F.col("fetched_at").cast("timestamp_ntz")
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
    )


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages read once for all extractors, which take them in place of `pages`: (url, read, text_hash[, fetched_at]).

    Store them: each extractor then scans its own part, and no page is read again.
    """
    kept = [c for c in ("fetched_at",) if c in pages.columns]
    return pages.select("url", markup.everything(F.col("html")).alias("read"), F.xxhash64("html").alias("text_hash"), *kept)


def _of_page(pages: DataFrame, part: str) -> Column:
    """What `markup.<part>` finds in a page, from its html or as it was read."""
    return F.col("read")[part] if "read" in pages.columns else getattr(markup, part)(F.col("html"))


def page_links(pages: DataFrame) -> DataFrame:
    """Every anchor with a target: (url, pos, href, target), in page order from 0."""
    found = pages.select("url", F.posexplode(markup.hrefs(F.col("html"))).alias("pos", "href"))
    found = found.filter(F.col("href").isNotNull())
    return found.withColumn("target", url_join(F.col("url"), F.col("href")))


def extract_category_links(
    pages: DataFrame, base_url: str, max_categories: int | None = None
) -> DataFrame:
    """Category links of the home page: (category_pos, category_id, category_url).

    The links sit in the list nested in the navigation list; the id is the number after
    the last underscore of the folder name. `max_categories` keeps the first ones in page
    order, None keeps all.
    """
    base = base_url.rstrip("/")
    home = pages.filter(F.col("url") == f"{base}/index.html")
    menu = _of_page(pages, "menu_hrefs").alias("_menu")
    hrefs = F.coalesce("_menu", F.raise_error(F.lit("home page has no category list")).cast("array<string>"))
    links = home.select(menu).select(F.posexplode(hrefs).alias("category_pos", "_href"))
    if max_categories is not None:
        links = links.filter(F.col("category_pos") < max_categories)
    links = links.select("category_pos", required(F.col("_href"), "category link without target").alias("_href"))
    slug = from_end(F.col("_href"), "/", 2)
    return links.select(
        "category_pos",
        from_end(slug, "_", 1).cast("int").alias("category_id"),
        url_join(F.lit(base + "/"), F.col("_href")).alias("category_url"),
    )


def extract_categories(pages: DataFrame, links: DataFrame) -> DataFrame:
    """(category_id, category_name, extracted_at) from the heading of each category page."""
    headings = pages.select(
        "url", _of_page(pages, "heading").alias("_heading"), _extracted_at(pages).alias("extracted_at")
    )
    headings = latest_per_key(headings, "url", "extracted_at").filter(F.col("_heading").isNotNull())
    joined = links.join(headings, F.col("category_url") == F.col("url"), "left")
    name = required(F.col("_heading"), "category page without heading")
    return joined.select("category_id", name.alias("category_name"), "extracted_at")


def next_page_edges(pages: DataFrame) -> DataFrame:
    """(url, next_url) for every page by its latest fetch; NULL on the last page of a listing."""
    found = pages.select("url", _of_page(pages, "next_button").alias("_next"), _extracted_at(pages).alias("_at"))
    href = F.when(F.col("_next").isNotNull(), required(F.col("_next.href"), "next button without link"))
    found = found.select("url", url_join(F.col("url"), href).alias("next_url"), "_at")
    return latest_per_key(found, "url", "_at", ["next_url"]).drop("_at")


def page_order(edges: DataFrame, links: DataFrame) -> DataFrame:
    """Crawl order of listing pages: (category_pos, category_id, page_url, page_no from 0).

    Pointer doubling: after round r every page within 2**(r+1) steps of its category page
    is known, so a chain of n pages takes log2(n) joins on unique page keys. Each round is
    written to the shared folder, which keeps plans short and survives lost executors.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "page-order")
    step = links.select(
        "category_pos", "category_id", F.col("category_url").alias("page_url"),
        F.lit(0).cast("bigint").alias("page_no"),
    )
    jump = edges.filter(F.col("next_url").isNotNull()).select(
        F.col("url").alias("_from"), F.col("next_url").alias("_to")
    )
    page_columns, link_columns = step.columns, jump.columns
    # A chain has at most one page more than links, and one round more finds its end; any beyond is in a loop.
    n_links = jump.count()
    for round_no in range(n_links.bit_length() + 2):
        # One job writes the pages and the links of a round.
        both = step.withColumn("_kind", F.lit("page")).unionByName(
            jump.withColumn("_kind", F.lit("link")), allowMissingColumns=True
        )
        both.write.mode("errorifexists").parquet(f"{root}/round={round_no}")
        written = spark.read.schema(both.schema).parquet(f"{root}/round={round_no}")
        # All rounds so far in one scan.
        reached = spark.read.schema(both.schema).parquet(root)
        reached = reached.filter("_kind = 'page'").select(*page_columns)
        if written.filter("_kind = 'page'").isEmpty():
            return reached
        jump = written.filter("_kind = 'link'").select(*link_columns)
        onward = jump.select(F.col("_from").alias("_mid"), F.col("_to").alias("_end"))
        step = reached.join(jump, F.col("page_url") == F.col("_from")).select(
            "category_pos", "category_id", F.col("_to").alias("page_url"),
            (F.col("page_no") + F.lit(2**round_no)).alias("page_no"),
        )
        jump = jump.join(onward, F.col("_to") == F.col("_mid")).select("_from", F.col("_end").alias("_to"))
    raise ValueError(f"a listing goes on after {n_links} links: its links form a loop")


def listing_cards(pages: DataFrame) -> DataFrame:
    """Product cards of every page by its latest fetch: (url, pos, title, price, rating_word, href, extracted_at)."""
    # A page without cards keeps a row, so that it can replace an older fetch that had some.
    # The fetch is numbered before its cards are apart.
    text = F.col("text_hash") if "text_hash" in pages.columns else F.xxhash64("html")
    fetches = pages.withColumn("_fetch", F.monotonically_increasing_id()).select(
        "url", "_fetch", text.alias("_text"), _of_page(pages, "cards").alias("_cards"),
        _extracted_at(pages).alias("extracted_at"),
    )
    found = fetches.select("url", "_fetch", "_text", F.posexplode_outer("_cards").alias("pos", "_card"), "extracted_at")
    records = found.select(
        "url", "_fetch", "_text", "pos", "_card.title", "_card.price", "_card.rating_word", "_card.href", "extracted_at"
    )
    order = Window.partitionBy("url").orderBy(F.col("extracted_at").desc_nulls_first(), "_text", "_fetch")
    latest = records.withColumn("_rank", F.rank().over(order)).filter((F.col("_rank") == 1) & F.col("pos").isNotNull())
    return latest.drop("_rank", "_fetch", "_text")


def crawl_listing(pages: DataFrame, order: DataFrame, base_url: str) -> DataFrame:
    """Cards on the pages of the crawl, in crawl coordinates; a card with a missing field fails the job."""
    cards = listing_cards(pages).join(order, F.col("url") == F.col("page_url"))
    book_url = strip_base(url_join(F.col("page_url"), F.col("href")), base_url)
    return cards.select(
        "category_pos",
        "page_no",
        "pos",
        required(F.col("title"), "card without title").alias("product_name"),
        required(F.col("price"), "card without price").alias("price"),
        required(F.col("rating_word"), "card without rating").alias("rating_word"),
        "category_id",
        required(book_url, "card without link").alias("book_url"),
        "extracted_at",
    )


def extract_listing(crawl: DataFrame) -> DataFrame:
    """Raw book rows: the first card of every title in crawl order."""
    kept = first_seen(crawl, "product_name", ["category_pos", "page_no", "pos"])
    return kept.select(
        "product_name", "price", "rating_word", "category_id", "book_url", "extracted_at"
    )


def detail_urls(crawl: DataFrame) -> DataFrame:
    """Distinct book links over all listing pages, before titles are made unique."""
    return crawl.select("book_url").distinct()


def parse_detail(pages: DataFrame) -> DataFrame:
    """Fields of product detail pages with the reason a page cannot be used, NULL when it can."""
    read = pages.select("url", _of_page(pages, "detail").alias("_d"), _extracted_at(pages).alias("extracted_at"))
    reviews, stock = F.col("_d.reviews"), F.col("_d.stock")
    fields = read.select(
        "url",
        F.col("_d.no_table").alias("_no_table"),
        F.col("_d.bad_row").alias("_bad_row"),
        F.coalesce("_d.upc", F.lit("")).alias("upc"),
        leading_int(stock).alias("num_in_stock"),
        F.when(reviews.isNull(), F.lit(0)).otherwise(reviews.try_cast("int")).alias("num_reviews"),
        stock.isNull().alias("_no_stock"),
        F.col("_d.description").alias("description"),
        "extracted_at",
    )
    reason = (
        F.when(F.col("_no_table"), F.lit("no product table"))
        .when(F.col("_bad_row"), F.lit("table row without header or value"))
        .when(F.col("_no_stock"), F.lit("no stock paragraph"))
        .when(F.col("num_in_stock").isNull(), F.lit("stock is not an integer"))
        .when(F.col("num_reviews").isNull(), F.lit("reviews are not an integer"))
    )
    found = fields.select(
        "url", "upc", "num_in_stock", "num_reviews", "description", "extracted_at",
        reason.alias("reason"),
    )
    return latest_per_key(found, "url", "extracted_at")


def extract_detail(pages: DataFrame, urls: DataFrame, base_url: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): raw inventory rows, and (book_url, reason) for pages left out.

    Pages are parsed where they are read; only the parsed record is joined to the links.
    """
    base = base_url.rstrip("/")
    parsed = parse_detail(pages.filter(F.col("url").startswith(base + "/")))
    wanted = urls.withColumn("_url", F.concat(F.lit(base + "/"), F.col("book_url")))
    joined = wanted.join(parsed, F.col("_url") == F.col("url"), "left").withColumn(
        "reason", F.when(F.col("url").isNull(), F.lit("page not fetched")).otherwise(F.col("reason"))
    )
    good = joined.filter(F.col("reason").isNull()).select(
        "book_url", "upc", "num_in_stock", "num_reviews", "description", "extracted_at"
    )
    quarantine = joined.filter(F.col("reason").isNotNull()).select("book_url", "reason")
    return good, quarantine
