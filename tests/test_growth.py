"""Steps whose shuffles grow with what is kept, not with what is read; the results are those of the plain forms."""

from __future__ import annotations

import gc
import math
from datetime import datetime

import pyarrow as pa
from conftest import plan, rows
from pyspark.sql import functions as F

from stacklore.functions import markup
from stacklore.operators import blockmax, extract, lexical
from stacklore.operators.dedup import latest_per_key, latest_then_lookup

SHOP = "http://shop.example"


def test_lengths_do_not_depend_on_which_terms_are_broadcast(spark):
    counts = spark.createDataFrame(
        [(d, f"w{t}", 1 + (d + t) % 3) for d in range(30) for t in range(12) if d % (t + 1) == 0], "doc_id long, term string, tf long"
    )
    terms = counts.groupBy("term").agg(F.log(31.0 / (F.count(F.lit(1)) + 1)).alias("idf")).filter("idf > 0")
    idf = {r.term: r.idf for r in terms.collect()}
    squares = {}
    for r in counts.collect():
        if r.term in idf:
            squares[r.doc_id] = squares.get(r.doc_id, 0) + (r.tf * idf[r.term]) ** 2
    leads = set()
    for limit in (0, 3, 6, 500):
        found = lexical.doc_lengths(counts, terms, ["doc_id"], limit).collect()
        assert {r.doc_id: round(r.length, 9) for r in found} == {d: round(math.sqrt(s), 9) for d, s in squares.items()}
        leads.add(tuple(sorted((r.doc_id, r.lead) for r in found)))
    assert len(leads) == 1


def test_postings_are_not_shuffled_by_term(spark):
    docs = spark.createDataFrame([(i, f"w{i % 5} the x{i}") for i in range(50)], "id long, body string")
    index = lexical.build_lexical_index(docs, "id", "body")
    assert "hashpartitioning(term" not in plan(index.postings) and "Join" in plan(index.postings)
    questions = spark.createDataFrame([(1, "w1 x3 the")], "qid long, question string")
    hits = blockmax.search_blocks(questions, blockmax.block_index(index, 2))
    text = plan(hits)
    assert "hashpartitioning(block#" in text
    assert not any("hashpartitioning(block#" in line and "term#" in line for line in text.splitlines())


def test_latest_rows_with_texts_of_a_lookup(spark):
    """Ties between links and between texts of one link, repeated rows, NULL keys, links, times and texts."""
    def row(i):
        at = None if i % 13 == 0 else datetime(2024, 1, 1 + i % 3)
        return (None if i % 17 == 0 else f"u{i % 11}", "upc", i % 2, at, None if i % 7 == 0 else i % 5)

    schema = "book_url string, upc string, n int, at timestamp, link int"
    texts = [(0, "b"), (0, "a"), (1, None), (1, "z"), (2, "c"), (2, "c"), (None, "never"), (9, "x")]
    lookup = spark.createDataFrame(texts, "link int, description string")
    alone = [(f"u{i}", "upc", 1, datetime(2024, 1, 1), i % 4) for i in range(40)]
    for data in ([row(i) for i in range(300)], alone, alone + alone, []):
        df = spark.createDataFrame(data, schema).repartition(5)
        whole = df.join(lookup, "link", "left").select("book_url", "upc", "n", "description", "at")
        late = latest_then_lookup(df, "book_url", "at", "link", lookup, ["description"]).select(*whole.columns)
        assert rows(late) == rows(latest_per_key(whole, "book_url", "at"))


def test_extractors_take_pages_read_once(spark):
    listing = (
        '<div class="page-header"><h1> Travel </h1></div><article class="product_pod"><p class="star-rating Two"></p>'
        '<h3><a href="../../../b_1/index.html" title="B"></a></h3><p class="price_color">£1.00</p></article>'
        '<li class="next"><a href="page-2.html">next</a></li>'
    )
    home = '<ul class="nav-list"><li><ul><li><a href="catalogue/category/books/travel_2/index.html">T</a></li></ul></li></ul>'
    detail = '<table class="table-striped"><tr><th>UPC</th><td>u1</td></tr></table><p class="instock">In stock (3)</p>'
    url = f"{SHOP}/catalogue/category/books/travel_2/index.html"
    at = datetime(2024, 1, 1)
    data = [(f"{SHOP}/index.html", home, at), (url, listing, at), (url, "<p></p>", datetime(2023, 1, 1)),
            (f"{SHOP}/catalogue/b_1/index.html", detail, at), (f"{SHOP}/none.html", None, at)]
    pages = spark.createDataFrame(data, "url string, html string, fetched_at timestamp_ntz")
    read = extract.read_pages(pages)
    assert "html" not in read.columns
    links = [extract.extract_category_links(p, SHOP) for p in (pages, read)]
    for take in (
        extract.next_page_edges, extract.listing_cards, extract.parse_detail,
        lambda p: extract.extract_categories(p, links[0]), lambda p: extract.extract_category_links(p, SHOP),
    ):
        assert rows(take(read)) == rows(take(pages)) != []


def test_a_page_is_freed_when_it_was_read():
    """No cycle of elements and page is left for the collector, however many pages a batch has."""
    gc.collect()
    gc.disable()
    try:
        html = "<div><p class=instock>In stock</p></div>" * 5
        records = markup.read_batch(pa.array([html, None] * 600), markup._detail, pa.struct([("stock", pa.string())]))
        assert len(records) == 1200 and records[0].as_py() == {"stock": "In stock"} and records[1].as_py() == {"stock": None}
        assert not any(isinstance(o, markup.Element) for o in gc.get_objects())
    finally:
        gc.enable()
