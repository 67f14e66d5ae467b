from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stacklore import schemas
from stacklore.operators import extract as e

BASE = "http://shop.test"
AT = datetime(2024, 1, 1)
HOME = """<ul class="nav nav-list"><li><a href="catalogue/category/books_1/index.html">Books</a><ul>
<li><a href="catalogue/category/books/travel_2/index.html"> Travel </a></li>
<li><a href='catalogue/category/books/mystery_3/index.html'>Mystery</a></li>
<li><a href="catalogue/category/books/history_4/index.html">History</a></li>
<li><a href="catalogue/category/books/art_5/index.html">Art</a></li></ul></li></ul>
<ul><li><a href="x_9/index.html">elsewhere</a></li></ul>"""


def card(href, title, price="£12.99", rating="Three"):
    return f"""<article class="product_pod"><p class="star-rating {rating}"></p>
<h3><a href="{href}" title="{title}">It..</a></h3><p class="price_color">{price}</p></article>"""


def listing(name, *cards, following=None):
    button = f'<li class="next"><a href="{following}">next</a></li>' if following else ""
    return f'<div class="page-header action"><h1> {name} </h1></div>' + "\n".join(cards) + button


DETAIL = """<table class="table table-striped"><tr><th>UPC</th><td>abc</td></tr>
<tr><th>Number of reviews</th><td>0</td></tr></table>
<p class="instock availability"> In stock (22 available)</p>
<div id="product_description"><h2>D</h2></div>
<p>He said</p>"""


def shelf(name, page="index.html"):
    return f"{BASE}/catalogue/category/books/{name}/{page}"


PAGES = {
    f"{BASE}/index.html": HOME,
    shelf("travel_2"): listing(
        "Travel &amp; more", card("../../../x_9/index.html", "It&#39;s A &amp; B"),
        card("../../../y_8/index.html", "Twice", "£2.00"), following="page-2.html",
    ),
    shelf("travel_2", "page-2.html"): listing("Travel", card("../../../z_7/index.html", "Zed"), following="page-3.html"),
    shelf("travel_2", "page-3.html"): listing("Travel", card("../../../w_6/index.html", "W", rating="One")),
    shelf("mystery_3"): listing("Mystery", card("../../../v_5/index.html", "Twice", "£3.00")),
    shelf("history_4"): listing("History"),
    f"{BASE}/catalogue/x_9/index.html": DETAIL,
    f"{BASE}/catalogue/y_8/index.html": DETAIL.replace("<p>He said</p>", "").replace("22 available", "many"),
    f"{BASE}/catalogue/z_7/index.html": DETAIL.replace("<tr><th>UPC</th><td>abc</td></tr>", "")
    .replace("He said", " <i>One </i> two&lt;b&gt; "),
    f"{BASE}/catalogue/w_6/index.html": "<p class='instock'>In stock</p>",
    "http://other.test/catalogue/x_9/index.html": DETAIL,
}


@pytest.fixture(scope="module")
def pages(spark):
    data = [(u, h, AT) for u, h in PAGES.items()]
    return spark.createDataFrame(data, schemas.PAGES).repartition(3).cache()


@pytest.fixture(scope="module")
def crawl(pages):
    links = e.extract_category_links(pages, BASE, max_categories=3)
    order = e.page_order(e.next_page_edges(pages), links)
    return e.crawl_listing(pages, order, BASE).cache()


def test_category_links(pages):
    assert rows(e.extract_category_links(pages, BASE, max_categories=3)) == [
        (0, 2, shelf("travel_2")), (1, 3, shelf("mystery_3")), (2, 4, shelf("history_4"))
    ]
    assert e.extract_category_links(pages, BASE).count() == 4


def test_categories(pages):
    links = e.extract_category_links(pages, BASE, max_categories=3)
    assert rows(e.extract_categories(pages, links)) == [
        (2, "Travel & more", AT), (3, "Mystery", AT), (4, "History", AT)
    ]
    everything = e.extract_category_links(pages, BASE)
    with pytest.raises(Exception, match="category page without heading"):
        e.extract_categories(pages, everything).collect()


def test_page_order(pages):
    links = e.extract_category_links(pages, BASE, max_categories=3)
    order = e.page_order(e.next_page_edges(pages), links)
    assert [(r[0], r[1], r[3], r[2]) for r in sorted(order.collect(), key=lambda r: (r[0], r[3]))] == [
        (0, 2, 0, shelf("travel_2")), (0, 2, 1, shelf("travel_2", "page-2.html")),
        (0, 2, 2, shelf("travel_2", "page-3.html")), (1, 3, 0, shelf("mystery_3")), (2, 4, 0, shelf("history_4")),
    ]


def test_long_and_shared_chains(spark):
    """Two categories run into one chain: each walks it on its own."""
    n = 45
    edges = spark.createDataFrame(
        [(f"p{i}", f"p{i + 1}" if i + 1 < n else None) for i in range(n)] + [("q", "p3")], "url string, next_url string"
    )
    links = spark.createDataFrame([(0, 10, "p0"), (1, 11, "q")], "category_pos int, category_id int, category_url string")
    got = {(r.category_id, r.page_no): r.page_url for r in e.page_order(edges, links).collect()}
    want = {(10, i): f"p{i}" for i in range(n)} | {(11, 0): "q"} | {(11, i - 2): f"p{i}" for i in range(3, n)}
    assert got == want


def test_pages_fetched_twice_count_by_their_latest_fetch(spark, pages, crawl):
    """Older fetches with other content, and one fetch stored twice, change no result."""
    older = pages.selectExpr("url", "replace(html, 'page-2.html', 'page-9.html') as html", "fetched_at - interval 1 day as fetched_at")
    both = pages.unionByName(pages).unionByName(older)
    links = e.extract_category_links(pages, BASE, max_categories=3)
    assert rows(e.next_page_edges(both)) == rows(e.next_page_edges(pages))
    order = e.page_order(e.next_page_edges(both), links)
    assert rows(e.crawl_listing(both, order, BASE)) == rows(crawl)
    assert rows(e.parse_detail(both)) == rows(e.parse_detail(pages))
    assert rows(e.extract_categories(both, links)) == rows(e.extract_categories(pages, links))


def test_link_loop_is_an_error(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "url string, next_url string")
    links = spark.createDataFrame([(0, 1, "a")], "category_pos int, category_id int, category_url string")
    with pytest.raises(ValueError, match="loop"):
        e.page_order(edges, links)


def test_listing(crawl):
    assert rows(e.extract_listing(crawl)) == [
        ("It's A & B", "£12.99", "Three", 2, "catalogue/x_9/index.html", AT),
        ("Twice", "£2.00", "Three", 2, "catalogue/y_8/index.html", AT),
        ("W", "£12.99", "One", 2, "catalogue/w_6/index.html", AT),
        ("Zed", "£12.99", "Three", 2, "catalogue/z_7/index.html", AT),
    ]


def test_listing_without_title_fails(spark, pages):
    broken = pages.withColumn("html", F.regexp_replace("html", 'title="Zed"', ""))
    order = e.page_order(e.next_page_edges(broken), e.extract_category_links(broken, BASE))
    with pytest.raises(Exception, match="card without title"):
        e.crawl_listing(broken, order, BASE).collect()


def test_details_and_quarantine(pages, crawl):
    good, bad = e.extract_detail(pages, e.detail_urls(crawl), BASE)
    assert rows(good) == [
        ("catalogue/x_9/index.html", "abc", 22, 0, "He said", AT),
        ("catalogue/y_8/index.html", "abc", 0, 0, None, AT),
        ("catalogue/z_7/index.html", "", 22, 0, "Onetwo<b>", AT),
    ]
    assert rows(bad) == [
        ("catalogue/v_5/index.html", "page not fetched"),
        ("catalogue/w_6/index.html", "no product table"),
    ]


@pytest.mark.parametrize(
    "change, reason",
    [
        (("<td>0</td>", "<td>many</td>"), "reviews are not an integer"),
        (("<th>UPC</th>", ""), "table row without header or value"),
        (("instock", "gone"), "no stock paragraph"),
        (("22", "99999999999"), "stock is not an integer"),
    ],
)
def test_bad_details(spark, change, reason):
    page = spark.createDataFrame([("u", DETAIL.replace(*change), AT)], schemas.PAGES)
    assert e.parse_detail(page).first().reason == reason


def test_last_table_row_wins_and_long_text_is_whole(spark):
    long = "word " * 60_000
    html = DETAIL.replace("</table>", "<tr><th> UPC </th><td>second</td></tr></table>").replace("He said", long)
    row = e.parse_detail(spark.createDataFrame([("u", html, AT)], schemas.PAGES)).first()
    assert row.upc == "second" and row.description == long.strip()
