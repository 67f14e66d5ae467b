"""The element tree: extents, siblings, attributes, and records of odd pages."""

from __future__ import annotations

import random

import pytest

from stacklore import schemas
from stacklore.functions.markup import RAW, VOID, Page
from stacklore.operators import extract as e
from test_extract import AT, DETAIL, card


def build(rng, depth=0):
    """A random tree: (name, attributes, children), children being trees or texts."""
    name = rng.choice(["div", "p", "b", "li", "ul"])
    attributes = {k: rng.choice(["x", "a b", "c > d", "it's"]) for k in rng.sample(["class", "id", "data-x"], rng.randint(0, 3))}
    children = [rng.choice([f"t{rng.randint(0, 9)} ", " 1 < 2 "]) if rng.random() < 0.4 or depth > 4 else build(rng, depth + 1)
                for _ in range(rng.randint(0, 4))]
    return name, attributes, children


def written(tree, rng):
    """Markup of a tree in a random spelling, with comments, void elements and scripts between."""
    if isinstance(tree, str):
        return tree.replace("<", rng.choice(["&lt;", "<"]))
    name, attributes, children = tree
    spelt = "".join(f'{rng.choice([" ", chr(10), "  "])}{k.upper() if rng.random() < 0.3 else k}{rng.choice(["=", " = "])}"{v}"' for k, v in attributes.items())
    noise = ["", "", "<!-- <div class='x'> </b> -->", "<br>", "<img src='>'/>", "<script>'</p><b>'</script>", "<STYLE>b > p {}</STYLE>", "</i>"]
    tag = name.upper() if rng.random() < 0.3 else name
    inner = "".join(rng.choice(noise) + written(c, rng) for c in children) + rng.choice(noise)
    return f"<{tag}{spelt}{rng.choice(['', ' '])}>{inner}</{rng.choice([tag, name])}{rng.choice(['', ' '])}>"


def flat(tree, out):
    name, attributes, children = tree
    out.append((name, attributes, "".join(texts(tree)).strip()))
    for c in children:
        if not isinstance(c, str):
            flat(c, out)
    return out


def texts(tree):
    for c in tree[2]:
        yield from [c] if isinstance(c, str) else texts(c)


@pytest.mark.parametrize("seed", range(60))
def test_tree_of_random_markup(seed):
    rng = random.Random(seed)
    tree = build(rng)
    page = Page(written(tree, rng))
    plain = [x for x in page.elements if x.name not in VOID and x.name not in RAW]
    got = [(x.name, {k: x.attribute(k) for k in ("class", "id", "data-x") if x.attribute(k) is not None}, x.text()) for x in plain]
    assert got == flat(tree, [])


def test_unclosed_and_stray_tags():
    page = Page("<ul><li>a<li>b</ul><p>c</div></p><div>d")
    assert [(x.name, x.text(), x.after) for x in page.elements] == [
        ("ul", "ab", 3), ("li", "ab", 3), ("li", "b", 3), ("p", "c", 4), ("div", "d", 5)]
    assert page.elements[0].sibling().name == "p" and page.elements[1].sibling() is None
    assert Page("").elements == [] and Page("1 < 2 <3 <a href='x").elements == []
    assert Page("<!-- <p>").elements == [] and [x.name for x in Page("<script><p>").elements] == ["script"]


def one(spark, html, url="http://h/"):
    return spark.createDataFrame([(url, html, AT)], schemas.PAGES)


@pytest.mark.parametrize(
    "html",
    [
        card("x", "a &gt; b").replace('title="a &gt; b"', 'title="a > b"'),
        card("x", "a > b").upper().replace("PRODUCT_POD", "product_pod").replace("STAR-RATING THREE", "star-rating Three")
        .replace("PRICE_COLOR", "price_color").replace("A > B", "a > b").replace('"X"', '"x"'),
        f"<!-- {card('old', 'gone')} --><script>'{card('old', 'gone')}'</script>" + card("x", "a > b"),
        card("x", "a > b").replace('"product_pod"', "product_pod").replace('"price_color"', "'other price_color'"),
        card("x", "a > b").replace("</p></article>", "</article><p class='price_color'>£9</p>"),
    ],
)
def test_cards_in_any_spelling(spark, html):
    found = e.listing_cards(one(spark, html)).collect()
    assert [(r.title, r.price, r.rating_word, r.href) for r in found] == [("a > b", "£12.99", "Three", "x")]


def test_description_is_the_next_sibling_only(spark):
    for about, want in (
        ('<div id="product_description"></div><section><p>no</p></section><p>other</p>', None),
        ('<div id="product_description"><p>in</p></div><!-- x --> text <P> One <b>two</b> </P><p>other</p>', "Onetwo"),
        ('<div><div id="product_description"></div></div><p>of the parent</p>', None),
        ("<h2 id=product_description>D</h2><p>He said", "He said"),
    ):
        html = DETAIL.replace('<div id="product_description"><h2>D</h2></div>\n<p>He said</p>', about)
        assert e.parse_detail(one(spark, html)).first().description == want


def test_heading_stays_within_its_header(spark):
    pages = one(spark, '<div class="page-header"></div><h1>elsewhere</h1>', "http://shop.test/c")
    links = spark.createDataFrame([(0, 2, "http://shop.test/c")], "category_pos int, category_id int, category_url string")
    with pytest.raises(Exception, match="category page without heading"):
        e.extract_categories(pages, links).collect()


def test_next_button_without_link_is_an_error(spark):
    with pytest.raises(Exception, match="next button without link"):
        e.next_page_edges(one(spark, "<li class='next'>next</li><a href='x'>")).collect()


def test_null_and_long_pages(spark):
    long = "<p>word > " * 20_000
    pages = spark.createDataFrame([("a", None, AT), ("b", "", AT), ("c", long + card("x", "T"), AT)], schemas.PAGES)
    assert [r.url for r in e.listing_cards(pages).collect()] == ["c"]
    assert {r.url: r.reason for r in e.parse_detail(pages).collect()} == dict.fromkeys("abc", "no product table")
    assert e.page_links(pages).count() == 1
