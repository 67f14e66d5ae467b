from __future__ import annotations

import html
from datetime import datetime
from urllib.parse import urljoin

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stacklore.functions import text as x


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_strip_matches_python(spark):
    samples = ["  a b \n", " x ", "\x1cq\x1f", "", "plain", "\t\n ", "a\n\n"]
    df = spark.createDataFrame([(s,) for s in samples], "s string").select("s", x.strip(F.col("s")).alias("v"))
    assert {r.s: r.v for r in df.collect()} == {s: s.strip() for s in samples}


def test_entities(spark):
    samples = ["It&#39;s A &amp; B", "&pound;5 &eacute;", "a&b", "&amp;lt;", None]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.v for r in df.select(x.decode_entities(F.col("s")).alias("v")).collect()]
    assert got == [s if s is None else html.unescape(s) for s in samples]


def test_element_text(spark):
    body = x.element_body(F.lit('<p>x</p><p class="a price_color b"> <i>£1</i>&nbsp;</p>'), "p", "price_color")
    assert one(spark, x.inner_text(body)) == "£1"
    assert one(spark, x.element_body(F.lit('<p class="price_colors">1</p>'), "p", "price_color")) is None
    pieces = x.stripped_pieces(F.lit("<i> a </i> b&lt;c&gt; <!-- no --> d"))
    assert one(spark, pieces) == "ab<c>d"


def test_attribute(spark):
    tag = "<a data-href='no' href=\"q?a=1&amp;b\" title='t \"u\"' rel=me>later href='x'"
    assert one(spark, x.attribute(F.lit(tag), "href")) == "q?a=1&amp;b"
    assert one(spark, x.attribute(F.lit(tag), "title")) == 't "u"'
    assert one(spark, x.attribute(F.lit(tag), "rel")) == "me"
    assert one(spark, x.attribute(F.lit(tag), "class")) is None


def test_leading_int(spark):
    samples = {"In stock (22 available)": 22, "none": 0, "7 or 8": 7, "99999999999": None}
    for text, value in samples.items():
        assert one(spark, x.leading_int(F.lit(text))) == value


def test_utc_timestamp(spark):
    cases = {
        "2024-01-01T10:00:00.123456+00:00": datetime(2024, 1, 1, 10, 0, 0, 123456),
        "2024-01-01T10:00:00+05:00": datetime(2024, 1, 1, 5),
        "2024-01-01 10:00:00": datetime(2024, 1, 1, 10),
    }
    for zone in ("UTC", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for text, value in cases.items():
                assert one(spark, x.utc_timestamp(F.lit(text))) == value
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


SEGMENT = st.sampled_from(["a", "b_2", "..", ".", "page-2.html", ""])
BASE = st.builds(
    lambda host, path, tail: f"{host}/{'/'.join(path)}{tail}",
    st.sampled_from(["http://a.com", "https://x.example.org"]),
    st.lists(st.sampled_from(["a", "cat", "x_1"]), max_size=4),
    st.sampled_from(["", "/", "/index.html", "?q=1", "#top", "?q=1#top"]),
)
HREF = st.builds(
    lambda lead, path, tail: lead + "/".join(path) + tail,
    st.sampled_from(["", "/", "../", "../../", "./", "//h.com/"]),
    st.lists(SEGMENT, max_size=4),
    st.sampled_from(["", "/", "?z=1", "#f", "?z#f", "?", "#"]),
)


# One Spark job per example: many pairs in few examples, and no shrinking.
@settings(
    max_examples=4,
    deadline=None,
    derandomize=True,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(pairs=st.lists(st.tuples(BASE, HREF), min_size=60, max_size=120))
def test_url_join_matches_urllib(spark, pairs):
    # A network path without a host is not a reference.
    pairs = [(b, h) for b, h in pairs if h.startswith("//h.com/") or not h.startswith("//")]
    want = [(b, h, urljoin(b, h)) for b, h in pairs]
    df = spark.createDataFrame(want, "b string, h string, w string")
    got = df.withColumn("g", x.url_join(F.col("b"), F.col("h"))).filter("g is distinct from w")
    assert got.collect() == []


def test_strip_base(spark):
    assert one(spark, x.strip_base(F.lit("http://a.com/c/d"), "http://a.com")) == "c/d"
