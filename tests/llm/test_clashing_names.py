"""Extra columns may have any name, those used inside the operators included."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stacklore.llm import (
    exact_dedup,
    jaccard_join,
    mixing,
    packing,
    pii,
    pivot_search,
    prefix_trie,
    quality,
    sharding,
    term_pipeline,
    toxicity,
    url_filter,
    warc,
)

NAMES = ["_id", "_label", "_kept", "_sha", "_class", "_row", "_dropped", "_part", "_place", "_start", "_tie", "_mix_id", "_plain",
         "_group", "_digit", "_rest", "_cls", "_root", "_v", "cls", "v", "part", "root", "key", "path", "range", "row", "_n", "a.b"]
TEXTS = ["one two three four five six", "one two three four five six", "a b c d e f g h i j k l", "a b c d e f g h i j k l m",
         None, "", "idiot " * 4, "you are an idiot and a fool, call +1 (988) 555-2485"]


def with_extras(df):
    for name in NAMES:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def plain(spark):
    data = [(i, TEXTS[i % len(TEXTS)], "en", f"s{i % 3}") for i in range(32)] + [(3, TEXTS[3], "en", "s0"), (3, TEXTS[0], "en", "s0")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def labels(spark):
    data = [(i, int(i % 3 == 0), int(i % len(TEXTS) >= 6)) for i in range(32)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


STAGES = {
    "toxicity": lambda d, labels: toxicity.without_toxic(d, toxicity.fit(d, labels)),
    "exact": lambda d, labels: exact_dedup.without_copies(d),
    "near": lambda d, labels: jaccard_join.one_per_component(d),
    "mixing": lambda d, labels: mixing.mix(d),
    "sharding": lambda d, labels: sharding.shard_rows(d, ["doc_id", "text"], 3).drop("shard", "slot"),
}
QUERIES = {
    "pii": lambda d, labels: pii.find(d, pii.fit(d)),
    "quality": lambda d, labels: quality.score(d, quality.fit(d, labels)),
    "packing": lambda d, labels: packing.pack(d).select("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
    "exact": lambda d, labels: exact_dedup.exact_copies(d).drop("kept"),
    "near": lambda d, labels: jaccard_join.near_components(d),
    "toxicity": lambda d, labels: toxicity.score(d, toxicity.fit(d, labels), "doc_id"),
    "mixing": lambda d, labels: mixing.mixing_plan(d),
    "search": lambda d, labels: term_pipeline.search(d, d.withColumn("item_id", F.col("doc_id"))).drop("rank"),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_of_any_name(plain, labels, name):
    wide = STAGES[name](with_extras(plain), with_extras(labels))
    assert wide.columns == [*plain.columns, *NAMES]
    assert {tuple(r)[len(plain.columns):] for r in wide.collect()} <= {("x",) * len(NAMES)}
    assert rows(wide.select(plain.columns)) == rows(STAGES[name](plain, labels).select(plain.columns))


@pytest.mark.parametrize("name", QUERIES)
def test_queries_ignore_columns_of_any_name(plain, labels, name):
    assert rows(QUERIES[name](with_extras(plain), with_extras(labels))) == rows(QUERIES[name](plain, labels))


def test_sharding_replaces_its_own_names_only(plain):
    found = sharding.shard_rows(with_extras(plain).withColumn("shard", F.lit("old")), ["doc_id", "text"], 3)
    assert found.columns == [*plain.columns, *NAMES, "shard", "slot"]
    assert {r[0] for r in found.select("shard").collect()} == {0, 1, 2}


def test_other_tables(spark):
    vectors = spark.createDataFrame([(i, [i / 7, 1.0 - i / 5]) for i in range(20)], "vec_id long, embedding array<double>")
    pages = spark.createDataFrame([(i, f"http://h/{i % 3}/{i}", "<p>x</p>" * (150 * (i % 2))) for i in range(20)], "page_id long, url string, html string")
    turns = spark.createDataFrame([(i // 3, i % 3, "u", f"t{i % 2}") for i in range(30)], "conv_id long, turn int, role string, text string")
    for operator, table in (
        (lambda t: pivot_search.top_k(t, t["vec_id"] % 5 == 0, k=3), vectors),
        (lambda t: warc.archive_pages(t).select("page_id", "payload_digest", "record_type", "refers_to"), pages),
        (lambda t: url_filter.judge(t, [url_filter.Rule("h", "/0", "allow")]), pages),
        (prefix_trie.conversation_trie, turns),
    ):
        assert rows(operator(with_extras(table))) == rows(operator(table))
