"""Searches and models whose work must not outgrow their input."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from test_search import ranked, texts, tfidf_brute

from stacklore.functions import markup
from stacklore.operators import blockmax, lexical, topk_kernel
from stacklore.plans import marts, staging


@pytest.fixture(scope="module")
def corpus(spark):
    docs = {f"d{i}": t for i, t in enumerate(texts(200, 11))} | {"e1": "", "e2": None}
    questions = dict(enumerate(texts(90, 12)))
    d = spark.createDataFrame(list(docs.items()), "id string, body string")
    q = spark.createDataFrame(list(questions.items()), "qid long, question string")
    wanted = tfidf_brute({i: t or "" for i, t in docs.items()}, questions, 5)
    return d, q, lexical.build_lexical_index(d, "id", "body"), wanted


def test_no_row_per_question_and_document(corpus):
    """F2-F7: pairs of questions and documents are neither hashed nor sorted."""
    d, q, index, wanted = corpus
    for hits in (lexical.search_lexical(q, index, k=5), blockmax.search_blocks(q, blockmax.block_index(index, 3), k=5)):
        assert ranked(hits) == wanted
        text = plan(hits)
        assert "MapInArrow" in text
        assert not any("HashAggregate(keys=" in line and "qid#" in line and "doc_id#" in line and "weight" in line
                       for line in text.splitlines())


def test_texts_are_counted_where_they_are_read(spark, corpus):
    d = corpus[0].withColumn("body", F.concat("body", F.lit(" ÄÖ ñ٣ the THE")))
    found = lexical.doc_term_counts(d, "id", "body")
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(lexical.term_counts(d, "id", "body")) != []
    assert lexical.doc_term_counts(d.limit(0), "id", "body").collect() == []


@pytest.mark.parametrize("cells", [1, 7, 2**20])
def test_sums_do_not_depend_on_how_many_are_held(monkeypatch, cells):
    monkeypatch.setattr(topk_kernel, "CELLS", cells)
    rng = np.random.default_rng(3)
    n, n_terms, docs = 70, 9, 40
    weights = rng.random((n_terms, n)) * (rng.random((n_terms, n)) < 0.4)
    at = [np.flatnonzero(w) for w in weights]
    asked = topk_kernel.TermWeights(
        pa.array(range(n)), np.cumsum([0, *map(len, at)]), np.concatenate(at), np.concatenate([w[i] for w, i in zip(weights, at)]))
    lists = [rng.choice(n_terms, rng.integers(0, 5), replace=False) for _ in range(docs)]
    open_to = rng.integers(-(2**63), 2**63 - 1, (docs, 2))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([f"d{i}" for i in range(docs)]), pa.array([x.tolist() for x in lists], pa.list_(pa.int32())),
         pa.array([[0.5] * len(x) for x in lists], pa.list_(pa.float64())), pa.array(open_to.tolist(), pa.list_(pa.int64()))],
        names=["doc_id", "no", "weight", "open"])
    schema = pa.schema([("qid", pa.int64()), ("doc_id", pa.string()), ("score", pa.float64())])
    for part, masked in ((batch, True), (batch.select(["doc_id", "no", "weight"]), False)):
        wanted = []
        for q in range(n):
            scores = [(-round(sum(weights[t, q] * 0.5 for t in x), 9), f"d{i}") for i, x in enumerate(lists)
                      if any(weights[t, q] for t in x) and (not masked or int(open_to[i, q // 64]) >> (q % 64) & 1)]
            wanted += [(q, i, -s) for s, i in sorted(scores)[:3]]
        parts = topk_kernel.best_documents(iter([part.slice(0, 13), part.slice(13)]), asked, 3, schema)
        found = [tuple(r.values()) for p in parts for r in p.to_pylist()]
        assert [r[:2] for r in found] == [r[:2] for r in wanted]
        assert np.allclose([r[2] for r in found], [r[2] for r in wanted])


def test_texts_are_joined_last_and_once(spark):
    """the dimension deals its long column once and sorts none of it; ties, repeats and missing links as before."""
    at = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    books = staging.stg_books(spark.createDataFrame(
        [(f"B{i}", "£5.00", "Two", i % 3, f"u{i}", at[0]) for i in range(12)],
        "product_name string, price string, rating_word string, category_id int, book_url string, extracted_at timestamp"))
    categories = staging.stg_categories(spark.createDataFrame(
        [(0, "A", at[0]), (1, "B", at[0])], "category_id int, category_name string, extracted_at timestamp"))
    scrapes = spark.createDataFrame(
        [(f"u{i % 10}", "upc", i % 2, 1, at[i % 2], None if i % 7 == 0 else i % 6) for i in range(40)],
        "book_url string, upc string, num_in_stock int, num_reviews int, extracted_at timestamp, text_key int")
    lookup = spark.createDataFrame([(0, " b "), (0, "a"), (1, None), (2, "  "), (3, "c"), (None, "x")], "text_key int, description string")
    before = marts.dim_books(books, categories, staging.stg_inventory(scrapes, texts=lookup))
    inventory, linked = staging.stg_inventory_linked(scrapes, lookup)
    after = marts.dim_books(books, categories, inventory, texts=linked)
    assert rows(after) == rows(before) and len(rows(after)) == 12
    long = [line for line in plan(after).splitlines() if "Exchange hashpartitioning" in line or "Sort [" in line]
    assert not any("book_url" in line and "description" in line for line in long) and "ShuffledHashJoin" in plan(after)


def test_attributes_not_there_are_not_read():
    """a tag without an attribute's name is not taken apart for it."""
    page = markup.Page('<p class="a &amp; b">x<b>y</b></p><i ID=q></i><p data-id=1></p>')
    first, _, third, last = page.elements
    assert first.attribute("id") is None and first._attributes is None
    assert [e.index for e in page.with_id("q")] == [2] and last.attribute("id") is None
    assert first.classes() == ["a", "&", "b"] and page.of_name == {"p": [0, 3], "b": [1], "i": [2]}
    assert [e.index for e in page.find_all("p", None, 1)] == [3] and first.text() == "xy"
