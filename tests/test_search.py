from __future__ import annotations

import json
import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from stacklore.operators import dense, lexical, search
from stacklore.operators.blocks import question_blocks
from stacklore.plans import answer as a
from stacklore.sources.tables import list_indexes

WORDS = "red blue green small large ring bolt nut gear the of and".split()


def texts(n, seed):
    rng = np.random.default_rng(seed)
    # "the" is in most texts, and a third of the texts are copies of one.
    out = [" ".join(rng.choice(WORDS, size=rng.integers(3, 12))) for _ in range(n)]
    return [out[0] if i % 3 == 0 else t + (" the" if i % 4 else "") for i, t in enumerate(out)]


def tfidf_brute(docs, questions, k):
    def tf(text):
        return Counter(re.findall(r"[^\W_]+", text.lower()))

    counts = {i: tf(t) for i, t in docs.items()}
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((len(docs) + 1) / (n + 1)) for w, n in df.items()}

    def unit(c):
        w = {t: n * idf[t] for t, n in c.items() if idf.get(t, 0) > 0}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / size for t, x in w.items()}

    vectors = {i: unit(c) for i, c in counts.items()}
    out = []
    for q, text in questions.items():
        asked = unit(tf(text))
        scores = [(-round(sum(x * v.get(t, 0) for t, x in asked.items()), 9), i) for i, v in vectors.items() if asked.keys() & v.keys()]
        out += [(q, i, r + 1) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus(spark):
    docs = dict(enumerate(texts(120, 1)))
    questions = dict(enumerate(texts(20, 2)))
    d = spark.createDataFrame([(i, t, len(t)) for i, t in docs.items()], "id long, body string, size int")
    q = spark.createDataFrame(list(questions.items()), "qid long, question string")
    return docs, questions, d, q, lexical.build_lexical_index(d, "id", "body")


def ranked(df):
    return sorted((r.qid, r.doc_id, r["rank"]) for r in df.collect())


def test_lexical_equals_brute_force(corpus):
    docs, questions, _, q, index = corpus
    assert ranked(lexical.search_lexical(q, index, k=5)) == tfidf_brute(docs, questions, 5)


def test_lexical_blocks_give_the_same(corpus):
    docs, questions, _, q, index = corpus
    assert ranked(lexical.search_lexical(q, index, k=4, block_terms=25)) == tfidf_brute(docs, questions, 4)


def test_questions_longer_than_a_block_give_the_same(corpus):
    """Some questions have more terms than a block holds, some not; every document sum meets again."""
    docs, questions, _, q, index = corpus
    sizes = {r.qid: r.n for r in lexical.question_terms(q, index.terms, "qid", "question").groupBy("qid").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    limit = sorted(sizes.values())[len(sizes) // 2] - 1
    assert min(sizes.values()) <= limit < max(sizes.values())
    assert ranked(lexical.search_lexical(q, index, k=4, block_terms=limit)) == tfidf_brute(docs, questions, 4)
    assert ranked(lexical.search_lexical(q, index, k=4, block_terms=9)) == tfidf_brute(docs, questions, 4)


def test_lexical_filter_before_scoring(corpus):
    docs, _, _, q, index = corpus
    hits = lexical.search_lexical(q, index, k=3, where=F.col("size") < 30).collect()
    assert hits and all(len(docs[r.doc_id]) < 30 for r in hits)
    assert Counter(r.qid for r in hits).most_common(1)[0][1] == 3


def test_lexical_no_overlap_no_hits(spark, corpus):
    q = spark.createDataFrame([(1, "zebra"), (2, ""), (3, None)], "qid long, question string")
    hits = lexical.search_lexical(q, corpus[4])
    assert hits.collect() == [] and hits.columns == ["qid", "doc_id", "score", "rank"]


def test_lexical_saved_index(spark, corpus):
    docs, questions, _, q, index = corpus
    spark.sql("create schema if not exists search_test")
    lexical.save_lexical_index(index, "search_test", "book", buckets=4)
    stored = lexical.open_lexical_index(spark, "search_test", "book", "id")
    hits = lexical.search_lexical(q, stored, k=5)
    # Postings come bucketed by document: the sums need no shuffle, only the k best do.
    assert plan(hits).count("Exchange hashpartitioning") == 1
    assert ranked(hits) == tfidf_brute(docs, questions, 5)
    assert [r.tableName for r in list_indexes(spark, "search_test").collect()] == ["book_search"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(300, 8)).astype(np.float32)
    m[::3] = m[0]  # copies: a third of the rows
    m[5] = 0
    q = rng.normal(size=(12, 8))
    q[0] = m[0]
    d = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(999, None)], "id long, embedding array<float>")
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "qid int, vector array<double>")
    return m.astype(float), q, d.repartition(5), asked


def dense_brute(m, q, k):
    out = []
    for i, v in enumerate(q):
        with np.errstate(invalid="ignore"):
            s = m @ v / (np.linalg.norm(m, axis=1) * np.linalg.norm(v))
        order = sorted((-round(x, 9), j) for j, x in enumerate(s) if not np.isnan(x))
        out += [(i, j, r + 1) for r, (_, j) in enumerate(order[:k])]
    return sorted(out)


def test_dense_equals_brute_force_with_copies(vectors):
    m, q, d, asked = vectors
    index = dense.build_dense_index(d, "id")
    assert ranked(dense.search_dense(asked, index, k=5)) == dense_brute(m, q, 5)
    assert ranked(dense.search_dense(asked, index, k=5, block_vectors=3)) == dense_brute(m, q, 5)


def test_dense_small_batches_and_text_ids(spark, vectors):
    m, q, d, asked = vectors
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        named = d.withColumn("id", F.format_string("d%04d", "id"))
        hits = dense.search_dense(asked, dense.build_dense_index(named, "id"), k=5)
        got = sorted((r.qid, int(r.doc_id[1:]), r["rank"]) for r in hits.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == dense_brute(m, q, 5)


def test_dense_filter_and_wrong_length(spark, vectors):
    m, q, d, asked = vectors
    hits = dense.search_dense(asked, dense.build_dense_index(d, "id"), k=3, where=F.col("id") > 200)
    assert all(r.doc_id > 200 for r in hits.collect())
    short = asked.withColumn("vector", F.slice("vector", 1, 4))
    with pytest.raises(Exception, match="expected vectors of 4"):
        dense.search_dense(short, dense.build_dense_index(d, "id")).collect()


def test_cells_all_probed_are_exact_and_recall_is_high(vectors):
    m, q, d, asked = vectors
    cells = dense.build_cells(dense.build_dense_index(d, "id"), cells=8)
    exact = dense_brute(m, q, 5)
    assert ranked(dense.search_dense(asked, cells, k=5, probes=8)) == exact
    some = ranked(dense.search_dense(asked, cells, k=5, probes=4))
    recall = len({x[:2] for x in some} & {x[:2] for x in exact}) / len(exact)
    assert recall >= 0.8


def test_question_blocks_hold_every_row_once(spark):
    df = spark.range(1000).select((F.col("id") % 200).alias("qid"), "id")
    blocks = question_blocks(df, "qid", 60)
    sizes = [b.count() for b in blocks]
    assert max(sizes) <= 60 and sum(sizes) == 1000
    assert sorted(r.id for b in blocks for r in b.collect()) == list(range(1000))
    with pytest.raises(ValueError, match="one qid holds more than"):
        question_blocks(df.withColumn("qid", F.lit(1)), "qid", 60)


@pytest.fixture(scope="module")
def book_search(spark, built):
    docs = search.build_search_docs(built["dim_books"]).cache()
    questions = spark.createDataFrame(
        [(1, "a quiet walk in travel"), (2, "locked room mystery"), (3, "zebra")], "qid long, question string"
    )
    return docs, questions, lexical.build_lexical_index(docs, "book_title", "search_text")


def test_search_docs(book_search):
    assert sorted(r.search_text for r in book_search[0].collect()) == [
        "Alpha [Travel]: A quiet walk.", 'Charlie [Travel]: It\'s a "long" road.',
        "Delta [Mystery]: A locked room.", "Echo [Historical Fiction]: New text.",
    ]


def test_search_columns_and_filter(book_search):
    docs, questions, index = book_search
    hits = search.search(questions, index)
    assert hits.columns == ["qid", "rank", "score", *search.RETURN_COLUMNS]
    first = {r.qid: r.book_title for r in hits.filter("rank = 1").collect()}
    assert first == {1: "Alpha", 2: "Delta"}
    only = search.search(questions, index, where=F.col("category_name") == "Mystery", columns=("book_title",))
    assert {r.book_title for r in only.collect()} == {"Delta"}


def test_search_with_embedder(book_search):
    docs, questions, _ = book_search
    embedder = dense.hashing_embedder(256)
    index = dense.build_dense_index(dense.embed(docs, "search_text", embedder), "book_title")
    hits = search.search(questions, index, k=2, embedder=embedder, columns=("book_title",))
    first = {r.qid: r.book_title for r in hits.filter("rank = 1 and qid < 3").collect()}
    assert first == {1: "Alpha", 2: "Delta"}


def test_preview_json(spark, book_search):
    docs, _, index = book_search
    requests = spark.createDataFrame(
        [
            (1, json.dumps({"query": "quiet walk a travel", "columns": ["book_title", "price_gbp"], "limit": 1})),
            (2, json.dumps({"query": "zebra", "columns": ["book_title"], "limit": 3})),
            (3, json.dumps({"query": "a road travel"})),
        ],
        "qid long, request string",
    )
    responses = search.search_preview(requests, index)
    found = {r.qid: json.loads(r.response)["results"] for r in responses.collect()}
    assert found[1] == [{"book_title": "Alpha", "price_gbp": 10.0}] and found[2] == []
    assert found[3][0]["book_title"] == "Charlie" and "stock_status" in found[3][0]
    flat = search.flatten_results(responses).filter("qid = 1")
    assert rows(flat)[0][:5] == (1, 0, "Alpha", None, 10)


def test_whole_number_price_rounds_half_up(spark):
    r = spark.createDataFrame([(1, '{"results":[{"price_gbp":19.51},{"price_gbp":19.5},{"price_gbp":19.49}]}')], "qid int, response string")
    assert [int(x.price_gbp) for x in search.flatten_results(r).orderBy("pos").collect()] == [20, 20, 19]


def test_prompt_and_answer(book_search):
    docs, questions, index = book_search
    prompts = a.build_prompt(questions, search.search(questions, index, k=1))
    got = {r.qid: r.prompt for r in prompts.collect()}
    assert got[1] == (
        "You are a book recommendation assistant.\n"
        "Answer using ONLY the books listed below. If none match the request, say so honestly"
        " — do not invent titles.\n\n"
        '1. "Alpha" (Travel, £10.0, ★★★)\n   A quiet walk.\n\n'
        "Question: a quiet walk in travel\nAnswer:"
    )
    assert got[3] is None

    def upper(prompts, model):
        return [f"{model}:{len(prompts)}:{p[-7:]}" for p in prompts]

    answered = {r.qid: r for r in a.answer(prompts, upper, model="m", partitions=1).collect()}
    assert answered[1].answer == "m:2:Answer:"
    assert answered[3].answer == a.NO_MATCH and answered[3].books == []
    assert answered[2].books[0].asDict() == {
        "book_title": "Delta", "category_name": "Mystery", "price_gbp": 15.0, "rating_stars": 5,
        "description": "A locked room.",
    }
