"""Block-max search and the postings log equal the exhaustive search of a fresh index."""

from __future__ import annotations

import os
import shutil

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_search import ranked, texts, tfidf_brute

from stacklore.operators import blockmax, lexical, postings_log, search

DOC = "id long, body string, size int"


def topical(n, seed, topics=20):
    """Texts about one of many topics, with words common to all."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        topic = rng.integers(topics)
        words = [f"t{topic}w{rng.integers(8)}" for _ in range(rng.integers(3, 9))] + list(rng.choice(["the", "of", "and", "red"], 4))
        out.append(" ".join(words))
    return out


def table(spark, docs):
    return spark.createDataFrame([(i, t, len(t or "")) for i, t in docs.items()], DOC)


def asked(spark, questions):
    return spark.createDataFrame(list(questions.items()), "qid long, question string")


@pytest.mark.parametrize(("make", "bits"), [(texts, 2), (texts, 10), (topical, 3)])
def test_hits_are_those_of_the_exhaustive_search(spark, make, bits):
    docs, questions = dict(enumerate(make(300, 1))), dict(enumerate(make(25, 2)))
    index = blockmax.block_index(lexical.build_lexical_index(table(spark, docs), "id", "body"), bits)
    hits = blockmax.search_blocks(asked(spark, questions), index, k=5)
    assert hits.columns == ["qid", "doc_id", "score", "rank"]
    assert ranked(hits) == tfidf_brute(docs, questions, 5)


def test_blocks_out_of_reach_are_not_scored(spark):
    docs, questions = dict(enumerate(topical(1200, 3))), dict(enumerate(topical(20, 4)))
    index = blockmax.block_index(lexical.build_lexical_index(table(spark, docs), "id", "body"), 3)
    rounds = []
    hits = blockmax.search_blocks(asked(spark, questions), index, k=5, scored=rounds)
    assert ranked(hits) == tfidf_brute(docs, questions, 5)
    sizes = index.postings.select("block", "doc_id").distinct().groupBy("block").count()
    done = sum(r.join(sizes, "block").agg(F.sum("count")).first()[0] or 0 for r in rounds)
    terms = lexical.question_terms(asked(spark, questions), index.terms, "qid", "question").select("qid", "term")
    sharing = index.postings.join(terms, "term").select("qid", "doc_id").distinct().count()
    assert done < sharing / 3
    pairs = [tuple(r) for part in rounds for r in part.collect()]
    assert len(pairs) == len(set(pairs))


def test_filter_and_questions_without_hits(spark):
    docs = dict(enumerate(texts(120, 5)))
    index = blockmax.block_index(lexical.build_lexical_index(table(spark, docs), "id", "body"), 3)
    questions = {0: "red ring", 1: "zebra", 2: "", 3: None}
    hits = blockmax.search_blocks(asked(spark, questions), index, k=200, where=F.col("size") < 30).collect()
    assert {r.qid for r in hits} == {0} and all(len(docs[r.doc_id]) < 30 for r in hits)
    plain = lexical.search_lexical(asked(spark, questions), lexical.build_lexical_index(table(spark, docs), "id", "body"), 200, F.col("size") < 30)
    assert sorted((r.doc_id, r["rank"]) for r in hits) == sorted((r.doc_id, r["rank"]) for r in plain.collect())
    empty = blockmax.block_index(lexical.build_lexical_index(table(spark, docs).limit(0), "id", "body"))
    assert blockmax.search_blocks(asked(spark, questions), empty).count() == 0


def test_a_question_of_many_terms(spark):
    """More terms than fit one broadcast block of the exhaustive form."""
    docs = {i: f"w{i} w{i + 1}" for i in range(60)}
    question = " ".join(f"w{i}" for i in range(120_000))
    index = blockmax.block_index(lexical.build_lexical_index(table(spark, docs), "id", "body"))
    hits = blockmax.search_blocks(asked(spark, {1: question}), index, k=3).collect()
    assert len(hits) == 3


def test_books_of_one_title_are_two_documents(spark, built):
    dim = built["dim_books"].filter("book_title = 'Alpha'")
    twice = dim.withColumn(search.KEY, F.lit("u1")).unionByName(dim.withColumn(search.KEY, F.lit("u2")))
    other = built["dim_books"].filter("book_title <> 'Alpha'").withColumn(search.KEY, F.col("upc"))
    docs = search.build_search_docs(twice.unionByName(other))
    questions = asked(spark, {1: "a quiet walk"})
    index = blockmax.block_index(lexical.build_lexical_index(docs, search.KEY, "search_text"))
    assert [r.book_title for r in search.search(questions, index, k=1).collect()] == ["Alpha"]
    assert sorted(r.book_title for r in search.search(questions, index, k=2).collect()) == ["Alpha", "Alpha"]
    with pytest.raises(ValueError, match="no unique key"):
        lexical.build_lexical_index(docs, "book_title", "search_text")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_series_of_refreshes_equals_a_fresh_build(spark, tmp_path, seed):
    rng = np.random.default_rng(seed)
    path, questions = f"{tmp_path}/index", dict(enumerate(topical(8, 9, topics=4)))
    docs = {}
    for version in range(5):
        for i in rng.choice(40, 15, replace=False).tolist():
            if rng.random() < 0.25:
                docs.pop(i, None)
            else:
                docs[i] = topical(1, int(rng.integers(1000)), topics=4)[0] if rng.random() < 0.9 else ["", None][int(rng.integers(2))]
        changes = postings_log.refresh_postings(table(spark, docs), path, "id", "body", version)
        if version == 3:
            # Cut off before its documents were written: the version does not count, and is written again.
            shutil.rmtree(f"{path}/docs/version=3")
            assert postings_log.versions(spark, path) == [0, 1, 2]
            changes = postings_log.refresh_postings(table(spark, docs), path, "id", "body", version)
        index = blockmax.block_index(postings_log.open_postings(spark, path, "id"), 3)
        assert ranked(blockmax.search_blocks(asked(spark, questions), index, k=5)) == tfidf_brute(
            {i: t or "" for i, t in docs.items()}, questions, 5)
    written = sum(len(files) for _, _, files in os.walk(f"{path}/postings/version=4"))
    assert written and changes.count() < 30
    assert postings_log.refresh_postings(table(spark, docs), path, "id", "body", 5).count() == 0
    postings_log.compact_postings(spark, path, "id", f"{tmp_path}/small")
    again = postings_log.open_postings(spark, f"{tmp_path}/small", "id")
    assert rows(again.docs) == rows(table(spark, docs))
    assert ranked(lexical.search_lexical(asked(spark, questions), again, k=5)) == tfidf_brute(
        {i: t or "" for i, t in docs.items()}, questions, 5)


def test_partial_refresh_keeps_other_documents(spark, tmp_path):
    path = f"{tmp_path}/index"
    postings_log.refresh_postings(table(spark, {1: "red ring", 2: "blue bolt"}), path, "id", "body", 0)
    postings_log.refresh_postings(table(spark, {2: "green nut"}), path, "id", "body", 1, deletes=False)
    index = postings_log.open_postings(spark, path, "id")
    assert rows(index.docs.select("id", "body")) == [(1, "red ring"), (2, "green nut")]
    assert {r.term for r in index.terms.collect()} == {"red", "ring", "green", "nut"}
