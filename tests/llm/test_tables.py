"""Archives, vector search, SQL of the queries, and the pipeline."""

from __future__ import annotations

import os

import check
import corpus_pipeline
import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stacklore.llm import common, oracle, pivot_search, warc
from stacklore.llm.queries import QUERIES
from stacklore.session import materialise

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no data folder")


@needs_data
@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in check.TABLES:
        db.execute(f"create view {table} as select * from read_parquet('{DATA}/{table}.parquet')")
    df = QUERIES[name](spark, DATA)
    result = db.execute(oracle.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows([tuple(r) for r in df.collect()], df.columns) == check.rows(result.fetchall(), columns)


def test_search_of_odd_vectors(spark):
    data = [(0, [0.1, 0.2]), (100, [0.1, -0.2]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (None, [0.3, 0.3])]
    df = spark.createDataFrame([(*r, 1) for r in data], "vec_id long, embedding array<double>, part int")
    found = rows(pivot_search.top_k(df, F.col("vec_id") % 100 == 0, k=3))
    scores = {}
    whole = {i: [int((x * 1024) // 1) for x in v] for i, v in data if v and all(x is not None and abs(x) < 1e9 for x in v)}
    for q in (0, 100):
        ranked = sorted(((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i is None, i) for i, v in whole.items() if i != q),
                        key=lambda t: (t[0], t[1], t[2] or 0))[:3]
        scores[q] = [(i, -s) for s, _, i in ranked]
    assert {q: [(r[2], r[3]) for r in sorted(f for f in found if f[0] == q)] for q in (0, 100)} == scores
    assert pivot_search.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_queries_repeated_with_one_id_take_the_smallest_vector(spark):
    data = [(0, [2.0, 0.0]), (0, [0.0, 3.0]), (0, [1.0, 5.0]), (1, [1.0, 4.0]), (1, [1.0, 4.0]), (2, [9.0, 1.0])]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").coalesce(1)
        found = rows(pivot_search.top_k(df, F.col("vec_id") == 0, k=5))
        assert [(r[2], r[3]) for r in sorted(found)] == [(1, 12 << 20), (1, 12 << 20), (2, 3 << 20)]


def test_search_over_many_parts_and_copies(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(pivot_search, "PART_ROWS", 64)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 8))
    x[200:400] = x[0]  # a third are copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole = np.floor(x * 1024).astype(np.int64)
    found = pivot_search.top_k(df, F.col("vec_id") % 100 == 0, k=10).toPandas()
    for q in range(0, 600, 100):
        s = whole @ whole[q]
        want = sorted((-int(v), i) for i, v in enumerate(s) if i != q)[:10]
        mine = found[found.query_id == q].sort_values("rank")
        assert list(zip(-mine.score, mine.vec_id, strict=True)) == want


def test_archives_of_odd_pages(spark):
    big = "<p>é</p>" * 200
    data = [(1, "http://a/x y", big), (2, None, big), (None, "", big), (3, "u", None), (4, "u", ""), (5, "u", "a\r\n\r\nb"),
            (6, "u", "small"), (7, "u", "small"), (2, None, big)]
    pages = spark.createDataFrame([(*r, "p", 0) for r in data], "page_id long, url string, html string, path string, offset int")
    found = rows(warc.archive_pages(pages).select("page_id", "payload_bytes", "record_type", "refers_to"))
    n = len(big.encode())
    assert sorted(found, key=repr) == sorted([
        (1, n, "revisit", 2), (2, n, "response", None), (2, n, "revisit", 2), (None, n, "revisit", 2), (3, 0, "response", None),
        (4, 0, "response", None), (5, 6, "response", None), (6, 5, "response", None), (7, 5, "response", None)], key=repr)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_broadcasts_are_counted_by_nested_content(spark):
    entries = [(n, f"<urn:uuid:{n:036d}>") for n in range(5000)]
    revisits = spark.createDataFrame([("a", entries), ("b", None), ("c", [None])], "path string, revisits array<struct<o: long, r: string>>")
    assert not common.fits_broadcast(revisits, 5000 * 47)
    assert common.fits_broadcast(revisits, 5000 * 120)
    named = spark.createDataFrame([({"k": "v" * 1000}, ("s" * 1000,)), (None, None)], "m map<string, string>, s struct<`x.y`: string>")
    assert not common.fits_broadcast(named, 2000)
    assert common.fits_broadcast(named, 2400)


def test_archives_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "lookup_side", lambda df, label: common.lookup_side(df, label, 5000))
    looked_up = []
    monkeypatch.setattr(common, "fits_broadcast", lambda *a, f=common.fits_broadcast: looked_up.append(f(*a)) or looked_up[-1])
    data = [(i, f"http://h/{i}", f"<p>{i % 3}</p>" * 200) for i in range(90)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rows(warc.archive_pages(pages).select("page_id", "record_type", "refers_to"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert looked_up == [True, False]
    assert found == sorted([(i, "response", None) if i >= 87 else (i, "revisit", 87 + i % 3) for i in range(90)], key=repr)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_headers(version):
    block = warc.arc_version_block("f.arc", version)
    content = block + warc.arc_record(9, "http://h/", "body", version, len(block), "f.arc")
    record = next(warc.parse_arc(content))
    assert (record.page_id, record.payload, record.fields["Archive-date"]) == (9, b"body", warc.BASE_DATE)
    with pytest.raises(ValueError, match="declares"):
        list(warc.parse_arc(content[:-4]))
    with pytest.raises(ValueError, match="version"):
        list(warc.parse_arc(content[len(block):]))


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, DATA), "stage")
        counts.append(docs.count())
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert counts[0] <= 200 and counts[0] >= counts[1] >= counts[2] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    copies = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    assert {r["doc_id"]: r["n"] for r in total} == {r["doc_id"]: r["t"] * copies[r["doc_id"]] for r in total}
    assert len(total) == len(copies)


def test_record_ids_are_reproducible_and_unique(spark):
    data = [(i // 2, f"http://h/{i % 5}", f"<p>{i % 3}</p>" * 200) for i in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3, "page_id")
    first, second = (rows(warc.archive_pages(pages).select("page_id", "record_id", "record_type")) for _ in range(2))
    assert first == second and len({r[1] for r in first}) == 60
