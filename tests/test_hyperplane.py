"""Multi-probe hyperplane tables against the exact search."""

from __future__ import annotations

import numpy as np
import pytest
from test_search import dense_brute

from stacklore.operators import dense, hyperplane


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    m = (centres[rng.integers(12, size=900)] + 0.4 * rng.normal(size=(900, 16))).astype(np.float32)
    m[::3] = m[0]  # copies: a third of the rows in one code of every table
    q = m[1:40:3] + 0.1 * rng.normal(size=(13, 16))
    d = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(9999, None)], "id long, embedding array<float>")
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)] + [(99, None)], "qid int, vector array<double>")
    return m.astype(float), q, dense.build_dense_index(d.repartition(5), "id"), asked


def hits(df):
    return sorted((r.qid, r.doc_id, r["rank"]) for r in df.collect())


def test_all_probes_are_exact(clustered):
    m, q, index, asked = clustered
    built = hyperplane.build_hyperplanes(index, tables=3, bits=4)
    best, scored = hyperplane.search_hyperplanes(asked, built, k=5, probes=16)
    assert hits(best) == dense_brute(m, q, 5)
    assert {r.scored for r in scored.collect()} == {900}


def test_few_probes_find_most_and_score_less(clustered):
    m, q, index, asked = clustered
    best, scored = hyperplane.search_hyperplanes(asked, hyperplane.build_hyperplanes(index, tables=10, bits=6), k=5, probes=4)
    exact = {h[:2] for h in dense_brute(m, q, 5)}
    assert len({h[:2] for h in hits(best)} & exact) >= 0.9 * len(exact)
    assert all(r.scored < 0.75 * 900 for r in scored.collect())


def test_codes_are_probed_by_distance():
    rng = np.random.default_rng(1)
    planes, v = rng.normal(size=(2, 5, 8)), rng.normal(size=(3, 8))
    for probes in (1, 3, 32):
        found = hyperplane.probed_codes(v, planes, probes)
        assert (found.sum(axis=2) == probes).all()
        for i, t in np.ndindex(3, 2):
            d = planes[t] @ v[i]
            cost = [sum(d[b] ** 2 for b in range(5) if (d[b] > 0) != bool(c >> b & 1)) for c in range(32)]
            assert set(np.flatnonzero(found[i, t])) == set(np.argsort(cost, kind="stable")[:probes])


def test_empty_index(clustered, spark):
    _, _, index, asked = clustered
    none = dense.build_dense_index(index.rows.limit(0), "id")
    best, scored = hyperplane.search_hyperplanes(asked, hyperplane.build_hyperplanes(none))
    assert best.count() == 0 and scored.count() == 0
