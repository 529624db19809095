"""Centroid clustering over dictionary-encoded vectors against plain integer arithmetic, on odd rows."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import subvectors
from riskflow.llm.queries import centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def brute(rows, k=16, rounds=3, dims=64):
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e, *_ in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    kept = [(i, [min(max(x, -subvectors.LARGEST), subvectors.LARGEST) for x in q]) for i, q in kept]
    name = lambda i: hashlib.sha256(("1" if i is None else f"1:{i}").encode()).hexdigest()
    centroids = [q for _, q in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(q)[1] for _, q in kept]
        for n in range(len(centroids)):
            of = [q for (_, q), m in zip(kept, own) if m == n]
            if of:
                centroids[n] = [sum(column) // len(of) for column in zip(*of)]
    found = [nearest(q) for _, q in kept]
    each, total = Counter(), sum(d for d, _ in found)
    for d, n in found:
        each[n] += d
    return Counter((i, n, d, each[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, found))


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(0, 0.2, 64).astype(np.float32)]) for k in range(150)]
    same = rows[0][1]
    rows += [(k, same) for k in range(200, 300)] + [(5, same)] * 3 + [(None, same), (None, [0.5] * 64)]
    rows += [(400, None), (401, []), (402, same[:63]), (403, [*same, 0.0]), (404, [*same[:63], None]), (405, [*same[:63], float("nan")]), (406, [float("-inf"), *same[1:]])]
    rows += [(500, [3e38, -3e38, *same[2:]])]
    return [(*r, 1, 7, "x") for r in rows]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.data())
def test_codes_lose_nothing(dims, width, data):
    q = np.array(data.draw(st.lists(st.lists(st.integers(-3, 3), min_size=dims, max_size=dims), min_size=1, max_size=30)), np.int32)
    chunk = subvectors._Chunk(subvectors._encoded([0] * len(q), q, width), dims, width)
    assert (chunk.decoded() == q).all()
    assert all(len(e) == len(np.unique(q[:, c], axis=0)) for e, c in zip(chunk.entries, chunk.columns))
    centroids = q[: min(3, len(q))].astype(np.int64)
    apart = ((q[:, None, :].astype(np.int64) - centroids) ** 2).sum(axis=2)
    cluster, distance = chunk.nearest(centroids)
    assert (cluster == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    for c, row in enumerate(chunk.sums(cluster, len(centroids))):
        assert row.tolist() == [*q[cluster == c].sum(axis=0).tolist(), int((cluster == c).sum())]


@pytest.mark.parametrize("width, chunk_rows", [(2, 8192), (5, 7)])
def test_clusters(spark, width, chunk_rows, monkeypatch):
    monkeypatch.setattr(subvectors, "encode", lambda kept, dims, w, f=subvectors.encode: f(kept, dims, w, chunk_rows))
    rows = odd_rows()
    found = subvectors.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3), width=width)
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_fewer_vectors_than_centroids(spark):
    rows = odd_rows()[:5]
    assert Counter(map(tuple, subvectors.cluster(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_query(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert Counter(map(tuple, centroid_clusters(spark, str(tmp_path)).collect())) == brute(rows)


def test_no_vectors(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert centroid_clusters(spark, str(tmp_path)).collect() == []
