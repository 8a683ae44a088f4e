"""Recall against brute force over several blocks, for even and for uneven norms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import ann, topk, vectors

NORMS = {
    "even": lambda dice, n: np.ones(n), "uneven": lambda dice, n: dice.lognormal(0, 1, n),
    "a little uneven": lambda dice, n: dice.uniform(0.5, 1, n), "tiny and huge": lambda dice, n: 10.0 ** dice.integers(-6, 7, n),
}


def clustered(dice, n, dims):
    values = dice.normal(size=(n, dims)) + 1.5 * dice.normal(size=(12, dims))[dice.integers(0, 12, n)]
    return values / np.sqrt((values**2).sum(axis=1))[:, None]


@pytest.mark.parametrize("norms", NORMS)
def test_recall_over_several_blocks(spark, monkeypatch, norms):
    monkeypatch.setattr(vectors, "_ROWS", 2_500)
    dice = np.random.default_rng(8)
    values = clustered(dice, 6_000, 24) * NORMS[norms](dice, 6_000)[:, None]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(values)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(frame, F.col("vec_id") % 100 == 0, 20).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = []
    for query, ranked in found.items():
        score = values @ values[query]
        score[query] = -np.inf
        assert sorted(ranked) == list(range(1, 21))
        assert all(abs(ranked[k][1] - score[ranked[k][0]]) <= 1e-9 * max(1.0, abs(score[ranked[k][0]])) for k in ranked)
        hits.append(len({v for v, _ in ranked.values()} & set(np.argsort(-score)[:20])) / 20)
    assert len(hits) == 60 and np.mean(hits) >= 0.9 and min(hits) >= 0.5


def test_ties_over_several_blocks(spark, monkeypatch):
    """Equal products in all blocks: the smaller numbers win."""
    monkeypatch.setattr(vectors, "_ROWS", 10)
    rows = [(k, [1.0, float(k >= 50)]) for k in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    top = topk.top_products(frame, F.col("vec_id") == 70, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in top] == [(k, 131072) for k in range(50, 55)]
    near = ann.nearest(frame, F.col("vec_id") == 70, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in near] == [(k, 2.0) for k in range(50, 55)]


def test_topk_reads_postings_and_stops_on_proof():
    """A segment posts only vectors with an impact, and most queries end before the last segment."""
    dice = np.random.default_rng(9)
    values = np.floor(256 * clustered(dice, 1_000, 32))
    index = topk.Index(values)
    posted = np.zeros_like(values)
    for segment in index.segments:
        for d, rows, impacts in segment:
            assert (impacts != 0).all()
            posted[rows, d] += impacts
    assert (posted == values).all()
    assert sum(len(rows) for _, rows, _ in index.segments[0]) < 0.2 * values.size
    read = []

    class Counted(list):
        def __iter__(self):
            for segment in super().__iter__():
                read.append(len(segment))
                yield segment

    index.segments = Counted(index.segments)
    found = index.top(values[:50], 5, [np.array([k]) for k in range(50)])
    for k, (rows, scores) in enumerate(found):
        exact = values @ values[k]
        exact[k] = -np.inf
        assert (scores == exact[rows]).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(rows.tolist())
    assert len(read) <= len(index.segments)
