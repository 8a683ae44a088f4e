import numpy as np
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from tillbook.llm import negatives, registry

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id int, place int"


def brute_force(rows, anchor, positives=5, negatives_=3):
    used = sorted({(i, l, tuple(np.floor(256 * np.array(v, float)).astype(object))) for i, v, l in rows}, key=repr)
    exact = [(i, l, [int(x) for x in v]) for i, l, v in used]
    out = []
    for a, (i, l, v) in enumerate(exact):
        if not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for b, (j, m, w) in enumerate(exact) if b != a and len(v) == len(w))
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            inside = [x for x in scored if x[2] != l and -50 * s <= -100 * x[0] <= -95 * s][:negatives_]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame([(i, [float(x) for x in v], l, "x", 1, 2) for i, v, l in rows], SCHEMA)
    found = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, F.col("label"), **more).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found)


def test_equals_sql_at_a_larger_scale(spark, small):
    folder = small.replace("sf0.001", "sf0.1")
    assert_same(registry.op13_hard_negatives(spark, folder), negatives.ORACLE, folder)


@pytest.mark.parametrize("kind", ["even", "uneven", "ties", "negative", "repeated"])
def test_several_blocks_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "ROWS", 60)
    random = np.random.default_rng(5)
    values = random.normal(size=(300, 12))
    if kind == "uneven":
        values *= random.lognormal(0, 2, (300, 1))
    if kind == "ties":
        values = np.round(values)
    if kind == "negative":
        values = -np.abs(values) * np.where(np.arange(300)[:, None] % 2, 1, -1)
    rows = [(k, np.float32(v), int(l)) for k, (v, l) in enumerate(zip(values, random.integers(0, 6, 300)))]
    rows += [(300, np.float32(values[0]), 9), (301, np.zeros(12), 1), (310, np.zeros(12), 1)]  # a label of its own, zeros
    if kind == "repeated":
        rows += rows[:40] + [(k, v, l + 1) for k, v, l in rows[:20]] + [(k, -v, l) for k, v, l in rows[20:30]]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0)


def test_other_lengths_huge_numbers_and_empty_vectors(spark):
    rows = [(0, [3e30, 1.0], 1), (1, [3e30, 0.0], 1), (2, [2e30, 0.0], 2), (10, [1.0], 1), (11, [1.0], 1), (12, [0.75], 2), (20, [], 1), (21, [], 1), (22, [], 3)]
    found = mined(spark, rows)
    assert (10, 11, 1, 12, 65536, 49152) in found and (20, 21, 1, 22, 0, 0) in found
    assert not [r for r in found if r[0] == 0]  # all scores are the largest long, none is in the window


def test_nulls_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.5], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2), (7, [1.0, 0.5], None), (None, [1.0, 0.5], 2)]
    frame = spark.createDataFrame([(i, v, l, "x", 1, 2) for i, v, l in rows], SCHEMA)
    found = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, F.col("label"))
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 2, 131072, 98304)]
    assert negatives.hard_negatives(frame.limit(0), F.lit(True), F.col("label")).collect() == []


def test_the_index_leaves_components_out_and_loses_no_row():
    random = np.random.default_rng(6)
    values = np.floor(256 * random.normal(size=(500, 32)) / 6)
    index = negatives.Index(values)
    posted = [sum(len(rows) for _, rows, _ in band) for band in index.bands]
    assert sum(posted) == np.count_nonzero(values) and posted[0] < 0.6 * sum(posted)
    calls = {}

    def full(k, rows, scores, least):
        exact = values @ values[k]
        assert sorted(rows) == sorted(np.flatnonzero(exact >= least)) and (exact[rows] == scores).all()
        calls[k] = calls.get(k, 0) + 1
        return len(rows) >= 6

    index.join(values[:20], full)
    assert len(calls) == 20 and max(calls.values()) < len(index.bands)
