"""Postings are compared whole, in blocks that do not grow with them."""

import numpy as np

from test_llm_queries import components_by_brute_force
from tillbook.llm import near_dup


def test_near_dup_deals_members_and_probes(spark, monkeypatch):
    """One posting of 600 documents that are all their own component."""
    monkeypatch.setattr(near_dup, "_BLOCK_MEMBERS", 50)
    sizes = [100 + 7 * k for k in range(600)]
    prefix = spark.createDataFrame([(k, 1, 600) for k in range(600)], "doc_id long, token long, held long")
    labelled = spark.createDataFrame([(k, n, k) for k, n in enumerate(sizes)], "doc_id long, n long, component long")
    groups = {}
    for r in near_dup._dealt(prefix, labelled).collect():
        groups.setdefault((r.token, r.band, r.block, r.turn), ([], []))[r.probe].append(r.doc_id)
    assert max(len(side) for sides in groups.values() for side in sides) <= 100
    met = [tuple(sorted((u, v))) for held, probes in groups.values() for u in held for v in probes if u != v]
    able = {(u, v) for v in range(600) for u in range(v) if 100 * sizes[u] >= near_dup.PERCENT * sizes[v]}
    assert able <= set(met) and len(set(met)) < 600 * 599 // 2


def test_near_dup_with_shared_boilerplate(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "_BLOCK_MEMBERS", 16)
    dice = np.random.default_rng(3)
    common = [f"c{k}" for k in range(60)]
    texts = {k: " ".join([*common, *(f"w{x}" for x in dice.integers(0, 10**9, 50 + k % 40))]) for k in range(150)}
    texts |= {1000 + k: texts[k] + " one more end" for k in range(0, 150, 5)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame).collect()}
    assert found == components_by_brute_force(texts)
