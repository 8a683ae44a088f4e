"""Nothing is bounded, dropped or averaged away where the input is large or odd."""

import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from tillbook.llm import lm


def test_lm_entries_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(F.col("text").cast("binary").alias("text"), "doc_id", (F.col("doc_id") % 7 != 2).alias("use")).repartition(3, "doc_id")
    blocks = lm.bound(docs)
    inside = {r.block: list(zip(lm._texts(bytes(r.packed), r.sizes), r.use)) for r in blocks.collect()}
    rows_of = [SimpleNamespace(block=b, text=t, use=u) for b, texts in inside.items() for t, u in texts]
    assert len(inside) == 3 and Counter(r.text for r in rows_of) == Counter(bytes(r.text or b"") for r in docs.collect())
    asked, taught = {}, Counter()
    for r in rows_of:
        keys = np.concatenate(lm._keys(*lm.tokens([bytes(r.text or b"")]), 40)).tolist()
        asked.setdefault(r.block, set()).update(keys)
        if r.use:
            taught.update((d, k >> (lm.BITS - d)) for k in keys for d in range(lm.BITS + 1))
    found = {}
    rows = lm.answered(blocks, 4, 40).collect()
    summaries = [lm._unsqueezed(r.found, np.int64).reshape(2, -1) for r in rows if r.block == lm._SUMMARY]
    rows = [r for r in rows if r.block != lm._SUMMARY]
    assert {r.range for r in rows} == set(range(8))
    for r in sorted((r for r in rows if r.range < 4), key=lambda r: r.range):
        found.setdefault(r.block, []).append(lm._unsqueezed(r.found, np.int8).ravel())
    for block, keys in asked.items():
        order = sorted(keys)
        got = lm._spread(np.array(order, np.uint64), np.concatenate(found[block]))
        assert len(got) == len(order)
        for k in range(0, len(order), 97):
            key = order[k]
            for d in range(lm.BITS):
                node = key >> (lm.BITS - d)
                zeros, ones = taught[d + 1, 2 * node], taught[d + 1, 2 * node + 1]
                want = np.clip(np.log((ones + lm._PRIOR) / (zeros + lm._PRIOR)) * lm._UNIT, -lm._MOST, lm._MOST)
                assert abs((int(got[k, d]) >> 1) - want) <= 0.51 and got[k, d] & 1 == (zeros + ones >= lm._KNOWN)
    counted = Counter(t for r in rows_of if r.use for t in lm.tokens([bytes(r.text or b"")])[0].tolist())
    sizes = np.zeros((2, lm._NODES), np.int64)
    for token, n in counted.items():
        sizes[:, token >> (64 - lm.BITS)] += n, 1
    assert (sum(summaries) == sizes).all() and len(summaries) == 4


def mixed_by_one(hashes, counts, model, places, predicted):
    """The model as its docstring has it: a token, a bit and a predictor at a time."""
    out, first = [], 0
    start = np.array(lm.WEIGHTS).reshape(-1, 4)
    for n in counts:
        weights, correction, own = np.ones((4, lm.BITS)), np.zeros(lm._LEVELS), {}
        for step in range(first, first + n, lm.STEP):
            moves, moved, said = np.zeros((4, lm.BITS)), np.zeros(lm._LEVELS), []
            for at in range(step, min(step + lm.STEP, first + n)):
                total, node = 0.0, 1
                for d in range(lm.BITS):
                    bit = int(hashes[at]) >> (63 - d) & 1
                    zeros, ones = own.get((node, 0), 0), own.get((node, 1), 0)
                    entries = [int(predicted[place[at], d]) for place in places]
                    gate = sum(zeros + ones >= limit for limit in lm._SEEN) + 4 * max(entries[0] & 1, 2 * (entries[1] & 1))
                    stretched = np.clip(np.log((ones + lm._PRIOR) / (zeros + lm._PRIOR)), -lm._WIDEST, lm._WIDEST)
                    x = np.array([model.plain[node], (entries[0] >> 1) / lm._UNIT, (entries[1] >> 1) / lm._UNIT, stretched]) * start[gate]
                    raw = float(x @ weights[:, d])
                    level = int((np.clip(raw, -6, 5.99) + 6) * lm._LEVELS / 12)
                    probability = 1 / (1 + np.exp(-np.clip(raw + correction[level], -14, 14)))
                    error = bit - probability
                    total += np.log(1 - abs(error))
                    moves[:, d] += error * x
                    moved[level] += error
                    said.append((node, bit))
                    node = 2 * node + bit
                out.append(total)
            weights += lm.RATE * moves
            correction += lm.CORRECTION * moved
            for key in said:
                own[key] = own.get(key, 0) + 1
        first += n
    return np.array(out)


def test_lm_mixing_equals_a_scalar_version():
    random = np.random.default_rng(4)
    texts = [" ".join(random.choice(["a", "bb", "ccc", "dd", "the", "of"], n)).encode() for n in (0, 1, 40, 200, 33)]
    hashes, counts, ((pairs, places), (h, (token,))) = lm._placed_keys(texts, 40)
    told = random.integers(0, 9, len(pairs))
    entries = lm._entries(pairs, told)
    predicted = lm._spread(pairs, entries[lm._first_at(pairs)])
    assert (predicted == lm._of_ones(pairs, entries.copy())).all()
    sizes = 1.0 + lm._prefix_sizes(h, random.integers(0, 50, len(h))).sum(axis=0)
    model = lm.Model(lm._of_sizes(sizes), sizes, 1, 1)
    got = lm.mixed(hashes, counts, model, places, predicted)
    want = mixed_by_one(hashes, counts, model, places, predicted)
    assert len(got) == sum(counts) == 279 and np.abs(got - want).max() < 2e-3


def test_lm_contexts_do_not_share_statistics(spark):
    """A million words with one possible next word each: far more (context, node) than 2^20."""
    n, length = 1_000_000, 10_000
    follow = np.random.default_rng(5).permutation(n)
    rows, word = [], 0
    for k in range(100):
        said = []
        for _ in range(length):
            said.append(f"w{word}")
            word = int(follow[word])
        rows += [(k, " ".join(said))]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 2]
    rows += [(1000 + k, text) for k, (_, text) in enumerate(held) if zlib.crc32(str(1000 + k).encode()) % 7 != 2]
    found = lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out")
    base, score = found.agg(F.sum("base_score"), F.sum("score")).first()
    print("share of bits", score / base)
    assert score > 0.5 * base
