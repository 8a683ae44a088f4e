import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from oracle import assert_same
from tokenizers import Tokenizer

import corpus_pipeline
from tillbook.llm import bpe, html, packing, registry


def table(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pandas()


def components_by_brute_force(texts):
    sets, holders = {}, {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[key] = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for shingle in sets[key]:
            holders.setdefault(shingle, []).append(key)
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key, own in sets.items():
        for other, n in Counter(k for s in own for k in holders[s] if k < key).items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                a, b = sorted((find(key), find(other)))
                parent[b] = a
    return {key: (len(sets[key]), find(key)) for key in sets}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, small, name):
    assert_same(registry.queries()[name](spark, small), registry.oracle_sql()[name], small)


def test_near_dup_equals_brute_force(spark, small):
    docs = table(small, "documents")
    want = components_by_brute_force(dict(zip(docs.doc_id, docs.text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.op1_near_dup(spark, small).collect()}
    assert got == want


def test_language_held_out_accuracy(spark, small):
    docs = table(small, "documents").set_index("doc_id")
    found = [r for r in registry.op3_language_id(spark, small).collect()]
    assert len(found) == len(docs)
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([docs.lang[r.doc_id] == r.lang_pred for r in held]) > 0.95


def test_packing_holds_every_id_once(spark, small):
    docs = table(small, "documents")
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = registry.op5_packing(spark, small).toPandas()
    by_doc = {k: g.sort_values("piece") for k, g in rows.groupby("doc_id")}
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = np.array(tool.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = by_doc[doc_id]
        assert own.length.sum() == len(ids) and (own.length[1:] == 1024).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length)] == list(own.ids_crc32)
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert list(group.offset) == [0, *np.cumsum(group.length)[:-1]] and group.length.sum() <= 1024
    assert rows.sequence_id.nunique() <= 1.02 * rows.length.sum() / 1024 + 1


def test_plan_packs_everything_and_prefers_two_for_one():
    counts = np.zeros(11, np.int64)
    counts[[7, 5, 4, 3]] = 1, 2, 1, 1
    used = np.zeros(11, np.int64)
    for lengths, times in packing.plan(counts):
        assert sum(lengths) <= 10
        used += times * np.bincount(lengths, minlength=11)
    assert (used == counts).all()


def test_ann_recall(spark, small):
    frame = table(small, "embeddings")
    vectors, ids = np.array(frame.embedding.tolist(), float), frame.vec_id.to_numpy()
    found = registry.op6_ann(spark, small).toPandas()
    hits = []
    for query, group in found.groupby("query_id"):
        score = vectors @ vectors[ids == query][0]
        score[ids == query] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -score))[:20]]) & set(group.vec_id)) / 20)
    assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_bpe_equals_tiktoken(spark, small):
    docs = table(small, "documents")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in registry.op7_bpe(spark, small).collect()}
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_odd_texts():
    codec = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for text in ["", " ", "\x00\x01 \n\n\t x", "日本語 текст ñandú", "▁a▁ <unk> <s>", "a" * 5000, "😀" * 50, "it's  we'll", "  x​"]:
        ids = codec.encode(text)
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_lm_base_and_model(spark, small):
    docs = table(small, "documents")
    tokens = {k: (t or "").encode().lower().split() + [None] for k, t in zip(docs.doc_id, docs.text)}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    counts = Counter(t for k, ts in tokens.items() if not held[k] for t in ts)
    total = sum(counts.values())
    rows = registry.op8_lm_score(spark, small).collect()
    for r in rows:
        base = sum(np.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens[r.doc_id]) and abs(r.base_score - base) < 1e-6
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_html_of_given_and_composed_pages(spark, small):
    pages = table(small, "pages").set_index("page_id")
    for row in registry.op9_html_text(spark, small).collect():
        inside = pages.html[row.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.html.unescape(html.re.sub(r"<[^>]+>", " ", b)).split()) for b in html.re.split(r"</?(?:p|h1)>", inside)]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


def test_pipeline_stages_keep_clean_documents(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "packing"]
    registry.ship(spark)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    named = corpus_pipeline.in_a_language(spark, docs, small)
    assert named.columns == docs.columns and {r.doc_id for r in named.collect()} == {k for k, t in texts.items() if any(c.isalpha() for c in t)}
    single = corpus_pipeline.one_of_each_group(spark, docs, small)
    want = components_by_brute_force(texts)
    assert sorted(r.doc_id for r in single.collect()) == sorted(k for k, (_, c) in want.items() if k == c)
    stripped = corpus_pipeline.without_repeats(spark, docs, small)
    assert stripped.columns == docs.columns
    left, seen = {r.doc_id: r.text for r in stripped.collect()}, set()
    for key in sorted(texts):
        words = texts[key].encode().split()
        windows = [tuple(words[k : k + 20]) for k in range(len(words) - 19)]
        repeats = [w in seen or w in windows[:k] for k, w in enumerate(windows)]
        kept = [w for p, w in enumerate(words) if not any(repeats[max(0, p - 19) : p + 1])]
        assert left.get(key, "").encode().split() == kept
        seen.update(windows)


def test_bpe_forgets_only_what_did_not_occur_for_long(monkeypatch):
    """Pre-tokens that occur all the time are encoded once, however many others come by, and few are held."""
    monkeypatch.setattr(bpe, "_REMEMBERED", 20)
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    whole, encoded = codec.model, []

    class Model:
        def encode(self, pieces, **more):
            encoded.extend(pieces)
            return whole.encode(pieces, **more)

    codec.model = Model()
    texts = [" Zqxjvwkq" + "".join(f" Xvq{chr(97 + k // 26)}{chr(97 + k % 26)}{c}zzq" for c in "bcdfg") for k in range(40)]
    for text in texts:
        assert codec.decode(codec.encode(text)) == text.encode()
    assert len(encoded) == len(set(encoded)) == 201
    assert len(codec.known) < 40
