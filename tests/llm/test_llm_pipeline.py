"""The stages of the corpus pipeline one by one and all together."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_llm_queries import components_by_brute_force
from tillbook.llm import common, near_dup, registry

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
T = "one and the same text of more than five words in two rows"
U = "a different text that happens to have the same number as its id"


def docs(spark, *rows):
    registry.ship(spark)
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], SCHEMA)


def ids_and_texts(frame):
    assert frame.columns == corpus_pipeline.COLUMNS
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_language_stage_drops_only_what_has_no_letter(spark):
    rows = [(1, T, "en"), (1, T, "en"), (2, None, "en"), (3, "", "en"), (4, "12 34 \u00b2", None), (None, U, None), (5, "\u65e5\u672c", None)]
    want = sorted([(1, T), (1, T), (None, U), (5, "\u65e5\u672c")], key=repr)
    assert ids_and_texts(corpus_pipeline.in_a_language(spark, docs(spark, *rows), "")) == want
    unlabelled = [(i, t, None) for i, t, _ in rows]
    assert ids_and_texts(corpus_pipeline.in_a_language(spark, docs(spark, *unlabelled), "")) == want


def test_near_duplicates_are_dropped_by_row(spark):
    """A clean text stays though another row with its id is a copy; of repeated rows one stays."""
    rows = [(1, T, "en"), (1, T, "en"), (2, T, "en"), (2, U, "en"), (2, U, "de"), (None, T, "en"), (None, T, "en"), (3, None, "en"), (3, None, "en"), (4, "", "en")]
    kept = ids_and_texts(corpus_pipeline.one_of_each_group(spark, docs(spark, *rows), ""))
    assert kept == sorted([(1, T), (2, U), (None, T), (None, T), (3, None), (4, "")], key=repr)
    plain = [(1, T, "en"), (2, T + " more", "en"), (3, U, "en")]
    assert ids_and_texts(corpus_pipeline.one_of_each_group(spark, docs(spark, *plain), "")) == [(1, T), (3, U)]


def test_substring_stage(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(1, passage, "en"), (2, f"own\twords {passage}  end", "en"), (3, "kept  as\tit is", "en"), (4, None, "en"), (5, passage, "en")]
    found = ids_and_texts(corpus_pipeline.without_repeats(spark, docs(spark, *rows), ""))
    assert found == sorted([(1, passage), (2, "own words end"), (3, "kept  as\tit is"), (4, None)], key=repr)


def test_packing_stage_holds_every_token_once(spark):
    rows = [(1, T, "en"), (1, T, "en"), (2, None, "en"), (None, U, "en"), (3, "x " * 3000, "en")]
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(len(tool.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    found = corpus_pipeline.packed(spark, docs(spark, *rows), "").toPandas()
    assert found.length.sum() == sum(want) and found.groupby("sequence_id").length.sum().max() <= 1024
    for _, group in found.sort_values("offset").groupby("sequence_id"):
        assert list(group.offset) == [0, *np.cumsum(group.length)[:-1]]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_of_nothing_is_nothing(spark, name, stage):
    assert stage(spark, docs(spark), "").collect() == []


def test_run_equals_brute_force(spark, small):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    named = {k: t for k, t in rows.items() if any(c.isalpha() for c in t or "")}
    single = {k: named[k] for k, (_, first) in components_by_brute_force(named).items() if k == first}
    tool, seen, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), set(), {}
    for key in sorted(single):
        words = single[key].encode().split()
        windows = [tuple(words[k : k + 20]) for k in range(len(words) - 19)]
        repeats = [w in seen or w in windows[:k] for k, w in enumerate(windows)]
        kept = [w for p, w in enumerate(words) if not any(repeats[max(0, p - 19) : p + 1])]
        seen.update(windows)
        text = single[key] if len(kept) == len(words) else b" ".join(kept).decode()
        if kept or len(kept) == len(words):
            ids = np.array(tool.encode(text, add_special_tokens=False).ids + [2], "<u4")
            want |= {(key, s): zlib.crc32(ids[s : s + n].tobytes()) for s, n in pieces(len(ids))}
    found = corpus_pipeline.run(spark, small).collect()
    assert {(r.doc_id, r.start): r.ids_crc32 for r in found} == want and len(found) == len(want)


def pieces(n):
    first = n % 1024 or 1024
    return [(0, first), *((s, 1024) for s in range(first, n, 1024))]


def test_the_stage_of_near_copies_broadcasts_no_table_by_an_estimate(spark, monkeypatch):
    """Of what it writes only the texts that stay are joined with a written table, whose size is no estimate."""
    plans, write = [], common.save

    def save(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, label)

    for module in (common, near_dup, corpus_pipeline):
        monkeypatch.setattr(module, "save", save)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join([*words[:58], "x", "y"]), " ".join(reversed(words)), " ".join(words)]
    docs = spark.createDataFrame([(k, text, "en", "s", len(text)) for k, text in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert len(plans) > 9 and not [plan for plan in plans if "Broadcast" in plan]
    assert sorted(r.doc_id for r in found.collect()) == [0, 2]
