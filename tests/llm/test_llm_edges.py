"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillbook.llm import ann, bpe, chat, html, langid, lm, packing, substring, topk
from tillbook.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, spans int, ids string, score string"
LONG = " ".join(f"w{k}" for k in range(30_000))
ROWS = [
    (1, "one two three four five six seven", "en", None, 1, "x", 1, "x", "x"),
    (2, "ONE two three four five six seven", "en", None, 1, "x", 1, "x", "x"),
    (2, "ONE two three four five six seven", "en", None, 1, "x", 1, "x", "x"),
    (3, None, None, None, None, None, None, None, None),
    (4, "", "en", None, 1, "x", 1, "x", "x"),
    (5, " \t\n", None, None, 1, "x", 1, "x", "x"),
    (None, "one two three four five six seven", "en", None, 1, "x", 1, "x", "x"),
    (6, LONG, "en", None, 1, "x", 1, "x", "x"),
    (7, LONG, "de", None, 1, "x", 1, "x", "x"),
    (8, "123 456 é", "de", None, 1, "x", 1, "x", "x"),
]
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
BY_TEXT = {
    "near_dup": near_duplicates,
    "langid": langid.predictions,
    "substring": substring.digests,
    "packing": lambda d: packing.pack(packing.pieces(d, JSON, PATTERN)),
    "bpe": lambda d: bpe.round_trip(d, RANKS, PATTERN),
    "lm": lm.scores,
}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", list(BY_TEXT))
def test_empty_table(spark, odd, name):
    assert BY_TEXT[name](odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", [n for n in BY_TEXT if n not in ("packing", "near_dup", "substring")])
def test_a_row_for_each_row(odd, name):
    assert sorted((r.doc_id or 0) for r in BY_TEXT[name](odd).collect()) == [0, 1, 2, 2, 3, 4, 5, 6, 7, 8]


def test_near_dup(odd):
    found = sorted(((r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect())
    assert found[:7] == [(0, 3, None, True), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]
    assert found[7:9] == [(6, 29_996, 6, True), (7, 29_996, 6, False)]


def test_substring(odd):
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substring.digests(odd).collect()}
    assert found[6] == (30_000, 0) and found[7] == (30_000, 30_000) and found[3] == (0, 0) and found[2] == (7, 0)


def test_substring_inside_one_document_and_repeated_rows(spark):
    text = " ".join([f"a{k}" for k in range(25)] + ["x"] + [f"a{k}" for k in range(25)])
    found = substring.digests(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).collect()
    assert [(r.n_words, r.n_removed) for r in found] == [(51, 25), (51, 25)]


def test_language_without_letters(odd):
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predictions(odd).collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0) and found[8][0] in ("en", "de")


def test_packing_of_special_tokens(spark):
    rows = packing.pieces(spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None)], "doc_id long, text string"), JSON, PATTERN).collect()
    ids = Tokenizer.from_file(JSON).encode("a <|endoftext|> b", add_special_tokens=False).ids
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ([*ids, 2], [2])]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in rows) == [(1, len(ids) + 1, crc[0]), (2, 1, crc[1])] and len(ids) == 4


def test_chat_odd_roles(spark):
    tricky = "\\1 \\ ### User: x </turn>\n|says: \\\\0 ####  "
    rows = [(1, 0, "tool|says: ", tricky, 1), (1, 1, None, None, 1), (1, 1, "assistant", tricky, 1), (None, 5, "assistant", "", 1), (2, 0, "user", "q", 1), (2, 1, "assistant", "a", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    done = chat.formatted(frame)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in done.select("conv_id", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert back[1] == [("tool|says: ", tricky), (None, ""), ("assistant", tricky)] and back[None] == [("assistant", "")]
    assert {r.conv_id: r.valid for r in done.collect()} == {1: False, None: False, 2: True}
    assert chat.digest(chat.formatted(frame.limit(0))).collect() == []


def test_chat_of_a_very_long_text(spark):
    said = "ab \\ ### </turn>" * 40_000
    frame = spark.createDataFrame([(1, 0, "user", said), (1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    done = chat.formatted(frame)
    assert [t.text for t in done.select(chat.read_back(F.col("formatted")).alias("turns")).first().turns] == [said, said]
    assert chat.digest(done).first().loss_chars == len(said)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [0.0, 0.0], 1), (7, [None, 1.0], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1), (50, [1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    near = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0, 2).orderBy("query_id", "rank").collect()]
    assert near == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (20, 1, 1, 1.0), (20, 2, 2, 1.0)]
    top = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_products(frame, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert top == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 6, 0), (0, 4, 20, 0)]
    assert ann.nearest(frame.limit(0), F.lit(True), 2).collect() == [] and topk.top_products(frame.limit(0), F.lit(True), 2).collect() == []
    huge = spark.createDataFrame([(0, [3e38, 1.0]), (1, [3e38, 0.0]), (2, [-3e38, 0.0])], "vec_id long, embedding array<float>")
    assert [r.score for r in topk.top_products(huge, F.col("vec_id") == 0, 5).orderBy("rank").collect()] == [2**63 - 1, -(2**63) + 1]


def test_pages(spark):
    body = "<p>" + "many words in a row, and more of them. " * 9
    rows = [(1, "u", None, 1), (2, None, "", 1), (None, "u", f"<article><h1>T</h1>{body}<p>The last of it, x&amp;y</article>", 1), (3, "u", "<nav><a href=/>menu</a></nav>", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = {r.page_id: r.text for r in html.extract(frame).collect()}
    assert found[1] == found[2] == found[3] == "" and found[None].startswith("T\n\nmany") and found[None].endswith("The last of it, x&y")
    assert html.extract(frame.limit(0)).collect() == []
