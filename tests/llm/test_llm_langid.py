"""What a text is judged by: its own grams and nothing else."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import langid

LEARN = [("en", "hello world and the other things of the world"), ("de", "hallo welt und die anderen dinge der welt"), ("fr", "bonjour le monde et les autres choses"), (None, "zq zq")]
TEXTS = ["zq", "hel", "hello world", "hallo welt", "x", "", " the ", "é", "die", "a b c d", "le monde", "WELT", "bonjour", "42 things", "日本語", "und"]


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.createDataFrame(LEARN * 3, "lang string, text string"))


def grams_by_hand(text):
    clean = "".join(chr(langid._CLEAN[b]) for b in text.encode())
    padded = " " * 4 + clean + " " * 4
    return [padded[k : k + 4] for k in range(len(padded) - 3) if padded[k : k + 4].count(" ") <= 1]


def number(gram):
    return int.from_bytes(bytes(ord(c) for c in gram), "big")


def test_grams_equal_brute_force_in_any_batch():
    dice = np.random.default_rng(1)
    for _ in range(20):
        some = [TEXTS[k] for k in dice.integers(0, len(TEXTS), dice.integers(0, 9))]
        found, owner = langid.grams([t.encode() for t in some])
        for k, text in enumerate(some):
            assert found[owner == k].tolist() == [number(g) for g in grams_by_hand(text)]


def test_shares_equal_plain_sets(model):
    """A gram counts for a language if all its rows of the filter have the language's bit."""
    value, total = langid.shares([t.encode() for t in TEXTS], model)
    for k, text in enumerate(TEXTS):
        own = grams_by_hand(text)
        assert total[k] == len(own)
        for lang in range(len(model.languages)):
            hits = 0
            for gram in own:
                slots = [int(s[0]) for s in langid._slots(np.array([number(gram)], np.uint32), model.masks.shape[1])]
                hits += all(int(model.masks[0][s]) >> lang & 1 for s in slots)
            rate = model.false_rate[lang]
            assert abs(value[k, lang] - max(0, (hits - len(own) * rate) / (1 - min(rate, 0.999)))) < 1e-9


def test_grams_that_were_learnt_are_in_the_filter(model):
    for lang, text in LEARN[:3]:
        value, total = langid.shares([text.encode()], model)
        assert value[0].argmax() == model.languages.index(lang)


def test_a_text_alone_and_in_any_batch_gets_the_same_row(spark, model):
    alone = [tuple(x[0] for x in langid._decide([t.encode()], model)) for t in TEXTS]
    dice = np.random.default_rng(2)
    for _ in range(20):
        order = dice.permutation(len(TEXTS))
        together = list(zip(*langid._decide([TEXTS[k].encode() for k in order], model)))
        assert together == [alone[k] for k in order]
    rows = [(k, t, None) for k, t in enumerate(TEXTS)] + [(100 + k, text, lang) for k, (lang, text) in enumerate(LEARN)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = [
        sorted(map(tuple, langid.identify(frame.repartition(n, "doc_id"), F.col("lang").isNotNull()).collect()))
        for n in (1, 3, 11)
    ]
    assert seen[0] == seen[1] == seen[2] and dict((r[0], r[1]) for r in seen[0])[2] == "en"


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([(1, bytearray(b"\xff\xfe\x80"), None), (2, bytearray(b"\xffhello"), None), (3, bytearray(b"hello world"), "en")], "doc_id long, raw binary, lang string")
    frame = rows.select("doc_id", F.expr("cast(raw as string)").alias("text"), "lang")
    found = {r.doc_id: r.lang_pred for r in langid.identify(frame, F.col("lang").isNotNull()).collect()}
    assert found == {1: "und", 2: "en", 3: "en"}
