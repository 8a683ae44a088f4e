"""Language identification with bit-sliced Bloom filters of byte 4-grams.

All languages share one filter: a row of it is a bit mask with a bit per language. The rows that a gram
hashes to, combined by AND, give every language whose filter holds the gram. A text's grams are looked up
together; the popcounts per language are corrected for the false positives that the filter's own fill
predicts, and the largest share decides.

A language's filter holds the grams that are about as frequent in it as in any other. As only grams above
a least frequency enter, a filter has at most 1 / ``LEAST`` grams of a language however large the corpus is,
which bounds what is sent to the driver and to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import carried, carry_schema, grouped, mix, rows, save, uncarried

LEAST = 2e-6  # least relative frequency of a gram in its language
SHARE = 0.5  # of its highest relative frequency in any language
HASHES = 3
ROWS_PER_GRAM = 8  # filter rows for each gram of the fullest language
UNKNOWN = "und"
_WORD = 64  # languages in one mask
_BLOCK_BYTES = 1 << 18
_FLUSH = 1 << 20
_GAP = b"    "
_LETTER = regex.compile(r"\p{L}")

# Letters in lower case and all bytes of other scripts stay; the rest separates words.
_CLEAN = np.full(256, 0x20, np.uint8)
_CLEAN[0x80:] = np.arange(0x80, 0x100)
_CLEAN[0x61:0x7B] = _CLEAN[0x41:0x5B] = np.arange(0x61, 0x7B)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """4-grams with at most one separator as 32-bit numbers, and the text that each belongs to.

    Every text stands between separators, so its grams do not depend on the texts beside it; the second byte of
    a gram lies in its text, the first may be the separator before it.
    """
    data = _CLEAN[np.frombuffer(_GAP + b"".join(text + _GAP for text in texts), np.uint8)]
    wide = data.astype(np.uint32)
    pair = wide[:-1] << np.uint32(8) | wide[1:]
    found = pair[:-2] << np.uint32(16) | pair[2:]
    gap = (data == 0x20).view(np.int8)
    twice = gap[:-1] + gap[1:]
    at = np.flatnonzero(twice[:-2] + twice[2:] <= 1)
    ends = len(_GAP) + np.cumsum([len(text) + len(_GAP) for text in texts])
    return found[at], np.searchsorted(ends, at + 1, side="right")


def _slots(found: np.ndarray, size: int) -> Iterator[np.ndarray]:
    mixed = mix(found.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(HASHES):
        yield (mixed >> np.uint64(21 * k)) & np.uint64(size - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n), added up over what a task has read so far."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        both, n = (np.concatenate(x) for x in zip(*parts))
        keys, at = np.unique(both, return_inverse=True)
        return keys, np.bincount(at, n, len(keys)).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "gram": pa.array(keys.astype(np.int64)), "n": pa.array(n)})

    for part in grouped(rows(batches), lambda r: len(r[1]), _BLOCK_BYTES):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in part:
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            keys, n = np.unique(grams(texts)[0], return_counts=True)
            held.setdefault(lang, []).append((keys, n))
            size += len(keys)
        if size > _FLUSH:
            held = {lang: [merged(parts)] for lang, parts in held.items()}
            size = sum(len(parts[0][0]) for parts in held.values())
            if size > _FLUSH // 2:
                yield from flush()
                held, size = {}, 0
    yield from flush()


@dataclass(frozen=True)
class Model:
    """languages, their filter as masks [word of 64 languages, row], each language's false positive rate."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    default: str


def fit(documents: DataFrame) -> Model:
    """Learn from all rows of (lang, text); null languages and texts teach nothing."""
    source = documents.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    counted = save(source.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = {row.lang: row.total for row in totals.collect()}
    if not sizes:
        return Model([], np.zeros((1, 1), np.uint64), np.zeros(0), UNKNOWN)
    languages = sorted(sizes)
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)])
    frequency = F.create_map(*[F.lit(x) for lang in languages for x in (lang, 1.0 / sizes[lang])])
    known = counted.select("gram", number[F.col("lang")].alias("k"), (F.col("n") * frequency[F.col("lang")]).alias("p"))
    highest = known.groupBy("gram").agg(F.collect_list(F.struct("k", "p")).alias("all"), F.max("p").alias("top"))  # an entry per language
    typical = highest.select("gram", F.explode(F.filter("all", lambda x: (x["p"] >= LEAST) & (x["p"] >= SHARE * F.col("top")))).alias("x"))
    typical = typical.groupBy("gram").agg(F.collect_set("x.k").alias("k"))
    found = typical.toArrow().to_pydict()  # at most 1 / LEAST grams of each language
    kept, member = np.array(found["gram"], np.int64), found["k"]
    flat = np.array([k for ks in member for k in ks], np.int64)
    repeated = np.repeat(kept, [len(ks) for ks in member])
    fullest = int(np.bincount(flat, minlength=1).max()) if len(flat) else 1
    size = 1 << max(10, (ROWS_PER_GRAM * fullest - 1).bit_length())
    masks = np.zeros((-(-len(languages) // _WORD), size), np.uint64)
    for slots in _slots(repeated, size):
        np.bitwise_or.at(masks, (flat // _WORD, slots.astype(np.int64)), np.uint64(1) << (flat % _WORD).astype(np.uint64))
    fill = np.array([((masks[k // _WORD] >> np.uint64(k % _WORD)) & np.uint64(1)).mean() for k in range(len(languages))])
    if len(languages) <= 8:
        masks = masks.astype(np.uint8)
    return Model(languages, masks, fill**HASHES, max(languages, key=lambda lang: (sizes[lang], lang)))


def shares(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Corrected popcount by text and language, and the number of grams by text."""
    found, owner = grams(texts)
    total = np.bincount(owner, minlength=len(texts))
    counts = np.zeros((len(texts), len(model.languages)))
    starts = np.searchsorted(owner, np.flatnonzero(total))
    if len(found):
        slots = [s.astype(np.int64) for s in _slots(found, model.masks.shape[1])]
        for word, table in enumerate(model.masks):
            held = table[slots[0]]
            for more in slots[1:]:
                held &= table[more]
            for k in range(word * _WORD, min(len(model.languages), (word + 1) * _WORD)):
                bits = (held >> held.dtype.type(k % _WORD)) & held.dtype.type(1)
                counts[total > 0, k] = np.add.reduceat(bits, starts, dtype=np.int64)
    corrected = (counts - total[:, None] * model.false_rate) / (1 - np.minimum(model.false_rate, 0.999))
    return np.clip(corrected, 0, None), total


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text, more...) become (doc_id, more..., lang_pred, score)."""
    for batch in batches:
        for part in _slices(batch):
            named, score = _decide([r[0] or b"" for r in rows(iter([part.select(["text"])]))], model)
            kept = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(named, pa.string()), pa.array(score, pa.float64())], [*kept.schema.names, "lang_pred", "score"])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy()
    first = total = 0
    for k, size in enumerate(sizes):
        if k > first and total + size > _BLOCK_BYTES:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size
    if len(sizes) > first:
        yield batch.slice(first)


def _decide(texts: list[bytes], model: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    letters = [bool(_LETTER.search(text.decode(errors="replace"))) for text in texts]
    named, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model.languages:
        value, total = shares(texts, model)
        for k, best in enumerate(value.argmax(axis=1)):
            if letters[k]:
                sure = value[k, best] > 0
                named[k] = model.languages[best] if sure else model.default
                score[k] = float(value[k, best] / value[k].sum()) if sure else 0.0
    return named, score


def crc32(number: Column) -> Column:
    return F.crc32(number.cast("string").cast("binary"))


def identify(documents: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred and score, a row for each row.

    ``learn_from`` tells the labelled rows to learn from. Null texts and texts without a letter are ``und``
    with score 0. A text whose grams are all unknown gets the most frequent language with score 0; without
    any labelled row all are ``und``. Bytes that are no UTF-8 are no letters. Ties go to the language that sorts first. Of other columns those named
    in ``carry`` are returned too.
    """
    carry = carry or []
    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"), learn_from.alias("use"),
        *carried(documents, carry),
    )
    model = fit(source.filter("use").select("lang", "text"))
    along = [f"_carry_{k}" for k in range(len(carry))]
    texts = source.select("doc_id", F.col("text").cast("binary").alias("text"), *along)
    schema = f"doc_id long{carry_schema(documents, carry)}, lang_pred string, score double"
    return texts.mapInArrow(partial(_predict, model=model), schema).select("doc_id", "lang_pred", "score", *uncarried(carry))


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: rows whose crc32 of the id leaves 2 modulo 4 are held out, rows
    without an id teach nothing."""
    held_out = crc32(F.col("doc_id")) % 4 == 2
    found = identify(documents, F.coalesce(~held_out, F.lit(False)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
