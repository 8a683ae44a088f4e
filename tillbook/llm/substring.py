"""Substring dedup: documents are factored against everything that starts earlier in the corpus.

A document is parsed into reference blocks. Every window of ``WINDOW`` words has a canonical seed, the
smallest hash of its runs of ``SEED`` words; consecutive windows with the same seed occurrence form a
block, and equal passages are cut into equal blocks wherever they lie, but for the two at their ends. The
first occurrence of a block is indexed under its seed; a later one is a factor that copies it whole. At the
boundaries of factors, where blocks share a seed but not their whole extent, the single windows are
looked up instead. The union of copied windows is what goes, so the result is exact.

One row per block is shuffled, about one for 8 words, and windows only where seeds repeat in different
blocks. Tasks resolve what repeats inside a chunk of text before they send it, so a passage that a third
of all documents share arrives as one row per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import carried, carry_schema, grouped, merged, mix, rows, runs, save, uncarried, word_hashes

WINDOW = 20
SEED = 5
_SPAN = WINDOW - SEED + 1  # seeds in a window
_BLOCK_BYTES = 1 << 21
_LAST_ID = (1 << 63) - 1  # rows without an id count as later than all others
_BASE = 0xC2B2AE3D27D4EB4F
_COPY, _LOOK_UP = 0, 1
_KEYED = "kind int, s long, e long, doc_id long, version int, start long, n int"


def _sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums that give the hash of any run of words, and what shifts it to a common origin."""
    n = len(hashes)
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]), dtype=np.uint64)
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, pow(_BASE, -1, 2**64), np.uint64)]), dtype=np.uint64)
    return np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[:n], dtype=np.uint64)]), down


def _stretch(sums: np.ndarray, down: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix((sums[last] - sums[first]) * down[first])


def _canonical(seeds: np.ndarray) -> np.ndarray:
    """For each window the place of its smallest seed, the leftmost of equal ones."""
    at = np.arange(len(seeds))
    width = 1
    while width < _SPAN:
        step = min(width, _SPAN - width)
        left, right = at[:-step], at[step:]
        at = np.where(seeds[left] <= seeds[right], left, right)
        width += step
    return at


def blocks(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """seed hash, content hash, document number, first window and number of windows of each block.

    ``hashes`` are the words of several documents in a row, ``counts`` says how many each has. First windows
    count from the start of ``hashes``.
    """
    ends = np.cumsum(counts)
    if len(hashes) < WINDOW:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    seeds = runs(hashes, SEED)
    at = _canonical(seeds)  # a window for each position that has WINDOW words after it
    owner = np.repeat(np.arange(len(counts)), counts)[: len(at)]
    inside = np.arange(len(at)) + WINDOW <= ends[owner]
    first = inside & np.concatenate([[True], (at[1:] != at[:-1]) | ~inside[:-1] | (owner[1:] != owner[:-1])])
    start = np.flatnonzero(first)
    stop = np.minimum(np.append(start[1:], len(at)), ends[owner[start]] - WINDOW + 1)
    n = stop - start
    sums, down = _sums(hashes)
    content = _stretch(sums, down, start, stop + WINDOW - 1)
    shape = (n << 8 | (at[start] - start)).astype(np.uint64)
    return seeds[at[start]], mix(content ^ mix(shape)), owner[start], start, n


def _not_later(new: np.ndarray, doc_id: np.ndarray, start: np.ndarray, first: tuple[int, int] = (0, 0)) -> np.ndarray:
    """Of sorted rows, those at the place of the first row of their group; repeated rows share a place.

    ``new`` marks the first rows; ``first`` is the place of the group that began before these rows.
    """
    at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
    return (doc_id == np.where(at < 0, first[0], doc_id[at])) & (start == np.where(at < 0, first[1], start[at]))


def _first_of(keys: list[np.ndarray], doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether a row comes first, by document and place, among those with equal keys."""
    order = np.lexsort((start, doc_id, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), bool)
    out[order] = _not_later(new, doc_id[order], start[order])
    return out


def _batch(kind, s, e, doc_id, version, start, n) -> pa.RecordBatch:
    columns = [
        np.asarray(kind, np.int32), s.view(np.int64), e.view(np.int64), doc_id, version.astype(np.int32),
        start.astype(np.int64), n.astype(np.int32),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "s", "e", "doc_id", "version", "start", "n"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each document; those that copy an earlier one of the same chunk are marked already."""
    for part in grouped(rows(batches), lambda r: len(r[2] or b""), _BLOCK_BYTES):
        hashes, counts = word_hashes([r[2] or b"" for r in part])
        s, e, owner, start, n = blocks(hashes, counts)
        if not len(s):
            continue
        doc_id, version = np.array([r[0] for r in part], np.int64)[owner], np.array([r[1] for r in part], np.int64)[owner]
        start = start - (np.cumsum(counts) - counts)[owner]
        fresh = _first_of([s, e], doc_id, start)
        yield _batch(np.where(fresh, _LOOK_UP, _COPY), s, e, doc_id, version, start, n)


def _resolve(batches: Iterator[pa.RecordBatch], alone: bool) -> Iterator[pa.RecordBatch]:
    """From rows sorted by seed, content and place: copies, and first blocks whose seed has other blocks too.

    ``alone`` leaves out what is first. Between batches only the last row and a block that is the first of
    its seed are held.
    """
    last: tuple | None = None  # (s, e) of the row before
    first = (0, 0)  # place of the first row with that (s, e)
    held: tuple | None = None  # the first block of the current seed while it has no other
    for batch in batches:
        kind, s, e, doc_id, version, start, n = (column.to_numpy() for column in batch.columns)
        looked = kind == _LOOK_UP
        index = np.flatnonzero(looked)
        if len(index):
            ks, ke = s[index], e[index]
            new_seed = np.concatenate([[last is None or last[0] != ks[0]], ks[1:] != ks[:-1]])
            new = new_seed | np.concatenate([[last is None or last[1] != ke[0]], ke[1:] != ke[:-1]])
            early = _not_later(new, doc_id[index], start[index], first)
            last = (int(ks[-1]), int(ke[-1]))
            if new.any():
                k = index[np.flatnonzero(new)[-1]]
                first = (int(doc_id[k]), int(start[k]))
        else:
            new = new_seed = early = np.empty(0, bool)
        copies = np.concatenate([np.flatnonzero(~looked), index[~early]])
        out = [(np.full(len(copies), _COPY), copies)]
        if not alone and len(index):
            group = np.cumsum(new_seed)  # 0: the seed that the batch before ended with
            firsts = np.bincount(group[new], minlength=group[-1] + 1)
            if held is not None and firsts[0]:
                yield _batch([_LOOK_UP], *(np.array([x], t) for x, t in zip(held, (np.int64, np.int64, np.int64, np.int64, np.int64, np.int64))))
                held = None
            several = firsts[group] > 1
            several |= (group == 0) & (not new_seed[0])  # an earlier block of this seed was sent or is being sent
            sent = index[new & several]
            out.append((np.full(len(sent), _LOOK_UP), sent))
            if group[-1] > 0:
                held = None
            lone = np.flatnonzero(new & ~several & (group == group[-1]))
            if len(lone):
                k = index[lone[-1]]
                held = tuple(int(x[k]) for x in (s, e, doc_id, version, start, n))
        for kinds, rows_of in out:
            if len(rows_of):
                yield _batch(kinds, s[rows_of], e[rows_of], doc_id[rows_of], version[rows_of], start[rows_of], n[rows_of])


def _resolve_blocks(batches):
    return _resolve(batches, alone=False)


def _resolve_windows(batches):
    return _resolve(batches, alone=True)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single windows of the blocks that are asked for, resolved inside the chunk."""
    for part in grouped(rows(batches), lambda r: len(r[2] or b""), _BLOCK_BYTES):
        hashes, counts = word_hashes([r[2] or b"" for r in part])
        sums, down = _sums(hashes)
        before = np.cumsum(counts) - counts
        asked = [(x["s"], before[k] + x["start"], x["n"], k) for k, r in enumerate(part) for x in r[3]]
        s, start, n, owner = (np.array(c, np.int64) for c in zip(*asked))
        each = np.repeat(np.arange(len(s)), n)
        at = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        e = _stretch(sums, down, at, at + WINDOW) * np.uint64(0x9E3779B97F4A7C15)
        owner = owner[each]
        doc_id, version = np.array([r[0] for r in part], np.int64)[owner], np.array([r[1] for r in part], np.int64)[owner]
        at = at - before[owner]
        fresh = _first_of([s[each], e], doc_id, at)
        yield _batch(np.where(fresh, _LOOK_UP, _COPY), s[each], e, doc_id, version, at, np.ones(len(at)))


def _strip(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text, spans, more...) become (doc_id, more..., n_words, n_removed, kept or its digest)."""
    for batch in batches:
        counts, removed, kept = [], [], []
        for text, spans in rows(iter([batch.select(["text", "spans"])])):
            tokens = (text or b"").split()  # at space and 0x09-0x0D
            gone = 0
            left = tokens
            if spans:
                change = np.zeros(len(tokens) + 1, np.int32)
                starts = np.fromiter((x["start"] for x in spans), np.int64, len(spans))
                np.add.at(change, starts, 1)
                np.add.at(change, starts + np.fromiter((x["n"] for x in spans), np.int64, len(spans)) + WINDOW - 1, -1)
                out = np.cumsum(change[:-1]) > 0
                gone = int(out.sum())
                left = [token for token, drop in zip(tokens, out.tolist()) if not drop]
            counts.append(len(tokens))
            removed.append(gone)
            joined = b" ".join(left)
            kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
        along = batch.drop_columns(["text", "spans"])
        yield pa.RecordBatch.from_arrays(
            [*along.columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            [*along.schema.names, "n_words", "n_removed", "kept"],
        )


def _version(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _spans(source: DataFrame) -> DataFrame:
    """Copied stretches (start, n windows) by row of ``source``."""
    order = ["s", "e", "doc_id", "start"]
    indexed = source.select("order_id", "version", "text").mapInArrow(_index, _KEYED)
    spread = F.xxhash64("doc_id", "start")  # copies need no others; a passage of many documents is no hot key
    found = save(merged(indexed.repartition(F.when(F.col("kind") == _COPY, spread).otherwise(F.col("s"))).sortWithinPartitions(*order).mapInArrow(_resolve_blocks, _KEYED).drop("e")), "blocks")
    asked = found.filter(F.col("kind") == _LOOK_UP).groupBy(F.col("doc_id").alias("order_id"), "version")
    asked = asked.agg(F.collect_list(F.struct("s", "start", "n")).alias("asked"))  # at most a row per block of a document
    single = source.join(asked, ["order_id", "version"]).select("order_id", "version", "text", "asked").mapInArrow(_windows, _KEYED)
    single = single.repartition(F.when(F.col("kind") == _COPY, spread).otherwise(F.xxhash64("s", "e"))).sortWithinPartitions(*order).mapInArrow(_resolve_windows, _KEYED).drop("e")
    copied = found.filter(F.col("kind") == _COPY).unionByName(single).select("doc_id", "version", "start", "n")
    return copied.groupBy(F.col("doc_id").alias("order_id"), "version").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def strip_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the remaining words joined by one space), a row for each row.

    A word goes if a window of 20 words that covers it also starts earlier: in a smaller doc_id or before in
    the same one. Null texts have no words. Rows without an id count as later than all others; rows that
    share an id are versions of one document. With ``digest``, kept is the SHA-256 of the words instead. Of
    other columns those named in ``carry`` are returned too.
    """
    carry = carry or []
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *carried(documents, carry))
    source = source.withColumn("version", F.coalesce(_version(F.col("text")), F.lit(0)))
    source = source.withColumn("order_id", F.coalesce("doc_id", F.lit(_LAST_ID)))
    found = source.join(_spans(source), ["order_id", "version"], "left").drop("order_id", "version")
    schema = f"doc_id long{carry_schema(documents, carry)}, n_words long, n_removed long, kept string"
    out = found.select("doc_id", "text", "spans", *(f"_carry_{k}" for k in range(len(carry)))).mapInArrow(partial(_strip, digest=digest), schema)
    return out.select("doc_id", "n_words", "n_removed", "kept", *uncarried(carry))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return strip_repeats(documents, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE = """
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), placed AS (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM split WHERE len(w) >= 20
), windows AS (
    SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS content FROM placed
), ranked AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY content ORDER BY doc_id, p) AS k FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS p FROM ranked WHERE k > 1
), each AS (
    SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM split
), kept AS (
    SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) AS t, count(*) AS n FROM each e
    LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p WHERE g.p IS NULL GROUP BY e.doc_id
)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""
