"""Suffix-array dedup: maximal repeats from the interval tree of an enhanced suffix array.

Only bytes that repeat need to be in the array. Every string of ``WINDOW`` bytes has a canonical seed, the
smallest hash of its runs of ``SEED`` bytes, so equal strings share it wherever they lie. Consecutive windows with
the same occurrence of a seed form a block; blocks of equal text are one class, whose first document stands for
it, and the others repeat it whole. What remains are seeds with several classes, most of which meet by chance in a
large corpus: of a common window 17 bytes lie to the left of the seed or to its right, so classes that agree on neither
side with another one are left out. The texts of the other blocks meet by seed, their suffixes are sorted into a suffix array, and a scan with a stack over its common prefixes
yields the intervals: repeats of ``WINDOW`` bytes and more with all their occurrences. An interval whose
occurrences are all preceded by the same byte is part of a longer repeat and is not reported. An occurrence
is a copy in the deepest interval that has a smaller document; repeats of that document's own go up the tree.

A row per block is shuffled, about one for 17 bytes, and texts of about 70 bytes where seeds have several
classes. Tasks resolve what repeats inside a chunk before they send it. A seed with very many classes, as at the
edges of a line that many documents share, is dealt by whole windows instead, one per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.common import carried, carry_schema, grouped, merged, mix, rows, save, uncarried

WINDOW = 50
SEED = 16
MANY = 4_096  # classes of a seed from which its blocks are dealt by window
_SPAN = WINDOW - SEED + 1  # seeds in a window
_WIDEST = WINDOW + _SPAN - 1  # bytes of the longest block
_CHUNK = 1 << 19
_PIECES = 1 << 20  # bytes of blocks whose suffixes are sorted together
_LAST_ID = (1 << 63) - 1  # rows without an id count as later than all others
_BASE = 0x9E3779B97F4A7C55
_COPY, _ASK = 0, 1
_SIDE = -(-(WINDOW - SEED) // 2)  # bytes that a window has beside its seed at least, on one of its sides
_NO_VERSION = 0
_FIELDS = ["kind", "s", "e", "doc_id", "version", "start", "n"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
_KEYED = "kind int, s long, e long, doc_id long, version int, start long, n int"
_DEALT = "s long, e long, doc_id long, place long, version long"  # as it is shuffled and sorted: place is start, sides, n and kind
_PIECE = "kind int, key long, doc_id long, version int, start long, n int, piece binary"
_SPAN_ROW = "doc_id long, version int, start long, n int"
GROUP = "repeat long, length int, doc_id long, start long"


def run_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` bytes, put together from runs of powers of two."""
    if len(data) < width:
        return np.empty(0, np.uint64)
    part, size, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if width & size:
            n = len(data) - width + 1
            piece = part[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(pow(_BASE, size, 2**64)) + piece
            done += size
        if done == width:
            return mix(out)
        part = part[:-size] * np.uint64(pow(_BASE, size, 2**64)) + part[size:]
        size *= 2


def _smallest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window its smallest seed, the place of that, and whether it has that seed in several places.

    Seeds lose their last six bits to their place, which then is the lowest part of what is compared. Of equal
    seeds any may be taken: equal windows have the same seed, if not the same block.
    """
    at, low = np.arange(len(values), dtype=np.uint64), np.uint64(63)
    least, last, width = (values & ~low) | (at & low), (values & ~low) | (~at & low), 1
    while width < _SPAN:
        step = min(width, _SPAN - width)
        least, last = np.minimum(least[:-step], least[step:]), np.minimum(last[:-step], last[step:])
        width += step
    at = at[: len(least)]
    return least & ~low, (at + ((least - at) & low)).astype(np.int64), (least ^ last) & low != low


def _sides(seeds: np.ndarray, place: np.ndarray, start: np.ndarray, n: np.ndarray, tied: np.ndarray) -> np.ndarray:
    """Eight bits for the bytes to the left of the seed, eight for those to the right, and whether a window has its
    seed twice, as then equal windows may lie otherwise in their blocks. Zeros where no window of the block
    reaches as far; else the bits depend on the text of the block only."""
    def bits(first: np.ndarray, reached: np.ndarray) -> np.ndarray:
        first = np.where(reached, first, 0)  # the bytes are covered by two runs as long as a seed
        return np.where(reached, (mix(seeds[first] ^ mix(seeds[first + _SIDE - SEED])) % np.uint64(255)).astype(np.int64) + 1, 0)

    left, right = bits(place - _SIDE, place - start >= _SIDE), bits(place + SEED, place - start - n + 1 <= WINDOW - SEED - _SIDE)
    return left << 9 | right << 1 | tied


def blocks(data: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """seed, class, document number, first window, number of windows and sides of each block.

    ``data`` are the bytes of several documents in a row, ``counts`` says how many each has. First windows count
    from the start of ``data``.
    """
    if len(data) < WINDOW:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    seeds, whole = run_hashes(data, SEED), run_hashes(data, WINDOW)
    seed, place, twice = _smallest(seeds)
    ends = np.cumsum(counts)
    inside = np.ones(len(place), bool)  # whether a window ends in the document in which it starts
    for begin, end in zip((ends - counts).tolist(), ends.tolist()):
        inside[max(begin, end - WINDOW + 1) : end] = False
    first = inside.copy()
    first[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    start = np.flatnonzero(first)
    owner = np.searchsorted(ends, start, side="right")
    stop = np.minimum(np.append(start[1:], len(place)), ends[owner] - WINDOW + 1)
    n = stop - start  # less than WINDOW, so the first and the last window cover the block
    shape = (n << 8 | (place[start] - start)).astype(np.uint64)
    sides = _sides(seeds, place[start], start, n, np.logical_or.reduceat(twice, start) if len(start) else np.empty(0, bool))
    return seed[start], mix(whole[start] ^ mix(whole[stop - 1] ^ mix(shape))), owner, start, n, sides


def _batch(kind, s, e, doc_id, version, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(t.to_pandas_dtype(), copy=False), t) for c, t in zip((kind, s.view(np.int64), e.view(np.int64), doc_id, version, start, n), _TYPES)], _FIELDS)


def _narrow(batch: pa.RecordBatch, sides: np.ndarray | int = 0) -> pa.RecordBatch:
    """A row of _DEALT for each of _KEYED: 48 bytes in a sort instead of 64. n is less than WINDOW, so it has six bits."""
    kind, start, n = (batch[name].to_numpy().astype(np.int64) for name in ("kind", "start", "n"))
    place = pa.array(start << 24 | sides << 7 | n << 1 | kind)
    return pa.RecordBatch.from_arrays([batch["s"], batch["e"], batch["doc_id"], place, batch["version"].cast(pa.int64())], ["s", "e", "doc_id", "place", "version"])


def _wide(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The columns of _KEYED from a batch of _DEALT."""
    s, e, doc_id, place, version = (column.to_numpy() for column in batch.columns)
    return [place & 1, s, e, doc_id, version, place >> 24, place >> 1 & 63]


def _later(keys: list[np.ndarray], doc_id: np.ndarray) -> np.ndarray:
    """Whether a row has equal keys with one of a smaller document."""
    order = np.lexsort((doc_id, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    out = np.empty(len(order), bool)
    out[order] = doc_id[order] > doc_id[order][first]
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each document; those that an earlier document of the same chunk has are copies already."""
    for part in grouped(rows(batches), lambda r: len(r[2] or b""), _CHUNK):
        texts = [r[2] or b"" for r in part]
        counts = np.array([len(text) for text in texts])
        s, e, owner, start, n, sides = blocks(np.frombuffer(b"".join(texts), np.uint8), counts)
        if len(s):
            doc_id, version = np.array([r[0] for r in part], np.int64)[owner], np.array([r[1] for r in part], np.int64)[owner]
            yield _narrow(_batch(np.where(_later([s, e], doc_id), _COPY, _ASK), s, e, doc_id, version, start - (np.cumsum(counts) - counts)[owner], n), sides)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by seed, class and document: copies, and the first document's blocks of classes that may have
    a window in common with another one. Between batches the rows of a seed are held, MANY at most: those of a seed
    that has more pass as they are."""
    held, passing = None, None
    for batch, sides in _several(batches):
        if sides is None:
            yield batch
            continue
        if passing is not None:
            other = np.flatnonzero(batch["s"].to_numpy() != passing)
            passed = int(other[0]) if len(other) else batch.num_rows
            yield batch.slice(0, passed)
            batch, sides = batch.slice(passed), sides[passed:]
            if not batch.num_rows:
                continue
            passing = None
        if held is not None:
            batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
            sides = np.concatenate([held[1], sides])
        s = batch["s"].to_numpy()
        other = np.flatnonzero(s != s[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield _meeting(batch.slice(0, cut), sides[:cut])
        held = batch.slice(cut), sides[cut:]
        if len(held[1]) > MANY:
            yield held[0]
            held, passing = None, s[-1]
    if held is not None:
        yield _meeting(*held)


def _meeting(batch: pa.RecordBatch, sides: np.ndarray) -> pa.RecordBatch:
    """Of the blocks of whole seeds those that agree with another class on a side of the seed, or have it twice."""
    s, e, kept = batch["s"].to_numpy(), batch["e"].to_numpy(), (sides & 1).astype(bool)
    for side in (sides >> 9, sides >> 1 & 255):
        at = np.flatnonzero(side)
        order = at[np.lexsort((e[at], side[at], s[at]))]
        new = np.ones(len(order), bool)
        new[1:] = (s[order][1:] != s[order][:-1]) | (side[order][1:] != side[order][:-1])
        first = new.copy()
        first[1:] |= e[order][1:] != e[order][:-1]
        group = np.cumsum(new) - 1
        kept[order] |= (np.bincount(group[first]) > 1)[group]
    return batch.filter(pa.array(kept))


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None]]:
    """From rows sorted by seed, class and document: copies, and with their sides the first document's blocks of seeds
    with several classes. Between batches only the last row and the first document's blocks of a seed with one class so far are held.
    """
    last, first_doc, several, held = None, 0, False, []
    for batch in batches:
        columns = _wide(batch)
        waiting = columns[0] == _ASK
        if (~waiting).any():
            yield _batch(*(c[~waiting] for c in columns)), None
        if not waiting.any():
            continue
        kind, s, e, doc_id, version, start, n = (c[waiting] for c in columns)
        sides = batch["place"].to_numpy()[waiting] >> 7 & 0x1FFFF
        new_seed = np.concatenate([[last is None or last[0] != s[0]], s[1:] != s[:-1]])
        new = new_seed | np.concatenate([[last is None or last[1] != e[0]], e[1:] != e[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        early = doc_id == np.where(at < 0, first_doc, doc_id[at])
        seed = np.cumsum(new_seed)  # 0: the seed that the batch before ended with
        many = np.bincount(seed[new], minlength=seed[-1] + 1) > 1
        many[0] = several or (bool(held) and bool((new & (seed == 0)).any()))
        if many[0] and held:
            yield from held
            held = []
        out = early & many[seed]
        if (~early).any():
            yield _batch(np.full((~early).sum(), _COPY), *(c[~early] for c in (s, e, doc_id, version, start, n))), None
        if out.any():
            yield _batch(kind[out], *(c[out] for c in (s, e, doc_id, version, start, n))), sides[out]
        if seed[-1] > 0:
            held = []
        several = bool(many[-1]) if seed[-1] > 0 else bool(many[0])
        alone = early & (seed == seed[-1])
        if not several and alone.any():
            held.append((_batch(kind[alone], *(c[alone] for c in (s, e, doc_id, version, start, n))), sides[alone]))
        last, first_doc = (s[-1], e[-1]), doc_id[at[-1]] if at[-1] >= 0 else first_doc


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the blocks that are asked for; of seeds with many classes single windows, resolved in the chunk."""
    names, types = [f.split()[0] for f in _PIECE.split(", ")], [*(_TYPES[k] for k in (0, 1, 3, 4, 5, 6)), pa.binary()]
    for part in grouped(rows(batches), lambda r: len(r[2]), _CHUNK):
        out, single = [], []
        for doc_id, version, text, asked in part:
            for x in asked:
                if x["many"]:
                    single += [(doc_id, version, at, text[at : at + WINDOW]) for at in range(x["start"], x["start"] + x["n"])]
                else:
                    out.append((_ASK, x["s"], doc_id, version, x["start"], x["n"], text[x["start"] : x["start"] + x["n"] + WINDOW - 1]))
        if single:
            content = run_hashes(np.frombuffer(b"".join(x[3] for x in single), np.uint8), WINDOW)[::WINDOW]
            later = _later([content], np.array([x[0] for x in single], np.int64))
            for (doc_id, version, at, text), key, copied in zip(single, content.view(np.int64).tolist(), later.tolist()):
                out.append((_COPY, key, doc_id, version, at, 1, None) if copied else (_ASK, key, doc_id, version, at, 1, text))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _words(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The bytes of each suffix as numbers of eight, the first most significant; zeros behind its end."""
    part = data.astype(np.uint64)
    for shift in (1, 2, 4):
        part = (part[:-shift] << np.uint64(8 * shift)) | part[shift:]
    out = []
    for first in range(0, _WIDEST, 8):
        missing = np.clip(first + 8 - size, 0, 8).astype(np.uint64) * np.uint64(8)
        word = part[at + first] >> np.minimum(missing, np.uint64(63))
        out.append(np.where(missing == 64, np.uint64(0), word << np.minimum(missing, np.uint64(63))))
    return out


def _common(words: list[np.ndarray]) -> np.ndarray:
    """Number of leading bytes that each suffix shares with the one before."""
    common, equal = np.zeros(max(0, len(words[0]) - 1), np.int64), np.ones(max(0, len(words[0]) - 1), bool)
    for word in words:
        differ = word[1:] ^ word[:-1]
        for shift in range(56, -1, -8):
            equal &= (differ >> np.uint64(shift)) == 0
            common += equal
    return common


class SuffixArray:
    """Suffixes of pieces that share WINDOW bytes with another document's, in order, with their common prefixes."""

    def __init__(self, pieces: list[bytes], n: np.ndarray, doc_id: np.ndarray):
        size = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces) + bytes(_WIDEST + 16), np.uint8)
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(pieces)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = begin[owner] + offset
        # Only strings of more than one document can be copies.
        content = run_hashes(data, WINDOW)[at]
        order = np.argsort(content, kind="stable")
        content, docs = content[order], doc_id[owner][order]
        first = np.flatnonzero(np.concatenate([[True], content[1:] != content[:-1]]))
        shared = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
        size_of = np.diff(np.append(first, len(order)))
        keep, group = order[np.repeat(shared, size_of)], np.repeat(np.arange(len(first))[shared], size_of[shared])
        self.owner, self.offset = owner[keep], offset[keep]
        self.size = size[self.owner] - self.offset
        words = _words(data, at[keep], self.size)
        # Suffixes are together by their first WINDOW bytes already; what follows puts each group in order.
        order = np.lexsort((self.size, *reversed(words[WINDOW // 8 :]), group))
        self.owner, self.offset, self.size = self.owner[order], self.offset[order], self.size[order]
        common = _common([word[order] for word in words])
        self.common = np.minimum(common, np.minimum(self.size[1:], self.size[:-1]))  # with the suffix before
        before = data[np.maximum(at[keep][order] - 1, 0)].astype(np.int64)
        self.before = np.where(self.offset > 0, before, -1)  # -1: the piece begins here, whatever precedes it
        self.doc_id = doc_id[self.owner]

    def intervals(self) -> Iterator[tuple[int, int, int, bool, int, list[int]]]:
        """(length, first, last, whether bytes to the left differ, least document, its members' places) by a scan with a stack.

        Of the members those are given that no interval inside has resolved; all but those of the least
        document are resolved by this one.
        """
        doc_id, before, common = self.doc_id.tolist(), self.before.tolist(), [*self.common.tolist(), 0]
        stack: list[list] = []  # length, first, least document, the byte to the left or -1 if bytes differ, open members

        def merge(into: list, least: int, left: int, members: list[int]) -> None:
            into[2] = min(into[2], least)
            into[3] = left if into[3] == left else -1
            if len(into[4]) < len(members):
                into[4], members = members, into[4]
            into[4].extend(members)

        for place, length in enumerate(common):
            least, left, members, first = doc_id[place], before[place], [place], place
            while stack and stack[-1][0] > length:
                top = stack.pop()
                merge(top, least, left, members)
                yield top[0], top[1], place, top[3] == -1, top[2], top[4]
                least, left, first = top[2], top[3], top[1]
                members = [m for m in top[4] if doc_id[m] == least]
            if length < WINDOW:
                continue
            if stack and stack[-1][0] == length:
                merge(stack[-1], least, left, members)
            else:
                stack.append([length, first, least, left, members])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Columns of pieces with whole keys, about _PIECES bytes together, from rows sorted by key."""
    held, total = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = batch["key"].to_numpy()
        if held and total > _PIECES:
            cut = int(np.argmax(np.append(keys != held[-1]["key"][-1].as_py(), True)))
            if cut < len(keys) or len(keys) == 0:
                yield pa.concat_tables([*held, table.slice(0, cut)])
                held, total, table = [], 0, table.slice(cut)
        held.append(table)
        total += table["piece"].nbytes
    if held:
        yield pa.concat_tables(held)


def _copies(batches: Iterator[pa.RecordBatch], groups: bool) -> Iterator[pa.RecordBatch]:
    """Copied stretches of _SPAN_ROW, or all occurrences of the maximal repeats."""
    for table in _parts(batches):
        if not table.num_rows:
            continue
        doc_id, version, start, n = (table[name].to_numpy() for name in ("doc_id", "version", "start", "n"))
        array = SuffixArray(table["piece"].to_pylist(), n.astype(np.int64), doc_id)
        if not len(array.owner):
            continue
        places, lengths, repeats = [], [], []
        for length, first, last, differ, least, members in array.intervals():
            if not differ:
                continue
            found = range(first, last + 1) if groups else [m for m in members if array.doc_id[m] != least]
            places += found
            lengths += [length] * len(found)
            repeats += [first] * len(found)
        at, lengths = np.array(places, np.int64), np.array(lengths, np.int64)
        owner = array.owner[at]
        begin = start[owner] + array.offset[at]
        if groups:
            texts = table["piece"].to_pylist()
            names = [int.from_bytes(hashlib.blake2b(texts[array.owner[f]][array.offset[f] : array.offset[f] + k], digest_size=8).digest(), "little", signed=True) for f, k in zip(repeats, lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(lengths, pa.int32()), pa.array(doc_id[owner]), pa.array(begin)], ["repeat", "length", "doc_id", "start"])
        else:
            yield pa.RecordBatch.from_arrays([pa.array(doc_id[owner]), pa.array(version[owner]), pa.array(begin), pa.array(lengths - WINDOW + 1, pa.int32())], ["doc_id", "version", "start", "n"])


def _source(documents: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *carried(documents, carry))
    source = source.withColumn("order_id", F.coalesce("doc_id", F.lit(_LAST_ID)))
    # Only rows that share an id are told apart by their texts: a hash is four bytes in each block that is shuffled.
    if source.groupBy("order_id").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        return source.withColumn("version", F.lit(_NO_VERSION))
    return source.withColumn("version", F.coalesce(F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"), F.lit(_NO_VERSION)))


def _found(source: DataFrame) -> DataFrame:
    """Blocks that are copies, and those whose texts have to be compared."""
    indexed = source.select("order_id", "version", "text").mapInArrow(_index, _DEALT)
    spread = F.xxhash64("doc_id", "place")  # copies need no others
    dealt = indexed.repartition(F.when(F.col("place").bitwiseAND(F.lit(1)) == _COPY, spread).otherwise(F.col("s")))
    return save(merged(dealt.sortWithinPartitions("s", "e", "doc_id").mapInArrow(_classes, _KEYED).drop("e")), "repeat-blocks")


def _compared(source: DataFrame, found: DataFrame) -> DataFrame:
    """The pieces to be compared, and what the tasks that cut them have resolved."""
    asked = found.filter(F.col("kind") == _ASK).select("s", "doc_id", "version", "start", "n")
    many = asked.groupBy("s").agg(F.count("*").alias("classes")).filter(F.col("classes") >= MANY).select("s", F.lit(True).alias("many"))
    asked = asked.join(many, "s", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    asked = asked.groupBy(F.col("doc_id").alias("order_id"), "version").agg(F.collect_list(F.struct("s", "start", "n", "many")).alias("asked"))
    texts = source.select("order_id", "version", "text")  # at most a row per block of a document meets its text
    return save(merged(texts.join(asked, ["order_id", "version"]).select("order_id", "version", "text", "asked").mapInArrow(_pieces, _PIECE)), "repeat-pieces")


def _sorted(pieces: DataFrame) -> DataFrame:
    return pieces.filter(F.col("kind") == _ASK).drop("kind").repartition("key").sortWithinPartitions("key")


def maximal_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """repeat, length, doc_id, start: all occurrences of each maximal repeat of WINDOW bytes and more among block classes.

    Repeats are cut at the ends of blocks, at most 84 bytes; of blocks with equal texts the first document's
    stand for all. ``repeat`` is a hash of the text. Nulls, repeated rows and other columns as in ``strip_repeats``.
    """
    source = _source(documents, id_col, text_col, [])
    pieces = _compared(source, _found(source))
    found = _sorted(pieces).mapInArrow(partial(_copies, groups=True), GROUP)
    return found.withColumn("doc_id", F.when(F.col("doc_id") != _LAST_ID, F.col("doc_id")))


def _spans(source: DataFrame) -> DataFrame:
    found = _found(source)
    pieces = _compared(source, found)
    # Written, so that the pieces as they were sorted are gone before texts are shuffled again.
    compared = save(merged(_sorted(pieces).mapInArrow(partial(_copies, groups=False), _SPAN_ROW)), "repeat-spans")
    columns = ["doc_id", "version", "start", "n"]
    copied = found.filter(F.col("kind") == _COPY).select(columns).unionByName(pieces.filter(F.col("kind") == _COPY).select(columns)).unionByName(compared)
    return copied.groupBy(F.col("doc_id").alias("order_id"), "version").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def _strip(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text, spans, more...) become (doc_id, more..., n_bytes, n_removed, n_spans, kept or its digest)."""
    for batch in batches:
        made: list[tuple] = []
        for text, spans in rows(iter([batch.select(["text", "spans"])])):
            text = text or b""
            removed = runs = 0
            kept = text
            if spans:
                change = np.zeros(len(text) + 1, np.int32)
                start = np.fromiter((x["start"] for x in spans), np.int64, len(spans))
                np.add.at(change, start, 1)
                np.add.at(change, start + np.fromiter((x["n"] for x in spans), np.int64, len(spans)) + WINDOW - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            made.append((len(text), removed, runs, hashlib.sha256(kept).hexdigest() if digest else kept))
        along = batch.drop_columns(["text", "spans"])
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*made), types)] if made else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays([*along.columns, *columns], [*along.schema.names, "n_bytes", "n_removed", "n_spans", "kept"])


def strip_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes), a row for each row.

    A byte of the UTF-8 text goes if 50 bytes that cover it also start in a document with a smaller doc_id; what
    remains need not be UTF-8. Null texts have no bytes. Rows without an id count as later than all others; rows
    that share an id are one document, so none of them is removed for another. With ``digest``, kept is the
    SHA-256 of the bytes. Of other columns those named in ``carry`` are returned too. An empty table gives no rows.
    """
    carry = carry or []
    source = _source(documents, id_col, text_col, carry)
    found = source.join(_spans(source), ["order_id", "version"], "left").drop("order_id", "version")
    schema = f"doc_id long{carry_schema(documents, carry)}, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}"
    out = found.select("doc_id", *(f"_carry_{k}" for k in range(len(carry))), "text", "spans").mapInArrow(partial(_strip, digest=digest), schema)
    return merged(out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *uncarried(carry)))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return strip_repeats(documents, digest=True).withColumnRenamed("kept", "kept_sha256")


ORACLE = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
    SELECT doc_id, p, substring(h, 2 * p - 1, 100) AS content FROM (SELECT doc_id, h, unnest(generate_series(1, n - 49)) AS p FROM bytes WHERE n >= 50)
), gone AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY content) AS least FROM windows) WHERE doc_id > least
), runs AS (
    SELECT doc_id, min(p) AS b, max(p) + 49 AS e FROM (
        SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
            SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM gone))
    GROUP BY doc_id, run
), cut AS (
    SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS behind FROM runs
), left_over AS (
    SELECT c.doc_id, count(*) AS n_spans, sum(e - b + 1) AS n_removed, max(e) AS last,
        string_agg(substring(h, 2 * behind + 1, 2 * (b - 1 - behind)), '' ORDER BY b) AS h
    FROM cut c JOIN bytes USING (doc_id) GROUP BY c.doc_id
)
SELECT b.doc_id, CAST(b.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(CASE WHEN l.doc_id IS NULL THEN b.h ELSE l.h || substring(b.h, 2 * last + 1) END)) AS kept_sha256
FROM bytes b LEFT JOIN left_over l ON b.doc_id = l.doc_id
"""
