"""Language model scores by online logistic mixing of bit predictors that know a context.

A token is coded in two parts. The first ``BITS`` bits of its hash are predicted one after the other; each bit
by several predictors that know the bits before it and a context: nothing, the word before, the two words
before, and what this document has said so far. Their predictions are mixed in the logistic domain with
weights that the place of the bit and the experience with its contexts select; a last stage corrects the
mixture by how it has erred at that level of confidence. Weights, corrections and the document's own counts
adapt while a document is read, a block of tokens at a time. The second part, which token of its hash
prefix it is, has the add-one probability of its count there; all unseen tokens of a prefix are one symbol.

The counts behind the fixed contexts come from the whole training part of the corpus, per token and per
pair of a context and a hash prefix that follows it, both without bound. A pair is a number, the prefix below
as many bits of the context's hash as keep contexts apart in a corpus of this size: 8 more than those of its
length in bytes, so about one context in 1,500 shares its number. The keys below a node are one range. Keys are dealt
into ranges that grow in number with the input; each block of documents, a few MB as they were read, tells every range the keys it has
and how often it teaches them, and gets the predictions at the nodes along them, each once and in a byte. Tokens are
counted the same way, by their whole hash; the sizes of the hash prefixes are summed up on the way, and only
they reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from tempfile import SpooledTemporaryFile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.common import grouped, mix, rows, save, word_hashes

BITS = 12
STEP = 32  # tokens after which weights adapt
RATE = 0.06  # of the weights
CORRECTION = 0.01  # rate of the last stage
# Weights of the four predictors at the start of a document: a row for each experience that the document has
# with a node (below 1, 4, 30 observations, more), first where both contexts are rare ones, then where the word
# before is a known one, then where the two words before are.
WEIGHTS = (
    ((0.78, 0.45, 0.38, 0.00), (0.75, 0.43, 0.36, 0.28), (0.58, 0.40, 0.38, 0.50), (0.34, 0.36, 0.40, 0.68)),
    ((0.73, 0.48, 0.60, 0.00), (0.66, 0.50, 0.52, 0.11), (0.53, 0.47, 0.52, 0.22), (0.42, 0.38, 0.54, 0.33)),
    ((0.10, 0.95, 0.75, 0.00), (0.10, 1.10, 0.60, 0.05), (0.00, 1.00, 0.60, 0.18), (0.00, 0.80, 0.60, 0.20)),
)
_SEEN = (1, 4, 30)
_KNOWN = 4  # observations of a node that make a context a known one there
_LEVELS = 24  # of confidence in the last stage
_WIDEST = 8.0
_PRIOR = 0.4
_UNIT = 4  # steps of a prediction that is sent, for one of its logarithm; with 8 scores differ by less than 0.1 %
_MOST = 31  # steps
_NODES = 1 << BITS
_RANGE_BYTES = 4 << 20  # of text for a range of pairs
_HELD_BYTES = 32 << 20  # of questions to a range, more go to a temporary file
_END = np.uint64(0x5EED0E2D0F7E871)  # stands for the end of a text
_START = np.uint64(0x57A127)  # stands for what comes before a text
_FLUSH = 1 << 20
_CHUNK_BYTES = 1 << 20  # of text scored at a time
_GROUP_BYTES = 7 << 20
_ROUNDS = 2  # blocks are scored in so many parts, each of which gives its shuffle free before the next
_DOCUMENT_BYTES = 256  # that a document counts for besides, as each has counts of its own
_SUMMARY = -1  # stands in the place of a block
_LOG10 = np.log(10)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, each text with its end, and how many each has."""
    hashes, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    return np.insert(hashes, ends, _END), counts + 1


def _paths(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the binary tree over hash prefixes that a token passes, and the bit it takes at each."""
    prefix = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
    down = np.arange(BITS, dtype=np.int32)
    nodes = (np.int32(1) << down) | (prefix[:, None] >> (BITS - down))
    return nodes, ((prefix[:, None] >> (BITS - 1 - down)) & 1).astype(np.int8)


def _contexts(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Hashes of the word before and of the two words before each token."""
    first = np.cumsum(counts) - counts
    one = np.concatenate([[_START], hashes[:-1]])
    one[first] = _START
    two = np.concatenate([[_START], one[:-1]])
    two[first] = _START
    return [mix(one + np.uint64(1)), mix(one * np.uint64(0x9E3779B97F4A7C15) + two)]


def context_bits(size: int) -> int:
    """Bits of a context's hash in the key of a pair, for so many bytes of text."""
    return min(64 - BITS, max(20, int(size).bit_length() + 8))


def _keys(hashes: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    """The pair of each token's hash prefix with the word before and with the two words before."""
    prefix = hashes >> np.uint64(64 - BITS)
    return [((context >> np.uint64(64 - width)) << np.uint64(BITS)) | prefix for context in _contexts(hashes, counts)]


def _place(keys: np.ndarray, unused: int, used: int, ranges: int) -> np.ndarray:
    """The range of keys, by their leading ``used`` bits without the last ``unused`` ones."""
    top = min(used, 32)
    return ((keys >> np.uint64(unused + used - top)) * np.uint64(ranges)) >> np.uint64(top)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    keys, n = (np.concatenate(x) for x in zip(*held))
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, n, len(keys)).astype(np.int64)


def _squeezed(values: np.ndarray, level: int = 1) -> bytes:
    """Numbers byte by byte of all of them, as most of the high bytes are alike."""
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T))


def _unsqueezed(data: bytes, kind: type, width: int = 1) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize * width, -1)
    return np.ascontiguousarray(flat.T).view(kind)


def _keys_of(data: bytes) -> np.ndarray:
    return np.cumsum(_unsqueezed(data, np.uint64).ravel(), dtype=np.uint64)


def _placed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and the place of each value among them."""
    order = np.argsort(values)
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], place


def _placed_keys(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Tokens of all texts and how many each has; then, for pairs and for tokens, how many distinct ones there are and the
    place of each token among them in order."""
    hashes, counts = tokens(texts)
    made = []
    for keys in (_keys(hashes, counts, width), [hashes]):
        distinct, place = _placed(np.concatenate(keys))
        made.append((distinct, np.split(place, len(keys))))
    return hashes, counts, made


def _taught_keys(texts: list[bytes], use: list[bool], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For pairs and for tokens the distinct ones in order and their counts in the texts to learn from."""
    hashes, counts = tokens(texts)
    learnt = np.repeat(np.array(use, bool), counts)
    made = []
    for keys in (_keys(hashes, counts, width), [hashes]):
        taught, n = np.unique(np.concatenate([k[learnt] for k in keys]), return_counts=True)
        distinct = _distinct(np.concatenate([taught, *(k[~learnt] for k in keys)]))
        told = np.zeros(len(distinct), np.int64)
        told[np.searchsorted(distinct, taught)] = n
        made.append((distinct, told))
    return made


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, use, task) put together into blocks of text, compressed; a longer text stands alone."""
    for number, part in enumerate(grouped(rows(batches), lambda r: len(r[1]) + 64, _GROUP_BYTES)):
        block = (part[0][3] << 32) | number
        yield pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([[r[0] for r in part]], pa.list_(pa.int64())), pa.array([[bool(r[2]) for r in part]], pa.list_(pa.bool_())),
            pa.array([[len(r[1]) for r in part]], pa.list_(pa.int64())), pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(r[1] for r in part))], pa.binary()),
        ], ["block", "ids", "use", "sizes", "packed"])


def _texts(packed: bytes, sizes: list[int]) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(packed, max_output_size=sum(sizes) + 1) if sum(sizes) else b""
    ends = np.cumsum(sizes).tolist()
    return [whole[end - size : end] for end, size in zip(ends, sizes)]


def _ask(batches: Iterator[pa.RecordBatch], ranges: int, width: int) -> Iterator[pa.RecordBatch]:
    """A row for each range in which a block has pairs, and then for each range of its tokens."""
    for batch in batches:
        for block, use, sizes, packed in rows(iter([batch])):
            out: list[tuple] = []
            for kind, (keys, n) in enumerate(_taught_keys(_texts(packed, sizes), use, width)):
                place = _place(keys, *((0, 64) if kind else (BITS, width)), ranges)
                edges = np.searchsorted(place, np.arange(ranges + 1, dtype=np.uint64)).tolist()
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if b > a:
                        out.append((block, kind * ranges + k, _squeezed(np.diff(keys[a:b], prepend=np.uint64(0))), _squeezed(n[a:b])))
            types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["block", "range", "keys", "counts"])


def _entries(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Predictions at the nodes along each key; ``keys`` are in order and hold all of each of their contexts.

    An entry is the stretched prediction of the bit that the key takes, in steps of 1 / ``_UNIT``, doubled, and 1
    more if the context is a known one there: a byte. It is 0 where nothing was observed.
    """
    before = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty((len(keys), BITS), np.int8)

    def below(depth: int) -> np.ndarray:
        node = keys >> np.uint64(BITS - depth)
        edges = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(keys)]])
        return np.repeat((before[edges[1:]] - before[edges[:-1]]).astype(np.float32), np.diff(edges))

    here = below(0)
    for depth in range(BITS):
        taken = below(depth + 1)
        out[:, depth] = 2 * np.clip(np.rint(_stretch(here - taken, taken) * _UNIT), -_MOST, _MOST) + (here >= _KNOWN)
        here = taken
    return out


def _of_ones(keys: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The same entries for the bit 1, in their place."""
    prefix = (keys & np.uint64(_NODES - 1)).astype(np.uint16)
    for depth in range(BITS):  # one at a time, as all together would take several times the memory
        entry = entries[:, depth]
        taken = (prefix >> np.uint16(BITS - 1 - depth)) & np.uint16(1)
        entries[:, depth] = np.where(taken, entry, 2 * (entry & 1) - entry)
    return entries


def _first_at(keys: np.ndarray) -> np.ndarray:
    """Whether a key is the first at each of its nodes; keys are in order."""
    out = np.ones((len(keys), BITS), bool)
    for depth in range(BITS):
        node = keys >> np.uint64(BITS - depth)
        out[1:, depth] = node[1:] != node[:-1]
    return out


def _spread(keys: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Entries for the bit 1 along all keys from those of the first key at each node, row by row."""
    first, entries, at = _first_at(keys), np.zeros((len(keys), BITS), np.int8), np.arange(len(keys), dtype=np.int32)
    entries[first] = told
    entries = _of_ones(keys, entries)
    for depth in range(BITS):
        entries[:, depth] = entries[np.maximum.accumulate(np.where(first[:, depth], at, np.int32(0))), depth]
    return entries


def _prefix_sizes(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each hash prefix how often its tokens were taught, and how many were."""
    prefix = (keys >> np.uint64(64 - BITS)).astype(np.int64)
    return np.stack([np.bincount(prefix, counts, _NODES), np.bincount(prefix, counts > 0, _NODES)]).astype(np.int64)


def _answer(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """For each block and range the entries of its pairs, or the counts of its tokens, and for each range of tokens
    the sizes of their prefixes. Rows come range by range: counts are added up while the questions are put
    aside, then these are answered one by one."""
    for number, of_range in groupby(rows(batches), lambda r: r[1]):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, asked = 0, []
        with SpooledTemporaryFile(_HELD_BYTES) as aside:
            for block, _, keys, counts in of_range:
                aside.write(keys)
                asked.append((block, len(keys)))
                held.append((_keys_of(keys), _unsqueezed(counts, np.int64).ravel()))
                size += len(held[-1][0])
                if size > _FLUSH and size > 2 * len(held[0][0]):
                    held = [_added(held)]
                    size = len(held[0][0])
            whole, told = _added(held)
            if number < ranges:
                told = _entries(whole, told)
            else:
                sizes = _squeezed(_prefix_sizes(whole, told).ravel())
                yield pa.RecordBatch.from_arrays([pa.array([_SUMMARY], pa.int64()), pa.array([number], pa.int32()), pa.array([sizes], pa.binary())], ["block", "range", "found"])
            aside.seek(0)
            for block, length in asked:
                keys = _keys_of(aside.read(length))
                found = told[np.searchsorted(whole, keys)]
                found = _squeezed(found[_first_at(keys)], 3) if number < ranges else _squeezed(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([number], pa.int32()), pa.array([found], pa.binary())], ["block", "range", "found"]
                )


@dataclass(frozen=True)
class Model:
    """Predictions without a context, sizes of the hash prefixes, tokens, vocabulary."""

    plain: np.ndarray
    prefix_size: np.ndarray
    total: int
    distinct: int


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    odds = (ones + np.float32(_PRIOR)) / (zeros + np.float32(_PRIOR))
    return np.clip(np.log(odds), np.float32(-_WIDEST), np.float32(_WIDEST))


def _of_sizes(prefix_size: np.ndarray) -> np.ndarray:
    """Without a context a node's children are as likely as the sizes of what is below them: alone, this
    predictor gives every token its add-one probability in the corpus."""
    below = np.concatenate([np.zeros(_NODES), prefix_size])
    for node in range(_NODES - 1, 0, -1):
        below[node] = below[2 * node] + below[2 * node + 1]
    children = below[2:].reshape(-1, 2)  # of node 1, 2, ...
    return np.concatenate([[0], np.log(children[:, 1] / children[:, 0])]).astype(np.float32)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, n, v) of all summaries that a task reads."""
    total = np.zeros((2, _NODES), np.int64)
    for (sizes,) in rows(batches):
        total += _unsqueezed(sizes, np.int64).reshape(2, _NODES)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(_NODES)), *map(pa.array, total)], ["prefix", "n", "v"])


def fit(answers: DataFrame) -> Model:
    """What the token counts tell without a context, from the summaries among the answers."""
    summed = answers.filter(F.col("block") == _SUMMARY).select("found").mapInArrow(_sum_up, "prefix long, n long, v long")
    sizes = summed.groupBy("prefix").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()  # a row per prefix
    prefix_size = np.ones(_NODES, np.float64)
    for row in sizes:
        prefix_size[row["prefix"]] += row["n"] + row["v"]
    return Model(_of_sizes(prefix_size), prefix_size, sum(r["n"] for r in sizes), sum(r["v"] for r in sizes))


def bound(source: DataFrame) -> DataFrame:
    """Blocks of (doc_id, text, use): block, ids, use, sizes and packed, written down as they are made."""
    numbered = source.select("doc_id", "text", "use", F.spark_partition_id().cast("long").alias("task"))
    return save(numbered.mapInArrow(_bound, "block long, ids array<long>, use array<boolean>, sizes array<long>, packed binary"), "lm-blocks")


def answered(blocks: DataFrame, ranges: int, width: int) -> DataFrame:
    """(block, range, found) of ``bound`` texts: entries of all pairs of a block, in order over the ranges, and
    counts of all its tokens in ranges from ``ranges`` on, which have a summary each."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _ask(batches, ranges, width)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answer(batches, ranges)

    asked = blocks.select("block", "use", "sizes", "packed").mapInArrow(ask, "block long, range int, keys binary, counts binary")
    dealt = asked.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(answer, "block long, range int, found binary")


_LOG = np.log(np.arange(1 << 12) + _PRIOR).astype(np.float32)


def _stretch_counts(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``_stretch`` of whole numbers, from a table as far as it goes."""
    if len(ones) and max(zeros.max(), ones.max()) >= len(_LOG):
        return _stretch(zeros.astype(np.float32), ones.astype(np.float32))
    odds = np.take(_LOG, ones) - np.take(_LOG, zeros)
    return np.clip(odds, np.float32(-_WIDEST), np.float32(_WIDEST), out=odds)


def mixed(hashes: np.ndarray, counts: np.ndarray, model: Model, places: list[np.ndarray], predicted: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each token's hash prefix, document by document.

    All documents are read side by side: step k has the k-th block of ``STEP`` tokens of each. ``predicted`` holds
    the entries of all their keys and ``places`` where those of each token with the word before and with the
    two words before are.
    """
    documents = len(counts)
    owner = np.repeat(np.arange(documents, dtype=np.int32), counts)
    step = (np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)) // STEP
    order = np.lexsort((owner, step))
    bounds = np.append(np.flatnonzero(np.diff(step[order], prepend=-1)), len(order))
    one, two = (place[order] for place in places)
    owner = owner[order]
    nodes, bits = _paths(hashes[order])

    start_weights = np.array(WEIGHTS, np.float32).reshape(-1, 4).T.copy()
    weights = np.ones((4, documents, BITS), np.float32)  # relative to where they start
    correction = np.zeros(documents * _LEVELS, np.float32)
    own = np.zeros(documents * _NODES * 2, np.int32)  # zeros and ones of each node
    own_pair = own.view(np.int64)  # both in one look-up
    out = np.empty(len(hashes))
    for start, stop in zip(bounds[:-1], bounds[1:]):
        who, node, bit = owner[start:stop], nodes[start:stop], bits[start:stop]
        entries = [np.take(predicted, place[start:stop], axis=0) for place in (one, two)]
        here = who[:, None] * np.int64(_NODES) + node
        said = np.take(own_pair, here).view(np.int32).reshape(*node.shape, 2)
        zeros, ones = said[..., 0], said[..., 1]
        seen = zeros + ones
        gate = (seen >= _SEEN[0]).view(np.int8) + (seen >= _SEEN[1]).view(np.int8)
        gate += (seen >= _SEEN[2]).view(np.int8)
        gate += np.maximum(entries[0] & 1, (entries[1] & 1) << 1).astype(np.int8) << 2
        x = [
            np.take(model.plain, node), (entries[0] >> 1) * np.float32(1 / _UNIT), (entries[1] >> 1) * np.float32(1 / _UNIT),
            _stretch_counts(zeros, ones),
        ]
        raw = np.zeros(node.shape, np.float32)
        for k in range(4):
            x[k] *= np.take(start_weights[k], gate)
            raw += x[k] * np.take(weights[k], who, axis=0)
        level = ((np.clip(raw, -6, 5.99) + np.float32(6)) * np.float32(_LEVELS / 12)).astype(np.int32)
        level += who[:, None] * np.int32(_LEVELS)
        final = np.clip(raw + np.take(correction, level), -14, 14)
        probability = 1 / (1 + np.exp(-final))
        error = bit - probability
        out[order[start:stop]] = np.log(np.prod(1 - np.abs(error), axis=1, dtype=np.float64))
        first = np.flatnonzero(np.diff(who, prepend=-1))
        for k in range(4):
            weights[k, who[first]] += np.float32(RATE) * np.add.reduceat(error * x[k], first, axis=0)
        base = who[0] * _LEVELS
        moved = np.bincount((level - base).ravel(), error.ravel(), (who[-1] + 1) * _LEVELS - base)
        correction[base : base + len(moved)] += np.float32(CORRECTION) * moved
        np.add.at(own, (2 * here + bit).ravel(), np.int32(1))
    return out


def _score_block(documents: pa.Table, told: pa.Table, model: Model, ranges: int, width: int) -> pa.Table:
    out: list[tuple] = []
    if documents.num_rows:
        told = told.sort_by("range")
        _, ids, sizes, packed = next(rows(iter(documents.select(["block", "ids", "sizes", "packed"]).to_batches())))
        texts = _texts(packed, sizes)
        all_hashes, all_counts, ((pairs, places), (_, (token,))) = _placed_keys(texts, width)
        parts: list[list] = [[], []]
        for number, found in zip(told["range"].to_pylist(), told["found"]):
            parts[number >= ranges].append(_unsqueezed(found.as_py(), np.int8 if number < ranges else np.int64).ravel())
        predicted, c = _spread(pairs, np.concatenate(parts[0])), np.concatenate(parts[1])
        upto = doc = 0
        for part in grouped(zip(ids, texts), lambda r: len(r[1]) + _DOCUMENT_BYTES, _CHUNK_BYTES):
            counts = all_counts[doc : doc + len(part)]
            some = slice(upto, upto + int(counts.sum()))
            upto, doc = some.stop, doc + len(part)
            hashes, times = all_hashes[some], c[token[some]]
            hit = times > 0
            base = np.log10((times + 1) / (model.total + model.distinct + 1))
            size = model.prefix_size[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
            whole = mixed(hashes, counts, model, [place[some] for place in places], predicted) / _LOG10 + np.log10((times + 1) / size)
            first = np.cumsum(counts) - counts
            out += zip(
                [r[0] for r in part], [len(r[1] or b"") for r in part], counts.tolist(), np.add.reduceat(hit, first, dtype=np.int64).tolist(),
                np.add.reduceat(base, first).tolist(), np.add.reduceat(whole, first).tolist(),
            )
    columns = list(zip(*out)) or [[]] * 6
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    return pa.table([pa.array(x, t) for x, t in zip(columns, types)], ["doc_id", "n_bytes", "n_tokens", "n_known", "base_score", "score"])


def score(documents: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte, a row for each row.

    ``learn_from`` tells the rows to learn from. Null texts are empty and have one token, their end;
    bits_per_byte is null for them. Without anything to learn from all tokens are unseen. Other columns are
    ignored; an empty table gives no rows.
    """
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"), learn_from.alias("use"))
    blocks = bound(source)
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size))).first()[0] or 0
    ranges, width = max(1, size // _RANGE_BYTES), context_bits(size)
    answers = save(answered(blocks, ranges, width), "lm-answers")  # the questions go when they are answered
    model = fit(answers)

    def run(of_block: pa.Table, found: pa.Table) -> pa.Table:
        return _score_block(of_block, found, model, ranges, width)

    schema = "doc_id long, n_bytes long, n_tokens long, n_known long, base_score double, score double"
    parts = []
    for k in range(_ROUNDS):
        mine = F.pmod(F.xxhash64("block"), F.lit(_ROUNDS)) == k
        told = answers.filter((F.col("block") != _SUMMARY) & mine)
        parts.append(save(blocks.filter(mine).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema), "lm-scores"))
    scored = reduce(DataFrame.unionByName, parts)
    bits = -F.col("score") / F.lit(np.log10(2.0).item()) / F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte")
    )


def scores(documents: DataFrame) -> DataFrame:
    """The columns of ``score`` with held_out: rows whose crc32 of the id leaves 2 modulo 7. Rows without an
    id teach nothing."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = score(documents, F.coalesce(~held_out, F.lit(False)))
    return found.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
