"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Which pieces go together depends on their lengths alone, and there are at most as many lengths as a
sequence has tokens. So the packing is planned on the histogram of lengths, whatever the number of
documents: a plan is a list of patterns, each used as often as the lengths allow. A pattern is filled
greedily, largest length first; then its smallest piece is replaced by two unpacked ones that fit the gap
and the freed place more tightly. Pieces are numbered within their length, in buckets so that a frequent
length is not one task, and the number leads to pattern, sequence and offset.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from tillbook.llm.bpe import ALPHABET
from tillbook.llm.common import grouped, rows, save

LENGTH = 1024
END = 2
_BLOCK_BYTES = 1 << 22
_BUCKET = 50_000


class Ids:
    """The ids that the library ``tokenizers`` gives, without added special tokens.

    Its file names the merges and the vocabulary; ``tiktoken`` computes the same ids from them several times
    faster. Texts that spell a special token are left to ``tokenizers`` itself, which has rules for them.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as text:
            described = json.load(text)
        back = {char: byte for byte, char in enumerate(ALPHABET)}
        added = [token["content"] for token in described["added_tokens"]]
        ranks = {bytes(back[c] for c in piece): n for piece, n in described["model"]["vocab"].items() if piece not in added}
        plain = (
            described["normalizer"] is None and described["pre_tokenizer"]["type"] == "ByteLevel"
            and not described["pre_tokenizer"]["add_prefix_space"] and sorted(ranks.values()) == list(range(len(ranks)))
        )
        self.slow = Tokenizer.from_file(path)
        self.special = added
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def of(self, text: str) -> np.ndarray:
        if self.fast is None or any(token in text for token in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@lru_cache(maxsize=4)
def ids(path: str, pattern: str) -> Ids:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Ids(path, pattern)


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else full pieces after a shorter first one."""
    if n <= length:
        return [(0, n)]
    first = n % length
    return ([(0, first)] if first else []) + [(start, length) for start in range(first, n, length)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, pattern: str, length: int, end: int) -> Iterator[pa.RecordBatch]:
    tool = ids(path, pattern)
    for part in grouped(rows(batches), lambda r: len(r[1] or ""), _BLOCK_BYTES):
        out: list[tuple] = []
        for doc_id, text in part:
            coded = np.append(tool.of(text or ""), np.uint32(end)).astype("<u4")
            out += [
                (doc_id, k, start, n, zlib.crc32(coded[start : start + n].tobytes()))
                for k, (start, n) in enumerate(cut(len(coded), length))
            ]
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def pieces(documents: DataFrame, path: str, pattern: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document; null texts are empty and still have an end."""
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run = partial(_pieces, path=path, pattern=pattern, length=length, end=end)
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns (lengths, descending) and how often each is used; ``counts[n]`` pieces have length n."""
    left, room = counts.astype(np.int64).copy(), len(counts) - 1
    out: list[tuple[list[int], int]] = []
    while left.any():
        free, taken = left.copy(), []
        gap = room
        while (fit := np.flatnonzero(free[1 : gap + 1])).size:
            n = int(fit[-1]) + 1
            taken.append(n)
            free[n] -= 1
            gap -= n
        if gap:
            pair = _two(free, gap + taken[-1], taken[-1])
            if pair:
                free[taken.pop()] += 1
                taken = sorted([*taken, *pair], reverse=True)
        used = np.bincount(taken, minlength=room + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        out.append((taken, times))
    return out


def _two(free: np.ndarray, space: int, beaten: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum within ``space`` that is above ``beaten``."""
    best, found = beaten, None
    lengths = np.flatnonzero(free[: space + 1])
    low, high = 0, len(lengths) - 1
    while low <= high:
        a, b = int(lengths[low]), int(lengths[high])
        if a + b > space or (low == high and free[a] < 2):
            high -= 1
            continue
        if a + b > best:
            best, found = a + b, (b, a)
        low += 1
    return found


def _allocations(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """(length, first rank, first sequence, pieces of this length in the pattern, offset of the first), sorted."""
    out, rank, sequence = [], {}, 0
    for taken, times in patterns:
        offset = 0
        for n in dict.fromkeys(taken):
            each = taken.count(n)
            out.append((n, rank.get(n, 0), sequence, each, offset))
            rank[n] = rank.get(n, 0) + each * times
            offset += each * n
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _place(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = table[:, 0] << 48 | table[:, 1]
    for batch in batches:
        length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
        at = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
        step = rank - at[:, 1]
        sequence = at[:, 2] + step // at[:, 3]
        offset = at[:, 4] + step % at[:, 3] * length
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])


def pack(cut_pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset.

    Sequences are numbered from 0 and filled without gaps from offset 0. Pieces that are alike in every
    column may change places. An empty table gives no rows.
    """
    cut_pieces = save(cut_pieces, "pieces")
    found = cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # a row per length
    counts = np.zeros(length + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    table = _allocations(plan(counts))

    buckets = max(1, int(counts.sum()) // _BUCKET)
    bucketed = cut_pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = bucketed.withColumn("inside", F.row_number().over(inside)).join(firsts, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("inside") - 1).cast("long").alias("rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_place, table=table), schema)
