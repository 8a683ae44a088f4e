"""Hard negatives: threshold joins on an inverted index that grows as thresholds are lowered.

Components become whole numbers. The index of a block of rows posts, for a threshold, only those components
of a row without which it could reach the threshold by too much: the smallest ones, whose norm bounds what they
can add, stay out. An anchor adds up the products of the postings; a row whose partial score plus the bound of
what is left stays below the threshold is pruned, the others are scored exactly, so all rows at or above the
threshold are known. While the anchor's windows are not full, the threshold is lowered and only the postings
that come in addition are read. The last threshold posts everything.

The first pass finds each anchor's positives, the second the negatives in the windows these define. Rows are
dealt into blocks once and never copied; anchors are sent to every block and stream past its index.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillbook.llm.common import save

SCALE = 256
ROWS = 16_384  # rows of a block
_TOGETHER = 64  # anchors that read the index together
_START, _LOWER, _STEPS = 0.85, 0.75, 9  # thresholds, as shares of what the longest row could score
_LEFT_OUT = 0.4  # share of a threshold that components left out of the index may make up
_SMALL, _EXACT = 1 << 24, 1 << 53  # whole numbers beyond are not exact in short floats, in floats
_LONG = (1 << 63) - 1
_FOUND = "anchor long, anchor_mark long, place int, positive_id long, positive_score long, other_id long, score long"


class Index:
    """Postings of a block in bands: band k has what threshold k needs and threshold k - 1 did not."""

    def __init__(self, values: np.ndarray, kind: type = np.float64):
        self.values = values.astype(kind)
        size = np.abs(values)
        order = np.argsort(-size, axis=1, kind="stable")
        squares = np.take_along_axis(size, order, 1) ** 2
        left = np.sqrt(np.concatenate([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(values), 1))], axis=1))
        longest = left[:, 0].max(initial=0.0)
        shares = [_START * _LOWER**k for k in range(_STEPS)] if longest > 0 else []
        self.thresholds = [share * longest for share in shares] + [-np.inf]  # for an anchor of norm 1
        rank = np.argsort(order, axis=1, kind="stable")  # place of each dimension among the row's components
        cut = np.zeros(len(values), np.int64)
        self.bands, self.left = [], []
        for threshold in self.thresholds:
            until = (left > max(_LEFT_OUT * threshold, 0.0)).sum(axis=1)  # components that are posted
            new = (rank >= cut[:, None]) & (rank < until[:, None])
            band = []
            for d in np.flatnonzero(new.any(axis=0)):
                rows = np.flatnonzero(new[:, d])
                band.append((d, rows, self.values[rows, d]))
            self.bands.append(band)
            self.left.append(left[np.arange(len(values)), until])
            cut = until

    def join(self, anchors: np.ndarray, full) -> None:
        """Call ``full(k, rows, scores, threshold)`` with all rows of anchor k at or above ever lower thresholds until it is true."""
        norms = np.sqrt((anchors**2).sum(axis=1))
        anchors = anchors.astype(self.values.dtype)
        waiting = np.arange(len(anchors))
        total = np.zeros((len(self.values), len(anchors)), self.values.dtype)
        for threshold, band, left in zip(self.thresholds, self.bands, self.left):
            for d, rows, values in band:
                total[rows] += values[:, None] * anchors[waiting, d]
            done = np.zeros(len(waiting), bool)
            for at, k in enumerate(waiting):
                least = threshold * norms[k] if norms[k] else -np.inf
                possible = np.flatnonzero(total[:, at] + left * (norms[k] * (1 + 1e-9)) >= least * (1 - 1e-9) if least > 0 else total[:, at] >= -np.inf)
                scores = self.values[possible] @ anchors[k]
                reached = scores >= least
                done[at] = full(k, possible[reached], scores[reached].astype(np.int64), least)
            waiting, total = waiting[~done], total[:, ~done]
            if not len(waiting):
                return


class Plain:
    """For components too large for exact floats: all products as Python numbers, held to the range of a long."""

    def __init__(self, values: np.ndarray):
        self.values = [[int(x) for x in row] for row in values]

    def join(self, anchors: np.ndarray, full) -> None:
        for k, anchor in enumerate(anchors):
            whole = [int(x) for x in anchor]
            exact = [max(-_LONG, min(_LONG, sum(a * b for a, b in zip(whole, row)))) for row in self.values]
            full(k, np.arange(len(exact)), np.array(exact, np.int64), -np.inf)


def _index(values: np.ndarray, most: float) -> Index | Plain:
    most *= most * max(1, values.shape[1])
    return Index(values, np.float32 if most < _SMALL else np.float64) if most < _EXACT else Plain(values)


def _best(found: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    order = np.lexsort((ids[found], -scores))[:k]
    return [(int(ids[found[t]]), int(scores[t])) for t in order]


class Block:
    """The rows of one block and the anchors that search it."""

    def __init__(self, table: pa.Table):
        self.ids, self.marks, self.labels = (table[name].to_numpy() for name in ("id", "mark", "label"))
        self.values = _whole(table)
        self.index: Index | Plain | None = None
        self.most = np.abs(self.values).max(initial=0.0)

    def search(self, table: pa.Table, positives: int, negatives: int) -> Iterator[tuple]:
        """Rows of _FOUND: without positives of their own yet, anchors look for these, else for negatives."""
        anchors = _whole(table)
        most = max(self.most, np.abs(anchors).max(initial=0.0))
        if self.index is None or most > self.most:  # larger anchors may need another kind of numbers
            self.index, self.most = _index(self.values, most), most
        ids, marks, labels = (table[name].to_numpy() for name in ("id", "mark", "label"))
        windows = table["positives"].to_pylist()
        out: list[list[tuple]] = [[] for _ in ids]

        def same(k, rows, scores, least) -> bool:
            keep = (self.labels[rows] == labels[k]) & ((self.ids[rows] != ids[k]) | (self.marks[rows] != marks[k]))
            if keep.sum() < positives and least > -np.inf:
                return False
            out[k] = [(0, None, None, *pair) for pair in _best(rows[keep], scores[keep], self.ids, positives)]
            return True

        def different(k, rows, scores, least) -> bool:
            keep = self.labels[rows] != labels[k]
            rows, scores = rows[keep], scores[keep]
            out[k] = []
            for window in windows[k]:
                positive = window["score"]
                low, high = -(-50 * positive // 100), 95 * positive // 100
                inside = (scores >= low) & (scores <= high)
                if inside.sum() < negatives and least > low and low <= high:
                    return False
                out[k] += [(window["place"], window["id"], positive, *pair) for pair in _best(rows[inside], scores[inside], self.ids, negatives)]
            return True

        self.index.join(anchors, same if windows[0] is None else different)
        for k, found in enumerate(out):
            for row in found:
                yield (int(ids[k]), int(marks[k]), *row)


def _whole(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).reshape(table.num_rows, -1)


def _scan(batches: Iterator[pa.RecordBatch], positives: int, negatives: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and dims, members before anchors: members are held, anchors stream past them."""
    names = [field.split()[0] for field in _FOUND.split(", ")]
    types = [pa.int32() if field.endswith(" int") else pa.int64() for field in _FOUND.split(", ")]
    key, held, block = None, [], None
    for batch in batches:
        places = np.stack([batch[name].to_numpy() for name in ("block", "dims")] + [batch["is_anchor"].to_numpy(zero_copy_only=False)])
        edges = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            part = pa.Table.from_batches([batch.slice(start, end - start)])
            if key != tuple(places[:2, start]):
                key, held, block = tuple(places[:2, start]), [], None
            if not places[2, start]:
                held.append(part)
                continue
            if block is None and held:
                block, held = Block(pa.concat_tables(held)), []
            if block is None:  # anchors of a number of dimensions that no row of the block has
                continue
            for first in range(0, part.num_rows, _TOGETHER):
                found = list(zip(*block.search(part.slice(first, _TOGETHER), positives, negatives)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names)


def _joined(rows: DataFrame, anchors: DataFrame, blocks: int, positives: int, negatives: int) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    sent = anchors.withColumn("block", every).withColumn("is_anchor", F.lit(True))
    dealt = rows.withColumns({"block": F.pmod(F.xxhash64("id", "mark"), F.lit(blocks)).cast("int"), "is_anchor": F.lit(False)})
    dealt = dealt.withColumn("positives", F.lit(None).cast(anchors.schema["positives"].dataType))
    together = dealt.unionByName(sent).repartition(blocks, "block").sortWithinPartitions("block", "dims", "is_anchor")
    together = together.select("block", "dims", "is_anchor", "id", "mark", "label", "vector", "positives")
    return together.mapInArrow(partial(_scan, positives=positives, negatives=negatives), _FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label, vector or component or one that is not finite take no part; zero and empty vectors
    do. Repeated rows count once; rows that share an id but not all else are rows of their own, and an anchor
    only leaves itself out. Ties go to the smaller id. Vectors of different lengths are never compared, scores
    beyond a long count as the nearest long. Of other columns none is used, an empty table gives no rows.
    ``is_anchor`` and ``label`` are columns of the table; anchors without a negative in a window have no rows for it.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    infinite = F.lit(float("inf"))
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"), is_anchor.alias("wanted")
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(F.coalesce(x, F.lit(0.0))) & (F.abs(x) < infinite)))
    rows = rows.withColumns({"mark": F.xxhash64("label", "vector"), "dims": F.size("vector")})
    rows = save(rows.dropDuplicates(["id", "mark"]), "mined-rows")
    blocks = -(-rows.count() // ROWS) or 1
    anchors = rows.filter("wanted").drop("wanted")
    rows = rows.drop("wanted")
    unknown = F.lit(None).cast("array<struct<place:int,id:bigint,score:bigint>>")
    found = _joined(rows, anchors.withColumn("positives", unknown), blocks, positives, negatives)
    chosen = _first(found, ["anchor", "anchor_mark"], positives).groupBy(F.col("anchor").alias("id"), F.col("anchor_mark").alias("mark"))
    chosen = chosen.agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("other_id").alias("id"), "score"))).alias("positives"))
    known = save(anchors.join(chosen, ["id", "mark"]), "mined-anchors")
    mined = _first(_joined(rows, known, blocks, positives, negatives), ["anchor", "anchor_mark", "place"], negatives)
    return mined.select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mined(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; where it is divisible by 7, the label is the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(embeddings, F.col("vec_id") % 50 == 0, label)


ORACLE = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
