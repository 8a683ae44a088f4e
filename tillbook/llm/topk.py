"""Exact top-k inner products by an impact-ordered index, read score at a time.

Components become whole numbers. The index of a block of vectors is a list of segments, one per band of
magnitudes from large to small; a segment posts every component in its band, by dimension, with an impact quantised
to a quarter of the band. Queries read the segments in descending impact and add up scores for all vectors. After
each segment the part of a vector that is unread or lost by quantising has a known norm, which bounds its score
from both sides. A query stops only on proof: when the vectors whose upper bound reaches the k-th lower bound
are few. Those possible members are scored exactly. The last segment posts what all others lost, so reading
on always ends in exact scores.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.vectors import best, in_blocks, usable

SCALE = 256
_FEW = 0.02  # share of a block that is scored exactly rather than read on
_TOGETHER = 128  # queries that read the index together
_WIDEST = 1 << 20  # larger components are multiplied as Python numbers
_SHORT = 1 << 24  # whole numbers below are exact in short floats
_LONG = (1 << 63) - 1


class Index:
    """Segments of one block, and the norm of what is lost after each.

    A segment holds, for each dimension, the vectors that have an impact there and their impacts; vectors without one
    are not in the posting.
    """

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.float64)  # whole numbers, exact in all sums below
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.lost: list[np.ndarray] = []
        left = self.values.copy()
        band = 1 << max(0, int(np.abs(values).max(initial=1)).bit_length() - 1)
        while band >= 16:
            step = band // 4
            self._post(np.where(np.abs(left) >= band, np.trunc(left / step) * step, 0.0), left)
            band //= 2
        self._post(left.copy(), left)

    def _post(self, impacts: np.ndarray, left: np.ndarray) -> None:
        """Add a segment of the impacts that are not zero, and take them from what is left."""
        left -= impacts
        postings = []
        for d in np.flatnonzero(impacts.any(axis=0)):
            rows = np.flatnonzero(impacts[:, d])
            postings.append((d, rows, impacts[rows, d]))
        self.segments.append(postings)
        self.lost.append(np.sqrt((left**2).sum(axis=1)))

    def top(self, queries: np.ndarray, k: int, skip: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Possible members and their exact scores for each query; rows of ``skip`` are not wanted."""
        n = len(self.values)
        most = max(1, self.values.shape[1]) * np.abs(self.values).max(initial=0) * np.abs(queries).max(initial=0)
        exact = np.float32 if most < _SHORT else np.float64
        slack = 4 * np.spacing(exact(most))  # of the bounds, which are no whole numbers
        norms = (np.sqrt((queries**2).sum(axis=1)) * (1 + 1e-5)).astype(exact)
        asked = queries.T.astype(exact)
        few = max(8 * k, int(_FEW * n))
        out: list[tuple] = [()] * len(queries)
        open_ones = np.arange(len(queries))
        total = np.zeros((n, len(queries)), exact)
        for q, rows_of in enumerate(skip):
            total[rows_of, q] = -np.inf
        for number, (segment, lost) in enumerate(zip(self.segments, self.lost)):
            for d, rows, impacts in segment:
                total[rows] += impacts.astype(exact)[:, None] * asked[d, open_ones]
            short = lost.astype(exact)[:, None] * norms[open_ones]
            wanted = max(0, n - k - 1)  # a place lower, as the query's own vector may stand among the rows
            floor = np.partition(np.ascontiguousarray((total - short).T), wanted, axis=1)[:, wanted]
            possible = total + short >= np.maximum(floor - slack, np.finfo(exact).min)
            ready = (possible.sum(axis=0) <= few) | (number == len(self.segments) - 1)
            for column in np.flatnonzero(ready):
                q = open_ones[column]
                at = np.flatnonzero(possible[:, column])
                out[q] = at, (self.values[at] @ queries[q]).astype(np.int64)
            open_ones, total = open_ones[~ready], total[:, ~ready]
            if not len(open_ones):
                break
        return out


def _whole(rows: pa.Table) -> np.ndarray:
    flat = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).reshape(rows.num_rows, -1)


def _search(rows: pa.Table, k: int) -> pa.Table:
    flags = rows["query"].to_numpy(zero_copy_only=False)
    members, queries = rows.filter(pa.array(~flags)), rows.filter(pa.array(flags))
    out: list[tuple] = []
    if members.num_rows and queries.num_rows:
        values, wanted = _whole(members), _whole(queries)
        ids, query_ids = members["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        fits = values.shape[1] and max(np.abs(values).max(), np.abs(wanted).max()) < _WIDEST
        index = Index(values) if fits else None
        for first in range(0, len(query_ids), _TOGETHER):
            some, of = query_ids[first : first + _TOGETHER], wanted[first : first + _TOGETHER]
            own = [np.flatnonzero(ids == query_id) for query_id in some]
            if index is not None:
                results = index.top(of, k, own)
            else:  # exact products of any size, held to the range of a long
                results = []
                for query, skip in zip(of, own):
                    at = np.delete(np.arange(len(ids)), skip)
                    exact = [sum(int(a) * int(b) for a, b in zip(values[t], query)) for t in at]
                    results.append((at, np.array([max(-_LONG, min(_LONG, x)) for x in exact], np.int64)))
            for query_id, (at, score) in zip(some, results):
                for t in np.lexsort((ids[at], -score))[:k]:
                    out.append((int(query_id), int(ids[at[t]]), int(score[t])))
    columns = list(zip(*out)) or [[], [], []]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.int64())})


def top_products(embeddings: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest whole-number inner products of each query.

    ``is_query`` is a condition on vec_id. Zero vectors take part; see ``usable`` for nulls, repeated ids and
    other columns. Products beyond a long count as the nearest long. An empty table gives no rows.
    """
    source = usable(embeddings, zero=True, id_col=id_col, vector_col=vector_col)
    return best(in_blocks(source, is_query, partial(_search, k=k), "query_id long, vec_id long, score long"), k)


ORACLE = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
