"""Approximate nearest neighbours by counting collisions on single projections.

Every vector is projected on ``PROJECTIONS`` random directions and each projection is kept as a sorted
array. A query opens a window around its own projection in every array; a vector inside a window collides.
Widening all windows together is virtual rehashing at a larger radius and only the two new ends of each
window are counted. A vector with enough collisions is verified by its inner product. A query is done when
``k`` verified vectors lie within the radius that its windows stand for, or when a stated share of the block
has been verified.

Largest inner product becomes smallest distance by one more coordinate that gives all vectors the same
norm, and a query that is scaled to it. As short vectors would all look alike beside long ones, a block is
searched in bands of similar norms, longest first; a query leaves out the bands whose norms cannot reach its
k-th best product any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.vectors import best, in_blocks, usable

PROJECTIONS = 24
WIDTH = 1.0  # half a window in units of the radius: two thirds of the vectors at that distance collide
COLLISIONS = 0.6  # share of the projections
STEP = 1.25  # between radii
START = 0.6  # first radius in units of the common norm
SLACK = 1.25  # the k-th verified vector must be so much nearer than the radius
SHARE = 0.47  # of a block that is verified before a query ends without proof
_FEW = 1_024  # vectors that are verified at least before a query ends without proof
_BAND = 1.5  # ratio of the norms in a band
_SEED = 7


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = rows["vector"].combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return rows["vec_id"].to_numpy(), flat.reshape(rows.num_rows, -1)


def search_block(ids: np.ndarray, members: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of up to ``k`` verified members for each query; never the query's own id."""
    norms, lengths = np.sqrt((members**2).sum(axis=1)), np.sqrt((queries**2).sum(axis=1))
    band = np.floor(np.log(norms.max() / norms) / np.log(_BAND)).astype(np.int64)
    found = [np.empty(0, np.int64)] * len(queries)
    score = [np.empty(0)] * len(queries)
    for number in np.unique(band):
        rows = np.flatnonzero(band == number)
        norm = norms[rows].max()
        able = [q for q in range(len(queries)) if len(score[q]) < k or norm * lengths[q] >= np.partition(score[q], -k)[-k]]
        if not able:
            break
        for q, (more, products) in zip(able, _search_band(ids[rows], members[rows], query_ids[able], queries[able], norm, k)):
            found[q], score[q] = np.append(found[q], rows[more]), np.append(score[q], products)
    out: list[tuple] = []
    for q, query_id in enumerate(query_ids):
        if len(score[q]) > k:  # ties with the k-th stay
            near = score[q] >= np.partition(score[q], -k)[-k]
            found[q], score[q] = found[q][near], score[q][near]
        top = np.lexsort((ids[found[q]], -score[q]))[:k]
        out += [(int(query_id), int(ids[found[q][t]]), float(score[q][t])) for t in top]
    return out


def _search_band(
    ids: np.ndarray, members: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, norm: float, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and products of the verified members of a band, query by query."""
    n = len(ids)
    directions = np.random.default_rng(_SEED).standard_normal((members.shape[1] + 1, PROJECTIONS))
    lift = np.sqrt(np.maximum(norm**2 - (members**2).sum(axis=1), 0))
    projected = np.hstack([members, lift[:, None]]) @ directions
    order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32).copy()
    values = np.take_along_axis(projected, order.T.astype(np.int64), axis=0).T.copy()
    scaled = queries * (norm / np.sqrt((queries**2).sum(axis=1)))[:, None]
    centres = scaled @ directions[:-1]
    need, enough = max(1, int(COLLISIONS * PROJECTIONS)), max(_FEW, int(SHARE * n))

    radii = START * norm * STEP ** np.arange(200)
    radii = radii[: int(np.searchsorted(radii, 2 * norm)) + 2]
    reach = WIDTH * radii
    low, high = np.empty((PROJECTIONS, len(queries), len(reach)), np.int32), np.empty((PROJECTIONS, len(queries), len(reach)), np.int32)
    for p in range(PROJECTIONS):
        low[p] = np.searchsorted(values[p], centres[:, p, None] - reach, side="left")
        high[p] = np.searchsorted(values[p], centres[:, p, None] + reach, side="right")

    for q, query in enumerate(queries):
        count, done = np.zeros(n, np.uint8), np.zeros(n, bool)
        done[ids == query_ids[q]] = True
        found, score = np.empty(0, np.int64), np.empty(0)
        length = np.sqrt((query**2).sum())
        for r, radius in enumerate(radii):
            lo, hi = low[:, q, r], high[:, q, r]
            before_lo, before_hi = (low[:, q, r - 1], high[:, q, r - 1]) if r else (lo, lo)
            for p in range(PROJECTIONS):
                if lo[p] < before_lo[p]:
                    count[order[p, lo[p] : before_lo[p]]] += 1
                if before_hi[p] < hi[p]:
                    count[order[p, before_hi[p] : hi[p]]] += 1
            fresh = np.flatnonzero((count >= need) & ~done)
            if len(fresh):
                done[fresh] = True
                found, score = np.append(found, fresh), np.append(score, members[fresh] @ query)
            if len(found) < min(k, n - 1):
                continue
            # At this radius a product is at least norm * |q| - |q| * radius**2 / (2 * norm).
            within = length * (norm - (radius / SLACK) ** 2 / (2 * norm))
            if len(found) >= enough or (score >= within).sum() >= k:
                break
        if len(found) < min(k, n - 1):  # too few collided at any radius
            found = np.flatnonzero(ids != query_ids[q])
            score = members[found] @ query
        yield found, score


def _search(rows: pa.Table, k: int) -> pa.Table:
    flags = rows["query"].to_numpy(zero_copy_only=False)
    members, queries = rows.filter(pa.array(~flags)), rows.filter(pa.array(flags))
    found = search_block(*_matrix(members), *_matrix(queries), k) if members.num_rows and queries.num_rows else []
    columns = list(zip(*found)) or [[], [], []]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def nearest(embeddings: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: about the ``k`` largest inner products of each query.

    ``is_query`` is a condition on vec_id. See ``usable`` for nulls, zeros, repeated ids and other columns;
    an empty table gives no rows. Every vector is indexed, in the block that its id falls into.
    """
    source = usable(embeddings, zero=False, id_col=id_col, vector_col=vector_col)
    return best(in_blocks(source, is_query, partial(_search, k=k), "query_id long, vec_id long, score double"), k)
