"""What both vector searches share: which rows take part, and queries against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

_ROWS = 16_384  # rows of a block
_QUERIES = 2_048  # queries that a block is searched for together


def usable(embeddings: DataFrame, zero: bool, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part.

    Rows without an id, null vectors and vectors with a null or non-finite component do not; zero and empty
    vectors only if ``zero``. Of rows that share an id the one with the smallest vector stands for all.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    source = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    infinite = F.lit(float("inf"))
    source = source.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(F.coalesce(x, F.lit(0.0))) & (F.abs(x) < infinite)))
    if not zero:
        source = source.filter(F.exists("vector", lambda x: x != 0))
    return source.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def in_blocks(source: DataFrame, is_query: Column, search: Callable, schema: str) -> DataFrame:
    """Run ``search`` on each block of rows with each batch of queries.

    Rows are dealt into blocks once, as many as their number asks for. Queries, the smaller side, are sent to every
    block and stream past its rows, so a task holds a block and a batch, however many queries there are.
    Vectors of different lengths are never compared. ``search`` gets a table of vec_id, vector and query.
    """
    marked = source.withColumn("query", is_query).withColumn("dims", F.size("vector"))
    blocks = -(-marked.count() // _ROWS) or 1
    members = marked.withColumns({"query": F.lit(False), "block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")})
    queries = marked.filter("query").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    together = members.unionByName(queries).repartition(blocks, "block").sortWithinPartitions("block", "dims", "query")
    return together.select("block", "dims", "query", "vec_id", "vector").mapInArrow(partial(_stream, search=search), schema)


def _stream(batches: Iterator[pa.RecordBatch], search: Callable) -> Iterator[pa.RecordBatch]:
    """Rows come by block and number of dimensions, members before queries: members are held, queries stream by."""
    key, members = None, []
    for batch in batches:
        marks = np.stack([batch["block"].to_numpy(), batch["dims"].to_numpy(), batch["query"].to_numpy(zero_copy_only=False)])
        edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            if key != tuple(marks[:2, start]):
                key, members = tuple(marks[:2, start]), []
            part = pa.Table.from_batches([batch.slice(start, end - start)]).select(["vec_id", "vector", "query"])
            if not marks[2, start]:
                members.append(part)
                continue
            for first in range(0, part.num_rows if members else 0, _QUERIES):
                members = [pa.concat_tables(members)]
                found = search(pa.concat_tables([*members, part.slice(first, _QUERIES)]))
                yield from found.combine_chunks().to_batches()


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
