"""Exact top-k inner products by aggregation without random access.

Rows are cut into blocks of bounded size; every block keeps, for each component, its rows sorted by
that component. A query reads these lists in step, from the end that adds most to its score. After
each step every row has an upper bound: what was read of it, and the last value read in every list
where it has not come up. Rows that cannot reach the k-th best score known so far are out; reading
stops when few are left, and their scores are then resolved exactly. Blocks of queries meet blocks of rows in tasks of their own, and each sends on k
rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallybook.llm.blocks import pack, unpack, written_table

BLOCK_ROWS = 8192
BLOCK_QUERIES = 128
BLOCKS_IN_STEP = 4  # blocks of rows that a block of queries meets one after another
_DEPTHS = (0.45, 0.6, 0.75, 0.9)  # parts of every list read before bounds are looked at
_LEADERS = 16  # rows whose scores are resolved at each look, for a better k-th score


class SortedLists:
    """The rows of a block, and for each component its values in ascending order."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.values = np.sort(rows.T, axis=1)
        self.most = np.abs(rows).max(axis=0, initial=0).astype(np.float64)

    def read(self, depth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the lists give when this part of each is read, from the bottom and from the top.

        For lists read from the bottom, then for those from the top: the values reached, and for each row how far
        beyond them its own was; 0 where it has not come up.
        """
        size = int(len(self.rows) * depth) + 1
        bottom, top = self.values[:, size - 1], self.values[:, -size]
        read = np.empty((len(self.rows), 2 * len(bottom)))
        np.subtract(np.minimum(self.rows, bottom), bottom, out=read[:, : len(bottom)])
        np.subtract(np.maximum(self.rows, top), top, out=read[:, len(bottom) :])
        return bottom.astype(np.float64), top.astype(np.float64), read


def no_random_access(lists: SortedLists, queries: np.ndarray, k: int, own: np.ndarray, floors: np.ndarray) -> list[np.ndarray]:
    """For each query the numbers of all rows that may be among its ``k`` best.

    ``own``, if not negative, takes no part; rows that score less than ``floors`` are not wanted. A row's upper bound
    is the sum of what was read of it and, for every list where it has not come up, the value
    reached there. Its lower bound is the score itself for the rows that lead; few of them suffice. The lists of a block
    are read once for all queries that are still open, and their sums taken together.
    """
    count = len(lists.rows)
    alive = np.ones((len(queries), count), bool)
    mine = np.flatnonzero(own >= 0)
    alive[mine, own[mine]] = False
    floors = floors.astype(np.float64)
    weights = queries.astype(np.float64)
    weights = np.concatenate([np.minimum(weights, 0), np.maximum(weights, 0)], axis=1)
    slack = 1e-9 * (np.abs(queries).astype(np.float64) @ lists.most)
    for depth in _DEPTHS:
        left = alive.sum(axis=1)
        open_ = np.flatnonzero((left > max(_LEADERS, 2 * k, count // 64)) & (weights != 0).any(axis=1))
        if not len(open_):
            break
        bottom, top, read = lists.read(depth)
        upper = weights[open_] @ read.T
        upper += (weights[open_] @ np.concatenate([bottom, top]))[:, None]
        upper[~alive[open_]] = -np.inf
        leaders = np.argpartition(upper, count - _LEADERS, axis=1)[:, count - _LEADERS :]
        for q, lead, bound in zip(open_, leaders, upper):
            lead = lead[alive[q, lead]]
            scores = np.sort(lists.rows[lead] @ queries[q])
            if len(scores) >= k:
                floors[q] = max(floors[q], float(scores[-k]))
            alive[q] &= bound >= floors[q] - slack[q]
    return [np.flatnonzero(row) for row in alive]


def best_rows(lists: SortedLists, ids: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray, floors: np.ndarray):
    """For each query (ids, scores) of its ``k`` best rows: highest score first, ties to the smaller id."""
    for query, rows in zip(queries, no_random_access(lists, queries, k, own, floors)):
        scores = lists.rows[rows] @ query
        order = np.lexsort((ids[rows], -scores))[:k]
        yield ids[rows][order], scores[order]


def _blocks(vectors: DataFrame, size: int, width: int, name: str) -> DataFrame:
    """``name`` (block number), ``count``, and its ids, row numbers and components as packed arrays."""
    blocks = max(1, -(-vectors.count() // size))

    def run(table: pa.Table) -> pa.Table:
        rows = np.zeros((table.num_rows, width), np.int64)
        flat = table.column("whole").combine_chunks()
        sizes = np.diff(flat.offsets.to_numpy())
        values = flat.flatten().to_numpy(zero_copy_only=False)
        rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
        ids, numbers = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        return pa.table({
            name: table.column(name)[:1], "ids": [pack(ids)], "numbers": [pack(numbers)], "cells": [pack(rows.reshape(-1))],
        })

    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(name)
    packed = vectors.select(block, "vec_id", "row", "whole").groupBy(name).applyInArrow(
        run, f"{name} int, ids binary, numbers binary, cells binary"
    )
    return written_table(packed, name)


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_column: str = "vec_id",
    vector_column: str = "embedding", block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows for every query row.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the
    query's own. Components are floor(``scale`` * x) and must fit 32 bits; a score is their inner
    product. Ties go to the smaller id. Rows without an id, null vectors and vectors with a null or
    non-finite component take no part; shorter vectors count as filled up with zeros, and an empty
    one scores 0. Rows that repeat an id are candidates, and queries, each. Other columns are
    ignored; an empty table gives no rows.
    """
    x = F.col(f"`{vector_column}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.when(finite, whole).alias("whole"))
    rows = rows.where("vec_id IS NOT NULL AND whole IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    rows = written_table(rows, "vectors")
    width = rows.agg(F.max(F.size("whole"))).first()[0] or 0
    candidates = _blocks(rows, block_rows, width, "block")
    queries = _blocks(rows.where(F.col("vec_id") % every == 0), block_queries, width, "ask")
    # Every block of queries against every block of rows: both are few, and each pair is a task's work.
    asks = queries.select(F.collect_set("ask").alias("asks"))
    blocks = candidates.select(F.collect_set("block").alias("blocks"))
    pairs = asks.select(F.explode("asks").alias("ask"), F.lit(0).alias("one")).join(
        blocks.select(F.explode("blocks").alias("block"), F.lit(0).alias("one")), "one"
    ).select("ask", "block")
    pairs = written_table(pairs, "pairs")
    step = F.floor(F.col("block") / BLOCKS_IN_STEP).cast("int")
    left = pairs.join(candidates, "block").select(F.col("ask").alias("met"), step.alias("part"), "ids", "numbers", "cells")
    right = pairs.select("ask", step.alias("step")).distinct().join(queries, "ask")

    def run(blocks: pa.Table, ask: pa.Table) -> pa.Table:
        asked = ask.to_pylist()[0]
        names, rows = unpack(asked["ids"], np.int64).tolist(), unpack(asked["numbers"], np.int64).tolist()
        wanted = unpack(asked["cells"], np.int64).reshape(len(names), width)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(names)
        for i in range(blocks.num_rows):
            mine = blocks.slice(i, 1).to_pylist()[0]
            ids, numbers = unpack(mine["ids"], np.int64), unpack(mine["numbers"], np.int64)
            lists = SortedLists(unpack(mine["cells"], np.int64).reshape(len(ids), width))
            at = {n: j for j, n in enumerate(numbers.tolist())}
            own = np.array([at.get(row, -1) for row in rows], np.int64)
            floors = np.array([float(scores[-1]) if len(scores) == k else -np.inf for _, scores in best])
            for q, (found, scores) in enumerate(best_rows(lists, ids, wanted, k, own, floors)):
                found, scores = np.concatenate([best[q][0], found]), np.concatenate([best[q][1], scores])
                order = np.lexsort((found, -scores))[:k]
                best[q] = found[order], scores[order]
        sizes = [len(scores) for _, scores in best]
        return pa.table({
            "query_row": np.repeat(np.array(rows, np.int64), sizes), "query_id": np.repeat(np.array(names, np.int64), sizes),
            "vec_id": np.concatenate([found for found, _ in best]), "score": np.concatenate([scores for _, scores in best]),
        })

    local = left.groupBy("met", "part").cogroup(right.groupBy("ask", "step")).applyInArrow(
        run, "query_row long, query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
