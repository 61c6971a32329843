"""Exact highest inner products by sorted lists read in step, without random access.

Each block of candidates has one list per component, sorted by value; a query reads a list from
the end that its own component's sign favours. After each depth a candidate's score lies between
a lower bound (unread components at the list's worst value) and an upper bound (at the value
reached). A candidate whose upper bound is below the k-th lower bound can never qualify and is
dropped; the lists are then read on for the others, to twice the depth, and the scores of those
that remain are resolved from the whole lists. Bounds of a block of queries and a block of
candidates are matrix products. Blocks meet as equi-join groups of bounded size, and only k rows
of a query and block go on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
QUERY_BLOCK = 1024
BLOCK = 8192
DEPTHS = (0.25, 0.5)  # shares of the lists read before the bounds are compared


def _bounds(q: np.ndarray, x: np.ndarray, ranks: np.ndarray, lists: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores once ``depth`` entries of every list are read.

    ``ranks``: each entry's place in its component's list, greatest value first; ``lists``: those
    lists. The same list read from its other end serves negative query components.
    """
    n = len(lists)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    from_top, from_end = ranks < depth, ranks >= n - depth
    low = up @ np.where(from_top, x, lists[-1]).T + down @ np.where(from_end, x, lists[0]).T
    high = up @ np.where(from_top, x, lists[depth - 1]).T + down @ np.where(from_end, x, lists[n - depth]).T
    return low, high


def block_top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the ``k`` best of one block for each query; equal scores by lesser id."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    widest = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    kind = float if 0 <= widest < 1 << 53 else object  # products past a double's whole numbers stay integers
    q, x = q.astype(kind), x.astype(kind)
    own = q_ids[:, None] == ids[None, :]
    if x.dtype != object and len(ids) > 4 * k:
        places = np.argsort(-x, axis=0, kind="stable")
        lists = np.take_along_axis(x, places, axis=0)
        ranks = np.empty_like(places)
        np.put_along_axis(ranks, places, np.arange(len(ids))[:, None], axis=0)
        left = np.arange(len(ids))
        for share in DEPTHS:
            if len(left) <= 4 * k:
                break
            low, high = _bounds(q, x[left], ranks[left], lists, max(1, int(len(ids) * share)))
            low[own[:, left]] = -np.inf
            high[own[:, left]] = -np.inf
            least = np.partition(low, len(left) - k, axis=1)[:, len(left) - k]
            left = left[(high >= least[:, None]).any(axis=0)]
        ids, x, own = ids[left], x[left], own[:, left]
    scores = q @ x.T
    found = []
    for i, query in enumerate(q_ids):
        there = np.flatnonzero(~own[i])
        row = scores[i, there]
        if len(row) > k and row.dtype != object:
            least = np.partition(row, len(row) - k)[len(row) - k]
            there, row = there[row >= least], row[row >= least]
        best = sorted(range(len(row)), key=lambda j: -row[j])[:k] if row.dtype == object else np.argsort(-row, kind="stable")[:k]
        found += [(int(query), int(ids[there[j]]), int(row[j])) for j in best]
    return found


def _read(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a group, each pair of equal id and vector once."""
    if not table.num_rows:
        return np.empty(0, np.int64), np.empty((0, 0), np.int64)
    ids = table.column("vec_id").to_numpy()
    lists = table.column("v").combine_chunks()
    x = lists.flatten().to_numpy().reshape(len(ids), -1)
    if len(set(ids.tolist())) < len(ids):
        both = np.unique(np.column_stack([ids, x]), axis=0)
        ids, x = both[:, 0], both[:, 1:]
    return ids, x


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    query_block: int = QUERY_BLOCK,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each row of ``queries``.

    Components count as floor(1024 x). A query never meets its own id, nor vectors of another
    length. Ties go to the smaller id; rows equal in id and vector count once. Null ids, null
    vectors and those with null, NaN or infinite components take no part; an empty vector scores 0
    with its like. Other columns play no part. No rows on either side give no rows.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def ready(df: DataFrame) -> DataFrame:
        fit = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(F.col(vector_col), bad)
        rows = df.select(id_col, vector_col).where(fit)
        return rows.select(F.col(id_col).cast("long").alias("vec_id"), _whole(F.col(vector_col)).alias("v"))

    base, asked = ready(vectors), ready(queries)
    blocks = max(1, -(-base.count() // block))
    query_blocks = max(1, -(-asked.count() // query_block))
    part = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = base.select("vec_id", "v", F.size("v").alias("dim"), part(blocks, 1).alias("cb"), every(query_blocks).alias("qb"))
    theirs = asked.select("vec_id", "v", F.size("v").alias("dim"), part(query_blocks, 2).alias("qb"), every(blocks).alias("cb"))

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        (q_ids, q), (ids, x) = _read(left), _read(right)
        found = block_top(q_ids, q, ids, x, k) if len(q_ids) and len(ids) else []
        columns = list(zip(*found)) if found else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    best = (
        theirs.groupBy("qb", "cb", "dim")
        .cogroup(own.groupBy("qb", "cb", "dim"))
        .applyInArrow(match, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
