"""Exact top-k by inner product with no-random-access aggregation, in blocks.

Components are turned into integers, floor(scale * x), so scores are exact. Queries and candidates are
dealt into blocks of a fixed number of rows, and each block of queries meets each block of candidates
in a task of its own. There, every dimension is a list of the candidates sorted by component; a query
reads it from the end that its own component favours. After a depth of the lists has been read, a
candidate's score lies between what is read of it plus the least and plus the largest values the unread
lists can still add. Candidates whose upper bound is below the k-th best lower bound can no longer
qualify; a query stops when the ones that can are few, and their final scores are resolved. Otherwise
the lists are read to the end. The k best of each block are then ranked for each query.

A vector that is null or holds a null or non-finite component takes no part, as query or as candidate. Only vectors
of one length are compared. Ties go to the smaller id. Rows that repeat an id are candidates of their own, and every query row is
answered: an id on several rows, alike or not, has an answer for each of them, of which none holds a row of that id. Rows are numbered
and written down first; blocks are dealt by that number, so rows that repeat themselves spread over all blocks. Fewer candidates than
k give them all; no candidates or an empty table, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wortfund.llm.common import quoted, stored

#: Rows of a block.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
#: Shares of the lists after which bounds are drawn.
DEPTHS = (0.25, 0.5, 0.75)
#: A query stops when this many times k candidates can still qualify.
FEW = 8
#: Whole numbers up to here are exact in floating point.
_EXACT = 2.0**53


def _ints(table: pa.Table, name: str, scale: int) -> np.ndarray:
    column = table[name].combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products; in unbounded integers where floating point would round."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, x.shape[1])
    if most < _EXACT:
        return q @ x.T
    return np.array([[int(a) for a in row] for row in q], dtype=object) @ np.array([[int(a) for a in row] for row in x], dtype=object).T


def no_random_access(q: np.ndarray, x: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[list[np.ndarray], int]:
    """For each query, places of the candidates that can be among its k best; and the list entries read.

    own [query, candidate]: candidates that are rows of the query itself. They take no place of the k best; they can
    still be among the places.
    """
    n, dims = x.shape
    if n <= FEW * k or not dims or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * dims >= _EXACT:
        return [np.arange(n)] * len(q), n * dims * len(q)
    order = np.argsort(x, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    ordered = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    # the least an unread list can add: its far end
    floor_up, floor_down = ordered[0], ordered[-1]
    out, open_, read = [np.arange(n)] * len(q), np.arange(len(q)), 0
    for share in DEPTHS:
        depth = int(n * share)
        high, low = rank >= n - depth, rank < depth  # read from the top where q > 0, else from the bottom
        top, bottom = ordered[n - depth - 1], ordered[depth]  # the next values of the lists
        u, d = up[open_], down[open_]
        read += 2 * depth * dims
        lower = u @ np.where(high, x, floor_up).T + d @ np.where(low, x, floor_down).T
        upper = u @ np.where(high, x, top).T + d @ np.where(low, x, bottom).T
        if own is not None:
            lower[own[open_]] = upper[own[open_]] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k]
        can = upper >= kth[:, None]
        few = can.sum(axis=1) <= FEW * k
        for i in np.flatnonzero(few):
            out[open_[i]] = np.flatnonzero(can[i])
        open_ = open_[~few]
        if not len(open_):
            break
    return out, read


def _cell(k: int, scale: int):
    def run(table: pa.Table) -> pa.Table:
        is_query = np.asarray(table["is_query"])
        queries, candidates = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query))
        q, x = _ints(queries, "v", scale), _ints(candidates, "v", scale)
        qid, xid, uid = queries["id"].to_numpy(), candidates["id"].to_numpy(), queries["uid"].to_numpy()
        found: list[tuple[int, int, int, int]] = []
        if len(q) and len(x):
            for at in range(0, len(q), 256):
                some = q[at : at + 256]
                # a query's own rows, however many, may stand among its best
                for i, places in enumerate(no_random_access(some, x, k, qid[at : at + 256, None] == xid[None, :])[0]):
                    own = qid[at + i]
                    score = _exact_scores(some[i : i + 1], x[places])[0]
                    keep = xid[places] != own
                    score, ids = score[keep], xid[places][keep]
                    best = np.lexsort((ids, -score.astype(np.float64)))[:k] if score.dtype != object else sorted(range(len(ids)), key=lambda j: (-score[j], ids[j]))[:k]
                    found += [(int(uid[at + i]), int(own), int(ids[j]), int(score[j])) for j in best]
        columns = list(zip(*found)) or [(), (), (), ()]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("uid", "query_id", "id", "score"), columns)})

    return run


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(query_id, rank from 1, id, score) of the k highest scores of each query row over all other rows."""
    vector = quoted(vector_col).cast("array<double>")
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.where(quoted(id_col).isNotNull()).where(F.coalesce(sound, F.lit(False)))
    # as wide as they came: floats stay floats until they are scaled
    kept = quoted(vector_col) if df.schema[vector_col].dataType.simpleString() == "array<float>" else vector
    rows = rows.select(quoted(id_col).cast("long").alias("id"), kept.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    q_blocks, c_blocks = max(1, -(-sizes.q // QUERY_BLOCK)), max(1, -(-sizes.n // CANDIDATE_BLOCK))
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dims = F.size("v").alias("dims")
    queries = rows.where("is_query").select("uid", "id", "v", F.lit(True).alias("is_query"), dims, part(q_blocks, 1).alias("qb"), every(c_blocks).alias("cb"))
    candidates = rows.select("uid", "id", "v", F.lit(False).alias("is_query"), dims, part(c_blocks, 2).alias("cb"), every(q_blocks).alias("qb"))
    cells = queries.unionByName(candidates).repartition(min(q_blocks * c_blocks, 100_000), "dims", "qb", "cb")
    best = cells.groupBy("dims", "qb", "cb").applyInArrow(_cell(k, scale), "uid long, query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
