"""Hard negatives for anchors, by the threshold algorithm over per-dimension sorted lists.

Components are turned into integers, floor(scale * x), so scores are exact. An anchor's positives are its best rows of the same
label. Each of them opens a window of scores, from `low` to `high` per cent of its own, and the best rows of another label within
the window are its hard negatives.

Candidates are dealt into blocks of a fixed number of rows, anchors likewise, and each block of anchors meets each block of
candidates in a task of its own (Fagin's algorithm runs there):

- sorted access: every dimension is a list of the block's candidates sorted by component. An anchor reads all lists in step, each
  from the end that the sign of its own component favours;
- random access: a candidate that a list shows for the first time is looked up and scored in whole numbers;
- the threshold is what a candidate would score that stood, in every list, where reading has come to. No unseen one
  scores more. An anchor stops once the threshold lies strictly below the k-th best score that each of its windows has so far (an
  equal one could still win by its smaller id), or below the window's lower end. Otherwise the lists are read to the end.

It runs twice: for the positives (one window without ends, rows of the same label), and for the negatives (one window for each
positive, rows of other labels). The k best of each block are then ranked over all blocks.

Every row has a number of its own, so that rows that repeat an id, or an id and a vector, are rows like others: an anchor on two
rows is answered for each of them, and each is the other's candidate. Ties go to the smaller id. A row whose id, label or vector is null, or
whose vector holds a null or non-finite component, takes no part. Rows are compared with rows of as many dimensions. A window
that holds no row gives none, nor does an anchor without positives; an empty table gives an empty result. A score
beyond a 64-bit integer ends the job. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wortfund.llm.common import quoted, stored

#: Rows of a block.
ANCHOR_BLOCK, CANDIDATE_BLOCK = 2048, 8192
#: Parts in which a list is read; the threshold is drawn after each.
STEPS = 16
#: Whole numbers up to here are exact in floating point.
_EXACT = 2.0**53


class Lists:
    """The candidates of a block, and for each dimension their places sorted by component."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        self.order = np.argsort(x, axis=0, kind="stable")
        self.ordered = np.take_along_axis(x, self.order, axis=0)
        self.most = np.abs(x).max(initial=0)

    def exact(self, q: np.ndarray) -> bool:
        """Whether floating point holds every score of q, and every threshold, without rounding."""
        return np.abs(q).max(initial=0) * self.most * max(1, self.x.shape[1]) < _EXACT

    def scores(self, q: np.ndarray, places: np.ndarray):
        """Inner products as whole numbers."""
        if self.exact(q):
            return self.x[places] @ q
        return np.array([sum(int(a) * int(b) for a, b in zip(q, row)) for row in self.x[places]], dtype=object)


def threshold_search(lists: Lists, q: np.ndarray, may: np.ndarray, windows, k: int) -> tuple[list[list[int]], int]:
    """For each window (low, high; None: no end) the places of the k best candidates whose score it holds, best first, ties by
    smaller id; and the number of candidates that were looked up. may: the candidates that count."""
    n, dims = lists.x.shape
    seen = np.zeros(n, dtype=bool)
    step = max(1, -(-n // STEPS)) if dims and lists.exact(q) else n
    up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    best: list[list] = [[] for _ in windows]
    open_, looked_up, depth = list(range(len(windows))), 0, 0
    while open_ and depth < n:
        to = min(n, depth + step)
        # sorted access; at the end of the lists every candidate has been met, in lists of zeros too
        now = np.zeros(n, dtype=bool)
        now[lists.order[n - to : n - depth, up]] = True
        now[lists.order[depth:to, down]] = True
        if to == n:
            now[:] = True
        new = np.flatnonzero(now & ~seen)
        seen |= now
        places = new[may[new]]
        looked_up += len(new)
        scores = lists.scores(q, places)
        # no unseen candidate scores more than this
        threshold = (lists.ordered[n - to, up] @ q[up] + lists.ordered[to - 1, down] @ q[down]) if to < n else None
        for w in list(open_):
            low, high = windows[w]
            inside = np.ones(len(places), dtype=bool)
            if low is not None:
                inside &= (scores >= low).astype(bool)
            if high is not None:
                inside &= (scores <= high).astype(bool)
            own = [(-int(scores[i]), int(lists.ids[places[i]]), int(places[i])) for i in _foremost(scores, np.flatnonzero(inside), k)]
            best[w] = sorted(best[w] + own)[:k]
            if threshold is not None:
                full = len(best[w]) == k and threshold < -best[w][-1][0]
                if full or (low is not None and threshold < low):
                    open_.remove(w)
        depth = to
    return [[place for _, _, place in b] for b in best], looked_up


def _foremost(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places `at`, those whose score is not below the k-th best one."""
    if len(at) <= k or scores.dtype == object:
        return at
    own = scores[at]
    return at[own >= np.partition(own, len(own) - k)[len(own) - k]]


def _ints(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _cell(k: int, scale: int, same_label: bool):
    """Rows of a cell -> (anchor, window, uid, id, score) of the k best of each window."""

    def run(table: pa.Table) -> pa.Table:
        is_anchor = np.asarray(table["is_anchor"])
        anchors, rows = table.filter(pa.array(is_anchor)), table.filter(pa.array(~is_anchor))
        found: list[tuple] = []
        if len(anchors) and len(rows):
            lists = Lists(_ints(rows["v"], scale), rows["id"].to_numpy())
            q, uid, labels = _ints(anchors["v"], scale), rows["uid"].to_numpy(), rows["label"].to_numpy()
            for i, (own, label, windows) in enumerate(zip(anchors["uid"].to_pylist(), anchors["label"].to_pylist(), anchors["windows"].to_pylist())):
                may = (labels == label) & (uid != own) if same_label else labels != label
                ends = [(w["low"], w["high"]) for w in windows]
                for w, places in zip(windows, threshold_search(lists, q[i], may, ends, k)[0]):
                    scores = lists.scores(q[i], np.array(places, dtype=np.int64))
                    found += [(own, w["window"], int(uid[p]), int(lists.ids[p]), int(s)) for p, s in zip(places, scores)]
        columns = list(zip(*found)) or [()] * 5
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor", "window", "uid", "id", "score"), columns)})

    return run


_WINDOWS = "array<struct<window: bigint, low: bigint, high: bigint>>"


def _best(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], k: int, scale: int, same_label: bool) -> DataFrame:
    """(anchor, window, rank, uid, id, score): the k best rows of each window of the anchors (uid, id, label, v, windows)."""
    a_blocks, c_blocks = blocks
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = ["uid", "id", "label", "v", F.size("v").alias("dims")]
    left = anchors.select(*own, "windows", F.lit(True).alias("is_anchor"), part(a_blocks, 1).alias("ab"), every(c_blocks).alias("cb"))
    right = rows.select(*own, F.lit(None).cast(_WINDOWS).alias("windows"), F.lit(False).alias("is_anchor"), every(a_blocks).alias("ab"), part(c_blocks, 2).alias("cb"))
    cells = left.unionByName(right).repartition(min(a_blocks * c_blocks, 100_000), "dims", "ab", "cb")
    found = cells.groupBy("dims", "ab", "cb").applyInArrow(_cell(k, scale, same_label), "anchor long, window long, uid long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "uid"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col="vec_id",
    vector_col="embedding",
    label_col="label",
) -> DataFrame:
    """(anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score): for each anchor and each of its
    `positives` best rows of the same label, the `negatives` best rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score. label: an expression in place of the column."""
    vector = quoted(vector_col).cast("array<double>")
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = quoted(label_col) if label is None else label
    rows = df.where(quoted(id_col).isNotNull() & label.isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.monotonically_increasing_id().alias("uid"),
        quoted(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        vector.cast("array<float>").alias("v") if df.schema[vector_col].dataType.simpleString() == "array<float>" else vector.alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    # written down, so that a row keeps its number whenever a task is run again
    rows = stored(rows, "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).first()
    blocks = max(1, -(-sizes.a // ANCHOR_BLOCK)), max(1, -(-sizes.n // CANDIDATE_BLOCK))
    anchors = rows.where("is_anchor")
    every = F.array(F.struct(F.lit(0).cast("long").alias("window"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    good = _best(rows, anchors.withColumn("windows", every), blocks, positives, scale, same_label=True)
    good = stored(good.select("anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole numbers: the least not below low * score / 100, the greatest not above high * score / 100
    ends = F.expr(f"struct(window, -((-{low} * positive_score - pmod(-{low} * positive_score, 100)) div 100) AS low, ({high} * positive_score - pmod({high} * positive_score, 100)) div 100 AS high)")
    windows = good.groupBy(F.col("anchor").alias("uid")).agg(F.collect_list(ends).cast(_WINDOWS).alias("windows"))
    bad = _best(rows, anchors.join(windows, "uid"), blocks, negatives, scale, same_label=False)
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        bad.join(good, ["anchor", "window"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
