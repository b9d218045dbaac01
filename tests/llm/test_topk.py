import math
import random

import numpy as np
from pyspark.sql import functions as F

from wortfund.llm import topk


def brute(rows, is_query, k, scale):
    sound = {}
    for i, (vid, v) in enumerate(rows):
        if vid is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound[i] = (vid, [math.floor(scale * x) for x in v])
    out = set()
    for qid, q in [(vid, v) for vid, v in sound.values() if is_query(vid)]:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), vid) for vid, v in sound.values() if vid != qid and len(v) == len(q))
        out |= {(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(scored[:k])}
    return out


def run(spark, rows, every=10, k=5, scale=256):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k, scale).collect()}


def vectors(n, dims=16, seed=3, spread=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, spread))) for _ in range(dims)], "x") for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    rows = vectors(400)
    assert run(spark, rows) == brute([r[:2] for r in rows], lambda i: i % 10 == 0, 5, 256)


def test_repeated_query_rows(spark, monkeypatch):
    """Own rows with the highest scores, more of them than k."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 128)
    rows = vectors(500, 4)
    rows = [(i, [4 * c for c in v], s) if i % 10 == 0 else (i, v, s) for i, v, s in rows]
    rows += [r for r in rows if r[0] % 10 == 0 for _ in range(2 + r[0] % 40 // 5)]
    assert run(spark, rows) == brute([r[:2] for r in rows], lambda i: i % 10 == 0, 5, 256)


def test_unlike_query_rows_of_one_id(spark, monkeypatch):
    """Every row is answered; none of the answers holds a row of its id."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    rows = [(50, [1.0, 0.0], "x"), (50, [0.0, 1.0], "x"), *[(i, [i / 10, -i / 7], "x") for i in range(1, 40)]]
    got = run(spark, rows, every=50)
    assert got == brute([r[:2] for r in rows], lambda i: i % 50 == 0, 5, 256) and len(got) == 10
    df = spark.createDataFrame(rows + rows[:2], "vec_id long, embedding array<float>, score string")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).count() == 20


def test_rows_that_repeat_themselves_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 100)
    rows = [(7, [1.0, 2.0], "x")] * 2000 + [(10, [1.0, 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    parts = topk.stored(df.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    sizes = parts.groupBy(F.pmod(F.xxhash64(F.lit(2), "uid"), F.lit(21))).count().collect()
    assert max(r["count"] for r in sizes) < 200
    assert [r.score for r in topk.top_k(df, F.col("vec_id") == 10, 3).collect()] == [3 * 256 * 256] * 3


def test_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    rows = [(i, [float(i % 3), 1.0], "x") for i in range(200)]
    assert run(spark, rows) == brute([r[:2] for r in rows], lambda i: i % 10 == 0, 5, 256)


def test_unsound_vectors(spark):
    bad = [(500, None, "x"), (510, [1.0, None], "x"), (520, [float("nan"), 1.0], "x"), (530, [float("inf"), 1.0], "x"), (None, [1.0, 1.0], "x"), (540, [], "x")]
    rows = [*vectors(30, 2), *bad]
    assert run(spark, rows) == brute([r[:2] for r in rows], lambda i: i % 10 == 0, 5, 256)


def test_empty_and_few(spark):
    assert run(spark, []) == set()
    assert run(spark, vectors(1)) == set()
    assert len(run(spark, vectors(3))) == 2


def test_reads_less_than_everything():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 30, (4000, 16)))
    x[:, 0] *= 30  # one telling list
    q = np.floor(rng.normal(0, 30, (20, 16)))
    places, read = topk.no_random_access(q, x, 6)
    assert read < 4000 * 16 * len(q)
    scores = q @ x.T
    for i, at in enumerate(places):
        assert set(np.argsort(-scores[i])[:5]) <= set(at)
    assert min(map(len, places)) < 4000
