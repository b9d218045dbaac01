import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wortfund.llm import hard_negatives as H


def brute(rows, is_anchor, scale=256, positives=5, negatives=10, low=30, high=90):
    sound = []
    for n, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.append((n, i, [math.floor(scale * x) for x in v], label))
    out = []
    for n, i, q, label in sound:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m, other) for m, j, v, other in sound if m != n and len(v) == len(q))
        for s, j, _, other in [x for x in scored if x[3] == label][:positives]:
            window = [x for x in scored if x[3] != label and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(window[:negatives])]
    return sorted(out)


def run(spark, rows, every=10, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, uid string, score string")
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % every == 0, **more).collect()))


def vectors(n, dims=8, seed=3, labels=4):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0.2, 1))) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 16)
    monkeypatch.setattr(H, "CANDIDATE_BLOCK", 64)


def test_against_brute_force(spark, small_blocks):
    rows = vectors(400)
    found = run(spark, rows)
    assert found == brute(rows, lambda i: i % 10 == 0) and len(found) > 500


def test_repeated_rows_and_ids(spark, small_blocks):
    """Rows that repeat an id, alike or unlike, anchors among them."""
    rows = vectors(150)
    rows += [r for r in rows if r[0] % 30 == 0 for _ in range(3)] + [(i, v, 1) for i, v, _ in vectors(60, seed=9)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_ties(spark, small_blocks):
    rows = [(i, [float(i % 3), 1.0], i % 2) for i in range(200)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_nulls_and_unsound_vectors(spark):
    bad = [(500, None, 1), (510, [1.0, None], 1), (520, [float("nan"), 1.0], 2), (530, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (540, [], 1), (550, [1.0, 1.0], None), (560, [0.0, 0.0], 1), (570, [1.0], 1), (580, [2.0], 1), (590, [1.0], 0)]
    rows = [*vectors(60, 2), *bad]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_few_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, vectors(1)) == []
    assert run(spark, [(i, v, 1) for i, v, _ in vectors(30)]) == []
    rows = vectors(6, labels=2)
    assert run(spark, rows, every=1) == brute(rows, lambda i: True)


def test_large_components(spark):
    rows = [(i, [float(np.float32(x * 1e5)) for x in v], label) for i, v, label in vectors(60, 4)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_search_stops_before_the_end():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 20, (4000, 6)))
    x[:, 0] *= 40  # one telling list
    lists, may = H.Lists(x, np.arange(4000)), rng.random(4000) < 0.5
    most = 0
    for q in np.floor(rng.normal(0, 30, (20, 6))):
        scores = x @ q
        top = int(scores[may].max())
        windows = [(None, None), (int(0.3 * top), int(0.9 * top))]
        found, looked_up = H.threshold_search(lists, q, may, windows, 5)
        for places, (low, high) in zip(found, windows):
            want = sorted((-s, i) for i, s in enumerate(scores) if may[i] and (low is None or low <= s) and (high is None or s <= high))[:5]
            assert places == [i for _, i in want]
        most = max(most, looked_up)
    assert most < 4000
