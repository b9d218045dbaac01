import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wortfund.llm import periodic
from wortfund.llm.queries import op11_periodic_runs


def brute(w):
    """Every run of a list of words, straight from its definition."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and not any(all(w[j] == w[j + r] for j in range(s, s + length - r)) for r in range(1, q)):
                out.append((s, length, q))
            i = max(i, s + 1) if i > s else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_words(rng, most, letters):
    w = []
    while len(w) < most:
        if rng.random() < 0.4:
            w += [rng.choice(letters) for _ in range(rng.randint(1, 6))]
        else:
            p = [rng.choice(letters) for _ in range(rng.randint(1, 12))]
            w += (p * 8)[: rng.randint(1, 7 * len(p))]
    return w


@pytest.mark.parametrize("letters", [2, 3, 5])
def test_runs_against_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(300):
        docs = [periodic_words(rng, rng.randint(0, 90), range(letters)) for _ in range(rng.randint(1, 4))]
        flat, sizes = np.array([x for d in docs for x in d], dtype=np.int64), np.array([len(d) for d in docs])
        found = [tuple(r) for r in periodic.runs_in(flat, sizes).tolist()]
        assert found == [(i, *r) for i, d in enumerate(docs) for r in brute(d)]


def test_every_lag_has_a_class():
    classes = periodic.lag_classes(10_000)
    assert [q for a, b, _ in classes for q in range(a, b + 1)][:10_000] == list(range(1, 10_001))
    for a, b, k in classes:
        assert 2 * b <= k or b == 1
        assert all(k <= max(6, 4 * q) - q for q in range(a, b + 1))


def test_a_period_that_holds_repeats_itself():
    # every 5-gram of the period stands in it several times
    period = "a a a a a a a b a a a a a a a b a a a a a a a a b".split()
    w = period * 5
    assert [tuple(r) for r in periodic.runs_in(np.array([ord(x) for x in w]), np.array([len(w)]))[:, 1:].tolist()] == brute(w)


def test_frame(spark):
    rows = [(1, "x y x y x y x y x y z"), (2, "no run here at all"), (3, None), (4, ""), (5, " \t\n "), (5, " \t\n "), (None, "a " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("r"), "row": F.lit(1)})
    out = periodic.find_runs(df)
    assert out.columns == ["doc_id", "text", "row", "runs", "collapsed_text"]
    found = {(r.doc_id, tuple(map(tuple, r.runs)), r.collapsed_text) for r in out.collect()}
    assert found == {(1, ((0, 10, 2),), "x y z"), (2, (), "no run here at all"), (3, (), ""), (4, (), ""), (5, (), ""), (None, ((0, 9, 1),), "a")}
    assert out.count() == 7


def test_odd_and_empty(spark, odd, empty):
    assert periodic.find_runs(odd).count() == odd.count()
    assert periodic.find_runs(empty, keep_text=False).count() == 0
    assert periodic.find_runs(odd.select("text"), keep_text=False).columns == ["runs", "collapsed_text"]


def test_a_very_long_text(spark):
    rng = random.Random(3)
    period = [f"w{rng.randint(0, 9999)}" for _ in range(9_000)]
    w = ["start", *(period * 7)[: 9_000 * 6 + 77], "end"]
    (row,) = periodic.find_runs(spark.createDataFrame([(" ".join(w),)], "text string")).collect()
    assert [tuple(r) for r in row.runs] == [(1, 54_077, 9_000)]
    assert row.collapsed_text == " ".join(["start", *period, "end"])


def test_query_against_brute_force(spark, sf, documents):
    want = {}
    for row in documents.select("doc_id", "text").collect():
        w = (row.text or "").encode().split()
        h = zlib.crc32(str(row.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        w = [x.decode() for x in w]
        if n > 1500:
            continue  # the plain version is quadratic
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        want[row.doc_id] = (len(runs), *best, milli, sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)), sha(collapse(w, runs)))
    out = op11_periodic_runs(spark, sf)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert len(got) == documents.count()
    assert {i: got[i] for i in want} == want
    assert sum(v[0] > 0 for v in want.values()) > 5
