import heapq
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wortfund.llm import mixing


def simulate(parts):
    """Earliest deadline first among released blocks, slot by slot."""
    total, had, out = sum(parts), [0] * len(parts), []
    for t in range(total):
        ready = [(math.ceil(Fraction((n + 1) * total, p)), i) for i, (n, p) in enumerate(zip(had, parts)) if n < p and n * total // p <= t]
        due, i = min(ready)
        assert due > t
        had[i] += 1
        out.append(i)
    return out


def picks(spark, parts):
    slots, period = mixing.schedule(spark.createDataFrame(list(enumerate(parts)), "i long, parts long"))
    got = sorted(slots.collect(), key=lambda r: r.slot)
    assert period == sum(parts) and [r.slot for r in got] == list(range(period))
    return [r.i for r in got]


@pytest.mark.parametrize("segment, chunk", [(1 << 19, 512), (10, 3)])
def test_schedule(spark, monkeypatch, segment, chunk):
    monkeypatch.setattr(mixing, "SEGMENT", segment)
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    for parts in ([1], [1, 1], [5, 3, 2], [32, 9, 9, 9, 1, 4], [1, 30], [7, 7, 7], [3, 9, 3, 1, 9, 3, 2]):
        got = picks(spark, parts)
        assert got == simulate(parts)
        total = sum(parts)
        for t in range(total + 1):
            had = [got[:t].count(i) for i in range(len(parts))]
            assert all(abs(h - Fraction(t * p, total)) < 1 for h, p in zip(had, parts))


def test_many_sources(spark):
    """5,000 sources of 1 to 40 rows: the order of a plain simulation."""
    size = [1 + s * 7919 % 40 for s in range(5_000)]
    docs = spark.createDataFrame([(s, n) for s, n in enumerate(size)], "s long, n long")
    docs = docs.select(F.format_string("s%04d", "s").alias("source"), F.explode(F.sequence(F.lit(1), "n")).alias("doc_id"), F.lit("t").alias("text"))
    rows = order(mixing.mix(docs, block_rows=4).collect())
    assert len(rows) == sum(size)
    parts = [max(1, math.floor(32 * math.sqrt(n) / math.sqrt(40))) for n in size]
    total = sum(parts)
    slots = [[] for _ in parts]
    for p in set(parts):
        same = [i for i, x in enumerate(parts) if x == p]
        for j in range(p):
            for i in same:
                slots[i].append((math.ceil(Fraction((j + 1) * total, p)), j * total // p))
    ready, released, had = [], sorted((slots[i][j][1], i, j) for i in range(len(parts)) for j in range(parts[i])), 0
    expected = []
    for t in range(total):
        while had < len(released) and released[had][0] <= t:
            _, i, j = released[had]
            heapq.heappush(ready, (slots[i][j][0], i, j))
            had += 1
        _, i, j = heapq.heappop(ready)
        expected += [(i, t)] * max(0, min(4, size[i] - 4 * j))
    assert [(int(r.source[1:]), r.mix_slot) for r in rows] == expected


def order(rows):
    rows = sorted(rows, key=lambda r: r.mix_position)
    assert [r.mix_position for r in rows] == list(range(len(rows)))
    return rows


def test_deviation_and_whole(spark):
    docs = spark.range(0, 900, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source")
    )
    weights, block = {"hot": 5, "s0": 2, "s1": 1, "s2": 1, "s3": 1}, 4
    rows = order(mixing.mix(docs, weights, block_rows=block).collect())
    assert sorted(r.doc_id for r in rows) == list(range(900))
    total, had = sum(weights.values()), dict.fromkeys(weights, 0)
    size = {s: sum(r.source == s for r in rows) for s in weights}
    for t, r in enumerate(rows):
        if min(size[s] - had[s] for s in weights) < block:
            break
        had[r.source] += 1
        assert all(abs(had[s] - (t + 1) * weights[s] / total) < 2 * block for s in weights)
        if (t + 1) % block == 0:
            assert all(abs(had[s] / block - (t + 1) // block * weights[s] / total) < 1 for s in weights)
    assert t > 300


def test_ranges_agree_with_one_window(spark, documents, monkeypatch):
    one = {r.doc_id: r.mix_position for r in mixing.mix(documents).collect()}
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert {r.doc_id: r.mix_position for r in mixing.mix(documents).collect()} == one


def test_in_order(spark, documents, tmp_path):
    path = str(tmp_path / "mixed")
    mixing.in_order(documents).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.columns == documents.columns and back.exceptAll(documents).count() == 0 == documents.exceptAll(back).count()


def test_odd_and_empty(odd, empty):
    rows = order(mixing.mix(odd, block_rows=1).collect())
    assert len(rows) == 10 and sum(r.source is None for r in rows) == 2
    assert mixing.mix(empty).count() == 0
    assert mixing.in_order(odd).columns == odd.columns
