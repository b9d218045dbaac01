import zlib
from collections import Counter

from pyspark.sql import functions as F

from wortfund.llm import sharding
from wortfund.llm.queries import op1_sharding


def check(rows, shards, n):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_every_row_has_a_place(spark, documents):
    out = sharding.shard(documents, 24, bucket_bytes=20_000).collect()
    check(out, 24, documents.count())
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in documents.collect())
    by_place = [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    rises = sum(a < b for a, b in zip(by_place, by_place[1:]))
    assert 0.35 * len(by_place) < rises < 0.65 * len(by_place)


def test_copies_spread(spark):
    rows = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("doc_id"), F.lit("one text, again and again").alias("text"))
    placed = sharding.scatter(rows, seed=1, bucket_bytes=4_000)
    sizes = [r["count"] for r in placed.groupBy("bucket").count().collect()]
    assert max(sizes) <= 4000 / 16 * 3
    check(sharding.shard(rows, 7, bucket_bytes=4_000).collect(), 7, 4000)


def test_odd_and_empty(odd, empty):
    out = sharding.shard(odd, 3)
    assert out.columns.count("shard") == 1 and set(odd.columns) <= set(out.columns)
    check(out.collect(), 3, 10)
    assert sharding.shard(empty, 3).count() == 0


def test_write(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(documents, path, shards=4, bucket_bytes=50_000)
    check(spark.read.parquet(path).collect(), 4, documents.count())


def test_query_columns(spark, sf, documents):
    """Size, checksum and law of the query, row by row."""
    text = {r.doc_id: r.text for r in documents.collect()}
    rows = op1_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.law, r.grown_shard) == (len(raw) + 8, "rows", None)
        assert text[r.doc_id] is None or r.text_crc32 == zlib.crc32(raw)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
