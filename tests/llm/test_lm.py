import math
import re
from collections import Counter

import pytest

from wortfund.llm import blocks, lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts):
    docs = [WORD.findall(t or "") for t in texts]
    one, two = Counter(), Counter()
    for d in docs:
        one.update(d)
        two.update(zip(d, d[1:]))
    n = sum(one.values())
    for d in docs:
        own1, own2, others = Counter(d), Counter(zip(d, d[1:])), n - len(d)
        total, known = 0.0, 0
        for i, w in enumerate(d):
            c = one[w] - own1[w]
            value = c / others if c else lm.BACKOFF / (others + 1)
            if i:
                pair = (d[i - 1], w)
                both = two[pair] - own2[pair]
                known += both > 0
                value = both / (one[d[i - 1]] - own1[d[i - 1]]) if both else lm.BACKOFF * value
            total += math.log(value)
        yield len(d), known, total


def check(df, **options):
    rows = lm.score(df, **options).collect()
    for row, (n, known, total) in zip(rows, brute([r.text for r in rows])):
        assert (row.lm_words, row.lm_known_bigrams) == (n, known)
        assert row.lm_logsum == pytest.approx(total, abs=1e-6)
        assert row.lm_score is None if not n else row.lm_score == pytest.approx(total / n)
    return rows


def test_against_brute_force(documents):
    assert len(check(documents, block_bytes=30_000)) == documents.count()


def test_one_block(spark):
    check(spark.createDataFrame([(1, "a b c a b"), (2, "a b d"), (3, "e"), (4, ""), (5, "a b c a b")], "doc_id long, text string"))


def test_odd_and_empty(odd, empty):
    assert len(check(odd.drop("w"), block_bytes=100_000)) == 10
    assert lm.score(empty).count() == 0


def test_blocks_do_not_follow_the_partition_size(spark):
    """A Python process holds a block whole."""
    docs = spark.range(20).selectExpr("id AS doc_id", "repeat('x ', 500000) AS text")
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    try:
        assert blocks.in_blocks(docs, "doc_id", "text")[1] == 3
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)


def test_own_counts_some_documents_at_a_time(monkeypatch):
    monkeypatch.setattr(lm, "WORDS_AT_ONCE", 100)
    rng = lm.np.random.default_rng(1)
    of = lm.np.sort(rng.integers(0, 40, 3000)).astype(lm.np.int32)
    gram = rng.integers(0, 50, 3000).astype(lm.np.uint64)
    total = lm.np.full(len(lm.np.unique(gram)), 1000)
    own = Counter(zip(of.tolist(), gram.tolist()))
    assert lm._without_own(total, gram, of).tolist() == [1000 - own[d, g] for d, g in zip(of.tolist(), gram.tolist())]
