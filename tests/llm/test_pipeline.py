import hashlib
import math
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
import corpus_pipeline as P  # noqa: E402
from test_mixing import simulate  # noqa: E402
from test_quality import WORD, brute, verdict  # noqa: E402
from wortfund.llm import near_dup, secret_scan  # noqa: E402
from wortfund.llm.queries import vocabulary_path  # noqa: E402


def classes(texts):
    """Least member of each class, by all pairs that may be similar by their common words."""
    words, top = [WORD.findall(t) for t in texts], list(range(len(texts)))
    number = {w: i for i, w in enumerate({w for x in words for w in x})}
    counts, codes = [Counter(x) for x in words], [np.array([number[w] for w in x]) for x in words]

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(words[i]), len(words[j]))
            if min(len(words[i]), len(words[j])) >= 0.8 * longer and (counts[i] & counts[j]).total() >= 0.8 * longer and near_dup.alike([(codes[i], codes[j])], 0.8)[0]:
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_run_against_brute_force(spark, sf, documents):
    library = Tokenizer.from_file(vocabulary_path())
    rows = sorted((r.doc_id, r.text) for r in documents.collect() if verdict(brute(r.text)))
    rows = [rows[i] for i in sorted(set(classes([t for _, t in rows])))]
    want = {}
    for doc_id, text in rows:
        text = secret_scan.redacted(text, secret_scan.find(text))
        ids = library.encode(text, add_special_tokens=False).ids
        want[doc_id] = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = P.run(spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_odd_and_empty(spark, odd, empty, sf, name, stage):
    plain = odd.select(*empty.columns)
    for docs in (plain, empty):
        out = stage(spark, docs, sf)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert out.count() <= docs.count()
    assert stage(spark, empty, sf).count() == 0


def test_stages_keep_what_they_should(spark, documents, sf):
    for name, stage in P.STAGES[2:4]:
        assert stage(spark, documents, sf).count() == documents.count()


def mixed_order(rows):
    """Ids of (id, source, text) in the mixed order, slot by slot."""
    of = {}
    for i, source, text in rows:
        of.setdefault(source, []).append((hashlib.md5(f"11:{i}:{text}".encode()).hexdigest(), i))
    names = sorted(of)
    most = max(map(len, of.values()))
    picks = simulate([max(1, math.floor(32 * math.sqrt(len(of[s])) / math.sqrt(most))) for s in names])
    left, out = [[i for _, i in sorted(of[s])] for s in names], []
    while any(left):
        for p in picks:
            out += left[p][:16]
            left[p] = left[p][16:]
    return out


@pytest.fixture
def many_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_mixed_order_reaches_the_result(spark, documents, sf, tmp_path, many_files):
    stages, path = dict(P.STAGES), str(tmp_path / "mixed")
    # files of unlike size
    stages["mixing"](spark, documents.unionByName(documents.where("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") + 10**6)), sf).write.parquet(path)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) > 3
    got = sorted((r.mix_position, r.doc_id) for r in stages["tokens"](spark, back, sf).collect())
    assert [p for p, _ in got] == list(range(len(got)))
    assert [i for _, i in got] == mixed_order([(r.doc_id, r.source, r.text) for r in back.collect()])


def test_run_is_in_mixed_order(spark, documents, sf, many_files):
    got = [r.doc_id for r in P.run(spark, sf).collect()]
    texts = {r.doc_id: r for r in documents.collect()}
    rows = [(i, texts[i].source, secret_scan.redacted(texts[i].text, secret_scan.find(texts[i].text))) for i in got]
    assert got == mixed_order(rows) != sorted(got)
