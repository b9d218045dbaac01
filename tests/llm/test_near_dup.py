import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wortfund.llm import near_dup as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar(a, b):
    return len(a) > 0 and len(b) > 0 and distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9


def classes(texts):
    """Least member of each class, by all pairs."""
    words = [WORD.findall(t) for t in texts]
    top = list(range(len(texts)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or abs(len(words[i]) - len(words[j])) <= 0.2 * max(len(words[i]), len(words[j])) and similar(words[i], words[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_alignment():
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(0, 14)):
            if b:
                k = rng.randrange(len(b))
                b[k : k + rng.randrange(2)] = [rng.randrange(6)] * rng.randrange(2)
        if b:
            pairs.append((np.array(a), np.array(b)))
    got = D.alike(pairs, 0.8)
    assert got == [similar(list(a), list(b)) for a, b in pairs]
    for band in (1, 3, 50):
        exact = [distance(list(a), list(b)) for a, b in pairs]
        assert list(D.edit_distances(pairs, band)) == [min(d, band + 1) for d in exact]


def make(seed=5, n=40):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(vocab, k=60))
    texts = []
    for i in range(n):
        base = rng.choices(vocab, k=rng.randrange(40, 300))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            copy = list(base)
            for _ in range(max(1, len(copy) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy))
        if i % 4 == 0:
            texts.append(passage + " " + " ".join(rng.choices(vocab, k=30)))
            texts.append(texts[-2].replace(" ", "\n"))
    return texts


def test_classes_against_all_pairs(spark):
    texts = make()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.class_id for r in D.classify(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes(texts)
    kept = sorted(r.doc_id for r in D.keep_one(df).collect())
    assert kept == sorted(set(classes(texts)))


def test_large_groups_in_blocks(spark, monkeypatch):
    """Copies and dissimilar texts in one group, more than a chunk holds."""
    monkeypatch.setattr(D, "CHUNK", 4)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(100)]
    texts = []
    for _ in range(30):
        copy = list(base)
        for _ in range(8):
            copy[rng.randrange(100)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    shared = base[:50]
    texts += [" ".join(shared + [f"u{rng.randrange(10**6)}" for _ in range(50)]) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.class_id for r in D.classify(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes(texts)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    df = spark.createDataFrame([(bytes([a >> 8, a & 255]), bytes([b >> 8, b & 255])) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in D.components(df).collect()}
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    key = lambda x: bytes([x >> 8, x & 255])
    assert got == {key(x): key(find(x)) for a, b in edges for x in (a, b) if a != b}


def test_odd_and_empty(spark, odd, empty):
    got = D.classify(odd).collect()
    assert len(got) == 10
    kept = D.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 0, 1, 2, 3, 4, 5, 6]
    assert D.classify(empty).count() == 0 == D.keep_one(empty).count()


def test_recall_at_the_edge(spark):
    """Pairs that are similar by their words, with 10, 15 and 20 % of single words replaced, end in one class."""
    rng, texts, pairs = random.Random(8), [], {}
    for percent in (10, 15, 20):
        for _ in range(80):
            base = [f"w{rng.randrange(4000)}" for _ in range(300)]
            copy = list(base)
            for at in rng.sample(range(300), 3 * percent):
                copy[at] = f"n{rng.randrange(10**6)}"
            pairs.setdefault(percent, []).append(len(texts))
            texts += [" ".join(base), " ".join(copy)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.class_id for r in D.classify(df).collect()}
    assert all(similar(texts[i].split(), texts[i + 1].split()) for i in pairs[20][:5])
    recall = {percent: np.mean([got[i] == got[i + 1] for i in firsts]) for percent, firsts in pairs.items()}
    assert recall[10] == 1 and recall[15] > 0.97 and recall[20] > 0.93, recall
    assert all(got[i] // 2 == i // 2 for i in got)


def test_one_id_on_many_texts(spark, monkeypatch):
    """Rows without an id, or all with one: each wanted text is found by itself, and the classes are right."""
    found, store = [], D.stored

    def counted(df, name):
        out = store(df, name)
        if name == "found":
            found.append(out.count())
        return out

    monkeypatch.setattr(D, "stored", counted)
    texts = make(n=15)
    least = classes(texts)
    for doc_id in (None, 7):
        # one row of each class has an id of its own, the others share one or have none
        rows = [(1000 + i if least[i] == i else doc_id, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found.clear()
        kept = D.keep_one(df).collect()
        assert found and max(found) <= len(texts)
        assert len(kept) == len(set(least))
        if doc_id is None:
            assert sorted(r.doc_id for r in kept) == sorted(1000 + i for i in set(least))


def test_sketch_follows_edits():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = a.copy()
    b[rng.choice(300, 6, replace=False)] = 7
    turned = np.concatenate([a[150:], a[:150]])
    sketch = lambda x: D.sketches(x, np.array([len(x)]))[0]
    same = lambda x, y: (sketch(x) == sketch(y)).mean()
    short = [a[:1], a[:3], a[:5], a[:7]]
    together = D.sketches(np.concatenate([*short, a]), np.array([1, 3, 5, 7, 300]))
    assert all((sketch(x) == y).all() for x, y in zip([*short, a], together))
    assert same(a, a) == 1 and same(a, b) > 0.5 > same(a, rng.permutation(a)) and same(a, turned) < 0.9


def test_long_near_copies(spark):
    """30,000 words, a few of them replaced, dropped and put in; and a long text that shares only its half."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(30_000)]
    near, half = list(base), base[:15_000] + [f"n{rng.randrange(10**6)}" for _ in range(15_000)]
    for _ in range(200):
        at = rng.randrange(len(near))
        near[at : at + rng.randrange(2)] = [f"x{rng.randrange(10**6)}"] * rng.randrange(2)
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(half))], "doc_id long, text string")
    assert {r.id: r.class_id for r in D.classify(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_scratch_tables_go(spark, monkeypatch):
    import os

    kept = []
    store = D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])
    df = spark.createDataFrame(list(enumerate(make(n=12))), "doc_id long, text string")
    assert D.classify(df).count() == df.count()
    left = [t.stored_at for t in kept if os.path.isdir(t.stored_at)]
    # what the lazy result reads: rows, nodes, the last labels, and the tested pairs
    assert {os.path.basename(p).split("-")[0] for p in left} <= {"rows", "nodes", "stars", "verified"}
    assert sum("nodes-" in p or "rows-" in p or "stars-" in p for p in left) == 3


def test_sketches_are_made_of_few_words_at_a_time(monkeypatch):
    size = [0, 40, 300, 7, 0, 500, 20, 20]
    ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    words = pa.ListArray.from_arrays(ends, pa.array(np.random.default_rng(5).integers(-(2**60), 2**60, sum(size))))
    names, number = ["id", "key", "node", "words"], pa.array(range(len(size)), pa.int64())
    batch = pa.record_batch([number, number, pa.array([b"n"] * len(size)), words], names=names)
    whole = pa.Table.from_batches(D._signed([batch]))
    monkeypatch.setattr(D, "WORDS_AT_ONCE", 100)
    made = []
    sketches = D.sketches
    monkeypatch.setattr(D, "sketches", lambda word, size: made.append(len(word)) or sketches(word, size))
    parts = pa.Table.from_batches(D._signed([batch]))
    assert parts.to_pylist() == whole.to_pylist()
    assert whole["sketches"].null_count == 2 and max(made) < 100 + max(size) and len(made) > 2


def test_fine_bins_of_few_and_of_many_words():
    """Few words are written as their bins, many as counts; both are read as the same counts, up to 255."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 2**63, n, dtype=np.int64) for n in (1, 5, D.FINE_BINS // 2 - 1, D.FINE_BINS // 2, 5000)]
    texts += [np.full(300, 7, dtype=np.int64), np.full(3000, -1, dtype=np.int64)]
    batch = pa.record_batch([pa.array([b"%d" % i for i in range(len(texts))], pa.binary()), pa.array(texts, pa.list_(pa.int64()))], names=["node", "words"])
    (found,) = D._fine([batch])
    bags = found["bag"].to_pylist()
    assert [len(b) for b in bags] == [2, 10, D.FINE_BINS - 2, D.FINE_BINS, D.FINE_BINS, 600, D.FINE_BINS]
    want = [np.minimum(np.bincount(t.view(np.uint64) % np.uint64(D.FINE_BINS), minlength=D.FINE_BINS), 255) for t in texts]
    assert (D._counts(bags, D.FINE_BINS) == np.array(want)).all()
    assert (D._counts([bytes(range(128))], 128) == np.arange(128)).all()


def test_groups_of_a_node_are_told_apart_once(spark, monkeypatch):
    """Not once for each side of the cells."""
    rng, plans, paired = random.Random(4), [], D._paired
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(20 + i % 40)) for i in range(40)]
    texts += [" ".join(["x", *t.split()[1:]]) for t in texts[:5]]

    def spied(rows, *args):
        plans.append(rows._jdf.queryExecution().toString())
        return paired(rows, *args)

    monkeypatch.setattr(D, "_paired", spied)
    got = {r.id: r.class_id for r in D.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == classes(texts)
    assert len(plans) > 2 and all("inline(" not in p for p in plans)


def test_members_are_sent_once_for_many_others(spark):
    """A group of 1500 different texts is one block: each is on one side of two cells, and on the other side of one."""
    rows = spark.range(1500).selectExpr("7L AS s", "1500L AS size", "unhex(md5(string(id))) AS node", "10L AS n", f"unhex(repeat('00', {D.BINS})) AS bag")
    sent, paired = [], D._paired

    class Graph:
        labels = None

    try:
        D._paired = lambda cells, *args: sent.append(cells.groupBy("minor").count().collect())
        D._open_pairs(rows, Graph, 0.8, True)
    finally:
        D._paired = paired
    assert dict(map(tuple, sent[0])) == {True: 2 * 1499, False: 1500}
