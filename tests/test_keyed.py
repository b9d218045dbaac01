"""Keyed tables that are loaded again, replaced documents in every layout, term dictionaries."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wortfund import schemas
from wortfund.operators import index as I
from wortfund.operators import keyed
from wortfund.plans import jobs
from wortfund.sources import tables as S
from wortfund.sources import versions

ARTICLE = "docid long, title string, wikitext string"


def frame(spark, rows, order=False):
    return spark.createDataFrame(rows, ARTICLE + (", n int" if order else ""))


def stop(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_the_last_row_of_a_key_wins(spark):
    rows = frame(spark, [(1, "b", "first", 1), (1, "a", "last", 2), (2, "x", None, None), (2, "y", "z", None)], True)
    found = sorted(map(tuple, keyed.one_row_per_key(rows, ["docid"], ["n"]).collect()))
    assert found == [(1, "a", "last", 2), (2, "y", "z", None)]
    current = frame(spark, [(1, "z", "old"), (3, "c", "kept"), (4, "d", "gone"), (5, "e", "old")])
    deleted = spark.createDataFrame([(4,), (5,), (77,)], "docid long")
    load = rows.unionByName(frame(spark, [(5, "e", "new", 0)], True))
    found = keyed.upsert(current, load, ["docid"], ["n"], deleted)
    assert sorted(map(tuple, found.collect())) == [(1, "a", "last"), (2, "y", "z"), (3, "c", "kept"), (5, "e", "new")]


def test_upsert_articles(spark, tmp_path):
    path = str(tmp_path / "articles")
    jobs.upsert_articles(spark, frame(spark, [(i, f"T{i % 3}", f"x{i}") for i in range(9)]), path, 4)
    before = S.read_articles(spark, path)
    jobs.upsert_articles(spark, frame(spark, [(2, "new", "a", 2), (2, "old", "b", 1), (9, "T9", None, 1)], True), path, 4, ["n"], spark.createDataFrame([(3,)], "docid long"))
    want = {i: (f"T{i % 3}", f"x{i}") for i in range(9) if i != 3} | {2: ("new", "a"), 9: ("T9", None)}
    assert {r.docid: (r.title, r.wikitext) for r in S.read_articles(spark, path).collect()} == want
    titles = S.read_titles(spark, path).select("title", "docid").collect()
    assert sorted(map(tuple, titles)) == sorted((t, i) for i, (t, _) in want.items())
    # who had read the table before goes on with the version it saw
    assert before.count() == 9
    assert versions.versions(spark, path) == [1, 2]
    for _ in range(2):
        jobs.upsert_articles(spark, frame(spark, []), path, 4)
    versions.drop_old(spark, path)
    assert versions.versions(spark, path) == [3, 4]
    assert S.read_articles(spark, path).count() == len(want)


def test_a_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "articles")
    jobs.upsert_articles(spark, frame(spark, [(1, "a", "b")]), path, 4)
    failing = frame(spark, [(1, "a", "c")]).withColumn("title", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        jobs.upsert_articles(spark, failing, path, 4)
    assert [r.wikitext for r in S.read_articles(spark, path).collect()] == ["b"]


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "table")
    write = lambda folder: spark.range(1).write.parquet(f"{folder}/index")
    with pytest.raises(FileExistsError):
        versions.publish(spark, path, lambda folder: (write(folder), versions.publish(spark, path, write)))
    assert versions.versions(spark, path) == [1]


TEXTS = [(i, " ".join(random.Random(i).choices(["hot"] * 9 + list("abcdefg"), k=i % 7))) for i in range(120)]
CHANGED = [(i, " ".join(random.Random(-i).choices(list("cdxyz"), k=i % 4))) for i in range(0, 150, 4)]
DELETED = [5, 7, 8, 119, 500]


def expected():
    """Postings after the changed documents were loaded and others deleted."""
    texts = {i: t for i, t in TEXTS if i not in DELETED} | dict(CHANGED)
    found = defaultdict(list)
    for docid, text in texts.items():
        for pos, word in enumerate(text.split()):
            if word != "a":
                found[word, docid].append(pos)
    return dict(found)


def as_dict(postings):
    rows = postings.collect()
    out = {(r.word, r.docid): list(r.occurences) for r in rows}
    assert len(out) == len(rows)
    return out


def articles(spark, texts):
    return spark.createDataFrame([(i, "t", t) for i, t in texts], ARTICLE)


TO_POSTINGS = {"postings": lambda df: df, "positions": I.positions_to_postings, "by_term": I.by_term_to_postings}


def check_dictionary(rows, width):
    want = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for (word, docid), places in expected().items():
        want[word][docid // width][0] += 1
        want[word][docid // width][1] += len(places)
    got = {r.word: {c.chunk: [c.documents, c.occurrences] for c in r.chunks} for r in rows}
    assert got == {w: dict(c) for w, c in want.items()}
    assert all((r.documents, r.occurrences) == tuple(map(sum, zip(*want[r.word].values()))) for r in rows)


@pytest.mark.parametrize("layout", list(schemas.LAYOUTS))
def test_upsert_index(spark, tmp_path, layout):
    path, words = str(tmp_path / "index"), stop(spark, "a")
    jobs.upsert_index(spark, articles(spark, TEXTS), words, layout, path, buckets=4, docids=16)
    load = articles(spark, CHANGED).withColumn("n", F.lit(2)).unionByName(articles(spark, [(i, "stale words") for i, _ in CHANGED]).withColumn("n", F.lit(1)))
    deleted = spark.createDataFrame([(i,) for i in DELETED], "docid long")
    jobs.upsert_index(spark, load, words, layout, path, buckets=4, order=["n"], deleted=deleted, docids=16)
    index = S.read_layout(spark, path, layout)
    assert as_dict(TO_POSTINGS[layout](index)) == expected()
    if layout == "by_term":
        keys = [(r.word, r.chunk) for r in index.collect()]
        assert len(keys) == len(set(keys))
    kept = S.read_dictionary(spark, path).select(*schemas.DICTIONARY.names).collect()
    check_dictionary(kept, 16)
    fresh = I.term_dictionary(index.select(*schemas.LAYOUTS[layout].names), 16).collect()
    assert sorted(map(str, fresh)) == sorted(map(str, kept))


def test_upsert_index_of_another_width(spark, tmp_path):
    path, words = str(tmp_path / "index"), stop(spark, "a")
    jobs.upsert_index(spark, articles(spark, TEXTS), words, "by_term", path, buckets=4, docids=16)
    with pytest.raises(ValueError, match="16|32"):
        jobs.upsert_index(spark, articles(spark, CHANGED), words, "by_term", path, buckets=4, docids=32)


def test_merges_of_replaced_documents(spark):
    words = stop(spark, "a")
    first, second = I.index_postings(articles(spark, TEXTS), words), I.index_postings(articles(spark, CHANGED), words)
    gone = spark.createDataFrame([(i,) for i in {*DELETED, *dict(CHANGED)}], "docid long")
    loaded = [articles(spark, TEXTS), gone]
    assert as_dict(I.by_term_to_postings(I.index_merge([first, second], 16, loaded))) == expected()
    assert as_dict(I.merge_postings([first, second], loaded)) == expected()
    by_term = [I.index_by_term(p, 16) for p in (first, second)]
    assert as_dict(I.by_term_to_postings(I.merge_by_term(by_term, 16, loaded))) == expected()
    with pytest.raises(ValueError):
        I.index_merge([first, second], 16, loaded[:1])
    # without the loaded documents, all postings stay
    assert I.merge_postings([first, second], [gone.limit(0)] * 2).count() == first.count() + second.count()


def test_merged_dictionaries(spark):
    words = stop(spark, "a")
    odd = [t for t in TEXTS if t[0] % 2]
    whole, part = (I.term_dictionary(I.index_postings(articles(spark, t), words), 16) for t in (TEXTS, odd))
    rest = I.term_dictionary(I.index_postings(articles(spark, [t for t in TEXTS if t[0] % 2 == 0]), words), 16)
    show = lambda df: sorted(map(str, df.collect()))
    assert show(I.merge_dictionaries([part, rest])) == show(whole)
    assert show(I.merge_dictionaries([whole], [part])) == show(rest)
    assert I.merge_dictionaries([whole], [whole]).count() == 0


@pytest.mark.parametrize("layout", ["postings", "by_term"])
def test_replaced_documents_are_a_list_of_known_size(spark, tmp_path, monkeypatch, layout):
    """So that Spark compares an index with it where its postings lie; the size of loaded rows may be unknown, and so very large."""
    words, path, sizes = stop(spark, "x"), str(tmp_path / "index"), []
    load = articles(spark, CHANGED).withColumn("n", F.lit(1))
    load = spark.createDataFrame(load.rdd, load.schema)
    name = "merge_by_term" if layout == "by_term" else "merge_postings"
    merge = getattr(jobs.I, name)

    def spied(*args):
        sizes.append(int(str(args[-1][-1]._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
        return merge(*args)

    monkeypatch.setattr(jobs.I, name, spied)
    for rows in (articles(spark, TEXTS), load):
        jobs.upsert_index(spark, rows, words, layout, path, buckets=4, docids=16)
    assert len(sizes) == 1 and sizes[0] < 100_000
