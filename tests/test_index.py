"""Index layouts, their conversion, and words with very many postings."""

import random
from collections import defaultdict

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from explain import plan_of
from wortfund import schemas
from wortfund.operators import index as I
from wortfund.operators import keyed
from wortfund.plans import jobs
from wortfund.plans.registry import QUERIES
from wortfund.sources import lists


def articles(spark, texts):
    return spark.createDataFrame(texts, "docid long, wikitext string")


def stop(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def as_dict(postings):
    return {(r.word, r.docid): list(r.occurences) for r in postings.collect()}


def corpus(n=200, seed=3):
    rng = random.Random(seed)
    words = ["hot"] * 30 + [f"w{chr(97 + i)}" for i in range(20)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(n)]


def brute_force(texts, stopwords=()):
    found = defaultdict(list)
    for docid, text in texts:
        for pos, word in enumerate(text.split()):
            if word not in stopwords:
                found[word, docid].append(pos)
    return dict(found)


def names_and_types(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_positions_of_repeated_words(spark):
    text = "Rot und Blau und Gelb rot und Grau"
    found = as_dict(I.flatten_entries(articles(spark, [(4, text)])))
    assert found == {
        ("rot", 4): [0, 5],
        ("und", 4): [1, 3, 6],
        ("blau", 4): [2],
        ("gelb", 4): [4],
        ("grau", 4): [7],
    }


def test_repeated_words_beyond_ascii(spark):
    text = "Été žába ПИР été ŽÁBA пир été"
    found = as_dict(I.index_postings(articles(spark, [(5, text)]), stop(spark, "x")))
    assert found == {("été", 5): [0, 3, 6], ("žába", 5): [1, 4], ("пир", 5): [2, 5]}


def test_stop_words_leave_gaps(spark):
    rows = articles(spark, [(1, "a der b der c")])
    assert as_dict(I.index_postings(rows, stop(spark, "der"))) == {
        ("a", 1): [0],
        ("b", 1): [2],
        ("c", 1): [4],
    }


def test_stop_words_match_exactly(spark):
    rows = articles(spark, [(1, "Der der derb")])
    assert as_dict(I.index_postings(rows, stop(spark, "Der", "der."))) == {
        ("der", 1): [0, 1],
        ("derb", 1): [2],
    }


def test_articles_without_words(spark):
    rows = articles(spark, [(1, ""), (2, None), (3, "== x =="), (4, "der")])
    assert I.index_postings(rows, stop(spark, "der")).count() == 0
    assert I.index_positions(rows, stop(spark, "der")).count() == 0


def test_layouts_against_brute_force(spark):
    texts = corpus()
    rows, words = articles(spark, texts), stop(spark, "wa", "wb")
    expected = brute_force(texts, {"wa", "wb"})
    postings = I.index_postings(rows, words)
    positions = I.index_positions(rows, words)
    by_term = I.index_by_term(postings)
    assert as_dict(postings) == expected
    assert sorted(map(tuple, positions.collect())) == sorted(
        (w, d, p) for (w, d), places in expected.items() for p in places
    )
    assert by_term.count() == len({w for w, _ in expected})
    assert as_dict(I.by_term_to_postings(by_term)) == expected
    for row in by_term.collect():
        assert [e.docid for e in row.inv_index] == sorted(e.docid for e in row.inv_index)
    for name, df in {"postings": postings, "positions": positions, "by_term": by_term}.items():
        assert names_and_types(df.schema) == names_and_types(schemas.LAYOUTS[name])


def test_layouts_convert_into_each_other(spark):
    texts = corpus()
    postings = I.index_postings(articles(spark, texts), stop(spark, "wa"))
    expected = as_dict(postings)
    positions = I.postings_to_positions(postings)
    assert positions.count() == sum(map(len, expected.values()))
    assert as_dict(I.positions_to_postings(positions)) == expected
    by_term = I.postings_to_by_term(postings)
    assert as_dict(I.by_term_to_postings(by_term)) == expected
    assert as_dict(I.by_term_to_postings(I.positions_to_by_term(positions))) == expected
    again = I.positions_to_postings(I.by_term_to_positions(by_term))
    assert as_dict(again) == expected


@pytest.mark.parametrize("docids", [1, 7, 50])
def test_chunks_are_ranges_of_docids(spark, docids):
    texts = corpus()
    expected = brute_force(texts)
    postings = I.index_postings(articles(spark, texts), stop(spark, "x"))
    rows = I.index_by_term(postings, docids).collect()
    found = {(r.word, e.docid): list(e.occurences) for r in rows for e in r.inv_index}
    assert found == expected
    assert sum(len(r.inv_index) for r in rows) == len(expected)
    assert len(rows) == len({(w, d // docids) for w, d in expected})
    for r in rows:
        assert {e.docid // docids for e in r.inv_index} == {r.chunk}
        assert [e.docid for e in r.inv_index] == sorted(e.docid for e in r.inv_index)


def test_chunk_of_any_docid(spark):
    ids = [-(2**63) + 10, -7, -1, 0, 6, 7, 2**53 + 1, 2**63 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "docid long")
    found = [r.c for r in rows.select(I.chunk_of(F.col("docid"), 7).alias("c")).collect()]
    assert found == [i // 7 for i in ids]


def test_merge_of_partial_indexes(spark):
    texts = corpus()
    none = stop(spark, "x")
    parts = [
        I.index_postings(articles(spark, texts[:80]), none),
        I.index_postings(articles(spark, texts[80:]), none),
    ]
    expected = brute_force(texts)
    assert as_dict(I.by_term_to_postings(I.index_merge(parts))) == expected
    by_term = [I.index_by_term(part, 7) for part in parts]
    merged = I.merge_by_term(by_term)
    assert merged.count() == len({(w, d // 7) for w, d in expected})
    assert as_dict(I.by_term_to_postings(merged)) == expected


def test_postings_and_positions_need_no_shuffle(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scan = documents.selectExpr("doc_id AS docid", "text AS wikitext")
    words = lists.default_stopwords(spark)
    for build in (I.index_postings, I.index_positions):
        plan = plan_of(build(scan, words))
        assert "BroadcastHashJoin LeftAnti" in plan
        assert "hashpartitioning" not in plan
        assert "Python" not in plan


def test_by_term_reads_and_moves_the_postings_once(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scan = documents.selectExpr("doc_id AS docid", "text AS wikitext")
    plan = plan_of(jobs.build_index(scan, lists.default_stopwords(spark), "by_term"), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("documents.parquet") == 1


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        jobs.build_index(articles(spark, [(1, "a")]), stop(spark, "x"), "nope")


def test_upserts(spark):
    old = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (2, "b", "y")], schemas.ARTICLES
    )
    new = spark.createDataFrame([(2, None, "z"), (3, "c", "w")], schemas.ARTICLES)
    found = sorted(map(tuple, keyed.articles_upsert(old, new).collect()))
    assert found == [(1, "a", "x"), (2, None, "z"), (3, "c", "w")]
    old = spark.createDataFrame([("a", 1, [0]), ("b", 1, [1])], schemas.POSTINGS)
    new = spark.createDataFrame([("a", 1, [5, 6])], schemas.POSTINGS)
    found = as_dict(keyed.postings_upsert(old, new))
    assert found == {("a", 1): [5, 6], ("b", 1): [1]}
    old = spark.createDataFrame([("a", 1, 0), ("a", 1, 0)], schemas.POSITIONS)
    assert keyed.positions_upsert(old, old).count() == 1


def test_one_row_per_key(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, "a", "x"), (1, None, "z"), (2, None, None)], schemas.ARTICLES
    )
    found = sorted(map(tuple, keyed.one_row_per_key(rows, ["docid"]).collect()))
    assert found == [(1, "a", "x"), (2, None, None)]


def test_upsert_reduces_before_its_shuffle(spark):
    rows = spark.range(5).selectExpr("id AS docid", "'t' AS title", "'w' AS wikitext")
    plan = plan_of(keyed.articles_upsert(rows, rows))
    assert "partial_max" in plan and "LeftAnti" in plan


def test_merge_job(spark, tmp_path):
    texts, none = corpus(), stop(spark, "x")
    parts = [str(tmp_path / "a"), str(tmp_path / "b")]
    for part, some in zip(parts, (texts[::2], texts[1::2])):
        I.index_by_term(I.index_postings(articles(spark, some), none), 50).write.parquet(part)
    path = str(tmp_path / "all")
    jobs.merge_index(spark, parts, path, 2, 50)
    rows = spark.read.parquet(path)
    expected = brute_force(texts)
    assert as_dict(I.by_term_to_postings(rows)) == expected
    assert rows.count() == len({(w, d // 50) for w, d in expected})


def test_by_term_job(spark, tmp_path):
    path = str(tmp_path / "index")
    jobs.write_index(articles(spark, corpus()), stop(spark, "wa"), "by_term", path, "word", 2)
    found = as_dict(I.by_term_to_postings(spark.read.parquet(path)))
    assert found == brute_force(corpus(), {"wa"})


def test_entries_of_many_articles_come_by_word(monkeypatch):
    """However many words are sorted at a time; articles of one docid, or of none, stay apart."""
    words = [["b", "a", "b"], [], ["a"], ["é", "z", "é", "a"], ["b"], None]
    docids = [9, 3, None, 2, 9, 1]
    batch = pa.record_batch([pa.array(docids, pa.int64()), pa.array(words, pa.list_(pa.string()))], names=["docid", "words"])
    expected = [("b", 9, [0, 2]), ("a", 9, [1]), ("a", None, [0]), ("a", 2, [3]), ("z", 2, [1]), ("é", 2, [0, 2]), ("b", 9, [0])]
    for most in (1 << 20, 3, 1):
        monkeypatch.setattr(I, "TOKENS_AT_ONCE", most)
        parts = [part.to_pylist() for part in I._entries([batch])]
        found = [(r["word"], r["docid"], r["occurences"]) for part in parts for r in part]
        assert sorted(found, key=str) == sorted(expected, key=str)
        for part in parts:
            assert [r["word"] for r in part] == sorted((r["word"] for r in part), key=str.encode)
        assert len(parts) == 1 or most < 4
    assert list(I._entries([batch.slice(1, 1)])) == []


def test_replaced_docids_leave_the_postings_in_place(spark, tmp_path):
    """The loaded pages are too large to broadcast, the list of their docids is not: postings move once, by word."""
    rng = random.Random(19)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(150)) for _ in range(300)]
    rows = [(i, text, f"<title>t</title> {text}") for i, text in enumerate(texts)]
    tables = spark.createDataFrame(rows, "id long, text string, html string")
    tables.select(F.col("id").alias("doc_id"), "text").write.parquet(f"{tmp_path}/documents.parquet")
    tables.where("id < 100").select(F.col("id").alias("page_id"), "html").write.parquet(f"{tmp_path}/pages.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "24k")
    try:
        found = QUERIES["index_merge_replaced"](spark, str(tmp_path))
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        entries = found.select("word", F.explode(F.split("inv_index", ";")).alias("entry"))
        docids = {int(row.entry.split(":")[0]) for row in entries.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert docids == {i for i in range(300) if i < 100 or i % 10 != 3}
