"""Lookups, single and in batches, on plain and on bucketed tables."""

import glob
import re
from collections import Counter

import pyarrow.parquet as pq

import pytest
from pyspark.sql import functions as F

from explain import plan_of
from wortfund import schemas
from wortfund.operators import index as I
from wortfund.operators import lookup as L
from wortfund.plans import jobs
from wortfund.sources import buckets as B
from wortfund.sources import tables as S
from wortfund.sources.buckets import CHUNK_FOLDERS, write_bucketed, write_by_term, write_merged_by_term

TEXTS = [(1, "a b a"), (2, "b c"), (3, "a c c"), (4, ""), (5, "b")]


@pytest.fixture
def articles(spark):
    rows = [(i, f"T{i % 2}" if i != 5 else "O'Neill", text) for i, text in TEXTS]
    return spark.createDataFrame(rows, schemas.ARTICLES)


@pytest.fixture
def postings(spark, articles):
    return I.index_postings(articles, spark.createDataFrame([("x",)], "word string"))


def test_articles(spark, articles):
    assert {r.docid for r in L.lookup_title(articles, "T1").collect()} == {1, 3}
    assert [r.docid for r in L.lookup_title(articles, "O'Neill").collect()] == [5]
    assert [r.docid for r in L.lookup_title_bound(spark, articles, "O'Neill").collect()] == [5]
    assert L.lookup_title_bound(spark, articles, "x' OR '1'='1").count() == 0
    assert [r.wikitext for r in L.lookup_docid(articles, 2).collect()] == ["b c"]
    assert L.lookup_docid(articles, 99).count() == 0


def test_index_layouts(postings):
    positions = I.postings_to_positions(postings)
    by_term = I.index_by_term(postings)
    assert {r.word for r in L.lookup_doc_words(postings, 1).collect()} == {"a", "b"}
    assert L.lookup_doc_words(positions, 1).count() == 3
    # "b" is found for document 2 although its list starts with document 1.
    assert {r.word for r in L.lookup_doc_words_by_term(by_term, 2).collect()} == {"b", "c"}
    assert {r.docid for r in L.lookup_word_docs(postings, "c").collect()} == {2, 3}
    assert L.lookup_word_docs(positions, "c").count() == 3
    (row,) = L.lookup_word_docs(by_term, "c").collect()
    assert [e.docid for e in row.inv_index] == [2, 3]
    assert L.lookup_word_docs(by_term, "zzz").count() == 0
    assert L.lookup_counts(positions, "word", "a").first().n == 3


def test_batches_agree_with_single_lookups(spark, articles, postings):
    words = spark.createDataFrame([(w,) for w in ["a", "b", "zzz", "a"]], "word string")
    found = {r.word: r.n for r in L.batch_lookup_word_docs(postings, words).collect()}
    assert found == {w: L.lookup_word_docs(postings, w).count() for w in ["a", "b", "zzz"]}
    ids = spark.createDataFrame([(i,) for i in [1, 4, 9, 1]], "docid long")
    found = {r.docid: r.n for r in L.batch_lookup_doc_words(postings, ids).collect()}
    assert found == {1: 2, 4: 0, 9: 0}
    by_term = I.index_by_term(postings)
    assert {
        r.docid: r.n for r in L.batch_lookup_doc_words_by_term(by_term, ids).collect()
    } == found
    found = {r.docid: r.n for r in L.batch_lookup_docid(articles, ids).collect()}
    assert found == {1: 1, 4: 1, 9: 0}
    titles = spark.createDataFrame([("T1",), ("O'Neill",), ("none",)], "title string")
    found = {r.title: r.n for r in L.batch_lookup_title(articles, titles).collect()}
    assert found == {"T1": 2, "O'Neill": 1, "none": 0}


def test_whole_run(spark, articles, postings):
    keys = {
        "titles": spark.createDataFrame([("T0",)], "title string"),
        "article_ids": spark.createDataFrame([(3,)], "docid long"),
        "index_ids": spark.createDataFrame([(3,)], "docid long"),
        "words": spark.createDataFrame([("b",)], "word string"),
    }
    found = {(r.lookup, r.key): r.n for r in jobs.run_lookups(articles, postings, keys).collect()}
    assert found == {
        ("title", "T0"): 2,
        ("docid", "3"): 1,
        ("doc_words", "3"): 2,
        ("word_docs", "b"): 3,
    }


def test_bucketed_tables_read_one_folder(spark, postings, tmp_path):
    by_word, by_doc = str(tmp_path / "word"), str(tmp_path / "docid")
    write_bucketed(postings, by_word, "word", 16)
    write_bucketed(postings, by_doc, "docid", 16)
    index = spark.read.parquet(by_word)
    found = L.lookup_word_docs(index, "c")
    assert {r.docid for r in found.collect()} == {2, 3}
    assert found.columns == ["word", "docid", "occurences"]
    assert "bucket_word_16" in plan_of(found).split("PartitionFilters:")[1].split("\n")[0]
    assert "EqualTo(word,c)" in plan_of(found)
    # An int literal finds the folder of a long column.
    found = L.lookup_doc_words(spark.read.parquet(by_doc), 1)
    assert Counter(r.word for r in found.collect()) == {"a": 1, "b": 1}
    assert "bucket_docid_16" in plan_of(found).split("PartitionFilters:")[1].split("\n")[0]
    words = spark.createDataFrame([("a",), ("c",), ("zzz",)], "word string")
    batch = L.batch_lookup_word_docs(index, words)
    assert {r.word: r.n for r in batch.collect()} == {"a": 2, "c": 2, "zzz": 0}


def test_hot_key_is_counted_before_it_moves(spark, postings):
    words = spark.createDataFrame([("a",)], "word string")
    assert "partial_count" in plan_of(L.batch_lookup_word_docs(postings, words))


def test_rows_of_a_large_folder_come_back_whole(spark, tmp_path):
    # A third of the rows has one word; small targets make Spark split its folder.
    rows = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('w', id % 997)) AS word",
        "id AS docid",
        "array(0) AS occurences",
    )
    path = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        write_bucketed(rows, path, "word", 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    index = spark.read.parquet(path)
    assert index.count() == 30_000
    hot = L.lookup_word_docs(index, "hot")
    assert hot.count() == 10_000
    files = hot.select(F.input_file_name()).distinct().count()
    assert files > 1


def filters_of(plan, kind):
    """What the scans of a formatted plan filter by."""
    return re.findall(rf"{kind}: \[(.*?)\]\n", plan)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """500 articles in a keyed table, an index of them by word, one by term and its dictionary."""
    root = tmp_path_factory.mktemp("kept")
    rows = spark.range(500).selectExpr(
        "id AS docid", "concat('T', id % 250) AS title", "concat('hot w', id % 50, ' v', id) AS wikitext"
    ).withColumn("wikitext", F.translate("wikitext", "0123456789", "abcdefghij"))
    paths = {name: str(root / name) for name in ("articles", "postings", "by_term", "docid")}
    stop = spark.createDataFrame([("x",)], "word string")
    jobs.upsert_articles(spark, rows, paths["articles"], 8)
    jobs.upsert_index(spark, rows, stop, "postings", paths["postings"], buckets=8)
    jobs.write_index(rows, stop, "by_term", paths["by_term"], "word", 4, docids=100)
    jobs.write_index(rows, stop, "postings", paths["docid"], "docid", 8)
    return paths


def key_file(spark, path, column, values):
    """Keys as the lookup run reads them: from a file."""
    spark.createDataFrame([(str(v),) for v in values], "value string").write.text(path)
    kind = "long" if column == "docid" else "string"
    return spark.read.text(path).select(F.col("value").cast(kind).alias(column))


def test_title_lookup_by_its_index(spark, kept):
    articles, titles = S.read_articles(spark, kept["articles"]), S.read_titles(spark, kept["articles"])
    found = L.lookup_title(articles, "T7", titles)
    assert found.columns == ["docid", "title", "wikitext"]
    assert sorted(r.docid for r in found.collect()) == [7, 257]
    plan = plan_of(found)
    assert "EqualTo(title,T7)" in plan
    partition = filters_of(plan, "PartitionFilters")
    assert any("bucket_title_8" in f and "=" in f for f in partition)
    assert any("bucket_docid_8" in f and "dynamicpruning" in f for f in partition)
    assert L.lookup_title(articles, "nope", titles).count() == 0
    assert L.lookup_title(articles, "T7").count() == 2


@pytest.mark.parametrize("kind", ["title", "docid", "doc_words", "word_docs", "word_counts", "by_term"])
def test_batches_prune_folders_while_they_run(spark, kept, tmp_path, kind):
    lookups = {
        "title": (L.batch_lookup_title, lambda: S.read_titles(spark, kept["articles"]), "title", {"T7": 2, "T9": 2, "no": 0}),
        "docid": (L.batch_lookup_docid, lambda: S.read_articles(spark, kept["articles"]), "docid", {7: 1, 499: 1, 500: 0}),
        "doc_words": (L.batch_lookup_doc_words, lambda: S.read_layout(spark, kept["docid"], "postings"), "docid", {7: 3, 500: 0}),
        "word_docs": (L.batch_lookup_word_docs, lambda: S.read_layout(spark, kept["postings"], "postings"), "word", {"hot": 500, "wab": 0, "wc": 10}),
        "word_counts": (L.batch_lookup_word_counts, lambda: S.read_dictionary(spark, kept["postings"]), "word", {"hot": 500, "wab": 0, "wc": 10}),
        "by_term": (L.batch_lookup_doc_words_by_term, lambda: S.read_layout(spark, kept["by_term"], "by_term"), "docid", {7: 3, 250: 3, 500: 0}),
    }
    lookup, table, column, want = lookups[kind]
    keys, rows = key_file(spark, str(tmp_path / "keys"), column, [*want, *want]), table()
    spark.sparkContext.setJobGroup(f"planning {kind}", "planning")
    found = lookup(rows, keys)
    plan = plan_of(found)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"planning {kind}")) == 0
    assert "dynamicpruning" in " ".join(filters_of(plan, "PartitionFilters"))
    assert {r[0]: r.n for r in found.collect()} == want
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_keys_are_read_once(spark, kept, tmp_path):
    keys = key_file(spark, str(tmp_path / "keys"), "docid", range(0, 500, 7))
    found = L.batch_lookup_docid(S.read_articles(spark, kept["articles"]), keys)
    assert sum(r.n for r in found.collect()) == 72
    final = plan_of(found, "simple").split("== Initial Plan ==")[0]
    # the distinct keys are shuffled once; their other uses read what that wrote
    assert final.count("FileScan text") == 1
    assert "ReusedExchange" in final


def test_keys_of_any_kind_of_table(spark, kept):
    articles = S.read_articles(spark, kept["articles"])
    # an int finds the folder of a long; null is no key
    for keys in (spark.createDataFrame([(7,), (None,)], "docid int"), spark.range(7, 8).toDF("docid")):
        assert {r.docid: r.n for r in L.batch_lookup_docid(articles, keys).collect()} == {7: 1}
    none = spark.createDataFrame([], "docid long")
    assert L.batch_lookup_docid(articles, none).count() == 0


def test_counts_from_the_dictionary(spark, kept):
    dictionary = S.read_dictionary(spark, kept["postings"])
    index = S.read_layout(spark, kept["postings"], "postings")
    for word in ("hot", "wc", "nope"):
        found = L.lookup_word_count(dictionary, word)
        assert found.first().n == L.lookup_counts(index, "word", word).first().n
        assert found.first().occurrences == found.first().n
    plan = plan_of(L.lookup_word_count(dictionary, "hot"))
    assert "bucket_word_8" in filters_of(plan, "PartitionFilters")[0] and "EqualTo(word,hot)" in plan
    assert L.lookup_equals(dictionary, "word", "hot").count() == 1


def test_by_term_lookup_reads_one_chunk(spark, kept):
    index = S.read_layout(spark, kept["by_term"], "by_term")
    found = L.lookup_doc_words_by_term(index, 257)
    assert found.columns == ["word", "chunk", "inv_index"]
    assert sorted(r.word for r in found.collect()) == ["hot", "vcfh", "wh"]
    assert {r.chunk for r in found.collect()} == {2}
    assert "chunk_100" in filters_of(plan_of(found), "PartitionFilters")[0]
    files = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("chunk_100=2/" in r.f for r in files)
    word = L.lookup_word_docs(index, "hot")
    assert sorted(r.chunk for r in word.collect()) == [0, 1, 2, 3, 4]
    assert "bucket_word_4" in filters_of(plan_of(word), "PartitionFilters")[0]


def test_by_term_of_any_width_answers_right(spark, kept, postings, tmp_path):
    index = S.read_layout(spark, kept["by_term"], "by_term")
    with pytest.raises(ValueError, match="100"):
        L.lookup_doc_words_by_term(index, 257, 50)
    plain = I.index_by_term(postings, 2)
    for i in range(1, 6):
        want = {r.word for r in L.lookup_doc_words(postings, i).collect()}
        assert {r.word for r in L.lookup_doc_words_by_term(plain, i).collect()} == want
        assert {r.word for r in L.lookup_doc_words_by_term(plain, i, 2).collect()} == want


def test_negative_docids_by_term(spark, tmp_path):
    rows = spark.createDataFrame([("a", -7, [0]), ("a", -1, [1]), ("b", 3, [2])], schemas.POSTINGS)
    write_by_term(rows, str(tmp_path / "index"), 5, 2)
    index = S.read_layout(spark, str(tmp_path / "index"), "by_term")
    assert {i: [r.word for r in L.lookup_doc_words_by_term(index, i).collect()] for i in (-7, -1, 3, 4)} == {-7: ["a"], -1: ["a"], 3: ["b"], 4: []}
    keys = spark.createDataFrame([(-7,), (3,), (4,)], "docid long")
    assert {r.docid: r.n for r in L.batch_lookup_doc_words_by_term(index, keys).collect()} == {-7: 1, 3: 1, 4: 0}


def test_index_files_of_a_folder_do_not_overlap(spark, tmp_path):
    """But in a word that is cut at their border, as one with very many rows is more than once."""
    rows = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('w', id % 2997)) AS word", "id AS docid", "array(0) AS occurences"
    )
    path = str(tmp_path / "index")
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        S.write_layout(rows, "postings", path, "word", 4)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cut = 0
    for folder in glob.glob(f"{path}/bucket_word_4=*"):
        ranges = []
        for file in glob.glob(f"{folder}/*.parquet"):
            words = pq.read_table(file, columns=["word"])["word"].to_pylist()
            assert words == sorted(words)
            ranges.append((words[0], words[-1]))
        ranges.sort()
        for (_, last), (first, _) in zip(ranges, ranges[1:]):
            # a word may be cut at a border of files
            assert last <= first
            cut += last == first == "hot"
    assert cut > 1
    index = S.read_layout(spark, path, "postings")
    assert index.count() == 60_000
    assert L.lookup_word_docs(index, "hot").count() == 20_000
    opened = L.lookup_word_docs(index, "w10").select(F.input_file_name()).distinct().count()
    assert opened <= 2


def test_by_term_write_moves_postings_once(spark):
    from wortfund.sources import buckets

    order = ["chunk_5", "bucket_word_2", "word"]
    rows = spark.range(100).selectExpr("concat('w', id % 9) AS word", "id AS docid")
    keyed = rows.select((F.col("docid") % 5).alias("chunk_5"), buckets.bucket_of(F.col("word"), 2).alias("bucket_word_2"), "word", "docid")
    plan = plan_of(keyed.repartitionByRange(*order).groupBy(*order).agg(F.collect_list("docid")), "simple")
    assert plan.count("Exchange") == 1


def test_narrow_chunks_share_folders(spark, tmp_path):
    """Chunks are as many as the documents allow, folders are not; a lookup of a document still reads its chunk alone."""
    rows = spark.range(1000).selectExpr("concat('w', id % 3) AS word", "id - 100 AS docid", "array(0) AS occurences")
    written, merged = str(tmp_path / "written"), str(tmp_path / "merged")
    write_by_term(rows, written, 5, 2)
    write_merged_by_term(I.index_by_term(rows, 5), merged, 5, 2)
    for path in (written, merged):
        assert len(glob.glob(f"{path}/chunk_5=*")) == CHUNK_FOLDERS
        index = S.read_layout(spark, path, "by_term")
        assert index.count() == index.select("word", "chunk").distinct().count() == 600
        assert sorted(I.by_term_to_postings(index).collect()) == sorted(rows.collect())
        # 32 and 64 chunks from it lie in the same folder
        found = L.lookup_doc_words_by_term(index, 7)
        assert [(r.word, r.chunk) for r in found.collect()] == [("w2", 1)]
        assert "EqualTo(chunk,1)" in plan_of(found)
        keys = spark.createDataFrame([(-7,), (7,), (167,), (5000,)], "docid long")
        assert {r.docid: r.n for r in L.batch_lookup_doc_words_by_term(index, keys).collect()} == {-7: 1, 7: 1, 167: 1, 5000: 0}


def counted(spark, rows):
    """The rows, and a counter of how often one was computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return rows.mapInArrow(count, rows.schema), seen


def test_by_term_write_computes_postings_once(spark, tmp_path):
    rows, seen = counted(spark, spark.range(6000).selectExpr("concat('w', id % 7) AS word", "id AS docid", "array(0) AS occurences"))
    path = str(tmp_path / "index")
    write_by_term(rows, path, 50, 2)
    assert seen.value == 6000
    # a folder is one file, by chunk and word
    for folder in glob.glob(f"{path}/chunk_50=*/bucket_word_2=*"):
        (file,) = glob.glob(f"{folder}/*.parquet")
        found = pq.read_table(file, columns=["chunk", "word"]).to_pylist()
        assert found == sorted(found, key=lambda r: (r["chunk"], r["word"]))
    assert S.read_layout(spark, path, "by_term").count() == 120 * 7


@pytest.mark.parametrize("layout", ["postings", "positions"])
def test_index_write_draws_borders_from_few_articles(spark, tmp_path, monkeypatch, layout):
    """The articles are tokenized once and a small share of them once more; files still do not overlap, and a hot word is cut."""
    for name, value in (("RANGE_BYTES", 4000), ("SAMPLE_BYTES", 10_000), ("SAMPLE_ARTICLES", 40), ("KEYS_A_BORDER", 100)):
        monkeypatch.setattr(jobs, name, value)
    texts = [(None if i == 7 else i, "hot " + " ".join(f"w{chr(97 + (i * k) % 23)}{chr(97 + k)}" for k in range(i % 9))) for i in range(3000)]
    articles = spark.createDataFrame(texts, "docid long, wikitext string")
    stop = spark.createDataFrame([("wab",)], "word string")
    seen = []

    def build(some, words, of):
        rows, count = counted(spark, index_of(some, words, of))
        seen.append(count)
        return rows

    index_of = jobs.build_index
    monkeypatch.setattr(jobs, "build_index", build)
    path = str(tmp_path / "index")
    jobs.write_index(articles, stop, layout, path, "word", 4)
    expected = index_of(articles, stop, layout)
    index = spark.read.parquet(path).drop("bucket_word_4")
    assert sorted(map(str, index.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    n = expected.count()
    assert n <= sum(c.value for c in seen) < 1.5 * n
    cut = 0
    for folder in glob.glob(f"{path}/bucket_word_4=*"):
        ranges = []
        for file in glob.glob(f"{folder}/*.parquet"):
            keys = [(r["word"], -1 if r["docid"] is None else r["docid"]) for r in pq.read_table(file, columns=["word", "docid"]).to_pylist()]
            assert keys == sorted(keys)
            ranges.append((keys[0], keys[-1]))
        ranges.sort()
        for (_, last), (first, _) in zip(ranges, ranges[1:]):
            assert last < first
            cut += last[0] == first[0] == "hot"
    assert cut


def test_borders_are_searched_by_halves(spark):
    """As many borders are passed as a plain search says, keys that are null in part included, without an interpreted expression."""
    low = lambda key: [(v is not None, v.encode() if isinstance(v, str) else v) for v in key]
    words = ["", "a", "b", "ä", "b\U0001f600", "z"]
    keys = [(word, docid) for word in words for docid in (None, -3, 0, 7, 8)]
    for n in (0, 1, 2, 3, 4, 7, 20):
        own = sorted(keys[:: max(1, len(keys) // n)][:n] if n else [], key=low)
        rows = spark.createDataFrame([(*key, own) for key in keys], "word string, docid long, own array<struct<word: string, docid: long>>")
        found = B._with_passed(rows, F.struct("word", "docid"), len(own))
        assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()
        for row in found.collect():
            assert row.passed == sum(low(border) <= low((row.word, row.docid)) for border in own)
