"""Runs of equal keys in Arrow batches, and the operators that are built on them."""

import glob
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from explain import plan_of

from wortfund.operators import index as I
from wortfund.operators import runs
from wortfund.sources import buckets as B

POSTINGS = "word string, docid long, occurences array<int>"
ROWS = [
    ("b", 7, [3, 4]), ("a", 7, [1]), ("a", 2, [9]), ("a", 2, [0, 5]), ("b", -3, [1]), (None, 2, [2]), ("a", None, [6]), ("a", 12, []), ("b", 7, [0]),
]


def low(value):
    return (value is not None, value)


def by_term(rows, width):
    lists = {}
    for word, docid, places in rows:
        lists.setdefault((word, None if docid is None else docid // width), []).append((docid, places))
    return {k: sorted(v, key=lambda e: (low(e[0]), e[1])) for k, v in lists.items()}


def collected(df):
    found = [((r.word, r.chunk), [(e.docid, e.occurences) for e in r.inv_index]) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def moves(df):
    return plan_of(df, "simple").split("== Initial Plan ==")[-1].count("Exchange ")


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(runs, "ROWS_AT_ONCE", 3)


def test_whole_runs(small):
    rows = [None] * 2 + ["a"] * 40 + ["b"] + ["c"] * 2 + [None]
    batches = [pa.record_batch([pa.array(rows[i : i + 2], pa.string())], names=["k"]) for i in range(0, len(rows), 2)]
    found = []
    for table, first in runs.whole_runs(iter(batches), ["k"]):
        ends = [*first[1:], len(table)]
        found += [(table["k"][int(a)].as_py(), b - a) for a, b in zip(first, ends)]
    assert found == [(None, 2), ("a", 40), ("b", 1), ("c", 2), (None, 1)]


def test_by_term_lists_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame(ROWS, POSTINGS)
    assert collected(I.index_by_term(df, 5)) == by_term(ROWS, 5)
    assert "ObjectHashAggregate" not in plan_of(I.index_by_term(df, 5))


def test_merge_puts_lists_together_once(spark):
    parts = [I.index_by_term(spark.createDataFrame(rows, POSTINGS), 5) for rows in (ROWS[::2], ROWS[1::2])]
    merged = I.merge_by_term(parts, 5, by=B.term_folders(5, 4))
    assert collected(merged) == by_term(ROWS, 5)
    assert set(merged.columns) == {"word", "chunk", "inv_index", "chunk_5", "bucket_word_4"}
    # the parts move once each, and their union once; before, the merge moved twice
    assert moves(merged) == 3


def test_positions_to_postings_of_repeated_and_null_keys(spark):
    rows = [("a", 1, 5), ("a", 1, 2), ("b", 1, 0), ("a", 1, 2), ("a", None, 3), (None, 1, 1), ("c", 4, None)]
    df = spark.createDataFrame(rows, "word string, docid long, occurence int").repartition(3)
    found = {(r.word, r.docid): r.occurences for r in I.positions_to_postings(df).collect()}
    assert found == {("a", 1): [2, 2, 5], ("b", 1): [0], ("a", None): [3], (None, 1): [1], ("c", 4): []}


@pytest.mark.parametrize("layout", ["postings", "positions", "by_term"])
def test_dictionary_moves_words_once(spark, layout):
    rows = ROWS[:3] + ROWS[4:6]
    index = spark.createDataFrame(rows, POSTINGS).repartition(3)
    index = {"postings": lambda df: df, "positions": I.postings_to_positions, "by_term": lambda df: I.index_by_term(df, 5)}[layout](index)
    dictionary = I.term_dictionary(index, 5)
    documents, occurrences = Counter((w, d // 5) for w, d, _ in rows), Counter()
    for w, d, places in rows:
        occurrences[w, d // 5] += len(places)
    found = {r.word: (r.documents, r.occurrences, [tuple(c) for c in r.chunks]) for r in dictionary.collect()}
    assert set(found) == {w for w, _ in documents}
    for word, (n, places, chunks) in found.items():
        expected = [(c, documents[w, c], occurrences[w, c]) for w, c in sorted(documents, key=lambda k: k[1]) if w == word]
        assert chunks == expected
        assert (n, places) == (sum(c[1] for c in chunks), sum(c[2] for c in chunks))
    # besides the one that deals out the rows above, and that of the by-term layout; before, two or three
    assert moves(dictionary) == (3 if layout == "by_term" else 2)


def test_dictionary_of_documents_taken_off(spark):
    kept, gone = (I.term_dictionary(spark.createDataFrame(rows, POSTINGS), 5) for rows in (ROWS[:3], ROWS[1:2]))
    found = {r.word: [tuple(c) for c in r.chunks] for r in I.merge_dictionaries([kept], [gone]).collect()}
    assert found == {"a": [(0, 1, 1)], "b": [(1, 1, 2)]}


def test_index_files_are_packed_close(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:3], POSTINGS)
    B.write_by_term(df, f"{tmp_path}/t", 5, 2)
    B.write_in_ranges(df, f"{tmp_path}/p", "word", 2, ["docid"])
    B.write_merged_by_term(I.index_by_term(df, 5), f"{tmp_path}/m", 5, 2)
    files = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
