"""Exact-match lookups: one key, or a whole table of keys in one job."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wortfund.operators.index import chunk_of
from wortfund.sources.buckets import CHUNK_FOLDERS, bucket_columns, chunk_folder, key_set, prune_to_key, prune_to_keys


def lookup_equals(table: DataFrame, column: str, value) -> DataFrame:
    """Rows with this value. The value is a literal, never text spliced into a condition."""
    rows = prune_to_key(table, column, value).where(F.col(column) == F.lit(value))
    return rows.drop(*bucket_columns(rows))


def lookup_title(articles: DataFrame, title: str, titles: DataFrame | None = None) -> DataFrame:
    """Articles with exactly this title. With `titles`, a table (title, docid) in folders by title, the docids come from
    there, one folder, and only the articles' folders of those docids are read."""
    if titles is None:
        return lookup_equals(articles, "title", title)
    return batch_rows(articles, lookup_equals(titles, "title", title), "docid")


def lookup_title_bound(spark, articles: DataFrame, title: str) -> DataFrame:
    """The same through SQL with a bound parameter; quotes in the title are harmless."""
    return spark.sql(
        "SELECT * FROM {articles} WHERE title = :title", args={"title": title}, articles=articles
    )


def lookup_docid(articles: DataFrame, docid: int) -> DataFrame:
    return lookup_equals(articles, "docid", docid)


def lookup_doc_words(index: DataFrame, docid: int) -> DataFrame:
    """All words of a document. Postings: a row per distinct word; positions: per occurrence."""
    return lookup_equals(index, "docid", docid)


def by_term_width(by_term: DataFrame) -> tuple[str, int] | None:
    """The chunk folder's column of a stored by-term index, and the width that its name tells."""
    for name in by_term.columns:
        if found := re.fullmatch(r"chunk_(\d+)", name):
            return name, int(found[1])
    return None


def lookup_doc_words_by_term(
    by_term: DataFrame, docid: int, docids: int | None = None
) -> DataFrame:
    """By-term rows that hold the document at any place of their list.

    A stored index tells the width of its chunks, and of the folder of the document's chunk only this is read. Of any other table all
    rows are looked at, unless `docids` gives its width; a width that a stored index does not have is an error.
    """
    holds = F.array_contains(F.col("inv_index.docid"), F.lit(docid).cast("long"))
    stored = by_term_width(by_term)
    if stored is not None:
        name, width = stored
        if docids not in (None, width):
            raise ValueError(f"the index is cut at {width} docids, not {docids}")
        chunk = docid // width
        rows = by_term.where(F.col(name) == F.lit(chunk % CHUNK_FOLDERS)).where(F.col("chunk") == F.lit(chunk)).where(holds)
        return rows.drop(*bucket_columns(rows))
    if docids is not None:
        holds = (F.col("chunk") == F.lit(docid // docids).cast("long")) & holds
    return by_term.where(holds)


def lookup_word_docs(index: DataFrame, word: str) -> DataFrame:
    """All documents with a word: a row per document, per occurrence, or one list, by layout."""
    return lookup_equals(index, "word", word)


def lookup_counts(table: DataFrame, column: str, value) -> DataFrame:
    """The number of rows that match, as one row."""
    return lookup_equals(table, column, value).agg(F.count("*").alias("n"))


def lookup_word_count(dictionary: DataFrame, word: str) -> DataFrame:
    """(n, occurrences): in how many documents a word stands and how often, from its one row of the term dictionary; 0 for a
    word that it does not hold."""
    found = lookup_equals(dictionary, "word", word)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return found.agg(total("documents").alias("n"), total("occurrences").alias("occurrences"))


def batch_lookup_word_counts(dictionary: DataFrame, words: DataFrame) -> DataFrame:
    """(word, n) for every distinct word of the list, from the term dictionary: no postings are read."""
    keys = key_set(dictionary, words, "word")
    found = prune_to_keys(dictionary, keys, "word").select("word", "documents")
    n = F.coalesce("documents", F.lit(0)).cast("long").alias("n")
    return keys.join(found, "word", "left").select("word", n)


def batch_rows(table: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows of `table` whose `column` is among the keys."""
    keys = key_set(table, keys, column)
    rows = prune_to_keys(table, keys, column).join(keys, column, "left_semi")
    return rows.select(*table.drop(*bucket_columns(table)).columns)


def batch_counts(table: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """(key, n) for every distinct key, 0 where nothing matches.

    The table is only filtered, and counted before anything moves, so a key that holds a large
    share of the rows costs one row per task.
    """
    found = batch_rows(table, keys, column).groupBy(column).agg(F.count("*").alias("found"))
    n = F.coalesce("found", F.lit(0)).cast("long").alias("n")
    return key_set(table, keys, column).join(found, column, "left").select(column, n)


def batch_lookup_title(articles: DataFrame, titles: DataFrame) -> DataFrame:
    """`articles`, or better the table (title, docid) in folders by title that is kept with them."""
    return batch_counts(articles, titles, "title")


def batch_lookup_docid(articles: DataFrame, docids: DataFrame) -> DataFrame:
    return batch_counts(articles, docids, "docid")


def batch_lookup_doc_words(index: DataFrame, docids: DataFrame) -> DataFrame:
    return batch_counts(index, docids, "docid")


def batch_lookup_word_docs(index: DataFrame, words: DataFrame) -> DataFrame:
    return batch_counts(index, words, "word")


def batch_lookup_doc_words_by_term(by_term: DataFrame, docids: DataFrame) -> DataFrame:
    """(docid, n): number of distinct words per document, from the by-term layout."""
    stored = by_term_width(by_term)
    if stored is not None:
        # only the chunk folders of the keys, found while the job runs, if Spark finds the chunk numbers small enough
        name, width = stored
        keys = key_set(by_term.select(F.lit(0).cast("long").alias("docid")), docids, "docid")
        chunk = chunk_folder(chunk_of(F.col("docid"), width)).cast(by_term.schema[name].dataType).alias(name)
        chunks = keys.groupBy(chunk).agg(F.count("*").alias("keys")).where(F.col("keys") > 0).select(name)
        by_term = by_term.join(chunks, name, "left_semi")
    entries = by_term.select("word", F.explode("inv_index.docid").alias("docid"))
    return batch_counts(entries, docids, "docid")
