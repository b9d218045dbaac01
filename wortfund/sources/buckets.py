"""Parquet tables split into folders by a hash of one column, and the matching pruning.

A table written here has a partition column named bucket_<column>_<n>; a by-term index has another one before it, chunk_<width>, the
chunk modulo CHUNK_FOLDERS. Spark cannot derive the folder from a condition on the column itself, so the lookups add it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wortfund.operators.index import chunk_of, put_in_lists
from wortfund.session import drop_shuffles

#: Of the files, which are several times smaller with it than the shuffles that make them.
COMPRESSION = "zstd"

#: Folders by chunk of a by-term index, at most: narrow chunks are as many as the documents allow, and every folder is a file or more.
CHUNK_FOLDERS = 32


def bucket_of(value: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n)).cast("int")


def chunk_folder(chunk: Column) -> Column:
    """The folder of a chunk; the rows in it lie by chunk."""
    return F.pmod(chunk, F.lit(CHUNK_FOLDERS).cast("long"))


def write_bucketed(df: DataFrame, path: str, column: str, n: int, mode: str = "append") -> None:
    """Write `df` in `n` folders by the hash of `column`, each file sorted by it.

    The rebalance hint lets Spark cut a folder whose rows are too many for one task into several
    files, and put small ones together; a key with very many rows spreads over several tasks.
    """
    name = f"bucket_{column}_{n}"
    (
        df.withColumn(name, bucket_of(F.col(column), n))
        .hint("rebalance", name)
        .sortWithinPartitions(name, column)
        .write.mode(mode)
        .partitionBy(name)
        .parquet(path, compression=COMPRESSION)
    )
    drop_shuffles(df.sparkSession)


def _ranges(sample: DataFrame, order: list[str], n: int, ranges: int) -> tuple[DataFrame, int]:
    """(folder, before, own): the borders in each of the `n` folders and how many lie in the folders before it; borders cut `sample`
    into that many ranges of `order`, whose first column is the folder, or into fewer ones. And how many a folder has at most."""
    low = lambda key: [(v is not None, v.encode() if isinstance(v, str) else v) for v in key]
    keys = sorted((tuple(row) for row in sample.select(*order).collect()), key=low)
    borders = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)} if keys else (), key=low)
    rows, before = [], 0
    for folder in range(n):
        own = [key[1:] for key in borders if key[0] == folder]
        rows.append((folder, before, own))
        before += len(own)
    key = ", ".join(f"{sample.schema[c].name}: {sample.schema[c].dataType.simpleString()}" for c in order[1:])
    borders = sample.sparkSession.createDataFrame(rows, f"{order[0]} int, before int, own array<struct<{key}>>")
    return borders, max(len(own) for _, _, own in rows)


def _with_passed(rows: DataFrame, key: Column, longest: int) -> DataFrame:
    """`rows` with `passed`, how many of the sorted `own` borders, `longest` at most, are not above the key.

    A binary search with a column for each of its steps, so that it is compiled and costs the same few comparisons whatever the number
    of borders; a lambda expression would be interpreted for each row and border.
    """
    rows = rows.withColumn("key", key).withColumn("passed", F.lit(0))
    for step in reversed([1 << i for i in range(longest.bit_length())]):
        border = F.get("own", F.col("passed") + F.lit(step - 1))
        rows = rows.withColumn("passed", F.col("passed") + F.when(border <= F.col("key"), step).otherwise(0))
    return rows


def write_in_ranges(
    df: DataFrame,
    path: str,
    column: str,
    n: int,
    then: list[str],
    mode: str = "append",
    sample: DataFrame | None = None,
    ranges: int = 0,
) -> None:
    """The same with files that hold ranges of (folder, column, *then): those of a folder do not overlap but in a key that
    is cut between them, so a lookup opens only the files of its key.

    A key with very many rows is cut by the columns `then`. Spark draws the borders from a sample of the rows, for which it computes
    them once more, and puts ranges together that are small. With `sample`, a few of the rows that the driver can hold, the
    borders of so many `ranges` are drawn from these, and `df` is computed once.
    """
    name = f"bucket_{column}_{n}"
    order = [name, column, *then]
    rows = df.withColumn(name, bucket_of(F.col(column), n))
    if sample is None or ranges < 1:
        cut = rows.repartitionByRange(*order)
    else:
        borders, longest = _ranges(sample.withColumn(name, bucket_of(F.col(column), n)), order, n, ranges)
        passed = _with_passed(rows.join(F.broadcast(borders), name), F.struct(column, *then), longest)
        # partition numbers, which no shuffle puts together in another order
        cut = passed.repartitionById(ranges, F.col("before") + F.col("passed")).select(*rows.columns)
    (
        cut.sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy(name)
        .parquet(path, compression=COMPRESSION)
    )
    drop_shuffles(df.sparkSession)


def write_by_term(
    postings: DataFrame, path: str, docids: int, buckets: int, mode: str = "append"
) -> None:
    """Write postings in layout "by term": folders by chunk of docids, chunk_<docids>=..., and by word, in them by chunk and word.

    Postings are moved once, and computed once: a folder is put together by its numbers, which keeps a word and chunk together too and
    needs no borders drawn. So a folder is one sorted file, of one task: its share of the postings of the chunks in it. A further load
    of the same documents, or of others in the same chunks, goes in by a merge, since this appends rows.
    """
    folders = term_folders(docids, buckets)
    order = [*folders, "chunk", "word"]
    keyed = postings.select("word", chunk_of(F.col("docid"), docids).alias("chunk"), "docid", "occurences").withColumns(folders)
    rows = put_in_lists(keyed.repartition(*folders), order)
    # as they lie already; Spark sorts by folder what does not tell so
    rows.sortWithinPartitions(*order).write.mode(mode).partitionBy(*folders).parquet(path, compression=COMPRESSION)
    drop_shuffles(postings.sparkSession)


def term_folders(docids: int, buckets: int) -> dict[str, Column]:
    """The columns of the folders of a by-term index, from word and chunk."""
    return {f"chunk_{docids}": chunk_folder(F.col("chunk")), f"bucket_word_{buckets}": bucket_of(F.col("word"), buckets)}


def write_merged_by_term(
    by_term: DataFrame, path: str, docids: int, buckets: int, mode: str = "append"
) -> None:
    """The same for rows that are in layout "by term" already, each word and chunk once. Where they come with the columns of
    term_folders, those of a folder lie in one partition, and nothing moves."""
    folders = term_folders(docids, buckets)
    order = [*folders, "chunk", "word"]
    if not set(folders) <= set(by_term.columns):
        by_term = by_term.select("word", "chunk", "inv_index").withColumns(folders).hint("rebalance", *folders)
    rows = by_term.select(*folders, "word", "chunk", "inv_index").sortWithinPartitions(*order)
    rows.write.mode(mode).partitionBy(*folders).parquet(path, compression=COMPRESSION)
    drop_shuffles(by_term.sparkSession)


def bucket_columns(df: DataFrame) -> list[str]:
    """The partition columns that tell folders apart."""
    return [c for c in df.columns if re.fullmatch(r"bucket_.+_\d+|chunk_\d+", c)]


def _bucket_column(df: DataFrame, column: str) -> tuple[str, int] | None:
    for name in df.columns:
        found = re.fullmatch(rf"bucket_{re.escape(column)}_(\d+)", name)
        if found:
            return name, int(found[1])
    return None


def prune_to_key(df: DataFrame, column: str, value) -> DataFrame:
    """Restrict a bucketed table to the folder of one key; other tables stay as they are."""
    bucket = _bucket_column(df, column)
    if bucket is None:
        return df
    name, n = bucket
    typed = F.lit(value).cast(df.schema[column].dataType)
    return df.where(F.col(name) == bucket_of(typed, n)).drop(name)


def key_set(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The distinct keys, in the type that the column has in the table; null is no key."""
    typed = keys.select(F.col(column).cast(df.schema[column].dataType).alias(column))
    return typed.where(F.col(column).isNotNull()).distinct()


def prune_to_keys(df: DataFrame, distinct_keys: DataFrame, column: str) -> DataFrame:
    """Restrict a bucketed table to the folders of the keys while it runs, by dynamic partition pruning.

    What is broadcast are folder numbers, `n` at most. No job runs while the plan is built, and the keys are those of
    key_set, which Spark computes once for all their uses.
    """
    bucket = _bucket_column(df, column)
    if bucket is None:
        return df
    name, n = bucket
    # never null, so that Spark adds no filter of its own and the distinct keys stay the same plan everywhere
    bucket = F.coalesce(bucket_of(F.col(column), n), F.lit(0)).alias(name)
    # a condition that a filter can test, true for every folder: without one Spark does not prune
    folders = distinct_keys.groupBy(bucket).agg(F.count("*").alias("keys"))
    folders = folders.where(F.col("keys") > 0).select(name)
    return df.join(F.broadcast(folders), name, "left_semi").drop(name)
