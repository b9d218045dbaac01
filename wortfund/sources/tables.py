"""Article and index tables in any format Spark has a name for.

Parquet is the default. JDBC, Cassandra and MongoDB need their driver on the class path; their
connection settings are plain reader and writer options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wortfund.schemas import ARTICLES, DICTIONARY, LAYOUTS, TITLES
from wortfund.sources import versions
from wortfund.sources.buckets import bucket_columns, write_in_ranges

# Column names of the target tables, as fixed values: (docid, title, wikitext), then the index
# in the layout that each target keeps.
ARTICLE_NAMES = {
    "parquet": ["docid", "title", "wikitext"],
    "jdbc": ["docID", "title", "wikitext"],
    "cassandra": ["docid", "title", "wikitext"],
    "mongodb": ["_id", "title", "wikitext"],
}
INDEX_LAYOUTS = {
    "parquet": "postings",
    "jdbc": "positions",
    "cassandra": "postings",
    "mongodb": "by_term",
}
INDEX_NAMES = {
    "parquet": ["word", "docid", "occurences"],
    "jdbc": ["word", "docID", "occurence"],
    "cassandra": ["word", "docid", "occurences"],
    "mongodb": ["_id", "invIndex"],
}
MONGODB_POSTINGS = "array<struct<_1: bigint, _2: array<int>>>"
FORMATS = {
    "parquet": "parquet",
    "jdbc": "jdbc",
    "cassandra": "org.apache.spark.sql.cassandra",
    "mongodb": "mongodb",
}


def rename_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Impose the target's column names, by position."""
    return df.toDF(*names)


def read_table(spark: SparkSession, path: str | None = None, kind="parquet", **options):
    return spark.read.format(FORMATS[kind]).options(**options).load(path)


def append_table(df: DataFrame, path: str | None = None, kind="parquet", **options) -> None:
    df.write.format(FORMATS[kind]).options(**options).mode("append").save(path)


def create_table(df: DataFrame, path: str | None = None, kind="parquet", **options) -> None:
    """Create the table from the schema of `df`; an existing one is an error."""
    df.write.format(FORMATS[kind]).options(**options).mode("errorifexists").save(path)


def jdbc_scan_options(column: str, lower: int, upper: int, connections: int) -> dict:
    """Options that read a JDBC table over several connections, by ranges of an integer column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(connections),
    }


def jdbc_article_types() -> dict:
    """Create-table types for articles; without them every string becomes TEXT."""
    return {"createTableColumnTypes": "title VARCHAR(255)"}


def jdbc_index_types() -> dict:
    return {"createTableColumnTypes": "word VARCHAR(65)"}


def typed_columns(df: DataFrame, schema) -> DataFrame:
    """Pick and cast the columns of a fixed schema by name; other columns are not read."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _read_files(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table by its fixed schema, and its folders' columns, which lookups need, at the end."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*schema.names, *bucket_columns(rows))


def read_articles(spark: SparkSession, path: str | None = None, kind="parquet", **options):
    """Articles of any target as (docid, title, wikitext); of a Parquet table that jobs.upsert_articles keeps, the newest
    version, with the column of its folders."""
    if kind == "parquet":
        return _read_files(spark, versions.part(spark, path, "articles") or path, ARTICLES)
    names = ARTICLE_NAMES[kind]
    rows = read_table(spark, path, kind, **options).select(*names)
    return rename_columns(rows, ARTICLE_NAMES["parquet"])


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """(title, docid) in folders by title, kept with the articles at `path`."""
    return _read_files(spark, _kept_part(spark, path, "titles"), TITLES)


def read_layout(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """An index in Parquet: the newest version of one that jobs.upsert_index keeps, or a plain table."""
    return _read_files(spark, versions.part(spark, path, "index") or path, LAYOUTS[layout])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The term dictionary kept with the index at `path`."""
    return _read_files(spark, _kept_part(spark, path, "dictionary"), DICTIONARY)


def _kept_part(spark: SparkSession, path: str, name: str) -> str:
    found = versions.part(spark, path, name)
    if found is None:
        raise FileNotFoundError(f"no {name} are kept at {path}")
    return found


def write_layout(
    index: DataFrame, layout: str, path: str, column: str, buckets: int, mode="append", sample: DataFrame | None = None, ranges: int = 0
) -> None:
    """Postings or positions in folders by word or docid, in files that do not overlap; see write_in_ranges."""
    if layout == "by_term":
        raise ValueError("write_by_term writes this layout")
    rest = {"word": ["docid"], "docid": ["word"]}[column]
    names = LAYOUTS[layout].names
    sample = None if sample is None else sample.select(column, *rest)
    write_in_ranges(index.select(*names), path, column, buckets, rest, mode, sample, ranges)


def append_articles(articles: DataFrame, path: str | None = None, kind="parquet", **options):
    rows = rename_columns(articles.select("docid", "title", "wikitext"), ARTICLE_NAMES[kind])
    append_table(rows, path, kind, **options)


def to_mongodb_index(by_term: DataFrame) -> DataFrame:
    """By-term rows with MongoDB's field names. `_id` is unique: chunks but 0 are told apart."""
    key = F.when(F.col("chunk") == 0, F.col("word")).otherwise(
        F.concat_ws("#", "word", F.col("chunk").cast("string"))
    )
    return by_term.select(
        key.alias("_id"), F.col("inv_index").cast(MONGODB_POSTINGS).alias("invIndex")
    )


def mongodb_word_rows(rows: DataFrame, word: str) -> DataFrame:
    """The rows of one word, by conditions on `_id` that a connector can push down."""
    return rows.where((F.col("_id") == word) | F.col("_id").startswith(word + "#"))


def from_mongodb_index(rows: DataFrame) -> DataFrame:
    """Tokens are letters or digits only, so "#" always starts a chunk number."""
    parts = F.split("_id", "#")
    return rows.select(
        parts[0].alias("word"),
        F.coalesce(F.get(parts, F.lit(1)).cast("long"), F.lit(0)).alias("chunk"),
        F.col("invIndex")
        .cast("array<struct<docid: bigint, occurences: array<int>>>")
        .alias("inv_index"),
    )


def to_target_index(index: DataFrame, kind: str) -> DataFrame:
    """An index in the layout of the target -> the target's column names."""
    if kind == "mongodb":
        return to_mongodb_index(index)
    layout = LAYOUTS[INDEX_LAYOUTS[kind]]
    return rename_columns(index.select(*layout.names), INDEX_NAMES[kind])


def read_index(spark: SparkSession, path: str | None = None, kind="parquet", **options):
    """The index of any target, in its layout, under the names of that layout."""
    rows = read_table(spark, path, kind, **options).select(*INDEX_NAMES[kind])
    if kind == "mongodb":
        return from_mongodb_index(rows)
    return rename_columns(rows, LAYOUTS[INDEX_LAYOUTS[kind]].names)
