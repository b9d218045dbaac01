"""Stop-word and search-key lists: one entry per line."""

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STOPWORDS_FILE = os.path.join(os.path.dirname(__file__), "..", "resources", "stopwords_de.txt")


def read_list(spark: SparkSession, path: str, name: str, kind: str = "string") -> DataFrame:
    """The distinct lines of a text file, cast to `kind`; a line that is no number fails."""
    return spark.read.text(path).select(F.col("value").cast(kind).alias(name)).distinct()


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    return read_list(spark, path, "word")


def default_stopword_list() -> list[str]:
    """The entries of the list that comes with the package; fewer than 200."""
    with open(STOPWORDS_FILE, encoding="utf-8") as lines:
        return sorted({line.rstrip("\n") for line in lines if line.strip()})


def default_stopwords(spark: SparkSession) -> DataFrame:
    """The package's own list, as rows of the plan: executors need no copy of the file, and
    Spark knows its size, so that it can broadcast it."""
    return spark.createDataFrame(pa.table({"word": default_stopword_list()}))


def load_search_keys(spark: SparkSession, titles, article_ids, index_ids, words) -> dict:
    """The four key lists of the lookup run."""
    return {
        "titles": read_list(spark, titles, "title"),
        "article_ids": read_list(spark, article_ids, "docid", "long"),
        "index_ids": read_list(spark, index_ids, "docid", "long"),
        "words": read_list(spark, words, "word"),
    }
