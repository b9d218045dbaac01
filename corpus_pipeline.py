"""From raw documents to tokens: quality rules, near-duplicates, secrets, mixing, byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; run() writes what each
returns as Parquet below spark.checkpoint.dir and rereads it as the next one's documents. All but the last
return the columns of documents.

- quality rules: documents that a rule rejects go.
- near-duplicates: one document of each class stays, the one with the least id.
- secrets: each is replaced in the text by its kind; no document goes.
- mixing: the rows in the mixed order of their sources, as the files and the rows in them follow each other;
  none goes.
- byte-pair encoding: the digest columns of query op10 for every document, and `mix_position`, its place in the
  mixed order: what it has in the files of the stage before.

run() returns the digest columns in the mixed order; run_placed() has the place as a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wortfund.llm import bpe, mixing, near_dup, quality, secret_scan
from wortfund.llm.common import stored
from wortfund.llm.queries import read, tokens_of, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens_of(mixing.placed(docs), bpe.vocabulary(vocabulary_path()), "mix_position")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: The near-duplicates of Order MinHash are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_placed(spark, sf_dir).orderBy("mix_position").drop("mix_position")
