"""Cleaning of article bodies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wortfund.functions import markup as M
from wortfund.functions.entities import unescape_html


def filter_namespace(pages: DataFrame, ns: int = 0) -> DataFrame:
    """Pages of one namespace; redirect pages stay in."""
    return pages.where(F.col("ns") == F.lit(ns))


def project_article(pages: DataFrame) -> DataFrame:
    """XML page rows -> (docid, title, wikitext). A page without a body gets an empty one."""
    return pages.select(
        F.col("id").cast("long").alias("docid"),
        F.col("title").cast("string").alias("title"),
        F.coalesce(F.col("revision.text._VALUE"), F.lit("")).alias("wikitext"),
    )


def clean_unescape_html(df: DataFrame, body: str = "wikitext") -> DataFrame:
    """Decode HTML entities."""
    return df.withColumn(body, unescape_html(F.col(body)))


def clean_article(df: DataFrame, body: str = "wikitext") -> DataFrame:
    """The whole cleaner, row by row and without a shuffle; NULL bodies become empty."""
    df = df.withColumn(body, F.coalesce(F.col(body), F.lit("")))
    # a projection for each step: the analyser refuses an expression as deep as all of them
    for step in [*M.BEFORE_ENTITIES, unescape_html, *M.AFTER_ENTITIES]:
        df = df.withColumn(body, step(F.col(body)))
    return df
