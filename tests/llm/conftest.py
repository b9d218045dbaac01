import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing extra columns."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "", "en", "a", 0),
        (2, None, "en", "a", None),
        (None, "some words here, and a few more of them to pass the bar", None, None, 3),
        (3, long_text, "de", "b", len(long_text)),
        (3, long_text, "de", "b", len(long_text)),
        (4, " \n\t ", "fr", "b", 4),
        (5, "same words in this row as in the next one, all of them", "en", "c", 9),
        (5, "same words in this row as in the next one, all of them", "en", "c", 9),
        (6, "naïve \U0001f600 café 中文 words", "fr", "c", 9),
        (None, None, None, None, None),
    ]
    names = ["shard", "slot", "row", "spans", "kept", "n_words", "ids", "decoded", "words", "block", "bucket", "mix_position", "secrets", "redacted_text", "lang_pred", "toxicity", "lm_score", "node", "w", "t"]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, DOCS).select("*", *[F.lit(n).alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
