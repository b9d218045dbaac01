import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wortfund.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests", memory="12g")
    yield session
    session.stop()


@pytest.fixture
def run(spark):
    """run(expression, texts): the expression over a one-column table, in the order of the texts."""

    def apply(expression, texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        found = rows.select("i", expression(F.col("text")).alias("out")).collect()
        return [row.out for row in sorted(found)]

    return apply
