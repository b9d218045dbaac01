import duckdb
import pytest

from wortfund.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings labels".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    show = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert show(got) == show(want)


def test_one_query_of_each_operator():
    numbers = [int(n.split("_")[0][2:]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
