import duckdb
import pandas as pd
import pytest

from kindred import catalogue

SQL = catalogue.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(d):
    one = lambda v: "~" if pd.isna(v) else round(float(v), 6) if not isinstance(v, str) else v
    return sorted((tuple(one(v) for v in r) for r in d[sorted(d.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    made, want = catalogue.queries()[name](spark, small).toPandas(), con.execute(SQL[name]).df()
    assert sorted(made.columns) == sorted(want.columns)
    assert rows(made) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["s1", "t", "p"]
    assert set(e.oracle_sql()) <= set(e.queries())
