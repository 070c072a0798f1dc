"""Queries and their SQL on the smallest tables."""

import duckdb
import pytest

from postlake import catalog, catalog_layers  # noqa: F401  (adds its queries to the catalog)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df):
    def plain(v):
        if v is None or v != v:
            return None
        return round(float(v), 5) if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)

    return sorted((tuple(plain(v) for v in r) for r in df), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, small)
    result = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.select(*names).collect()) == rows_of(result.fetchall())


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
