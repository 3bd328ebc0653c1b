"""The registered queries over a whole small table, against SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
from tillroll.llm import oracles, queries


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(oracles.registry()) <= set(queries.registry())


@pytest.mark.parametrize("name", sorted(oracles.registry()))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_small}/{table}.parquet')")
    con.execute(f"CREATE VIEW oracle AS {oracles.registry()[name]}")
    want = con.execute("SELECT * FROM oracle")
    columns = [c[0] for c in want.description]
    df = queries.registry()[name](spark, sf_small)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())
