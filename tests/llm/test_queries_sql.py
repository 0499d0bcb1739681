"""Registered queries against their SQL, over whole tables."""

import duckdb
import pytest

from orderloom.llm import queries

SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == {d[0]: str(d[1]) for d in result.description}
    want = sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in result.fetchall())
    assert sorted(repr(tuple(r[c] for c in sorted(names))) for r in df.collect()) == want


def test_operators_with_sql():
    assert sorted(n.split("_")[0] for n in queries.ORACLES) == ["op11", "op12", "op13", "op4", "op5", "op6", "op7"]
