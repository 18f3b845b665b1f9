"""Operators that SQL can express, against a second engine."""

import duckdb
import pytest

from starmill.llm.oracles import SQL
from starmill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WITH_SECRETS = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(session, name):
    folder = WITH_SECRETS if name == "op3_secret_scan" else FOLDER
    result = QUERIES[name](session, folder)
    columns = sorted(result.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=str)
    engine = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        engine.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    relation = engine.sql(SQL[name])
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in relation.fetchall()), key=str)
    assert len(ours) > 0 and ours == theirs
