"""Every registered query against the same query in SQL on a second engine."""

import duckdb
import pytest

import __spark_entry__ as registered
from starmill import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
# Queries of optional parts have tests of their own.
QUERIES = {n: q for n, q in registered.queries().items() if n in queries.QUERIES}
SQL = {n: q for n, q in registered.oracle_sql().items() if n in queries.QUERIES}


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, second_engine, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=str)
    relation = second_engine.sql(SQL[name])
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in relation.fetchall()), key=str)
    assert len(ours) > 0
    assert ours == theirs


# Row counts of FIXTURES.md, part C, computed independently of the SQL above.
EXPECTED = {
    "geolocation_rollup": 25,
    "products_translated": 2000,
    "dedup_payments": 6030,
    "dedup_reviews": 5000,
    "orphan_sellers": 12,
    "orphan_products": 343,
    "orphan_customer_zips": 5,
    "orders_without_items": 257,
    "items_with_valid_product": 49746,
    "items_with_valid_seller": 43870,
    "items_with_valid_order": 34888,
    "orders_with_valid_customer": 11895,
    "clean_drop_null_keys": 7986,
    "dedup_then_dropna": 3990,
    "dedup_prefers_order": 4801,
    "dim_customers": 1500,
    "dim_sellers": 100,
    "dim_reviews": 5000,
    "dim_date": 2404,
    "fact_orderpayments": 6030,
    "fact_orderlifecycle": 73086,
}


@pytest.mark.parametrize("name", EXPECTED)
def test_row_counts(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() == EXPECTED[name]


def test_entry(spark):
    assert registered.entry(spark).count() == 7358
