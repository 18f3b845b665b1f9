"""Declared keys as queries: violation counts per constraint, and the offending keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import schemas


def _copies(df: DataFrame, column: str) -> DataFrame:
    """(key, copies) of every key, the NULL key included."""
    return df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("copies"))


def _labelled(df: DataFrame, table: str, column: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(column).alias("key_name"), "*")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rejected(
    tables: Mapping[str, DataFrame], declared: Mapping[str, str], nulls: str
) -> DataFrame:
    """Rows beyond the first of each key, plus ``nulls`` of the copies of the NULL key."""
    rejected = F.when(F.col("key").isNull(), F.expr(nulls)).otherwise(F.col("copies") - 1)
    found = []
    for table, column in declared.items():
        total = F.coalesce(F.sum(rejected), F.lit(0)).alias("violations")
        found.append(_labelled(_copies(tables[table], column).agg(total), table, column))
    return _union(found)


def check_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that a primary key would reject: NULL keys, and copies beyond the first."""
    return _rejected(tables, schemas.PRIMARY_KEY, nulls="copies")


def check_unique_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that a UNIQUE constraint would reject; NULL may repeat."""
    return _rejected(tables, schemas.UNIQUE_KEY, nulls="0")


def repeated_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The offending keys: NULL primary keys, and keys that occur more than once."""
    found = []
    for declared, wrong in (
        (schemas.PRIMARY_KEY, "key is null or copies > 1"),
        (schemas.UNIQUE_KEY, "key is not null and copies > 1"),
    ):
        for table, column in declared.items():
            keys = _copies(tables[table], column).where(wrong)
            keys = keys.withColumn("key", F.col("key").cast("string"))
            found.append(_labelled(keys, table, column))
    return _union(found)


def _dangling(tables: Mapping[str, DataFrame], child: str) -> DataFrame:
    """(key_name, parent, key, rows) of foreign keys in ``child`` that have no parent.

    One pass over the child counts rows per key of all its constraints at once, so the
    join with the parents sees every key once however many rows carry it.
    """
    declared = {c: p for (t, c), p in schemas.FOREIGN_KEY.items() if t == child}
    used = (
        tables[child]
        .select(*[F.col(c).cast("bigint").alias(c) for c in declared])
        .unpivot([], list(declared), "key_name", "key")
        .where(F.col("key").isNotNull())
        .groupBy("key_name", "key")
        .agg(F.count("*").alias("rows"))
    )
    parent = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair])
    known = _union(
        [
            tables[p].select(
                F.lit(p).alias("parent"), F.col(schemas.PRIMARY_KEY[p]).cast("bigint").alias("key")
            )
            for p in sorted(set(declared.values()))
        ]
    )
    return used.withColumn("parent", parent[F.col("key_name")]).join(
        known, ["parent", "key"], "left_anti"
    )


def check_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent, one row per constraint."""
    found = []
    for child in sorted({t for t, _ in schemas.FOREIGN_KEY}):
        columns = [c for t, c in schemas.FOREIGN_KEY if t == child]
        # One marker row per constraint keeps those without violations in the result.
        names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("key_name")
        markers = tables[child].sparkSession.range(1).select(names, F.lit(0).alias("rows"))
        rows = _dangling(tables, child).select("key_name", "rows").unionByName(markers)
        totals = rows.groupBy("key_name").agg(F.sum("rows").alias("violations"))
        found.append(totals.select(F.lit(child).alias("table_name"), "key_name", "violations"))
    return _union(found)


def dangling_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The offending foreign keys (table, key name, parent, key, rows)."""
    return _union(
        [
            _dangling(tables, child).select(
                F.lit(child).alias("table_name"), "key_name", "parent", "key", "rows"
            )
            for child in sorted({t for t, _ in schemas.FOREIGN_KEY})
        ]
    )
