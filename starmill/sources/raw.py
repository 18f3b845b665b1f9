"""The raw layer: nine named tables read from CSV or Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from starmill.layer import Layer
from starmill.sources.quoted import read_quoted

RAW_TABLES = (
    "customers",
    "orders",
    "order_items",
    "products",
    "sellers",
    "geolocation",
    "payments",
    "reviews",
    "categories",
)

# Layout of the reviews file, the one table typed at the scan.
REVIEWS_SCHEMA = (
    "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date date, "
    "review_answer_timestamp timestamp"
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    multiline: bool = False,
    plain: bool = False,
) -> DataFrame:
    """Scan CSV with a header line. Without a schema every column is text.

    A schema binds by position, and an unreadable value becomes NULL. Quotes inside a
    quoted text are doubled; ``plain`` expects Spark's backslash instead and one record
    per line. ``multiline`` lets quoted texts hold line breaks; the blocks of a file are read
    by tasks of their own also then.
    """
    if multiline and not plain:
        return read_quoted(spark, path, schema)
    reader = spark.read.option("header", True)
    if not plain:
        reader = reader.option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    return reader.csv(path)


def read_raw(
    spark: SparkSession,
    root: str,
    format: str = "csv",
    files: Mapping[str, str] | None = None,
    multiline: tuple[str, ...] = ("reviews",),
    plain: bool = False,
) -> Layer:
    """Read all raw tables under ``root``; ``files`` renames the file of a table.

    Only reviews carry free text, so only they are scanned as multi-line by default.
    """
    names = {t: f"{t}.{format}" for t in RAW_TABLES} | dict(files or {})
    paths = {t: f"{root.rstrip('/')}/{names[t]}" for t in RAW_TABLES}
    if format not in ("csv", "parquet"):
        raise ValueError(f"unknown format {format!r}")

    def read(table: str) -> DataFrame:
        if format == "parquet":
            return spark.read.parquet(paths[table])
        schema = REVIEWS_SCHEMA if table == "reviews" else None
        return read_csv(spark, paths[table], schema, table in multiline, plain)

    return Layer({t: partial(read, t) for t in RAW_TABLES})
