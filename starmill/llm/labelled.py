"""Drawing a bounded, repeatable sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id's text modulo ``modulus``; a NULL id counts as the empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column) -> DataFrame:
    """(doc_id, label, _text) of at most ``rows`` labelled documents, chosen by a hash of the id.

    An id that is labelled twice takes its smaller label; an id that several rows of ``docs``
    share counts once, with its smallest text. Rows without id or label are left out.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` ids of a few bytes each: small enough to broadcast whatever the input.
    return (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("_text").alias("_text"))
    )
