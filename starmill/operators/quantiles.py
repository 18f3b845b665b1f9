"""Exact quantiles of a column that may be too large for one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.keys import surrogate_key


def exact_quantiles(
    df: DataFrame,
    value: str,
    cuts: Mapping[str, tuple[int, int]],
    tie: str,
    folder: str | None = None,
) -> DataFrame:
    """One row: for each name the quantile ``numerator / denominator`` of ``value``.

    Linear interpolation between neighbours, NULLs left out. Rows are ranked with a
    distributed key instead of being gathered; ``tie`` tells equal values apart, so that
    a frequent value spreads over partitions too.
    """
    present = df.where(F.col(value).isNotNull()).select(value, tie)
    ranked = surrogate_key(present, "_rank", [value, tie], keep=[value], folder=folder)
    sized = ranked.withColumn("_last", ranked.agg(F.count("*") - 1).scalar())

    def value_at(index: Column) -> Column:
        return F.max(F.when(F.col("_rank") == index + 1, F.col(value)))

    picks, results = [], []
    for name, (numerator, denominator) in cuts.items():
        steps = F.col("_last") * numerator
        below = F.floor(steps / denominator)
        share = steps % denominator / denominator
        picks += [
            value_at(below).alias(f"{name}_below"),
            value_at(below + F.when(share > 0, 1).otherwise(0)).alias(f"{name}_above"),
            F.max(share).alias(f"{name}_share"),
        ]
        between = f"{name}_below + ({name}_above - {name}_below) * {name}_share"
        results.append(F.expr(between).alias(name))
    return sized.agg(*picks).select(*results)
