"""One row per key, and rows without a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str | Column] = (),
    total: bool = False,
) -> DataFrame:
    """Keep one row per key: the first by ``prefer``, then the smallest remaining row.

    ``total`` declares that ``prefer`` tells all rows of a key apart and is never NULL.
    Columns are then picked one by one, so that those nobody reads are not read here either.

    The survivor depends on the rows only, not on their order or placement. NULL keys
    form one group. The minimum is taken before the shuffle too, so a key that owns a
    large share of the rows sends one row per input partition.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranks = [
        (F.col(p) if isinstance(p, str) else p).alias(f"_prefer{i}") for i, p in enumerate(prefer)
    ]
    if total:
        if not ranks:
            raise ValueError("a total order needs columns to prefer")
        first = F.struct(*ranks)
        picked = df.groupBy(*keys).agg(*[F.min_by(c, first).alias(c) for c in rest])
        return picked.select(*df.columns)
    survivor = F.min(F.struct(*ranks, *rest)).alias("_row")
    kept = df.groupBy(*keys).agg(survivor)
    return kept.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def require(df: DataFrame, *names: str) -> DataFrame:
    """Drop rows where any of the named columns is NULL; the scan can skip them."""
    return df.where(reduce(Column.__and__, [F.col(n).isNotNull() for n in names]))
