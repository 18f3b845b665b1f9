"""Casts of raw text that give NULL for unreadable values, with or without ANSI mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, **kinds: str) -> DataFrame:
    """Replace the named columns by themselves as ``kind``, e.g. ``price="double"``."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a header-only CSV scan delivers it."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
