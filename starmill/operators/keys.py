"""Dense surrogate keys 1..n in the order of a natural key."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.staging import stage

# monotonically_increasing_id holds the partition above bit 33 and the row below it.
ROW_BITS = 33
# Rows that a range of the spread method should hold, ranges at most, and sampled rows for each.
RANGE_ROWS, MOST_RANGES, SAMPLED = 1_000_000, 16_384, 32
# Below this many rows a range is not worth a task of its own.
LEAST_ROWS = 20_000


def surrogate_key(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    keep: Sequence[str] | None = None,
    method: str = "ranged",
    folder: str | None = None,
) -> DataFrame:
    """Add ``name``: the row's position, from 1, in ascending order of ``keys``.

    ``keep`` names the columns of the result besides ``name`` (default all); ``folder`` is
    where the placement is staged (default: the application's staging folder).

    Equals ``row_number`` over the whole table ordered by ``keys`` (NULLs first), as
    long as ``keys`` tell the rows apart.

    ``ranged`` never sends the table through one task. Rows are range-partitioned and
    sorted, and written with their place (partition, row). A key is then the row's place
    plus the sizes of the partitions before it. The write pins the placement: range
    bounds come from a sample, so a recomputed frame could place rows otherwise.

    ``global`` is one window over one task, for tables of bounded size.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    kept = list(keep or df.columns)
    if method == "global":
        position = F.row_number().over(Window.orderBy(*order))
        return df.select(position.cast("bigint").alias(name), *kept)
    if method != "ranged":
        raise ValueError(f"unknown method {method!r}")

    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*kept, F.monotonically_increasing_id().alias("_place"))
    )
    pinned = stage(placed, name, folder).withColumn("_part", F.shiftright("_place", ROW_BITS))
    # One row per partition, whatever the table's size: safe to order and to broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pinned.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return pinned.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + row + 1).alias(name), *kept
    )


def sampled(df: DataFrame, most: int) -> tuple[DataFrame, int]:
    """About ``most`` rows of ``df``, evenly drawn, and how many rows it has."""
    rows = df.count()
    return (df.sample(most / rows, seed=1) if rows > most else df), rows


def range_count(spark: SparkSession, rows: int) -> int:
    """Ranges for a table of about ``rows`` rows."""
    spread = min(spark.sparkContext.defaultParallelism, rows // LEAST_ROWS)
    return min(max(spread, rows // RANGE_ROWS, 1), MOST_RANGES)


@dataclass(frozen=True)
class Ranges:
    """Cuts of an order by ``keys``: a row's range is the number of cuts at or before it."""

    keys: tuple[str, ...]
    schema: str
    cuts: str
    count: int

    @classmethod
    def of(cls, sample: DataFrame, keys: Sequence[str], count: int, folder: str | None = None) -> Ranges:
        """``count`` ranges, cut at even distances of a sample of about SAMPLED rows for each.

        The sample decides only how even the ranges are.
        """
        schema = f"array<{sample.select(*keys).schema.simpleString()}>"
        if count == 1:
            return cls(tuple(keys), schema, "[]", 1)
        few, rows = sampled(stage(sample.select(*keys), "sample", folder), 2 * SAMPLED * count)
        # The sample is bounded by the number of ranges, so one task may sort it.
        place = F.row_number().over(Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys]))
        step = max(1, min(rows, 2 * SAMPLED * count) // count)
        chosen = few.withColumn("_place", place).where(F.col("_place") % step == 0).orderBy("_place")
        cuts = list(dict.fromkeys(chosen.drop("_place").toJSON().collect()))[: count - 1]
        return cls(tuple(keys), schema, f"[{','.join(cuts)}]", len(cuts) + 1)

    def numbered(self, df: DataFrame, name: str = "_range") -> DataFrame:
        """Add the range of each row: a binary search among the cuts, one projection a step."""
        cuts = F.from_json(F.lit(self.cuts), self.schema)
        found, key = F.col(name), F.struct(*self.keys)
        df = df.withColumn(name, F.lit(0))
        for bit in reversed(range((self.count - 1).bit_length())):
            step = 1 << bit
            df = df.withColumn(name, found + F.when(F.get(cuts, found + (step - 1)) <= key, step).otherwise(0))
        return df


def spread_key(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    ranges: Ranges,
    keep: Sequence[str] | None = None,
    folder: str | None = None,
    first: int = 1,
) -> tuple[DataFrame, int]:
    """Same keys as :func:`surrogate_key`, from ``first`` on, and the number of rows.

    ``ranges`` cut the order by a leading part of ``keys``. Rows per range are counted first,
    for which ``df`` is computed with its key columns only. Then every row goes to its range's
    task, is sorted there, and its key is its place plus the rows of the ranges before. So
    ``df`` is computed once in full and nothing wide is staged: ranges are fixed beforehand, and
    a task that is run again places its rows as before.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    kept = list(keep or df.columns)
    ranged = ranges.numbered(df)
    counts = stage(ranged.groupBy("_range").agg(F.count("*").alias("_rows")), f"{name}-rows", folder)
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    # One row per range: safe to order and to broadcast.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.monotonically_increasing_id()
    misplaced = F.raise_error(F.lit("a row is not in the task of its range"))
    row = F.when(F.shiftright(place, ROW_BITS) == F.col("_range"), place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    placed = (
        ranged.select(*dict.fromkeys([*kept, *keys]), "_range")
        .repartitionById(ranges.count, F.col("_range"))
        .sortWithinPartitions(*order)
        .select(*kept, "_range", row.otherwise(misplaced).alias("_row"))
    )
    numbered = placed.join(F.broadcast(starts), "_range")
    return numbered.select((F.col("_start") + F.col("_row") + first).alias(name), *kept), total
