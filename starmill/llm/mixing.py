"""Mix sources to target weights by Pfair scheduling of their blocks.

A source's documents, in an order by a hash of their ids, form blocks of equal size. Slots
come in periods of P. After p periods a source has been allotted p P w blocks, rounded up or
down, w being its exact target weight: what must not wait is allotted first, and the slots
left over go to the blocks due first. So the rounding never adds up over periods.

With a of a period's P slots, block j (from 0) of the period is released at floor(j P / a)
and due at ceil((j + 1) P / a). Of the released blocks, the one due first takes the next
slot. As the shares add up to P, every block gets a slot in its window. So after any number
of slots a source is less than two blocks away from its target weight, and less than one
from the line between the ends of the period, until the first source runs out.

From the period on in which that has happened, one schedule of whole shares of P, at least
one slot each, repeats, so that sources of very small weights come to an end.

Every document gets a position and none is dropped or repeated: a source that runs out
leaves gaps in the positions. All steps are DataFrame operations; a large source is ranked
in many buckets of its hash order.

A NULL source is a source of its own. NULL ids order like the empty text. Rows with equal
ids and texts are interchangeable. Without documents there is no row. A period has
``PERIOD`` slots for every ``MOST_SOURCES`` sources or part of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import small_or_shuffled, written

PERIOD = 1000
MOST_SOURCES = 500
BLOCK = 32
# Documents ranked together; a bucket's size does not grow with its source.
BUCKET = 4096


def _order_key() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def weighted(counts: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """``counts`` with w: exact target weights that add up to one.

    ``weights`` maps sources to target weights; without it, a source's weight is the square
    root of its number of documents. Sources without a weight get one slot in PERIOD.
    """
    weight = F.sqrt("n")
    if weights is not None:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("_source") == source, F.lit(float(value))).otherwise(weight)
    everything = Window.partitionBy()
    table = counts.withColumn("w", F.greatest(weight, F.lit(0.0)))
    given = F.sum("w").over(everything)
    least = F.when(F.col("given") > 0, F.col("given") / PERIOD).otherwise(1.0)
    table = table.withColumn("given", given).withColumn("w", F.when(F.col("w") > 0, F.col("w")).otherwise(least))
    return table.withColumn("w", F.col("w") / F.sum("w").over(everything)).drop("given")


def shares(counts: DataFrame, weights: dict[str, float] | None, period: int = PERIOD) -> DataFrame:
    """(_source, n, a, w): whole shares of one period, at least one slot each, and weights.

    The shares add up to ``period``, by largest remainder.
    """
    everything = Window.partitionBy()
    table = weighted(counts, weights).withColumn("x", period * F.col("w"))
    table = table.withColumn("a", F.greatest(F.floor("x"), F.lit(1)))
    # One slot more for the largest remainders, or one less for the largest shares.
    left = F.lit(period) - F.sum("a").over(everything)
    more = F.row_number().over(Window.partitionBy().orderBy(F.desc(F.col("x") - F.floor("x")), "_source"))
    table = table.withColumn("left", left).withColumn("more", more)
    plus = F.when(F.col("more") <= F.col("left"), 1).otherwise(0)
    table = table.withColumn("a", F.col("a") + plus)
    over = F.sum("a").over(everything) - period
    spare = F.sum(F.col("a") - 1).over(Window.partitionBy().orderBy(F.desc("a"), "_source").rowsBetween(Window.unboundedPreceding, -1))
    cut = F.greatest(F.least(F.col("a") - 1, F.col("over") - F.coalesce("spare", F.lit(0))), F.lit(0))
    table = table.withColumn("over", over).withColumn("spare", spare)
    return table.select("_source", "n", (F.col("a") - cut).cast("int").alias("a"), "w")


def allotments(table: DataFrame, block: int, period: int = PERIOD) -> DataFrame:
    """(_period, _source, a, before): blocks in each period, and in all periods before it.

    Periods end with the one in which a source first runs out. Of blocks that may wait, those
    due in an earlier period go first, then the largest remainders.
    """
    target = F.struct("_source", "w")
    last = F.ceil(F.min(F.ceil(F.col("n") / block) / (period * F.col("w"))))
    everyone = table.agg(F.sort_array(F.collect_list(target)).alias("all"), last.alias("periods"))
    fold = f"""
        aggregate(
          sequence(1L, periods),
          struct(transform(all, s -> 0L) AS done, cast(array() AS array<array<bigint>>) AS ends),
          (state, p) -> aggregate(
            array(transform(all, (s, i) -> greatest(state.done[i], floor(p * {period}D * s.w)))),
            state,
            (same, least) -> aggregate(
              array(slice(
                array_sort(transform(all, (s, i) -> struct(
                  if(least[i] < p * {period}D * s.w, 0, 1) AS early,
                  ceil((least[i] + 1) / (s.w * {period}D)) AS due,
                  least[i] - p * {period}D * s.w AS rest,
                  i AS i))),
                1,
                cast(greatest(p * {period}L - aggregate(least, 0L, (x, y) -> x + y), 0L) AS int)).i),
              same,
              (old, more) -> struct(
                transform(least, (d, i) -> if(array_contains(more, i), d + 1, d)) AS done,
                concat(old.ends, array(transform(least, (d, i) -> if(array_contains(more, i), d + 1, d)))) AS ends))),
          state -> state.ends)
    """
    ends = everyone.where("periods > 0").select("all", F.expr(fold).alias("_ends"))
    periods = ends.select("all", "_ends", F.posexplode("_ends").alias("_period", "_end"))
    return periods.select(
        "_period",
        F.posexplode("all").alias("i", "s"),
        "_end",
        F.expr("if(_period = 0, transform(_end, d -> 0L), _ends[_period - 1])").alias("_start"),
    ).select(
        "_period",
        "s._source",
        F.expr("cast(_end[i] - _start[i] AS int)").alias("a"),
        F.expr("_start[i]").alias("before"),
    )


def schedule(table: DataFrame, period: int = PERIOD, by: tuple[str, ...] = ()) -> DataFrame:
    """(_source, a, slots): the slots of each source in one period, earliest deadline first.

    ``by`` names columns that tell periods apart; a source without a slot in one is left out.
    """
    present = table.where("a > 0")
    everyone = present.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_source", "a"))).alias("all"))
    fold = f"""
        aggregate(
          sequence(0, {period} - 1),
          struct(transform(all, s -> 0) AS done, cast(array() AS array<int>) AS chosen),
          (state, t) -> aggregate(
            array(array_min(transform(all, (s, i) -> struct(
              if(state.done[i] * {period}L div s.a <= t AND state.done[i] < s.a,
                 ((state.done[i] + 1) * {period}L + s.a - 1) div s.a, {4 * period}L) AS due,
              i AS i))).i),
            state,
            (same, pick) -> struct(
              transform(state.done, (d, i) -> if(i = pick, d + 1, d)) AS done,
              concat(state.chosen, array(pick)) AS chosen)),
          state -> state.chosen)
    """
    chosen = everyone.select(*by, "all", F.expr(fold).alias("chosen"))
    return chosen.select(*by, F.posexplode("all").alias("i", "s"), "chosen").select(
        *by,
        "s._source",
        "s.a",
        F.expr(f"filter(sequence(0, {period} - 1), t -> chosen[t] = i)").alias("slots"),
    )


def blocks(periods: DataFrame, period: int = PERIOD) -> DataFrame:
    """(_source, _block, _slot, _release, _due): every block of the exact periods."""
    planned = schedule(periods, period, ("_period",)).join(
        periods.select("_period", "_source", "before"), ["_period", "_source"]
    )
    j, a, start = F.col("j"), F.col("a"), F.col("_period").cast("bigint") * period
    return planned.select("_period", "_source", "a", "before", F.posexplode("slots").alias("j", "t")).select(
        "_source",
        (F.col("before") + j).alias("_block"),
        (start + F.col("t")).alias("_slot"),
        (start + F.floor(j * period / a)).alias("_release"),
        (start + F.ceil((j + 1) * period / a)).alias("_due"),
    )


ADDED = ("block", "release", "deadline", "slot", "position")


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK
) -> DataFrame:
    """``docs`` with the columns of ADDED, which replace columns of the same names.

    ``position`` orders the mixture: slot times the block size, plus the place in the block.
    """
    # A source's name, never NULL, so that plain equality joins it.
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source")
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*kept).alias("_row"), name, _order_key().alias("_key"))
    counts = written(rows.groupBy("_source").agg(F.count("*").alias("n")))
    period = PERIOD * max(1, math.ceil(counts.count() / MOST_SOURCES))
    if weights is not None:
        weights = {"" if k is None else f"={k}": v for k, v in weights.items()}
    table = written(shares(counts, weights, period))
    periods = written(allotments(table, block, period))
    exact = blocks(periods, period)
    # What a source still has after the exact periods, and where these end.
    after = periods.groupBy("_source").agg(F.sum("a").alias("_exact"), (F.max("_period") + 1).alias("_periods"))
    # One row a source and ``period`` slots in all: broadcast.
    plan = schedule(table, period).join(table.select("_source", "n"), "_source").join(after, "_source")
    named = rows.join(F.broadcast(plan), "_source")
    # Buckets follow the order of the hash, so that ranks add up over them.
    high = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    buckets = F.ceil(F.col("n") / BUCKET)
    named = named.withColumn("_bucket", F.floor(high * buckets / F.lit(float(1 << 32))))
    sizes = named.groupBy("_source", "_bucket").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_source", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy("_key"))
    ranked = named.withColumn("_in", inside).join(starts, ["_source", "_bucket"])
    rank = F.col("_start") + F.col("_in") - 1
    ranked = ranked.withColumn("_rank", rank).withColumn("_block", F.floor(rank / block))
    ranked = ranked.join(small_or_shuffled(written(exact)), ["_source", "_block"], "left")
    a, j, again = F.col("a"), F.col("_block"), F.col("_block") - F.col("_exact")
    turn = lambda place: F.col("_periods") * period + place
    slot = turn(F.floor(again / a) * period + F.get("slots", (again % a).cast("int")))
    slot = F.coalesce("_slot", slot)
    return ranked.select(
        "_row.*",
        j.alias("block"),
        F.coalesce("_release", turn(F.floor(again * period / a))).alias("release"),
        F.coalesce("_due", turn(F.ceil((again + 1) * period / a))).alias("deadline"),
        slot.cast("bigint").alias("slot"),
        (slot * block + F.col("_rank") % block).cast("bigint").alias("position"),
    )
