"""CSV files whose quoted texts hold line breaks, read by as many tasks as they have blocks.

Whether a line begins inside a quoted text follows from the number of quotes before it. Each
block of a file counts its quotes; the counts of the blocks before tell how it begins. Then every
block puts its lines together into records by itself. A record that goes on in the next
block, at most one for each block, leaves in fragments, which are joined by file and order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, GOES_ON, BEGINS, HEADER = range(4)
PIECES = "file string, block bigint, kind int, place int, text string"


def _assemble():
    """Lines of blocks, in order, to PIECES. Stands alone, so that workers need not import this."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["file", "block", "kind", "place", "text"]
        now, held, odd, first, place = None, [], False, False, 0

        def batch(texts, kinds, where):
            n = len(kinds)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([where[0]] * n, pa.string()),
                    pa.array([where[1]] * n, pa.int64()),
                    pa.array(kinds, pa.int32()),
                    pa.array(range(place, place + n), pa.int32()),
                    pa.array(texts, pa.string()) if isinstance(texts, list) else texts,
                ],
                names,
            )

        def kind_of(begun, ended):
            return (HEADER if first else RECORD) if begun and ended else BEGINS if begun else GOES_ON

        def rest():
            return batch(["\n".join(held)], [kind_of(begun, not odd)], now)

        begun = True
        for lines in batches:
            files, blocks, inside = (lines.column(k) for k in (1, 2, 3))
            values = lines.column(0)
            starts = np.flatnonzero(
                np.append(
                    True,
                    pc.or_(
                        pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])
                    ).to_numpy(zero_copy_only=False),
                )
            ) if len(values) else []
            for a, b in zip(starts, [*starts[1:], len(values)], strict=True):
                where = (files[a].as_py(), blocks[a].as_py())
                if where != now:
                    if now is not None and held:
                        yield rest()
                    now, held, place = where, [], 0
                    odd = bool(inside[a].as_py())
                    begun, first = not odd, where[1] == 0 and not odd
                part = values[a:b]
                quotes = pc.count_substring(part, '"').to_numpy(zero_copy_only=False) % 2
                after = (np.cumsum(quotes) + odd) % 2 == 1
                ends = np.flatnonzero(~after)
                if held and len(ends):
                    # The record at hand ends in these lines.
                    text = "\n".join([*held, *part[: ends[0] + 1].to_pylist()])
                    yield batch([text], [kind_of(begun, True)], now)
                    place, held, begun, first = place + 1, [], True, False
                    done = ends[0] + 1
                    ends = ends[1:]
                elif not held and not begun and len(ends):
                    yield batch(["\n".join(part[: ends[0] + 1].to_pylist())], [GOES_ON], now)
                    place, begun, done = place + 1, True, ends[0] + 1
                    ends = ends[1:]
                else:
                    done = 0
                if len(ends):
                    offsets = np.append(done, ends + 1).astype(np.int32)
                    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), part), "\n")
                    kinds = np.full(len(ends), RECORD, np.int32)
                    if first:
                        kinds[0], first = HEADER, False
                    yield batch(whole, kinds, now)
                    place, done = place + len(ends), ends[-1] + 1
                held += part[done:].to_pylist()
                odd = bool(after[-1])
        if now is not None and held:
            yield rest()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(text): the records of the files at ``path`` without their header lines and blank lines."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside")
    # One row for each block of 128 MB or so of input.
    told = lines.join(F.broadcast(blocks.select("file", "block", begins)), ["file", "block"])
    pieces = told.select("value", "file", "block", "inside").mapInArrow(_assemble(), PIECES)
    order = Window.partitionBy("file").orderBy("block", "place")
    fragments = pieces.where(F.col("kind").isin(GOES_ON, BEGINS)).withColumn(
        "record", F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(order)
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "text")))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")
    joined = fragments.groupBy("file", "record").agg(text)
    whole = pieces.where(F.col("kind") == RECORD).select("text").unionByName(joined.select("text"))
    return whole.select(F.regexp_replace("text", "\r$", "").alias("text")).where("trim(text) <> ''")


def read_quoted(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Same rows as Spark's ``multiLine`` reader, with a header line and doubled quotes.

    Quotes stand around a whole field or doubled inside one, as in any file that was written
    as CSV; lines end in LF or CRLF. The header must lie in the first block of a file.
    """
    if schema is None:
        names = spark.read.option("header", True).option("escape", '"').csv(path).columns
        schema = ", ".join(f"`{n}` STRING" for n in names)
    parsed = F.from_csv("text", F.lit(schema), {"escape": '"'}).alias("row")
    return records(spark, path).select(parsed).select("row.*")
