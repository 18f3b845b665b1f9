"""Near-duplicate documents by circulant MinHash, bands, and exact Jaccard confirmation.

Signature. A shingle's hash is an index below 2**20, moved by a first permutation. A second
permutation, circularly shifted by k, gives coordinate k; the least value over a document's
shingles is its signature there. So one shingle needs one contiguous read of the second
permutation for all coordinates.

Candidates. Number and depth of the bands follow from the similarity asked for: two documents
that just reach it share no band with a probability of at most 3e-7, more similar ones with
less. At 0.85 these are 32 bands of 6 coordinates, at 0.80 38 bands of 5.

Confirmation, without all pairs of a band. Documents with equal shingle sets are one. Every
document is compared with the smallest of each band it is in, and what is linked becomes one
component. In bands that still hold several components, a document is dropped if too many of
its shingles occur in no other such document to be linked to any. Of the rest, pairs of
different components are compared if they share a shingle among their rarest ones, which
every similar pair does. Nothing is capped.

Words are runs without blanks, A-Z lower-cased. NULL, empty and blank texts have no shingle
and no link; texts of fewer than five words are one shingle. Rows that repeat a doc_id with
another text are separate texts of one document id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import (
    NULL_ID, ODD, Words, keyed, mix, pieces, release_shuffles, row_id, shown_id, signed,
    small_or_shuffled, text_key, windows, written,
)
from starmill.llm.components import components
from starmill.operators.matching import lookup

SHINGLE = 5
PERCENT = 85
# The chance that a pair at the similarity asked for shares no band, and the coordinates that
# deeper, more selective bands may take.
MISSED, WIDTH, DEEPEST = 3e-7, 200, 8
SIZE = 1 << 20

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def layout(percent: int) -> tuple[int, int]:
    """(bands, depth): the deepest bands that miss no more than MISSED within WIDTH."""
    if percent >= 100:
        return 1, DEEPEST
    out = None
    for depth in range(1, DEEPEST + 1):
        bands = math.ceil(math.log(MISSED) / math.log1p(-((max(percent, 1) / 100) ** depth)))
        if out is None or bands * depth <= WIDTH:
            out = bands, depth
    return out


def _permutations(width: int) -> tuple[np.ndarray, np.ndarray]:
    """First permutation, and every run of the second one as rows of a strided view."""
    if width not in _tables:
        random = np.random.Generator(np.random.PCG64(20))
        first = random.permutation(SIZE).astype(np.int32)
        second = random.permutation(SIZE).astype(np.int32)
        cyclic = np.concatenate([second, second[:width]])
        _tables.clear()
        _tables[width] = first, np.lib.stride_tricks.sliding_window_view(cyclic, width)
    return _tables[width]


def signature(shingles: np.ndarray, width: int) -> np.ndarray:
    first, shifted = _permutations(width)
    at = first[(shingles & np.uint64(SIZE - 1)).astype(np.int64)]
    out = None
    for k in range(0, len(at), 2048):
        part = shifted[at[k : k + 2048]].min(axis=0)
        out = part if out is None else np.minimum(out, part)
    return out


def shingle_sets(words: Words, count: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each row, sorted."""
    grams, whole = windows(words.hashes, words.rows, SHINGLE)
    out = []
    for row in range(count):
        a, b = words.ranges[row], words.ranges[row + 1]
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            weights = mix((np.arange(b - a, dtype=np.uint64) + np.uint64(16 * (b - a))) * ODD)
            out.append(mix((words.hashes[a:b] * weights).sum(keepdims=True, dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


FEATURES = "_id bigint, _th binary, _n bigint, _set bigint, _bands array<bigint>"


def _features(percent: int):
    count, depth = layout(percent)
    weights = mix(np.arange(1, count * depth + 1, dtype=np.uint64) * ODD).reshape(count, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            words = Words(batch.column(batch.schema.get_field_index("_text")), lower=True)
            sets = shingle_sets(words, batch.num_rows)
            bands, sums = [], []
            for shingles in sets:
                sums.append(mix(shingles).sum(dtype=np.uint64))
                if len(shingles):
                    parts = signature(shingles, count * depth).astype(np.uint64).reshape(count, depth)
                    bands.append(signed(mix((parts * weights + weights).sum(axis=1, dtype=np.uint64))))
                else:
                    bands.append(np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("_id")),
                    batch.column(batch.schema.get_field_index("_th")),
                    pa.array(np.array([len(s) for s in sets], np.int64)),
                    pa.array(signed(np.array(sums, np.uint64))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands))),
                ],
                ["_id", "_th", "_n", "_set", "_bands"],
            )

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                left = shingle_sets(Words(part.column(2), lower=True), part.num_rows)
                right = shingle_sets(Words(part.column(3), lower=True), part.num_rows)
                keep = []
                for a, b in zip(left, right, strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield part.select([0, 1]).filter(pa.array(keep))

    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text"):
        words = Words(batch.column(batch.schema.get_field_index("_text")), lower=True)
        sets = shingle_sets(words, batch.num_rows)
        sizes = np.array([len(s) for s in sets], np.int64)
        which = pa.array(np.repeat(np.arange(len(sets)), sizes))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("_rep")).take(which),
                pa.array(np.repeat(sizes, sizes)),
                pa.array(signed(np.concatenate(sets))),
            ],
            ["_rep", "_n", "_h"],
        )


REP = "struct<_id:bigint,_th:binary>"
SHINGLE_ROWS = f"_rep {REP}, _n bigint, _h bigint"


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of sets that are similar enough; ``texts`` has a text of each set."""
    left = texts.select(F.col("_rep").alias("u"), F.col("_text").alias("_left"))
    right = texts.select(F.col("_rep").alias("v"), F.col("_text").alias("_right"))
    full = pairs.join(right, "v").join(left, "u").select("u", "v", "_left", "_right")
    return full.mapInArrow(_linked(percent), f"u {REP}, v {REP}")


def _close(percent: int):
    """Set sizes n and m that allow the similarity."""
    return (100 * F.col("m") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("m"))


def _undecided(banded: DataFrame) -> DataFrame:
    """Rows of bands that hold several components."""
    mixed = (
        banded.groupBy("_band")
        .agg(F.min("_c").alias("_low"), F.max("_c").alias("_high"))
        .where("_low <> _high")
        .select("_band")
    )
    return lookup(banded, "_band", mixed, how="left_semi")


def _can_link(live: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Drop sets with too many shingles that no other set of ``live`` has."""
    shingles = texts.join(live, "_rep", "left_semi").mapInArrow(_shingle_rows, SHINGLE_ROWS)
    lost = (
        shingles.groupBy("_h")
        .agg(F.count("*").alias("_in"), F.min(F.struct("_rep", "_n")).alias("_owner"))
        .where("_in = 1")
        .groupBy("_owner")
        .agg(F.count("*").alias("_own"))
        .where(100 * (F.col("_owner._n") - F.col("_own")) < percent * F.col("_owner._n"))
        .select("_owner._rep")
    )
    return live.join(lost, "_rep", "left_anti")


def _pairs_left(live: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v, c, d) of different components that may still be similar enough.

    Of a set's shingles, ordered from rare to frequent, a similar set must share one of the
    first n - ceil(percent n / 100) + 1, at a place from which enough are still to come in both.
    So sets that are near the same text, but not near each other, meet in few rows.
    """
    sets = live.select("_rep", "n", "_c").distinct()
    shingles = texts.join(sets, "_rep", "left_semi").mapInArrow(_shingle_rows, SHINGLE_ROWS).drop("_n")
    often = shingles.groupBy("_h").agg(F.count("*").alias("_in"))
    order = Window.partitionBy("_rep").orderBy("_in", "_h")
    placed = shingles.join(often, "_h").withColumn("_at", F.row_number().over(order)).join(sets, "_rep")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    placed = written(placed.where((F.col("_in") > 1) & (F.col("_at") <= first)).drop("_in"))
    left = placed.select("_h", F.col("_rep").alias("u"), "n", F.col("_c").alias("c"), F.col("_at").alias("i"))
    right = placed.select(
        "_h", F.col("_rep").alias("v"), F.col("n").alias("m"), F.col("_c").alias("d"), F.col("_at").alias("j")
    )
    most = 1 + F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    enough = 100 * most >= percent * (F.col("n") + F.col("m") - most)
    return (
        left.join(right, "_h")
        .where((F.col("u") < F.col("v")) & (F.col("c") != F.col("d")) & _close(percent) & enough)
        .select("u", "v", "c", "d")
        .distinct()
    )


def classes(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(features per document, (_rep, component) of each set that is linked to another)."""
    features = written(keyed(docs).mapInArrow(_features(percent), FEATURES))
    sets = (
        features.where("_n > 0")
        .groupBy("_set", "_n")
        .agg(F.min(F.struct("_id", "_th", "_bands")).alias("_r"))
    )
    banded = sets.select(
        F.struct("_r._id", "_r._th").alias("_rep"),
        F.col("_n").alias("n"),
        F.explode("_r._bands").alias("_band"),
    )
    pivots = (
        banded.groupBy("_band")
        .agg(F.count("*").alias("_size"), F.min(F.struct("_rep", "n")).alias("_p"))
        .where("_size > 1")
        .select("_band", F.col("_p._rep").alias("_pivot"), F.col("_p.n").alias("m"))
    )
    shared = written(lookup(banded, "_band", pivots))
    wanted = shared.select("_rep._id", "_rep._th").distinct()
    # Rows that repeat id and text are one text.
    texts = written(
        keyed(docs)
        .join(wanted, ["_id", "_th"], "left_semi")
        .dropDuplicates(["_id", "_th"])
        .select(F.struct("_id", "_th").alias("_rep"), "_text")
    )
    stars = written(
        shared.where("_rep <> _pivot")
        .where(_close(percent))
        .select(F.col("_pivot").alias("u"), F.col("_rep").alias("v"))
        .distinct()
    )
    joined = components(_confirm(stars, texts, percent))
    named = joined.select(F.col("id").alias("_rep"), F.col("component").alias("_c"))
    live = (
        shared.select("_rep", "n", "_band")
        .join(named, "_rep", "left")
        .withColumn("_c", F.coalesce("_c", "_rep"))
    )
    live = written(_undecided(live))
    release_shuffles(docs.sparkSession)
    rows = live.count()
    while rows:
        live, before = written(_undecided(_can_link(live, texts, percent))), rows
        release_shuffles(docs.sparkSession)
        rows = live.count()
        if 10 * rows > 9 * before:
            break
    rest = _pairs_left(live, texts, percent)
    rest = written(rest.join(stars, ["u", "v"], "left_anti"))
    more = _confirm(rest.select("u", "v"), texts, percent).join(rest, ["u", "v"])
    merged = components(more.select(F.col("c").alias("u"), F.col("d").alias("v")))
    release_shuffles(docs.sparkSession)
    final = (
        named.select("_c").distinct().union(live.select("_c").distinct()).distinct()
        .join(merged, F.col("_c") == F.col("id"), "left")
        .select("_c", F.coalesce("component", "_c").alias("_final"))
    )
    every = named.union(live.select("_rep", "_c").distinct()).distinct()
    return features, every.join(final, "_c").select("_rep", F.col("_final").alias("_component"))


def members(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(_id, _th, _n, _component) per row; ``_component`` is the first text of the group."""
    features, linked = classes(docs, percent)
    reps = features.where("_n > 0").groupBy("_set", "_n").agg(F.min(F.struct("_id", "_th")).alias("_rep"))
    named = reps.join(linked, "_rep", "left").select(
        "_set", "_n", F.coalesce("_component", "_rep").alias("_component")
    )
    out = features.select("_id", "_th", "_set", "_n").join(named, ["_set", "_n"], "left")
    return out.select("_id", "_th", "_n", F.coalesce("_component", F.struct("_id", "_th")).alias("_component"))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    component = F.col("_component._id")
    return members(docs, percent).select(
        shown_id(),
        F.col("_n").alias("n_shingles"),
        F.nullif(component, F.lit(NULL_ID)).alias("component_id"),
        (component == F.col("_id")).alias("kept"),
    )


def survivors(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that come first in their group. Repeated rows become one."""
    later = written(
        members(docs, percent)
        .where(F.col("_component") != F.struct("_id", "_th"))
        .select("_id", "_th")
        .distinct()
    )
    later = small_or_shuffled(later)
    mine = docs.select(F.struct(*docs.columns).alias("_row"), row_id().alias("_id"), text_key().alias("_th"))
    return mine.join(later, ["_id", "_th"], "left_anti").dropDuplicates(["_id", "_th"]).select("_row.*")
