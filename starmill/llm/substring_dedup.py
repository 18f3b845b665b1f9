"""Remove word windows that were seen before, found by doubling the window length.

Level by level: short windows that repeat anywhere are extended to twice their length,
until windows of the full length remain. At the lengths below the full one, a full window
is represented by the least hash of its short windows; equal full windows have equal
representatives, so no repeat is lost, and only about one window in eight is shuffled.

NULL and empty texts have no words. Texts shorter than a window keep all words. Rows that
repeat doc_id and text are one document and get the same result; rows that repeat a
doc_id with another text are documents of equal rank, so an equal start in both is not
"earlier". NULL ids are equal ids, before all others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import sieve
from starmill.llm.common import (
    ODD, Words, mix, numbered, pieces, runs, shown_id, signed, sliding,
)

WINDOW = 20


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (
        batch.column(batch.schema.get_field_index("_id")).to_numpy(zero_copy_only=False),
        batch.column(batch.schema.get_field_index("_doc")).to_numpy(zero_copy_only=False),
    )


def _candidates(batch: pa.RecordBatch, words: Words, shorter: int, window: int) -> np.ndarray:
    """Starts of full windows whose representative at the shorter length repeats."""
    _, whole = words.grams(window)
    if not shorter:
        return whole
    grams, _ = words.grams(shorter)
    least = sliding(grams, window - shorter + 1)
    known = batch.column(batch.schema.get_field_index("_keys")).flatten().to_numpy()
    return whole & np.isin(least, known.view(np.uint64))


def _offers(length: int, shorter: int, window: int):
    """Offer each candidate window's representative at ``length``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            words = Words(batch.column(batch.schema.get_field_index("_text")))
            _, docs = _columns(batch)
            grams, _ = words.grams(length)
            fits = _candidates(batch, words, shorter, window)
            if not len(fits):
                continue
            # A gram stands for a window if it is the least of one that fits.
            least = np.where(fits, sliding(grams, window - length + 1), np.uint64(0))
            span = window - length
            around = np.concatenate([np.zeros(span, np.uint64), least, np.zeros(span, np.uint64)])
            at = np.flatnonzero((sliding(around, span + 1, np.maximum) == grams) & (grams != 0))
            yield sieve.offer(grams[at], words.rows[at], docs, within=True)

    return run


# ``_end`` is 0 for a window whose fate is open: its end is known from its start.
FULL = "_deal bigint, _id bigint, _doc bigint, _start int, _end int"
# A larger chunk settles more windows before they are shuffled.
SETTLED = 4 << 20


def _full_windows(shorter: int, window: int):
    """Candidate windows at full length; those with an earlier twin in the chunk are sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", SETTLED):
            words = Words(batch.column(batch.schema.get_field_index("_text")))
            ids, docs = _columns(batch)
            at = np.flatnonzero(_candidates(batch, words, shorter, window))
            grams, _ = words.grams(window)
            g, row = grams[at], words.rows[at]
            place = at - words.ranges[row]
            order = np.lexsort((place, ids[row], g))
            g, row, place = g[order], row[order], place[order]
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(g) else np.zeros(0, int)
            sure = (ids[row] != ids[row[first]]) | (place != place[first])
            open_ = np.flatnonzero(~sure)
            s, e, r = runs(place[sure], place[sure] + window, row[sure])
            row_all = np.concatenate([row[open_], r])
            starts = np.concatenate([place[open_], s])
            spread = mix(
                mix(docs[r].view(np.uint64) * ODD) + s.astype(np.uint64)
            ) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([g[open_], spread]))),
                    pa.array(ids[row_all]),
                    pa.array(docs[row_all]),
                    pa.array(starts.astype(np.int32)),
                    pa.array(np.concatenate([np.zeros(len(open_), np.int64), e]).astype(np.int32)),
                ],
                ["_deal", "_id", "_doc", "_start", "_end"],
            )

    return run


def _later(window: int):
    """From rows sorted by (deal, id, start): sure spans, and windows after the first of a deal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal_, id_, start_ = None, 0, 0
        for batch in batches:
            deal, ids, docs, start, end = (batch.column(k).to_numpy() for k in range(5))
            if not len(deal):
                continue
            new = np.ones(len(deal), bool)
            new[1:] = deal[1:] != deal[:-1]
            new[0] = deal_ is None or deal[0] != deal_
            first = np.flatnonzero(new)
            # Rows before the first new deal go on with the deal of the last batch.
            group = np.cumsum(new)
            first_id = np.append(id_, ids[first])[group]
            first_start = np.append(start_, start[first])[group]
            gone = (end > 0) | (ids != first_id) | (start != first_start)
            deal_, id_, start_ = deal[-1], first_id[-1], first_start[-1]
            end = np.where(end > 0, end, start + window).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[gone]) for x in (docs, start, end)], ["_doc", "_start", "_end"]
            )

    return run


class Spans:
    """The spans that were collected per document, read by row."""

    def __init__(self, batch: pa.RecordBatch):
        lists = [batch.column(batch.schema.get_field_index(c)) for c in ("_starts", "_ends")]
        self.has = lists[0].is_valid().to_numpy(zero_copy_only=False)
        self.lists = lists

    def of(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.has[row]:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        s, e = (x[row].values.to_numpy() for x in self.lists)
        return s, e


def collected(spans: DataFrame) -> DataFrame:
    """(_doc, _starts, _ends) of (_doc, _start, _end)."""
    return spans.groupBy("_doc").agg(
        F.collect_list("_start").alias("_starts"),
        F.collect_list("_end").alias("_ends"),
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text"):
        words = Words(batch.column(batch.schema.get_field_index("_text")))
        ids, _ = _columns(batch)
        n = batch.num_rows
        sizes = np.diff(words.ranges)
        removed, digests = np.zeros(n, np.int64), []
        spans = Spans(batch)
        for row in range(n):
            a, b = words.ranges[row], words.ranges[row + 1]
            keep = np.ones(b - a, bool)
            s, e = spans.of(row)
            if len(s):
                change = np.zeros(b - a + 1, np.int64)
                np.add.at(change, s, 1)
                np.add.at(change, e, -1)
                keep = np.cumsum(change[:-1]) == 0
            removed[row] = (b - a) - keep.sum()
            raw = words.data[words.offsets[row] : words.offsets[row + 1]].tobytes()
            parts = raw.split()
            if removed[row]:
                parts = [p for p, k in zip(parts, keep, strict=True) if k]
            digests.append(hashlib.sha256(b" ".join(parts)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(sizes.astype(np.int64)), pa.array(removed), pa.array(digests)],
            ["_id", "n_words", "n_removed", "kept_sha256"],
        )


def removed_spans(base: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_doc, _starts, _ends): word spans to remove, for documents that have any.

    ``base`` has one row (_id, _doc, _text) for each document.
    """
    shorter, table = 0, base
    length = max(window // 4, 1)
    while length < window:
        pairs = sieve.repeated(table.mapInArrow(_offers(length, shorter, window), sieve.SCHEMA))
        # Documents without a repeated key drop out; the shuffle of the texts is reused.
        table = base.join(sieve.by_document(pairs), "_doc")
        shorter, length = length, length * 2
    full = table.mapInArrow(_full_windows(shorter, window), FULL)
    spans = (
        full.repartition("_deal")
        .sortWithinPartitions("_deal", "_id", "_start")
        .mapInArrow(_later(window), "_doc bigint, _start int, _end int")
    )
    return collected(spans)


def deduplicate(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    every, base = numbered(docs)
    joined = every.join(removed_spans(base, window), "_doc", "left")
    out = joined.mapInArrow(
        _apply, "_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )
    return out.select(shown_id(), "n_words", "n_removed", "kept_sha256")
