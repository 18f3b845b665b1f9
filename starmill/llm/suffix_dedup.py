"""Remove byte strings of a fixed length that start in an earlier document too.

Method. Candidate places come first: every string of ``length`` bytes is represented by the
least hash of its 24-byte pieces, and only strings whose representative occurs in two
documents go on. Around each such representative (the anchor) a context is cut that holds
every string it stands for, so equal strings meet under equal anchors. Inside a task,
bounded batches of contexts become two shards. Each shard gets its Burrows-Wheeler
transform; the two are merged by refining their interleave ``length`` / 2 times: each round
deals the merged rows out by the symbol (two bytes) before them, which orders them by one
symbol more without comparing suffixes. The boundaries that appear in round k are where
common prefixes end at k symbols, so after the last round the blocks are the repeated
intervals.

A text that an earlier document has as a whole is removed as a whole, and takes no part in
the search: its strings start in that document as well. Contexts that are equal are one context, with the smallest document first, and a batch
leaves out contexts that share no more than the anchor. An anchor that
more than one document in 100 shares would make its group grow with the corpus; there, the
strings travel one by one under their own hash.

NULL texts are empty; documents shorter than ``length`` lose nothing. Matches never cross
documents. Rows that repeat a doc_id do not count as earlier for each other.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import sieve
from starmill.llm.common import (
    ODD, numbered, mix, pieces, prefix_hashes, release_shuffles, runs, shown_id, signed, sliding,
    small_or_shuffled, span_hashes, strided_hashes, text_buffer, written,
)
from starmill.llm.substring_dedup import Spans, collected
from starmill.operators.matching import lookup

LENGTH = 50
PIECE = 24
# Contexts merged at once inside a task; a larger group of one anchor is merged whole.
BATCH = 2000
# An anchor is hot beyond this share of the documents (so there are few hot anchors).
HOT_SHARE = 100
HOT_LEAST = 256
# Text scanned at once, in bytes: little for the caches, more where equal contexts meet.
SCANNED, SETTLED = 1 << 18, 1 << 20


def _col(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Strings:
    """The pieces of a chunk and the anchors among them.

    A piece is an anchor if some whole string around it has no piece of a smaller hash.
    """

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.data, self.offsets = text_buffer(_col(batch, "_text"))
        self.prefix = prefix_hashes(self.data)
        self.pieces = strided_hashes(self.prefix, PIECE)
        # 31 bits order the pieces; two that tie are both anchors, wherever they occur.
        rank = (self.pieces >> np.uint64(32)).astype(np.uint32)
        span = length - PIECE
        least = sliding(rank, span + 1)
        for end in self.offsets[1:-1]:
            least[max(end - length + 1, 0) : end] = 0
        self.least, self.rank = least, rank
        pad = np.zeros(span, np.uint32)
        top = sliding(np.concatenate([pad, least, pad]), span + 1, np.maximum)
        at = np.flatnonzero(top == rank) if len(least) else np.zeros(0, np.int64)
        sizes = np.diff(self.offsets)
        self.rows = np.searchsorted(self.offsets, at, "right") - 1
        whole = sizes[self.rows] >= length
        self.anchors, self.rows = at[whole], self.rows[whole]


def _offers(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", SCANNED):
            strings = Strings(batch, length)
            docs = _col(batch, "_doc").to_numpy(zero_copy_only=False)
            yield sieve.offer(strings.pieces[strings.anchors], strings.rows, docs, within=False)

    return run


def mark(starts: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Starts, made negative where the document holds the same bytes at other places too."""
    return np.where(repeated, -starts - 1, starts).astype(np.int32)


# ``_anchor`` is the anchor's place in the context; a NULL context is a span to remove.
CONTEXT = "_deal bigint, _bytes binary, _anchor int, _id bigint, _doc bigint, _start int, _end int"


def _contexts(length: int, hot: np.ndarray):
    """Cut contexts; those with an equal one of a smaller document in the chunk are settled."""
    reach = length - PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", SETTLED):
            strings = Strings(batch, length)
            keys = np.unique(_col(batch, "_keys").flatten().to_numpy()).view(np.uint64)
            deal = strings.pieces[strings.anchors]
            known = np.isin(deal, keys)
            at, row, deal, off = strings.anchors[known], strings.rows[known], deal[known], strings.offsets
            start = np.maximum(at - reach, off[row])
            end = np.minimum(at + length, off[row + 1])
            alone = np.isin(deal, hot)
            if alone.any():
                # Each string of a hot anchor by itself, dealt by its own hash.
                s, e, a = start[alone], end[alone], at[alone]
                count = e - s - length + 1
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                one = np.repeat(s, count) + step
                one = np.unique(one[strings.least[one] == np.repeat(strings.rank[a], count)])
                own = span_hashes(strings.prefix, one, one + length) >> np.uint64(1)
                start, end = np.append(start[~alone], one), np.append(end[~alone], one + length)
                row = np.append(row[~alone], np.searchsorted(off, one, "right") - 1)
                at, deal = np.append(at[~alone], one), np.append(deal[~alone], own)
            ids = _col(batch, "_id").to_numpy(zero_copy_only=False)
            docs = _col(batch, "_doc").to_numpy(zero_copy_only=False)
            body = span_hashes(strings.prefix, start, end)
            order = np.lexsort((start, row, ids[row], body, deal))
            start, end, row, deal, body, at = (x[order] for x in (start, end, row, deal, body, at))
            new = np.ones(len(deal), bool)
            new[1:] = (deal[1:] != deal[:-1]) | (body[1:] != body[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(deal) else np.zeros(0, int)
            sure = ids[row] != ids[row[first]]
            s, e, r = runs(start[sure], end[sure], row[sure])
            # A context that a document repeats travels once, marked.
            again = np.zeros(len(deal) + 1, bool)
            again[1:-1] = ~new[1:] & (row[1:] == row[:-1])
            left = np.flatnonzero(~sure & ~again[:-1])
            marked = again[1:][left]
            text = strings.data.tobytes()
            # A string dealt by its own hash needs no bytes: its group is all alike.
            cut = [
                text[a:b] if d >> 63 else b""
                for a, b, d in zip(start[left].tolist(), end[left].tolist(), deal[left].tolist(), strict=True)
            ]
            row_all = np.concatenate([row[left], r])
            base = off[row_all]
            spread = mix(mix(docs[r].view(np.uint64) * ODD) + s.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([deal[left], spread >> np.uint64(1)]))),
                    pa.array(cut + [None] * len(r), pa.binary()),
                    pa.array(np.concatenate([at[left] - start[left], np.zeros(len(r), np.int64)]).astype(np.int32)),
                    pa.array(ids[row_all]),
                    pa.array(docs[row_all]),
                    pa.array(
                        mark(
                            np.concatenate([start[left], s]) - base,
                            np.concatenate([marked, np.zeros(len(r), bool)]),
                        )
                    ),
                    pa.array((np.concatenate([end[left], e]) - base).astype(np.int32)),
                ],
                ["_deal", "_bytes", "_anchor", "_id", "_doc", "_start", "_end"],
            )

    return run


# --- Burrows-Wheeler transforms of fixed-width cyclic strings ----------------------------


def shard_transform(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of the rows in order of their first ``length`` symbols, and the symbol before each.

    ``symbols`` is a matrix of 16-bit codes; 0 is the end mark, at least one per row.
    """
    rank, known = symbols.astype(np.uint64), 1
    while known < min(length, 4):
        rank = (rank << np.uint64(16 * known)) | np.roll(rank, -known, 1)
        known *= 2
    order = None
    while order is None or known < length:
        if order is not None:
            shift = min(known, length - known)
            rank = (rank << np.uint64(32)) | np.roll(rank, -shift, 1)
            known += shift
        flat = rank.ravel()
        order = np.argsort(flat, kind="stable")
        sorted_ = flat[order]
        step = np.zeros(len(flat), np.uint64)
        step[1:] = sorted_[1:] != sorted_[:-1]
        flat = np.empty(len(flat), np.uint64)
        flat[order] = np.cumsum(step)
        rank = flat.reshape(symbols.shape)
    return order, np.roll(symbols, 1, 1).ravel()[order]


def merge_transforms(first: np.ndarray, second: np.ndarray, length: int):
    """Interleave two transforms so that rows are ordered by ``length`` symbols.

    Returns the interleave (True: a row of ``second``) and a block number per row; rows
    of one block share their first ``length`` symbols.
    """
    n, m = len(first), len(second)
    side = np.zeros(n + m, bool)
    side[n:] = True
    block = np.zeros(n + m, np.int32)
    symbol = np.empty(n + m, np.uint16)
    new = np.zeros(n + m, bool)
    for _ in range(length):
        symbol[side] = second
        symbol[~side] = first
        order = np.argsort(symbol, kind="stable")
        side = side[order]
        dealt, block = symbol[order], block[order]
        new[1:] = (dealt[1:] != dealt[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new, dtype=np.int32)
    return side, block


def _coded(contexts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Two rows per context, from its even and its odd places: codes of two bytes each.

    The codes are ranks of the pairs that occur, from 1, so that 0 can end a row. A merge
    of such rows takes half as many rounds as one of single bytes.
    """
    width = int(sizes.max()) // 2 * 2 + 4
    table = np.zeros((len(contexts), width), np.uint16)
    inside = np.arange(width) < sizes[:, None]
    table[inside] = np.frombuffer(b"".join(contexts), np.uint8)
    pairs = table[:, :-1] * np.uint16(256) + table[:, 1:]
    whole = inside[:, 1:]
    seen = np.zeros(1 << 16, bool)
    seen[pairs[whole]] = True
    if seen.all():
        raise OverflowError("every pair of bytes occurs: no code is left for the end")
    code = np.cumsum(seen).astype(np.uint16)
    coded = np.where(whole, code[pairs], np.uint16(0))
    half = width // 2 - 1
    return np.concatenate([coded[:, 0 : 2 * half : 2], coded[:, 1 : 2 * half + 1 : 2]], axis=1).reshape(-1, half)


def repeated_places(contexts: list[bytes], owners: np.ndarray, length: int) -> np.ndarray:
    """Matrix: does the string at this place of the context also occur with a smaller owner?

    ``length`` is even.
    """
    count = len(contexts)
    sizes = np.array([len(c) for c in contexts])
    symbols = _coded(contexts, sizes)
    width = symbols.shape[1]
    half = max(count // 2, 1) * 2
    parts = [symbols[:half], symbols[half:]]
    orders, transforms = zip(*(shard_transform(p, length // 2) for p in parts if len(p)), strict=True)
    if len(parts[1]):
        side, block = merge_transforms(*transforms, length // 2)
        place = np.empty(len(side), np.int64)
        place[~side] = orders[0]
        place[side] = orders[1] + half * width
    else:
        side, block = merge_transforms(transforms[0], transforms[0][:0], length // 2)
        place = orders[0]
    row = place // (2 * width)
    at = place % width * 2 + place // width % 2
    whole = at + length <= sizes[row]
    row, at, block = row[whole], at[whole], block[whole]
    owner = owners[row]
    gone = np.zeros((count, int(sizes.max()) + 1), bool)
    if len(row):
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        least = np.minimum.reduceat(owner, first)
        gone[row, at] = owner > np.repeat(least, np.diff(np.append(first, len(block))))
    return gone


def _could_repeat(contexts: list[bytes], anchors: np.ndarray, length: int) -> np.ndarray:
    """Contexts that share more than the anchor with another context of the batch.

    A string around the anchor reaches at least half of the rest to one side, so it shares
    the anchor with that half on the left or on the right.
    """
    sizes = np.array([len(c) for c in contexts])
    off = np.cumsum(sizes) - sizes
    prefix = prefix_hashes(np.frombuffer(b"".join(contexts), np.uint8))
    reach = (length - PIECE) // 2
    keep = np.zeros(len(contexts), bool)
    for a, b in ((anchors - reach, anchors + PIECE), (anchors, anchors + PIECE + reach)):
        fits = np.flatnonzero((a >= 0) & (b <= sizes))
        h = span_hashes(prefix, off[fits] + a[fits], off[fits] + b[fits])
        _, index, seen = np.unique(h, return_inverse=True, return_counts=True)
        keep[fits[seen[index] > 1]] = True
    return keep


def _merge(length: int):
    """From contexts sorted by (deal, bytes, id), the spans to remove."""

    def spans(docs, starts, ends):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(docs),
                pa.array(starts.astype(np.int32)),
                pa.array(ends.astype(np.int32)),
            ],
            ["_doc", "_start", "_end"],
        )

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        bytes_ = table["_bytes"]
        is_span = bytes_.is_null().to_numpy()
        ids, docs = table["_id"].to_numpy(), table["_doc"].to_numpy()
        start, end = table["_start"].to_numpy(), table["_end"].to_numpy()
        if is_span.any():
            yield spans(docs[is_span], start[is_span], end[is_span])
            table = table.filter(pa.array(~is_span))
            ids, docs, start, end = (x[~is_span] for x in (ids, docs, start, end))
        marked = start < 0
        start = np.where(marked, -start - 1, start)
        if not len(ids):
            return
        deal, texts = table["_deal"].to_numpy(), table["_bytes"].to_pylist()
        new = np.ones(len(ids), bool)
        new[1:] = deal[1:] != deal[:-1]
        new[1:] |= np.fromiter(map(operator.ne, texts[1:], texts[:-1]), bool, len(texts) - 1)
        first = np.flatnonzero(new)
        owner = ids[first]
        of = np.cumsum(new) - 1
        later = ids != owner[of]
        if later.any():
            yield spans(docs[later], mark(start, marked)[later], end[later])
        # Only groups with two different contexts can hold more repeats.
        group = deal[first]
        company = np.zeros(len(first), bool)
        company[1:] = group[1:] == group[:-1]
        company[:-1] |= group[1:] == group[:-1]
        chosen = np.flatnonzero(company)
        if not len(chosen):
            return
        contexts = [texts[first[i]] for i in chosen]
        keep = _could_repeat(contexts, table["_anchor"].to_numpy()[first[chosen]], length)
        chosen = chosen[keep]
        contexts = [c for c, k in zip(contexts, keep, strict=True) if k]
        if len(chosen) < 2:
            return
        gone = repeated_places(contexts, owner[chosen], length)
        where, at = np.nonzero(gone)
        s, e, w = runs(at, at + length, where)
        # Holders of the context with the smallest id: usually one row.
        holders = np.flatnonzero(~later)
        left = np.searchsorted(of[holders], chosen[w], "left")
        right = np.searchsorted(of[holders], chosen[w], "right")
        times = right - left
        each = np.repeat(left, times) + (
            np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        )
        rows = holders[each]
        s, e = np.repeat(s, times), np.repeat(e, times)
        if len(rows):
            yield spans(docs[rows], mark(start[rows] + s, marked[rows]), start[rows] + e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < BATCH:
                continue
            table = pa.Table.from_batches(held)
            deal = table["_deal"].to_numpy()
            # The last group may go on in the next batch.
            ends = np.flatnonzero(deal[1:] != deal[:-1]) + 1
            while len(ends) and count >= BATCH:
                cut = int(ends[max(int(np.searchsorted(ends, BATCH, "right")) - 1, 0)])
                yield from settle(table.slice(0, cut))
                table, deal = table.slice(cut), deal[cut:]
                ends = ends[ends > cut] - cut
                count -= cut
            held = table.combine_chunks().to_batches()
            count = table.num_rows
        if count:
            yield from settle(pa.Table.from_batches(held))

    return run


def everywhere(text: bytes, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans, and for marked ones every place where the text holds the same bytes."""
    if not (s < 0).any():
        return s, e
    starts, ends = list(s[s >= 0]), list(e[s >= 0])
    for a, b in {(-a - 1, b) for a, b in zip(s.tolist(), e.tolist(), strict=True) if a < 0}:
        place = text.find(text[a:b])
        while place >= 0:
            starts.append(place)
            ends.append(place + b - a)
            place = text.find(text[a:b], place + 1)
    return np.array(starts), np.array(ends)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text"):
        data, off = text_buffer(_col(batch, "_text"))
        n = batch.num_rows
        removed, count, digests = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        spans = Spans(batch)
        for row in range(n):
            text = data[off[row] : off[row + 1]]
            s, e = spans.of(row)
            s, e = everywhere(text.tobytes(), s, e) if len(s) else (s, e)
            s, e, _ = runs(s, e, np.zeros(len(s), np.int64))
            count[row], removed[row] = len(s), (e - s).sum()
            edges = np.concatenate([[0], np.stack([s, e], 1).ravel(), [len(text)]])
            digest = hashlib.sha256()
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                digest.update(text[a:b])
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                _col(batch, "_id"),
                pa.array(np.diff(off)),
                pa.array(removed),
                pa.array(count),
                pa.array(digests),
            ],
            ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def copies(base: DataFrame, length: int = LENGTH) -> DataFrame:
    """(_doc, _end): texts that an earlier document has as a whole, and their sizes."""
    size = F.octet_length("_text")
    digests = base.where(size >= length).select("_id", "_doc", size.alias("_end"), F.sha2("_text", 256).alias("_sha"))
    first = digests.groupBy("_sha").agg(F.min("_id").alias("_first"))
    later = lookup(digests, "_sha", first).where("_id > _first")
    return later.select("_doc", "_end")


def removed_spans(base: DataFrame, length: int = LENGTH) -> DataFrame:
    """(_doc, _starts, _ends): byte spans to remove, for documents that have any.

    ``base`` has one row (_id, _doc, _text) for each document.
    """
    whole = written(copies(base, length))
    originals = base.join(small_or_shuffled(whole), "_doc", "left_anti")
    pairs = written(sieve.repeated(originals.mapInArrow(_offers(length), sieve.SCHEMA)))
    release_shuffles(base.sparkSession)
    most = max(HOT_LEAST, base.count() // HOT_SHARE)
    # A document has one anchor in about 14 bytes, so few can be in that many documents.
    hot = [r[0] for r in pairs.groupBy("_h").count().where(F.col("count") > most).select("_h").collect()]
    table = base.join(sieve.by_document(pairs), "_doc")
    contexts = table.mapInArrow(_contexts(length, np.array(sorted(hot), np.int64).view(np.uint64)), CONTEXT)
    spans = (
        contexts.repartition("_deal")
        .sortWithinPartitions("_deal", "_bytes", "_id")
        .mapInArrow(_merge(length), "_doc bigint, _start int, _end int")
    )
    return collected(spans.union(whole.select("_doc", F.lit(0), "_end")))


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    every, base = numbered(docs)
    joined = every.join(removed_spans(base, length), "_doc", "left")
    out = joined.mapInArrow(
        _apply,
        "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )
    return out.select(shown_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")
