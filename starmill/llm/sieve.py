"""Find content keys that occur more than once, without gathering a hot key in one task.

Each chunk of documents offers (key, document) pairs. A key that repeats inside a chunk is
proven there: its pairs travel under keys of their own, and one stand-in asks on behalf of
the chunk. So a group holds at most one row per chunk, whatever the key's frequency.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ODD, mix, signed

# ``_h`` is NULL where it equals ``_deal``, so that it takes no room.
SCHEMA = "_deal bigint, _h bigint, _doc bigint, _kind tinyint"
SINGLE, STAND_IN, PROVEN = 0, 1, 2


def offer(keys, rows, docs, within: bool) -> pa.RecordBatch:
    """Pairs of one chunk; ``docs`` has the number of the document of each row. ``within``: a key twice in one document counts as repeated."""
    order = np.lexsort((rows, keys))
    k, r = keys[order], rows[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_pair = new_key.copy()
    new_pair[1:] |= r[1:] != r[:-1]
    firsts = np.flatnonzero(new_key)
    if within:
        sizes = np.diff(np.append(firsts, len(k)))
        proven = sizes > 1
    elif len(k):
        owner = docs[r]
        proven = np.minimum.reduceat(owner, firsts) != np.maximum.reduceat(owner, firsts)
    else:
        proven = np.zeros(0, bool)
    known = proven[np.cumsum(new_key) - 1] if len(k) else proven
    pairs = np.flatnonzero(new_pair)
    kind = np.where(known[pairs], PROVEN, SINGLE)
    stand = firsts[proven]
    at = np.concatenate([pairs, stand])
    kind = np.concatenate([kind, np.full(len(stand), STAND_IN)]).astype(np.int8)
    h, row = k[at], r[at]
    spread = mix(h + mix(docs[row].view(np.uint64) * ODD + np.uint64(1)))
    deal = np.where(kind == PROVEN, spread >> np.uint64(1), h)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed(deal)),
            pa.array(signed(h), mask=kind != PROVEN),
            pa.array(docs[row]),
            pa.array(kind),
        ],
        ["_deal", "_h", "_doc", "_kind"],
    )


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by deal, the pairs whose key is proven or has company."""
    held: pa.Table | None = None

    def sift(table: pa.Table) -> pa.RecordBatch:
        deal = table["_deal"].to_numpy()
        kind = table["_kind"].to_numpy()
        alike = np.zeros(len(deal), bool)
        alike[1:] = deal[1:] == deal[:-1]
        alike[:-1] |= deal[1:] == deal[:-1]
        keep = np.flatnonzero((kind == PROVEN) | ((kind == SINGLE) & alike))
        if not len(keep):
            return None
        h = table["_h"].combine_chunks().fill_null(0).to_numpy()
        h = np.where(kind == PROVEN, h, deal)
        docs = table["_doc"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(docs[keep])], ["_h", "_doc"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        deal = table["_deal"].to_numpy()
        if not len(deal):
            continue
        cut = int(np.searchsorted(deal, deal[-1], "left"))
        held = table.slice(cut)
        if cut and (out := sift(table.slice(0, cut))) is not None:
            yield out
    if held is not None and (out := sift(held)) is not None:
        yield out


def repeated(offers: DataFrame) -> DataFrame:
    """(_h, _doc) of the offered pairs whose key was offered by two documents or chunks."""
    dealt = offers.repartition("_deal").sortWithinPartitions("_deal")
    return dealt.mapInArrow(_keep, "_h bigint, _doc bigint")


def by_document(pairs: DataFrame) -> DataFrame:
    """(_doc, _keys): a document's repeated keys; no more than it has windows."""
    return pairs.groupBy("_doc").agg(F.collect_list("_h").alias("_keys"))
