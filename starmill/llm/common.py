"""What several operators share: document keys, staged tables, vectorised text scanning.

A document is a row. ``_id`` is its doc_id, with NULL counted as the smallest id. Rows that
repeat an id with another text are told apart by a digest of the text (``_th``, 128 bits), or
by a number that no other document has (``_doc``). Rows that repeat both are one document,
and each of them is returned with the same result. A NULL text is empty.
"""

from __future__ import annotations

import gc
import hashlib
import os
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = -(2**63)
# Words are runs of other characters than these.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Text scanned at once inside a task, in bytes. A longer document is scanned whole.
CHUNK = 1 << 20
# Longer words, in bytes, get a cryptographic hash.
LONG_WORD = 128
# An odd factor, for spreading consecutive numbers over 64 bits.
ODD = np.uint64(0x9E3779B97F4A7C15)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers that this session starts import this package from its folder.

    On a cluster the package is delivered with --py-files or an installed wheel; then the
    folder is absent on executors and the entry does nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID))


def text_key() -> Column:
    """128 bits that tell texts apart."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def keyed(docs: DataFrame) -> DataFrame:
    """(_id, _th, _text); every consumer uses just these, so Spark can reuse their shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(row_id().alias("_id"), text_key().alias("_th"), text.alias("_text"))


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Twice (_id, _doc, _text): all rows, and one row for each document.

    ``_doc`` is the id itself where an id has one row, which is told by the ids alone. For the
    rows of a repeated id it is a hash of id and text, and that it meets no other document is
    checked, not assumed.
    """
    ids = docs.select(row_id().alias("_id"))
    several = written(ids.groupBy("_id").count().where("count > 1").select("_id"))
    if several.isEmpty():
        text = F.coalesce(F.col("text"), F.lit("")).alias("_text")
        plain = docs.select(row_id().alias("_id"), row_id().alias("_doc"), text)
        return plain, plain
    several = small_or_shuffled(several)
    repeated = keyed(docs).select("_id", "_th").join(several, "_id", "left_semi").distinct()
    single = ids.join(several, "_id", "left_anti").withColumnRenamed("_id", "_doc")
    for seed in range(100):
        names = written(repeated.withColumn("_doc", F.xxhash64(F.lit(seed), "_id", "_th")))
        taken = single.join(names.select("_doc"), "_doc", "left_semi")
        if names.select("_doc").distinct().count() == names.count() and taken.isEmpty():
            break
    else:
        raise ValueError("no free numbers for rows that repeat an id")
    known = keyed(docs).join(small_or_shuffled(names), ["_id", "_th"], "left")
    every = known.select("_id", F.coalesce("_doc", "_id").alias("_doc"), "_text", F.col("_doc").isNull().alias("_own"))
    copies = every.where(~F.col("_own")).groupBy("_doc").agg(F.first("_id").alias("_id"), F.first("_text").alias("_text"))
    once = every.where("_own").drop("_own").unionByName(copies)
    return every.drop("_own"), once


def shown_id(column: str = "_id") -> Column:
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias("doc_id")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors and the driver share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="starmill-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and return the written table."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of (id, text hash), 16 bytes each, that a join may broadcast.
BROADCAST_IDS = 1_000_000


def small_or_shuffled(table: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """A written ``table``, hinted for broadcast if it has at most ``rows`` rows.

    Joining texts to a short list then moves no text; a longer list is shuffled with them.
    """
    return F.broadcast(table) if table.count() <= rows else table


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that only cut lineages had used.

    Its cleaner acts when the driver collects garbage, which a mostly idle driver rarely does.
    References from Python are dropped by a thread of their own, hence the second turn.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


# --- inside tasks -----------------------------------------------------------------------


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK):
    """Slices of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_buffer(batch.column(batch.schema.get_field_index(column)))[1][1:]
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + limit, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows back to back, and the offsets of the rows."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


_blank = np.zeros(256, bool)
_blank[list(BLANKS)] = True
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes; never 0."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h | np.uint64(1 << 63)


_codes = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
_folded_codes = _codes[_fold]
_BASE = 0xA24BAED4963EE407
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(n + 1, CHUNK + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """P with sum(code[b] * base**i) over a prefix; spans of equal bytes hash alike by span_hashes."""
    powers, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_folded_codes if lower else _codes)[data] * powers[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def strided_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all spans of ``size`` bytes; equal to span_hashes at every start."""
    n = len(prefix) - size
    if n <= 0:
        return np.zeros(0, np.uint64)
    _, inverse = _power_tables(len(prefix))
    return mix((prefix[size:] - prefix[:n]) * inverse[:n])


class Words:
    """The words of a chunk: byte starts and ends, row, hash, and each row's word range."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = data, at = text_buffer(column)
        inside = ~_blank[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.rows = np.searchsorted(at, self.starts, "right") - 1
        self.hashes = span_hashes(prefix_hashes(data, lower), self.starts, self.ends)
        # Texts can be made whose sums of powers agree over a thousand bytes or more.
        for k in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            word = data[self.starts[k] : self.ends[k]]
            digest = hashlib.blake2b((_fold[word] if lower else word).tobytes(), digest_size=8).digest()
            self.hashes[k] = np.frombuffer(digest, np.uint64)[0] | np.uint64(1 << 63)
        self.ranges = np.searchsorted(self.rows, np.arange(len(at)), "left")

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows of the chunk, and which of them lie in one row."""
        return windows(self.hashes, self.rows, n)


def windows(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total, done, step = hashes.copy(), 1, _BASE
    # Double the length as long as it fits, then add single words.
    while done * 2 <= n:
        total = total[: len(total) - done] + total[done:] * np.uint64(step)
        step = step * step % 2**64
        done *= 2
    while done < n:
        size = len(hashes) - done
        total = total[:size] + hashes[done:][: len(total[:size])] * np.uint64(pow(_BASE, done, 2**64))
        done += 1
    return mix(total[:count]), rows[:count] == rows[n - 1 :]


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or by ``pick``) of each run of ``width`` values."""
    if len(values) < width:
        return values[:0]
    out, span = values, 1
    while span * 2 <= width:
        out = pick(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def runs(starts: np.ndarray, ends: np.ndarray, owner: np.ndarray):
    """Merge touching or overlapping spans of the same owner, sorted by (owner, start)."""
    if not len(starts):
        return starts, ends, owner
    order = np.lexsort((starts, owner))
    s, e, o = starts[order].astype(np.int64), ends[order].astype(np.int64), owner[order]
    _, group = np.unique(o, return_inverse=True)
    lift = group.astype(np.int64) * (int(e.max()) + 2)
    far = np.maximum.accumulate(e + lift)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] + lift[1:] > far[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return s[first], far[last] - lift[last], o[first]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
