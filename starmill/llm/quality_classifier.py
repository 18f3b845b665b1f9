"""Quality of documents: random-indexing word vectors, pooled, into a two-layer network.

Word vectors. A token (a run of letters, of digits, or of other signs) falls into one of 8192
slots, each with a fixed sparse index vector of four entries of +1 or -1. A slot's context
vector is the sum of the index vectors of the two tokens on either side, over all documents;
it is counted in every partition and added up by Spark. The table has a fixed size.

Pooling. A document is the weighted mean of its tokens' context vectors (frequent slots count
less), the mean of their index vectors, the length of both means, and how much neighbours
agree. The network (tanh layer, logistic output) is fitted in numpy to at most ``ROWS``
labelled documents; its temperature is fitted to a fifth of them that it does not learn from.

NULL and empty texts are the zero vector and get the score of that vector. Without labels of
both kinds every score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import labelled
from starmill.llm.common import ODD, CHUNK, mix, pieces, prefix_hashes, span_hashes, text_buffer

SLOTS, WIDTH, ENTRIES = 8192, 32, 4
REACH = 2
ROWS = 20_000
HIDDEN = 32
HELD_OUT = (3, 1)

_kind = np.full(256, 3, np.uint8)
_kind[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_kind[128:] = 1
_kind[list(b"0123456789")] = 2
_kind[list(b" \t\n\x0b\x0c\r")] = 0


def index_vectors() -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(7))
    out = np.zeros((SLOTS, WIDTH), np.float32)
    for row in out:
        row[random.permutation(WIDTH)[:ENTRIES]] = random.choice([-1, 1], ENTRIES)
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Slot and row of each token."""
    data, at = text_buffer(column)
    kind = _kind[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[at] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    slots = span_hashes(prefix_hashes(data), starts, ends) % np.uint64(SLOTS)
    return slots.astype(np.int64), np.searchsorted(at, starts, "right") - 1, len(at) - 1


def _around(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the vectors of the neighbours within REACH in the same row."""
    out = np.zeros_like(vectors)
    for step in range(1, REACH + 1):
        same = (rows[step:] == rows[:-step])[:, None]
        out[step:] += vectors[:-step] * same
        out[:-step] += vectors[step:] * same
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = index_vectors()
    total, count = np.zeros((SLOTS, WIDTH), np.int64), np.zeros(SLOTS, np.int64)
    for batch in pieces(batches, "_text", CHUNK // 4):
        slots, rows, _ = tokens(batch.column(0))
        if not len(slots):
            continue
        around = _around(index[slots], rows)
        order = np.argsort(slots, kind="stable")
        sorted_ = slots[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        total[sorted_[first]] += np.add.reduceat(around[order], first, axis=0).astype(np.int64)
        count += np.bincount(slots, minlength=SLOTS)
    used = np.flatnonzero(count)
    columns = [used, count[used], *total[used].T]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c)) for c in columns],
        ["_slot", "_count", *(f"_v{k}" for k in range(WIDTH))],
    )


def context_vectors(docs: DataFrame) -> np.ndarray:
    """A weighted vector per slot, from all documents. SLOTS x WIDTH, whatever the input."""
    names = ["_count", *(f"_v{k}" for k in range(WIDTH))]
    schema = "_slot bigint, " + ", ".join(f"{n} bigint" for n in names)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("_text"))
    rows = (
        texts.mapInArrow(_contexts, schema)
        .groupBy("_slot")
        .agg(*(F.sum(n).alias(n) for n in names))
        .collect()
    )
    out = np.zeros((SLOTS, WIDTH), np.float64)
    counts = np.zeros(SLOTS)
    for row in rows:
        counts[row[0]] = row[1]
        out[row[0]] = row[2:]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    out = out / np.maximum(length, 1e-9)
    seen = counts > 0
    if seen.any():
        out[seen] -= np.average(out[seen], axis=0, weights=counts[seen])
    share = counts / max(counts.sum(), 1)
    return (out * (1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def pooled(column: pa.Array, index: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A feature row per text."""
    slots, rows, n = tokens(column)
    out = np.zeros((n, 2 * WIDTH + 4), np.float64)
    if not len(slots):
        return out
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    row = rows[first]
    size = np.diff(np.append(first, len(rows)))[:, None]
    own = index[slots]
    means = [np.add.reduceat(v, first, axis=0) / size for v in (context[slots], own)]
    out[row, :WIDTH], out[row, WIDTH : 2 * WIDTH] = means
    for k, mean in enumerate(means):
        out[row, 2 * WIDTH + k] = np.linalg.norm(mean, axis=1)
    for step in (1, 2):
        agree = np.zeros(len(slots))
        agree[step:] = (own[step:] * own[:-step]).sum(axis=1) * (rows[step:] == rows[:-step])
        out[row, 2 * WIDTH + 1 + step] = np.add.reduceat(agree, first) / size[:, 0]
    return out


def _features(index: np.ndarray, context: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", CHUNK // 4):
            x = pooled(batch.column(batch.schema.get_field_index("_text")), index, context)
            rows = [r.astype(np.float32).tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())],
                ["doc_id", "label", "x"],
            )

    return run


class Network:
    """Two layers on standardised features, with a temperature on the output."""

    def __init__(self, x: np.ndarray, y: np.ndarray, tune: np.ndarray, rounds: int = 400):
        self.mean, self.scale = x[~tune].mean(0), x[~tune].std(0) + 1e-6
        random = np.random.Generator(np.random.PCG64(3))
        shape = x.shape[1]
        w = [random.normal(0, shape**-0.5, (shape, HIDDEN)), np.zeros(HIDDEN),
             random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        z, t = self.scaled(x[~tune]), y[~tune]
        for k in range(1, rounds + 1):
            hidden = np.tanh(z @ w[0] + w[1])
            gap = (_logistic(hidden @ w[2] + w[3]) - t) / len(t)
            back = np.outer(gap, w[2]) * (1 - hidden**2)
            slopes = [z.T @ back + 1e-4 * w[0], back.sum(0), hidden.T @ gap + 1e-4 * w[2], gap.sum(keepdims=True)]
            for p, g, a, b in zip(w, slopes, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.02 * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.999**k)) + 1e-8)
        self.weights = w
        self.temperature = 1.0
        if tune.any():
            raw, target = self.raw(x[tune]), y[tune]
            trials = np.exp(np.linspace(-1.5, 2.0, 71))
            losses = [
                np.mean(np.logaddexp(0, raw / t) - target * raw / t) for t in trials
            ]
            self.temperature = float(trials[int(np.argmin(losses))])

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(self.scaled(x) @ w[0] + w[1]) @ w[2] + w[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.raw(x) / self.temperature)


class Constant:
    def __init__(self, share: float):
        self.share = share

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def _logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS):
    """(model, index vectors, context vectors) from ``docs`` and the labels not held out."""
    index, context = index_vectors(), context_vectors(docs)
    allowed = labelled.remainder(HELD_OUT[0]) != HELD_OUT[1]
    sample = labelled.sample(docs, labels, "quality", rows, allowed)
    got = sample.mapInArrow(_features(index, context), "doc_id bigint, label int, x binary").collect()
    got.sort(key=lambda r: r[0])
    y = np.array([r[1] for r in got], np.float64)
    if not 0 < y.sum() < len(y):
        return Constant(float(y.mean()) if len(y) else 0.5), index, context
    x = np.array([np.frombuffer(r[2], np.float32) for r in got], np.float64)
    tune = mix(np.array([r[0] for r in got], np.int64).view(np.uint64) * ODD) % np.uint64(5) == 0
    if tune.all() or not 0 < y[~tune].sum() < (~tune).sum():
        tune[:] = False
    return Network(x, y, tune), index, context


def _scores(model, index: np.ndarray, context: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", CHUNK // 4):
            text = batch.column(batch.schema.get_field_index("_text"))
            p = model.probability(pooled(text, index, context))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (labelled.remainder(HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    out = texts.mapInArrow(_scores(*fit(docs, labels, rows)), "doc_id bigint, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _filter(model, index: np.ndarray, context: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", CHUNK // 4):
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(model.probability(pooled(text, index, context)) >= 0.5))

    return run


def accepted(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` with a score of at least one half, unchanged."""
    return docs.mapInArrow(_filter(*fit(docs, labels, rows)), docs.schema)
