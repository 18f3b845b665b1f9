"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Features are the distinct lower-cased letter runs of a text and their prefixes of four to
seven bytes, hashed to 2**18 columns. Grades come from labels: a document labelled clean has
grade 0; one labelled toxic has grade 1, 2 or 3 by how many of its words are typical of toxic
documents (none or one, few, many: thirds of the labelled toxic documents).

P(grade > k) = logistic(w x - t_k) with one weight vector for the ordered thresholds
t_0 < t_1 < t_2. Columns seen in fewer than ``LEAST`` labelled documents, or about as often
in toxic ones as chance has it, have no weight.
Fitted to at most ``ROWS`` labelled documents. Output: the expected severity
P(>0) + P(>1) + P(>2), the chance P(>0), and whether that is at least one half.

NULL and empty texts have no feature and get the severity of the thresholds alone. Without
labels of both kinds nothing is toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import labelled
from starmill.llm.common import CHUNK, pieces, prefix_hashes, span_hashes, text_buffer

COLUMNS = 1 << 18
PREFIXES = (4, 5, 6, 7)
ROWS = 20_000
LEAST = 5
# Columns whose count among toxic documents is no further than this from chance have no weight.
SIGMAS = 4.0
GRADES = 4
HELD_OUT = (3, 1)

_letters = np.zeros(256, bool)
_letters[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'")] = True
_letters[128:] = True


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (row, hashed column) pairs of the texts, sorted."""
    data, at = text_buffer(column)
    inside = _letters[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    rows = np.searchsorted(at, starts, "right") - 1
    prefix = prefix_hashes(data, lower=True)
    keys = [span_hashes(prefix, starts, ends) % np.uint64(COLUMNS // 2)]
    where = [rows]
    for size in PREFIXES:
        long = ends - starts > size
        s = starts[long]
        keys.append((span_hashes(prefix, s, s + size) + np.uint64(size)) % np.uint64(COLUMNS // 2) + np.uint64(COLUMNS // 2))
        where.append(rows[long])
    pairs = np.unique(np.concatenate(where) * COLUMNS + np.concatenate(keys).astype(np.int64))
    return pairs // COLUMNS, pairs % COLUMNS, len(at) - 1


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "_text", CHUNK // 2):
        row, column, n = features(batch.column(batch.schema.get_field_index("_text")))
        cuts = np.searchsorted(row, np.arange(n + 1))
        packed = [column[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "label", "x"]
        )


def _logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -60, 60)))


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def above(self, row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
        """P(grade > k) per text and k."""
        raw = np.bincount(row, self.weights[column], n)
        return _logistic(raw[:, None] - self.thresholds[None, :])


def grades(row, column, toxic: np.ndarray) -> np.ndarray:
    """0 for clean texts; 1 to 3 for toxic ones by their number of typical columns."""
    n = len(toxic)
    bad = np.bincount(column, toxic[row], COLUMNS)
    good = np.bincount(column, 1 - toxic[row], COLUMNS)
    bad_share, good_share = (bad + 0.5) / (toxic.sum() + 1), (good + 0.5) / (n - toxic.sum() + 1)
    typical = (bad >= LEAST) & (bad_share > 4 * good_share)
    hits = np.bincount(row, typical[column], n)[toxic > 0]
    low, high = np.quantile(hits, [1 / 3, 2 / 3])
    out = np.zeros(n, np.int64)
    out[toxic > 0] = 1 + (hits > low) + (hits > max(high, low))
    return out


def chosen(seen: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    """Columns seen often enough, and further from chance among toxic documents than SIGMAS."""
    spread = np.sqrt(seen * rate * (1 - rate))
    return (seen >= LEAST) & (np.abs(bad - seen * rate) > SIGMAS * spread)


def learn(row: np.ndarray, column: np.ndarray, toxic: np.ndarray, rounds: int = 300) -> Model:
    grade = grades(row, column, toxic)
    n = len(toxic)
    seen, bad = np.bincount(column, minlength=COLUMNS), np.bincount(column, toxic[row], COLUMNS)
    telling = chosen(seen, bad, toxic.mean())
    row, column = row[telling[column]], column[telling[column]]
    used, place = np.unique(column, return_inverse=True)
    shares = [(grade > k).mean() for k in range(GRADES - 1)]
    start = -np.log(np.clip(shares, 1e-4, 1 - 1e-4) / (1 - np.clip(shares, 1e-4, 1 - 1e-4)))
    # Thresholds as a first one and positive steps, so that they stay ordered.
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    parts = [np.zeros(len(used)), start[:1].copy(), steps]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    above = grade[:, None] > np.arange(GRADES - 1)[None, :]
    for k in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([parts[1], np.exp(parts[2])]))
        raw = np.bincount(row, parts[0][place], n)
        p = np.concatenate([np.ones((n, 1)), _logistic(raw[:, None] - thresholds), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        chance = np.maximum(p[at, grade] - p[at, grade + 1], 1e-9)
        slope = p * (1 - p)
        # Derivative of -log P(grade) by w x and by each threshold.
        by_raw = -(slope[at, grade] - slope[at, grade + 1]) / chance / n
        by_threshold = np.zeros(GRADES - 1)
        for j in range(GRADES - 1):
            upper = (grade == j + 1) * slope[:, j + 1] / chance
            lower = (grade == j) * slope[:, j + 1] / chance
            by_threshold[j] = (upper - lower).sum() / n
        tails = np.cumsum(by_threshold[::-1])[::-1]
        slopes = [
            np.bincount(place, by_raw[row], len(used)) + 2e-5 * parts[0],
            tails[:1],
            tails[1:] * np.exp(parts[2]),
        ]
        for q, g, a, b in zip(parts, slopes, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            q -= 0.05 * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.999**k)) + 1e-8)
    weights = np.zeros(COLUMNS, np.float32)
    weights[used] = parts[0]
    return Model(weights, np.cumsum(np.concatenate([parts[1], np.exp(parts[2])])))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    allowed = labelled.remainder(HELD_OUT[0]) != HELD_OUT[1]
    sample = labelled.sample(docs, labels, "toxic", rows, allowed)
    got = sorted(sample.mapInArrow(_rows, "doc_id bigint, label int, x binary").collect(), key=lambda r: r[0])
    toxic = np.array([r[1] > 0 for r in got], np.float64)
    if not 0 < toxic.sum() < len(toxic):
        return Model(np.zeros(COLUMNS, np.float32), np.array([30.0, 31.0, 32.0]))
    # A few documents at a time: all columns of all documents would be large as integers.
    packed = [r[2] for r in got]
    seen, bad = np.zeros(COLUMNS, np.int64), np.zeros(COLUMNS)
    for k in range(0, len(packed), 256):
        part = packed[k : k + 256]
        column = np.frombuffer(b"".join(part), np.int32)
        seen += np.bincount(column, minlength=COLUMNS)
        weights = np.repeat(toxic[k : k + 256], [len(x) // 4 for x in part])
        bad += np.bincount(column, weights, COLUMNS)
    telling = chosen(seen, bad, toxic.mean())
    kept = [x[telling[x]] for x in (np.frombuffer(p, np.int32) for p in packed)]
    column = np.concatenate(kept).astype(np.int64)
    return learn(np.repeat(np.arange(len(kept)), [len(x) for x in kept]), column, toxic)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", CHUNK // 2):
            above = model.above(*features(batch.column(batch.schema.get_field_index("_text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(above.sum(axis=1)), pa.array(above[:, 0].copy())],
                ["doc_id", "held_out", "severity", "p_toxic"],
            )

    return run


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, severity (0 to 3), p_toxic, toxic."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (labelled.remainder(HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    model = fit(docs, labels, rows)
    out = texts.mapInArrow(_scores(model), "doc_id bigint, held_out boolean, severity double, p_toxic double")
    return out.withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))
