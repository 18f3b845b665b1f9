"""Log probabilities of documents under an interpolated modified Kneser-Ney bigram model.

Counting. A first pass names the most frequent words (a list of at most 1000). A second one
counts bigrams: each chunk sends, per word, its successors and their counts to the word's
bucket; the successors of a frequent word are spread over 64 buckets. A bucket's bigrams
are sorted by hash and written as one array file, and what the words need from them (token
count, number of distinct predecessors, successors seen once, twice, more often) is sent
on and written as array files by ranges of the word hash. Both sets of files lie in the
shared folder, grow with the training text, and are memory-mapped by the scoring workers.

Model. p(w|h) = max(c(hw) - D(c), 0) / c(h) + gamma(h) p1(w) with
p1(w) = max(a(w) - D'(a), 0) / A + gamma' / (V + 1), a(w) being the number of distinct words
before w. The three discounts of either level come from counts of counts over all training
text. The chance 1 / (V + 1) is also that of an unknown word, so all chances sum to one.
Words are hashed to 48 bits; two of ten million words collide with a chance of 0.2.

Tokens are the words, A-Z lower-cased, and one end per document; the first word follows a
start mark, which is not a token. NULL texts are empty: they hold just the end. A NULL
doc_id counts as the empty text when documents are drawn for training. Without training
text every chance is 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import hash_arrays
from starmill.llm.common import (
    ODD, Words, importable, keyed, mix, pieces, shared_folder, signed,
)

HELD_OUT = (7, 2)
HOT_WORDS = 1000
SPREAD = 64
# Training tokens per bucket of the array files, and tokens counted at once in a task.
BUCKET_TOKENS = 1 << 21
COUNTED = 1 << 21
LEAST_BUCKETS = 64
BITS = 48
START, END = (int(x) for x in mix(np.array([1, 2], np.uint64) * ODD) >> np.uint64(64 - BITS - 1) & np.uint64(2**BITS - 1))


def _is_held_out():
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT[0] == HELD_OUT[1]


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predecessor and token of every token in the chunk, and the token's row."""
    words = Words(column, lower=True)
    sizes = np.diff(words.ranges)
    stops = np.cumsum(sizes + 1)
    tokens = np.full(int(stops[-1]) if len(stops) else 0, END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[stops - 1] = False
    tokens[inner] = words.hashes & np.uint64(2**BITS - 1)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[stops - sizes - 1] = START
    return before, tokens, np.repeat(np.arange(len(sizes)), sizes + 1)


def _text(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(batch.schema.get_field_index("_text"))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token count of a chunk, under the start mark, and its most frequent predecessors."""
    for batch in pieces(batches, "_text"):
        before, tokens, _ = _pairs(_text(batch))
        words, counts = np.unique(before, return_counts=True)
        often = counts * 4 * HOT_WORDS > len(before)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(words[often].astype(np.int64), -1)),
                pa.array(np.append(counts[often], len(tokens)).astype(np.int64)),
            ],
            ["_word", "_count"],
        )


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of a byte array that follow each other."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _successors(buckets: int, hot: np.ndarray):
    """Rows (bucket, word, successors, counts) of the bigrams of about COUNTED tokens."""

    def flush(before: list[np.ndarray], tokens: list[np.ndarray]) -> pa.RecordBatch:
        h, w = np.concatenate(before), np.concatenate(tokens)
        sub = np.where(np.isin(h, hot), w % np.uint64(SPREAD), np.uint64(0))
        group = h * np.uint64(SPREAD) + sub
        order = np.lexsort((w, group))
        group, w = group[order], w[order]
        new_group = np.ones(len(w), bool)
        new_group[1:] = group[1:] != group[:-1]
        new = new_group.copy()
        new[1:] |= w[1:] != w[:-1]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(w))).astype(np.uint32)
        starts = np.flatnonzero(new_group[first])
        ends = np.append(starts[1:], len(first))
        names = group[first[starts]]
        six = w[first].view(np.uint8).reshape(-1, 8)[:, :6]
        return pa.RecordBatch.from_arrays(
            [
                pa.array((mix(names * ODD) % np.uint64(buckets)).astype(np.int32)),
                pa.array(signed(names // np.uint64(SPREAD))),
                _binary(np.ascontiguousarray(six).ravel(), ends * 6),
                _binary(counts.view(np.uint8), ends * 4),
            ],
            ["_bucket", "_word", "_next", "_counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, tokens, size = [], [], 0
        for batch in pieces(batches, "_text"):
            h, w, _ = _pairs(_text(batch))
            before.append(h)
            tokens.append(w)
            size += len(w)
            if size >= COUNTED:
                yield flush(before, tokens)
                before, tokens, size = [], [], 0
        if size:
            yield flush(before, tokens)

    return run


def _bigram(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h * ODD) + w)


def _grouped(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.Table]]:
    """Tables of one value of a column each, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        index = batch.schema.get_field_index(name)
        values = batch.column(index).to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(values)), strict=True):
            part = batch.slice(a, b - a)
            if held and held[0].column(index)[0].as_py() != int(values[a]):
                yield held[0].column(index)[0].as_py(), pa.Table.from_batches(held)
                held = []
            if part.num_rows:
                held.append(part)
    if held:
        index = held[0].schema.get_field_index(name)
        yield held[0].column(index)[0].as_py(), pa.Table.from_batches(held)


WORD_ROWS = "_range int, _key bigint, _c bigint, _a bigint, _n1 bigint, _n2 bigint, _n3 bigint"


def _word_rows(ranges: int, key, c, a, n1, n2, n3) -> pa.RecordBatch:
    where = (key.astype(np.float64) * (ranges / 2.0**BITS)).astype(np.int32)
    columns = [where, signed(key), *(x.astype(np.int64) for x in (c, a, n1, n2, n3))]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in columns], ["_range", "_key", "_c", "_a", "_n1", "_n2", "_n3"]
    )


def _bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = pa.concat_arrays(column.chunks).cast(pa.large_binary())
    at = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(array.buffers()[2], np.uint8)[at[0] : at[-1]], np.diff(at)


def _count_bigrams(folder: str, ranges: int):
    """Write each bucket's bigram counts; pass on what words need, and counts of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, table in _grouped(batches, "_bucket"):
            data, sizes = _bytes_of(table["_next"])
            h = np.repeat(table["_word"].to_numpy().view(np.uint64), sizes // 6)
            wide = np.zeros((len(h), 8), np.uint8)
            wide[:, :6] = data.reshape(-1, 6)
            w = wide.view(np.uint64).ravel()
            counts = _bytes_of(table["_counts"])[0].view(np.uint32).astype(np.int64)
            order = np.lexsort((w, h))
            h, w, counts = h[order], w[order], counts[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
            first = np.flatnonzero(new)
            h, w, counts = h[first], w[first], np.add.reduceat(counts, first)
            key = _bigram(h, w)
            order = np.argsort(key)
            hash_arrays.put(folder, f"bigrams-{bucket}", key[order], [counts[order]])
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            zero = np.zeros(len(starts), np.int64)
            seen = [np.add.reduceat((counts == k).astype(np.int64), starts) for k in (1, 2)]
            more = np.add.reduceat((counts > 2).astype(np.int64), starts)
            yield _word_rows(ranges, h[starts], zero, zero, *seen, more)
            order = np.argsort(w, kind="stable")
            w, sorted_counts = w[order], counts[order]
            starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            zero = np.zeros(len(starts), np.int64)
            yield _word_rows(
                ranges, w[starts], np.add.reduceat(sorted_counts, starts),
                np.diff(np.append(starts, len(w))), zero, zero, zero,
            )
            # Counts of counts travel as a row of range -1.
            n = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            total = int(counts[h == np.uint64(START)].sum())
            row = [[-1], [total], *([x] for x in n), [0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int32()), *(pa.array(x, pa.int64()) for x in row[1:])],
                ["_range", "_key", "_c", "_a", "_n1", "_n2", "_n3"],
            )

    return run


FIGURES = "tokens long, words long, links long, docs long, " + ", ".join(
    f"{level}{k} long" for level in "ab" for k in (1, 2, 3, 4)
) + ", a_more long"


def _count_words(folder: str):
    """Write each range's words; return the figures that the model's discounts need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FIGURES.split(", ")]
        for number, table in _grouped(batches, "_range"):
            figures = dict.fromkeys(names, 0)
            columns = {n: table[n].to_numpy() for n in ("_key", "_c", "_a", "_n1", "_n2", "_n3")}
            if number < 0:
                figures["docs"] = int(columns["_key"].sum())
                for k, name in enumerate(("_c", "_a", "_n1", "_n2"), 1):
                    figures[f"b{k}"] = int(columns[name].sum())
            else:
                key = columns.pop("_key").view(np.uint64)
                order = np.argsort(key, kind="stable")
                key = key[order]
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                c, a, n1, n2, n3 = (np.add.reduceat(x[order], starts) for x in columns.values())
                hash_arrays.put(folder, f"words-{number}", key[starts], [c, a, n1, n2, n3])
                figures |= {"tokens": int(c.sum()), "words": int((c > 0).sum()), "links": int(a.sum())}
                figures |= {f"a{k}": int((a == k).sum()) for k in (1, 2, 3, 4)}
                figures["a_more"] = int((a > 2).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([figures[n]], pa.int64()) for n in names], names
            )

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and above; kept off 0 so that some chance is always left over."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for k, (here, above) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        value = k - (k + 1) * y * above / here if here else k / 2
        out.append(min(max(value, 0.05), float(k)))
    return np.array(out)


def train(docs: DataFrame) -> dict:
    """Count the model from ``docs`` into the shared folder; returns its description."""
    spark = docs.sparkSession
    texts = keyed(docs).select("_text")
    seen = texts.mapInArrow(_frequent, "_word long, _count long").groupBy("_word").agg(F.sum("_count").alias("n"))
    top = seen.orderBy(F.col("_word") >= 0, F.desc("n"), "_word").limit(HOT_WORDS + 1).collect()
    total = sum(r.n for r in top if r._word == -1)
    hot = np.array(sorted(r._word for r in top if r._word >= 0), np.int64).view(np.uint64)
    buckets = max(LEAST_BUCKETS, total // BUCKET_TOKENS)
    folder = shared_folder(spark)
    if "://" not in folder:
        folder = folder.replace("file:", "", 1) if folder.startswith("file:") else folder
        folder = f"file://{folder}"
    bigrams = (
        texts.mapInArrow(_successors(buckets, hot), "_bucket int, _word long, _next binary, _counts binary")
        .repartition(buckets, "_bucket")
        .sortWithinPartitions("_bucket")
        .mapInArrow(_count_bigrams(folder, buckets), WORD_ROWS)
    )
    figures = (
        bigrams.repartition(buckets, "_range")
        .sortWithinPartitions("_range")
        .mapInArrow(_count_words(folder), FIGURES)
    )
    row = figures.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures.columns)).first()
    return row.asDict() | {"folder": folder, "buckets": buckets, "hot": hot}


class Scorer:
    """Looks n-grams up in the mapped arrays of a model."""

    def __init__(self, model: dict):
        self.model = model
        self.files = hash_arrays.Store(model["folder"])
        self.high = discounts(*(model[f"b{k}"] for k in (1, 2, 3, 4)))
        self.low = discounts(*(model[f"a{k}"] for k in (1, 2, 3, 4)))
        left = self.low[1] * model["a1"] + self.low[2] * model["a2"] + self.low[3] * model["a_more"]
        self.left = left / model["links"] if model["links"] else 1.0

    def _lookup(self, kind: str, bucket: np.ndarray, keys: np.ndarray, columns: int) -> list[np.ndarray]:
        out = [np.zeros(len(keys), np.int64) for _ in range(columns)]
        order = np.lexsort((keys, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            if len(part) and (file := self.files.get(f"{kind}-{bucket[part[0]]}")) is not None:
                for got, values in zip(out, file.find(keys[part]), strict=True):
                    got[part] = values
        return out

    def words(self, keys: np.ndarray) -> list[np.ndarray]:
        where = (keys.astype(np.float64) * (self.model["buckets"] / 2.0**BITS)).astype(np.int32)
        return self._lookup("words", where, keys, 5)

    def bigrams(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        sub = np.where(np.isin(h, self.model["hot"]), w % np.uint64(SPREAD), np.uint64(0))
        name = mix((h * np.uint64(SPREAD) + sub) * ODD)
        bucket = (name % np.uint64(self.model["buckets"])).astype(np.int32)
        return self._lookup("bigrams", bucket, _bigram(h, w), 1)[0]

    def log10(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 chance of each token after its predecessor."""
        model = self.model
        names, index = np.unique(np.concatenate([h, w]), return_inverse=True)
        c, a, n1, n2, n3 = self.words(names)
        total = np.where(names == np.uint64(START), model["docs"], c)
        rest = (self.high[1] * n1 + self.high[2] * n2 + self.high[3] * n3) / np.maximum(total, 1)
        before, token = index[: len(h)], index[len(h) :]
        base = np.maximum(a - self.low[np.minimum(a, 3)], 0) / max(model["links"], 1)
        lower = (base + self.left / (model["words"] + 1))[token]
        both = self.bigrams(h, w)
        known = total[before] > 0
        top = np.maximum(both - self.high[np.minimum(both, 3)], 0) / np.maximum(total[before], 1)
        chance = np.where(known, top + rest[before] * lower, lower)
        return c[token], np.log10(chance)


_scorers: dict[str, Scorer] = {}


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model["folder"] not in _scorers:
            _scorers.clear()
            _scorers[model["folder"]] = Scorer(model)
        scorer = _scorers[model["folder"]]
        size = model["tokens"] + model["words"] + 1
        for batch in pieces(batches, "_text"):
            h, w, row = _pairs(_text(batch))
            # Ask once for each bigram of the chunk.
            pair = _bigram(h, w)
            _, first, back = np.unique(pair, return_index=True, return_inverse=True)
            count, chance = scorer.log10(h[first], w[first])
            count, chance = count[back], chance[back]
            n = batch.num_rows
            base = np.bincount(row, np.log10((count + 1) / size), n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    batch.column(batch.schema.get_field_index("held_out")),
                    pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(row, count > 0, n).astype(np.int64)),
                    pa.array(np.full(n, model["tokens"], np.int64)),
                    pa.array(base),
                    pa.array(np.bincount(row, chance, n)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Adds nothing to ``docs``: one row per row with the counts and scores of its text."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _is_held_out().alias("held_out"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    out = rows.mapInArrow(
        _score(model),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
        " base_score double, score double",
    )
    tokens = F.greatest("n_tokens", F.lit(1))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / tokens))


def train_and_score(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, score all."""
    importable(docs.sparkSession)
    return score(docs, train(docs.where(~_is_held_out())))
