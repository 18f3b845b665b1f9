"""Sorted runs of index lines, merged into one global order by loser trees.

A run is a set of blocks: lines in byte order, packed, with the first of them. Ranges of the
order are cut at sampled first lines, every block is cut where ranges meet, and the blocks of a
range come to one task in the order of their first lines. The task holds one block of each run:
before it takes the next block it has given out every line that comes before it. So it reads
its runs as a stream, however long they are.

At most about FAN_IN runs are merged at once; with more, groups of runs become longer runs
first. A key that holds a large part of all lines is cut like any other, since lines differ.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import written

FAN_IN = 64
# Lines of a block, blocks that make a range, and first lines that are sampled to cut ranges.
LINES, RANGE_BLOCKS, SAMPLE = 4096, 64, 8192
BLOCK = "_run bigint, _first binary, _lines binary"


class LoserTree:
    """The least line of several sorted lists; every inner node keeps the loser of its match."""

    def __init__(self):
        self.lists: list[list[bytes]] = []
        self.at: list[int] = []
        self.losers: list[int] = []
        self.slots: dict[int, int] = {}
        self.winner = -1

    def add(self, run: int, lines: list[bytes]) -> None:
        """The next lines of a run, whose earlier ones have all been given out."""
        slot = self.slots.setdefault(run, len(self.lists))
        if slot == len(self.lists):
            self.lists.append(lines)
            self.at.append(0)
        else:
            self.lists[slot], self.at[slot] = lines, 0
        self._play()

    def _head(self, slot: int) -> bytes | None:
        lines, at = self.lists[slot], self.at[slot]
        return lines[at] if at < len(lines) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self) -> None:
        """All matches anew: leaves are k to 2k - 1, the winner of node n goes up to n // 2."""
        k = len(self.lists)
        self.losers = [-1] * k
        won = [0] * k + list(range(k))
        for n in range(k - 1, 0, -1):
            a, b = won[2 * n], won[2 * n + 1]
            won[n], self.losers[n] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = won[1] if k > 1 else 0

    def least(self) -> bytes | None:
        return self._head(self.winner) if self.lists else None

    def pop(self) -> bytes:
        slot = self.winner
        line = self.lists[slot][self.at[slot]]
        self.at[slot] += 1
        # Replay the matches on the way up from the leaf that has changed.
        n = (slot + len(self.lists)) // 2
        while n:
            other = self.losers[n]
            if self._beats(other, slot):
                self.losers[n], slot = slot, other
            n //= 2
        self.winner = slot
        return line


def blocks_of(run: int, lines: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    for k in range(0, len(lines), LINES):
        part = lines[k : k + LINES]
        yield run, part[0], b"\n".join(part)


def block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["_run", "_first", "_lines"]
    )


def _cut(groups: int, cuts: list[list[bytes]], offsets: list[int]):
    """Pieces of blocks that lie within one range of their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, group, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines, mine = packed.split(b"\n"), cuts[group]
                at, r = 0, bisect_right(mine, lines[0])
                while at < len(lines):
                    end = bisect_left(lines, mine[r], at) if r < len(mine) else len(lines)
                    if end > at:
                        rows.append((offsets[group] + r, group, name, lines[at], b"\n".join(lines[at:end])))
                    at, r = end, r + 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                ["_range", "_group", "_run", "_first", "_lines"],
            )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces sorted by range and first line, the blocks of the merged run."""
    tree, out, group, range_ = LoserTree(), [], None, None

    def flush(limit: bytes | None) -> Iterator[pa.RecordBatch]:
        while (line := tree.least()) is not None and (limit is None or line < limit):
            out.append(tree.pop())
            if len(out) >= LINES:
                yield block_batch([(group, out[0], b"\n".join(out))])
                out.clear()

    for batch in batches:
        for r, g, name, first, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r != range_:
                yield from flush(None)
                if out:
                    yield block_batch([(group, out[0], b"\n".join(out))])
                tree, out, group, range_ = LoserTree(), [], g, r
            yield from flush(first)
            tree.add(name, packed.split(b"\n"))
    yield from flush(None)
    if out:
        yield block_batch([(group, out[0], b"\n".join(out))])


def _pass(blocks: DataFrame, groups: int) -> DataFrame:
    """Merge the runs of each group; tasks follow the order of groups and of their lines."""
    count = blocks.count()
    named = blocks.withColumn("_group", F.pmod(F.xxhash64("_run"), F.lit(groups)) if groups > 1 else F.lit(0).cast("bigint"))
    wanted = min(max(1, count // RANGE_BLOCKS), SAMPLE // 2)
    # Where ranges are cut decides only how even they are.
    some = named.select("_group", "_first")
    if count > SAMPLE:
        some = some.sample(SAMPLE / count, seed=13)
    firsts: list[list[bytes]] = [[] for _ in range(groups)]
    for g, first in some.collect():
        firsts[g].append(bytes(first))
    every = max(1, sum(map(len, firsts)) // wanted)
    cuts = [sorted(set(sorted(f)[every::every])) for f in firsts]
    offsets, total = [], 0
    for c in cuts:
        offsets.append(total)
        total += len(c) + 1
    pieces = named.select("_run", "_group", "_lines").mapInArrow(
        _cut(groups, cuts, offsets), "_range int, _group bigint, _run bigint, _first binary, _lines binary"
    )
    dealt = pieces.repartitionById(total, F.col("_range"))
    return dealt.sortWithinPartitions("_range", "_first").mapInArrow(_merge, BLOCK)


def merged(blocks: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One run of all lines: blocks, whose tasks and rows follow the global order."""
    runs = blocks.select("_run").distinct().count()
    while True:
        groups = -(-runs // fan_in) if runs > fan_in else 1
        blocks = _pass(blocks, groups)
        if groups == 1:
            return blocks
        blocks, runs = written(blocks), groups
