"""Repair the turn structure of conversations with the cheapest edits.

Rows of a conversation, in the order of their turns, become one symbol each: role initial and
fault. Re-Pair replaces frequent neighbours among the symbols of many conversations by rules;
a rule has one min-plus matrix of edits between the states of the role grammar, with the edits
kept as ropes, computed from the matrices of its two halves. A conversation is the product of
what is left of its symbols, so conversations share the work on what they have in common.

Grammar of roles: ``(s?(ua)+)?``. States: nothing yet, after s, after u, after a.
Edits: K keep (0), R give the role user or assistant (3), D delete (4), I insert an empty turn
of user or assistant (3). Blank and repeated rows have to be deleted; a truncated row that
stays costs 3 more. Of equally cheap edits the ASCII-least string of initials wins: edits of
equal cost over the same rows are never prefixes of each other, so the least string of a whole
is made of the least strings of its parts.

Order and odd rows. Rows are ordered by turn, NULL first; rows of one turn by the SHA-256 of
role and text. A NULL role or text is one space. A NULL conv_id is one conversation. A row
that repeats role and text of an earlier one is a duplicate. Empty roles have no initial, and
roles of other initials must be changed or deleted. Conversations without rows are returned
if ``conv_ids`` names them; an empty table gives no rows. Other columns are ignored.

Memory. A task holds symbols and edits, a byte a row of the conversation it is at, never the
texts: these are sorted by Spark and read as a stream when the edits are applied.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETYPE, DELETE, INSERT, KEEP_TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Symbols: role class 0 to 3 (s, u, a, other), plus 4 if truncated; 8 must be deleted.
MUST_GO, SYMBOLS = 8, 9
# Symbols that share a grammar in a task, the rules it may have, and how often a pair must occur.
SHARED, RULES, OFTEN = 1 << 16, 512, 3
BLANKS = " \t\n\x0b\x0c\r"


# --- edits as ropes ---------------------------------------------------------------------

_LEAF = 64
_MOD, _BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A string made of two; its hash lets equal parts be skipped."""

    __slots__ = ("size", "hash", "left", "right")

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.size = _size(left) + _size(right)
        self.hash = (_hash(left) * pow(_BASE, _size(right), _MOD) + _hash(right)) % _MOD


def _size(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope.size


def _hash(rope) -> int:
    if not isinstance(rope, str):
        return rope.hash
    h = 0
    for c in rope:
        h = (h * _BASE + ord(c)) % _MOD
    return h


def join(left, right):
    if not left:
        return right
    if not right:
        return left
    if isinstance(left, str) and isinstance(right, str) and len(left) + len(right) <= _LEAF:
        return left + right
    return Rope(left, right)


def text_of(rope) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x.right, x.left)
    return "".join(out)


def before(a, b) -> bool:
    """Whether a comes before b in ASCII order."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        n, m = _size(x), _size(y)
        if isinstance(x, str) and isinstance(y, str):
            k = min(n, m)
            if x[:k] != y[:k]:
                return x[:k] < y[:k]
            if n > k:
                left.append(x[k:])
            if m > k:
                right.append(y[k:])
        elif n == m and _hash(x) == _hash(y):
            continue
        elif not isinstance(x, str) and (n >= m or isinstance(y, str)):
            left += (x.right, x.left)
            right.append(y)
        else:
            left.append(x)
            right += (y.right, y.left)
    return bool(right)


def cheaper(a, b):
    """The better of two (cost, rope); None is no way at all."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if before(b[1], a[1]) else a


def times(vector: list, matrix: list) -> list:
    out = []
    for j in range(4):
        best = None
        for k in range(4):
            a, b = vector[k], matrix[k][j]
            if a is None or b is None or (best is not None and a[0] + b[0] > best[0]):
                continue
            best = cheaper(best, (a[0] + b[0], join(a[1], b[1])))
        out.append(best)
    return out


def product(left: list, right: list) -> list:
    return [times(row, right) for row in left]


def _steps(moves: dict[tuple[int, int], tuple[int, str]]) -> list:
    return [[moves.get((i, j)) for j in range(4)] for i in range(4)]


_AFTER = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
# Two insertions in a row lead from u to a by way of nothing shorter; three never help.
INSERTS = _steps(
    {(i, i): (0, "") for i in range(4)}
    | {(i, USER): (INSERT, "I") for i in _AFTER[USER]}
    | {(USER, ASSISTANT): (INSERT, "I")}
    | {(i, ASSISTANT): (2 * INSERT, "II") for i in (START, SYSTEM)}
)


def _terminal(symbol: int) -> list:
    """Insertions, then one row."""
    moves = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol != MUST_GO:
        role, extra = symbol % 4, KEEP_TRUNCATED if symbol >= 4 else 0
        for to, sources in _AFTER.items():
            for i in sources:
                kept = role == to - 1
                moves[i, to] = (extra, "K") if kept else (RETYPE + extra, "R")
        if role == 0:
            moves[START, SYSTEM] = (extra, "K")
    return product(INSERTS, _steps(moves))


TERMINALS = [_terminal(k) for k in range(SYMBOLS)]
EMPTY = [(0, ""), None, None, None]


def outcome(vector: list) -> tuple[int, str]:
    """Cost and edits of a conversation that ends here."""
    ended = times(vector, INSERTS)
    cost, rope = cheaper(ended[START], ended[ASSISTANT])
    return cost, text_of(rope)


# --- grammar ----------------------------------------------------------------------------


def re_pair(sequences: list[bytes]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences in symbols and rules, and the rules; rule r is symbol SYMBOLS + r."""
    gap = np.array([-1], np.int32)
    parts = [x for s in sequences for x in (np.frombuffer(s, np.uint8).astype(np.int32), gap)]
    all_ = np.concatenate(parts) if parts else gap
    rules: list[tuple[int, int]] = []
    while len(rules) < RULES and len(all_) > 1:
        size = SYMBOLS + len(rules)
        pairs = np.where((all_[:-1] >= 0) & (all_[1:] >= 0), all_[:-1] * size + all_[1:], size * size)
        counts = np.bincount(pairs, minlength=size * size + 1)[:-1]
        best = int(counts.argmax())
        if counts[best] < OFTEN:
            break
        a, b = divmod(best, size)
        at = np.flatnonzero(pairs == best)
        if a == b and len(at):
            # In a run of the same symbol every second place starts a pair.
            new = np.ones(len(at), bool)
            new[1:] = np.diff(at) > 1
            first = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
            at = at[(at - first) % 2 == 0]
        rules.append((a, b))
        all_[at] = size
        all_ = np.delete(all_, at + 1)
    ends = np.flatnonzero(all_ < 0)
    return [s[:-1] for s in np.split(all_, ends + 1)[: len(sequences)]], rules


class Grammar:
    """Matrices of the symbols and rules that a set of sequences shares."""

    def __init__(self, sequences: list[bytes]):
        shorter, rules = re_pair(sequences)
        self.matrices = list(TERMINALS)
        for a, b in rules:
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        self.shorter = dict(zip(sequences, shorter, strict=True))

    def after(self, sequence: bytes, vector: list) -> list:
        for symbol in self.shorter[sequence].tolist():
            vector = times(vector, self.matrices[symbol])
        return vector


# --- Spark ------------------------------------------------------------------------------


def _digest(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of role and text."""
    sized = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(sized, 256)), 1, 16)


def _rows(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = turns.select(
        F.col("conv_id").cast("bigint").alias("_conv"),
        F.col("turn").cast("bigint").alias("_turn"),
        role.alias("_role"),
        text.alias("_text"),
    )
    return plain.withColumn("_same", _digest(F.col("_role"), F.col("_text")))


def _symbols(turns: DataFrame) -> DataFrame:
    """(_conv, _turn, _same, _class, _fault): 0 none, 1 truncated, 2 duplicate, 3 blank."""
    initial = F.substring("_role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    shown = F.rtrim(F.col("_text"), F.lit(BLANKS))
    last = F.right(shown, F.lit(1))
    fault = F.when(shown == "", 3).when(last.isin(".", "!", "?"), 0).otherwise(1)
    rows = _rows(turns).select(
        "_conv", "_turn", "_same", role.cast("tinyint").alias("_class"), fault.alias("_own")
    )
    again = F.row_number().over(Window.partitionBy("_conv", "_same").orderBy("_turn")) > 1
    judged = F.when(F.col("_own") == 3, 3).when(again, 2).otherwise(F.col("_own"))
    return rows.select("_conv", "_turn", "_same", "_class", judged.cast("tinyint").alias("_fault"))


PLAN = (
    "_conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string"
)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


class _Open:
    """The conversation whose rows are being read."""

    def __init__(self, conv):
        self.conv, self.faults, self.illegal = conv, np.zeros(4, np.int64), 0
        self.low = self.high = self.turn = None
        self.turns, self.last = 0, None
        self.vector, self.parts = EMPTY, []

    def add(self, turns: pa.Array, classes: np.ndarray, faults: np.ndarray) -> None:
        self.faults += np.bincount(faults, minlength=4)
        both = classes if self.last is None else np.append(self.last, classes)
        self.illegal += int((~_LEGAL[both[:-1], both[1:]]).sum())
        self.last = both[-1]
        known = turns.drop_null().to_numpy()
        if len(known):
            self.low = int(known[0]) if self.low is None else self.low
            self.turns += int((np.diff(known) != 0).sum()) + (self.high != known[0])
            self.high = int(known[-1])
        self.parts.append(np.where(faults >= 2, MUST_GO, classes + 4 * (faults == 1)).astype(np.uint8))

    def symbols(self) -> bytes:
        whole = np.concatenate(self.parts).tobytes() if self.parts else b""
        self.parts = []
        return whole

    def row(self, cost: int, audit: str) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, gaps, *map(int, self.faults[[3, 2, 1]]), self.illegal, cost, audit


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by conversation and place, the cheapest edits of each conversation."""
    schema = pa.schema(
        [("_conv", pa.int64())]
        + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )
    done: list[tuple[_Open, bytes]] = []
    current: _Open | None = None
    held = 0

    def settle() -> pa.RecordBatch:
        grammar = Grammar(list(dict.fromkeys(s for _, s in done)))
        ends: dict[bytes, tuple[int, str]] = {}
        rows = []
        for conv, s in done:
            if conv.vector is not EMPTY:
                rows.append(conv.row(*outcome(grammar.after(s, conv.vector))))
                continue
            if s not in ends:
                ends[s] = outcome(grammar.after(s, EMPTY))
            rows.append(conv.row(*ends[s]))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        conv, turn, classes, faults = (batch.column(k) for k in range(4))
        ids = conv.fill_null(0).to_numpy()
        null = conv.is_null().to_numpy(zero_copy_only=False)
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        first = np.flatnonzero(new)
        for a, b in zip(first, np.append(first[1:], len(ids)), strict=True):
            name = None if null[a] else int(ids[a])
            if current is None or current.conv != name:
                if current is not None:
                    done.append((current, current.symbols()))
                if held >= SHARED:
                    yield settle()
                    held = 0
                current = _Open(name)
            here = np.flatnonzero(classes[a:b].is_valid().to_numpy(zero_copy_only=False))
            if len(here):
                at = pa.array(here + a)
                current.add(turn.take(at), classes.take(at).to_numpy(), faults.take(at).to_numpy())
            held += b - a
            if sum(map(len, current.parts)) >= SHARED:
                # A part of a very long conversation, with a grammar of its own.
                part = current.symbols()
                current.vector = Grammar([part]).after(part, current.vector)
    if current is not None:
        done.append((current, current.symbols()))
    if done:
        yield settle()


def plan(turns: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """PLAN: the faults of each conversation, and its cheapest edits."""
    rows = _symbols(turns)
    if conv_ids is not None:
        named = conv_ids.select(F.col("conv_id").cast("bigint").alias("_conv")).distinct()
        rows = rows.unionByName(named, allowMissingColumns=True)
    placed = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_same")
    return placed.select("_conv", "_turn", "_class", "_fault").mapInArrow(_edits, PLAN)


class _Replay:
    """Applies edits to the rows of a conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _made(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return ROLES[self.state]

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield "I", self._made(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = " sua".index(role[0])
            yield "K", role, text
        elif edit == "R":
            yield "R", self._made(), text


def _replayed(batches: Iterator[pa.RecordBatch]):
    """(row of the plan, its repaired rows as an iterator) for each conversation."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    stream = rows()
    head = next(stream, None)
    while head is not None:
        following = [None]

        def repaired(replay, following=following):
            for row in stream:
                if row[3] is not None:
                    following[0] = row
                    break
                yield from replay.row(row[1], row[2])
            yield from replay.inserts()

        lines = repaired(_Replay(head[-1]))
        yield head, lines
        for _ in lines:
            pass
        head = following[0]


def _columns(plans: DataFrame, turns: DataFrame) -> DataFrame:
    """Plans and rows in one table, each plan right before its rows."""
    counts = [c for c in plans.columns if c not in ("_conv", "audit")]
    heads = plans.select(
        "_conv", F.lit(None).cast("bigint").alias("_turn"), F.lit(None).cast("binary").alias("_same"),
        F.lit(0).cast("tinyint").alias("_kind"), F.lit(None).cast("string").alias("_role"),
        F.lit(None).cast("string").alias("_text"), *counts, "audit",
    )
    rows = _rows(turns).withColumn("_kind", F.lit(1).cast("tinyint"))
    both = heads.unionByName(rows, allowMissingColumns=True)
    placed = both.repartition("_conv").sortWithinPartitions("_conv", "_kind", "_turn", "_same")
    return placed.select("_conv", "_role", "_text", *counts, "audit")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "place", "edit", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    rows, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
        )

    for head, lines in _replayed(batches):
        for place, (edit, role, text) in enumerate(lines):
            rows.append((head[0], place, edit, role, text))
            size += len(text) + 32
            if size > 1 << 20:
                yield batch()
                rows, size = [], 0
    if rows:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    names = ["_conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
        )

    for head, lines in _replayed(batches):
        total, first = hashlib.sha256(), True
        for _, role, text in lines:
            total.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        out.append((head[0], *head[3:], total.hexdigest()))
        if len(out) >= 4096:
            yield batch()
            out.clear()
    if out:
        yield batch()


def repaired(turns: DataFrame) -> DataFrame:
    """conv_id, place, edit (K, R or I), role, text: the conversations with their edits applied."""
    return _columns(plan(turns), turns).mapInArrow(
        _lines, "conv_id bigint, place bigint, edit string, role string, text string"
    )


def report(turns: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired ``role:text`` lines). ``gaps`` are turn numbers missing
    between the first and the last."""
    both = _columns(plan(turns, conv_ids), turns)
    out = both.mapInArrow(_digests, f"{PLAN}, repaired_sha256 string")
    return out.withColumnRenamed("_conv", "conv_id")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults by a checksum of ``conv_id:turn``: dropped, emptied, without sentence
    ends, repeated, or given the role user. NULLs are one space."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    copies = F.when(code == 0, 0).when(code == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")
