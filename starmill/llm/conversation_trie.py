"""The trie of all conversation prefixes, built from adaptive radix trees over key ranges.

A turn becomes a big-endian id of fixed width, 16 bytes of a digest of role and text and 4
bytes that hold the text's length; a conversation's key is its ids in a row. Equal keys become
one, then keys are dealt by range, and every task puts bounded shards of its range into
adaptive radix trees: nodes of 4, 16, 48 or 256 places that grow as needed, with compressed
paths. Only byte depths at the end of an id are trie nodes, also inside a compressed path.

A trie node that no key outside the shard can share, one that is a prefix of neither the
first nor the last key of the shard, is final in its tree. What is known of the others, the rim,
goes as one entry for each place where something ends or branches off to the next level,
which builds the trees of the rims in the same way, until one tree holds the last of them. So no
task sees a subtree whole, however many conversations share it.

Members that end at a node are listed by a sort that is dealt by key and id: a hot key is
spread, every task packs its part of the list, and only the packed parts meet. The ids of one
conversation are one value, 20 bytes a turn.

Order and odd rows. Turns are ordered by turn, NULL first; rows of one turn by their ids.
NULL roles and texts are empty. Rows without conv_id are one conversation; its id is NULL,
comes before all others and is an empty string in lists of ids. Repeated rows are turns of
their own. An empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import NULL_ID, written

DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
# Entries that a task puts into one tree, and the bytes of keys for each of them.
SHARD, ENTRY_BYTES = 20_000, 800
# Ids that a packed part of a list of members holds.
PACK = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree ----------------------------------------------------------------


class Sparse:
    """Up to 4 or 16 places: bytes and children side by side."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node):
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.room:
            return self.grown().put(byte, node)
        self.bytes.append(byte)
        self.nodes.append(node)
        return self

    def grown(self):
        larger = Sparse(16) if self.room == 4 else Indexed()
        for byte, node in zip(self.bytes, self.nodes, strict=True):
            larger.put(byte, node)
        return larger

    def children(self) -> list:
        return self.nodes


class Indexed:
    """Up to 48 places: 256 bytes that say where a child is."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        at = self.index[byte]
        if at:
            self.nodes[at - 1] = node
            return self
        if len(self.nodes) == 48:
            larger = Full()
            for other in range(256):
                if self.index[other]:
                    larger.put(other, self.nodes[self.index[other] - 1])
            return larger.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def children(self) -> list:
        return self.nodes


class Full:
    """A place for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def children(self) -> list:
        return [n for n in self.nodes if n is not None]


class Node:
    """A compressed path that ends ``end`` bytes below the root, what is known there, and children."""

    __slots__ = ("path", "end", "entry", "below")

    def __init__(self, path: bytes, end: int, entry=None):
        self.path, self.end, self.entry, self.below = path, end, entry, None

    def adopt(self, node: Node) -> None:
        if self.below is None:
            self.below = Sparse()
        self.below = self.below.put(node.path[0], node)


def _shared(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``start`` on."""
    low, high = 0, min(len(a), len(b) - start)
    if a[:high] == b[start : start + high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[start : start + middle]:
            low = middle
        else:
            high = middle
    return low


def insert(root: Node, key: bytes, entry: Entry) -> None:
    node, at = root, 0
    while True:
        if at == len(key):
            node.entry = entry if node.entry is None else node.entry.merged(entry)
            return
        child = node.below.get(key[at]) if node.below is not None else None
        if child is None:
            node.adopt(Node(key[at:], len(key), entry))
            return
        same = _shared(child.path, key, at)
        if same < len(child.path):
            # The path splits: its first part becomes a node above.
            upper = Node(child.path[:same], at + same)
            child.path = child.path[same:]
            upper.adopt(child)
            node.adopt(upper)
            child = upper
        node, at = child, at + same


class Entry:
    """What is known at a prefix apart from what lies below it in the same tree.

    Members that end here with the least of them and the digest of all; and of closed
    subtrees below: members, their least, how many hang right here, leaves, saved bytes.
    """

    __slots__ = ("ends", "least", "sha", "closed", "kids", "leaves", "saved")

    def __init__(self, ends, least, sha, closed=0, kids=0, leaves=0, saved=0):
        self.ends, self.least, self.sha = ends, least, sha
        self.closed, self.kids, self.leaves, self.saved = closed, kids, leaves, saved

    def merged(self, other: Entry) -> Entry:
        return Entry(
            self.ends + other.ends, min(self.least, other.least), self.sha or other.sha,
            self.closed + other.closed, self.kids + other.kids,
            self.leaves + other.leaves, self.saved + other.saved,
        )


class _Sums:
    """Totals of what hangs below a place: members, the least, nodes right below, leaves, saved."""

    __slots__ = ("members", "least", "kids", "leaves", "saved", "rows")

    def __init__(self):
        self.members, self.least, self.kids, self.leaves, self.saved = 0, None, 0, 0, 0
        self.rows: list[list] = []  # finished nodes that still lack their parent

    def take(self, other: _Sums) -> None:
        self.members += other.members
        if self.least is None or (other.least is not None and other.least < self.least):
            self.least = other.least
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        if len(self.rows) < len(other.rows):
            self.rows, other.rows = other.rows, self.rows
        self.rows += other.rows


PARENT = 8  # the place of a parent that is still open in a finished row


def _chain(name: bytes, path: bytes) -> bytes:
    """The name of a prefix, from that of its parent and the last id."""
    return hashlib.md5(name + path, usedforsecurity=False).digest()


def _walk(root: Node, first: bytes, last: bytes, level: int, whole: bool, finished: list, rim: list) -> None:
    """Turn a tree into finished rows and, unless it is the ``whole``, entries of the rim.

    A finished row: conv_id, depth, parent's conv_id, members, children, leaves, saved, sha,
    name of a parent that is still open, own name if it was open at the level before.
    """
    sums: dict[int, _Sums] = {}
    todo = [(root, b"", [b""], False)]
    while todo:
        node, above, names, ready = todo.pop()
        key = above + node.path
        start, end = node.end - len(node.path), node.end - node.end % WIDTH
        children = node.below.children() if node.below is not None else ()
        if not ready:
            # Names of the parent's deepest prefix and of every prefix that ends on this path.
            names = names[-1:]
            for at in range(start - start % WIDTH, end, WIDTH):
                names.append(_chain(names[-1], key[at : at + WIDTH]))
            todo.append((node, above, names, True))
            todo += [(c, key, names, False) for c in children]
            continue
        total = _Sums()
        for child in children:
            total.take(sums.pop(id(child)))
        open_to = -1 if whole else max(_shared(key, first, 0), _shared(key, last, 0))
        entry = node.entry
        # From the end of the path up, over every end of an id on it.
        while end > start or (end == 0 and node is root):
            here = entry if end == node.end else None
            name = names.pop()
            if here is not None:
                total.members += here.ends + here.closed
                total.least = here.least if total.least is None else min(total.least, here.least)
                total.kids += here.kids
                total.leaves += here.leaves
                total.saved += here.saved
            if end <= open_to:
                if total.members:
                    ends, sha = (here.ends, here.sha) if here is not None else (0, None)
                    rim.append(
                        (key[:end], ends, total.least, sha, total.members - ends, total.kids, total.leaves, total.saved)
                    )
                for row in total.rows:
                    row[PARENT] = name
                total = _Sums()
            else:
                size = int.from_bytes(key[end - LENGTH : end], "big") if end else 0
                total.saved += (total.members - 1) * size
                total.leaves = total.leaves if total.kids else 1
                sha = here.sha if here is not None and here.ends else EMPTY_SHA
                row = [
                    total.least, end // WIDTH, None, total.members, total.kids, total.leaves,
                    total.saved, sha, None, name if level else None,
                ]
                for child in total.rows:
                    child[2] = total.least
                finished.append(row)
                total.kids, total.rows = 1, [row]
            end -= WIDTH
        sums[id(node)] = total


# --- Spark ------------------------------------------------------------------------------

RIM = "_key binary, _ends bigint, _least bigint, _sha string, _closed bigint, _kids bigint, _leaves bigint, _saved bigint"
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, _parent binary, _own binary"
)
RIM_COLUMNS = [c.split()[0] for c in RIM.split(", ")]
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
_KINDS = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in f"{NODE}, {RIM}".split(", ")])


def turn_id(role: Column, text: Column) -> Column:
    """WIDTH bytes: a digest of role and text, and the text's length, big-endian."""
    size = F.octet_length(text)
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(told, 256)), 1, DIGEST)
    return F.concat(digest, F.unhex(F.lpad(F.hex(size), 2 * LENGTH, "0")))


def sequences(turns: DataFrame) -> DataFrame:
    """(_conv, _turns): the turn ids of each conversation, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NULL_ID)).alias("_conv"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), turn_id(role, text).alias("id")).alias("_t"),
    )
    return rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_t")).getField("id").alias("_turns"))


def grafted(convs: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin like the first one of their group.

    Conversation c begins with the first h turns of c - c % group, h being a checksum of c below
    ``heads``, and goes on with its own turns after the first h. A conversation without id stays.
    """
    conv = F.col("_conv")
    h = F.when(conv == NULL_ID, 0).otherwise(F.crc32(conv.cast("string")) % heads).cast("int")
    firsts = convs.where(conv % group == 0).select(
        conv.alias("_base"), F.slice("_turns", 1, heads - 1).alias("_head")
    )
    own = convs.select("_conv", "_turns", (conv - conv % group).alias("_base"), h.alias("_h"))
    joined = own.join(firsts, "_base", "left")
    head = F.slice(F.coalesce("_head", F.array().cast("array<binary>")), F.lit(1), F.col("_h"))
    size = F.greatest(F.size("_turns") - F.col("_h"), F.lit(0))
    rest = F.slice("_turns", F.col("_h") + 1, size)
    return joined.select("_conv", F.concat(head, rest).alias("_turns"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and id: packed parts of each key's list of ids."""
    out, size = [], 0
    key, ids = None, []

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        types = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["_key", "_least", "_n", "_list"]
        )

    def part() -> tuple:
        listed = ",".join("" if i == NULL_ID else str(i) for i in ids)
        return key, ids[0], len(ids), listed.encode()

    for rows in batches:
        for k, i in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            if k != key or len(ids) >= PACK:
                if ids:
                    out.append(part())
                    size += len(key) + len(out[-1][3])
                    if size > 1 << 22:
                        yield batch()
                        out, size = [], 0
                key, ids = k, []
            ids.append(i)
    if ids:
        out.append(part())
    if out:
        yield batch()


def _tree(entries: Iterator[tuple[bytes, Entry]], level: int, shard: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Trees of bounded shards of entries that come in the order of their keys."""
    held: list[tuple[bytes, Entry]] = []
    size = 0

    def settle() -> pa.RecordBatch:
        finished, rim = [], []
        root = Node(b"", 0)
        for key, entry in held:
            insert(root, key, entry)
        _walk(root, held[0][0], held[-1][0], level, whole, finished, rim)
        no_rim, no_node = [None] * len(RIM_COLUMNS), [None] * len(NODE_COLUMNS)
        rows = [[*r, *no_rim] for r in finished] + [[*no_node, *r] for r in rim]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
        )

    for key, entry in entries:
        full = len(held) >= shard or size >= shard * ENTRY_BYTES
        if full and not whole and key != held[-1][0]:
            yield settle()
            held, size = [], 0
        held.append((key, entry))
        size += len(key)
    if held:
        yield settle()


def _from_packed(shard: int):
    """Packed lists, in the order of key and id, to entries and their trees."""

    def entries(batches: Iterator[pa.RecordBatch]):
        key, total, count, least = None, None, 0, 0
        for rows in batches:
            for k, i, n, listed in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if k != key:
                    if key is not None:
                        yield key, Entry(count, least, total.hexdigest())
                    key, total, count, least = k, hashlib.sha256(listed), n, i
                else:
                    total.update(b"," + listed)
                    count += n
        if key is not None:
            yield key, Entry(count, least, total.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tree(entries(batches), 0, shard, whole=False)

    return run


def _from_rim(level: int, shard: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        entries = ((key, Entry(ends, least, sha, *rest)) for key, ends, least, sha, *rest in rows)
        yield from _tree(entries, level, shard, whole)

    return run


def nodes(sequenced: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the sequences (_conv, _turns): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    # One binary of all ids; joining as text takes time in proportion to the length.
    key = F.unhex(F.array_join(F.transform("_turns", lambda t: F.hex(t)), ""))
    keys = written(sequenced.select(key.alias("_key"), "_conv"))
    packed = (
        keys.repartitionByRange("_key", "_conv")
        .sortWithinPartitions("_key", "_conv")
        .mapInArrow(_pack, "_key binary, _least bigint, _n bigint, _list binary")
    )
    out = f"{NODE}, {RIM}"
    tables = [
        written(
            packed.repartitionByRange("_key")
            .sortWithinPartitions("_key", "_least")
            .mapInArrow(_from_packed(shard), out)
        )
    ]
    last = None
    while True:
        rim = tables[-1].where("_key IS NOT NULL").select(*RIM_COLUMNS)
        count, size = rim.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_key")), F.lit(0))).first()
        if not count:
            break
        # Where most entries lie on one path the rim hardly shrinks; larger trees then cut more off.
        if last is not None and 2 * count > last:
            shard *= 2
        last = count
        parts = max(-(-count // shard), -(-size // (shard * ENTRY_BYTES)))
        dealt = rim.repartition(1) if parts == 1 else rim.repartitionByRange(parts, "_key")
        level = _from_rim(len(tables), shard, parts == 1)
        tables.append(written(dealt.sortWithinPartitions("_key").mapInArrow(level, out)))
    return _named(tables)


def _named(tables: list[DataFrame]) -> DataFrame:
    """The finished rows of all levels, with the ids of parents that were settled at a later one."""
    rows = [t.where("depth IS NOT NULL").select(*NODE_COLUMNS) for t in tables]
    every, owners = rows[0], None
    for later in rows[1:]:
        every = every.union(later)
        own = later.select(F.col("_own").alias("_parent"), F.col("conv_id").alias("_named"))
        owners = own if owners is None else owners.union(own)
    if owners is not None:
        waiting = every.where("_parent IS NOT NULL").join(owners, "_parent", "left")
        waiting = waiting.withColumn("parent_conv_id", F.col("_named"))
        every = every.where("_parent IS NULL").select(*NODE_COLUMNS[:8]).union(waiting.select(*NODE_COLUMNS[:8]))
    shown = [F.nullif(F.col(c), F.lit(NULL_ID)).alias(c) for c in ("conv_id", "parent_conv_id")]
    return every.select(shown[0], "depth", shown[1], *NODE_COLUMNS[3:8])


def trie(turns: DataFrame) -> DataFrame:
    """The prefix trie of conversations as they are."""
    return nodes(sequences(turns))
