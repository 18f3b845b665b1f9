"""Conversation tries and repairs against brute force."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from starmill.llm import conversation_repair as repair
from starmill.llm import conversation_trie as trie

from .conftest import result

TURNS = "conv_id bigint, turn bigint, role string, text string, _conv int, _key string, audit int, depth string"
NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
REPORT = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
EXTRA = (1, "k", 2, "d")


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def random_turns(seed, convs, most, words=3):
    pick = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(pick.randrange(most + 1)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", ""])
            text = pick.choice(["Hello.", "Yes", "no?", "", " \n", "Ends well!  ", "ü é"][: words + 4])
            rows.append((c, t + pick.randrange(2) * pick.randrange(3), role, text))
    return rows


@pytest.fixture(scope="module")
def odd_turns(session):
    long = "word " * 60_000 + "end."
    rows = [
        (1, 0, "user", "Hi."), (1, None, None, None), (1, 2, "assistant", "Hello."), (1, 2, "assistant", "Hello."),
        (2, 5, None, "No role."), (2, None, "user", None), (2, 9, "assistant", ""), (2, 9, "assistant", "Tie."),
        (None, 0, "user", "Nobody's."), (None, 1, "assistant", "Nobody's."), (None, None, None, None),
        (3, 0, "user", long), (3, 1, "assistant", long), (4, 0, "user", long), (4, 1, "assistant", long + "x"),
        (5, 0, "system", "Rules."), (5, 1, "user", "Hi."), (6, 0, "system", "Rules."), (6, 1, "user", "Hi."),
        (7, 0, "user", "Hi."), (7, 0, "user", "Hi."), (8, 1, "", ""), (9, 0, "assistant", "a:b\nc"),
        (-3, 0, "user", "Below."), (-5, 0, "user", "Base."), (2**62, 1, "user", "Large."),
        *((k, t, "user", "Same.") for k in range(10, 60) for t in range(3)),
    ]
    return session.createDataFrame([r + EXTRA for r in rows], TURNS), rows


@pytest.fixture(scope="module")
def no_turns(session):
    return session.createDataFrame([], TURNS)


# --- trie -------------------------------------------------------------------------------


def in_order(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [r[3:] for r in sorted(turns)] for c, turns in convs.items()}


def brute_trie(convs):
    low = {c: -(2**63) if c is None else c for c in convs}
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    least = {p: min(cs, key=low.get) for p, cs in nodes.items()}
    out = []
    for p, cs in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        kids = {q[: len(q) - 1] for q in nodes if q}
        ends = sorted((c for c in cs if len(convs[c]) == len(p)), key=low.get)
        listed = ",".join("" if c is None else str(c) for c in ends)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append(
            (
                least[p], len(p), least[p[:-1]] if p else None, len(cs),
                sum(len(q) == len(p) + 1 for q in below), sum(q not in kids for q in below), saved,
                hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def graft(convs, group=5, heads=9):
    out = {}
    for c, turns in convs.items():
        if c is None:
            out[c] = turns
            continue
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


@pytest.mark.parametrize("shard", [2, 5, trie.SHARD])
def test_trie_of_odd_turns(odd_turns, shard):
    frame, rows = odd_turns
    convs = in_order(rows)
    assert result(trie.nodes(trie.sequences(frame), shard), *NODE) == brute_trie(convs)
    assert result(trie.nodes(trie.grafted(trie.sequences(frame)), shard), *NODE) == brute_trie(graft(convs))


@pytest.mark.parametrize("shard", [3, 40])
def test_trie_of_many_branches(session, settings, shard):
    """More than 48 children of one node, deep shared paths, copies; trees of every layout."""
    settings(**{"spark__sql__adaptive__coalescePartitions__enabled": "false"})
    rows = [(c, 0, "user", f"start {c % 300}") for c in range(420)]
    rows += [(1000 + c, t, "user", f"deep {t if t < 25 else t * (c % 7)}") for c in range(40) for t in range(c % 35)]
    frame = session.createDataFrame([r + EXTRA for r in rows], TURNS)
    assert result(trie.nodes(trie.sequences(frame), shard), *NODE) == brute_trie(in_order(rows))


def test_long_path_of_prefixes(session):
    """Conversations that are prefixes of each other: the rim holds nearly every key."""
    rows = [(c, t, "user", f"turn {t}") for c in range(60) for t in range(c)] + [(0, 0, "user", "turn 0")]
    frame = session.createDataFrame([r + EXTRA for r in rows], TURNS)
    assert result(trie.nodes(trie.sequences(frame), 4), *NODE) == brute_trie(in_order(rows))


def test_hot_conversation_copies_are_packed(session):
    """A third of all conversations are copies; their list of ids is packed in parts."""
    few = 9000
    frame = session.range(3 * few).selectExpr(
        "id AS conv_id", "0L AS turn", "'user' AS role", f"IF(id < {few}, 'hot', concat('text ', id)) AS text"
    )
    found = {r.depth: r for r in trie.trie(frame).where("n_convs > 1").collect()}
    listed = ",".join(map(str, range(few)))
    assert {d: r.n_convs for d, r in found.items()} == {0: 3 * few, 1: few}
    assert found[1].ends_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_node_layouts_grow():
    tree = trie.Node(b"", 0)
    kinds = []
    for byte in range(256):
        trie.insert(tree, bytes([byte]) * trie.WIDTH, trie.Entry(1, byte, "x"))
        kinds.append((type(tree.below).__name__, getattr(tree.below, "room", 0)))
    names = [k for k, _ in itertools.groupby(kinds)]
    assert names == [("Sparse", 4), ("Sparse", 16), ("Indexed", 0), ("Full", 0)]
    assert [tree.below.get(b).entry.least for b in range(256)] == list(range(256))


def test_trie_of_nothing(no_turns):
    assert trie.trie(no_turns).collect() == []
    assert trie.nodes(trie.grafted(trie.sequences(no_turns))).columns == NODE


# --- repair -----------------------------------------------------------------------------


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        code = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        out += [(c, t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def brute_repair(rows, every):
    """Cheapest edits by a search over (rows taken, state) in the order of cost and edits."""
    out = []
    for c in every:
        mine = sorted(
            ((t is not None, t or 0, digest(role, text)), t, role, text) for cc, t, role, text in rows if cc == c
        )
        seen, faults = set(), []
        for _, _, role, text in mine:
            shown = text.strip(" \t\n\x0b\x0c\r")
            kind = "b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t"
            faults.append(kind)
            seen.add((role, text))
        pairs = [a[2][:1] + ">" + b[2][:1] for a, b in itertools.pairwise(mine)]
        todo, done = [(0, "", 0, "", "")], set()
        while True:
            cost, audit, at, state, lines = heapq.heappop(todo)
            if at == len(mine) and state in ("", "a"):
                break
            if (at, state) in done:
                continue
            done.add((at, state))
            following, name = ("a", "assistant") if state == "u" else ("u", "user")
            heapq.heappush(todo, (cost + 3, audit + "I", at, following, f"{lines}{name}:\n"))
            if at < len(mine):
                heapq.heappush(todo, (cost + 4, audit + "D", at + 1, state, lines))
                if faults[at] not in ("b", "d"):
                    extra = 3 if faults[at] == "t" else 0
                    _, _, role, text = mine[at]
                    first = role[:1]
                    if first == following or (first == "s" and state == ""):
                        heapq.heappush(todo, (cost + extra, audit + "K", at + 1, first, f"{lines}{role}:{text}\n"))
                    heapq.heappush(todo, (cost + 3 + extra, audit + "R", at + 1, following, f"{lines}{name}:{text}\n"))
        turns = [t for _, t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(p not in ("s>u", "u>a", "a>u") for p in pairs)
        sha = hashlib.sha256(lines[:-1].encode()).hexdigest()
        out.append((c, gaps, faults.count("b"), faults.count("d"), faults.count("t"), bad, cost, audit, sha))
    return sorted(out, key=str)


def test_repair_of_odd_turns(odd_turns):
    frame, rows = odd_turns
    plain = [(c, t, *(" " if x is None else x for x in rest)) for c, t, *rest in rows]
    every = list(dict.fromkeys(r[0] for r in rows))
    assert result(repair.report(frame), *REPORT) == brute_repair(plain, every)
    whole = repair.report(repair.damage(frame), frame)
    assert result(whole, *REPORT) == brute_repair(damaged(rows), every)


@pytest.mark.parametrize("seed, convs, most", [(1, 300, 9), (2, 20, 120)])
def test_repair_of_random_turns(session, seed, convs, most):
    rows = random_turns(seed, convs, most)
    frame = session.createDataFrame([r + EXTRA for r in rows], TURNS)
    every = list(dict.fromkeys(r[0] for r in rows))
    assert result(repair.report(repair.damage(frame), frame), *REPORT) == brute_repair(damaged(rows), every)


def test_grammar_does_not_change_the_edits(monkeypatch):
    """Long sequences by rules, by parts and symbol by symbol give the same cost and edits."""
    pick = random.Random(5)
    sequences = [bytes(pick.choices(range(9), k=k)) for k in (0, 1, 7, 400, 3000)] + [bytes([1, 2]) * 900]
    grammar = repair.Grammar(sequences)
    assert len(grammar.matrices) > repair.SYMBOLS + 50
    assert len(grammar.shorter[sequences[-1]]) < 100
    for s in sequences:
        plain = repair.EMPTY
        for symbol in s:
            plain = repair.times(plain, repair.TERMINALS[symbol])
        split = repair.Grammar([s[: len(s) // 3]]).after(s[: len(s) // 3], repair.EMPTY)
        split = repair.Grammar([s[len(s) // 3 :]]).after(s[len(s) // 3 :], split)
        assert repair.outcome(grammar.after(s, repair.EMPTY)) == repair.outcome(plain) == repair.outcome(split)


def test_ropes_compare_like_strings():
    pick = random.Random(9)
    for _ in range(300):
        strings = ["".join(pick.choices("DK", weights=[1, 12], k=150)) for _ in range(2)]
        if strings[0] == strings[1]:
            continue
        ropes = []
        for s in strings:
            at = sorted(pick.sample(range(len(s)), 9))
            rope = ""
            for a, b in itertools.pairwise([0, *at, len(s)]):
                rope = repair.join(rope, s[a:b])
            ropes.append(rope)
        assert [repair.text_of(r) for r in ropes] == strings
        assert repair.before(*ropes) == (strings[0] < strings[1])


def test_repaired_rows(session):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, "user", "So"), (1, 3, "tool", "x.")]
    frame = session.createDataFrame([r + EXTRA for r in rows], TURNS)
    found = result(repair.repaired(frame), "conv_id", "place", "edit", "role", "text")
    audit = repair.report(frame).first().audit
    assert [f[2] for f in found] == [e for e in audit if e != "D"]
    assert re.fullmatch("s?(ua)+", "".join(f[3][0] for f in found))


def test_conversations_without_rows(session, no_turns):
    ids = session.createDataFrame([(4,), (None,), (4,)], "conv_id bigint")
    empty = hashlib.sha256(b"").hexdigest()
    assert result(repair.report(no_turns, ids), *REPORT) == sorted(
        [(4, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)], key=str
    )
    assert repair.report(repair.damage(no_turns), no_turns).collect() == []
