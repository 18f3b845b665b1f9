"""Byte, word and near-duplicate removal against brute force."""

import collections
import hashlib

import numpy as np
import pytest

from starmill.llm import components, minhash_dedup, substring_dedup, suffix_dedup

from .conftest import pairs, result

LOW = -(2**63)


def brute_bytes(rows, size=50):
    first = {}
    texts = [(LOW if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - size + 1):
            key = t[p : p + size]
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in texts:
        keep = bytearray(b"\1" * len(t))
        for p in range(len(t) - size + 1):
            if first[t[p : p + size]] < i:
                keep[p : p + size] = bytes(size)
        spans = sum(a == 1 and b == 0 for a, b in zip(b"\1" + keep, keep, strict=False))
        digest = hashlib.sha256(bytes(c for c, k in zip(t, keep, strict=True) if k)).hexdigest()
        out.append((None if i == LOW else i, len(t), len(t) - sum(keep), spans, digest))
    return sorted(out, key=str)


def brute_words(rows, size=20):
    first = {}
    texts = [(LOW if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for i, w in texts:
        keep = [True] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < (i, p):
                keep[p : p + size] = [False] * size
        kept = b" ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((None if i == LOW else i, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_near(rows, percent=85):
    texts = [(LOW if i is None else i, (t or "").encode().lower().split()) for i, t in rows]
    sets = []
    for _, w in texts:
        if len(w) >= 5:
            sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)))
        else:
            sets.append(frozenset([tuple(w)] if w else []))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    shared = collections.Counter()
    for h in holders.values():
        for n, a in enumerate(h):
            for b in h[:n]:
                shared[b, a] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(texts):
        least[find(k)] = min(least.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(texts):
        c = least[find(k)]
        out.append((None if i == LOW else i, len(sets[k]), None if c == LOW else c, c == i))
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["documents", "odd", "nothing"])
@pytest.mark.parametrize("hot", [256, 2])
def test_bytes(request, monkeypatch, table, hot):
    frame = request.getfixturevalue(table)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", hot)
    assert result(suffix_dedup.deduplicate(frame)) == brute_bytes(pairs(frame))


@pytest.mark.parametrize("table", ["documents", "odd", "nothing"])
def test_words(request, table):
    frame = request.getfixturevalue(table)
    assert result(substring_dedup.deduplicate(frame)) == brute_words(pairs(frame))


@pytest.mark.parametrize("table", ["documents", "odd", "nothing"])
def test_near_duplicates(request, table):
    frame = request.getfixturevalue(table)
    assert result(minhash_dedup.deduplicate(frame)) == brute_near(pairs(frame))


def test_near_duplicate_chain_and_crowd(session):
    """A chain of links, and a crowd of variants of one text that are too far apart."""
    base = [f"w{k}" for k in range(150)]
    chain, crowd = [], []
    words = list(base)
    for k in range(8):
        chain.append((100 - k, " ".join(words)))
        words[3 + 17 * k] = f"new{k}"
    for k in range(60):
        other = [f"c{x}" for x in range(150)]
        for x in range(4):
            other[(k * 7 + 37 * x) % 150] = f"own{k}-{x}"
        crowd.append((200 + k, " ".join(other)))
    frame = session.createDataFrame(chain + crowd, "doc_id bigint, text string")
    got = result(minhash_dedup.deduplicate(frame))
    assert got == brute_near(pairs(frame))
    assert len({r[2] for r in got if r[0] <= 100}) == 1


def test_survivors_keep_columns_and_one_row_of_each_group(odd):
    kept = minhash_dedup.survivors(odd)
    assert kept.columns == odd.columns
    got = result(kept, "doc_id", "text")
    texts = [t for _, t in got]
    assert len(got) == len(set(got))
    assert sum(t is not None and t.startswith("the quick") for t in texts) == 2
    assert (1, None) in got and (2, "") in got


def test_merged_transforms_equal_sorted_suffixes():
    random = np.random.default_rng(1)
    texts = [bytes(random.integers(97, 100, random.integers(20, 40)).astype(np.uint8)) for _ in range(30)]
    owners = random.integers(0, 9, 30)
    gone = suffix_dedup.repeated_places(texts, owners, 8)
    first = {}
    for t, o in zip(texts, owners, strict=True):
        for p in range(len(t) - 7):
            first[t[p : p + 8]] = min(first.get(t[p : p + 8], 99), o)
    for row, (t, o) in enumerate(zip(texts, owners, strict=True)):
        for p in range(gone.shape[1]):
            assert gone[row, p] == (p + 8 <= len(t) and first[t[p : p + 8]] < o)


def test_bytes_of_texts_that_repeat_themselves(session):
    der, line = "Der " * 300, "the same line again and again, with some more words in it\n" * 40
    rows = [(1, der), (2, "x" + der), (3, line), (4, "start " + line + der), (5, "Der " * 20 + "end"), (6, line[:70])]
    frame = session.createDataFrame(rows, "doc_id bigint, text string")
    assert result(suffix_dedup.deduplicate(frame)) == brute_bytes(rows)


def test_a_hot_key_sends_one_row_per_chunk_to_its_group():
    from starmill.llm import sieve

    hot = np.uint64((1 << 63) + 5)
    keys = np.concatenate([np.full(300, hot), np.arange(300, dtype=np.uint64) + np.uint64(1 << 63) + np.uint64(9)])
    rows = np.tile(np.arange(300), 2)
    offered = sieve.offer(keys, rows, np.arange(300) * 7, within=False).to_pydict()
    to_group = [k for k, d in enumerate(offered["_deal"]) if d == int(hot) - (1 << 64)]
    assert len(to_group) == 1 and offered["_kind"][to_group[0]] == sieve.STAND_IN
    assert offered["_kind"].count(sieve.PROVEN) == 300
    assert offered["_kind"].count(sieve.SINGLE) == 300
    assert len(set(offered["_deal"])) == 601


def test_bands_follow_the_similarity():
    assert minhash_dedup.layout(85) == (32, 6)
    for percent in (30, 50, 80, 85, 95):
        bands, depth = minhash_dedup.layout(percent)
        assert (1 - (percent / 100) ** depth) ** bands <= 3e-7


def test_rounds_of_components_are_few_and_small(session, monkeypatch):
    """A round reads the links eight times at most, and links that are stars already take none."""
    plans, write = [], components.written
    monkeypatch.setattr(components, "written", lambda df: plans.append(df) or write(df))
    stars = [(k % 3, 10 + k) for k in range(30)]
    chain = [(100 + k, 100 + (k + 7) % 40) for k in range(0, 200, 7)]
    hub = [(200 + k, 299) for k in range(50)] + [(299, 220), (299, 299), (220, 299)]

    def found(links):
        plans.clear()
        return result(components.components(session.createDataFrame(links, "u bigint, v bigint")))

    assert found(stars) == sorted(((v, u) for u, v in stars), key=str)
    assert len(plans) == 1
    links = stars + chain + hub
    least = {x: x for link in links for x in link}
    for _ in least:
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    assert found(links) == sorted(((x, c) for x, c in least.items() if x != c), key=str)
    leaves = [df._jdf.queryExecution().optimizedPlan().collectLeaves().size() for df in plans[1:]]
    assert leaves and max(leaves) <= 8


def test_shingle_rows_carry_the_size_of_their_set(session):
    rows = [(1, "a b c d e f g a b c d e"), (2, "a b"), (3, " ")]
    frame = session.createDataFrame(rows, "doc_id bigint, text string")
    texts = minhash_dedup.keyed(frame).selectExpr("struct(_id, _th) AS _rep", "_text")
    got = texts.mapInArrow(minhash_dedup._shingle_rows, minhash_dedup.SHINGLE_ROWS).selectExpr("_rep._id", "_n", "_h")
    assert [r[:2] for r in result(got)] == [(1, 7)] * 7 + [(2, 1)]
