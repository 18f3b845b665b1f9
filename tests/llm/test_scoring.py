"""Classifiers, rules and the language model: brute force, or accuracy on held-out labels."""

import collections
import math
import zlib

import numpy as np
import pytest

from starmill.llm import hash_arrays, lm_scoring, quality_classifier, quality_rules, toxicity

from .conftest import pairs, result

LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def larger(session):
    return [session.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels")]


def held_out(i, modulus, value):
    return zlib.crc32(("" if i is None else str(i)).encode()) % modulus == value


def judged(frame, labels, score, label, chosen):
    truth = {r.doc_id: r[label] for r in labels.collect()}
    rows = [r for r in frame.collect() if r.held_out and r.doc_id in truth]
    yes = [r[chosen] for r in rows if truth[r.doc_id] == 1]
    no = [r[chosen] for r in rows if truth[r.doc_id] == 0]
    assert all(0 <= r[score] for r in rows)
    return np.mean(yes), 1 - np.mean(no)


def test_quality_on_held_out_labels(larger):
    docs, labels = larger
    scored = quality_classifier.score(docs, labels)
    right_one, right_zero = judged(scored, labels, "score", "quality", "predicted")
    assert right_one > 0.97 and right_zero > 0.95


def test_temperature_keeps_the_order_and_calibrates():
    random = np.random.default_rng(0)
    x = random.normal(size=(600, 4))
    y = (random.random(600) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    tune = np.arange(600) % 3 == 0
    net = quality_classifier.Network(x, y, tune)
    p = net.probability(x)
    assert np.array_equal(np.argsort(net.raw(x)), np.argsort(p))
    assert abs(p[tune].mean() - y[tune].mean()) < 0.1


def test_toxicity_on_held_out_labels(larger):
    docs, labels = larger
    right_toxic, right_clean = judged(toxicity.score(docs, labels), labels, "severity", "toxic", "toxic")
    assert right_toxic > 0.75 and right_clean > 0.98


def test_more_toxic_words_are_more_severe(session, larger):
    docs, labels = larger
    model = toxicity.fit(docs, labels)
    import pyarrow as pa

    texts = pa.array(["and the of that", "and the idiot of that", "idiot scum loser and moron of that trash"])
    above = model.above(*toxicity.features(texts))
    severity = above.sum(axis=1)
    assert severity[0] < severity[1] < severity[2]
    assert (np.diff(above, axis=1) <= 0).all() and (np.diff(model.thresholds) > 0).all()


@pytest.mark.parametrize("operator", [quality_classifier, toxicity, quality_rules])
@pytest.mark.parametrize("table", ["odd", "nothing"])
@pytest.mark.parametrize("known", ["labels", "no_labels"])
def test_odd_rows_are_scored(request, operator, table, known):
    frame = request.getfixturevalue(table)
    scored = operator.score(frame, request.getfixturevalue(known))
    ids = sorted(r[0] for r in scored.select("doc_id").collect() if r[0] is not None)
    assert ids == sorted(r[0] for r in frame.select("doc_id").collect() if r[0] is not None)
    assert scored.count() == frame.count()


def test_accepted_rows_are_unchanged(odd, labels, no_labels):
    kept = quality_classifier.accepted(odd, no_labels)
    assert kept.columns == odd.columns and result(kept) == result(odd)


def brute_counts(t):
    w = (t or "").encode().split()
    n = len(w)
    seen = collections.Counter(tuple(w[k : k + 5]) for k in range(n - 4))
    covered = {q for k in range(n - 4) if seen[tuple(w[k : k + 5])] > 1 for q in range(k, k + 5)}
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    symbols = sum((t or "").count(c) for c in "#*$%&|<>")
    chars = sum(len(x.decode()) for x in w)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, chars, symbols, len(lines) - len(set(lines)), len(covered), failed


@pytest.mark.parametrize("table", ["documents", "odd", "nothing"])
def test_rule_counts(request, table):
    frame = request.getfixturevalue(table)
    want = sorted(((i, *brute_counts(t)) for i, t in pairs(frame)), key=str)
    assert [r[:7] for r in result(quality_rules.judge(frame, []))] == want


def test_learned_rules_hold_on_held_out_labels(larger):
    docs, labels = larger
    rules = quality_rules.fit(docs, labels)
    assert rules
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality_rules.judge(docs, rules).collect() if held_out(r.doc_id, 3, 1) and r.doc_id in truth]
    good = [r.rule is None for r in rows if truth[r.doc_id] == 1]
    bad = [r.kept for r in rows if truth[r.doc_id] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def brute_model(rows):
    def tokens(t):
        return [*(t or "").encode().lower().split(), "end"]

    pair, single = collections.Counter(), collections.Counter()
    for i, t in rows:
        if not held_out(i, 7, 2):
            before = "start"
            for w in tokens(t):
                pair[before, w] += 1
                single[w] += 1
                before = w
    total, words, links = sum(single.values()), len(single), len(pair)
    left_of = collections.Counter(w for _, w in pair)

    def discounts(values):
        n = [0, *(sum(v == k for v in values) for k in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        out = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
        return [0.0, *(min(max(v, 0.05), k) for k, v in enumerate(out, 1))]

    high, low = discounts(list(pair.values())), discounts(list(left_of.values()))
    rest = sum(low[min(v, 3)] for v in left_of.values()) / links if links else 1.0
    context, gamma = collections.Counter(), collections.Counter()
    for (h, _), c in pair.items():
        context[h] += c
        gamma[h] += high[min(c, 3)]

    def chance(h, w):
        below = max(left_of[w] - low[min(left_of[w], 3)], 0) / max(links, 1) + rest / (words + 1)
        if not context[h]:
            return below
        c = pair[h, w]
        return (max(c - high[min(c, 3)], 0) + gamma[h] * below) / context[h]

    out = []
    for i, t in rows:
        before, score, base, known = "start", 0.0, 0.0, 0
        for w in tokens(t):
            score += math.log10(chance(before, w))
            base += math.log10((single[w] + 1) / (total + words + 1))
            known += single[w] > 0
            before = w
        out.append((i, held_out(i, 7, 2), len(tokens(t)), known, total, base, score))
    mass = sum(chance("the", w) for w in single) + chance("the", "never seen")
    return sorted(out, key=lambda r: str(r[0])), mass


@pytest.mark.parametrize("table", ["documents", "odd", "nothing"])
def test_language_model(request, table):
    frame = request.getfixturevalue(table)
    want, mass = brute_model(pairs(frame))
    got = sorted((tuple(r) for r in lm_scoring.train_and_score(frame).collect()), key=lambda r: str(r[0]))
    key = lambda r: (str(r[0]), r[2], r[6])
    for ours, theirs in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert ours[:5] == theirs[:5]
        assert ours[5] == pytest.approx(theirs[5]) and ours[6] == pytest.approx(theirs[6])
    if table == "documents":
        assert mass == pytest.approx(1.0)


def test_frequent_words_are_spread(documents, monkeypatch):
    plain = result(lm_scoring.train_and_score(documents), "doc_id", "score")
    monkeypatch.setattr(lm_scoring, "HOT_WORDS", 0)
    flat = result(lm_scoring.train_and_score(documents), "doc_id", "score")
    assert [r[0] for r in plain] == [r[0] for r in flat]
    assert np.allclose([r[1] for r in plain], [r[1] for r in flat])


def test_hash_arrays_round_trip(tmp_path):
    keys = np.unique(np.random.default_rng(2).integers(0, 2**63, 1000).astype(np.uint64))
    values = np.arange(len(keys)) ** 2
    hash_arrays.put(f"file://{tmp_path}/arrays", "a", keys, [values, values % 7])
    store = hash_arrays.Store(f"file://{tmp_path}/arrays")
    got = store.get("a").find(np.append(keys[::-1], np.uint64(5)))
    assert got[0].tolist() == [*values[::-1], 0] and got[1].tolist() == [*(values[::-1] % 7), 0]
    assert store.get("b") is None
