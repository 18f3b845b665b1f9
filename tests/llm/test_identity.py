"""Rows that share an id, or have none, stay apart however alike a short hash makes their texts."""

import pytest

from starmill.llm import common, decontamination, minhash_dedup, secret_scan, substring_dedup, suffix_dedup

from .conftest import pairs, result
from .test_dedup import brute_bytes, brute_words

# Pairs of texts with the same 32-bit hash.
ALIKE = ["alpha beta gamma delta epsilon zeta number72837", "alpha beta gamma delta epsilon zeta number352041"]
HOLDS, CLEAN = (
    "the quick brown fox jumps over the lazy dog near the river bank today 128615",
    "plain text without anything to see here but a number 206857",
)


def frame(session, rows):
    return session.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")


def test_texts_that_hash_alike_without_id(session):
    docs = frame(session, [(None, t, "s", "en") for t in ALIKE])
    assert docs.selectExpr("hash(text) AS h").distinct().count() == 1
    assert result(minhash_dedup.survivors(docs), "text") == [(ALIKE[1],), (ALIKE[0],)]


def test_a_clean_row_is_not_taken_for_a_contaminated_one(session):
    docs = frame(session, [(5, HOLDS, "s", "en"), (5, CLEAN, "s", "en")])
    items = session.createDataFrame([(1, HOLDS.rsplit(" ", 1)[0])], "item_id bigint, text string")
    assert result(decontamination.clean(docs, items), "text") == [(CLEAN,)]


def test_spans_belong_to_their_own_text(session):
    tails = [" number 7", " number 8 and more of it"]
    docs = frame(session, [(5, f"password = Zk3vQ9xLm2Rt8WyBc4{tails[0]}", "s", "en"), (5, "x" * 30 + tails[1], "s", "en")])
    assert result(secret_scan.masked(docs), "text") == sorted([(f"<SECRET>{tails[0]}",), ("x" * 30 + tails[1],)])


def rows_without_ids(count):
    shared = " ".join(f"w{k}" for k in range(40))
    rows = [(None, f"{shared} only {k} here", "s", "en") for k in range(count)]
    return [*rows, *rows[:20], *((k, f"{shared} {k}", "s", "en") for k in range(20)), (7, shared, "s", "en")]


def test_many_rows_without_id(session):
    docs = frame(session, rows_without_ids(300))
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert result(substring_dedup.deduplicate(docs), *columns) == brute_words(pairs(docs))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result(suffix_dedup.deduplicate(docs), *columns) == brute_bytes(pairs(docs))


def test_numbers_of_documents(session):
    docs = frame(session, rows_without_ids(50))
    every, once = common.numbered(docs)
    assert every.count() == docs.count()
    assert once.count() == once.select("_doc").distinct().count() == docs.select("doc_id", "text").distinct().count()
    assert every.where("_id BETWEEN 0 AND 19 AND _id <> 7 AND _doc <> _id").count() == 0
    plain = frame(session, [(k, "t", "s", "en") for k in range(5)])
    assert common.numbered(plain)[0].where("_doc <> _id").count() == 0


def test_numbers_avoid_those_of_other_documents(session, monkeypatch):
    """A number that is another row's id, or another document's, is not used."""
    rows = [(1, "a", "s", "en"), (1, "b", "s", "en")]
    first = frame(session, rows).select(
        common.F.xxhash64(common.F.lit(0), common.row_id(), common.text_key()).alias("n")
    )
    taken = first.collect()[0].n
    docs = frame(session, [*rows, (taken, "c", "s", "en")])
    _, once = common.numbered(docs)
    assert once.select("_doc").distinct().count() == 3


@pytest.mark.parametrize("lower", [False, True])
def test_long_words_are_hashed_by_more_than_sums(session, lower):
    import pyarrow as pa

    twins = ["a", "b"]
    for _ in range(10):
        twins = [twins[0] + twins[1], twins[1] + twins[0]]
    words = common.Words(pa.array([" ".join(twins), twins[0].upper()]), lower)
    assert len(twins[0]) == 1024 and len(set(words.hashes.tolist())) == (2 if lower else 3)
