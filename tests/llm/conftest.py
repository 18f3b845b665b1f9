import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, _text string, _row int, block int, label int, _key string, n bigint"


@pytest.fixture(scope="session")
def session(spark):
    from starmill.llm.common import importable

    return importable(spark)


@pytest.fixture(scope="session")
def documents(session):
    return session.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(session):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns."""
    long = " ".join(f"word{k % 700} and{k}" for k in range(4000))
    twin = "the quick brown fox jumps over the lazy dog and then walks home again slowly because it was very tired indeed my friend"
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 4),
        (4, twin, "en", "b", len(twin)),
        (5, twin, "en", "b", len(twin)),
        (5, twin, "en", "b", len(twin)),
        (6, twin + " Again " + twin, "en", "c", None),
        (6, "another text under the same id", "en", "c", None),
        (None, twin, "en", "c", None),
        (None, None, None, None, None),
        (7, long, "en", "a", len(long)),
        (8, long + " tail", "en", "a", len(long) + 5),
        (9, "öäü ß password = hunter22 é", "de", "a", 27),
        (10, "a b c", "en", "a", 5),
        (11, "A B\tC", "en", "a", 5),
        (12, "x" * 49, "en", "a", 49),
        (13, "x" * 200, "en", "a", 200),
        (14, "x" * 50, "en", None, 50),
    ]
    extra = ("i", "t", 7, 8, 9, "k", 10)
    return session.createDataFrame([r + extra for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(session):
    return session.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(session):
    return session.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="session")
def no_labels(session):
    return session.createDataFrame([], "doc_id bigint, quality int, toxic int")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def result(frame, *columns):
    """Rows as tuples, in an order that copes with NULLs."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=str)
