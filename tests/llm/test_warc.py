"""Archives: files, index runs, merged histories, and the way there and back."""

import gzip
import hashlib
import io
import random

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from starmill.llm import capture_merge, warc

from .conftest import result

SCHEMA = "page_id bigint, url string, html string, _page int, _same string, bytes int, kind string"
COLUMNS = "page_id payload_bytes payload_digest record_type refers_to".split()
EXTRA = (1, "s", 2, "k")


def brute(rows):
    low = {None: -(2**63)}
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data]
        top = max(same, key=lambda p: low.get(p, p))
        again = len(data) >= 1000 and top != page
        digest = hashlib.sha1(data).hexdigest()
        out.append((page, len(data), digest, "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def odd_pages(session):
    large, edge = "<p>ü\r\n\r\nWARC/1.1\r\n</p>" * 50, "x" * 998 + "ü"
    rows = [
        (1, "http://www.a.example.com/x?b=2&a=1#top", large), (2, "https://b.example.org", large), (3, None, large),
        (None, "http://c.example.com:8080/", large), (4, "bad url\r\nX-Header: 1", "small"), (5, "u", "small"),
        (6, "u", None), (7, "", ""), (8, "http://[bad", edge[:-1]), (9, "http://a.example.com/X", edge[:-1]),
        (10, "http://a.example.com/x", edge), (11, "http://a.example.com/x", edge), (12, "ü é", "y" * 3_000_000),
        (13, "v", "y" * 3_000_000), (14, "w", "z" * 1000), (14, "w", "z" * 1000), (15, "w2", "q" * 1000),
        (15, "w2", "q" * 1000), (16, "w2", "q" * 1000), (None, None, None), (-7, "neg", "q" * 1000),
    ]
    return session.createDataFrame([r + EXTRA for r in rows], SCHEMA), rows


def test_round_trip_of_odd_pages(odd_pages):
    frame, rows = odd_pages
    assert result(warc.round_trip(frame), *COLUMNS) == brute(rows)


def test_pages_that_are_shuffled_give_the_same(odd_pages, monkeypatch):
    frame, rows = odd_pages
    monkeypatch.setattr(warc, "SMALL", 0)
    assert result(warc.round_trip(frame), *COLUMNS) == brute(rows)


def test_nothing_to_archive(session):
    assert warc.round_trip(session.createDataFrame([], SCHEMA)).collect() == []


def test_files_are_plain_gzip_members(odd_pages):
    frame, rows = odd_pages
    folder, files = warc.archive(frame.repartition(3))
    assert files.agg(F.sum("records")).first()[0] == len(rows)
    store, path = fs.FileSystem.from_uri(folder)
    payloads = []
    for file, count, size in files.collect():
        raw = store.open_input_stream(f"{path}/{file}", compression=None).read()
        assert len(raw) == size
        found = list(warc.records(io.BytesIO(raw)))
        assert sum(length for _, length, _, _ in found) == size and len(found) == count + 1
        assert found[0][2]["warc-type"] == "warcinfo"
        assert gzip.decompress(raw).count(b"WARC-Type: ") == count + 1
        for offset, length, headers, block in found:
            single = gzip.decompress(raw[offset : offset + length])
            assert single.startswith(b"WARC/1.1\r\n") and single.endswith(block + b"\r\n\r\n")
            if headers["warc-type"] == "response":
                payloads.append(block.split(b"\r\n\r\n", 1)[1])
            if headers["warc-type"] == "revisit":
                assert headers["warc-refers-to"].startswith("<urn:uuid:")
            assert "x-header" not in headers
    kept = {(h or "").encode() for _, _, h in rows}
    assert set(payloads) == kept


def test_damaged_archives_are_noticed(odd_pages):
    page = warc.page_record(1, "u", b"p" * 50, 0, None)
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(page[:-9])))
    (offset, length, headers, block), = warc.records(io.BytesIO(page))
    with pytest.raises(ValueError, match="digest"):
        warc.index_line("f", offset, length, headers, block[:-1] + b"q")


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_histories_in_global_order(session, monkeypatch, fan_in):
    """Many files, a hot URL with a third of all captures, and ranges that cut its blocks."""
    monkeypatch.setattr(capture_merge, "RANGE_BLOCKS", 2)
    merge = capture_merge.merged
    monkeypatch.setattr(warc, "merged", lambda blocks: merge(blocks, fan_in))
    pages = session.range(3000).selectExpr(
        "id AS page_id", "IF(id % 3 = 0, 'http://hot.example.com/', concat('http://h', id % 97, '.example.com/', id)) AS url",
        "concat('html ', id) AS html",
    )
    folder, files = warc.archive(pages.repartition(11), F.lit(1_600_000_000) + F.col("page_id") % 50)
    found = [(r.url_key, r.timestamp, r.page) for r in warc.histories(folder, files).collect()]
    assert len(found) == 3000 and found == sorted(found)
    assert sum(k == "com,example,hot)/" for k, _, _ in found) == 1000


def test_loser_tree_merges_like_a_sort():
    pick = random.Random(3)
    for k in (1, 2, 3, 7, 20):
        lists = [sorted(b"%05d" % pick.randrange(500) for _ in range(pick.randrange(1, 40))) for _ in range(k)]
        tree, out = capture_merge.LoserTree(), []
        for run, lines in enumerate(lists):
            tree.add(run, lines)
        while tree.least() is not None:
            out.append(tree.pop())
        assert out == sorted(x for lines in lists for x in lines)
    assert capture_merge.LoserTree().least() is None


def test_url_keys():
    assert warc.url_key("HTTPS://www2.News.Example.com:443/A/?b=2&a=1#x") == "com,example,news)/a?a=1&b=2"
    assert warc.url_key("http://x.example.com:81") == "com,example,x:81)/"
    assert " " not in warc.url_key("http://[bad host") and "\n" not in warc.url_key("a\nb c")
