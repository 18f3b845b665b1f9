"""Web archives: WARC files of pages, their capture index, and captures in global order.

``archive`` writes a record per page, one gzip member each, into files below the shared folder.
Of pages with equal payloads of at least ``SAME`` bytes the one with the largest page_id is a
response and the others are revisits that refer to it. A task names its files anew whenever it
runs, and only files that a finished task has listed count, so a lost executor leaves nothing
but files that nobody reads.

``captures`` reads the files back: lengths and digests come from the payloads found there. Every
file gives a run of index lines sorted by URL key, time and page; the runs are merged by loser
trees (``capture_merge``) into histories in one global order. A revisit takes length and digest
from the response it refers to.

Odd rows. A NULL html is an empty payload, a NULL url an empty one. A NULL page_id counts as the
smallest and is returned as NULL. Rows that repeat page_id and payload are records of their own,
equal in kind. Characters that a header cannot hold (blanks, controls) are percent-encoded in the
URL. An empty table gives no record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.capture_merge import BLOCK, block_batch, blocks_of, merged
from starmill.llm.common import NULL_ID, shared_folder, small_or_shuffled, written

SAME = 1000
# A file ends with the record that reaches one of these.
FILE_BYTES, FILE_RECORDS = 256 << 20, 100_000
LEVEL = 4
# Rows of (digest, page), 40 bytes each, that may be sent to every executor.
SMALL = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Capture times that are made from ids: seconds of five years from 2020 on.
EPOCH, SPAN = 1_577_836_800, 5 * 365 * 86_400
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


# --- records ----------------------------------------------------------------------------


def record_id(page: int, sha1: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page}:{sha1}'.encode(), usedforsecurity=False).digest())}>"


def member(kind: str, name: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    parts = ("\r\n".join(lines).encode(), block, b"\r\n\r\n")
    return b"".join([*(packer.compress(p) for p in parts), packer.flush()])


def page_record(page: int, url: str, html: bytes, second: int, refers: int | None) -> bytes:
    sha1 = hashlib.sha1(html, usedforsecurity=False)
    date = datetime.fromtimestamp(second, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    headers = [
        ("WARC-Date", date),
        ("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha1.digest()).decode()}"),
        ("X-Page-Id", str(page)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n"
    name = record_id(page, sha1.hexdigest())
    if refers is None:
        return member("response", name, headers, http.encode() + html)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, sha1.hexdigest()))]
    return member("revisit", name, headers, http.encode())


def records(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the gzip members of an open file."""
    offset, rest = 0, b""
    while True:
        unpack, parts, length = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            data = rest or stream.read(1 << 20)
            if not data:
                if length:
                    raise ValueError(f"the archive ends inside the record at {offset}")
                return
            parts.append(unpack.decompress(data))
            rest = unpack.unused_data
            length += len(data) - len(rest)
        whole = b"".join(parts)
        head, _, body = whole.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        yield offset, length, headers, body[: int(headers["content-length"])]
        offset += length


def url_key(url: str) -> str:
    """A sort-friendly form: host from its end, no www, path and sorted query in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return _UNSAFE.sub("%", url.lower())
    host = re.sub(r"^www\d*\.", "", host)
    shown = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    path = parts.path.rstrip("/") or "/"
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    key = f"{','.join(reversed(host.split('.')))}{shown}){path}{'?' + query if query else ''}"
    return _UNSAFE.sub("%", key)


# --- writing ----------------------------------------------------------------------------


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, size, count = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([count], pa.int64()), pa.array([size], pa.int64())],
                ["file", "records", "bytes"],
            )

        for batch in batches:
            pages, urls, htmls, seconds, refers = batch.columns
            for k in range(batch.num_rows):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                    about = member(
                        "warcinfo", f"<urn:uuid:{uuid.uuid4()}>",
                        [("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                        b"format: WARC File Format 1.1\r\n",
                    )
                    out.write(about)
                    size = len(about)
                data = page_record(
                    pages[k].as_py(), urls[k].as_py(), htmls[k].as_buffer().to_pybytes(),
                    seconds[k].as_py(), refers[k].as_py(),
                )
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= FILE_BYTES or count >= FILE_RECORDS:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    return run


def made_up_time(page: Column) -> Column:
    """A capture time, in seconds, for pages that come without one; it depends on the id alone."""
    return F.lit(EPOCH) + F.pmod(page, F.lit(SPAN))


def archive(pages: DataFrame, captured: Column | None = None) -> tuple[str, DataFrame]:
    """Write WARC files; the folder, and (file, records, bytes) of the files that count.

    ``captured``: the time of capture in seconds, from 1970 to 9999; made from page_id without it.
    """
    page = F.coalesce(F.col("page_id").cast("bigint"), F.lit(NULL_ID))
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        page.alias("_page"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("_url"),
        html.alias("_html"),
        (made_up_time(page) if captured is None else captured).cast("bigint").alias("_second"),
    )
    same = F.when(F.octet_length("_html") >= SAME, F.unhex(F.sha2("_html", 256))).alias("_same")
    shared = (
        rows.select("_page", same)
        .where("_same IS NOT NULL")
        .groupBy("_same")
        .agg(F.max("_page").alias("_top"), F.min("_page").alias("_low"))
        .where("_low < _top")
        .select("_same", "_top")
    )
    # Few payloads repeat, as a rule; then pages stay where they are.
    shared = small_or_shuffled(written(shared), SMALL)
    refers = F.nullif(F.col("_top"), F.col("_page")).alias("_refers")
    told = rows.withColumn("_same", same).join(shared, "_same", "left")
    folder = shared_folder(pages.sparkSession)
    files = told.select("_page", "_url", "_html", "_second", refers).mapInArrow(
        _writer(folder), "file string, records bigint, bytes bigint"
    )
    return folder, written(files)


# --- reading ----------------------------------------------------------------------------


def index_line(file: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> bytes | None:
    """URL key, 14 digits of time, page, then the rest as JSON; None for other records."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = len(payload)
    digest = hashlib.sha1(payload, usedforsecurity=False)
    if kind == "response":
        if told and base64.b32decode(told) != digest.digest():
            raise ValueError(f"the payload at {offset} of {file} does not have its digest")
        sha1 = digest.hexdigest()
    else:
        sha1 = base64.b32decode(told).hex()
        found = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size = int(found[1]) if found else 0
    url = headers.get("warc-target-uri", "")
    page = int(headers.get("x-page-id", NULL_ID))
    rest = {
        "page": page, "url": url, "kind": kind, "id": headers["warc-record-id"],
        "refers": headers.get("warc-refers-to"), "bytes": size, "sha1": sha1,
        "file": file, "offset": offset, "length": length,
    }
    time = re.sub(r"\D", "", headers["warc-date"])[:14]
    return f"{url_key(url)} {time} {page - NULL_ID:016x} {json.dumps(rest)}".encode()


def _runs(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                lines = []
                with store.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for offset, length, headers, block in records(stream):
                        line = index_line(file, offset, length, headers, block)
                        if line is not None:
                            lines.append(line)
                lines.sort()
                name = int.from_bytes(hashlib.md5(file.encode(), usedforsecurity=False).digest()[:8], "big", signed=True)
                for row in blocks_of(name, lines):
                    yield block_batch([row])

    return run


ENTRY = {
    "url_key": "string", "timestamp": "string", "page": "bigint", "url": "string", "kind": "string",
    "id": "string", "refers": "string", "bytes": "bigint", "sha1": "string", "file": "string",
    "offset": "bigint", "length": "bigint",
}


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in ENTRY.items()])
    for batch in batches:
        for packed in batch.column(2).to_pylist():
            rows = []
            for line in packed.split(b"\n"):
                key, time, _, rest = line.decode().split(" ", 3)
                rows.append({"url_key": key, "timestamp": time} | json.loads(rest))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def histories(folder: str, files: DataFrame) -> DataFrame:
    """The captures of the files as ENTRY, in the order of URL key, time and page across all tasks."""
    count = files.count()
    dealt = files.select("file").repartition(max(1, min(count, 20_000)))
    runs = written(dealt.mapInArrow(_runs(folder), BLOCK))
    return merged(runs).mapInArrow(_entries, ", ".join(f"{k} {v}" for k, v in ENTRY.items()))


def captures(folder: str, files: DataFrame) -> DataFrame:
    """ENTRY of every capture; a revisit has length and digest of its response, and its page as refers_to."""
    index = written(histories(folder, files))
    responses = (
        index.where("kind = 'response'")
        .groupBy(F.col("id").alias("refers"))
        .agg(F.first("page").alias("_page"), F.first("bytes").alias("_bytes"), F.first("sha1").alias("_sha1"))
    )
    plain = index.where("kind = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    again = index.where("kind = 'revisit'").join(responses, "refers", "left").select(
        *(c for c in ENTRY if c not in ("bytes", "sha1")),
        F.coalesce("_bytes", "bytes").alias("bytes"),
        F.coalesce("_sha1", "sha1").alias("sha1"),
        F.col("_page").alias("refers_to"),
    )
    return plain.unionByName(again)


def round_trip(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """Write the pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = captures(*archive(pages, captured))
    return found.select(
        F.nullif(F.col("page"), F.lit(NULL_ID)).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.nullif(F.col("refers_to"), F.lit(NULL_ID)).alias("refers_to"),
    )
