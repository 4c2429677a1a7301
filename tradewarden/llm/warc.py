"""Web archives with a two-level capture index.

Each partition of pages becomes one archive file of gzipped WARC records; a payload that an earlier page id already holds
becomes a revisit record. The captures are sorted by URL key (the host reversed, so that a domain's pages lie together) and
written in compressed blocks of lines; a sparse directory keeps each block's first key and place. A lookup sends each key to the
index files whose range holds it, searches their part of the directory by bisection, reads a block by its byte range, and then the
record by its range.

Files are written and read by executors through pyarrow's file systems, in a folder that all of them share. A file name
carries a random part, so that a task that runs again never writes to a file of its earlier attempt; the tables of captures
and of blocks name the files that count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.llm.common import scratch, stored, text_of

MIN_BYTES = 0
BLOCK_LINES = 3_000
BLOCKS_A_FILE = 20
DATE = "2000-01-01T00:00:00Z"
LEVEL = 4
#: Index files at most; the directory's upper level has a row for each.
FILES = 20_000

CAPTURE = "page_id long, url string, key string, file string, offset long, length long, digest string, type string, refers_to long"
DIRECTORY = "first string, last string, file string, offset long, length long, lines long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_CAPTURE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
                      ("length", pa.int64()), ("digest", pa.string()), ("type", pa.string()), ("refers_to", pa.int64())])
_DIRECTORY = pa.schema([("first", pa.string()), ("last", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
                        ("length", pa.int64()), ("lines", pa.int64())])
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64())])


def url_key(url: str | None) -> str:
    """The URL's host reversed, then its path and query: com,example,www)/path?query. No scheme, port or fragment."""
    try:
        at = urlsplit((url or "").strip())
        host = ",".join(reversed((at.hostname or "").split(".")))
        key = f"{host}){at.path or '/'}" + (f"?{at.query}" if at.query else "")
    except ValueError:
        key = (url or "").strip()
    return quote(key, safe="!#$%&'()*+,-./:;=?@[]_~|")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or '', safe=chr(37) + '!#$&()*+,-./:;=?@[]_~')}",
            f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers (lower-case names) and payload of a record, and its payload's length, which a revisit states only."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "payload": payload, "size": size}


def _number(urn: str | None) -> int | None:
    found = (urn or "").strip("<>").rpartition(":")[2]
    return int(found) if found not in ("", "None") else None


class Files:
    """Byte ranges of files in one folder, with the files kept open."""

    def __init__(self, folder: str):
        self.system, self.base = _system(folder)
        self.open: dict[str, pa.NativeFile] = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.system.open_input_file(f"{self.base}/{name}")
        return self.open[name].read_at(length, offset)


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write_archive(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        name, out, offset = f"pages-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, first, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first", "revisit")),
                                                             strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                refers_to = first if revisit else None
                member = gzip.compress(record(page_id, url, payload, refers_to, revisit), compresslevel=LEVEL, mtime=0)
                out.write(member)
                rows.append({"page_id": page_id, "url": url, "key": url_key(url), "file": name, "offset": offset, "length": len(member),
                             "digest": digest_of(payload), "type": "revisit" if revisit else "response", "refers_to": refers_to})
                offset += len(member)
            yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURE)
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes one record per row of `pages` below `folder` and returns the captures (CAPTURE), stored.

    Of the records with equal payloads of at least `min_bytes` bytes, those with the smallest id are responses and the
    others revisits. A NULL payload is empty and a NULL URL is the empty one; a row without an id is a response only where
    no equal payload has an id. Rows that repeat an id and a payload are responses both, or revisits both."""
    payload = text_of(payload_col).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    first = rows.groupBy("digest", "size").agg(F.min("page_id").alias("first"))
    typed = rows.join(first, ["digest", "size"]).withColumn(
        "revisit", (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")))
    # The payloads are shuffled once, by the join; its partitions become the archives.
    return stored(typed.mapInArrow(_write_archive(folder), CAPTURE), "captures")


def _write_blocks(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        name, out, offset = f"index-{uuid.uuid4().hex}.cdx.gz", None, 0
        lines: list[str] = []
        keys: list[str] = []

        def flush() -> dict:
            nonlocal out, offset
            if out is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(f"{base}/{name}", compression=None)
            packed = gzip.compress("".join(lines).encode(), compresslevel=6, mtime=0)
            out.write(packed)
            row = {"first": keys[0], "last": keys[-1], "file": name, "offset": offset, "length": len(packed), "lines": len(lines)}
            offset += len(packed)
            lines.clear()
            keys.clear()
            return row
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                key = r.pop("key")
                keys.append(key)
                lines.append(f"{key} {DATE} {json.dumps(r, separators=(',', ':'))}\n")
                if len(lines) >= block_lines:
                    found.append(flush())
            yield pa.RecordBatch.from_pylist(found, schema=_DIRECTORY)
        if lines:
            yield pa.RecordBatch.from_pylist([flush()], schema=_DIRECTORY)
        if out is not None:
            out.close()
    return run


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the captures below `folder` in compressed blocks, sorted by URL key, and returns the directory (DIRECTORY), stored."""
    n = min(FILES, max(8, -(-captures.count() // (BLOCKS_A_FILE * block_lines))))
    ordered = captures.repartitionByRange(n, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    return stored(ordered.mapInArrow(_write_blocks(folder, block_lines), DIRECTORY), "directory")


def _entries(packed: bytes) -> Iterator[tuple[str, dict]]:
    for line in gzip.decompress(packed).decode().splitlines():
        key, _, rest = line.split(" ", 2)
        yield key, json.loads(rest)


def _read_record(files: Files, entry: dict) -> dict:
    found = parse(zlib.decompress(files.read(entry["file"], entry["offset"], entry["length"]), wbits=31))
    head = found["headers"]
    stated = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and digest_of(found["payload"]) != stated:
        raise ValueError(f"the payload of {head['warc-record-id']} doesn't match its digest")
    return {"page_id": _number(head["warc-record-id"]), "payload_bytes": found["size"], "payload_digest": stated,
            "record_type": head["warc-type"], "refers_to": _number(head.get("warc-refers-to")),
            "payload": found["payload"]}


def _assign(ranges: list[tuple[str, str, str]]):
    """The index files that may hold each key: `ranges` are (first key, last key, file) in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts, names = zip(*ranges, strict=True)
        for batch in batches:
            rows = []
            for url, key in zip(batch.column("url").to_pylist(), batch.column("key").to_pylist(), strict=True):
                key = url_key(url) if key is None else key
                at = bisect_left(lasts, key)
                while at < len(firsts) and firsts[at] <= key:
                    rows.append((names[at], key, url))
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.string())] * 3,
                                             names=["file", "key", "url"])
    return run


def _search(archives: str, index: str, schema: pa.Schema):
    """Records behind keys. For each index file come its directory entries and then the keys, both in order: a key's blocks
    are found by bisection and read by their ranges, and then its records by theirs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, files = Files(index), Files(archives)
        name, firsts, places, at_hand, lines = None, [], [], None, {}
        found: list[tuple[str | None, dict]] = []

        def records() -> pa.RecordBatch:
            found.sort(key=lambda x: (x[1]["file"], x[1]["offset"]))
            rows = [{"url": url} | _read_record(files, e) for url, e in found]
            found.clear()
            return pa.RecordBatch.from_pylist([{n: r[n] for n in schema.names} for r in rows], schema=schema)
        for batch in batches:
            for r in batch.to_pylist():
                if r["file"] != name:
                    name, firsts, places = r["file"], [], []
                if not r["wanted"]:
                    firsts.append(r["key"])
                    places.append((r["last"], r["offset"], r["length"]))
                    continue
                at = max(0, bisect_left(firsts, r["key"]) - 1)
                while at < len(firsts) and firsts[at] <= r["key"]:
                    last, offset, length = places[at]
                    if last >= r["key"]:
                        if at_hand != (name, offset):
                            at_hand, lines = (name, offset), {}
                            for key, entry in _entries(blocks.read(name, offset, length)):
                                lines.setdefault(key, []).append(entry)
                        found += [(r["url"], e) for e in lines.get(r["key"], ())]
                    at += 1
                    if len(found) >= 500:
                        yield records()
        if found:
            yield records()
    return run


def _through_index(wanted: DataFrame, directory: DataFrame, archives: str, index: str, schema: pa.Schema, ddl: str, slice_rows: int) -> DataFrame:
    """The records of each row of `wanted` (url, key; a NULL key is that of the URL), by both levels of the index.

    The index files' key ranges, at most FILES rows, send each key to its files, where it meets the part of the directory
    that describes them; nothing else of the directory is held in one place."""
    ranges = [tuple(r) for r in directory.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last"))
              .select("first", "last", "file").orderBy("first", "last", "file").collect()]
    asked = [wanted.mapInArrow(_assign(ranges[at:at + slice_rows]), "file string, key string, url string") for at in range(0, len(ranges), slice_rows)]
    described = directory.select("file", F.lit(False).alias("wanted"), F.col("first").alias("key"), "last", "offset", "length",
                                 F.lit(None).cast("string").alias("url"))
    rows = described
    for part in asked:
        rows = rows.unionByName(part.withColumn("wanted", F.lit(True)), allowMissingColumns=True)
    # An explicit number of parts: few small rows stand for many records here, so their size tells nothing about the work.
    dealt = rows.repartition(max(2, 2 * len(ranges)), "file").sortWithinPartitions("file", "wanted", "key", "offset")
    return dealt.mapInArrow(_search(archives, index, schema), ddl)


def lookup(spark: SparkSession, urls: DataFrame, directory: DataFrame, archives: str, index: str, url_col: str = "url",
           slice_rows: int = FILES) -> DataFrame:
    """The records captured for each URL in `urls`: url and the columns of RECORD, with the payload of responses.

    A NULL URL is the empty one, whose captures are those of pages without a URL; a URL that was never captured, an empty
    table or an empty index give no rows. Other columns are ignored, whatever their names. Payloads of any length are read whole."""
    wanted = urls.select(F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"), F.lit(None).cast("string").alias("key")).distinct()
    return _through_index(wanted, directory, archives, index, pa.schema([("url", pa.string()), *_RECORD, ("payload", pa.binary())]),
                          f"url string, {RECORD}, payload binary", slice_rows)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages written as archives and index, and looked up again by the URL key of each: one row (RECORD) per row of `pages`.

    NULL payloads and URLs are empty ones, and rows without an id are records too, see write_archives; an empty table gives an
    empty result; other columns are ignored, whatever their names. A page of any length is one record, written and read
    as a whole by the task that holds it."""
    spark = pages.sparkSession
    archives, index = scratch(spark, "warc"), scratch(spark, "cdx")
    captures = write_archives(pages, archives, id_col, url_col, payload_col, min_bytes)
    directory = write_index(captures, index)
    wanted = captures.select(F.lit(None).cast("string").alias("url"), "key").distinct()
    return _through_index(wanted, directory, archives, index, _RECORD, RECORD, FILES)
