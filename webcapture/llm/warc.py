"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. The index sorts captures by reversed-host URL key into compressed
blocks; each index file ends in a sparse directory of its blocks' first keys, and the files' key ranges are the
level above. A look-up searches the ranges, then the directory by halving, then reads only the blocks and the
records it needs. All files are written to unique names in the shared folder and become visible through the
rows that name them, so a task that runs again leaves no half-written archive in the index.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import saved
from webcapture.shared import new_path

#: Payloads below this size are always stored.
LEAST_REVISIT = 100
#: Bytes after which an archive is closed, lines of an index block, and bytes of archive that one task reads.
ARCHIVE_BYTES, BLOCK_LINES, READ_BYTES = 1 << 30, 1000, 256 << 20
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: Column) -> Column:
    """``com,example,blog:8080)/path?query``: host parts reversed and lower-cased; null becomes the empty key."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]+)?([^#]*)"
    host = F.lower(F.regexp_extract(url, parts, 1))
    port = F.regexp_replace(F.regexp_extract(url, parts, 2), "^:(80|443)$", "")
    path = F.regexp_extract(url, parts, 3)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), F.when(path == "", "/").otherwise(path))
    return F.coalesce(F.when(host != "", key).otherwise(url), F.lit(""))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else re.sub("^file:/+", "/", path))


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head of the full payload and no payload."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Page-ID": None if page is None else str(page),
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "WARC-Refers-To-Page-ID": str(refers_to) if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record and of the HTTP message in it, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


_CAPTURE = pa.schema([("key", pa.string()), ("page", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _written(folder: str, date: str) -> Callable:
    def write(batches):
        out, at, path = None, 0, ""
        where, root = _open(folder)
        where.create_dir(root, recursive=True)
        try:
            for batch in batches:
                rows = []
                for page, url, key, payload, digest, size, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, at, path = where.open_output_stream(f"{root}/{name}", compression=None), 0, f"{folder}/{name}"
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    raw = gz.compress(record_bytes(page, url, payload or b"", digest, size, refers, date)) + gz.flush()
                    out.write(raw)
                    rows.append((key, page, path, at, len(raw)))
                    at += len(raw)
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CAPTURE.types, strict=True)], schema=_CAPTURE)
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``key, page, archive, offset, length`` of a record per row, written to archives in the shared folder.

    The payload is the text in UTF-8, null empty. Of rows with equal payloads of at least ``LEAST_REVISIT``
    bytes those with the smallest id are responses and the others revisit it; a null id is never the smallest
    unless all are null, and then all are responses. Repeated rows are repeated records. A null URL has no
    target header and the empty key. Other columns are ignored; an empty table writes nothing.
    """
    folder = new_path(pages.sparkSession, "archives")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    records = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), url_key(F.col(url_col)).alias("key"), payload.alias("payload"))
    records = records.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    first = records.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    records = records.join(first, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    records = records.withColumn("refers", refers).withColumn("payload", F.when(F.col("refers").isNull(), F.col("payload")))
    return saved(records.select("page", "url", "key", "payload", "digest", "size", "refers").mapInArrow(_written(folder, date), "key string, page long, archive string, offset long, length long"), "captures")


def _blocks(folder: str, lines: int) -> Callable:
    schema = pa.schema([("file", pa.string()), ("first", pa.string()), ("last", pa.string())])

    def write(batches):
        out, at, path, first, last, directory = None, 0, "", None, None, []
        block: list[str] = []
        where, root = _open(folder)

        def put():
            nonlocal at
            raw = zlib.compress("\n".join(block).encode())
            out.write(raw)
            directory.append((json.loads(block[0])[0], at, len(raw)))
            at += len(raw)
            block.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    where.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.idx"
                    out, path, first = where.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", row[0]
                last = row[0]
                block.append(json.dumps(row))
                if len(block) == lines:
                    put()
        if out is not None:
            if block:
                put()
            tail = zlib.compress(json.dumps(directory).encode())
            out.write(tail + len(tail).to_bytes(8, "big"))
            out.close()
            yield pa.record_batch([pa.array([x]) for x in (path, first, last)], schema=schema)

    return write


def build_index(captures: DataFrame, files: int | None = None, lines: int = BLOCK_LINES) -> DataFrame:
    """``file, first, last``: index files and their key ranges, over captures sorted by key and place.

    There are at most ``files`` (by default the number of shuffle partitions), whatever the number of captures.
    A key shared by many captures may run over several blocks and files.
    """
    spark = captures.sparkSession
    folder = new_path(spark, "index")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "archive", "offset"]
    ordered = captures.select(*_CAPTURE.names).repartitionByRange(files, *order).sortWithinPartitions(*order)
    return saved(ordered.mapInArrow(_blocks(folder, lines), "file string, first string, last string"), "index_files")


def _found(batches):
    """Captures of the wanted keys of each index file: directory by halving, then its blocks."""
    name, source, directory, firsts, held = None, None, [], [], (-1, [])

    def block(k: int) -> list:
        nonlocal held
        if held[0] != k:
            _, at, length = directory[k]
            source.seek(at)
            held = (k, [json.loads(line) for line in zlib.decompress(source.read(length)).decode().split("\n")])
        return held[1]

    for batch in batches:
        rows: list = []
        for file, key in zip(batch.column("file").to_pylist(), batch.column("key").to_pylist(), strict=True):
            if file != name:
                where, path = _open(file)
                name, source, held = file, where.open_input_file(path), (-1, [])
                size = source.size()
                source.seek(size - 8)
                tail = int.from_bytes(source.read(8), "big")
                source.seek(size - 8 - tail)
                directory = json.loads(zlib.decompress(source.read(tail)))
                firsts = [entry[0] for entry in directory]
            for k in range(max(bisect.bisect_left(firsts, key) - 1, 0), len(firsts)):
                if firsts[k] > key:
                    break
                lines = block(k)
                rows += lines[bisect.bisect_left(lines, key, key=lambda line: line[0]) : bisect.bisect_right(lines, key, key=lambda line: line[0])]
                # Within the key: one key may have any number of captures.
                if len(rows) > 5000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CAPTURE.types, strict=True)], schema=_CAPTURE)
                    rows = []
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CAPTURE.types, strict=True)], schema=_CAPTURE)


def _routed(shared) -> Callable:
    def route(batches):
        files, firsts, lasts = shared.value
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for key in batch.column("key").to_pylist():
                for k in range(bisect.bisect_left(lasts, key), len(files)):
                    if firsts[k] > key:
                        break
                    out[0].append(files[k])
                    out[1].append(key)
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string())], names=["file", "key"])

    return route


def look_up(index: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """``key, page, archive, offset, length`` of every capture whose key is among ``keys``.

    A key that is asked for twice is answered once; null and unknown keys find nothing.
    """
    spark = index.sparkSession
    ranges = sorted((r["first"].encode(), r["last"].encode(), r["file"]) for r in index.collect())
    shared = spark.sparkContext.broadcast(([r[2] for r in ranges], [r[0].decode() for r in ranges], [r[1].decode() for r in ranges]))
    wanted = keys.select(F.col(key_col).alias("key")).filter("key is not null").distinct().mapInArrow(_routed(shared), "file string, key string")
    wanted = wanted.repartition("file", F.pmod(F.xxhash64("key"), F.lit(4))).sortWithinPartitions("file", "key")
    return wanted.mapInArrow(_found, "key string, page long, archive string, offset long, length long")


_RECORD = pa.schema([("page", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _records(with_payload: bool) -> Callable:
    def row(raw: bytes) -> tuple:
        headers, http, payload = parse_record(zlib.decompress(raw, 31))
        response = headers["WARC-Type"] == "response"
        digest = hashlib.sha256(payload).hexdigest() if response else headers["WARC-Payload-Digest"].removeprefix("sha256:")
        size = len(payload) if response else int(http["Content-Length"])
        page, refers = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
        kept = payload if response and with_payload else None
        return None if page is None else int(page), headers.get("WARC-Target-URI"), headers["WARC-Type"], digest, size, None if refers is None else int(refers), kept

    def read(batches) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            rows, size = [], 0
            for archive, at, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    where, path = _open(archive)
                    name, source = archive, where.open_input_file(path)
                source.seek(at)
                rows.append(row(source.read(length)))
                size += len(rows[-1][6] or b"")
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)

    return read


def read_records(captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """``page, url, record_type, digest, size, refers_to, payload`` of captures, by range reads of the archives.

    Digest and size of a response are those of the payload as read; a revisit carries them in its headers, and
    its payload is null.
    """
    near = captures.repartition("archive", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("archive", "offset")
    schema = "page long, url string, record_type string, digest string, size long, refers_to long, payload binary"
    return near.mapInArrow(_records(with_payload), schema)
