"""WARC archives with a two-level capture index.

Writing
    Every page is one WARC/1.1 record in a gzip member of its own; pages whose
    payload equals an earlier page's become ``revisit`` records.
Index
    Captures sort by reversed-host URL key (``org,example,www)/path``) over
    range partitions; each partition writes an index file of compressed blocks
    of ``BLOCK_LINES`` lines, followed by its sparse directory (first key,
    offset and length of each block).  The first key of each index file is the
    upper level.
Reading
    A key is searched among the files' first keys, then by bisection in a
    file's directory, then in the block fetched by a range read; the captures'
    records are range reads as well.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import new_folder, parallelism, written

BLOCK_LINES = 1024
FILE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Reversed-host key of a URL; '' for NULL.  White space and control
    characters are percent-encoded, the scheme is dropped, A-Z of the host
    lower-cased."""
    if url is None:
        return ""
    _, found, rest = url.partition("://")
    rest = rest if found else url
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host):]
    labels = ",".join(reversed(re.sub("[A-Z]", lambda m: m[0].lower(), host).split(".")))
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", f"{labels}){tail}")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    name = uuid.UUID(bytes=hashlib.sha256(f"{page_id}/{url}/{digest}/{refers_to}".encode()).digest()[:16])
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', url)}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def parse(member: bytes) -> dict:
    """Fields of a record written by :func:`record`; the payload is checked
    against its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload": payload if kind == "response" else None,
            "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To-Page")}


def _write_batches(folder: str):
    """(page_id, url, html, sha1, refers_to) rows to archives; capture lines out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = pafs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                captures = []
                for page_id, url, html, sha1, refers_to in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        # each attempt has its own name; only a finished task's lines name its files
                        name, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = target.open_output_stream(name, compression=None)
                    member = record(page_id, url, (html or "").encode(), base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to)
                    out.write(member)
                    captures.append((url_key(url), name, at, len(member)))
                    at += len(member)
                if captures:
                    yield pa.record_batch([pa.array(x) for x in zip(*captures, strict=True)], names=["key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


def _index_batches(folder: str):
    """Sorted capture lines to one index file per partition: compressed blocks,
    the directory, its offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = pafs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        name, out, at, block, directory, first, last, lines = "", None, 0, [], [], None, "", 0

        def flush() -> None:
            nonlocal at, block
            data = zlib.compress("\n".join(block).encode(), 6)
            directory.append(f"{block[0].partition(chr(9))[0]}\t{at}\t{len(data)}")
            out.write(data)
            at, block = at + len(data), []

        for batch in batches:
            for key, file, offset, length in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if out is None:
                    name = f"{root}/{uuid.uuid4().hex}.idx"
                    out, first = target.open_output_stream(name, compression=None), key
                block.append(f"{key}\t{file}\t{offset}\t{length}")
                last, lines = key, lines + 1
                if len(block) == BLOCK_LINES:
                    flush()
        if out is not None:
            if block:
                flush()
            data = zlib.compress("\n".join(directory).encode(), 6)
            out.write(data + struct.pack("<QQ", at, len(data)))
            out.close()
            yield pa.record_batch([pa.array([x]) for x in (first, last, name, lines, len(directory))], names=["first_key", "last_key", "file", "captures", "blocks"])
    return run


@dataclass
class Archive:
    """``captures`` (key, file, offset, length) and ``index``, one row per
    index file (first_key, last_key, file, captures, blocks)."""

    folder: str
    captures: DataFrame
    index: DataFrame


def write_archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> Archive:
    """Write every page as a WARC record and index the captures.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with
    the smallest id is the response and the others revisit it.
    * A NULL html is the empty payload; a NULL url has the key ''.
    * A NULL id revisits the smallest id of its payload; without any id among
      them all are responses, as are repeated rows of the smallest id.
    * Extra columns are ignored; an empty table writes no record.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("html").cast("binary")), "bytes": F.octet_length("html")})
    shared = rows.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.where("n > 1 and first_id is not null").drop("n"), "shared-payloads")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = rows.join(shared, ["sha1", "bytes"], "left").select("page_id", "url", "html", "sha1", refers_to.alias("refers_to"))
    captures = written(rows.mapInArrow(_write_batches(f"{folder}/archives"), "key string, file string, offset long, length long"), "captures")
    order = ["key", "file", "offset"]
    lines = captures.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)
    index = written(lines.mapInArrow(_index_batches(f"{folder}/index"), "first_key string, last_key string, file string, captures long, blocks long"), "index")
    return Archive(folder, captures, index)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], names=["key"])


def _file_batches(bounds: list[tuple[bytes, bytes]]):
    """Upper level: the index files whose key range holds a key."""
    firsts = [a for a, _ in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                k = bisect.bisect_right(firsts, key.encode()) - 1
                while k >= 0 and bounds[k][1] >= key.encode():  # a frequent key reaches over several files
                    found.append((key, k))
                    k -= 1
            yield pa.record_batch([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["key", "number"])
    return run


def _block_batches(folder: str, files: list[str]):
    """Second level: the blocks of an index file that can hold a key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pafs.FileSystem.from_uri(folder)
        opened, firsts, places = None, [], []
        for batch in batches:
            found = []
            for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != opened:
                    with source.open_input_file(files[number]) as f:
                        end = f.size()
                        at, length = struct.unpack("<QQ", f.read_at(16, end - 16))
                        entries = [x.split("\t") for x in zlib.decompress(f.read_at(length, at)).decode().split("\n")]
                    opened, firsts = number, [e[0].encode() for e in entries]
                    places = [(int(e[1]), int(e[2])) for e in entries]
                # from the last block that begins before the key to the last that begins with it
                lo = max(0, bisect.bisect_left(firsts, key.encode()) - 1)
                for at, length in places[lo:bisect.bisect_right(firsts, key.encode())]:
                    found.append((key, number, at, length))
            yield pa.record_batch([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                  names=["key", "number", "offset", "length"])
    return run


def _record_batches(folder: str, files: list[str]):
    """Blocks and keys, sorted by block, to the records of their captures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pafs.FileSystem.from_uri(folder)
        opened, keys, places = None, [], []
        archives: dict[str, pa.NativeFile] = {}
        for batch in batches:
            rows = []
            for key, number, at, length in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (number, at) != opened:
                    with source.open_input_file(files[number]) as f:
                        lines = [x.split("\t") for x in zlib.decompress(f.read_at(length, at)).decode().split("\n")]
                    opened, keys, places = (number, at), [x[0].encode() for x in lines], [(x[1], int(x[2]), int(x[3])) for x in lines]
                for file, offset, size in places[bisect.bisect_left(keys, key.encode()):bisect.bisect_right(keys, key.encode())]:
                    if file not in archives:
                        if len(archives) >= 64:
                            archives.pop(next(iter(archives))).close()
                        archives[file] = source.open_input_file(file)
                    rows.append(parse(archives[file].read_at(size, offset)))
                    if len(rows) >= 256:
                        yield _records(rows)
                        rows = []
            if rows:
                yield _records(rows)
        for f in archives.values():
            f.close()
    return run


def _records(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    return pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], names=list(kinds))


def read_captures(archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of all captures whose key is that of one of ``urls``:
    ``page_id``, ``url``, ``payload`` (NULL for revisits), ``payload_bytes``,
    ``payload_digest``, ``record_type`` and ``refers_to``.

    Repeated urls and urls with the same key count once; urls without a capture
    find nothing.  The upper level holds one entry per index file, as many as
    a shuffle has partitions.
    """
    n = parallelism(urls.sparkSession)
    files = archive.index.orderBy("first_key", "last_key", "file").collect()
    bounds = [(r["first_key"].encode(), r["last_key"].encode()) for r in files]
    names = [r["file"] for r in files]
    folder = f"{archive.folder}/index"
    keys = urls.select(F.col(url_col).cast("string")).mapInArrow(_key_batches, "key string").distinct()
    where = keys.mapInArrow(_file_batches(bounds), "key string, number long")
    blocks = (where.repartition(n, "number").sortWithinPartitions("number", "key")
              .mapInArrow(_block_batches(folder, names), "key string, number long, offset long, length long"))
    return (blocks.repartition(n, "number", "offset").sortWithinPartitions("number", "offset", "key")
            .mapInArrow(_record_batches(folder, names), _RECORD))
