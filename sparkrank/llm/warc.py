"""WARC archives with a two-level capture index.

Each task writes its pages as WARC/1.1 records, each a gzip member of its own, to
archives of bounded size in the shared folder. Payloads that occur more than once are stored
once, by the page with the largest id; the others are revisit records that refer to it.

The index is sorted by reversed-host URL keys over all tasks. A shard holds one range of
keys: blocks of a few thousand compressed lines, and a sparse directory with the first
key and place of each block. Looking up a key takes a binary search over the first keys of the
shards, one over the directory of a shard, one read of a block, and a range read of the
record in its archive.

Files are written under names that hold the task attempt and are listed only when the
attempt succeeded, so lost executors leave at most unlisted files. They are reached through
Arrow's file systems by the URI of the shared folder.

Defined cases: null html is an empty payload; payloads below ``MIN_BYTES`` are always responses; of
repeated rows of the largest id all are responses; a null url has an empty key; a null page id
is never referred to, unless all pages of the payload have none: then all are responses; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.llm.common import new_folder, stored, strings, utf8

MIN_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 2000
GAP = 64 << 10  # records this close are read together
READ_BYTES = 4 << 20
DATE = "2025-01-01T00:00:00Z"  # the tables name no time of capture


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", path)
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def url_key(url: str, page_id: int | None) -> str:
    """Host reversed, then path and query; the page id makes captures of one URL distinct."""
    try:
        parts = urlsplit(url.strip())
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:  # not a URL
        return f"{re.sub(r'\s+', '%20', url.strip())} {_number(page_id)}"
    rest = parts.path + (f"?{parts.query}" if parts.query else "")
    return f"{host}{port}){re.sub(r'\s+', '%20', rest or '/')} {_number(page_id)}"


def _number(page_id: int | None) -> str:
    return "-" if page_id is None else f"{page_id + (1 << 63):020d}"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def warc_record(kind: str, url: str, page_id: int | None, digest: str, length: int, refers_to: int | None, payload: bytes) -> bytes:
    """One record; a revisit has the headers of the answer without its payload."""
    name = "none" if page_id is None else page_id
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    if kind == "response":
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'\s', '%20', url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if kind == "revisit":
        head[2:2] = [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


ENTRY = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
ENTRY_DDL = "key string, file string, offset long, length long"


def _write(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        context = TaskContext.get()
        number, out, name, at = 0, None, "", 0
        for batch in batches:
            entries = []
            pages = zip(*(batch.column(n).to_pylist() for n in ("page_id", "digest", "bytes", "refers_to")), strings(batch.column("url")), utf8(batch.column("html")), strict=True)
            for page_id, digest, length, refers_to, url, payload in pages:
                if out is None:
                    name, at = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.gz", 0
                    out, number = system.open_output_stream(f"{root}/{name}", compression=None), number + 1
                kind = "response" if refers_to is None else "revisit"
                data = member(warc_record(kind, url, page_id, digest, length, refers_to, payload))
                out.write(data)
                entries.append((url_key(url, page_id), name, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if entries:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries, strict=True), ENTRY, strict=True)], schema=ENTRY)
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write one record for each row of ``pages`` (page_id, url, html) below ``folder``; gives the entries of the index."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    raw = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    known = raw.select("page_id", "url", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    known = stored(known, "digests")
    # pages with a twin only, so that little is joined with the payloads
    last = known.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1 and last is not null")
    revisits = known.join(last, ["digest", "bytes"]).filter("page_id is null or page_id <> last")
    revisits = revisits.select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), F.col("last").alias("refers_to")).distinct()
    full = raw.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("long"))
    same = F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest"))
    marked = full.join(revisits, same, "left").withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")))
    rows = marked.select("page_id", "url", "digest", "bytes", "refers_to", "html")
    return stored(rows.mapInArrow(_write(folder), ENTRY_DDL), "entries")


SHARD = pa.schema([("first", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("length", pa.int64())])


def _write_shard(folder: str, block_lines: int):
    """Blocks, then the directory, in one file; gives its first key and the place of the directory."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        context = TaskContext.get()
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}.gz"
        out, at, lines, directory = None, 0, [], []

        def flush():
            nonlocal at
            data = member("".join(f"{line}\n" for _, line in lines).encode())
            directory.append(f"{lines[0][0]}\t{at}\t{len(data)}\n")
            out.write(data)
            at += len(data)
            lines.clear()

        for batch in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                lines.append((key, f"{key}\t{file}\t{offset}\t{length}"))
                if len(lines) == block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            data = member("".join(directory).encode())
            out.write(data)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((directory[0].split("\t")[0], name, at, len(data)), SHARD, strict=True)], schema=SHARD)

    return run


def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, str, int, int]]:
    """Write the sorted index; gives the shards: first key, file, place and length of the directory.

    There is one shard for each shuffle partition.
    """
    ordered = entries.select(*ENTRY.names).repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    rows = ordered.mapInArrow(_write_shard(folder, block_lines), "first string, file string, at long, length long").collect()
    return sorted(tuple(r) for r in rows)


class Index:
    """Reads the entries of keys; keeps the shard and block it read last."""

    def __init__(self, folder: str, shards: list[tuple[str, str, int, int]]):
        self.system, self.root = file_system(folder)
        self.shards, self.firsts = shards, [s[0] for s in shards]
        self.shard = self.block = None

    def _read(self, file: str, at: int, length: int) -> list[list[str]]:
        with self.system.open_input_file(f"{self.root}/{file}") as source:
            data = source.read_at(length, at)
        return [line.split("\t") for line in zlib.decompress(data, 31).decode().split("\n")[:-1]]

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """Archive, offset and length of every entry of ``key``."""
        # equal keys may begin in the shard or block before the first that starts with them
        for s in range(max(0, bisect.bisect_left(self.firsts, key) - 1), bisect.bisect_right(self.firsts, key)):
            if self.shard is None or self.shard[0] != s:
                _, file, at, length = self.shards[s]
                rows = self._read(file, at, length)
                self.shard = (s, file, [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows])
                self.block = None
            _, file, firsts, places = self.shard
            for b in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
                if self.block is None or self.block[0] != b:
                    lines = self._read(file, *places[b])
                    self.block = (b, [r[0] for r in lines], lines)
                _, keys, lines = self.block
                for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                    yield lines[i][1], int(lines[i][2]), int(lines[i][3])


def _look_up(folder: str, shards):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, shards.value)
        for batch in batches:
            found = [(key, *place) for key in batch.column(0).to_pylist() for place in index.find(key)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), ENTRY, strict=True)], schema=ENTRY)

    return run


def look_up(keys: DataFrame, folder: str, shards: list[tuple[str, str, int, int]]) -> DataFrame:
    """Entries of a column of distinct keys; sorted keys read each block once."""
    shared = keys.sparkSession.sparkContext.broadcast(shards)  # one line for each shard
    ordered = keys.toDF("key").repartitionByRange("key").sortWithinPartitions("key")
    return ordered.mapInArrow(_look_up(folder, shared), ENTRY_DDL)


CAPTURE = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)
CAPTURE_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
PAGE = re.compile(r"<urn:page:(-?\d+|none)>")


def _page(value: str | None) -> int | None:
    name = PAGE.fullmatch(value)[1] if value else "none"
    return None if name == "none" else int(name)


def _capture(data: bytes) -> tuple:
    warc, http, payload = read_record(zlib.decompress(data, 31))
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = warc["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"damaged record {warc['WARC-Record-ID']}")
    return _page(warc["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, _page(warc.get("WARC-Refers-To")), warc["WARC-Target-URI"], payload if kind == "response" else None


def _fetch(folder: str):
    """Range reads of sorted entries; neighbours in an archive are read together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        name, source = None, None

        def read(run_of):
            start, end = run_of[0][0], run_of[-1][0] + run_of[-1][1]
            data = source.read_at(end - start, start)
            return [_capture(data[at - start : at - start + n]) for at, n in run_of]

        for batch in batches:
            rows, near = [], []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if near and (file != name or at > near[-1][0] + near[-1][1] + GAP or at + n - near[0][0] > READ_BYTES):
                    rows += read(near)
                    near = []
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{root}/{file}")
                if len(rows) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CAPTURE, strict=True)], schema=CAPTURE)
                    rows = []
                near.append((at, n))
            if near:
                rows += read(near)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CAPTURE, strict=True)], schema=CAPTURE)

    return run


def fetch(entries: DataFrame, folder: str) -> DataFrame:
    """The captures of entries of the index, with their payloads."""
    ordered = entries.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_fetch(folder), CAPTURE_DDL)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to archives, index them, look every capture up and read it back."""
    folder = new_folder(spark, "warc")
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    entries = write_archives(pages, folder)
    shards = write_index(entries, folder)
    return fetch(look_up(_keys(pages), folder, shards), folder)


def _key_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [url_key(u, p) for u, p in zip(strings(batch.column(1)), batch.column(0).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])


def _keys(pages: DataFrame) -> DataFrame:
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return known.mapInArrow(_key_batches, "key string").distinct()
