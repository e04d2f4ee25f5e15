"""WARC archives of pages with a two-level capture index.

Every page becomes one gzip member of a WARC file: a ``response`` with its
payload, or a ``revisit`` that refers to the record with the same payload and
the smallest page id.  The captures, keyed by the reversed host and path of
their URL, are sorted and packed into compressed blocks; an index file ends with
a sparse directory that names the first and last capture of each of its blocks,
and one row per index file says which captures it spans.  A lookup searches the
files, then a file's directory, then one block by bisection, and reads the
record with one ranged read.

Files are written through ``pyarrow.fs`` under names of their own for each task
attempt, and only the names that Spark's committed index rows hold are ever
read: what a lost or repeated task leaves behind is never seen.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions_for, pieces_of, shared_folder, written

DATE = "2024-01-01T00:00:00Z"
BLOCK_ENTRIES = 1024
FILE_BYTES = 1 << 30
ENTRIES_PER_INDEX_FILE = 4_000_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_RECORD = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- columns ------------------------------------------------------------------


def host_key(url: Column) -> Column:
    """Sort key of a URL: its host's labels reversed, then the rest, as ``org,example,www)/a?b``; null is empty."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), F.lit(""))


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1."""
    digits = F.sha1(payload)
    out = []
    for i in range(8):  # five hex digits are four base-32 digits
        five = F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(_BASE32), F.shiftright(five, 15 - 5 * j).bitwiseAND(31) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*out)


# -- writing ------------------------------------------------------------------


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_RECORD}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_RECORD}{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    member = zlib.compressobj(3, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


_CAPTURE = "key string, page_id long, file string, offset long, length long"


def _write_records(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the WARC files, a few per task; one index row per record."""

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for whole in batches:
            for batch in pieces_of(whole):
                cols = [batch.column(c).to_pylist() for c in ("key", "page_id", "url", "payload", "digest", "refers_to")]
                rows = []
                for key, page_id, *rest in zip(*cols, strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = _gzip(_record(page_id, *rest))
                    out.write(member)
                    rows.append((key, page_id, name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("key", "page_id", "file", "offset", "length"), r, strict=True)) for r in rows], schema=schema
                )
        if out is not None:
            out.close()

    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    return captures.mapInArrow(run, _CAPTURE)


def _order(key: str, page_id: int | None) -> list:
    """How captures sort: by the key's bytes, then by page id, rows without one first."""
    return [key, -1 if page_id is None else 0, page_id or 0]


def _place(x: list) -> tuple[bytes, int, int]:
    return x[0].encode(), x[1], x[2]


def _write_blocks(captures: DataFrame, folder: str, block_entries: int) -> DataFrame:
    """Packs each sorted partition into an index file; one row per file."""

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        out, name, at, held, directory = None, f"{uuid.uuid4().hex}.idx", 0, [], []

        def close_block():
            nonlocal at, held
            data = zlib.compress("\n".join(json.dumps(e) for e in held).encode())
            out.write(data)
            directory.append([held[0][:3], held[-1][:3], at, len(data)])
            at, held = at + len(data), []

        for batch in batches:
            for r in batch.to_pylist():
                out = out or store.open_output_stream(f"{root}/{name}", compression=None)
                held.append([*_order(r["key"], r["page_id"]), r["file"], r["offset"], r["length"]])
                if len(held) >= block_entries:
                    close_block()
        if out is not None:
            if held:
                close_block()
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data)
            out.close()
            row = {"first": json.dumps(directory[0][0]), "last": json.dumps(directory[-1][1]), "file": name, "offset": at, "length": len(data)}
            yield pa.RecordBatch.from_pylist([row])

    return captures.mapInArrow(run, "first string, last string, file string, offset long, length long")


@dataclass(frozen=True)
class Archive:
    """Folder with the WARC and index files, and the table with one row per index file."""

    folder: str
    files: DataFrame


def write_archive(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, block_entries: int = BLOCK_ENTRIES) -> Archive:
    """Archive of ``pages`` (page_id, url, html; further columns are not read).

    A null html is an empty payload, a null url has no target URI and an empty
    key.  Of records with equal payloads of at least ``min_revisit_bytes`` the
    rows with the smallest page id are responses and the others revisit it;
    rows without a page id come after all ids (and are responses if no row of
    their group has one).  An empty table makes an archive without files.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b"").cast("binary"))
    captures = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    captures = captures.withColumns({"digest": payload_digest(F.col("payload")), "key": host_key(F.col("url"))})
    narrow = captures.filter(F.length("payload") >= min_revisit_bytes).select("page_id", "digest").distinct()
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    first = written(first, "first")  # so that a hot digest can be split over tasks in the join
    # Only the rows that revisit, keyed by page as well as digest: a payload that a third of the pages share is no hot key.
    revisits = narrow.join(first, "digest").filter("refers_to is not null and not (page_id <=> refers_to)")
    revisits = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    same = captures.page_id.eqNullSafe(revisits._page) & (captures.digest == revisits._digest)
    records = captures.join(revisits.hint("shuffle_merge"), same, "left")
    index = written(_write_records(records.select("key", "page_id", "url", "payload", "digest", "refers_to"), folder), "captures")
    parts = partitions_for(index.count(), ENTRIES_PER_INDEX_FILE, least=4)
    ordered = index.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    return Archive(folder, written(_write_blocks(ordered, folder, block_entries), "directory"))


# -- reading ------------------------------------------------------------------


class _Recent(OrderedDict):
    """The last few values made by ``make(key)``."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self[key] = self.make(key)
        if len(self) > self.most:
            self.popitem(last=False)
        return value


class Index:
    """Bisection over index files, their directories and blocks; ``files`` are the rows of the directory table."""

    def __init__(self, folder: str, files: list):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        files = sorted(files, key=lambda f: _place(json.loads(f[0])))
        self.files = [(_place(json.loads(a)), _place(json.loads(b)), (name, at, n)) for a, b, name, at, n in files]
        self.open = _Recent(lambda name: self.store.open_input_file(f"{self.root}/{name}"), 16)
        self.directories = _Recent(self._directory, 4)
        self.blocks = _Recent(self._block, 8)

    def read(self, name: str, at: int, n: int) -> bytes:
        return self.open[name].read_at(n, at)

    def _directory(self, place):
        name, at, n = place
        return [(_place(a), _place(b), (name, o, m)) for a, b, o, m in json.loads(zlib.decompress(self.read(name, at, n)))]

    def _block(self, place):
        entries = [json.loads(x) for x in zlib.decompress(self.read(*place)).split(b"\n")]
        return [_place(e) for e in entries], [e[3:] for e in entries]

    @staticmethod
    def _spanning(spans: list, low: tuple, high: tuple) -> list:
        """The places of the spans (sorted, not overlapping) that meet [low, high]."""
        end = bisect_right(spans, high, key=lambda s: s[0])
        start = bisect_left(spans, low, hi=end, key=lambda s: s[1])
        return [place for _, _, place in spans[start:end]]

    def find(self, low: tuple, high: tuple):
        """(file, offset, length) of the captures in [low, high]."""
        for file in self._spanning(self.files, low, high):
            for block in self._spanning(self.directories[file], low, high):
                order, places = self.blocks[block]
                yield from places[bisect_left(order, low) : bisect_right(order, high)]


def parse_record(member: bytes) -> dict:
    """Headers and payload of one gzip member; a response whose payload does not match its digest is an error."""
    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise OSError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        text = fields.get(name, "").strip("<>").removeprefix(_RECORD)
        return int(text) if text else None

    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if response else None,
    }


_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def lookup(archive: Archive, wanted: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the captures ``wanted`` (``url`` and, optionally, ``page_id``), one row per record.

    Without a page_id column every capture of the URL is read.  The wanted rows
    are dealt out in key order, so that a task meets few blocks.  The table of
    index files (one row per four million captures) goes to every task.
    """
    spark = wanted.sparkSession
    files = [tuple(r) for r in archive.files.select("first", "last", "file", "offset", "length").collect()]
    folder, by_page = archive.folder, "page_id" in wanted.columns
    page = F.col("page_id").cast("long") if by_page else F.lit(None).cast("long")
    keys = wanted.select(host_key(F.col("url")).alias("key"), page.alias("page_id")).distinct()
    shared = spark.sparkContext.broadcast(files)
    fields = _FIELDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])

    def run(batches):
        index = Index(folder, shared.value)
        for whole in batches:
            for batch in pieces_of(whole):
                out = []
                for key, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                    low = _place(_order(key, page_id)) if by_page else (key.encode(), -1, 0)
                    high = low if by_page else (key.encode(), 1, 0)
                    for place in index.find(low, high):
                        record = parse_record(index.read(*place))
                        out.append({n: record[n] for n in names})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(run, fields)


def oracle_sql() -> str:
    """The records' digest columns over ``pages``, in DuckDB SQL."""
    four = " || ".join(
        f"substr('{_BASE32}', 1 + ((('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT >> {15 - 5 * j}) & 31)::INT, 1)" for i in range(8) for j in range(4)
    )
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, payload_bytes, {four} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` and reads every capture back through its index."""
    return lookup(write_archive(pages), pages.select("url", "page_id"))
