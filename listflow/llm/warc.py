"""WARC archives as a Python data source of Spark.

Each record is one gzip member whose header names the member's compressed size (extra field ``sl``), so that a reader can
inflate the first bytes of a record, read its headers, and step over a payload that nobody wants. Every write ends with a
list of its files and of places between records, about every ``SPLIT`` bytes: a later read plans its partitions from
all lists and sees only what was committed; the list of an overwriting write names those that no longer count. Folders without
a list hold archives of others, compressed by record or plain, and are read a file per partition.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, In, InputPartition, WriterCommitMessage

from .shared import Scratch

SPLIT = 32 << 20
WINDOW = 1 << 20
LIST = "_records-"
SCHEMA = "record_type string, page_id long, refers_to long, target_uri string, payload_digest string, payload_bytes long, record_id string, refers_to_id string, payload binary"
_HEADERS = {"record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest"}
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def member(data: bytes) -> bytes:
    """A gzip member that names its own compressed size."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    extra = b"sl" + struct.pack("<HII", 8, 12 + 12 + len(body) + 8, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra))
    return head + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row, date: str) -> bytes:
    """A response with its payload, or a revisit with the figures of the payload that it leaves out."""
    payload = (row["html"] or "").encode()
    page = "none" if row["page_id"] is None else row["page_id"]
    block = b"" if row["record_type"] == "revisit" else _HTTP % len(payload) + payload
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}"]
    # a line break would end the header
    if uri := "".join(" " if c in "\r\n" else c for c in row["url"] or ""):
        lines.append(f"WARC-Target-URI: {uri}")
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if row["record_type"] == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{row['refers_to']}>"]
    else:
        lines.append("Content-Type: application/http; msgtype=response")
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _number(text: str | None) -> int | None:
    text = (text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class _Window:
    """The bytes of a file from some place on, read some at a time."""

    def __init__(self, file, at: int, end: int):
        self.file, self.at, self.end, self.data = file, at, end, b""

    def get(self, low: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``low`` behind the place."""
        if len(self.data) < low + size and self.at + len(self.data) < self.end:
            most = min(max(low + size, WINDOW), self.end - self.at) - len(self.data)
            self.data += self.file.read_at(most, self.at + len(self.data))
        return self.data[low : low + size]

    def step(self, size: int) -> None:
        """Go on, also beyond what was read."""
        self.data = self.data[size:]
        self.at += size


class _Plain:
    """The bytes of a record that is not compressed."""

    def __init__(self, window: _Window):
        self.window, self.given = window, 0

    def more(self) -> bytes:
        piece = self.window.get(self.given, 4096 if not self.given else WINDOW)
        self.given += len(piece)
        return piece

    def size(self, headers: dict[str, str], top: int) -> int:
        return top + int(headers.get("content-length", 0)) + 4


class _Zipped:
    """The bytes of a record that is a gzip member."""

    def __init__(self, window: _Window):
        self.window, self.given, self.inflate = window, 0, zlib.decompressobj(31)
        head = window.get(0, 20)
        self.known = struct.unpack_from("<I", head, 16)[0] if len(head) >= 20 and head[3] & 4 and head[12:14] == b"sl" else 0

    def more(self) -> bytes:
        while not self.inflate.eof:
            piece = self.inflate.unconsumed_tail
            if not piece:
                piece = self.window.get(self.given, 4096 if not self.given else WINDOW)
                if not piece:
                    raise ValueError(f"a record at byte {self.window.at} is cut short")
                self.given += len(piece)
            if out := self.inflate.decompress(piece, WINDOW if self.given > 4096 else 4096):
                return out
        return b""

    def size(self, headers: dict[str, str], top: int) -> int:
        while not self.known:
            if not self.more() and self.inflate.eof:
                self.known = self.given - len(self.inflate.unused_data)
        return self.known


def _upto(record, data: bytes, mark: bytes, low: int = 0) -> tuple[bytes, int]:
    """Bytes of a record until ``mark`` is among them, and its place; -1 if it never comes."""
    while (at := data.find(mark, low)) < 0:
        piece = record.more()
        if not piece:
            return data, -1
        low, data = max(low, len(data) - len(mark) + 1), data + piece
    return data, at


def records(file, start: int, end: int, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers, and the payload if asked for, of the records in [start, end). Unwanted payloads are stepped over.

    The payload of an HTTP message is what follows its headers, that of any other record its block. Where no header
    ``x-payload-length`` gives its size, that header is added from the block; not for a revisit, whose block tells nothing.
    """
    window = _Window(file, start, end)
    while window.at < end:
        head = window.get(0, 20)
        if not head.strip(b"\r\n"):
            window.step(len(head))  # blank lines between records, or behind the last one
            if not head:
                return
            continue
        if head[:2] in (b"\r\n", b"\n\n"):
            window.step(2)
            continue
        record = _Zipped(window) if head[:2] == b"\x1f\x8b" else _Plain(window)
        data, at = _upto(record, b"", b"\r\n\r\n")
        if at < 0 or not data.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {window.at}, or one that is cut short")
        headers, top = _headers(data[:at]), at + 4
        length = int(headers.get("content-length", 0))
        if wanted(headers):
            kind, body = headers.get("warc-type"), None
            http = headers.get("content-type", "").lower().startswith("application/http")
            known = _number(headers.get("x-payload-length"))
            keep = payloads and kind != "revisit"
            if keep:
                parts = [data]
                have = len(data)
                while have < top + length:
                    piece = record.more()
                    if not piece:
                        raise ValueError(f"a record at byte {window.at} is cut short")
                    parts.append(piece)
                    have += len(piece)
                block = b"".join(parts)[top : top + length]
                body = block.partition(b"\r\n\r\n")[2] if http else block
                known = len(body) if known is None else known
            elif known is None and kind != "revisit":
                known = length
                if http:
                    data, gap = _upto(record, data, b"\r\n\r\n", top)
                    known = max(0, top + length - gap - 4) if 0 <= gap else 0
            if known is not None:
                headers["x-payload-length"] = str(known)
            yield headers, body
        window.step(record.size(headers, top))


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    file: str
    cuts: list


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payloads = options.get("payloads", "true").lower() == "true"
        self.equal: dict[str, list] = {}

    def pushFilters(self, filters):
        """Equality with and membership of header columns is decided from the headers; the rest stays with Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            values = [f.value] if isinstance(f, EqualTo | EqualNullSafe) else list(f.value) if isinstance(f, In) else None
            if values is not None and (name in _HEADERS or name in ("page_id", "refers_to")) and None not in values and name not in self.equal:
                self.equal[name] = values
            else:
                yield f

    def partitions(self):
        files, base = _files(self.path)
        from pyarrow import fs

        lists = _lists(files, base)
        if lists:
            return [Part(f"{base}/{x['file']}", a, b) for own in lists.values() for x in own["files"] for a, b in zip(x["cuts"], x["cuts"][1:], strict=False)]
        found = files.get_file_info(fs.FileSelector(base))
        return [Part(x.path, 0, x.size) for x in found if x.type == fs.FileType.File and x.path.endswith((".warc.gz", ".warc"))]

    def _row(self, h: dict[str, str]) -> dict:
        return {
            "record_type": h.get("warc-type"),
            "page_id": _number(h.get("warc-record-id")),
            "refers_to": _number(h.get("warc-refers-to")),
            "target_uri": h.get("warc-target-uri"),
            # digests of other kinds keep their kind
            "payload_digest": (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        }

    def read(self, part):
        if part is None:  # Spark's stand-in where there is nothing to read
            return
        files, _ = _files(self.path)

        def wanted(h):
            row = self._row(h) if self.equal else {}
            return all(row[k] in v for k, v in self.equal.items())

        with files.open_input_file(part.path) as file:
            for h, body in records(file, part.start, part.end, wanted, self.payloads):
                row, size = self._row(h), _number(h.get("x-payload-length"))
                given = row["payload_digest"]
                # a payload is held against what its headers say of it, where they say it
                if body is not None and (size != len(body) or given and ":" not in given and digest(body) != given.upper()):
                    raise ValueError(f"the payload of {h.get('warc-record-id')} is not what its headers say")
                payload = body if row["record_type"] == "response" else None
                yield (*row.values(), size, h.get("warc-record-id"), h.get("warc-refers-to"), payload)


def _lists(files, base: str) -> dict[str, dict]:
    """The commits under a folder, without those that later ones replace."""
    from pyarrow import fs

    found = {}
    for x in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if x.type == fs.FileType.File and x.base_name.startswith(LIST):
            with files.open_input_stream(x.path) as f:
                found[x.base_name] = json.loads(f.read())
    gone = {name for own in found.values() for name in own["replaces"]}
    return {name: own for name, own in found.items() if name not in gone}


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.date, self.overwrite = options["path"], options.get("date", "2000-01-01T00:00:00Z"), overwrite

    def write(self, rows):
        files, base = _files(self.path)
        files.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        cuts, at = [0], 0
        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            for row in rows:
                at += out.write(member(record(row, self.date)))
                if at - cuts[-1] >= SPLIT:
                    cuts.append(at)
        return Written(name, cuts if cuts[-1] == at else [*cuts, at])

    def commit(self, messages):
        """One list for each write: the moment it is there the write is, and what it replaces is not."""
        files, base = _files(self.path)
        files.create_dir(base, recursive=True)
        old = _lists(files, base) if self.overwrite else {}
        with files.open_output_stream(f"{base}/{LIST}{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps({"replaces": list(old), "files": [{"file": m.file, "cuts": m.cuts} for m in messages if m]}).encode())

    def abort(self, messages):
        files, base = _files(self.path)
        for m in messages:
            if m:
                files.delete_file(f"{base}/{m.file}")


class WarcSource(DataSource):
    """``warc``: options ``path``, ``payloads`` (false: headers only) and, for writes, ``date``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def with_revisits(pages: DataFrame, kept: Scratch, min_bytes: int = 0) -> DataFrame:
    """Columns (page_id, url, html, record_type, refers_to): of equal payloads the one with the smallest id stays a response."""
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    key = F.when(F.octet_length("html") >= min_bytes, F.sha2("html", 256))
    named = named.withColumn("key", key)
    first = named.where("key is not null").groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n")
    joined = named.join(kept.keep(first, "first"), "key", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return joined.select("page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, kept: Scratch, min_bytes: int = 0, mode: str = "append") -> None:
    """A WARC record per row of ``pages`` (page_id, url, html), under a path that pyarrow's file systems reach.

    ``mode`` is append, which adds to what is there, or overwrite, after which only these records are read.

    Payload: the html in UTF-8, null being empty. Payloads equal in all bytes and of ``min_bytes`` at least: the smallest
    page_id is a response, the others are revisits of it; rows that repeat the smallest id are responses too. A null id is
    above all others and reads back as null; a null url has no header. An empty table gives no archives. Other columns
    are not written.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    with_revisits(pages, kept, min_bytes).write.format("warc").mode(mode).option("path", path).save()


def read_warc(spark, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives: (record_type, page_id, refers_to, target_uri, payload_digest, payload_bytes, record_id, refers_to_id, payload).

    ``page_id`` and ``refers_to`` are null where an id is not one of ``write_warc``; ``record_id`` and ``refers_to_id`` are the ids as
    they stand. Payloads are those of responses. Sizes and digests that a record gives are checked when its payload is read; a
    record without them is not wrong. Filters on record_type, page_id, refers_to, target_uri and payload_digest reach the reader."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)
