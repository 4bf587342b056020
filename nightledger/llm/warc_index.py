"""WARC archives with a two-level capture index.

``write_archives`` writes a record per page, one gzip member each, so that a record can be read by its range. Pages whose
payloads are equal share one response; the others are revisits that name it.

``build_index`` sorts the captures by URL key (host reversed, then the path) and page id. Each range of keys
becomes an index file of blocks of ``BLOCK`` lines, compressed one by one, with a sparse directory at its end: first
key, offset and size of every block. ``lookup`` takes keys to the file of their range by binary search over the files'
first keys, to blocks by binary search over the directory, and reads and opens these blocks only. ``fetch`` reads the
records' ranges, in file order.

Records are read by as many tasks as their bytes ask for, not those of the references to them, and the index has a file per
``INDEX_LINES`` captures; both have at least one task per core. Pages have no time of capture, so all records of a run carry
the time at which it began as ``WARC-Date``.

Files are named by chance and count only once the table that lists them is committed, so a task that is lost or runs twice leaves
no trace in results. Folders are Spark paths that all executors share; files go through ``pyarrow.fs``.

Defined results: a null html is an empty payload; a null url has the empty key; rows that repeat are captures of their own
with equal lookups, and all rows with the largest page id of a payload are responses; a null page id is smaller than
any other; an empty table gives an empty index; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import NULL_ID, rows_of, shared_folder, written

BLOCK = 256
ARCHIVE_BYTES = 1 << 30
GAP = 64 << 10
TASK_BYTES = 64 << 20
INDEX_LINES = 1 << 19
CAPTURES = "url_key string, page_key long, archive string, start long, size long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)")


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then port and path: ``com,example)/path``."""
    if not url:
        return ""
    m = _HOST.match(url)
    if not m:
        return url.partition("#")[0].lower()
    host, port, path = m.groups()
    port = "" if port in (None, "80", "443") else f":{port}"
    return ",".join(reversed(host.lower().split("."))) + port + ")" + (path or "/")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _fields(pairs: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode()


def warc_date(when: datetime) -> str:
    return when.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, when: datetime | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member, dated ``when`` or now; a revisit has no block but tells size and digest of the payload."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", warc_date(when or datetime.now(UTC))),
        *([] if url is None else [("WARC-Target-URI", url if url.isprintable() else quote(url, safe="%/:?#&=+,;@"))]),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Payload-Length", len(payload)),
    ]
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
        head.append(("Content-Type", "application/http; msgtype=response"))
    else:
        block = b""
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{'' if refers_to == NULL_ID else refers_to}>"),
        ]
    head.append(("Content-Length", len(block)))
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + block + b"\r\n\r\n") + press.flush()


def parsed(member: bytes) -> tuple:
    """The columns of ``RECORD`` from a gzip member; the digest of a response is worked out from its payload."""
    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    page = fields["WARC-Record-ID"][10:-1]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["WARC-Payload-Length"])
    page_id, url = int(page) if page else None, fields.get("WARC-Target-URI")
    if fields["WARC-Type"] == "revisit":
        target = fields["WARC-Refers-To"][10:-1]
        return page_id, url, "revisit", size, stated, int(target) if target else None, None
    payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    if len(payload) != size or digest(payload) != stated:
        raise ValueError(f"record of page {page} is damaged")
    return page_id, url, "response", size, stated, None, payload


def with_responses(pages: DataFrame, least: int) -> DataFrame:
    """Pages with ``response``: the largest page id among equal payloads of at least ``least`` bytes, or null."""
    page_key = F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID))
    payload = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", page_key.alias("page_key"), "url", payload.alias("html")).withColumn("hashed", F.sha1(F.col("html").cast("binary")))
    base = base.withColumn("sized", F.octet_length("html") >= least)
    # partial aggregation makes one row per task of any payload; written, so that the join can split a frequent one
    copies = base.where("sized").groupBy("hashed").agg(F.max("page_key").alias("response"), F.min("page_key").alias("low"))
    copies = written(copies.where("low < response").select("hashed", "response"), "copies")
    response = F.when(F.col("sized") & (F.col("response") != F.col("page_key")), F.col("response"))
    return base.join(copies, "hashed", "left").select("page_id", "page_key", "url", "html", response.alias("response"))


def _tasks(df: DataFrame, amount: int, each: int) -> int:
    """Enough tasks for ``each`` of the amount to a task, and one per core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-amount // each))


def write_archives(pages: DataFrame, folder: str, *, least: int = 0, when: datetime | None = None) -> DataFrame:
    """Write the archives below ``folder`` and return the captures: key, archive, start and size of every record.

    Records are dated ``when``, or else the time of this call.
    """
    dated = when or datetime.now(UTC)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        out, name, at = None, "", 0
        for batch in rows_of(batches, "html"):
            rows = []
            for page, key, url, html, response in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page, url, html.encode(), response, dated)
                out.write(member)
                rows.append((url_key(url), key, name, at, len(member)))
                at += len(member)
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["url_key", "page_key", "archive", "start", "size"])
        if out is not None:
            out.close()

    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    return written(with_responses(pages, least).mapInArrow(write, CAPTURES), "captures")


@dataclass
class Index:
    """Index files below ``folder`` with the first (key, page) of each, in order: one entry per file."""

    folder: str
    files: list[str]
    firsts: list[tuple[str, int]]


def build_index(captures: DataFrame, folder: str) -> Index:
    """Sort the captures into index files; the driver gets the first key of each file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        out, name, held, directory, at = None, f"{uuid.uuid4().hex}.idx", [], [], 0

        def block() -> None:
            nonlocal at, held
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode(), 6)
            out.write(data)
            directory.append((*held[0][:2], at, len(data)))
            at, held = at + len(data), []

        for batch in batches:
            if out is None and batch.num_rows:
                out = files.open_output_stream(f"{root}/{name}", compression=None)
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                held.append(row)
                if len(held) == BLOCK:
                    block()
        if out is None:
            return
        if held:
            block()
        tail = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(tail + len(tail).to_bytes(8, "little"))
        out.close()
        yield pa.RecordBatch.from_pylist(
            [{"file": name, "url_key": directory[0][0], "page_key": directory[0][1]}],
            schema=pa.schema([("file", pa.string()), ("url_key", pa.string()), ("page_key", pa.int64())]),
        )

    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    ranged = captures.repartitionByRange(_tasks(captures, captures.count(), INDEX_LINES), "url_key", "page_key").sortWithinPartitions("url_key", "page_key", "archive", "start")
    made = written(ranged.mapInArrow(write, "file string, url_key string, page_key long"), "files").collect()
    made = sorted((r["url_key"].encode(), r["page_key"], r["file"]) for r in made)
    return Index(folder, [f for *_, f in made], [(k, p) for k, p, _ in made])


def _binary_order(key: str, page: int) -> tuple[bytes, int]:
    """Spark sorts strings by their bytes."""
    return key.encode(), page


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """Archive, start and size of all captures with the given ``url_key`` and ``page_key``."""
    shared = keys.sparkSession.sparkContext.broadcast(index)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = shared.value.firsts
        for batch in batches:
            wanted = [_binary_order(*x) for x in zip(batch.column("url_key").to_pylist(), batch.column("page_key").to_pylist(), strict=True)]
            # equal captures may go on from the file before the one that starts with them
            spans = [(max(bisect_left(firsts, w) - 1, 0), bisect_right(firsts, w)) for w in wanted]
            source = np.repeat(np.arange(len(wanted)), [max(b - a, 0) for a, b in spans])
            target = np.concatenate([np.arange(a, max(a, b)) for a, b in spans] or [np.zeros(0, int)])
            taken = batch.take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(target, pa.int32())], names=["url_key", "page_key", "file"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        files, root = _open(index.folder)
        opened, stream, directory, lines = -1, None, [], {}
        for batch in batches:
            rows = []
            for key, page, file in zip(*(batch.column(c).to_pylist() for c in ("url_key", "page_key", "file")), strict=True):
                if file != opened:
                    opened, stream, lines = file, files.open_input_file(f"{root}/{index.files[file]}"), {}
                    end = stream.size()
                    size = int.from_bytes(stream.read_at(8, end - 8), "little")
                    raw = json.loads(zlib.decompress(stream.read_at(size, end - 8 - size)))
                    directory = [(_binary_order(k, p), at, n) for k, p, at, n in raw]
                wanted = _binary_order(key, page)
                b = max(bisect_left(directory, wanted, key=lambda x: x[0]) - 1, 0)
                while b < len(directory) and directory[b][0] <= wanted:
                    if b not in lines:
                        if len(lines) > 16:
                            lines.clear()
                        text = zlib.decompress(stream.read_at(directory[b][2], directory[b][1])).decode()
                        lines[b] = [(_binary_order(k, p), *rest) for k, p, *rest in map(json.loads, text.split("\n"))]
                    block = lines[b]
                    i = bisect_left(block, wanted, key=lambda x: x[0])
                    while i < len(block) and block[i][0] == wanted:
                        rows.append((key, page, *block[i][1:]))
                        i += 1
                    if i < len(block):
                        break
                    b += 1
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["url_key", "page_key", "archive", "start", "size"]
            )

    wanted = keys.select("url_key", "page_key").mapInArrow(placed, "url_key string, page_key long, file int")
    wanted = wanted.repartitionByRange(_tasks(keys, len(index.files), 1), "file", "url_key", "page_key").sortWithinPartitions("file", "url_key", "page_key")
    return wanted.mapInArrow(searched, CAPTURES)


def fetch(captures: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records at the given places; neighbours in an archive are read at once.

    The places are written out first: their sum of bytes gives the number of tasks, which adaptive execution doesn't merge.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        opened, stream = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "size")), strict=True))
            done = 0
            while done < len(places):
                archive, start, size = places[done]
                last, end = done, start + size
                while last + 1 < len(places) and places[last + 1][0] == archive and places[last + 1][1] - end <= GAP and end - start < 4 << 20:
                    last += 1
                    end = max(end, places[last][1] + places[last][2])
                if archive != opened:
                    opened, stream = archive, files.open_input_file(f"{root}/{archive}")
                data = stream.read_at(end - start, start)
                rows = [parsed(data[a - start : a - start + n]) for _, a, n in places[done : last + 1]]
                columns = list(zip(*rows, strict=True))
                if not with_payload:
                    columns[-1] = (None,) * len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
                done = last + 1

    places = written(captures.select("archive", "start", "size"), "places")
    size = places.agg(F.sum("size")).first()[0] or 0
    ordered = places.repartitionByRange(_tasks(places, size, TASK_BYTES), "archive", "start").sortWithinPartitions("archive", "start")
    return ordered.mapInArrow(read, RECORD)


def archive_round_trip(pages: DataFrame, *, least: int = 0) -> DataFrame:
    """Write all pages, index them, and read every page's record back by its key."""
    folder = shared_folder(pages.sparkSession)
    captures = write_archives(pages, f"{folder}/archives", least=least)
    index = build_index(captures, f"{folder}/index")
    places = lookup(captures.select("url_key", "page_key").distinct(), index)
    return fetch(places, f"{folder}/archives", with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")




ORACLE = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h)) as n, sha1(h) as s, max(page_id) over (partition by h) as top from p)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(s, (i // 4) * 5 + 1, 5) as integer) >> (15 - 5 * (i % 4))) & 31)::int, 1)), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from q
"""
