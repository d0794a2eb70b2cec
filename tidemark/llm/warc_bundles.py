"""WARC archives as seekable Zstandard bundles: independent frames, a footer seek table and a record map.

A bundle (``*.warc.zst``) is a sequence of Zstandard frames, each holding whole
WARC/1.1 records (about ``FRAME_BYTES`` before compression, a longer record
alone), followed by two skippable frames:

* the record map: for each record its 16-byte UUID, frame, offset and length
  inside the frame;
* the seek table of the public seekable format: compressed and decompressed
  size of every frame before it, their number, and the closing magic number.

Any Zstandard reader decompresses a bundle to a plain WARC file; a reader of
the footer gets one record by decompressing one frame.

Records are ``response`` (HTTP head and payload) or ``revisit`` (HTTP head
only): of records with equal payloads of at least ``MIN_REVISIT`` bytes the one
with the smallest id is the response and the others refer to it.  The payload
digest is the bare lower-case hex SHA-256 of the full payload.

Scale.  The rows are written once with their digest and a row number.  Digests
collapse in an aggregation before its shuffle (a payload held by a third of
all rows is one entry a task); only digests that occur twice come back, as a
broadcast up to ``BROADCAST_ROWS`` counted rows, beyond it by a shuffled join
that adaptive execution splits at a hot digest.  Writing is map-only: a task
holds one frame and rolls over to a new bundle at ``BUNDLE_BYTES``.  Bundles
carry a name of their own for each attempt, and only those in the committed
index (Parquet, one row a record) are read: a lost executor or a second
attempt leaves files that nothing refers to.  Reading spreads frames, not
files, over the tasks.

The folder has to be shared by driver and executors (by default it lies under
``spark.checkpoint.dir``) and to be reachable by ``pyarrow.fs`` (a plain path,
``file:``, ``hdfs:``, ``s3:`` or ``gs:``).

Defined cases: a null payload is empty, a null id or url leaves its header out
and comes back null (a null id counts as largest); rows that agree in id and
payload still get one response; empty tables make no bundles and give no rows;
further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import checkpoint_dir
from ._stage import small_batches, stage

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
MIN_REVISIT = 100
BROADCAST_ROWS = 200_000
DATE = "2000-01-01T00:00:00Z"

#: Fixed values of the public formats.
SKIPPABLE_MAP, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY, _FOOTER, _HEAD, _PLACE = struct.Struct("<II"), struct.Struct("<IBI"), struct.Struct("<II"), struct.Struct("<16sIII")

INDEX = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("page_id", T.StringType()), T.StructField("record_type", T.StringType()),
                      T.StructField("file", T.StringType()), T.StructField("frame", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
RECORD = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("page_id", T.StringType()),
                       T.StructField("url", T.StringType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
                       T.StructField("refers_to_record", T.StringType()), T.StructField("refers_to", T.StringType()), T.StructField("payload", T.BinaryType())])


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def record_id(page_id, digest: str, row: int) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}|{digest}|{row}"))


def encode_record(kind: str, ident: str, page_id, url: str | None, digest: str, payload: bytes, refers: str | None = None, refers_page=None, date: str = DATE) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, whose Content-Length is that of the full payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{ident}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_SAFE)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if page_id is not None:
        head.append(f"X-Page-Id: {quote(str(page_id), safe=_SAFE)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:uuid:{refers}>"]
        if refers_page is not None:
            head.append(f"X-Refers-To-Page-Id: {quote(str(refers_page), safe=_SAFE)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: printable ASCII but the percent sign; all else is percent-encoded and comes back as it was
_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")
_UUID = re.compile(r"<urn:uuid:([0-9a-f-]{36})>")


def decode_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """Fields of the record at ``at`` and the place after it; ValueError if it is damaged."""
    split = data.find(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n") if split >= 0 else [""]
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    begin, end = split + 4, split + 4 + int(head["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut")
    body = data.index(b"\r\n\r\n", begin, end) + 4
    http = dict(line.split(": ", 1) for line in data[begin : body - 4].decode().split("\r\n")[1:])
    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
    text = lambda name: unquote(head[name]) if name in head else None
    ident = lambda name: _UUID.fullmatch(head[name])[1] if name in head else None
    payload = None
    if head["WARC-Type"] == "response":
        payload = data[body:end]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload at {at} is not what its headers say")
    return {"record_id": ident("WARC-Record-ID"), "record_type": head["WARC-Type"], "page_id": text("X-Page-Id"), "url": text("WARC-Target-URI"), "payload_digest": digest,
            "payload_bytes": size, "refers_to_record": ident("WARC-Refers-To"), "refers_to": text("X-Refers-To-Page-Id"), "payload": payload}, end + 4


class BundleWriter:
    """Appends records to one bundle; ``close`` writes what is left of the frame, the record map and the seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.places: list[bytes] = []
        self.pending: list[bytes] = []
        self.size = self.written = 0

    def add(self, ident: str, record: bytes) -> tuple[int, int, int]:
        """Frame, offset inside it and length of the record."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self._flush()
        place = (len(self.frames), self.size, len(record))
        self.places.append(_PLACE.pack(uuid.UUID(ident).bytes, *place))
        self.pending.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        if self.pending:
            data = self.compressor.compress(b"".join(self.pending))
            self._put(data, self.size)
            self.pending, self.size = [], 0

    def _put(self, data: bytes, plain: int) -> None:
        self.stream.write(data)
        self.frames.append((len(data), plain))
        self.written += len(data)

    def close(self) -> None:
        self._flush()
        places = b"".join(self.places)
        self._put(_HEAD.pack(SKIPPABLE_MAP, len(places)) + places, 0)
        table = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(len(self.frames), 0, SEEKABLE)
        self.stream.write(_HEAD.pack(SKIPPABLE_SEEK, len(table)) + table)
        self.stream.close()


def read_seek_table(stream) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, from the footer of an open bundle."""
    size = stream.size()
    stream.seek(max(0, size - _FOOTER.size))
    tail = stream.read(_FOOTER.size)
    if len(tail) < _FOOTER.size or _FOOTER.unpack(tail)[2] != SEEKABLE:
        raise ValueError("no seek table at the end")
    n, flags, _ = _FOOTER.unpack(tail)
    entry = _ENTRY.size + 4 * (flags >> 7)  # with or without a checksum for each frame
    length = n * entry + _FOOTER.size
    stream.seek(size - length - _HEAD.size)
    if _HEAD.unpack(stream.read(_HEAD.size)) != (SKIPPABLE_SEEK, length):
        raise ValueError("seek table is damaged")
    table, out, at = stream.read(length), [], 0
    for i in range(n):
        packed, plain = _ENTRY.unpack_from(table, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def read_record_map(stream) -> dict[str, tuple[int, int, int]]:
    """Frame, offset and length of every record id, from the bundle itself."""
    for start, packed, plain in reversed(read_seek_table(stream)):
        if plain == 0:
            stream.seek(start)
            magic, size = _HEAD.unpack(stream.read(_HEAD.size))
            if magic == SKIPPABLE_MAP and size == packed - _HEAD.size:
                return {str(uuid.UUID(bytes=i)): (f, o, n) for i, f, o, n in _PLACE.iter_unpack(stream.read(size))}
    raise ValueError("no record map")


def read_frame(stream, start: int, packed: int, plain: int) -> bytes:
    stream.seek(start)
    return zstandard.ZstdDecompressor().decompress(stream.read(packed), max_output_size=plain)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


# ------------------------------------------------------------------- writing ----
def assign_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Rows to write: page, url, payload, digest, row number, and for revisits the response's page and row."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = stage(pages.select(F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "warc-rows")
    first = F.min(F.struct(F.col("page").isNull().alias("none"), "page", "row")).alias("first")
    shared = (rows.filter(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("digest", F.col("first.page").alias("first_page"), F.col("first.row").alias("first_row")))
    shared = stage(shared, "warc-shared")
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    return rows.join(shared, "digest", "left")


def write_bundles(pages: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE, **columns: str) -> DataFrame:
    """Write a record for every row; returns the committed index, one row a record (see ``INDEX``)."""
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"

    def run(batches):
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        schema = _arrow(INDEX)
        writer = name = None
        for batch in batches:
            out = []
            for page, url, payload, digest, row, first_page, first_row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(system.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                kind = "response" if first_row is None or first_row == row else "revisit"
                ident = record_id(page, digest, row)
                refers = record_id(first_page, digest, first_row) if kind == "revisit" else None
                record = encode_record(kind, ident, page, url, digest, payload.encode(), refers, first_page, date)
                out.append((ident, None if page is None else str(page), kind, f"{folder}/{name}", *writer.add(ident, record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield _batch(out, schema)
        if writer is not None:
            writer.close()

    small_batches(spark)
    rows = assign_records(pages, **columns).select("page", "url", "payload", "digest", "row", "first_page", "first_row")
    return stage(rows.mapInArrow(run, INDEX), "warc-index")


# ------------------------------------------------------------------- reading ----
def bundle_frames(files: DataFrame) -> DataFrame:
    """(file, frame, start, packed, plain) of every frame of the bundles named in column ``file``, from their seek tables."""
    schema = T.StructType([T.StructField("file", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("frame", "start", "packed", "plain")]])

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = _open(name)
                with system.open_input_file(path) as stream:
                    yield _batch([(name, i, *f) for i, f in enumerate(read_seek_table(stream)) if f[2]], _arrow(schema))

    return files.select("file").distinct().mapInArrow(run, schema)


def _decode(frames: DataFrame, payload: bool) -> DataFrame:
    """Records of frames (file, start, packed, plain, offsets); null offsets: all of the frame."""
    names = [f.name for f in RECORD]

    def run(batches):
        schema = _arrow(RECORD)
        for batch in batches:
            for name, start, packed, plain, offsets in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _open(name)
                with system.open_input_file(path) as stream:
                    data = read_frame(stream, start, packed, plain)
                out, at = [], 0
                if offsets is not None:
                    out = [decode_record(data, o)[0] for o in offsets]
                else:
                    while at < len(data):
                        record, at = decode_record(data, at)
                        out.append(record)
                if not payload:
                    out = [r | {"payload": None} for r in out]
                yield _batch([tuple(r[n] for n in names) for r in out], schema)

    return frames.select("file", "start", "packed", "plain", "offsets").mapInArrow(run, RECORD)


def read_bundles(files: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the bundles named in column ``file`` (an index will do); digests of responses are computed again and compared."""
    frames = bundle_frames(files).withColumn("offsets", F.lit(None).cast("array<bigint>"))
    return _decode(frames.repartition("file", "frame"), payload)


def fetch_records(index: DataFrame, ids: DataFrame, payload: bool = True) -> DataFrame:
    """Records whose record_id is in ``ids``: only their frames are read, each once."""
    wanted = index.join(ids.select("record_id").distinct(), "record_id", "left_semi").groupBy("file", "frame").agg(F.collect_list("offset").alias("offsets"))
    return _decode(wanted.join(bundle_frames(wanted), ["file", "frame"]), payload)


def page_records(pages: DataFrame) -> DataFrame:
    """The registered query: ``pages`` written as bundles and read back, one row a record."""
    kind = pages.schema["page_id"].dataType
    return read_bundles(write_bundles(pages), payload=False).select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                                                    F.col("refers_to").cast(kind).alias("refers_to"), "record_id")
