"""Seekable Zstandard bundles of WARC records.

A bundle holds records in independent Zstandard frames, some records to a frame,
and ends with a seek table: a skippable frame with the compressed and plain size
of every frame (the public seekable format).  The index beside a bundle maps each
record id to its frame and the offset within the frame; records are read back through
it, and one record is read by decompressing one frame.

Bundles are rows of a Parquet table in the shared folder, so any file system
that Spark reaches will do.  Records with equal payloads are stored once: the one
with the largest page id is the response, others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isallobar.llm.common import Scratch, settle, slices

#: Plain bytes in a frame and in a bundle, and the compression level.
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 8 << 20, 3
# Fixed values of the seekable format: skippable frame and seek table magic numbers.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Payloads of at least this many bytes are stored once.
LEAST_BYTES = 0
#: A look-up of repeated payloads up to this many rows is broadcast (about 60 bytes each).
BROADCAST_ROWS = 20_000

DIGEST = "sha1:"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str, copy: int | None = None) -> str:
    """Id of a record; ``copy`` tells rows apart that repeat both the page id and the payload."""
    return f"<urn:page:{'' if page_id is None else page_id}:{payload_digest}{'' if copy is None else f':{copy}'}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, copy: int | None = None) -> tuple[str, bytes]:
    """Id and bytes of a WARC/1.1 record; a revisit has no payload but names its digest and length."""
    name = digest(payload)
    own = record_id(page_id, name, copy)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {own}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Target-URI: {re.sub('[\\x00-\\x20\\x7f]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Payload-Digest: {DIGEST}{name}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, name)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return own, "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, body and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    start = end + 4
    stop = start + int(fields["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, data[start:stop], stop + 4


class BundleWriter:
    """Gathers records into frames and closes them with a seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES) -> None:
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frame_bytes = frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.plain = self.total = 0
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, key: str, data: bytes) -> None:
        self.index.append((key, len(self.sizes), self.plain, len(data)))
        self.open.append(data)
        self.plain += len(data)
        self.total += len(data)
        if self.plain >= self.frame_bytes:
            self._close()

    def _close(self) -> None:
        if self.open:
            frame = self.compressor.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.plain))
            self.open, self.plain = [], 0

    def finish(self) -> bytes:
        self._close()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame, from the footer."""
    count, flags, magic = struct.unpack_from("<IBI", bundle, len(bundle) - 9)
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, out = len(bundle) - 9 - width * count, []
    offset = 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", bundle, at + width * k)
        out.append((offset, packed, plain))
        offset += packed
    return out


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    """Plain bytes of one frame."""
    offset, packed, plain = frame
    data = zstandard.ZstdDecompressor().decompress(bundle[offset : offset + packed], max_output_size=max(1, plain))
    if len(data) != plain:
        raise ValueError("a frame has another size than its table entry")
    return data


def read_record(bundle: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry; decompresses a single frame."""
    fields, body, _ = parse(read_frame(bundle, seek_table(bundle)[frame]), offset)
    return fields, body


def read_records(bundle: bytes, index: list[dict]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that index entries name, each by its frame and offset; a frame is decompressed once for entries in order."""
    frames, held, data = seek_table(bundle), -1, b""
    for entry in index:
        if entry["frame"] != held:
            held = entry["frame"]
            data = read_frame(bundle, frames[held])
        fields, body, end = parse(data, entry["offset"])
        if fields["WARC-Record-ID"] != entry["record_id"] or end - entry["offset"] != entry["length"]:
            raise ValueError("the index names another record")
        yield fields, body


def _with_twins(chosen: DataFrame, twins: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows that repeat another's page id and payload, told apart by ``copy``.

    Equal rows are folded before they are dealt out again.  Of those with the group's largest
    page id, one of the least url is the response and has no copy number.
    """
    same = F.broadcast(twins) if twins.count() <= BROADCAST_ROWS else twins
    on = (chosen["sha"] == same["sha_"]) & (chosen["n"] == same["n_"]) & chosen["page_id"].eqNullSafe(same["page_id_"])
    many = chosen.join(same, on, "left_semi").groupBy("page_id", "url", "sha", "n", "kept").agg(F.count("*").alias("rows"), F.first("payload").alias("payload"))
    many = scratch.settle(many, "twins")
    each = many.select("page_id", "url", "payload", "sha", "n", "kept", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("turn"))
    first = many.where(F.col("page_id").eqNullSafe(F.col("kept"))).groupBy("sha", "n").agg(F.min(F.struct(F.col("url").isNull().alias("none"), "url")).alias("least"))
    led = each.join(first, ["sha", "n"], "left")
    leads = F.col("page_id").eqNullSafe(F.col("kept")) & (F.col("turn") == 1) & F.col("url").eqNullSafe(F.col("least.url"))
    number = F.when(~leads, F.monotonically_increasing_id()).alias("copy")
    told = led.select("page_id", "url", "payload", "kept", (F.col("kept").isNotNull() & ~leads).alias("revisit"), number)
    alone = chosen.join(same, on, "left_anti").select("page_id", "url", "payload", "kept", "revisit", F.lit(None).cast("long").alias("copy"))
    return alone.unionByName(told)


def write_bundles(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write a record for each page and return the table of bundles, settled in the shared folder.

    Rows: ``bundle_id``, ``data`` (the bytes of a .warc.zst file) and ``index``, an array of
    (record_id, frame, offset, length).  Null html is empty.  Of records with equal
    payloads of ``least`` bytes or more, that with the largest page_id is the
    response; of rows that repeat that page_id too, one of the least url is, and the
    others revisit it.  Every row keeps its own url.  A null page_id counts as the
    smallest; among null ids alone every record is a response.  Record ids are unique.
    Other columns are ignored, an empty table gives no bundles.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", url.alias("url"), html.alias("payload"))
    scratch = Scratch()
    each = scratch.settle(rows.select("page_id", F.sha1("payload").alias("sha"), F.length("payload").alias("n")).groupBy("sha", "n", "page_id").agg(F.count("*").alias("same")), "payloads")
    groups = each.where(F.col("n") >= least).groupBy("sha", "n").agg(F.max("page_id").alias("kept"), F.sum("same").alias("copies"))
    repeated = scratch.settle(groups.where("copies > 1 AND kept IS NOT NULL").select("sha", "n", "kept"), "repeated")
    twins = each.where("same > 1").select(F.col("sha").alias("sha_"), F.col("n").alias("n_"), F.col("page_id").alias("page_id_"))
    keyed = rows.select("*", F.sha1("payload").alias("sha"), F.length("payload").alias("n"))
    found = keyed.join(F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated, ["sha", "n"], "left")
    chosen = found.withColumn("revisit", F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept")))
    if twins.isEmpty():
        chosen = chosen.withColumn("copy", F.lit(None).cast("long"))
    else:
        chosen = _with_twins(chosen, scratch.settle(twins, "twins"), scratch)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made, writer = TaskContext.get().partitionId() << 32, 0, BundleWriter()

        def flush() -> pa.RecordBatch:
            nonlocal made, writer
            entries = [dict(zip(("record_id", "frame", "offset", "length"), e, strict=True)) for e in writer.index]
            out = [[base + made], [writer.finish()], [entries]]
            made, writer = made + 1, BundleWriter()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), entry_type), strict=True)], names=["bundle_id", "data", "index"])

        entry_type = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            for start, end in slices(pc.binary_length(batch.column(2)).to_pylist()):
                for row in zip(*(c.slice(start, end - start).to_pylist() for c in batch.columns), strict=True):
                    writer.add(*record(*row))
                    if writer.total >= BUNDLE_BYTES:
                        yield flush()
        if writer.index:
            yield flush()

    shape = "bundle_id bigint, data binary, index array<struct<record_id: string, frame: int, offset: bigint, length: bigint>>"
    ordered = chosen.select(F.col("page_id").cast("long"), "url", "payload", F.col("kept").cast("long"), "revisit", "copy")
    bundles = settle(ordered.mapInArrow(work, shape), "bundles")
    scratch.clear()
    return bundles


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Read every record back through the index and the seek tables.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to; the
    digest of a response is checked against its payload.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for row in range(batch.num_rows):
                out: list[tuple] = []
                for fields, body in read_records(batch.column(0)[row].as_py(), batch.column(1)[row].as_py()):
                    name, size, kind = fields["WARC-Payload-Digest"].removeprefix(DIGEST), int(fields["WARC-Payload-Length"]), fields["WARC-Type"]
                    if kind == "response" and (len(body) != size or digest(body) != name):
                        raise ValueError("a payload differs from its digest")
                    page, other = fields["WARC-Page-ID"], fields.get("WARC-Refers-To-Page-ID")
                    out.append((int(page) if page else None, size, name, kind, int(other) if other else None))
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return bundles.select("data", "index").mapInArrow(work, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
