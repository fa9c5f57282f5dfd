"""Web archives: writing records in segments and putting them together again.

Writing: one response record for each distinct payload (that of the largest page),
revisit records for the other pages of that payload. Response payloads are framed
as HTTP chunks; blocks over ``segment_bytes`` are cut into a first record and
continuation records. Every record is a gzip member of its own.

Reading: records are parsed file by file; segments are grouped by the id of the
record they continue, ordered by segment number, and checked against the total
length; then chunk framing is undone and the payload digest compared. A record
that fails is reported with its problem instead of being dropped.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.store import fresh_path, open_folder, stored

SEGMENT_BYTES = 4_096
CHUNK_BYTES = 2_048
FILE_BYTES = 1 << 30
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2001-12-01T00:00:00Z"
_ID = "urn:x-page:"


# --- records ----------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame_chunks(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unframe_chunks(data: bytes) -> bytes:
    """Undo chunked framing; extensions and trailers are allowed and ignored."""
    parts, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size line")
        size = int(data[at:end].partition(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if len(data) < at + size + 2 or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk shorter than its size")
        parts.append(data[at : at + size])
        at += size + 2


def clean(text: str) -> str:
    """A header value: control characters as percent codes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(kind: str, record_id: str, block: bytes, **headers: object) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {_DATE}",
        *(f"{k.replace('_', '-')}: {clean(str(v))}" for k, v in headers.items() if v is not None),
        f"Content-Length: {len(block)}",
    ]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def records_of(
    page: int | None, url: str | None, payload: bytes, refers_to: int | None, mark: str, segment: int, chunk: int
) -> list[bytes]:
    """The records of one page."""
    own = f"{_ID}{'' if page is None else page}:{mark}"
    http = {"WARC_Target_URI": url or "about:blank", "WARC_Payload_Digest": "sha1:" + base32_sha1(payload)}
    kind = "application/http;msgtype=response"
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = status + b"Content-Length: %d\r\n\r\n" % len(payload)
        refers = {"WARC_Profile": _PROFILE, "WARC_Refers_To": f"<{_ID}{refers_to}>"}
        return [record("revisit", own, block, **http, **refers, Content_Type=kind)]
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + frame_chunks(payload, chunk)
    if len(block) <= segment:
        return [record("response", own, block, **http, Content_Type=kind)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    made = [record("response", own, parts[0], **http, Content_Type=kind, WARC_Segment_Number=1)]
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        made.append(
            record(
                "continuation",
                f"{own}:{k}",
                part,
                WARC_Segment_Origin_ID=f"<{own}>",
                WARC_Segment_Number=k,
                WARC_Segment_Total_Length=total,
            )
        )
    return made


def members(source) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    data, unpacker, held = b"", zlib.decompressobj(31), []
    while True:
        data = data or source.read(1 << 20)
        if not data:
            if held:
                raise ValueError("the archive ends within a record")
            return
        held.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(held)
            unpacker, held = zlib.decompressobj(31), []


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no archive record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = int(headers["content-length"])
    if len(rest) != length + 4:
        raise ValueError("block of another length than announced")
    return headers, rest[:length]


def payload_of(block: bytes) -> tuple[bytes, dict[str, str]]:
    """The HTTP payload of a response block, and its headers."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if http.get("transfer-encoding", "").lower() == "chunked":
        body = unframe_chunks(body)
    return body, http


def page_of(text: str | None) -> int | None:
    number = (text or "").strip("<>").removeprefix(_ID).partition(":")[0]
    return int(number) if number else None


# --- jobs ---------------------------------------------------------------------------


def with_roles(pages: DataFrame) -> DataFrame:
    """Add ``leader``: the largest page id of an equal payload, if it is another page."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    found = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("html"), F.sha1(body).alias("sha1")
    )
    leaders = found.groupBy("sha1").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1")
    leader = F.when(F.col("top").isNotNull() & ~F.col("top").eqNullSafe(F.col("page_id")), F.col("top"))
    return found.join(leaders, "sha1", "left").select("page_id", "url", "html", leader.alias("leader"))


def write(
    pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Write all pages; the manifest (path, n_records), one row per archive.

    A null payload is an empty one. Rows with equal ids and payloads are response
    records all. Only archives in the manifest count, so tasks may run twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        out, name, n, size, files, row = None, "", 0, 0, [], 0
        for batch in batches:
            pages_, urls, bodies, leaders = (batch.column(i) for i in range(4))
            for page, url, body, leader in zip(
                pages_.to_pylist(),
                urls.to_pylist(),
                bodies.cast(pa.binary()).to_pylist(),
                leaders.to_pylist(),
                strict=True,
            ):
                if out is None:
                    name = f"{path}/{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, n, size = system.open_output_stream(name, compression=None), 0, 0
                row += 1
                for piece in records_of(page, url, body, leader, f"{part}-{row}", segment_bytes, chunk_bytes):
                    out.write(piece)
                    n, size = n + 1, size + len(piece)
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, n))
                    out = None
        if out is not None:
            out.close()
            files.append((name, n))
        if files:
            names, counts = zip(*files, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"path": pa.array(names), "n_records": pa.array(counts, pa.int64())}
            )

    return stored(with_roles(pages).mapInArrow(run, "path string, n_records long"), "warc-manifest")


_PARSED = pa.schema(
    [
        ("origin", pa.string()),
        ("number", pa.int32()),
        ("total", pa.int64()),
        ("kind", pa.string()),
        ("digest", pa.string()),
        ("refers_to", pa.string()),
        ("block", pa.binary()),
    ]
)
_PARSED_SQL = "origin string, number int, total long, kind string, digest string, refers_to string, block binary"


def read_records(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of every archive, segments apart: origin is the record they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as source:
                    for headers, block in map(parse, members(source)):
                        get = headers.get
                        rows.append(
                            (
                                get("warc-segment-origin-id", get("warc-record-id")),
                                int(get("warc-segment-number", 1)),
                                int(get("warc-segment-total-length", -1))
                                if "warc-segment-number" in headers
                                else len(block),
                                get("warc-type"),
                                get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                get("warc-refers-to"),
                                block,
                            )
                        )
                        size += len(block)
                        if size >= 1 << 22:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(run, _PARSED_SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _PARSED, strict=True)], schema=_PARSED
    )


def reassemble(records: DataFrame) -> DataFrame:
    """One row per page record, from its segments: (page_id, record_type, payload, digest, refers_to, problem).

    A segment group is the blocks of one record, so it grows with that record only.
    """
    first = F.col("number") == 1
    segment = F.struct("number", "block")
    total = F.max(F.when(F.col("total") >= 0, F.col("total")))
    return records.groupBy("origin").agg(
        F.sort_array(F.collect_list(segment)).alias("segments"),
        total.alias("total"),
        F.max(F.when(first, F.col("kind"))).alias("kind"),
        F.max(F.when(first, F.col("digest"))).alias("digest"),
        F.max(F.when(first, F.col("refers_to"))).alias("refers_to"),
    )


def joined_block(segments: list[tuple[int, bytes]], total: int | None) -> bytes:
    """The whole block; numbers must run from 1 without gaps and the length must be as told."""
    if [n for n, _ in segments] != list(range(1, len(segments) + 1)):
        raise ValueError("segments are missing or repeated")
    block = b"".join(b for _, b in segments)
    if total != len(block):
        raise ValueError(f"total length is {len(block)}, not {total}")
    return block


def decode(grouped: DataFrame, with_payload: bool = False) -> DataFrame:
    """Check every grouped record and undo its framing; ``problem`` says what is wrong, else null."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string"
    schema += ", payload binary" if with_payload else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload, size, digest, problem = b"", None, None, None
                try:
                    block = joined_block([(s["number"], s["block"]) for s in r["segments"]], r["total"])
                    payload, http = payload_of(block)
                    if r["kind"] == "revisit":
                        size, digest = int(http["content-length"]), r["digest"]
                    else:
                        size, digest = len(payload), base32_sha1(payload)
                        if digest != r["digest"]:
                            problem = "payload does not match its digest"
                except (ValueError, KeyError) as error:
                    problem = str(error)
                row = (page_of(r["origin"]), size, digest, r["kind"], page_of(r["refers_to"]), problem)
                rows.append((*row, payload) if with_payload else row)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            names = [x.split()[0] for x in schema.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names
            )

    return grouped.mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives and report what reading them back gives; no pages, no rows."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    return decode(reassemble(read_records(spark, write(pages, folder), folder)))
