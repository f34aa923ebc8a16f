"""WARC archives: written as one gzip stream, rewritten as a member per record with an index.

Spark's text writer produces monolithic archives: records are its lines, ended by two line
breaks, in one gzip stream per task. The normaliser inflates such a file once, in small
blocks, and writes every record as a gzip member of its own, so that a record can be read
alone. A sidecar lists where the members lie. Files are written under a name of their own
and renamed when whole, so a task that is lost or run twice leaves nothing half done.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import shared_dir

#: Bytes read at a time, and the ends of records and of their heads (fixed by the format).
BLOCK = 1 << 18
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_ID = "urn:page:"
EPOCH = "1970-01-01T00:00:00Z"

_INDEX = "archive string, offset long, length long, record_id string, record_type string"
_MEMBER = 31  # zlib's window bits of a gzip member


def payload_digest(payload: Column) -> Column:
    """The SHA-1 of a payload in base 32, in upper case: 20 bits become four letters."""
    hexes = F.sha1(payload.cast("binary"))
    fours = [F.lpad(F.conv(F.substring(hexes, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_revisits(pages: DataFrame, *, id_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """``(id, digest, refers_to)`` of the pages whose payload a page with a larger id holds too.

    Only ids and digests are shuffled.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    digests = pages.select(F.col(id_col).alias("id"), payload_digest(payload).alias("digest"), F.octet_length(payload).alias("size"))
    digests = digests.where(F.col("size") >= least_bytes).select("id", "digest")
    copies = digests.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
    copies = stored(copies.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n"), "copies")
    return digests.join(copies, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "digest", "refers_to").distinct()


def write_archives(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0
) -> None:
    """One record per row, as monolithic gzip files under ``path``.

    Among records with equal payloads of at least ``least_bytes`` bytes the largest id is a
    response and the others are revisits, which hold no payload. Rows that share that id and
    payload are responses all; without any id there is no revisit. A null payload is empty,
    a null url leaves its field out.
    """
    revisits = plan_revisits(pages, id_col=id_col, payload_col=payload_col, least_bytes=least_bytes)
    revisits = stored(revisits.withColumnsRenamed({"id": "again", "digest": "same"}), "revisits")
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), payload_digest(payload).alias("digest")
    )
    # Spark broadcasts the stored revisits if they are small; else both sides are shuffled.
    rows = rows.join(revisits, F.col("id").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("same")), "left")
    again = F.col("same").isNotNull()
    body = F.when(again, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "_")
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(again, F.lit("WARC-Type: revisit\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(
            F.lit("WARC-Type: response\r\n")
        ),
        field("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_ID}"), number(F.col("id")), F.lit(">"))),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Date", F.lit(EPOCH)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(again, field("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_ID}"), number(F.col("refers_to")), F.lit(">")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        field("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    rows.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", RECORD_END).text(path)


class _Stream:
    """A gzip file inflated once, block by block; members that follow each other are joined."""

    def __init__(self, file) -> None:
        self.file, self.inflater, self.text = file, zlib.decompressobj(_MEMBER), bytearray()

    def more(self) -> bool:
        """Inflate up to a block more; false at the end of the file."""
        block = self.inflater.unconsumed_tail or self.inflater.unused_data or self.file.read(BLOCK)
        if not block:
            return False
        if self.inflater.eof:
            self.inflater = zlib.decompressobj(_MEMBER)
        self.text += self.inflater.decompress(bytes(block), BLOCK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The text up to and with ``mark``, or none at the end."""
        seen = 0
        while (at := self.text.find(mark, seen)) < 0:
            seen = max(0, len(self.text) - len(mark))
            if not self.more():
                if self.text.strip():
                    raise ValueError("the archive ends inside a record's head")
                return None
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.text) < size:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        part = bytes(self.text[:size])
        del self.text[:size]
        return part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record starts with {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def records(file) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Fields, head and block of each record of an inflated stream."""
    stream = _Stream(file)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        yield fields, head, stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than its length says")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; ``file:/a`` is ``/a``."""
    local = re.fullmatch(r"file:/+(.*)", uri)
    return (fs.LocalFileSystem(), "/" + local.group(1)) if local else fs.FileSystem.from_uri(uri)


def normalise_archive(source: str, target: str) -> int:
    """Rewrite one archive as ``target`` with a member per record and ``target``.idx; its size."""
    store, name = _open(target)
    part = f"{name}.{uuid.uuid4().hex}"
    reader, path = _open(source)
    offset = 0
    with reader.open_input_stream(path, compression=None) as file, store.open_output_stream(part, compression=None) as out, store.open_output_stream(
        f"{part}.idx", compression=None
    ) as index:
        for fields, head, block in records(file):
            deflater = zlib.compressobj(6, zlib.DEFLATED, _MEMBER)
            member = deflater.compress(head + block + b"\r\n\r\n") + deflater.flush()
            out.write(member)
            row = {
                "archive": target, "offset": offset, "length": len(member),
                "record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"),
            }
            index.write(json.dumps(row).encode() + b"\n")
            offset += len(member)
    store.move(part, name)
    store.move(f"{part}.idx", f"{name}.idx")
    return offset


def normalise(spark, source: str, target: str) -> DataFrame:
    """Normalise all ``.gz`` files under ``source`` into ``target``; ``(source, archive, bytes)`` per file.

    Files are listed, and dealt to tasks by size, by Spark's file source, which does not
    read them. A record, not a file, is what a task holds in memory.
    """
    store, folder = _open(target)
    store.create_dir(folder, recursive=True)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                archive = f"{target}/{path.rsplit('/', 1)[-1].removesuffix('.gz').removesuffix('.txt')}.warc.gz"
                size = normalise_archive(path, archive)
                yield pa.record_batch([pa.array([path]), pa.array([archive]), pa.array([size], pa.int64())], names=["source", "archive", "bytes"])

    return listed.mapInArrow(rewrite, "source string, archive string, bytes long")


def read_index(spark, target: str) -> DataFrame:
    """The sidecar indexes of normalised archives: one row per record."""
    return spark.read.schema(_INDEX).option("pathGlobFilter", "*.idx").json(target)


def read_records(index: DataFrame) -> DataFrame:
    """``(record_id, record_type, refers_to, payload_bytes, payload_digest, intact)`` per index row.

    Every member is read alone, by its offset. Length and digest of a response are those
    of the payload read, and ``intact`` says whether its head agrees; a revisit has them
    from its head.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive != current:
                    if file:
                        file.close()
                    store, path = _open(archive)
                    current, file = archive, store.open_input_file(path)
                file.seek(offset)
                inflated = zlib.decompress(file.read(length), _MEMBER)
                head, _, block = inflated.partition(b"\r\n\r\n")
                fields = _fields(head)
                payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]
                size, digest = int(fields["warc-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                intact = True
                if fields["warc-type"] == "response":
                    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    intact = (size, digest) == (len(payload), own)
                    size, digest = len(payload), own
                out.append((fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"), size, digest, intact))
            if out:
                types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "intact"]
                )

    return index.select("archive", "offset", "length").mapInArrow(
        read, "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, intact boolean"
    )


def round_trip(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0
) -> DataFrame:
    """``(id_col, payload_bytes, payload_digest, record_type, refers_to, intact)`` per row, read back from archives.

    Archives are written to the shared folder, normalised, and read through their indexes.
    See ``write_archives`` for nulls, equal payloads and repeated rows.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, f"{folder}/whole", id_col=id_col, url_col=url_col, payload_col=payload_col, least_bytes=least_bytes)
    stored(normalise(spark, f"{folder}/whole", f"{folder}/members"), "archives")
    back = read_records(read_index(spark, f"{folder}/members"))
    number = lambda c: F.nullif(F.regexp_extract(c, f"^<{RECORD_ID}(.*)>$", 1), F.lit("")).cast(pages.schema[id_col].dataType)
    return back.select(
        number(F.col("record_id")).alias(id_col), "payload_bytes", "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"), "intact"
    )
