"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own.  Writers put a file for each task
into the shared folder under a name of that attempt alone and return a
manifest row; only files of the manifest count, so a retried or speculative
task leaves no record twice.

The reader cuts files into byte ranges and reads ranges in parallel.  A task
looks for gzip magic in its range, accepts a candidate when the member decodes
to its end, holds a whole WARC record and is followed by another one or the
end of the file, and from there goes from member to member.  It owns the
records that start inside its range, and reads on past the range to finish the
last one.  Memory holds one record and one read buffer.

Defined cases: a null payload is empty; a null id or address writes no such
value and reads back as null; equal rows are separate records; rows with the
greatest id among equal payloads are all responses if that id repeats; an
empty table gives an archive without records; extra columns are ignored.

Damage is an error, never a lost record.  Inside a range, a member that doesn't
decode raises at once.  The first member of a range can't be told from chance
bytes if it is damaged, so it may be passed over; ``require_whole`` therefore
checks that the records that were read tile each file from its first byte to its
last, without gap or overlap, and are as many as its manifest says.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, text_array, written

MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads from this size on may be replaced by revisits.
REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
#: Most tasks of a read; beyond it, a task gets several ranges that follow each other.
TASKS = 20_000
#: A writer starts another file beyond this size.
FILE_BYTES = 1 << 30
CHUNK = 1 << 14
DATE = "2024-01-01T00:00:00Z"


def _record_id(key) -> str:
    return f"<urn:x-page:{'' if key is None else key}>"


def _clean(value: str) -> str:
    """Header values hold no control characters; they are percent-encoded."""
    return "".join(c if ord(c) >= 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in value)


def record(key, uri: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(key)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if uri is not None:
        head.insert(3, f"WARC-Target-URI: {_clean(uri)}")
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, id_col: str, payload: Column, least: int = REVISIT_BYTES) -> DataFrame:
    """Add refers_to: of equal payloads of at least ``least`` bytes all but the greatest id refer to it.

    Digests are grouped without their payloads (combined before the shuffle);
    only digests that repeat go to the join, whose build side Spark broadcasts
    if its written size is under the session's threshold.
    """
    digest, size = F.sha1(payload), F.octet_length(payload)
    repeated = written(pages.select(F.col(id_col).alias("_id"), digest.alias("_digest"), size.alias("_size")).where(F.col("_size") >= least)
                       .groupBy("_digest").agg(F.max("_id").alias("_keeper"), F.count("*").alias("_n")).where("_n > 1 and _keeper is not null")
                       .select("_digest", "_keeper"), "repeated-payloads")
    rows = pages.withColumn("_own", F.when(size >= least, digest))
    refers = F.when(F.col("_keeper").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_keeper")), F.col("_keeper"))
    return rows.join(repeated, F.col("_own") == F.col("_digest"), "left").withColumn("refers_to", refers).drop("_own", "_digest", "_keeper")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write every row as a record under ``folder``; returns the manifest (path, bytes, records)."""
    payload = F.coalesce(F.col("payload"), F.lit("")).cast("binary")
    own = pages.select(F.col(id_col).cast("long").alias("key"), F.col(uri_col).cast("string").alias("uri"), F.col(payload_col).cast("string").alias("payload"))
    rows = with_revisits(own, "key", payload).select("key", "uri", "payload", "refers_to")
    pafs.FileSystem.from_uri(folder)  # fails early on a store that Arrow can't write

    def write(batches):
        fs, top = pafs.FileSystem.from_uri(folder)
        fs.create_dir(top, recursive=True)
        out, name, size, n = None, "", 0, 0
        done = []
        for batch in batches:
            keys, uris, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for key, uri, text, to in zip(keys, uris, text_array(batch.column(2)), refers):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, n = fs.open_output_stream(f"{top}/{name}", compression=None), 0, 0
                member = record(key, uri, text.as_py().encode(), to, to is not None)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        if done:
            path, length, count = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(length, pa.int64()), pa.array(count, pa.int64())], ["path", "bytes", "records"])

    return written(rows.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives in a folder that another tool wrote."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", F.col("length").alias("bytes"))


class _Reader:
    """Sequential access with one buffer."""

    def __init__(self, source, size: int):
        self.source, self.size, self.base, self.buffer = source, size, 0, b""

    def at(self, pos: int, n: int) -> bytes:
        """Up to n bytes from pos on; fewer only at the end of the file."""
        if pos < self.base or pos + n > self.base + len(self.buffer) and self.base + len(self.buffer) < self.size:
            self.source.seek(pos)
            self.base, self.buffer = pos, self.source.read(max(n, 1 << 20))
        return self.buffer[pos - self.base:pos - self.base + n]

    def member(self, pos: int) -> tuple[bytes, int]:
        """The decoded gzip member at pos and where it ends."""
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            piece = self.at(pos, CHUNK)
            if not piece:
                raise zlib.error("the archive ends inside a member")
            out.append(unpack.decompress(piece))
            pos += len(piece) - len(unpack.unused_data)
        return b"".join(out), pos

    def starts_record(self, pos: int) -> bool:
        """Whether a member at pos begins like a WARC record, by decoding its first bytes."""
        piece = self.at(pos, 512)
        if not piece.startswith(MAGIC):
            return False
        try:
            return zlib.decompressobj(31).decompress(piece, 64).startswith(b"WARC/")
        except zlib.error:
            return False


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "surrogateescape").split("\r\n")
    head = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    n = int(head["content-length"])
    if len(data) != end + 4 + n + 4 or not data.startswith(b"WARC/"):
        raise ValueError("a member must hold exactly one record")
    return head, data[end + 4:end + 4 + n]


def first_record(reader: _Reader, start: int, end: int) -> int:
    """The first record that starts in [start, end), or end."""
    if start == 0 and reader.starts_record(0):
        return 0
    pos = start
    while pos < end:
        piece = reader.at(pos, 1 << 16)
        hit = piece.find(MAGIC)
        if hit < 0:
            pos += max(1, len(piece) - 2)
            continue
        pos += hit
        if pos >= end:
            break
        if reader.starts_record(pos):
            try:
                data, after = reader.member(pos)
                parse(data)
                if after == reader.size or reader.starts_record(after):
                    return pos
            except (zlib.error, ValueError, KeyError):
                pass
        pos += 1
    return end


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, where the record ends, headers, block) of the records that start in [start, end)."""
    reader = _Reader(source, size)
    pos = first_record(reader, start, end)
    while pos < end:
        data, after = reader.member(pos)
        yield (pos, after, *parse(data))
        pos = after


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files (path, bytes): path, offset, stop (where the record ends), page_id, record_type, uri, refers_to, header_digest
    (hex SHA-1), payload (binary; null for revisits)."""
    ranges = written(files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")), "warc-ranges")
    n = max(1, min(ranges.count(), TASKS))

    def key_of(value: str | None) -> int | None:
        own = (value or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(own) if own else None

    def read(batches):
        names = ["path", "offset", "stop", "page_id", "record_type", "uri", "refers_to", "header_digest", "payload"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                fs, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(name) as source:
                    for offset, stop, head, block in records_in(source, size, start, min(size, start + split_bytes)):
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex() if "warc-payload-digest" in head else None
                        kind = head.get("warc-type")
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        rows.append((path, offset, stop, key_of(head.get("warc-record-id")), kind, head.get("warc-target-uri"), key_of(head.get("warc-refers-to")), digest, payload))
                        held += len(block)
                        if held > 8 << 20:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)

    return ranges.repartitionByRange(n, "path", "start").select("path", "bytes", "start").mapInArrow(
        read, "path string, offset long, stop long, page_id long, record_type string, uri string, refers_to long, header_digest string, payload binary")


def damaged_files(index: DataFrame, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, found) of the files that the records read (path, offset, stop) don't tile, or that hold another number of
    them than ``files`` (path, bytes, and if known records) says.

    Within a range, a reader goes from each record's end to the next record,
    so ranges are compared, not records: a row per range of a file.
    """
    part = index.groupBy("path", F.floor(F.col("offset") / F.lit(split_bytes)).alias("part")).agg(
        F.min("offset").alias("first"), F.max("stop").alias("last"), F.count("*").alias("n"), F.sum(F.col("stop") - F.col("offset")).alias("covered"))
    before = F.lag("last", 1, 0).over(Window.partitionBy("path").orderBy("part"))
    tiles = (part.withColumn("whole", (F.col("first") == before) & (F.col("covered") == F.col("last") - F.col("first")))
             .groupBy("path").agg(F.min("whole").alias("whole"), F.max("last").alias("last"), F.sum("n").alias("found")))
    known = F.col("records") if "records" in files.columns else F.lit(None).cast("long")
    both = files.where("bytes > 0").select("path", "bytes", known.alias("records")).join(tiles, "path", "left")
    good = F.col("whole") & (F.col("last") == F.col("bytes")) & (F.col("records").isNull() | (F.col("records") == F.col("found")))
    return both.where(~F.coalesce(good, F.lit(False))).select("path", F.coalesce("found", F.lit(0)).cast("long").alias("found"))


def require_whole(index: DataFrame, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> None:
    """Raise if any file was not read from its first byte to its last."""
    bad = damaged_files(index, files, split_bytes).orderBy("path").limit(5).collect()
    if bad:
        raise ValueError("damaged archives: " + ", ".join(f"{r['path']} ({r['found']} records read)" for r in bad))


def payload_index(records: DataFrame, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; revisits take the size from the record they refer to.

    Digests are computed from the payloads that were read and must agree with
    the headers; a revisit must agree with its response; the records must tile
    the ``files`` that they were read from.
    """
    digest = F.sha1("payload")
    own = written(records.select("path", "offset", "stop", "page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                 F.when(F.col("record_type") == "revisit", F.col("header_digest")).when(digest == F.col("header_digest"), digest)
                                 .otherwise(F.raise_error(F.lit("a payload differs from its digest"))).alias("payload_digest")), "warc-index")
    require_whole(own, files, split_bytes)
    response = own.where("record_type = 'response'").select(F.col("page_id").alias("_to"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).distinct()
    revisit = own.where("record_type = 'revisit'").drop("payload_bytes").join(response, (F.col("refers_to") == F.col("_to")) & (F.col("payload_digest") == F.col("_digest")), "left")
    size = F.when(F.col("_bytes").isNull(), F.raise_error(F.lit("a revisit refers to no response")).cast("long")).otherwise(F.col("_bytes"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.where("record_type = 'response'").select(*names).unionByName(revisit.withColumn("payload_bytes", size).select(*names))


def round_trip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write the pages as archives in the shared scratch folder and index what is read back."""
    folder = scratch(pages.sparkSession, "warc")
    manifest = write_warc(pages, folder, id_col, uri_col, payload_col)
    return payload_index(read_warc(manifest, split_bytes), manifest, split_bytes)
