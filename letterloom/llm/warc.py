"""WARC archives: a writer with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm.common import cut, join_groups, shuffle_parts

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
READ = 1 << 20
EMPTY_LINE = b"\r\n\r\n"
#: A new archive is begun beyond so many bytes.
ARCHIVE = 32 << 20

RECORDS = (
    "path string, start long, end long, record_type string, record_id string, target string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to string, problem string"
)
FIELDS = [part.split()[0] for part in RECORDS.split(", ")]
ARROW = pa.schema(
    [(n, {"long": pa.int64(), "binary": pa.binary()}.get(k, pa.string())) for n, k in (p.split() for p in RECORDS.split(", "))]
)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else re.sub(r"^(?:file:)?/+", "file:///", path))


def record(kind: str, ident: str, target: str, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One record. A revisit has no block; its digest and length are those of the payload it stands for."""
    block = b"" if kind == "revisit" else payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{ident}>",
        "WARC-Target-URI": re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", target),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(size),
        "Content-Type": "text/html; charset=utf-8",
    }
    if refers_to is not None:
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Writes a gzip member per page into archives below ``folder``; (path, records, bytes) per archive.

    Payloads are the bodies in UTF-8, null as empty. Of equal payloads of 100 bytes or more those with the
    smallest key are responses and the others revisits of it; smaller ones are all responses. A null
    key is never the smallest. Keys and bodies travel once, dealt by payload hash, with groups of copies salted.

    A task writes under a name of its own attempt and moves the file to the task's name when it is
    complete, so a task that runs again after a lost executor replaces what it wrote.
    """
    spark = pages.sparkSession
    data = F.coalesce(F.col(body), F.lit("")).cast("binary")
    source = pages.select(F.col(key).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), data.alias("data"))
    source = source.withColumn("digest", F.sha2("data", 256)).withColumn("size", F.octet_length("data").cast("long"))
    prints = cut(source.select("id", "digest", "size"))
    groups = prints.where("size >= 100").groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    dealt = join_groups(source, groups.where("n > 1"), "digest", "n", "id", prints.count())
    rows = dealt.select(
        F.col("id").cast("string"), "url", "data", "digest", "size", F.when(F.col("id") != F.col("first"), F.col("first")).cast("string").alias("first")
    )
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = _filesystem(folder)
        system.create_dir(root, recursive=True)
        names, counts, sizes = [], [], []
        sink, held, written = None, 0, 0

        def close() -> None:
            name = f"{run}-{task.partitionId():06d}-{len(names):04d}.warc.gz"
            sink.close()
            system.move(partial, f"{root}/{name}")
            names.append(f"{folder}/{name}")
            counts.append(held)
            sizes.append(written)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("id", "url", "data", "digest", "size", "first"))):
                ident, target, payload, digest, size, first = (cell.as_py() for cell in row)
                kind = "response" if first is None else "revisit"
                member = _member(record(kind, str(ident), target, payload, digest, size, first))
                if sink is None:
                    partial = f"{root}/_{run}-{task.taskAttemptId()}-{len(names)}.part"
                    sink, held, written = system.open_output_stream(partial), 0, 0
                sink.write(member)
                held, written = held + 1, written + len(member)
                if written >= ARCHIVE:
                    close()
                    sink = None
        if sink is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return rows.mapInArrow(write, "path string, records long, bytes long")


class _Window:
    """A forward view of a stream that holds only the bytes from ``at`` on."""

    def __init__(self, stream):
        self.stream, self.at, self.data, self.ended = stream, 0, bytearray(), False

    def fill(self, size: int) -> bool:
        """Whether ``size`` bytes are there, after reading on as needed."""
        while len(self.data) < size and not self.ended:
            more = self.stream.read(READ)
            self.data += more
            self.ended = not more
        return len(self.data) >= size

    def skip(self, size: int) -> None:
        del self.data[:size]
        self.at += size


def _inflate(window: _Window) -> tuple[bytes, int] | None:
    """The gzip member at the window's start and its stored size, or none if its checks fail."""
    inflate, out, fed = zlib.decompressobj(31), [], 0
    while not inflate.eof:
        if not window.fill(fed + 1):
            return None
        part = bytes(window.data[fed:])
        try:
            out.append(inflate.decompress(part))
        except zlib.error:
            return None
        fed = len(window.data) - len(inflate.unused_data) if inflate.eof else len(window.data)
        if sum(map(len, out[:2])) >= 8 and not b"".join(out[:2]).startswith(VERSION):
            return None
    return b"".join(out), fed


def _head(data: bytes | bytearray) -> tuple[dict[str, str], int] | None:
    """Header fields, names in lower case, and where the block begins."""
    end = data.find(EMPTY_LINE)
    if not data.startswith(VERSION) or end < 0:
        return None
    first, *lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    return int(value) if re.fullmatch("[0-9]{1,18}", value) else -1


def _row(fields: dict[str, str], block: bytes) -> dict | None:
    """The record's columns, or none where the block is not what the head says."""
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest", "")
    own = hashlib.sha256(block).hexdigest()
    if kind == "revisit":
        size = int(fields["x-payload-length"]) if re.fullmatch("[0-9]{1,18}", fields.get("x-payload-length", "")) else None
        shown = digest.removeprefix("sha256:") or None
    else:
        if digest.startswith("sha256:") and digest != f"sha256:{own}":
            return None
        size, shown = len(block), own
    page = lambda name: re.sub(r"^<urn:page:|>$", "", fields[name]) if name in fields else None
    return {
        "record_type": kind, "record_id": page("warc-record-id"), "target": fields.get("warc-target-uri"),
        "payload": None if kind == "revisit" else block, "payload_bytes": size, "payload_digest": shown,
        "refers_to": page("warc-refers-to"),
    }


def _take(window: _Window) -> tuple[dict, int] | None:
    """The valid record at the window's start and its stored size."""
    window.fill(len(VERSION))
    if window.data.startswith(MAGIC):
        member = _inflate(window)
        if member is None:
            return None
        data, size = member
        head = _head(data)
        if head is None:
            return None
        fields, at = head
        length = _length(fields)
        if length < 0 or data[at + length :] != b"\r\n\r\n":
            return None
        row = _row(fields, data[at : at + length])
        return row and (row, size)
    if not window.data.startswith(VERSION):
        return None
    seen = 0
    while window.data.find(EMPTY_LINE, max(0, seen - 3)) < 0:
        seen = len(window.data)
        if not window.fill(seen + 1):
            break
    head = _head(window.data)
    if head is None:
        return None
    fields, at = head
    length = _length(fields)
    # a length beyond the file, or one that leads elsewhere, is damage
    if length < 0 or not window.fill(at + length + 4) or window.data[at + length : at + length + 4] != b"\r\n\r\n":
        return None
    row = _row(fields, bytes(window.data[at : at + length]))
    return row and (row, at + length + 4)


def _next(window: _Window) -> int | None:
    """Where the next member or version line may begin, after the window's first byte."""
    places = [p for p in (window.data.find(MAGIC, 1), window.data.find(VERSION, 1)) if p > 0]
    return min(places, default=None)


def salvage(stream, path: str) -> Iterator[dict]:
    """Records of one archive, and a row with ``problem`` for each run of bytes that is none.

    After a record that fails a check (gzip checksum, head, length, block digest) bytes are skipped to
    the next place where a valid record begins; the bytes in between are one gap. Memory is that of
    one record and a read ahead, but a damaged length may make it read on to the end of the file.
    """
    window, gap = _Window(stream), None
    while window.fill(1):
        found = _take(window)
        if found is not None:
            if gap is not None:
                yield _gap(path, gap, window.at)
                gap = None
            row, size = found
            yield {"path": path, "start": window.at, "end": window.at + size, "problem": None} | row
            window.skip(size)
            continue
        gap = window.at if gap is None else gap
        while (at := _next(window)) is None and not window.ended:
            window.skip(max(0, len(window.data) - len(VERSION)))  # a mark may lie across two reads
            window.fill(len(window.data) + 1)
        window.skip(len(window.data) if at is None else at)
    if gap is not None:
        yield _gap(path, gap, window.at)


def _gap(path: str, start: int, end: int) -> dict:
    return dict.fromkeys(FIELDS) | {"path": path, "start": start, "end": end, "problem": "no valid record"}


def read_archives(archives: DataFrame, path: str = "path", records: str | None = None) -> DataFrame:
    """Records and gaps of the archives that ``archives`` lists, gzip members or plain, mixed at will.

    One row per record, or per gap of bytes with its ``problem``. Each archive is streamed by one task;
    rows leave in batches of a few MB. Null paths and an empty list give no rows. With ``records``, the column
    that says how many records an archive has, a gap or another number of them raises ``ValueError``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                if not name:
                    continue
                system, place = _filesystem(name)
                held, size, count = [], 0, 0
                with system.open_input_stream(place, compression=None) as stream:
                    for row in salvage(stream, name):
                        if row["problem"] and expected is not None:
                            raise ValueError(f"{name}: {row['problem']} from byte {row['start']} to {row['end']}")
                        count += 1
                        held.append(row)
                        size += len(row["payload"] or b"") + 500
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=ARROW)
                            held, size = [], 0
                if expected is not None and count != expected:
                    raise ValueError(f"{name}: {count} records instead of {expected}")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=ARROW)

    known = F.col(records) if records else F.lit(None)
    return archives.select(F.col(path).alias("path"), known.cast("long").alias("records")).mapInArrow(read, RECORDS)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the archives in a folder; their bytes are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return found.select("path", "length")


def page_records(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Writes the pages to archives in ``folder`` and reads them back; one row per page.

    (key, payload_bytes, payload_digest, record_type, refers_to). Rows that repeat a key are written
    each; null pages and urls are empty, urls of any length are kept; an empty table writes nothing and gives
    no rows. An archive that does not give back every record written to it raises.
    """
    kind = pages.schema[key].dataType
    written = cut(write_archives(pages, folder, key, url, body))
    # a task for each archive while they are few, and a bounded number of tasks
    parts = min(max(1, written.count()), 32 * shuffle_parts(pages.sparkSession))
    records = read_archives(written.repartition(parts, "path"), records="records")
    return records.select(
        F.when(F.col("record_id") != "None", F.col("record_id")).cast(kind).alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
