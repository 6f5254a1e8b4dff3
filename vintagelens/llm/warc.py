"""WARC archives and a two-level capture index.

Each scan task writes archives of records that are gzip members of their own, so that a record
can be read by its range. The index sorts captures by reversed-host URL key, time and page;
every index file holds compressed blocks of lines. The first level is the sparse directory: the
first line of every block, one directory per index file, and above it the first line of every
file. A lookup finds the file by binary search, then the block, reads the block by its range,
finds the line, and reads the record by its range.

Files go to the shared folder under names that hold the task attempt: only names that a
finished task returned are used, so a repeated or lost attempt leaves no trace in the result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import stored
from vintagelens.session import new_table_path

SMALLEST_SHARED = 1_000  # payload bytes from which equal payloads are stored once
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1_000
PART_LINES = 1_000_000  # captures of one index file
REGION_BYTES = 16 << 20  # stretch of an archive whose records one task reads
BATCH_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the profile of revisit records for identical payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``com,example)/path?query`` in lower case; ``-`` without a URL."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return "-"
    if host.startswith("www."):
        host = host[4:]
    name = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    key = f"{name}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")
    return "".join(c if c > " " else f"%{ord(c):02x}" for c in key.lower())


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url: str | None, payload: bytes, first, date: str = DATE) -> tuple[bytes, str]:
    """Bytes of a response or revisit record and its type; ``first`` is the page it revisits."""
    digest = hashlib.sha1(payload).digest()
    hexed, revisit = digest.hex(), first is not None and first != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, hexed)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http; msgtype=response", f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, hexed)}", f"Refers-To-Page-ID: {first}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", "revisit" if revisit else "response"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, dict[str, str]]:
    """Named fields, payload, and HTTP fields of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, payload, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """Files of a folder on any file system that a URI can name, kept open for further ranges."""

    def __init__(self, folder: str):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.system.create_dir(self.root)
        self.open: dict[str, pa.NativeFile] = {}

    def create(self, name: str):
        return self.system.open_output_stream(f"{self.root}/{name}", compression=None)

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.system.open_input_file(f"{self.root}/{name}")
        self.open[name].seek(offset)
        return self.open[name].read(length)


def _attempt(prefix: str) -> str:
    task = TaskContext.get()
    return f"{prefix}-{task.partitionId():06d}-{task.taskAttemptId()}" if task else prefix


CAPTURE_TYPE = "key string, page_id long, file string, offset long, length long"
CAPTURE_ARROW = pa.schema([
    ("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
])


def write(pages: DataFrame, folder: str, smallest_shared: int = SMALLEST_SHARED, date: str = DATE) -> DataFrame:
    """Archives of all pages in ``folder``; returns one row per capture: key, page, file and range.

    Reads page_id, url, html; other columns are left out. A null html is an empty payload, a
    null url has the key ``-``. Of equal payloads of at least ``smallest_shared`` bytes, that of
    the largest page_id is the response and the others revisit it; rows that repeat its page_id
    are responses too. No pages give no archives.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    # A small payload stands for itself: a key of its own keeps such rows spread over the tasks.
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    shared = F.length("payload") >= smallest_shared
    rows = rows.withColumn("digest", F.when(shared, F.sha1("payload")).otherwise(alone))
    known = rows.where(shared).groupBy("digest")
    firsts = known.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stamp = "".join(c for c in date if c.isdigit())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, number, at, stream = None, None, 0, 0, ""
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if out is None:
                    files = files or _Files(folder)
                    stream = f"{_attempt('part')}-{number:04d}.warc.gz"
                    out, at, number = files.create(stream), 0, number + 1
                data, _ = record(row["page_id"], row["url"], row["payload"], row["first"], date)
                member = _member(data)
                out.write(member)
                found.append((f"{url_key(row['url'])} {stamp}", row["page_id"], stream, at, len(member)))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if found:
                columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), CAPTURE_ARROW.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=CAPTURE_ARROW)
        if out is not None:
            out.close()

    joined = rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "first")
    return stored(joined.mapInArrow(run, CAPTURE_TYPE), "warc-captures")


@dataclass
class Index:
    folder: str
    directory: DataFrame  # part, line, file, offset, length: the first line of each block
    starts: list[tuple[str, str]]  # first line and name of each part, in order


def _line(key: Column, page_id: Column) -> Column:
    """Sorting by this text sorts by key, then by page; null pages come first."""
    shifted = (page_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string")
    return F.concat(key, F.lit(" "), F.coalesce(F.lpad(shifted, 20, "0"), F.lit("")))


def index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> Index:
    """Sorted, compressed index of the captures, written to ``folder``.

    Captures of one key are told apart by page, so that a frequent URL spreads over parts. There
    are as many parts as shuffle partitions, and more if these would exceed ``PART_LINES``.
    """
    spark = captures.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // PART_LINES))
    ordered = captures.withColumn("line", _line(F.col("key"), F.col("page_id"))).repartitionByRange(parts, "line").sortWithinPartitions("line")
    schema = pa.schema([("part", pa.string()), ("line", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, lines, first, found, name = None, 0, [], "", [], ""

        def close_block():
            nonlocal at, lines
            block = _member("\n".join(lines).encode())
            out.write(block)
            found.append({"part": name, "line": first, "file": name, "offset": at, "length": len(block)})
            at, lines = at + len(block), []

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{_attempt('index')}.cdx.gz"
                    out = _Files(folder).create(name)
                if not lines:
                    first = row["line"]
                lines.append("\t".join([row["line"], row["file"], str(row["offset"]), str(row["length"])]))
                if len(lines) == block_lines:
                    close_block()
        if out is not None:
            if lines:
                close_block()
            out.close()
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    kind = "part string, line string, file string, offset long, length long"
    directory = stored(ordered.select("line", "file", "offset", "length").mapInArrow(run, kind), "warc-directory")
    # One line per index file: one for some ``PART_LINES`` captures.
    starts = sorted((r.line, r.part) for r in directory.groupBy("part").agg(F.min("line").alias("line")).collect())
    return Index(folder, directory, starts)


RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
RECORD_TYPE = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _blocks(where: Index, asked: DataFrame) -> DataFrame:
    """Index blocks that may hold the asked lines: line, n, file, offset, length.

    The first level finds the part by binary search in the first lines of all parts. In a part
    the sparse directory and the lines are one sorted run: a line belongs to the last block that
    begins before it, and to every block that begins with it.
    """
    starts = where.directory.sparkSession.sparkContext.broadcast(where.starts)
    routed_to = pa.schema([("part", pa.string()), ("line", pa.string()), ("n", pa.int64())])

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [line for line, _ in starts.value]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = bisect.bisect_right(firsts, row["line"]) - 1
                if at >= 0:
                    out.append({**row, "part": starts.value[at][1]})
            yield pa.RecordBatch.from_pylist(out, schema=routed_to)

    routed = asked.mapInArrow(route, "part string, line string, n long")
    block = F.struct("file", "offset", "length")
    entries = where.directory.select("part", "line", F.lit(None).cast("long").alias("n"), block.alias("block"))
    run = routed.withColumn("block", F.lit(None).cast(entries.schema["block"].dataType)).unionByName(entries)
    # At equal lines the asked one comes first, so that its block is one that begins before it.
    before = Window.partitionBy("part").orderBy("line", F.col("block").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    inside = run.withColumn("before", F.last("block", ignorenulls=True).over(before)).where("n is not null and before is not null")
    begun = asked.join(where.directory.drop("part"), "line").select("line", "n", "file", "offset", "length")
    return inside.select("line", "n", "before.*").unionByName(begun)


def _find_lines(folder: str):
    """Place of the record and number of askings of each asked line that its block holds."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, loaded, held = _Files(folder), None, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                block = (row["file"], row["offset"], row["length"])
                if block != loaded:
                    raw = zlib.decompress(files.read(*block), 31).decode()
                    loaded, held = block, [x.split("\t") for x in raw.split("\n")]
                place = bisect.bisect_left(held, row["line"], key=lambda x: x[0])
                while place < len(held) and held[place][0] == row["line"]:
                    name, offset, length = held[place][1:]
                    out.append({"file": name, "offset": int(offset), "length": int(length), "n": row["n"]})
                    place += 1
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _read_records(archives: str, payloads: bool):
    """The records of the given ranges, in batches of at most ``BATCH_BYTES`` of payload."""

    def read(store: _Files, row: dict) -> dict:
        name, offset = row["file"], row["offset"]
        fields, payload, http = parse(zlib.decompress(store.read(name, offset, row["length"]), 31))
        kind, page, first = fields["WARC-Type"], fields["Page-ID"], fields.get("Refers-To-Page-ID")
        response = kind == "response"
        stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        digest = hashlib.sha1(payload).hexdigest() if response else stated
        if digest != stated:
            raise ValueError(f"{name} at {offset}: the payload does not have its digest")
        return {
            "page_id": int(page) if page else None, "url": fields["WARC-Target-URI"], "record_type": kind,
            "payload_bytes": len(payload) if response else int(http["Content-Length"]), "payload_digest": digest,
            "refers_to": int(first) if first else None, "payload": payload if payloads and response else None, "n": row["n"],
        }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, schema = _Files(archives), RECORD_ARROW.append(pa.field("n", pa.int64()))
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                out.append(read(store, row))
                held += len(out[-1]["payload"] or b"")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def lookup(where: Index, archives: str, wanted: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the wanted captures: ``key`` (with time) and ``page_id``, found by the index.

    Size and digest of a response are taken from the payload that was read, those of a revisit
    from its own fields; the digest is lower-case hex. A capture that the index does not hold
    gives no row, one that is asked for or held several times gives as many rows.

    Index blocks are dealt to the tasks one by one, and records by the region of the archive
    they lie in, so that a block is read once and no task holds more than a batch of records.
    """
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = wanted.withColumn("line", _line(F.col("key"), F.col("page_id").cast("long")))
    asked = asked.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("line is not null")
    blocks = _blocks(where, asked).repartition(tasks, "file", "offset").sortWithinPartitions("file", "offset", "line")
    ranges = blocks.mapInArrow(_find_lines(where.folder), "file string, offset long, length long, n long")
    region = F.floor(F.col("offset") / REGION_BYTES)
    ranges = ranges.repartition(tasks, F.col("file"), region).sortWithinPartitions("file", "offset")
    records = ranges.mapInArrow(_read_records(archives, payloads), RECORD_TYPE + ", n long")
    return records.withColumn("n", F.explode(F.expr("sequence(1L, n)"))).drop("n")


def new_folder(df: DataFrame, name: str) -> str:
    return new_table_path(df.sparkSession, name)
