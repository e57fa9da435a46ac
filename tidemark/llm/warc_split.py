"""WARC archives: records written through Spark, read back by a splittable reader.

Writing. Of records with equal payloads of at least ``min_revisit`` bytes, the one with the
smallest id becomes a ``response`` and the others ``revisit`` records that refer to it. Digests
that occur more than once are pre-aggregated on the map side and written. The
``broadcast_rows`` commonest are broadcast, so revisits lose their payload in the scan; only
if there are more does a page move, by its digest, and then no digest left has more than
one in ``broadcast_rows`` of the pages. Every record is its own gzip member. Tasks pack members into byte strings of about ``chunk_bytes`` and Spark's text
writer stores those unchanged (Latin-1 separators), so the archives reach any store that
Spark can write, under its commit protocol: a lost executor leaves no partial file. The
writer demands a separator; an empty gzip member serves, so each file is plain
multi-member gzip.

Reading. Files are cut into byte ranges without any index, which are dealt to tasks of at
most about ``TASK_BYTES``. A task scans each range for the gzip magic, decompresses the head of each candidate member and takes it for a
record only if a WARC header follows; false magics inside compressed data fail that test. A
range owns the records that *start* in it and is read past its end to finish the last
one, so every record is read exactly once whatever the range size. Memory is bounded by a
record plus a read buffer. Where executors have no random access to the store, whole files
of at most ``WHOLE_FILE_BYTES`` are scanned the same way; larger ones raise an error.

Edge cases: null html is an empty payload; a null URL writes no target; control characters
in a URL are percent-encoded; a null id is written as such and read back as null; rows that
repeat the smallest id are all responses; small payloads are always responses; an empty
table gives an empty archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.session import cut, scratch_path, spread, table

MAGIC = b"\x1f\x8b\x08"
#: A gzip member without content.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" + "0300" + "00" * 8)
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT = 100
CHUNK_BYTES = 1 << 20
SPLIT_BYTES = 8 << 20
TASK_BYTES = 1 << 30
WHOLE_FILE_BYTES = 64 << 20
#: Digests that are broadcast at most: 32 bytes and an id each.
BROADCAST_ROWS = 200_000
READ_BYTES = 1 << 18
HEAD_BYTES = 512
LEVEL = 3

RECORDS = "record_type string, record_id string, page_id bigint, target_uri string, refers_to bigint, declared_digest string, declared_bytes bigint, payload binary"


def member(data: bytes) -> bytes:
    """One gzip member, without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _uri(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, html: bytes, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """A response or revisit record, uncompressed."""
    name = "none" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + html
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Bytes: {size}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def mark_revisits(rows: DataFrame, min_revisit: int = MIN_REVISIT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds first (the response's id) and again (whether the row revisits it), and empties the body of revisits.

    ``rows`` has id, body, digest (binary) and size.
    """
    long = rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = cut(long.where("n > 1 and first is not null"), "digests")
    more = firsts.count() > broadcast_rows
    common = firsts.orderBy(F.desc("n"), "digest").limit(broadcast_rows) if more else firsts

    def joined(left: DataFrame, known: DataFrame) -> DataFrame:
        own = known.select(F.col("digest").alias("__digest"), F.col("first").alias("__first"))
        # a settled row keeps its answer and is dealt by its id, so that no digest gathers them
        key = F.when(F.col("first").isNull(), F.col("digest")).otherwise(F.col("id").cast("string").cast("binary"))
        made = left.withColumn("__key", key).join(own, F.col("__key") == F.col("__digest"), "left")
        made = made.withColumn("first", F.coalesce("first", F.when(F.col("size") >= min_revisit, F.col("__first")))).drop("__key", "__digest", "__first")
        again = F.coalesce(~F.col("first").eqNullSafe(F.col("id")) & F.col("first").isNotNull(), F.lit(False))
        return made.withColumn("again", again).withColumn("body", F.when(again, F.lit(b"")).otherwise(F.col("body")))

    marked = joined(rows.withColumn("first", F.lit(None).cast("bigint")), F.broadcast(common))
    return joined(marked, firsts) if more else marked


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = MIN_REVISIT, broadcast_rows: int = BROADCAST_ROWS
) -> None:
    """Write one record per page under ``path``."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = spread(bounded_batches(pages).select(F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("body")))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("body", 256)), "size": F.octet_length("body").cast("bigint")})
    marked = mark_revisits(rows, min_revisit, broadcast_rows)
    marked = marked.select("id", "url", "body", F.lower(F.hex("digest")).alias("digest"), "size", "first", "again")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                page_id, target, data, digest, length, first, revisit = (v.as_py() for v in values)
                held.append(member(record(page_id, target, data, digest, length, first, revisit)))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["members"])

    packed = marked.mapInArrow(pack, "members binary").select(F.col("members").cast("string"))
    packed.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


class Window:
    """Random access to a byte source through one growing, forward-moving buffer."""

    def __init__(self, read: Callable[[int, int], bytes], size: int) -> None:
        self.read, self.size = read, size
        self.base, self.data = 0, b""

    def bytes(self, at: int, count: int) -> bytes:
        stop = min(at + count, self.size)
        if at < self.base or stop > self.base + len(self.data):
            self.base, self.data = at, self.read(at, min(max(count, READ_BYTES), self.size - at))
        return self.data[at - self.base : stop - self.base]


def _decode_member(source: Window, at: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at ``at`` if it holds a WARC record, else None."""
    unpack = zlib.decompressobj(31)
    parts: list[bytes] = []
    got, where = 0, at
    want = HEAD_BYTES
    try:
        while not unpack.eof:
            raw = source.bytes(where, want)
            if not raw:
                return None  # cut off: no valid member
            out = unpack.decompress(raw)
            parts.append(out)
            got += len(out)
            where += len(raw)
            if got >= len(VERSION) or unpack.eof:
                if not b"".join(parts[:2])[: len(VERSION)].startswith(b"WARC/"):
                    return None
            want = READ_BYTES
    except zlib.error:
        return None
    return b"".join(parts), where - len(unpack.unused_data)


def _parse(content: bytes) -> tuple | None:
    """The fields of ``RECORDS``, or None if the header is malformed."""
    head, split, block = content.partition(b"\r\n\r\n")
    if not split:
        return None
    fields: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    block = block[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]

    def number(name: str) -> int | None:
        digits = fields.get(name, "").rpartition(":")[2].rstrip(">")
        return int(digits) if digits.lstrip("-").isdigit() else None

    kind = fields["warc-type"]
    return (
        kind,
        fields.get("warc-record-id"),
        number("warc-record-id"),
        fields.get("warc-target-uri"),
        number("warc-refers-to"),
        fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
        number("x-payload-bytes"),
        None if kind == "revisit" else payload,
    )


def scan_range(read: Callable[[int, int], bytes], size: int, start: int, stop: int) -> Iterator[tuple]:
    """The records whose members start in [start, stop), wherever they end."""
    source = Window(read, size)
    at = start
    while at < stop:
        block = source.bytes(at, READ_BYTES + len(MAGIC) - 1)
        hit = block.find(MAGIC)
        if hit < 0:
            at += max(1, len(block) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= stop:
            return
        decoded = _decode_member(source, at)
        found = _parse(decoded[0]) if decoded else None
        if found is None:
            at += 1
            continue
        yield found
        at = decoded[1]


def _opened(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:") :]
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _reachable(path: str) -> bool:
    """Whether tasks can open the store by themselves."""
    try:
        fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        return True
    except (OSError, ValueError, pa.ArrowInvalid):
        return False


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [part.strip().split(" ")[0] for part in RECORDS.split(",")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _batches(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for one in records:
        held.append(one)
        size += len(one[-1] or b"") + 300
        if size >= 4 * CHUNK_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records under ``path`` with the columns of ``RECORDS``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    sizes = files.agg(F.sum("length"), F.max("length"), F.sum(F.ceil(F.col("length") / split_bytes))).first()
    if not _reachable(path):
        if (sizes[1] or 0) > WHOLE_FILE_BYTES:
            raise RuntimeError(f"tasks can't open ranges of {path}, and a file of {sizes[1]} bytes is too large to be read whole")

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for value in batch.column(0):
                    data = value.as_py()
                    yield from _batches(scan_range(lambda at, n, data=data: data[at : at + n], len(data), 0, len(data)))

        return files.select("content").mapInArrow(whole, RECORDS)

    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    at_least = max(4 * spark.sparkContext.defaultParallelism, -(-(sizes[0] or 0) // TASK_BYTES))
    tasks = max(1, min(at_least, sizes[2] or 0))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _opened(name) as file:
                    yield from _batches(scan_range(lambda at, n, file=file: file.read_at(n, at), size, start, min(size, start + split_bytes)))

    return ranges.repartition(tasks).mapInArrow(scan, RECORDS)


def digest_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def round_trip(pages: DataFrame, path: str, split_bytes: int = SPLIT_BYTES, **columns) -> DataFrame:
    """Write the pages as archives under ``path`` and judge what the reader finds there."""
    write_archives(pages, path, **columns)
    found = read_archives(pages.sparkSession, path, split_bytes)
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("declared_digest")).otherwise(F.sha2("payload", 256))
    return found.select(
        "page_id",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.octet_length("payload").cast("bigint")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        "refers_to",
        (digest == F.col("declared_digest")).alias("intact"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_path(spark, "warc"))


ORACLE = f"""
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND first <> page_id THEN first END AS refers_to,
       true AS intact
FROM firsts"""
