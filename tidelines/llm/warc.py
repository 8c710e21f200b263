"""WARC archives of web pages, compressed record by record with a Zstandard dictionary of their own (.warc.zst).

An archive holds about ``ARCHIVE_BYTES`` of records. A dictionary is trained on records spread over the whole archive
and stands, compressed itself, in a leading skippable frame; then each record is one frame, so a reader can begin at any
of them. Tools for such archives, and plain ``zstd`` given the dictionary, read them.

A page is written as a ``response``: an HTTP head and the payload. Of the pages with equal payloads of at least
``SHARED`` bytes only the one with the smallest id is; the others are ``revisit`` records that refer to it and hold the
head alone. Equality is by SHA-256. Only digests and ids are shuffled to find them, summed up in tasks first, so a
payload that a third of all pages share costs no more than others; its pages stay where they are.

A null payload is the empty one. A null id comes after all others; it is the response only where no equal payload has an
id, and ``refers_to`` is then null. Of rows that repeat an id and its payload one, of the smallest url, is the response
and the others revisit it. Very long payloads are one record, and one archive if they fill it. Without pages there is
no archive. Bytes that are no UTF-8 are kept. Blanks, control and other characters beyond ASCII in a url are written
percent-encoded; a page without url gets ``urn:x-page:`` and its id.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelines.llm.common import staged

SHARED = 100
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of records that a dictionary learns from, in pieces of one record each, spread evenly over the archive.
SAMPLE_BYTES, PIECE_BYTES = 2 << 20, 16 << 10
#: Digests of repeated payloads travel to all tasks up to this many (some 40 MB), and are joined by shuffle beyond.
DIGESTS = 400_000

# Fixed values of the formats: the skippable frame of a dictionary, the start of a dictionary, the start of a frame.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_START = 0xEC30A437
FRAME_START = 0xFD2FB528
#: A skippable frame without content. Spark's text writer ends a row with it instead of a line break.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6f0c1c52-3ad0-4f37-9d4b-6a8a1d9b6f11")


def _sized(small: DataFrame, limit: int) -> DataFrame:
    """A table to join with, broadcast only if it was counted and is small."""
    return F.broadcast(small) if small.count() <= limit else small


def _bytes(payload: str) -> Column:
    return F.coalesce(F.col(payload).cast("binary"), F.lit(b""))


def with_types(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """id, url, payload (binary), digest, type and refers_to of each row, under these names."""
    plain = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), _bytes(payload).alias("payload"))
    rows = plain.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    per_id = rows.filter(F.octet_length("payload") >= SHARED).groupBy("digest", "id").agg(F.count(F.lit(1)).alias("c"))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "c")).alias("f")
    sums = per_id.groupBy("digest").agg(F.sum("c").alias("n"), first).filter("n > 1")
    # Repeated payloads only: for most tables a small part of its digests.
    shared = staged(sums.select(F.col("digest").alias("of"), F.col("f.id").alias("first"), (F.col("f.c") > 1).alias("tied")), "digests")
    joined = rows.join(_sized(shared, DIGESTS), rows["digest"] == shared["of"], "left")
    earliest = F.col("id").eqNullSafe(F.col("first"))
    kind = F.when(F.col("of").isNull() | earliest, "response").otherwise("revisit").alias("type")
    tied = F.coalesce(F.col("tied") & earliest, F.lit(False))
    out = joined.filter(~tied).select("id", "url", "payload", "digest", kind, F.when(F.col("of").isNotNull() & ~earliest, F.col("first")).alias("refers_to"))
    if shared.filter("tied").isEmpty():
        return out
    return out.unionByName(_tied(joined.filter(tied)))


def _tied(rows: DataFrame) -> DataFrame:
    """Rows that repeat an id and its payload: one response each, rebuilt from counts per url."""
    counted = rows.groupBy("digest", "id", "url").agg(F.count(F.lit(1)).alias("c"), F.any_value("payload").alias("payload"))
    order = F.struct(F.col("url").isNull().alias("no"), "url")
    first = staged(counted.groupBy(F.col("digest").alias("of")).agg(F.min(order)["url"].alias("least")), "tied")
    marked = counted.join(_sized(first, DIGESTS), F.col("digest") == F.col("of"))
    each = marked.select("*", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("k"))
    response = (F.col("k") == 1) & F.col("url").eqNullSafe(F.col("least"))
    kind = F.when(response, "response").otherwise("revisit").alias("type")
    return each.select("id", "url", "payload", "digest", kind, F.when(~response, F.col("id")).alias("refers_to"))


def _target(url: bytes | None, page: str | None) -> str:
    if url is None:
        return f"urn:x-page:{quote(page or '', safe='')}"
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _named(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, '|'.join(map(str, parts)))}>"


def page_record(page: str | None, url: bytes | None, payload: bytes, digest: str, kind: str, refers_to: str | None, date: str, place: str) -> bytes:
    """One record. ``place`` makes the id of a record unique; a response that others may refer to is named by its digest."""
    shared = kind == "response" and len(payload) >= SHARED
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = kind == "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _named(digest) if shared else _named(page, digest, place)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _target(url, page)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _named(digest) if revisit else None),
        ("X-Page-ID", None if page is None else quote(page, safe="")),
        ("X-Refers-To-Page-ID", None if refers_to is None else quote(refers_to, safe="")),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(fields, http if revisit else http + payload)


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A dictionary of records: trained where there are enough of them, else their own bytes."""
    step = max(1, sum(min(len(r), PIECE_BYTES) for r in records) // SAMPLE_BYTES)
    pieces = [r[:PIECE_BYTES] for r in records[::step]]
    # zstandard fails on few or very small samples; a dictionary of raw content does as well then.
    if len(pieces) >= 8 and sum(map(len, pieces)) >= 8 * 1024:
        try:
            return zstandard.train_dictionary(min(size, sum(map(len, pieces)) // 4), pieces)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(pieces)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 3) -> bytes:
    """The bytes of one archive."""
    learned = dictionary(records)
    learned.precompute_compress(level=level)
    body = zstandard.ZstdCompressor(level=19).compress(learned.as_bytes())
    pack = zstandard.ZstdCompressor(level=level, dict_data=learned, write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(body)), body, *map(pack.compress, records)])


def _archives(batches: Iterator[pa.RecordBatch], date: str, limit: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    records, held, number = [], 0, 0

    def closed() -> pa.RecordBatch:
        info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _named(part, number, date)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        return pa.RecordBatch.from_arrays([pa.array([archive([info, *records])], pa.binary())], names=["content"])

    for batch in batches:
        for row, payload in enumerate(batch.column(2)):
            page, url, digest, kind, refers_to = (batch.column(i)[row].as_py() for i in (0, 1, 3, 4, 5))
            records.append(page_record(page, url, payload.as_py(), digest.hex(), kind, refers_to, date, f"{part}-{number}-{len(records)}"))
            held += len(records[-1])
            if held >= limit:
                yield closed()
                records, held, number = [], 0, number + 1
    if records:
        yield closed()


def write_archives(typed: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write rows of ``with_types`` as archives below ``path``, a file each, without a shuffle.

    Spark's own writer commits them, so a task that is run again leaves nothing twice, in any storage Spark knows. Its
    text format puts an empty frame after each archive, which every Zstandard reader passes over.
    """
    text = lambda c: F.col(c).cast("string").alias(c)
    rows = typed.select(text("id"), F.col("url").cast("binary").alias("url"), "payload", "digest", "type", text("refers_to"))
    made = rows.mapInArrow(lambda batches: _archives(batches, date, archive_bytes), "content binary")
    made.select(F.col("content").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)
    _rename(typed.sparkSession, path)


def _rename(spark: SparkSession, path: str) -> None:
    """Give the committed files the extension readers look for; contents stay where they are."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part-") and name.endswith(".txt"):
            files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.zst"))


def frames(content: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, frame) of each frame and skippable frame. Raises ValueError where the file is cut or no such file."""
    at = 0
    while at < len(content):
        start = at
        if len(content) - at < 8:
            raise ValueError(f"cut at byte {at}")
        magic, size = struct.unpack_from("<II", content, at)
        if magic & 0xFFFFFFF0 == DICTIONARY_FRAME & 0xFFFFFFF0:
            at += 8 + size
        elif magic == FRAME_START:
            check = zstandard.get_frame_parameters(content[at : at + 18]).has_checksum
            at += zstandard.frame_header_size(content[at : at + 18])
            last = 0
            while not last:
                if at + 3 > len(content):
                    raise ValueError(f"cut at byte {at}")
                head = int.from_bytes(content[at : at + 3], "little")
                last, kind, size = head & 1, head >> 1 & 3, head >> 3
                # A block of one repeated byte holds just that byte.
                at += 3 + (1 if kind == 1 else size)
            at += 4 * check
        else:
            raise ValueError(f"no frame at byte {at}")
        if at > len(content):
            raise ValueError(f"cut at byte {start}")
        yield start, content[start:at]


def records(content: memoryview) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields with lower-case names, block) of each record of an archive."""
    unpack = zstandard.ZstdDecompressor()
    for at, frame in frames(content):
        magic = struct.unpack_from("<I", frame)[0]
        if magic == DICTIONARY_FRAME and at == 0:
            body = bytes(frame[8:])
            if body[:4] == struct.pack("<I", FRAME_START):
                body = unpack.decompress(body)
            kind = zstandard.DICT_TYPE_FULLDICT if body[:4] == struct.pack("<I", DICTIONARY_START) else zstandard.DICT_TYPE_RAWCONTENT
            unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body, dict_type=kind))
        elif magic == FRAME_START:
            raw = unpack.decompress(frame)
            head, _, rest = raw.partition(b"\r\n\r\n")
            version, *lines = head.decode("utf-8", "replace").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"no record at byte {at}")
            fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
            yield at, fields, rest[: int(fields["content-length"])]


READ = "file string, offset long, record_id string, type string, target_uri string, page string, refers_to_page string, payload_digest string, payload_bytes long, payload binary"


def _id(text: str | None) -> str | None:
    return None if text is None else unquote(text)


def _read(name: str, content: bytes, with_payload: bool) -> Iterator[tuple]:
    for at, fields, block in records(memoryview(content)):
        if fields.get("warc-type") not in ("response", "revisit"):
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
        size, digest = int(http.get(b"content-length", len(payload))), fields.get("warc-payload-digest", "").removeprefix("sha256:")
        if fields["warc-type"] == "response":
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{name}: the payload at byte {at} does not have its digest")
        yield (name, at, fields.get("warc-record-id"), fields["warc-type"], fields.get("warc-target-uri"), _id(fields.get("x-page-id")), _id(fields.get("x-refers-to-page-id")), digest, size, payload if with_payload else None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The page records of all archives below ``path``. Payloads of responses are held against their digests, frames
    against their checksums; a damaged archive is an error. Sizes of revisited payloads come from their HTTP heads."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = list(_read(name.as_py(), content.as_py(), with_payload))
                if rows:
                    columns = zip(*rows)
                    kinds = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in READ.split(", ")])

    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], READ)
    return files.select("path", "content").mapInArrow(run, READ)
