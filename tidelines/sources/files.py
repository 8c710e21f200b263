"""Stored files looked at from tasks: listing without contents, ranged and streamed reads, digests.

Spark lists a folder once and hands each task some paths; a task opens its files where they are and reads only the bytes
it asks for, a block at a time. So the cost of a look follows the number of files, files may have any size, and what
comes back to Spark is short rows. Storage that only Spark's own readers know is read whole, as binary values (up to
2 GB a file).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Schemes that tasks can open by themselves, and the name each has there.
RANGED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
BLOCK = 1 << 20
#: Text that a batch of documents holds at most, besides its last line.
BATCH = 4 << 20

FILES = "path string, length bigint, modificationTime timestamp"


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length and modificationTime of the files below a folder; contents are not read. Spark lists no files
    of length zero. A missing folder is empty."""
    try:
        return _binary(spark, path, glob).select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)


def _binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(path)


def has_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> bool | None:
    """Whether a folder holds such files; None if there is no folder."""
    try:
        return not _binary(spark, path, glob).select("path").limit(1).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ranged(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files below ``path`` themselves."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.getUri().getScheme() in RANGED


def open_uri(path: str) -> pa.NativeFile:
    """A file that can be read at any place, by the path that Spark lists it under."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        # Spark lists local files as file:/folder/name, without escapes.
        return fs.LocalFileSystem().open_input_file("/" + (rest or scheme).lstrip("/"))
    store, inside = fs.FileSystem.from_uri(f"{RANGED[scheme]}:{rest}")
    return store.open_input_file(inside)


def map_files(
    spark: SparkSession,
    path: str,
    glob: str,
    run: Callable[[str, pa.NativeFile], Iterator[pa.RecordBatch]],
    schema: str,
    only: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``schema`` that ``run`` makes of each file (its path and the open file). ``only`` (path) limits the files."""
    whole = not ranged(spark, path)
    files = _binary(spark, path, glob).select("path", *(["content"] if whole else []))
    if only is not None:
        files = files.join(only.select("path"), "path", "left_semi")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, name in enumerate(batch.column(0).to_pylist()):
                with pa.BufferReader(batch.column(1)[row].as_buffer()) if whole else open_uri(name) as file:
                    yield from run(name, file)

    return files.mapInArrow(each, schema)


def blocks(file: pa.NativeFile, size: int = BLOCK) -> Iterator[bytes]:
    while block := file.read(size):
        yield block


class Damaged(ValueError):
    """A stream that cannot be unpacked to its end."""


def unpacked(file: pa.NativeFile) -> Iterator[bytes]:
    """The contents of a gzip file, which may be several members one after the other, a block at a time."""
    member, seen = zlib.decompressobj(wbits=31), False
    try:
        for block in blocks(file):
            seen = True
            full = False
            while block or full:
                if member.eof:
                    block = block.lstrip(b"\0")  # zeros may fill up the last block of a tape or store
                    if not block:
                        break
                    member = zlib.decompressobj(wbits=31)
                part = member.decompress(block, BLOCK)
                if part:
                    yield part
                # With as much output as allowed there may be more, even if all input is used up.
                full = len(part) == BLOCK and not member.eof
                block = member.unused_data if member.eof else member.unconsumed_tail
    except zlib.error as error:
        raise Damaged(str(error)) from error
    if not seen:
        raise Damaged("empty file")
    if not member.eof:
        raise Damaged("truncated")


def lines(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Lines that are not blank. The rest after the last line break counts only if the parts end without an error."""
    held: list[bytes] = []
    for part in parts:
        *whole, rest = part.split(b"\n")
        for line in whole:
            full = b"".join([*held, line])
            held = []
            if full.strip():
                yield full
        held.append(rest)
    last = b"".join(held)
    if last.strip():
        yield last


TEXTS = "file_path string, text binary, reason string"


def read_lines(spark: SparkSession, path: str, glob: str, only: DataFrame | None = None) -> DataFrame:
    """file_path and text of each line of plain and gzip files, in one pass. A file that cannot be unpacked to its end
    gives the whole lines before the fault, and one row with the reason and no text."""

    def run(name: str, file: pa.NativeFile) -> Iterator[pa.RecordBatch]:
        texts: list[bytes | None] = []
        size, reason = 0, None

        def batch() -> pa.RecordBatch:
            reasons = [None if t is not None else reason for t in texts]
            columns = [pa.array([name] * len(texts), pa.string()), pa.array(texts, pa.binary()), pa.array(reasons, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["file_path", "text", "reason"])

        try:
            for line in lines(unpacked(file) if name.endswith(".gz") else blocks(file)):
                texts.append(line)
                size += len(line)
                if size > BATCH:
                    yield batch()
                    texts.clear()
                    size = 0
        except Damaged as error:
            reason = str(error)
            texts.append(None)
        if texts:
            yield batch()

    return map_files(spark, path, glob, run, TEXTS, only)


def digests(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path and md5 of each file, hashed a block at a time."""

    def run(name: str, file: pa.NativeFile) -> Iterator[pa.RecordBatch]:
        digest = hashlib.md5(usedforsecurity=False)
        for block in blocks(file):
            digest.update(block)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], names=["path", "md5"])

    return map_files(spark, path, glob, run, "path string, md5 string")


def delete(spark: SparkSession, uris: list[str]) -> None:
    """Delete files by the escaped addresses of ``_metadata.file_path``."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for uri in uris:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        path.getFileSystem(conf).delete(path, False)


def _folders(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.listStatus(folder) if files.exists(folder) else []
    return files, [status.getPath() for status in found if status.isDirectory()]


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that a Spark job has written to its end."""
    files, found = _folders(spark, path)
    return sorted(f.getName() for f in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS")))


def remove_folders(spark: SparkSession, path: str, unwanted: Callable[[str], bool]) -> None:
    """Delete the folders in ``path`` whose names are unwanted."""
    files, found = _folders(spark, path)
    for folder in found:
        if unwanted(folder.getName()):
            files.delete(folder, True)
