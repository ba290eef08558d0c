"""Media columns: a data source over archives of members.

A folder holds archives (ZIP files of bounded size) and a list for each committed
write of those it made.  Reading plans byte ranges over the archives: a task takes
the members whose header starts in its range, looks each up in the archive's
directory, and streams payloads in Arrow batches of bounded size.  A
member whose read fails is read again by its own offset, from a newly opened
file, without repeating the others; a member that keeps failing fails the task
(nothing is skipped).

A text is stored as an 8-bit mono WAV: one sample per byte of UTF-8, padded
with zeros to a positive multiple of 64.  Null texts count as empty, and equal
texts make equal members whatever their ids.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import BATCH_BYTES, BATCH_ROWS, bounded_batches, documents, keyed_text, map_arrow, shared_folder

ARCHIVE_BYTES, RANGE_BYTES, TRIES = 32 << 20, 8 << 20, 4
#: Partitions of a read at most; their ranges grow with the input beyond that.
MOST_RANGES = 1 << 16
PAD, RATE = 64, 8000
#: Each write adds a list of its archives under this name.
MANIFEST = "_archives-"
SCHEMA = "doc_id long, n_bytes long, media binary"


def payload(text: str) -> tuple[int, bytes]:
    """Unpadded length and the padded UTF-8 bytes of a text."""
    data = text.encode("utf-8")
    return len(data), data + bytes(-len(data) % PAD if data else PAD)


def wav(samples: bytes) -> bytes:
    """An 8-bit mono WAV file of the samples (RIFF, ``fmt `` and ``data`` chunks)."""
    n = len(samples)
    return b"RIFF" + struct.pack("<I", (36 + n + (n & 1)) & 0xFFFFFFFF) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", n) + samples + bytes(n & 1)


def samples(media: bytes) -> bytes:
    """The sample bytes of a WAV file, found by walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if name == b"data":
            return media[at + 8 : at + 8 + n]
        at += 8 + n + (n & 1)
    raise ValueError("a WAV file without data")


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class Written(WriterCommitMessage):
    archives: list[tuple[str, int]]


@dataclass
class ByteRange(InputPartition):
    """Stretches ``(archive, low, high)`` of archives; a stretch takes the members whose header starts in it."""

    stretches: list[tuple[str, int, int]]


def manifests(store: fs.FileSystem, root: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith(MANIFEST))


def planned(archives: list[tuple[str, int]], most: int | None = None) -> list[ByteRange]:
    """Ranges of about equal bytes over all archives, in order, ``most`` at most: large archives are cut, small ones share a range."""
    size = max(RANGE_BYTES, -(-sum(n for _, n in archives) // (most or MOST_RANGES)))
    out: list[ByteRange] = []
    room = 0
    for name, n in archives:
        low = 0
        while low < n:
            if not room:
                out.append(ByteRange([]))
                room = size
            high = min(n, low + room)
            out[-1].stretches.append((name, low, high))
            room -= high - low
            low = high
    return out


class ArchiveWriter(DataSourceArrowWriter):
    """Rows of ``doc_id, n_bytes, media`` to archives; a task buffers one archive at most.

    The archives of a committed write join those that are there, or take their place if it overwrites.
    """

    def __init__(self, folder: str, overwrite: bool = False):
        self.folder, self.overwrite = folder, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _filesystem(self.folder)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        buffer, archive, members = io.BytesIO(), None, 0

        def finish() -> None:
            nonlocal buffer, archive, members
            if archive is not None:
                archive.close()
                name = f"{uuid.uuid4().hex}.zip"
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(buffer.getbuffer())
                done.append((name, buffer.getbuffer().nbytes))
            buffer, archive, members = io.BytesIO(), None, 0

        for batch in iterator:
            for doc_id, n_bytes, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if archive is None:
                    archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=4)
                info = zipfile.ZipInfo(f"{members}.wav")
                info.compress_type = zipfile.ZIP_DEFLATED
                info.comment = json.dumps([doc_id, n_bytes]).encode()
                archive.writestr(info, media.as_py())
                members += 1
                if buffer.tell() >= ARCHIVE_BYTES:
                    finish()
        finish()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _filesystem(self.folder)
        store.create_dir(root, recursive=True)
        before = manifests(store, root) if self.overwrite else []
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([x for m in messages if m for x in m.archives]).encode())
        for path in before:
            store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _filesystem(self.folder)
        for m in messages:
            for name, _ in m.archives if m else []:
                store.delete_file(f"{root}/{name}")


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[ByteRange]:
        store, root = _filesystem(self.folder)
        archives: list[tuple[str, int]] = []
        for path in manifests(store, root):
            with store.open_input_stream(path) as f:
                archives += map(tuple, json.loads(f.read()))
        return planned(archives)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], []]
        size = 0
        for name, low, high in partition.stretches if partition else []:  # no partition: an empty folder
            with retried(lambda: directory(self.folder, name)) as archive:
                for info in archive.infolist():
                    if not low <= info.header_offset < high:
                        continue
                    doc_id, n_bytes = json.loads(info.comment)
                    media = member(self.folder, name, archive, info)
                    for column, value in zip(columns, (doc_id, n_bytes, media)):
                        column.append(value)
                    size += len(media)
                    if size >= BATCH_BYTES or len(columns[0]) >= BATCH_ROWS:
                        yield _batch(columns)
                        columns, size = [[], [], []], 0
        if columns[0]:
            yield _batch(columns)


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["doc_id", "n_bytes", "media"])


def opened(folder: str, name: str):
    store, root = _filesystem(folder)
    return store.open_input_file(f"{root}/{name}")


def directory(folder: str, name: str) -> zipfile.ZipFile:
    """An archive with its directory, which opening it reads."""
    return zipfile.ZipFile(opened(folder, name))


def retried(attempt, tries: int = TRIES, wait: float = 0.2):
    for i in range(tries):
        try:
            return attempt()
        except (OSError, EOFError, zipfile.BadZipFile, zlib.error):
            if i == tries - 1:
                raise
            time.sleep(wait * 2**i)


def member(folder: str, name: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> bytes:
    """One member's bytes, checked by its CRC; retried alone, by offset, from a fresh file."""
    try:
        return archive.read(info)
    except (OSError, EOFError, zipfile.BadZipFile, zlib.error):

        def again() -> bytes:
            with zipfile.ZipFile(opened(folder, name)) as fresh:
                return fresh.read(info)

        return retried(again)


class ArchiveSource(DataSource):
    """``format("media_archive")``: ``doc_id long, n_bytes long, media binary``."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], overwrite)


def store(df: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write every text of ``df`` as a member under ``folder``; return the members read back."""
    spark = df.sparkSession
    spark.dataSource.register(ArchiveSource)

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        made = [payload(t.as_py()) for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "n_bytes": [n for n, _ in made], "media": [wav(p) for _, p in made]}

    map_arrow(keyed_text(df, key, text), SCHEMA, rows).write.format("media_archive").mode("append").save(folder)
    return read(spark, folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    bounded_batches(spark)
    return spark.read.format("media_archive").load(folder)


def feature(data: bytes) -> str:
    """Mean, deviation, root mean square, zero crossings (about 128) and entropy of the samples."""
    x = np.frombuffer(data, np.uint8)
    counts = np.bincount(x, minlength=256)
    p = counts[counts > 0] / len(x)
    level = np.arange(256)
    mean = float(counts @ level) / len(x)
    square = float(counts @ (level * level)) / len(x)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"{mean:.6f};{max(0.0, square - mean * mean) ** 0.5:.6f};{square**0.5:.6f};{crossings};{float(-(p * np.log2(p)).sum()) + 0.0:.6f}"


def features(members: DataFrame) -> DataFrame:
    """Digests and features of stored members, from the bytes read back."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for value in batch.column("media"):
            media = value.as_py()
            data = samples(media)
            for k, v in zip(out, (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), feature(data))):
                out[k].append(v)
        return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), **out}

    return map_arrow(members, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows)


def op5_media_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(store(documents(spark, sf_dir), shared_folder(spark, "media")))
