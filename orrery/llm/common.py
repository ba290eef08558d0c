"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import struct
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut at this many rows or bytes, whichever comes first, so
#: a worker's memory doesn't depend on how long the texts are.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that this session hands to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty) of every document."""
    return keyed_text(table(spark, sf_dir, "documents"))


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator needs; null text becomes empty."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def map_arrow(df: DataFrame, schema: str, rows: Callable[..., dict[str, list]], state: Callable[[], object] | None = None) -> DataFrame:
    """``rows`` turns each Arrow batch into columns; a map without a shuffle.  With ``state`` it is also given what that makes for each task."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_batches(df.sparkSession)
    arrow_schema = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = () if state is None else (state(),)
        for batch in batches:
            if batch.num_rows:
                columns = rows(batch, *held)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema)

    return df.mapInArrow(run, schema)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the actions run inside go as soon as their action ends; the session's own setting comes back after."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _own_folder(spark: SparkSession) -> str:
    """A folder of our own where the session names none, as in tests: only where driver and executors are one machine."""
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return Path(tempfile.mkdtemp(prefix="orrery-")).as_uri()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through ``spark.checkpoint.dir`` (shared by all executors)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark))
    with freed_shuffles(spark):
        return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder, where later scans take only some of its columns; ``discarded`` removes it."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discarded(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing reads any more."""
    for table in tables:
        removed_folder(table.sparkSession, table.written_to)


def framed(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed blob; they are taken as they lie in memory, not copied together first."""
    raw = [memoryview(a if isinstance(a, bytes) else np.ascontiguousarray(a).reshape(-1).view(np.uint8)) for a in arrays]
    pressed = zlib.compressobj(1)
    out = [pressed.compress(struct.pack(f"<{len(raw)}Q", *map(len, raw))), *map(pressed.compress, raw)]
    return b"".join([*out, pressed.flush()])


def frames_of(blob: bytes, n: int) -> list[memoryview]:
    """The ``n`` arrays of a blob of ``framed``."""
    data = memoryview(zlib.decompress(blob))
    at, out = 8 * n, []
    for size in struct.unpack(f"<{n}Q", data[: 8 * n]):
        out.append(data[at : at + size])
        at += size
    return out


def least_shared(per_cent: int, most: int) -> int:
    """How many tokens two different sets this alike share at least, or ``most`` if that is less: ``o`` of ``o + 1`` is the smallest case."""
    if not 1 <= per_cent <= 100:
        raise ValueError("the likeness must be 1 to 100 per cent")
    return next((o for o in range(1, most) if 100 * o >= per_cent * (o + 1)), most)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, for files that all executors see; it goes when the driver's JVM ends, or with ``removed_folder``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or _own_folder(spark)
    parent = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    files = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(parent)
    files.deleteOnExit(parent)
    return f"{parent.toString()}/data"


def removed_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``shared_folder`` that nothing reads any more."""
    parent = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    parent.getFileSystem(spark._jsc.hadoopConfiguration()).delete(parent, True)
