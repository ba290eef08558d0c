"""Shards of vectors and their metadata: NumPy files by ranges of rows, and JSON arrays by splits."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import CHUNKS
from .json_arrays import numbered_json_array

#: Bytes of a range, and rows of a batch.
RANGE, ROWS = 64 << 20, 4096


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI; a plain path is a local one."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Rows(InputPartition):
    """``n`` rows of an array file from byte ``at`` on, the first of them ``row``."""

    path: str
    shard: int
    row: int
    n: int
    at: int
    dtype: str
    width: int


def header(file) -> tuple[tuple[int, ...], bool, np.dtype, int]:
    """Shape, order, type and length of an array file's header."""
    read = {1: np.lib.format.read_array_header_1_0, 2: np.lib.format.read_array_header_2_0}
    shape, columns, dtype = read[np.lib.format.read_magic(file)[0]](file)
    return shape, columns, dtype, file.tell()


def planned(path: str, shard: int, file, most: int) -> list[Rows]:
    """The ranges of one file, of ``most`` bytes or a row."""
    shape, columns, dtype, at = header(file)
    if len(shape) != 2 or columns and shape[0] > 1 and shape[1] > 1:
        raise ValueError(f"{path} isn't an array of vectors stored row by row")
    size = max(1, shape[1] * dtype.itemsize)
    step = max(1, most // size)
    return [Rows(path, shard, a, min(step, shape[0] - a), at + a * size, dtype.str, shape[1]) for a in range(0, shape[0], step)]


class ShardReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.pattern, self.most = options["path"], options.get("pattern", "data_*.npy"), int(options.get("rangebytes", RANGE))

    def partitions(self) -> list[Rows]:
        store, root = opened(self.folder)
        names = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if fnmatch.fnmatch(f.base_name, self.pattern))
        out = []
        for shard, name in enumerate(names):
            with store.open_input_file(name) as file:
                out += planned(name, shard, file, self.most)
        return out

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.folder)
        dtype, p = np.dtype(partition.dtype), partition
        with store.open_input_file(p.path) as file:
            for a in range(0, p.n, ROWS):
                k = min(ROWS, p.n - a)
                size = p.width * dtype.itemsize
                data = np.frombuffer(file.read_at(k * size, p.at + a * size), dtype).astype(np.float32)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * p.width), pa.array(data))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, p.shard, np.int32)), pa.array(np.arange(p.row + a, p.row + a + k)), vectors], names=["shard", "row", "embedding"])


class ShardSource(DataSource):
    """``spark.read.format("array_shards")``: the vectors of all array files of a folder, ranges of them in a task."""

    @classmethod
    def name(cls) -> str:
        return "array_shards"

    def schema(self) -> str:
        return "shard int, row long, embedding array<float>"

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options)


def read_array_shards(spark: SparkSession, folder: str, pattern: str = "data_*.npy", range_bytes: int = RANGE) -> DataFrame:
    """``shard, row, embedding`` of NumPy files, the shards numbered by the order of their names; a task reads a range of rows."""
    spark.dataSource.register(ShardSource)
    return spark.read.format("array_shards").option("pattern", pattern).option("rangeBytes", range_bytes).load(folder)


def read_metadata_shards(spark: SparkSession, folder: str, schema: str = CHUNKS, pattern: str = "metadata_rank_*.json") -> DataFrame:
    """``shard, row`` and the columns of ``schema`` of files with one JSON array each, numbered like the vectors' files."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").orderBy("path")
    number = {r["path"]: i for i, r in enumerate(names.collect())}  # one name a file
    if not number:
        return spark.createDataFrame([], f"shard int, row long, {schema}")
    found = numbered_json_array(spark, f"{folder.rstrip('/')}/{pattern}", schema)
    plain = lambda p: F.regexp_replace(p, "^file:/+", "file:/")
    shards = spark.createDataFrame([(p, i) for p, i in number.items()], "path string, shard int")
    return found.join(F.broadcast(shards), plain(F.col("file")) == plain(F.col("path"))).select("shard", "row", *[c for c in found.columns if c not in ("file", "row")])
