"""JSON arrays of objects, read in as many tasks as their files have splits, and written as one array by many tasks.

Spark's text source cuts a file at closing braces and deals the stretches to tasks.  What a stretch means depends on whether it
begins in a string and how deep, so a first pass tells for each split what it does to either start (inside a string or
not) and to the depth; putting these together in order, a row a split, gives every split's true start.  A second
pass then cuts records.  A record that goes on in the next split comes in pieces, which are put together by its number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import _folder
from .shared import discarded, written

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_SPLIT = "file string, start long, after_out boolean, depth_out long, after_in boolean, depth_in long"


def _effect(stretch: str, inside: bool) -> tuple[bool, int]:
    """Whether the stretch and the brace that ends it leave a string open, and how they change the depth."""
    if inside:
        end = _REST_OF_STRING.match(stretch)
        if end is None:
            return True, 0
        stretch = stretch[end.end() :]
    bare = _STRING.sub("", stretch)
    open_ = bare.find('"')
    if open_ >= 0:
        bare = bare[:open_]
    depth = bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")
    return open_ >= 0, depth - (open_ < 0)


def _stretches(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split of this task."""
    sums: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, value in zip(*[c.to_pylist() for c in batch.columns]):
            state = sums.setdefault((file, start), [False, 0, True, 0])
            for i in (0, 2):
                state[i], more = _effect(value, state[i])
                state[i + 1] += more
    if sums:
        rows = [(*k, *v) for k, v in sums.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "start", "after_out", "depth_out", "after_in", "depth_in"), r)) for r in rows], schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("after_out", pa.bool_()), ("depth_out", pa.int64()), ("after_in", pa.bool_()), ("depth_in", pa.int64())]))


def _starts(splits: list) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """Each split's true start: in a string or not, the depth, and its number in order; an error for what isn't one array."""
    out, inside, depth, last = {}, False, 0, None
    for n, s in enumerate(sorted(splits, key=lambda s: (s["file"], s["start"]))):
        if s["file"] != last:
            _checked(last, inside, depth)
            inside, depth = False, 0
        out[s["file"], s["start"]] = (inside, depth, n)
        inside, more = (s["after_in"], s["depth_in"]) if inside else (s["after_out"], s["depth_out"])
        depth, last = depth + more, s["file"]
    _checked(last, inside, depth)
    return out


def _checked(file: str | None, inside: bool, depth: int) -> None:
    if file is not None and (inside or depth != -1):
        raise ValueError(f"{file} doesn't hold one whole JSON array of objects")


_PIECES = pa.schema([("file", pa.string()), ("split", pa.int64()), ("k", pa.int64()), ("begins", pa.bool_()), ("value", pa.string()), ("whole", pa.bool_())])


class _Cutter:
    """Cuts the stretches of one split after another into records and pieces of records."""

    def __init__(self, starts: dict[tuple[str, int], tuple[bool, int, int]]):
        self.starts, self.at, self.found = starts, None, []

    def begin(self, file: str, start: int) -> None:
        self.inside, self.depth, self.split = self.starts[file, start]
        self.at, self.parts, self.continued, self.k = (file, start), [], self.depth > 1, 0  # k: records begun here

    def emit(self, whole: bool) -> None:
        begins = not self.continued
        self.found.append((self.at[0], self.split, self.k, begins, "".join(self.parts), whole and begins))
        self.parts, self.continued, self.k = [], False, self.k + begins

    def end(self) -> None:
        if self.at is not None and self.parts:
            self.emit(False)

    def add(self, file: str, start: int, value: str) -> None:
        if self.at != (file, start):
            self.end()
            self.begin(file, start)
        if self.depth <= 1 and not self.inside:
            at = value.find("{")
            before = "".join((value if at < 0 else value[:at]).split())
            if before not in ((("[",) if self.depth == 0 else (",", "")) if at >= 0 else ("]", "[]")):
                raise ValueError(f"{file} doesn't hold one JSON array of objects: {before[:40]}")
            if at < 0:
                return  # what follows the last record
            self.depth, value = 1, value[at:]
        self.inside, more = _effect(value, self.inside)
        self.depth += more
        self.parts += [value, "}"]
        if self.depth == 1 and not self.inside:
            self.emit(True)

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.found), _PIECES.types)], schema=_PIECES)
        self.found = []
        return made


def _joined(pieces: DataFrame) -> DataFrame:
    """``file, split, k, value`` of the records that lie in several splits, of which a split has two pieces at most: the end of one, the beginning of another."""
    order = Window.partitionBy("file").orderBy("split", "begins").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.count_if("begins").over(order))
    in_order = F.array_sort(F.collect_list(F.struct("split", "k", "value")))
    return numbered.groupBy("file", "number").agg(in_order.alias("p")).select("file", "p.split", "p.k", F.array_join("p.value", "").alias("value")).select("file", F.get("split", F.lit(0)).alias("split"), F.get("k", F.lit(0)).alias("k"), "value")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, k, value``: the text of each record with the split that it begins in and its place there.

    The splits' starts, a row for each, are put together at the driver.  A file that isn't one whole array is an error.
    """
    stretches = _stretches(spark, path)
    held = spark.sparkContext.broadcast(_starts(stretches.mapInArrow(_summed, _SPLIT).collect()))

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(held.value)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                cutter.add(*row)
            if cutter.found:
                yield cutter.batch()
        cutter.end()
        if cutter.found:
            yield cutter.batch()

    pieces = stretches.mapInArrow(records, "file string, split long, k long, begins boolean, value string, whole boolean")
    return pieces.where("whole").select("file", "split", "k", "value").union(_joined(pieces.where("not whole")))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files (a file, or all of a folder) that hold one JSON array of objects each; absent keys are null."""
    return json_records(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")


def numbered_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``file, row`` (from 0 in each file) and the records of ``read_json_array``; splits are numbered by what those before them have."""
    found = json_records(spark, path)
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    starts = found.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n")).select("file", "split", F.coalesce(before, F.lit(0)).alias("before"))  # a row a split
    placed = found.join(starts, ["file", "split"])
    return placed.select("file", (F.col("before") + F.col("k")).alias("row"), F.from_json("value", schema).alias("r")).select("file", "row", "r.*")


def write_json_array(df: DataFrame, folder: str) -> None:
    """``df`` as one JSON array in parts: the files of the folder, put one after the other by name, are the array.

    Each task writes its own part.  The rows are written first, so that all know which comes first and last, and absent values are nulls.
    """
    spark = df.sparkSession
    table = written(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")), "rows")
    rows = table.withColumn("at", F.monotonically_increasing_id())
    first, last = rows.agg(F.min("at"), F.max("at")).first()
    if first is None:
        made = spark.createDataFrame([("[]",)], "value string")
    else:
        made = rows.select(F.concat(F.when(F.col("at") == first, "[").otherwise(","), F.col("value"), F.when(F.col("at") == last, "]").otherwise("")).alias("value"))
    made.write.mode("overwrite").text(folder)
    discarded(table)


def merged_file(spark: SparkSession, folder: str, path: str) -> None:
    """The parts of a folder as one file, by name, for readers that want one; it streams through a buffer of the driver's."""
    files, where = _folder(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    parts = sorted((s.getPath() for s in files.listStatus(where) if s.getPath().getName().startswith("part-") and s.getLen() > 0), key=lambda p: p.getName())
    out = files.create(target, True)
    try:
        for p in parts:
            into = files.open(p)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(into, out, 1 << 20, False)
            finally:
                into.close()
    finally:
        out.close()
