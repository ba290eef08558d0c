"""Files in and out: link lists, JSON arrays, directories of raw files, versioned tables."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The record schemas.
LINKS = "url STRING"
ARTICLES = "filename STRING, abstract_text STRING, text STRING, text_source STRING"
CHUNKS = "filename STRING, chunk_index INT, text STRING"
ARTICLES_QA = ARTICLES + ", qa STRUCT<question: STRING, answer: STRING>, context ARRAY<STRING>"
ANSWERS = "question STRING, reference_answer STRING, model_answer STRING, model STRING"


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a headerless CSV."""
    return spark.read.schema(LINKS).csv(path, header=False)


def append_links(links: DataFrame, path: str) -> None:
    links.select("url").write.mode("append").csv(path, header=False)


def list_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """``path`` of the files with an extension, in either case; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path").where(F.lower("path").endswith("." + extension.lower()))


def read_files(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.where(F.lower("path").endswith("." + extension.lower())).select("path", "content")


def suffixed(path: str, suffix: str) -> str:
    """``path`` with ``_suffix`` before its extension, which begins at the last dot of the file name."""
    folder, slash, name = path.rpartition("/")
    base, dot, extension = name.rpartition(".")
    return f"{folder}{slash}{base}_{suffix}.{extension}" if dot else f"{path}_{suffix}"


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where)


def removed(spark: SparkSession, path: str, really: bool = False) -> bool:
    """Remove a folder of temporary files, only when asked to; whether it went."""
    files, where = _folder(spark, path)
    return bool(really and files.delete(where, True))


class Versioned:
    """A table under ``root`` that is updated by writing a new version beside the one being read.

    A version counts once its number's file is in the log; a number is taken by creating
    that file, which one writer only can do, and readers take the last one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, df: DataFrame) -> str:
        path = f"{self.root}/v-{uuid.uuid4().hex}"
        df.write.parquet(path)
        n = max(self._versions(), default=0)
        while True:
            n += 1
            files, where = _folder(self.spark, f"{self.root}/log/{n:012d}")
            if files.exists(where):
                continue
            try:
                out = files.create(where, False)
            except Exception:
                if not files.exists(where):
                    raise
                continue  # another writer was first
            out.write(path.encode())
            out.close()
            return path

    def read(self) -> DataFrame:
        """The last version; one whose writer hasn't finished naming it is passed over."""
        for n in sorted(self._versions(), reverse=True):
            path = "".join(r["value"] for r in self.spark.read.text(f"{self.root}/log/{n:012d}").collect())
            if path:
                return self.spark.read.parquet(path)
        raise FileNotFoundError(f"no version under {self.root}")

    def _versions(self) -> list[int]:
        files, where = _folder(self.spark, f"{self.root}/log")
        return [int(s.getPath().getName()) for s in files.listStatus(where)] if files.exists(where) else []


def write_split(df: DataFrame, path: str) -> None:
    """One folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def _nodes(tree) -> list:
    """A JVM tree's nodes."""
    out, open_ = [], [tree]
    while open_:
        node = open_.pop()
        out.append(node)
        children = node.children()
        open_ += [children.apply(i) for i in range(children.length())]
    return out


def plan_key(df: DataFrame, also: str = "") -> str:
    """A digest of what ``df`` computes: its analysed plan, the Python functions in it, and its input files with their sizes and times.

    Rows that the driver holds are told by their values; a plan over an RDD has no key, so it is an error.
    """
    spark = df.sparkSession
    option, plan = "spark.sql.debug.maxToStringFields", df._jdf.queryExecution().analyzed()
    before = spark.conf.get(option)
    spark.conf.set(option, "1000000")  # the plan's text is to be whole
    try:
        told = [also, plan.canonicalized().toString()]
    finally:
        spark.conf.set(option, before)
    for node in _nodes(plan):
        kind = node.getClass().getSimpleName()
        if kind == "LogicalRDD":
            raise ValueError("a plan over an RDD has no key")
        if kind == "LocalRelation":
            told.append(str(node.data().hashCode()))
        expressions = node.expressions()
        for e in (x for i in range(expressions.length()) for x in _nodes(expressions.apply(i))):
            if e.getClass().getSimpleName() in ("PythonUDF", "PythonUDAF"):
                told.append(f"{e.name()} {e.func().command().hashCode()}")
    for name in sorted(df.inputFiles()):
        files, where = _folder(spark, name)
        status = files.getFileStatus(where)
        told.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\0".join(told).encode()).hexdigest()


def cached(df: DataFrame, root: str, also: str = "") -> DataFrame:
    """``df`` from a table under ``root``, computed and written unless the same plan over the same files was before.

    ``also`` is for what the plan doesn't show, such as a model's version.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{plan_key(df, also)}"
    if not exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


INDEX = CHUNKS + ", chunk_id BIGINT, embedding ARRAY<FLOAT>"


def write_index(chunks: DataFrame, path: str) -> None:
    """Vectors stored with their chunk: the columns of ``INDEX``, which must all be there; a new folder only."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(INDEX)
    chunks.select(*[F.col(f.name).cast(f.dataType) for f in wanted]).write.mode("errorifexists").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


def write_shards(df: DataFrame, path: str, shards: int, key: str) -> None:
    """``df`` dealt to ``shards`` folders by a hash of the key, vectors and metadata side by side."""
    df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")).repartition(shards, "shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards put together, without the shard's number."""
    return spark.read.parquet(path).drop("shard")


def merged_shards(vectors: DataFrame, metadata: DataFrame) -> DataFrame:
    """Vectors with their metadata by shard and row, and ``chunk_id`` in that order (from 0)."""
    sizes = {r["shard"]: r["count"] for r in vectors.groupBy("shard").count().collect()}  # one row a file
    at, before = 0, {}
    for shard in sorted(sizes):
        before[shard] = at
        at += sizes[shard]
    both = vectors.join(metadata, ["shard", "row"])
    starts = F.create_map(*[x for s, n in before.items() for x in (F.lit(s), F.lit(n).cast("long"))]) if before else F.create_map().cast("map<int,bigint>")
    return both.withColumn("chunk_id", F.element_at(starts, F.col("shard")) + F.col("row")).drop("shard", "row")
