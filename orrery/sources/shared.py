"""Tables that cut a job's lineage: in ``spark.checkpoint.dir``, which driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .files import removed


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names; where it names none, in one of our own, only on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = Path(tempfile.mkdtemp(prefix="orrery-")).as_uri()
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{where.toString()}/data"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, read back from a table; ``discarded`` removes it, at the latest the driver's end does."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discarded(*tables: DataFrame) -> None:
    for table in tables:
        removed(table.sparkSession, table.written_to, really=True)
