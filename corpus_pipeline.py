"""The training-data pipeline: quality, line dedup, near duplicates, personal data, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``, whatever others there are among them; a stage that
changes ``text`` keeps ``n_chars`` in step.  Columns whose names begin with two underscores are reserved.  Null texts pass every stage as they are
(and are scored, compared and packed as empty ones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import jaccard_join, line_dedup, packing, pii, quality_gam
from orrery.llm.common import discarded, keyed_text, table, written

#: SQL can't express the classifier, so ``run`` is tested against brute force instead.
ORACLE_SQL = None


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more stay."""
    model = quality_gam.train(keyed_text(docs), table(spark, sf_dir, "labels"), quality_gam.remainder(3) != 1)
    return quality_gam.with_score(docs, model, name="__quality").where("__quality >= 0.5").drop("__quality")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; every document stays, if only with fewer lines."""
    return _recounted(line_dedup.dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id stays (a null id is the smallest); of rows with one id and text, the one whose columns' hash is smallest.

    Rows without words are linked with nothing and stay, one for each id.
    """
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    found = jaccard_join.near_duplicates(keyed_text(keyed, "__row")).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).distinct()
    first = keyed.select("__row", "doc_id").join(found, "__row").groupBy("__group").agg(F.min(F.struct("doc_id", "__row")).alias("first"))
    one = keyed.join(first.select(F.col("first.__row").alias("__row")), "__row", "left_semi").groupBy("__row")
    return one.agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("kept")).select("kept.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind."""
    return _recounted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two length with their ids, one row each."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder, and removed when the next stage has read it."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            discarded(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
