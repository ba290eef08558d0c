"""Fine-tuning sets: exact splits and label-masked token sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .providers import Tokenizer
from .report import numbered

IGNORED = -100
#: Rows whose ids a task holds at once; an Arrow batch has more.
TOKENISED_ROWS = 256


def split_sizes(n: int, share: float = 0.1) -> tuple[int, int, int]:
    """Train, validation and test sizes of two successive splits (the held-out side is rounded up)."""
    held = -int(-n * share // 1)
    test = -int(-held * share // 1)
    return n - held, held - test, test


def split(df: DataFrame, key: str, seed: int = 42, share: float = 0.1) -> DataFrame:
    """``df`` with ``split``; sizes are exact, membership follows a seeded hash of the key.

    Only keys whose hash lies next to a cut are ranked: the cut hashes are found from
    counts per hash prefix, so no task sorts the whole table.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))))
    bins = hashed.groupBy(F.substring("_h", 1, 3).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))  # 4096 rows at most
    counts = {r["_bin"]: r["_n"] for r in bins.collect()}
    train, val, _ = split_sizes(sum(counts.values()), share)
    before, at = {}, 0
    for name in sorted(counts):
        before[name] = at
        at += counts[name]
    starts = F.create_map(*[x for name, n in before.items() for x in (F.lit(name), F.lit(n))]) if before else F.create_map().cast("map<string,int>")
    binned = hashed.withColumn("_bin", F.substring("_h", 1, 3)).withColumn("_rank", F.coalesce(F.try_element_at(starts, F.col("_bin")), F.lit(0)) + 1)
    name = F.when(F.col("_rank") <= train, "train").when(F.col("_rank") <= train + val, "validation").otherwise("test")
    # a bin that holds a cut is ranked within; all others are on one side
    cut = [b for b, n in counts.items() if any(before[b] < c < before[b] + n for c in (train, train + val))]
    own = F.row_number().over(Window.partitionBy("_bin").orderBy("_h", key)) - 1
    inside = F.col("_bin").isin(cut) if cut else F.lit(False)
    ranked = binned.where(~inside).unionByName(binned.where(inside).withColumn("_rank", F.col("_rank") + own))
    return ranked.withColumn("split", name).drop("_h", "_bin", "_rank")


def tokenised(df: DataFrame, full: str, prompt: str, tokenizer: Tokenizer, most: int = 4096) -> DataFrame:
    """``df`` with ``input_ids`` of the full text, cut at ``most``, their ``attention_mask`` and ``prompt_length``, the prompt's ids cut alike."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    df = df.drop("input_ids", "attention_mask", "prompt_length")

    def ids_of(text: str | None) -> np.ndarray:
        return np.array(tokenizer.encode(text or "")[:most], np.int32)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), TOKENISED_ROWS):
                part = pdf.iloc[a : a + TOKENISED_ROWS]
                ids = [ids_of(t) for t in part[full]]
                yield part.assign(input_ids=ids, attention_mask=[np.ones(len(x), np.int32) for x in ids], prompt_length=[len(ids_of(t)) for t in part[prompt]])

    ints = ArrayType(IntegerType())
    return df.mapInPandas(run, StructType([*df.schema.fields, StructField("input_ids", ints), StructField("attention_mask", ints), StructField("prompt_length", IntegerType())]))


def truncated(tokens: Column, most: int = 4096) -> Column:
    return F.slice(tokens, 1, most)


def masked_labels(ids: Column, prompt_length: Column, ignored: int | str = IGNORED) -> Column:
    """The ids with the prompt's part ignored."""
    n = F.least(prompt_length, F.size(ids))
    return F.concat(F.array_repeat(F.lit(ignored), n), F.slice(ids, n + 1, F.greatest(F.size(ids), F.lit(1))))


def has_response(ids: Column, prompt_length: Column) -> Column:
    """Something is left of the response after truncation."""
    return prompt_length < F.size(ids)


def has_label(labels: Column, ignored: int = IGNORED) -> Column:
    """Some label isn't ignored."""
    return F.exists(labels, lambda x: x != ignored)


def of_one_length(ids: Column, labels: Column) -> Column:
    """The labels; an error where there aren't as many as ids."""
    return F.when(F.size(ids) == F.size(labels), labels).otherwise(F.raise_error(F.lit("ids and labels differ in length")).cast("array<int>"))


def padded_length(batch_longest: Column, multiple: int = 8) -> Column:
    return (F.ceil(batch_longest / multiple) * multiple).cast("int")


def padded(ids: Column, length: Column, with_: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(with_), length - F.size(ids)))


def in_batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``df`` with ``batch`` (from 0) and ``place`` in it (from 0): rows of this order in batches of ``size``, but for the last.

    Rows are numbered by ranges of the first column, so no task sees the whole order.
    """
    at = F.col("_pos") - 1
    return numbered(df, order, "_pos").withColumns({"batch": F.floor(at / size), "place": (at % size).cast("int")}).drop("_pos")


def padded_batches(batches: DataFrame, ids: str = "input_ids", with_: int = 0, multiple: int = 8) -> DataFrame:
    """Rows of ``in_batches`` with their ids filled up to the batch's longest, rounded up; a task holds whole batches, not all rows."""
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch"))
    return batches.withColumn("_length", padded_length(longest, multiple)).withColumn(ids, padded(F.col(ids), F.col("_length"), with_)).drop("_length")
