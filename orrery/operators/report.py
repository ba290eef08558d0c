"""Evaluation frames: describe, scale, reshape, rank."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics
from .quantiles import exact_quantiles

QUARTILES = ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))


def zipped(left: DataFrame, right: DataFrame, position: str) -> DataFrame:
    """Two answer sets side by side by position; the shorter one ends it."""
    return left.join(right, position)


def numbered(df: DataFrame, order: Sequence[str], position: str = "pos", bins: int = 256) -> DataFrame:
    """``df`` with its rows' numbers (from 1) in this order, by ranges of the first column.

    Each range is numbered by itself and moved by the rows before it, so no task sees
    the whole order; rows with one value of the first column stay in one range.
    """
    first = F.col(order[0])
    cuts = sorted(set(df.agg(F.percentile_approx(first, [i / bins for i in range(1, bins)], 8 * bins).alias("c")).first()["c"] or []))
    marked = df.withColumn("_bin", F.coalesce(F.size(F.filter(F.lit(cuts), lambda c: c < first)), F.lit(-1)) if cuts else F.lit(0))
    at, before = 1, {}
    for r in marked.groupBy("_bin").count().orderBy("_bin").collect():  # bins + 1 rows
        before[r["_bin"]] = at
        at += r["count"]
    if not before:
        return marked.drop("_bin").withColumn(position, F.lit(0))
    starts = F.create_map(*[x for b, n in before.items() for x in (F.lit(b), F.lit(n))])
    own = F.row_number().over(Window.partitionBy("_bin").orderBy(*order)) - 1
    return marked.withColumn(position, (F.element_at(starts, F.col("_bin")) + own).cast("int" if at < 1 << 31 else "long")).drop("_bin")


def last_per_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """Of rows with one key the last value, at the first one's position."""
    rest = [c for c in df.columns if c not in (key, position)]
    last = df.groupBy(key).agg(F.min(position).alias(position), F.max_by(F.struct(*rest), position).alias("_last"))
    return last.select(key, position, "_last.*")


def described(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``metric, n, mean, std, min, q25, q50, q75, max`` of each column; exact, linearly interpolated quartiles."""
    totals = df.agg(*[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(f"s{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("metric"), *[F.col(f"s{i}.{k}").alias(k) for k in ("n", "mean", "std", "min", "max")]) for i, c in enumerate(columns)]
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])))
    quartiles = exact_quantiles(values, ["metric"], "value", [q for q, _ in QUARTILES], "_q")
    both = totals.select(F.inline(F.array(*rows))).join(quartiles, "metric", "left")
    return both.select("metric", "n", "mean", "std", "min", *[F.get("_q", F.lit(i)).alias(n) for i, (_, n) in enumerate(QUARTILES)], "max")


def described_frame(df: DataFrame) -> DataFrame:
    """``statistic`` and a column for every numeric column of the whole frame, as ``described`` has them."""
    from pyspark.sql.types import NumericType

    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not numeric:
        raise ValueError("no numeric column to describe")
    return by_statistic(described(df, numeric))


def by_statistic(stats: DataFrame) -> DataFrame:
    """``described`` turned around: one row per statistic, one column per metric."""
    names = stats.columns[1:]
    long = stats.select("metric", F.inline(F.array(*[F.struct(F.lit(c).alias("statistic"), F.col(c).cast("double").alias("value")) for c in names])))
    return long.groupBy("statistic").pivot("metric").agg(F.first("value"))


def side_by_side(frames: dict[str, DataFrame]) -> DataFrame:
    """Statistics of several frames (``statistic, ...``) as columns ``<frame>_<column>`` of one."""
    out = None
    for name, frame in frames.items():
        named = frame.select("statistic", *[F.col(c).alias(f"{name}_{c}") for c in frame.columns if c != "statistic"])
        out = named if out is None else out.join(named, "statistic", "full_outer")
    return out


def scored(df: DataFrame, prediction: str, reference: str, score: Callable[[Sequence[str], Sequence[str]], Sequence[float]], to: str) -> DataFrame:
    """``df`` with a metric of its pairs, batch by batch (a ``TokenScorer``'s ``score``, or ``metrics.greedy_match`` of ``TokenVectors``); null counts as empty."""

    @F.pandas_udf("double")
    def column(predictions: pd.Series, references: pd.Series) -> pd.Series:
        return pd.Series(score(predictions.fillna("").tolist(), references.fillna("").tolist()), dtype="float64")

    return df.withColumn(to, column(prediction, reference))


def compared(base: DataFrame, tuned: DataFrame, position: str, learned: dict[str, Callable[[Sequence[str], Sequence[str]], Sequence[float]]] | None = None) -> DataFrame:
    """Two models' answers to the same questions with all their scores, one row a question.

    Either side has ``question, reference_answer, model_answer`` and a position; of a repeated question the last answer counts, at the first position of the base
    model's.  Questions that neither answered are left out.  ``BLEU``, ``ROUGE_2``, ``ROUGE_L`` and the ``learned`` metrics follow as
    ``<metric>_base`` and ``<metric>_finetuned``, those scaled together as ``..._norm``, the differences of scaled scores as ``<metric>_diff``
    and the means of each model's scaled scores as ``mean_base`` and ``mean_finetuned``.
    """
    one = lambda df, to, *more: last_per_key(df.select("question", position, *more, F.col("model_answer").alias(to)), "question", position)
    both = one(base, "base_answer", "reference_answer").join(one(tuned, "finetuned_answer").drop(position), "question").where("base_answer is not null or finetuned_answer is not null")
    sides, names = ("base", "finetuned"), ["BLEU", "ROUGE_2", "ROUGE_L", *(learned or {})]
    for side in sides:
        answer, reference = f"{side}_answer", "reference_answer"
        both = both.withColumns({f"{n}_{side}": f(F.col(answer), F.col(reference)) for n, f in zip(names, (metrics.bleu, metrics.rouge_2, metrics.rouge_l))})
        for name, score in (learned or {}).items():
            both = scored(both, answer, reference, score, f"{name}_{side}")
    scaled = pooled_minmax(both, [(f"{n}_base", f"{n}_finetuned") for n in names])
    differences = {f"{n}_diff": F.col(f"{n}_finetuned_norm") - F.col(f"{n}_base_norm") for n in names}
    return scaled.withColumns(differences | {f"mean_{side}": row_mean([f"{n}_{side}_norm" for n in names]) for side in sides})


def pooled_minmax(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with ``<column>_norm`` scaled by the range of both columns of a pair together; a constant pair becomes 0."""
    ranges = df.agg(*[f(F.col(a), F.col(b)).alias(f"_{n}_{a}") for a, b in pairs for n, f in (("lo", lambda x, y: F.min(F.least(x, y))), ("hi", lambda x, y: F.max(F.greatest(x, y))))])
    out = df.crossJoin(F.broadcast(ranges))  # one row
    for a, b in pairs:
        lo, hi = F.col(f"_lo_{a}"), F.col(f"_hi_{a}")
        for c in (a, b):
            out = out.withColumn(f"{c}_norm", F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo)))
    return out.drop(*ranges.columns)


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the columns that aren't null."""
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(present > 0, total / present)


def melted(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "Model", value: str = "Score") -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def metric_name(column: Column) -> Column:
    short = F.regexp_extract(column, r"ROUGE_(\w?)_", 1)
    return F.when(column.startswith("BLEU"), "BLEU").when(column.startswith("BERTScore"), "BERTScore").when(column.startswith("a3cu"), "A3CU").when(column.startswith("ROUGE"), F.concat(F.lit("ROUGE-"), short))


def model_type(column: Column) -> Column:
    return F.when(column.contains("base"), "Base").otherwise("Finetuned")


def long_scores(df: DataFrame, shared: Sequence[str], names: Sequence[str], types: Sequence[str] = ("base", "finetuned")) -> DataFrame:
    """Both models' scores under common names, one row per model, with ``Type``."""
    out = None
    for own, other in (types, types[::-1]):
        part = df.select(*shared, *[F.col(f"{m}_{own}").alias(m) for m in names], *[F.col(f"{m}_{other}").alias(f"{m}_other") for m in names], F.lit(own.capitalize()).alias("Type"))
        out = part if out is None else out.unionByName(part)
    return out


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """``bin, n``: counts in equal bins; values outside are in bins 0 and ``bins + 1``."""
    return df.where(F.col(column).isNotNull()).groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles and whiskers (the furthest values within 1.5 ranges of the quartiles) of each group."""
    q = exact_quantiles(df, by, value, [p for p, _ in QUARTILES], "_q")
    q = q.select(*by, *[F.get("_q", F.lit(i)).alias(n) for i, (_, n) in enumerate(QUARTILES)])
    inside = (F.col(value) >= F.col("q25") - 1.5 * (F.col("q75") - F.col("q25"))) & (F.col(value) <= F.col("q75") + 1.5 * (F.col("q75") - F.col("q25")))
    return df.join(q, list(by)).where(inside).groupBy(*by, "q25", "q50", "q75").agg(F.min(value).alias("low"), F.max(value).alias("high"))


def top_bottom(df: DataFrame, score: str, position: str, n: int = 10) -> DataFrame:
    """The best ``n`` and the worst ``n`` (those in descending order), as ``rank`` 0 to 2n - 1; an overlap stays.

    Ties go to the row that comes first; nulls come last on either side.
    """
    best = df.orderBy(F.desc_nulls_last(score), position).limit(n).withColumn("_side", F.lit(0))
    worst = df.orderBy(F.asc_nulls_last(score), position).limit(n).withColumn("_side", F.lit(1))
    order = Window.partitionBy(F.lit(0)).orderBy("_side", F.desc_nulls_last(score), position)  # 2n rows
    return best.unionByName(worst).withColumn("rank", F.row_number().over(order) - 1).drop("_side")


def best_and_worst(df: DataFrame, score: str, position: str, n: int = 10) -> DataFrame:
    ranked = top_bottom(df, score, position, n)
    last = ranked.agg(F.max("rank").alias("last"))
    return ranked.crossJoin(F.broadcast(last)).where((F.col("rank") == 0) | (F.col("rank") == F.col("last"))).drop("last")
