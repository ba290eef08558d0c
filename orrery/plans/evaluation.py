"""Queries of the evaluation report, over scores derived from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import report
from .catalog import load, query

METRICS = ("BERTScore_f1", "BLEU", "ROUGE_2_score", "ROUGE_L_score", "a3cu_f1")
TYPES = ("base", "finetuned")
COLUMNS = [f"{m}_{t}" for m in METRICS for t in TYPES]
#: Each score is a multiple of the key modulo a prime, so both engines make the same ones.
FACTORS = dict(zip(COLUMNS, (37, 41, 53, 59, 61, 67, 71, 73, 79, 83)))
SCORES_SQL = "with s as (select p_partkey pos, p_name question, " + ", ".join(f"((p_partkey * {k}) % 1009)::double / 1009 {c}" for c, k in FACTORS.items()) + " from part)"
RANGES_SQL = SCORES_SQL + ", m as (select " + ", ".join(f"least(min({x}_base), min({x}_finetuned)) lo_{x}, greatest(max({x}_base), max({x}_finetuned)) hi_{x}" for x in METRICS) + " from s), n as (select s.*, " + ", ".join(f"({c} - lo_{c.rpartition('_')[0]}) / (hi_{c.rpartition('_')[0]} - lo_{c.rpartition('_')[0]}) {c}_norm" for c in COLUMNS) + " from s cross join m)"


def _scores(spark, sf_dir):
    key = F.col("p_partkey")
    return load(spark, sf_dir, "part").select(key.alias("pos"), F.col("p_name").alias("question"), *[((key * k) % 1009).cast("double").__truediv__(1009).alias(c) for c, k in FACTORS.items()])


def _scaled(spark, sf_dir):
    return report.pooled_minmax(_scores(spark, sf_dir), [(f"{m}_base", f"{m}_finetuned") for m in METRICS])


def _norm(t: str) -> list[str]:
    return [f"{m}_{t}_norm" for m in METRICS]


NUMERICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" union all ".join(f"select '{c}' metric, count({c}) n, round(avg({c}), 6) mean, round(stddev_samp({c}), 6) std, round(min({c}), 6) min, round(quantile_cont({c}, 0.25), 6) q25, round(quantile_cont({c}, 0.5), 6) q50, round(quantile_cont({c}, 0.75), 6) q75, round(max({c}), 6) max from lineitem" for c in NUMERICS))
def describe_scores(spark, sf_dir):
    d = report.described(load(spark, sf_dir, "lineitem"), NUMERICS)
    return d.select("metric", "n", *[F.round(c, 6).alias(c) for c in d.columns[2:]])


@query(RANGES_SQL + " select pos, " + ", ".join(f"round({c}_norm, 6) {c}_norm" for c in COLUMNS) + " from n")
def minmax_pooled(spark, sf_dir):
    return _scaled(spark, sf_dir).select("pos", *[F.round(f"{c}_norm", 6).alias(f"{c}_norm") for c in COLUMNS])


def _mean_sql(t: str) -> str:
    return "(" + " + ".join(f"{c}" for c in _norm(t)) + ") / 5"


@query(RANGES_SQL + f" select pos, round({_mean_sql('base')}, 6) base_mean, round({_mean_sql('finetuned')}, 6) finetuned_mean from n")
def row_mean(spark, sf_dir):
    return _scaled(spark, sf_dir).select("pos", *[F.round(report.row_mean(_norm(t)), 6).alias(f"{t}_mean") for t in TYPES])


@query(RANGES_SQL + " select pos, " + ", ".join(f"round({m}_finetuned_norm - {m}_base_norm, 6) {m}_diff" for m in METRICS[:4]) + " from n")
def score_diff(spark, sf_dir):
    return _scaled(spark, sf_dir).select("pos", *[F.round(F.col(f"{m}_finetuned_norm") - F.col(f"{m}_base_norm"), 6).alias(f"{m}_diff") for m in METRICS[:4]])


@query("select case when l_extendedprice < 0 then 0 when l_extendedprice >= 120000 then 21 else floor(l_extendedprice / 6000) + 1 end::bigint bin, count(*) n from lineitem where l_extendedprice is not null group by all")
def histogram(spark, sf_dir):
    return report.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 0.0, 120000.0, 20)


MELT_SQL = SCORES_SQL + ", l as (" + " union all ".join(f"select pos, '{c}' as Model, {c} as Score from s" for c in COLUMNS) + ")"


@query(MELT_SQL + " select pos, Model, round(Score, 6) as Score from l")
def melt_scores(spark, sf_dir):
    return report.melted(_scores(spark, sf_dir), ["pos"], COLUMNS).select("pos", "Model", F.round("Score", 6).alias("Score"))


LABELS_SQL = """case when Model like 'BLEU%' then 'BLEU' when Model like 'BERTScore%' then 'BERTScore' when Model like 'a3cu%' then 'A3CU' when Model like 'ROUGE%' then 'ROUGE-' || regexp_extract(Model, 'ROUGE_(\\w?)_', 1) end as Metric,
case when Model like '%base%' then 'Base' else 'Finetuned' end as Type"""


def _labelled(spark, sf_dir):
    melted = report.melted(_scores(spark, sf_dir), ["pos"], COLUMNS)
    return melted.withColumn("Metric", report.metric_name(F.col("Model"))).withColumn("Type", report.model_type(F.col("Model")))


@query(MELT_SQL + f" select Metric, Type, count(*) n, round(avg(Score), 6) mean from (select Score, {LABELS_SQL} from l) group by all".replace("\\\\", "\\"))
def metric_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).groupBy("Metric", "Type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("Score"), 6).alias("mean"))


@query((MELT_SQL + f", t as (select Score, {LABELS_SQL} from l), q as (select Metric, Type, quantile_cont(Score, 0.25) q25, quantile_cont(Score, 0.5) q50, quantile_cont(Score, 0.75) q75 from t group by all)" + " select Metric, Type, round(q25, 6) q25, round(q50, 6) q50, round(q75, 6) q75, round(min(Score), 6) low, round(max(Score), 6) high from t join q using (Metric, Type) where Score between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) group by Metric, Type, q25, q50, q75").replace("\\\\", "\\"))
def boxplot(spark, sf_dir):
    d = report.box(_labelled(spark, sf_dir), ["Metric", "Type"], "Score")
    return d.select("Metric", "Type", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75", "low", "high")])


def _long_sql(own: str, other: str) -> str:
    return f"select pos, question, {', '.join(f'round({m}_{own}, 6) {m}, round({m}_{other}, 6) {m}_other' for m in METRICS)}, '{own.capitalize()}' as Type from s"


@query(SCORES_SQL + " " + _long_sql(*TYPES) + " union all " + _long_sql(*TYPES[::-1]))
def wide_to_long(spark, sf_dir):
    d = report.long_scores(_scores(spark, sf_dir), ["pos", "question"], METRICS)
    return d.select("pos", "question", *[F.round(c, 6).alias(c) for m in METRICS for c in (m, f"{m}_other")], "Type")


TOP_SQL = RANGES_SQL + f""", k as (select pos, round({_mean_sql('finetuned')}, 6) score from n),
u as (select *, 0 side from (select * from k order by score desc, pos limit 10) union all select *, 1 side from (select * from k order by score, pos limit 10)),
r as (select pos, score, (row_number() over (order by side, score desc, pos) - 1)::int as rank from u)"""


def _ranked(spark, sf_dir):
    return _scaled(spark, sf_dir).select("pos", F.round(report.row_mean(_norm("finetuned")), 6).alias("score"))


@query(TOP_SQL + " select rank, pos, score from r")
def top_bottom_10(spark, sf_dir):
    return report.top_bottom(_ranked(spark, sf_dir), "score", "pos").select("rank", "pos", "score")


@query(TOP_SQL + " select rank, pos, score from r where rank = 0 or rank = (select max(rank) from r)")
def best_worst(spark, sf_dir):
    return report.best_and_worst(_ranked(spark, sf_dir), "score", "pos").select("rank", "pos", "score")
