"""Queries of retrieval and of question, answer and training-set assembly."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import dataset, qa, report, retrieve, vector_index
from ..operators.providers import StubEmbedder
from ..sources import shared
from .catalog import load, query

KNN_SQL = """
with q as (select vec_id query_id, embedding v from embeddings where vec_id % 50 = 0),
d as (select query_id, b.vec_id id, list_sum(list_transform(list_zip(v::double[], b.embedding::double[]), lambda z: pow(z[1] - z[2], 2))) distance from q cross join embeddings b),
r as (select *, row_number() over (partition by query_id order by distance, id) as rank from d)
"""


def _knn(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return retrieve.nearest(e.withColumnRenamed("vec_id", "id"), e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"))


@query(KNN_SQL + "select query_id, cast(rank as int) as rank, id, round(distance, 6) distance from r where rank <= 6")
def knn_top6(spark, sf_dir):
    """Every 50th vector as a query against all."""
    return _knn(spark, sf_dir).select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query(KNN_SQL + "select query_id, cast(rank as int) as rank, id, round(distance, 6) distance from r where rank <= 6")
def knn_indexed(spark, sf_dir):
    """The same neighbours from an index of cells, read where the triangle inequality leaves a chance."""
    e = load(spark, sf_dir, "embeddings")
    folder = shared.shared_folder(spark, "index")
    vector_index.build(e.withColumnRenamed("vec_id", "id"), folder)
    found = vector_index.search(spark, folder, e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"))
    return found.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query(KNN_SQL + "select query_id, string_agg(coalesce(text, ''), chr(10) || chr(10) order by rank) context from r join documents on doc_id = id where rank <= 6 group by query_id")
def context_concat(spark, sf_dir):
    """The nearest rows' texts in order."""
    texts = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return retrieve.contexts(_knn(spark, sf_dir), texts)


@query("select vec_id % 8 shard, count(*) n, sum(vec_id)::bigint ids, round(sum(embedding[1]::double), 6) first from embeddings group by all")
def shard_merge(spark, sf_dir):
    """Eight shards put together again, each vector with its id."""
    e = load(spark, sf_dir, "embeddings")
    whole = None
    for i in range(8):
        shard = e.where(F.col("vec_id") % 8 == i).withColumn("shard", F.col("vec_id") % 8)
        whole = shard if whole is None else whole.unionByName(shard)
    return whole.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("ids"), F.round(F.sum(F.get("embedding", F.lit(0)).cast("double")), 6).alias("first"))


@query()
def retrieve_contexts(spark, sf_dir):
    """Documents cleaned, chunked and embedded; six contexts for every user turn (with a stand-in for the embedding model)."""
    stub = StubEmbedder()
    chunks = retrieve.chunked(load(spark, sf_dir, "documents")).withColumn("id", F.shiftleft("doc_id", 24) + F.col("chunk_index"))  # a text has fewer chunks than that
    turns = load(spark, sf_dir, "conversations").where("role = 'user' and text <> ''").select((F.shiftleft("conv_id", 24) + F.col("turn")).alias("query_id"), "text")
    base = shared.written(retrieve.embedded(chunks.select("id", "chunk"), "chunk", stub), "chunks")
    asked = shared.written(retrieve.embedded(turns, "text", stub).select("query_id", "embedding"), "questions")
    found = retrieve.nearest(base.select("id", "embedding"), asked)
    return retrieve.contexts(found, base.select("id", F.col("chunk").alias("text")))


@query(r"""
with t as (select conv_id, turn, trim(regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g')) || '?' q, turn % 5 as kind from conversations)
select conv_id, turn, case when kind = 4 then null else q end question from t""")
def qa_repair(spark, sf_dir):
    """F16: whole, brace-less, fenced, broken over lines, and plain replies."""
    c = load(spark, sf_dir, "conversations")
    q = F.concat(F.trim(F.regexp_replace("text", "[^A-Za-z0-9 ]", "")), F.lit("?"))
    body = F.concat(F.lit('"question": "'), q, F.lit('"'))
    kind = F.col("turn") % 5
    reply = F.when(kind == 0, F.concat(F.lit("{"), body, F.lit("}"))).when(kind == 1, body).when(kind == 2, F.concat(F.lit("```{"), body, F.lit("}```"))).when(kind == 3, F.concat(F.lit("{\n"), body, F.lit("\n}"))).otherwise(q)
    return qa.with_questions(c.select("conv_id", "turn", reply.alias("reply"))).select("conv_id", "turn", "question")


PAIRS_SQL = "with pairs as (select u.conv_id, u.turn, u.text question, a.text answer from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 where u.role = 'user' and a.role = 'assistant')"


def _pairs(spark, sf_dir):
    return qa.chat_pairs(load(spark, sf_dir, "conversations"))


@query(PAIRS_SQL + " select * from pairs")
def chat_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(PAIRS_SQL + " select conv_id, turn, 'user: ' || question || chr(10) || 'assistant: ' prompt from pairs where answer <> ''")
def qa_filter(spark, sf_dir):
    """P9, F21 with a plain template."""
    found = _pairs(spark, sf_dir).withColumn("qa", F.when(F.col("answer") != "", F.struct("question", "answer")))
    return found.where("qa is not null").select("conv_id", "turn", F.concat(F.lit("user: "), F.col("qa.question"), F.lit("\nassistant: ")).alias("prompt"))


@query("select conv_id, turn, case when turn % 2 = 0 and trim(coalesce(text, '')) <> '' then text else 'generated for ' || role end answer from conversations")
def keep_or_generate(spark, sf_dir):
    """What is answered stays, the rest is generated."""
    c = load(spark, sf_dir, "conversations")
    old = F.when(F.col("turn") % 2 == 0, F.col("text"))
    return c.select("conv_id", "turn", qa.kept_or(old, F.concat(F.lit("generated for "), "role")).alias("answer"))


@query("""
with r as (select doc_id, row_number() over (order by md5(doc_id || '#42'), doc_id) k, count(*) over () n from documents)
select doc_id, case when k <= n - ceil(0.1 * n) then 'train' when k <= n - ceil(0.1 * ceil(0.1 * n)) then 'validation' else 'test' end split from r""")
def split_90_9_1(spark, sf_dir):
    return dataset.split(load(spark, sf_dir, "documents").select("doc_id"), "doc_id")


TOKENS_SQL = PAIRS_SQL + """, t as (select conv_id, turn, string_split(question || ' ' || answer, ' ')[1:4096] ids, len(string_split(question, ' ')) prompt from pairs),
u as (select *, least(prompt, len(ids)) p from t)"""


def _tokens(spark, sf_dir):
    ids = dataset.truncated(F.split(F.concat_ws(" ", "question", "answer"), " "))
    return _pairs(spark, sf_dir).select("conv_id", "turn", ids.alias("ids"), F.size(F.split("question", " ")).alias("prompt"))


@query(TOKENS_SQL + " select conv_id, turn, len(ids)::int n, array_to_string(list_concat(list_transform(range(0, p), lambda i: '-100'), ids[p + 1:]), ' ') labels from u")
def label_mask(spark, sf_dir):
    """F22, F23 with words for ids."""
    t = _tokens(spark, sf_dir)
    return t.select("conv_id", "turn", F.size("ids").alias("n"), F.array_join(dataset.masked_labels(F.col("ids"), F.col("prompt"), "-100"), " ").alias("labels"))


@query(TOKENS_SQL + " select count(*) filter (prompt >= len(ids)) dropped, count(*) filter (prompt < len(ids)) kept from u")
def truncated_filter(spark, sf_dir):
    """P10, G12."""
    ok = dataset.has_response(F.col("ids"), F.col("prompt"))
    return _tokens(spark, sf_dir).agg(F.count_if(~ok).alias("dropped"), F.count_if(ok).alias("kept"))


@query(TOKENS_SQL + ", b as (select conv_id, max(len(ids)) m from u group by conv_id) select conv_id, turn, (ceil(m / 8.0) * 8)::int padded, ((ceil(m / 8.0) * 8) - len(ids))::int padding from u join b using (conv_id)")
def pad_to_8(spark, sf_dir):
    """a conversation is a batch."""
    t = _tokens(spark, sf_dir).withColumn("length", dataset.padded_length(F.max(F.size("ids")).over(Window.partitionBy("conv_id"))))
    filled = dataset.padded(F.col("ids"), F.col("length"), "")
    return t.select("conv_id", "turn", F.size(filled).alias("padded"), (F.size(filled) - F.size("ids")).alias("padding"))


@query(PAIRS_SQL + """, l as (select row_number() over (order by conv_id, turn) pos, question, answer base from pairs),
r as (select row_number() over (order by conv_id, turn) pos, 'tuned ' || answer finetuned from pairs where turn % 3 <> 2),
z as (select pos, question, base, finetuned from l join r using (pos))
select question, min(pos)::int pos, arg_max(base, pos) base, arg_max(finetuned, pos) finetuned from z where base is not null or finetuned is not null group by question""")
def answers_zip_dedupe(spark, sf_dir):
    """Two answer sets by position, the last value of each question at its first position."""
    pairs = _pairs(spark, sf_dir)
    numbered = lambda df: report.numbered(df, ["conv_id", "turn"])  # noqa: E731  (the position is the data's own order)
    left = numbered(pairs).select("pos", "question", F.col("answer").alias("base"))
    right = numbered(pairs.where("turn % 3 <> 2")).select("pos", F.concat(F.lit("tuned "), "answer").alias("finetuned"))
    both = report.zipped(left, right, "pos").where("base is not null or finetuned is not null")
    return report.last_per_key(both, "question", "pos")


ROUGE_SQL = PAIRS_SQL + """, t as (select conv_id, turn, list_filter(regexp_split_to_array(lower(question), '[^a-z0-9]+'), lambda x: x <> '') p, list_filter(regexp_split_to_array(lower(answer), '[^a-z0-9]+'), lambda x: x <> '') r from pairs),
g as (select conv_id, turn, 'p' side, unnest(list_transform(range(1, len(p)), lambda i: p[i] || ' ' || p[i + 1])) g from t union all
      select conv_id, turn, 'r', unnest(list_transform(range(1, len(r)), lambda i: r[i] || ' ' || r[i + 1])) from t),
c as (select conv_id, turn, g, count(*) filter (side = 'p') a, count(*) filter (side = 'r') b from g group by all),
s as (select conv_id, turn, sum(least(a, b)) hit, sum(a) a, sum(b) b from c group by all)
select conv_id, turn, case when coalesce(hit, 0) = 0 then 0.0::double else round(2.0 * hit / (a + b), 6)::double end rouge2 from t left join s using (conv_id, turn)"""


def _scored(spark, sf_dir, metric, name):
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.round(metric(F.col("question"), F.col("answer")), 6).alias(name))


@query(ROUGE_SQL)
def rouge2(spark, sf_dir):
    return _scored(spark, sf_dir, metrics.rouge_2, "rouge2")


ROUGE_L_SQL = PAIRS_SQL.replace("with pairs", "with recursive pairs") + """, t as (select conv_id, turn, list_filter(regexp_split_to_array(lower(question), '[^a-z0-9]+'), lambda x: x <> '') p, list_filter(regexp_split_to_array(lower(answer), '[^a-z0-9]+'), lambda x: x <> '') r from pairs),
l as (select conv_id, turn, p, r, 0 i, list_transform(p, lambda x: 0) v from t union all
      select conv_id, turn, p, r, i + 1, list_transform(range(1, len(p) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: case when p[k] = r[i + 1] then coalesce(v[k - 1], 0) + 1 else v[k] end))) from l where i < len(r)),
s as (select conv_id, turn, coalesce(v[-1], 0) hit, len(p) + len(r) n from l where i = len(r))
select conv_id, turn, case when hit = 0 then 0.0::double else round(2.0::double * hit / n, 6) end "rougeL" from s"""


@query(ROUGE_L_SQL)
def rouge_l(spark, sf_dir):
    """By rows of the longest common subsequence's table in SQL, by a fold over words of bits here."""
    return _scored(spark, sf_dir, metrics.rouge_l, "rougeL")


def _tokens_13a_sql(text: str) -> str:
    return rf"""list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      ' ' || replace(replace(replace(replace(replace(replace(replace({text}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '), '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
      '([\x21-\x26\x28-\x2b\x2f\x3a-\x40\x5b-\x60\x7b-\x7e])', ' \1 ', 'g'), '([^0-9])([.,])', '\1 \2 ', 'g'), '([.,])([^0-9])', ' \1 \2', 'g'), '([0-9])(-)', '\1 \2 ', 'g'), '\s+'), lambda x: x <> '')"""


BLEU_SQL = PAIRS_SQL + f""", t as (select conv_id, turn, {_tokens_13a_sql("question")} p, {_tokens_13a_sql("answer")} r from pairs),
o as (select *, unnest([1, 2, 3, 4]) n from t),
g as (select conv_id, turn, n, 'p' side, unnest(list_transform(range(1, len(p) - n + 2), lambda i: array_to_string(p[i:i + n - 1], ' '))) g from o union all
      select conv_id, turn, n, 'r', unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], ' '))) from o),
c as (select conv_id, turn, n, g, count(*) filter (side = 'p') a, count(*) filter (side = 'r') b from g group by all),
h as (select conv_id, turn, n, sum(least(a, b)) hit, sum(a) total from c group by all),
m as (select conv_id, turn, count(*) filter (hit > 0) orders, sum(case when hit > 0 then ln(hit / total) end) logs from h group by all)
select conv_id, turn, case when orders = 4 then round(exp(logs / 4) * case when len(p) > len(r) then 1 else exp(1 - len(r) / len(p)::double) end, 6) else 0.0::double end bleu
from t left join m using (conv_id, turn)"""


@query(BLEU_SQL)
def bleu(spark, sf_dir):
    """G13."""
    return _scored(spark, sf_dir, metrics.bleu, "bleu")
