"""Questions and answers: prompts, reply repair, resume, pairs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import files
from .dataset import in_batches
from .fetch import in_threads
from .providers import ChatProvider

MESSAGES = "array<struct<role string, content string>>"


def repaired_question(reply: str | None) -> str | None:
    """The question of a model's reply: fences stripped, line breaks dropped, braces added; None unless it is JSON then."""
    if reply is None:
        return None
    text = reply.strip("`").strip().replace("\n", "")
    text = text if text.startswith("{") else "{" + text
    text = text if text.endswith("}") else text + "}"
    try:
        question = json.loads(text).get("question")
    except (ValueError, AttributeError):
        return None
    return question if question is None or isinstance(question, str) else json.dumps(question)


def with_questions(df: DataFrame, reply: str = "reply") -> DataFrame:
    """``df`` with ``question`` from the raw reply and ``error`` where there is none; no row is dropped."""

    @F.pandas_udf("string")
    def repair(replies: pd.Series) -> pd.Series:
        return replies.map(repaired_question)

    return df.withColumn("question", repair(F.col(reply))).withColumn("error", F.when(F.col("question").isNull(), "no question in the reply"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def question_prompt(abstract: Column) -> Column:
    rules = "Write one factual question that the abstract answers. Reply as a JSON object with the key question."
    return F.array(message("system", F.lit(rules)), message("user", abstract))


def answer_prompt(context: Column, question: Column) -> Column:
    rules = "Answer the question from the context alone, in a few sentences."
    return F.array(message("system", F.lit(rules)), message("user", F.concat(F.lit("Context:\n"), context, F.lit("\n\nQuestion: "), question)))


def plain_prompt(question: Column) -> Column:
    """The question alone, as a fine-tuned model is asked."""
    return F.array(message("user", question))


def question_or_empty(qa: str = "qa") -> Column:
    """The question of a ``qa`` struct; empty without one."""
    return F.coalesce(F.col(f"{qa}.question"), F.lit(""))


def replied(df: DataFrame, prompt: str, provider: ChatProvider, to: str = "reply", batch: int = 64, width: int = 4, **settings: object) -> DataFrame:
    """``df`` with the provider's replies, and ``<to>_error`` for those of a batch that failed; no row is dropped.

    Rows without a prompt aren't asked.  Batches of a task go ``width`` at a time; ``settings`` go to the provider.
    """
    df = df.drop(to, f"{to}_error")

    def ask(conversations: list[list[dict[str, str]]]) -> list[tuple[str | None, str | None]]:
        try:
            found = provider.reply(conversations, **settings)
            if len(found) != len(conversations):
                raise ValueError(f"{len(found)} replies to {len(conversations)} prompts")
            return [(x, None) for x in found]
        except Exception as e:  # the provider's own errors are unknown here
            return [(None, f"{type(e).__name__}: {e}")] * len(conversations)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [i for i, p in enumerate(pdf[prompt]) if p is not None]
            asked = [[dict(m) if isinstance(m, dict) else m.asDict() for m in pdf[prompt].iloc[i]] for i in rows]
            out: list[tuple[str | None, str | None]] = [(None, None)] * len(pdf)
            answers = in_threads([asked[a : a + batch] for a in range(0, len(asked), batch)], ask, width)
            for i, x in zip(rows, (x for part in answers for x in part)):
                out[i] = x
            yield pdf.assign(**{to: [x for x, _ in out], f"{to}_error": [e for _, e in out]})

    return df.mapInPandas(run, StructType([*df.schema.fields, StructField(to, StringType()), StructField(f"{to}_error", StringType())]))


def replied_in_batches(df: DataFrame, prompt: str, provider: ChatProvider, order: Sequence[str], size: int = 16, to: str = "reply", **settings: object) -> DataFrame:
    """``df`` with the provider's replies and ``<to>_error``, asked in batches of ``size`` prompts in this order (but for the last), one call a batch.

    Rows without a prompt aren't asked and aren't in a batch; a call that fails gives its error to the rows of its batch alone.
    """
    df = df.drop(to, f"{to}_error")
    schema = StructType([*df.schema.fields, StructField(to, StringType()), StructField(f"{to}_error", StringType())])

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place").drop(columns=["batch", "place"])
        try:
            found, error = provider.reply([[dict(m) if isinstance(m, dict) else m.asDict() for m in p] for p in pdf[prompt]], **settings), None
            if len(found) != len(pdf):
                raise ValueError(f"{len(found)} replies to {len(pdf)} prompts")
        except Exception as e:  # the provider's own errors are unknown here
            found, error = [None] * len(pdf), f"{type(e).__name__}: {e}"
        return pdf.assign(**{to: found, f"{to}_error": error})

    asked = in_batches(df.where(F.col(prompt).isNotNull()), order, size).groupBy("batch").applyInPandas(ask, schema)
    none = F.lit(None).cast("string")
    return asked.unionByName(df.where(F.col(prompt).isNull()).withColumns({to: none, f"{to}_error": none}))


LOG = "digest string, reply string, error string, run string"


def replied_once(df: DataFrame, prompt: str, provider: ChatProvider, log: str, to: str = "reply", model: str = "", per_task: int = 512, **options: object) -> DataFrame:
    """``replied`` by way of a log of replies: a prompt that has one isn't asked again, whoever asked it, and equal prompts are asked once.

    The log is a folder of Parquet files.  Prompts are told apart by a digest of themselves, the ``model`` and the settings; those without a
    reply are dealt to tasks of about ``per_task``, and each task commits its replies when it ends, so a run that breaks off, or an
    executor that is lost, costs the prompts of its open tasks only.  What failed has its error and is asked in the next run.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    told = json.dumps({"model": model} | {k: v for k, v in options.items() if k not in ("batch", "width")}, sort_keys=True, default=str)
    digest = F.sha2(F.concat(F.lit(told + "\0"), F.to_json(prompt)), 256)
    keyed = df.drop(to, f"{to}_error").withColumn("_digest", F.when(F.col(prompt).isNotNull(), digest))
    known = spark.read.schema(LOG).parquet(log) if files.exists(spark, log) else spark.createDataFrame([], LOG)
    open_ = keyed.where("_digest is not null").select(F.col("_digest").alias("digest"), prompt).dropDuplicates(["digest"]).join(known.where("reply is not null").select("digest"), "digest", "left_anti")
    tasks = -(-open_.count() // per_task)
    if tasks:
        asked = replied(open_.repartition(tasks, "digest"), prompt, provider, "reply", **options)
        rows = asked.select("digest", "reply", F.col("reply_error").alias("error"), F.lit(run).alias("run"))
        # version 2 of the committer: a task's file is there for good when the task ends
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").parquet(log)
    have = spark.read.schema(LOG).parquet(log) if tasks or files.exists(spark, log) else known
    replies = have.groupBy("digest").agg(F.max("reply").alias(to), F.max(F.when(F.col("run") == run, F.col("error"))).alias(f"{to}_error"))
    joined = keyed.join(replies, keyed["_digest"] == replies["digest"], "left").drop("digest", "_digest")
    return joined.withColumn(f"{to}_error", F.when(F.col(to).isNull(), F.col(f"{to}_error")))


def kept_or(existing: Column, generated: Column) -> Column:
    """The answer that is there already, else the generated one (resume)."""
    return F.when(F.coalesce(F.trim(existing), F.lit("")) != "", existing).otherwise(F.trim(generated))


def answered(df: DataFrame, answer: Column) -> DataFrame:
    """``qa.answer`` set where there is a ``qa``, whose other fields stay; other rows stay without."""
    return df.withColumn("qa", F.when(F.col("qa").isNotNull(), F.col("qa").withField("answer", F.trim(answer))))


def context_text(context: Column, amount: int = 6) -> Column:
    """The first contexts, joined by a blank line."""
    return F.array_join(F.slice(context, 1, amount), "\n\n")


def with_generated_questions(articles: DataFrame, provider: ChatProvider, batch: int = 16) -> DataFrame:
    """``articles`` (``abstract_text, ...``) with ``qa.question``, null where there is no abstract or no usable reply, and ``error`` (in place of an earlier one)."""
    asked = articles.drop("error").withColumn("_prompt", F.when(F.coalesce("abstract_text", F.lit("")) != "", question_prompt(F.col("abstract_text"))))
    found = with_questions(replied(asked, "_prompt", provider, "_reply", batch, temperature=0.6, json_object=True), "_reply")
    error = F.when(F.col("_prompt").isNull(), F.lit("no abstract")).otherwise(F.coalesce("_reply_error", "error"))
    return found.withColumn("error", error).withColumn("qa", F.when(F.col("question").isNotNull(), F.struct("question"))).drop("_prompt", "_reply", "_reply_error", "question")


def with_generated_answers(articles: DataFrame, provider: ChatProvider, amount: int = 6, most: int = 1024, batch: int = 16) -> DataFrame:
    """``articles`` (``qa, context, ...``) with ``qa.answer`` from the first contexts and ``error`` (in place of an earlier one).

    Answers that are there already stay and aren't asked for again; rows without a ``qa`` pass as they are.
    """
    fields = articles.schema["qa"].dataType.fieldNames()
    old = F.col("qa.answer") if "answer" in fields else F.lit(None).cast("string")
    open_ = F.col("qa").isNotNull() & (F.coalesce(F.trim(old), F.lit("")) == "")
    asked = articles.drop("error").withColumn("_prompt", F.when(open_, answer_prompt(context_text(F.coalesce("context", F.array().cast("array<string>")), amount), question_or_empty())))
    found = replied(asked, "_prompt", provider, "_reply", batch, temperature=0.6, max_tokens=most)
    return answered(found, kept_or(old, F.col("_reply"))).withColumnRenamed("_reply_error", "error").drop("_prompt", "_reply")


def model_answers(pairs: DataFrame, provider: ChatProvider, model: str, most: int = 512, batch: int = 16) -> DataFrame:
    """``question, reference_answer, model_answer, model, error``: the held-out questions (``question, answer``) put to a model as they are."""
    found = replied(pairs.select("question", "answer", plain_prompt(F.col("question")).alias("_prompt")), "_prompt", provider, "_reply", batch, temperature=0.0, max_tokens=most)
    return found.select("question", F.col("answer").alias("reference_answer"), F.col("_reply").alias("model_answer"), F.lit(model).alias("model"), F.col("_reply_error").alias("error"))


def rendered(question: Column, answer: Column | None = None, template: str = "user: {}\nassistant: ") -> Column:
    """The pair as chat text, or without an ``answer`` its prompt alone; ``template`` has one place, for the question."""
    before, after = template.split("{}")
    prompt = F.concat(F.lit(before), question, F.lit(after))
    return prompt if answer is None else F.concat(prompt, answer)


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(column) != "")


def chat_pairs(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, question, answer``: every user turn with the assistant's next one."""
    after = Window.partitionBy("conv_id").orderBy("turn")
    turns = conversations.withColumn("next_turn", F.lead("turn").over(after)).withColumn("next_role", F.lead("role").over(after)).withColumn("next_text", F.lead("text").over(after))
    pairs = turns.where((F.col("role") == "user") & (F.col("next_role") == "assistant") & (F.col("next_turn") == F.col("turn") + 1))
    return pairs.select("conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer"))
