"""One command per stage: ``python -m orrery STAGE --input PATH --output PATH ...``.

Model-bound stages need ``--provider module:name``, a class of ``operators.providers``, or ``--stand-in`` for one that only looks like a model.
Tables are Parquet; with ``--json`` the output, and an input that ends in ``.json``, is one JSON array.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import crawl as walks
from .operators import dataset, extract, fetch, links, qa, report, retrieve
from .operators import providers as P
from .sources import array_shards, files, json_arrays, markup

Stage = Callable[[SparkSession, argparse.Namespace], DataFrame]


def _provider(a: argparse.Namespace, stand_in: type) -> Any:
    if not a.provider:
        if not a.stand_in:
            raise SystemExit(f"{a.stage} needs --provider module:name, or --stand-in")
        return stand_in()
    module, _, name = a.provider.partition(":")
    return getattr(importlib.import_module(module), name)()


def gather(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Links of the pages under --input (page_id, url, html) that --existing doesn't list."""
    found = markup.page_links(spark.read.parquet(a.input)).select("url")
    return links.new_links(found, files.read_links(spark, a.existing)) if a.existing else found


def crawl(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Article links from the front pages in the CSV under --input, by journals and issues of --domain; the walk is kept under --walk and goes on there."""
    roots = files.read_links(spark, a.input)
    get = walks.by_network(_provider(a, P.StubFetcher), wait=(0.0, 0.0) if not a.provider else fetch.WAIT)
    walks.walked(roots, get, walks.journal_levels(a.domain), a.walk)
    return walks.article_links(spark, a.walk, roots, a.domain)


def pages(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Pages of the links in the CSV under --input."""
    return fetch.fetched(files.read_links(spark, a.input), _provider(a, P.StubFetcher), wait=(0.0, 0.0) if not a.provider else fetch.WAIT)


def articles(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """One text per article of the PDF and XML files under --input."""
    read = extract.pdf_pages(files.read_files(spark, a.input, "pdf"), _provider(a, P.StubPdfReader))
    from_pdf = extract.document_texts(read.where("text is not null")).withColumnRenamed("text", "pdf_text")
    from_xml = markup.xml_articles(files.read_files(spark, a.input, "xml")).withColumnRenamed("path", "xml_path")
    groups = extract.file_groups(files.list_files(spark, a.input, "pdf"), files.list_files(spark, a.input, "xml"))
    chosen = extract.chosen_source(groups.join(from_pdf, "stem", "left").join(from_xml, "xml_path", "left"))
    return chosen.withColumnRenamed("stem", "filename")


def _articles(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.input.endswith(".json"):
        return json_arrays.read_json_array(spark, a.input, a.schema)
    return spark.read.parquet(a.input)


def ingest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Chunks of the articles under --input with their vectors."""
    keyed = _articles(spark, a).select(F.xxhash64("filename").alias("doc_id"), "filename", "text")
    chunks = retrieve.chunked(keyed, a.chunk_size, a.overlap).join(keyed.select("doc_id", "filename"), "doc_id")
    named = chunks.select("filename", "chunk_index", F.col("chunk").alias("text"), F.xxhash64("filename", "chunk_index").alias("chunk_id"))
    return retrieve.embedded(named, "text", _provider(a, P.StubEmbedder))


def merge(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The vector and metadata shards under --input in one table."""
    return files.merged_shards(array_shards.read_array_shards(spark, a.input), array_shards.read_metadata_shards(spark, a.input))


def questions(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """A question for each abstract."""
    return qa.with_generated_questions(_articles(spark, a), _provider(a, P.StubChat), a.batch)


def contexts(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The texts of --index nearest to each article's question."""
    keyed = _articles(spark, a).withColumn("query_id", F.xxhash64("filename"))
    asked = keyed.select("query_id", qa.question_or_empty().alias("question")).where("question <> ''")
    index = files.read_index(spark, a.index)
    vectors = retrieve.embedded(asked, "question", _provider(a, P.StubEmbedder)).select("query_id", "embedding")
    found = retrieve.nearest(index.select(F.col("chunk_id").alias("id"), "embedding"), vectors, a.amount)
    return retrieve.with_contexts(keyed, found, index.select(F.col("chunk_id").alias("id"), "text"), a.amount).drop("query_id")


def answers(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """An answer to each question from its contexts; answers that are there stay."""
    return qa.with_generated_answers(_articles(spark, a), _provider(a, P.StubChat), a.amount, a.most, a.batch)


def split(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Train, validation and test rows."""
    return dataset.split(_articles(spark, a), "filename")


def tokenise(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Token ids with the prompt's labels ignored, of rows whose response isn't cut off."""
    rows = _articles(spark, a).where("qa is not null")
    texts = rows.select("filename", qa.rendered(F.col("qa.question"), F.col("qa.answer")).alias("full"), qa.rendered(F.col("qa.question")).alias("prompt"))
    found = dataset.tokenised(texts, "full", "prompt", _provider(a, P.StubTokenizer), a.most)
    ids, n = F.col("input_ids"), F.col("prompt_length")
    return found.where(dataset.has_response(ids, n)).withColumn("labels", dataset.masked_labels(ids, n)).drop("full", "prompt", "prompt_length")


def infer(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """A model's answers to the questions of the articles under --input."""
    return qa.model_answers(_articles(spark, a).where("qa is not null").select("qa.question", "qa.answer"), _provider(a, P.StubChat), a.model, a.most, a.batch)


def evaluate(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The scores of two models' answers, those under --input and the tuned model's under --other, side by side."""
    answers = lambda path: (json_arrays.read_json_array(spark, path, files.ANSWERS) if path.endswith(".json") else spark.read.parquet(path)).withColumn("pos", F.monotonically_increasing_id())
    learned = {"learned": _provider(a, P.StubScorer).score} if a.provider or a.stand_in else None
    return report.compared(answers(a.input), answers(a.other), "pos", learned)


def rank(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The best and worst --amount rows of evaluate's result by the tuned model's mean."""
    return report.top_bottom(spark.read.parquet(a.input), "mean_finetuned", "pos", a.amount)


def describe(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Statistics of every numeric column."""
    return report.described_frame(_articles(spark, a))


STAGES: dict[str, Stage] = {f.__name__: f for f in (gather, crawl, pages, articles, ingest, merge, questions, contexts, answers, split, tokenise, infer, evaluate, rank, describe)}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orrery", description=__doc__.split("\n")[0])
    stages = top.add_subparsers(dest="stage", required=True)
    for name, stage in STAGES.items():
        own = stages.add_parser(name, help=stage.__doc__)
        own.add_argument("--input", required=True)
        own.add_argument("--output", required=True)
        own.add_argument("--provider")
        own.add_argument("--stand-in", action="store_true", help="a deterministic stand-in for the model or the network")
        own.add_argument("--json", action="store_true", help="write one JSON array")
        own.add_argument("--schema", default=files.ARTICLES_QA, help="columns of a JSON input")
        own.add_argument("--existing", help="CSV of links that are known")
        own.add_argument("--walk", help="folder of the crawl")
        own.add_argument("--domain", default="", help="end of the journals' hosts")
        own.add_argument("--index", help="folder of the index")
        own.add_argument("--other", help="the tuned model's answers")
        own.add_argument("--model", default="model")
        for option, value in (("--chunk-size", 4096), ("--overlap", 500), ("--amount", 6), ("--batch", 16), ("--most", 1024)):
            own.add_argument(option, type=int, default=value)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"orrery {a.stage}").getOrCreate()
    found = STAGES[a.stage](spark, a)
    if a.stage == "gather":
        files.append_links(found, a.output)
    elif a.stage == "split":
        files.write_split(found, a.output)
    elif a.stage == "ingest":
        files.write_index(found, a.output)
    elif a.json:
        json_arrays.write_json_array(found, f"{a.output}.parts")
        json_arrays.merged_file(spark, f"{a.output}.parts", a.output)
        files.removed(spark, f"{a.output}.parts", really=True)
    else:
        found.write.mode("errorifexists").parquet(a.output)


if __name__ == "__main__":
    main()
