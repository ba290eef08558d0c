"""Operators that the oracle queries don't reach: blocks of queries, failing providers, extraction frames."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orrery.operators import dataset, extract, links, providers, qa, retrieve


def test_nearest_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(2)
    vectors = rng.integers(0, 4, (120, 3)).astype(float)  # many ties
    base = spark.createDataFrame(pd.DataFrame({"id": range(120), "embedding": vectors.tolist()}))
    queries = base.where("id % 5 = 0").withColumnRenamed("id", "query_id")
    got = {(r.query_id, r["rank"]): (r.id, r.distance) for r in retrieve.nearest(base.repartition(6), queries, 4).collect()}
    assert len(got) == 24 * 4
    for q in range(0, 120, 5):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(120), d))[:4]
        assert [got[q, k + 1] for k in range(4)] == [(int(i), d[i]) for i in order]
    assert retrieve.nearest(base.limit(2), queries, 4).where("query_id = 0").count() == 2


def test_embeddings_have_unit_norm(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, "x")], "id long, text string")
    norms = [float(np.linalg.norm(r.embedding)) for r in retrieve.embedded(df, "text", providers.StubEmbedder(16)).orderBy("id").collect()]
    assert np.allclose(norms, [1, 0, 1], atol=1e-6)


class Failing:
    def reply(self, conversations):
        if any("bad" in c[-1]["content"] for c in conversations):
            raise RuntimeError("no answer")
        return ['{"question": "Why?"}'] * len(conversations)


def test_a_failing_batch_loses_no_rows(spark):
    df = spark.createDataFrame([(i, "bad" if i == 3 else "good") for i in range(8)], "i int, text string").coalesce(1)
    asked = df.withColumn("prompt", qa.question_prompt(F.col("text")))
    rows = qa.with_questions(qa.replied(asked, "prompt", Failing(), batch=2)).orderBy("i").collect()
    assert [r.question for r in rows] == ["Why?"] * 2 + [None] * 2 + ["Why?"] * 4
    assert [r.error is None for r in rows] == [r.question is not None for r in rows]


def test_answers(spark):
    df = spark.createDataFrame([(1, "q", " a "), (2, None, "b")], "i int, q string, reply string")
    df = df.withColumn("qa", F.when(F.col("q").isNotNull(), F.struct(F.col("q").alias("question"))))
    rows = qa.answered(df, F.col("reply")).orderBy("i").collect()
    assert rows[0].qa.answer == "a" and rows[1].qa is None
    kept = spark.createDataFrame([("old", "new"), ("  ", "new "), (None, "new")], "a string, b string").select(qa.kept_or(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in kept.collect()] == ["old", "new", "new"]


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = dataset.split(df, "k").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in a} == {"train": 900, "validation": 90, "test": 10}
    one, two = (sorted(r.k for r in dataset.split(x, "k").where("split = 'test'").collect()) for x in (df, df.repartition(9)))
    assert one == two and dataset.split(df.limit(0), "k").count() == 0


def test_links_and_sources(spark):
    scraped = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "url string")
    assert sorted(r.url for r in links.new_links(scraped, spark.createDataFrame([("a",)], "url string")).collect()) == ["b", "b", "c"]
    groups = spark.createDataFrame(
        [("s1", "p", "x", "pdf", "xml", "abs"), ("s2", "p", "x", "pdf", "", "abs"), ("s3", None, "x", None, "", "abs"), ("s4", "p", None, "pdf", None, None), ("s5", None, None, None, None, None)],
        "stem string, pdf_path string, xml_path string, pdf_text string, xml_text string, xml_abstract string",
    )
    rows = {r.stem: (r.text_source, r.text, r.abstract_text) for r in extract.chosen_source(groups).collect()}
    assert rows == {"s1": ("xml", "xml", "abs"), "s2": ("pdf", "pdf", "abs"), "s3": ("xml", "", "abs"), "s4": ("pdf", "pdf", ""), "s5": (None, None, None)}
    articles = spark.createDataFrame([("a",), ("b",)], "filename string")
    found = spark.createDataFrame([("a.x.json", "one", 0), ("a.y", "two", 1)], "filename string, abstract string, pos int")
    assert {r.filename: r.abstract for r in extract.with_abstracts(articles, found).collect()} == {"a": "two", "b": ""}
    pages = spark.createDataFrame([("d", 1, "x\n" * 14 + "References\nA"), ("d", 0, "T\nAbstract: We"), ("e", 0, None)], "stem string, page_num int, text string")
    assert {r.stem: r.text for r in extract.document_texts(pages).collect()} == {"d": "We" + ("x\n" * 14)[:-1], "e": ""}
    assert extract.without_tables(pages).count() == 3
