"""Very long texts, repeated rows, null ids and empty tables, where the other tests don't have them."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.llm import byte_bpe, collocations, iblt, pii, quality_gam, suffix_dedup
from orrery.llm.common import keyed_text
from tests.llm.test_corpus_operators import brute_removed

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij é", k=rng.randrange(1, 9))) for _ in range(3000)]
    return " ".join(rng.choices(words, k=60_000)) + "\n" + "z" * 50_000


def test_personal_data_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a@b.org 1.2.3.4"), (1, "a@b.org 1.2.3.4"), (None, "a@b.org"), (None, None), (2, "")]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_email, r.n_ip) for r in pii.spans(keyed_text(spark.createDataFrame(rows, DOCS))).collect())
    assert found == [(False, 1, 1, 1), (False, 1, 1, 1), (False, 2, 0, 0), (True, 0, 0, 0), (True, 0, 1, 0)]
    assert pii.spans(keyed_text(spark.createDataFrame([], DOCS))).collect() == []


def test_scores_of_repeated_rows_and_no_rows(spark, sf_dir):
    docs = keyed_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.train(docs, labels, quality_gam.remainder(3) != 1)
    rows = [(5, "same text"), (5, "same text"), (None, "same text"), (6, None)]
    found = [r.score for r in quality_gam.with_score(spark.createDataFrame(rows, DOCS), model).collect()]
    assert len(found) == 4 and found[0] == found[1] == found[2] and all(0 <= x <= 1 for x in found)
    assert quality_gam.with_score(spark.createDataFrame([], DOCS), model).collect() == []
    none = quality_gam.train(docs.where("false"), labels, quality_gam.remainder(3) != 1)
    assert {r.score for r in quality_gam.with_score(spark.createDataFrame(rows, DOCS), none).collect()} == {0.5}


def iblt_paragraphs(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(iblt.paragraph_digests(F.col("text")).alias("d")).first().d


def test_a_very_long_text_is_fingerprinted_and_deduplicated(spark, long_text):
    rows = [(1, long_text), (2, long_text[:100_000] + "q" * 200), (3, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    prints = {r.doc_id: r for r in iblt.fingerprints(docs).collect()}
    digests = [set(iblt_paragraphs(spark, t)) for _, t in rows]
    assert prints[1].n_chars == len(long_text) and prints[2].near_next == pytest.approx(len(digests[0] & digests[1]) / len(digests[0] | digests[1]))
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(docs).collect()} == brute_removed(rows, 100)


def test_a_very_long_text_is_encoded(spark, long_text):
    import tiktoken

    path, pattern = byte_bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.codec(path, pattern).ranks, special_tokens={})
    ids = byte_bpe.codec(path, pattern).encode(long_text)
    assert list(ids) == library.encode_ordinary(long_text)


def test_phrases_of_a_text_without_pieces(spark):
    words = "alpha beta gamma delta".split()
    rng = random.Random(1)
    text = " ".join(rng.choices(words, k=400_000))  # one piece
    found = {r.phrase: r.a for r in collocations.phrases(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), 100, 2).collect()}
    tokens = text.split()
    want = {}
    for a, b in zip(tokens, tokens[1:]):
        want[f"{a} {b}"] = want.get(f"{a} {b}", 0) + 1
    assert found == want
