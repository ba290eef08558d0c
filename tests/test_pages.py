"""The folds over lines, captions and pages against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.functions import pages as P
from orrery.operators import extract
from tests import page_kernel

LINES = ["1 2", "3", "", "a-b–c", " ".join(["w"] * 7), " ".join(["w"] * 9), " ".join(["w"] * 12), " ".join(["w"] * 16), " ".join(["w"] * 25), "Table 1. Values", "Table S2. " + " ".join(["h"] * 15), "see Table 3. here", "Tables", "Abstract", "Abstract. We ﬁnd", "References", "Appendix A:", "5 Data availability", "ﬂow 😀"]


def page(rng, n=40):
    return "\n".join(rng.choices(LINES, weights=[9, 9, 2, 4, 6, 6, 6, 3, 3, 2, 1, 1, 1, 0.3, 0.3, 0.3, 0.2, 0.2, 1], k=rng.randrange(n)))


@pytest.mark.parametrize("keep_prefix", [False, True])
def test_tables(spark, keep_prefix):
    rng = random.Random(1)
    texts = [page(rng) for _ in range(400)] + ["", "Table 1.", "x\nTable 1. a\n1\n2\n3", "Table 1. a\nTable 2. b\n1\n2\n3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, text string").repartition(4)
    found = {r.i: r.text for r in extract.without_tables(df, keep_prefix).collect()}
    assert found.pop(-1) is None
    for i, t in enumerate(texts):
        assert found[i] == page_kernel.remove_tables(t, keep_prefix), t
    assert sum(found[i] != t for i, t in enumerate(texts)) > 50


def test_documents(spark):
    rng = random.Random(2)
    docs = [["Title\nAbstract: We" + page(rng, 5)] * rng.randrange(2) + [page(rng) for _ in range(rng.randrange(6))] for _ in range(250)]
    docs = [d[::-1] if rng.random() < 0.2 else d for d in docs] + [[], ["Abstract"], ["no heading"]]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(-1, None), (-2, ["Abstract x", None])], "i int, pages array<string>").repartition(4)
    found = {r.i: r.text for r in extract.with_document_text(df, "pages").collect()}
    assert found.pop(-1) == "" and found.pop(-2) == "x"
    assert found == {i: page_kernel.document_text(d) for i, d in enumerate(docs)} and len(set(found.values())) > 100
    flat = spark.createDataFrame([(f"d{i}", k, p) for i, d in enumerate(docs) for k, p in enumerate(d)], "stem string, page_num int, text string").repartition(5)
    assert {r.stem: r.text for r in extract.document_texts(flat).collect()} == {f"d{i}": found[i] for i, d in enumerate(docs) if d}


def test_captions_count_down(spark):
    (r,) = spark.createDataFrame([("Table 1. a\n" * 5,)], "t string").select(F.regexp_count("t", F.lit(P._CAPTIONS)).alias("n")).collect()
    assert r.n == 5
