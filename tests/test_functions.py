"""Hand-computed cases and properties of the kernels."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.functions import chunking
from orrery.functions import text as T
from orrery.operators import dataset, qa, report
from orrery.sources import files, json_arrays, markup
from tests import page_kernel as pages


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


def test_clean(spark):
    cases = {"a-\nb-\nc": "ab- c", "é-\nü": "éü", "a\nb\nc": "a b c", "x  \n\n y": "x y", "x\x1cy": "x y", "x\u200by": "x\u200by", "²-\n½": "²½", "a\u0301-\nb": "a\u0301- b", "": ""}
    assert column(spark, cases, T.clean) == list(cases.values())
    assert column(spark, [None], T.clean) == [None]


def test_end_markers(spark):
    cases = {"Body.\nReferences\nA": "Body.", "Body.\nReferences": None, "x\nAppendix A:\n": "x", "x\nAppendix A Details\n": None, "Body\nAcknowledgements. We": "Body", "Body\nAcknowledgments. We": None, "5 Data availability": ""}
    assert column(spark, cases, T.before_end_marker) == list(cases.values())


def test_links(spark):
    cases = {
        "https://acp.example.org/articles/24/1/2024/": (True, 2024), "https://acp.example.org/articles/24/1/2024": (False, 2024), "https://acp.example.org/articles/24/1/2024/x.pdf": (True, None),
        "javascript:void(0)": (True, None), "mailto:a@b": (True, None), "https://x": (False, None), "https://x/": (False, None), "1/2/": (True, None),
    }
    assert column(spark, cases, T.is_article) == [a for a, _ in cases.values()]
    assert column(spark, cases, T.year) == [b for _, b in cases.values()]
    assert column(spark, ["https://acp.example.org/articles/24/1/2024/"], lambda u: T.download_name(u, "pdf")) == ["acp-24-1-2024.pdf"]
    journals = {"https://acp.example.org": True, "https://esd.example.org/articles/": True, "https://www.acp.example.org/": False, "https://meetings.example.org/": False, "https://acp.example.org/about": False}
    assert column(spark, journals, lambda u: T.is_journal(u, ".example.org")) == list(journals.values())


def test_question_repair():
    cases = {
        '{"question": "Why?"}': "Why?", '"question": "Why?"': "Why?", '```{"question": "Why?"}```': "Why?", '```json\n{"question": "Why?"}\n```': None,
        '{"question":\n "a\nb"}': "ab", "Why?": None, '{"question": "a", "question": "b"}': "b", '{"question": "Why?"} thanks': None,
    }
    assert {k: qa.repaired_question(k) for k in cases} == cases
    assert qa.repaired_question(None) is None


@pytest.mark.parametrize("n,sizes", [(2000, (1800, 180, 20)), (1000, (900, 90, 10)), (200, (180, 18, 2)), (0, (0, 0, 0))])
def test_split_sizes(n, sizes):
    assert dataset.split_sizes(n) == sizes


@settings(max_examples=200, deadline=None)
@given(st.text("ab  c", max_size=80), st.integers(2, 14), st.integers(0, 13))
def test_chunks(text, size, overlap):
    if overlap >= size:
        with pytest.raises(ValueError):
            chunking.chunks(text, size, overlap)
        return
    found = list(chunking.spans(text, size, overlap))
    covered = set()
    for (a, b), after in zip(found, [*found[1:], None]):
        assert 0 < b - a <= size
        covered |= set(range(a, b))
        if after:
            assert a < after[0] and b - after[0] <= overlap
    assert covered == set(range(len(text)))
    assert all(c == c.strip() and c for c in chunking.chunks(text, size, overlap))


def test_long_piece_and_white_space():
    assert chunking.chunks("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert chunking.chunks("    ", 4, 1) == []
    assert chunking.chunks("abcd", 4, 1) == ["abcd"]


def test_tables_and_automaton():
    body = "\n".join(f"This body line number {i} has rather more than nine words in it today." for i in range(14))
    table = "Table 1. Values\n1 2\n3 4\n5 6\n"
    assert pages.remove_tables("no table here") == "no table here"
    without = pages.remove_tables(f"Before.\n{table}{body}")
    assert without.startswith("Before.") and "3 4" not in without and "number 13" in without
    assert pages.remove_tables("Before.\nTable 1. shows that this long line is just a sentence of the body text") == "e 1. shows that this long line is just a sentence of the body text"
    assert pages.remove_tables("Before.\nTable 1. shows that this long line is just a sentence of the body text", keep_prefix=True).startswith("Before.")
    assert pages.document_text(["Title\nno heading"]) == ""
    text = pages.document_text(["Title\nAbstract. We show.", "sparse page", body, body + "\nReferences\nA", body])
    assert text == "We show." + body + "\n" + body


def test_markup():
    xml = b"<article><front><abstract><p>We <i>show</i> CO<sub>2</sub> rises.</p><p>no</p></abstract></front><body><sec><p>One <fig><p>gone</p></fig>tail</p><table-wrap><p>x</p></table-wrap><p>Two</p></sec></body></article>"
    assert markup.xml_abstract(xml) == "WeshowCO2rises."
    assert markup.xml_body(xml) == "Onetail\n\nTwo"
    assert markup.xml_abstract(b"<a><abstract/></a>") == "" and markup.xml_body(b"broken<") == ""
    assert markup.anchors('<a href="/x">1</a><A HREF=y.PNG>2</A><a href="z">3</a>', "https://h/d/") == ["https://h/x", "https://h/d/z"]
    assert markup.anchors(None, "https://h/") == []


def test_files(spark, tmp_path):
    root = tmp_path.as_uri()
    files.append_links(spark.createDataFrame([("u1",)], "url string"), f"{root}/links")
    files.append_links(spark.createDataFrame([("u2",)], "url string"), f"{root}/links")
    assert sorted(r.url for r in files.read_links(spark, f"{root}/links").collect()) == ["u1", "u2"]
    (tmp_path / "a.json").write_text('[{"filename": "f", "text": "é"}, {"filename": "g"}]')
    assert [r.text for r in json_arrays.read_json_array(spark, f"{root}/a.json", files.ARTICLES).orderBy("filename").collect()] == ["é", None]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.v1.XML").write_bytes(b"<a/>")
    (tmp_path / "raw" / "x.pdf").write_bytes(b"%")
    assert files.read_files(spark, f"{root}/raw", "xml").count() == 1
    assert files.list_files(spark, f"{root}/raw", "pdf").select(T.stem(F.col("path"))).first()[0] == "x"
    assert files.suffixed("/a.b/c.d.json", "qa") == "/a.b/c.d_qa.json"
    table = files.Versioned(spark, f"{root}/t")
    table.write(spark.range(2))
    table.write(table.read().withColumn("x", F.lit(1)))
    assert table.read().columns == ["id", "x"]


def test_reports(spark):
    df = spark.createDataFrame([(i, float(i % 7), 3.0, None if i == 2 else 1.0) for i in range(12)], "pos int, a double, c double, d double")
    scaled = report.pooled_minmax(df, [("c", "c")])
    assert {r.c_norm for r in scaled.collect()} == {0.0}
    ranks = report.top_bottom(df, "a", "pos").orderBy("rank").collect()
    assert len(ranks) == 20 and [r.pos for r in ranks[:3]] == [6, 5, 4] and ranks[-1].a == 0
    means = df.select(report.row_mean(["a", "d"]).alias("m")).collect()
    assert means[2].m == 2.0 and means[3].m == 2.0


def test_stream(spark, tmp_path):
    from orrery.streaming import ingest

    spark.createDataFrame([(1, "a b c"), (2, "")], ingest.SCHEMA).write.parquet(str(tmp_path / "in"))
    for n in (1, 2):
        ingest.ingest(ingest.chunk_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
        spark.createDataFrame([(3, "d")], ingest.SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
