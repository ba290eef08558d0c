"""Steps around models, the network and files, against plain Python."""

import json
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery import __main__ as cli
from orrery.operators import dataset, extract, fetch, links, qa, report, retrieve
from orrery.operators.providers import StubChat, StubFetcher, StubPdfReader
from orrery.sources import array_shards, files, markup
from tests import page_kernel as pages


class Failing:
    def reply(self, conversations, **settings):
        if any("bad" in c[-1]["content"] for c in conversations):
            raise RuntimeError("no model")
        return [json.dumps(settings) for _ in conversations]


def test_fetch_tries_and_gives_up(spark):
    urls = ["a" * n for n in range(1, 15)]
    df = spark.createDataFrame([(u,) for u in urls] + [(None,)], "url string")
    rows = {r.url: r for r in fetch.fetched(df, StubFetcher(), wait=(0, 0)).collect()}
    for u in urls:
        fails = len(u) % 7
        assert rows[u].html == (None if fails == 6 else f"<html>{u}</html>") and rows[u].attempts == min(6, fails + 1)
        assert (rows[u].error is None) == (fails < 6)
    assert rows[None].html is None and rows[None].attempts == 0
    counts = fetch.download_counts(fetch.downloaded(df.where("url is not null"), StubFetcher(), "pdf")).first()
    assert (counts.total, counts.skipped, counts.managed) == (14, 2, 12)


@pytest.mark.parametrize("width", [1, 8])
def test_rows_of_one_url_are_tried_apart(spark, width):
    urls = [u for n in (3, 5, 6) for u in ["a" * n] * 40]
    df = spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1)
    rows = fetch.fetched(df, StubFetcher(), wait=(0, 0), width=width).collect()
    assert len(rows) == 120
    for r in rows:
        assert (r.html, r.attempts) == ((None, 6) if len(r.url) == 6 else (f"<html>{r.url}</html>", len(r.url) + 1))


def test_waits_between_tries(monkeypatch):
    waited = []
    monkeypatch.setattr(fetch.time, "sleep", waited.append)
    assert fetch.attempted(lambda: 1 / 0, 3, (1.0, 3.0)) == (None, 3, "ZeroDivisionError: division by zero")
    assert len(waited) == 2 and all(1 <= w <= 3 for w in waited)


def test_threads_keep_order_and_overlap():
    meet = threading.Barrier(3, timeout=10)
    assert fetch.in_threads([1, 2, 3], lambda x: (meet.wait(), x * x)[1], 3) == [1, 4, 9]


def test_pdf_pages_are_clipped_and_errors_kept(spark):
    text = "\n".join(f"l{i}" for i in range(60))
    df = spark.createDataFrame([("/a/x.pdf", bytearray(text.encode())), ("/a/y.pdf", bytearray(b"\xff"))], "path string, content binary")
    rows = extract.pdf_pages(df, StubPdfReader()).orderBy("stem", "page_num").collect()
    assert [(r.stem, r.page_num) for r in rows] == [("x", 0), ("x", 1), ("y", None)]
    assert rows[0].text.split("\n") == [f"l{i}" for i in range(5, 48)] and rows[1].text.split("\n") == [f"l{50 + i}" for i in range(2, 10)]
    assert rows[2].text is None and "UnicodeDecodeError" in rows[2].error


def test_files_of_a_stem(spark):
    pdf = spark.createDataFrame([("/a/s.2.pdf",), ("/b/s.1.pdf",), ("/a/t.pdf",)], "path string")
    xml = spark.createDataFrame([("/a/s.xml",), ("/c/s.xml",), ("/a/u.xml",)], "path string")
    assert {r.stem: r.paths for r in extract.paths_per_stem(pdf).collect()} == {"s": ["/a/s.2.pdf", "/b/s.1.pdf"], "t": ["/a/t.pdf"]}
    rows = {r.stem: (r.pdf_path, r.xml_path) for r in extract.file_groups(pdf, xml).collect()}
    assert rows == {"s": ("/a/s.2.pdf", "/a/s.xml"), "t": ("/a/t.pdf", None), "u": (None, "/a/u.xml")}


def test_broken_xml_is_recovered():
    good = b"<a><abstract><p>One &amp; <i>two</i></p></abstract><body><p>x</p><fig><p>no</p></fig><p>y</p></body></a>"
    broken = good.replace(b"&amp;", b"&").replace(b"</fig>", b"")
    assert markup.xml_abstract(good) == markup.xml_abstract(broken) == "One &two"
    assert markup.xml_body(good) == "x\n\ny" and markup.xml_body(broken) == "x"
    assert markup.xml_body(b"no xml at all & nothing") == ""


def table(*rows):
    return "\n".join(("Table 1. Values", *rows))


# The lines of a table are three words at most, those of the body ten or twenty-five.
BODY, LONG = " ".join(["word"] * 10), " ".join(["word"] * 25)


@pytest.mark.parametrize("text, kept", [
    (table("1 2", "3 4", BODY, BODY, BODY, "after"), f"before\n{BODY}\n{BODY}\n{BODY}\nafter\n"),
    (table("1 2", "3 4", BODY, BODY, BODY, LONG, "after"), "before\n\nafter\n"),
    (table("1 2", "3 4", "5 6", BODY), f"before\n{BODY}\n"),
    (table("1 2", "3 4", BODY, "5 6", "7 8"), "before\n\n"),
    (table(*[BODY] * 10, "1 2", "3 4", "5 6"), None),
    (table(BODY, BODY), None),
])
def test_tables_by_line_classes(text, kept):
    found = pages.remove_tables(f"before\n{text}")
    assert found == (kept if kept is not None else f"\n{text}"[pages.CAPTION_STEP :])


def test_replies_errors_and_settings(spark):
    df = spark.createDataFrame([(i, "bad" if i == 5 else f"q{i}") for i in range(8)] + [(9, None)], "id int, q string")
    asked = df.withColumn("prompt", F.when(F.col("q").isNotNull(), qa.plain_prompt(F.col("q")))).coalesce(1)
    rows = {r.id: r for r in qa.replied(asked, "prompt", Failing(), batch=2, temperature=0.0).collect()}
    assert [i for i in rows if rows[i].reply is None] == [4, 5, 9]
    assert rows[5].reply_error == "RuntimeError: no model" and rows[9].reply_error is None and json.loads(rows[0].reply) == {"temperature": 0.0}


def test_answers_keep_the_other_fields(spark):
    df = spark.sql("select 1 id, struct('q' question, ' a ' answer, 7 page) qa, array('x') context union all select 2, struct('r', cast(null as string), 8), null union all select 3, null, null")
    rows = {r.id: r.qa for r in qa.with_generated_answers(df, StubChat()).collect()}
    assert rows[1].asDict() == {"question": "q", "answer": "a", "page": 7} and rows[3] is None
    assert rows[2].asDict() == {"question": "r", "answer": "Reply to: Question: r", "page": 8}


@pytest.mark.parametrize("block", [4096, 3])
def test_nearest_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", block)
    monkeypatch.setattr(retrieve, "ROW_BLOCK", 20)
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (90, 4)).astype(float)  # many ties
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, embedding array<double>")
    queries = spark.createDataFrame([(i, rows[i].tolist()) for i in range(0, 90, 9)], "query_id long, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.id, r.distance) for r in retrieve.nearest(base, queries, 5).collect())
    want = []
    for q in range(0, 90, 9):
        d = ((rows - rows[q]) ** 2).sum(axis=1)
        want += [(q, k + 1, int(i), d[i]) for k, i in enumerate(np.lexsort((np.arange(90), d))[:5])]
    assert found == want
    assert retrieve.nearest(base.limit(2), queries, 5).count() == 20 and retrieve.nearest(base.limit(0), queries).count() == 0


@pytest.mark.parametrize("n, width, kind", [(3, 4, "ties"), (90, 4, "ties"), (20000, 8, "copies"), (9000, 3, "close"), (4000, 64, "far")])
def test_candidates_by_single_precision_lose_nobody(n, width, kind):
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 3, (n, width)).astype("float32") if kind == "ties" else rng.normal(size=(n, width))
    rows = rows * 1e-3 + 1e3 if kind == "close" else rows * 1e60 if kind == "far" else rows
    if kind == "copies":
        rows[:15000] = rows[0]
    ids, queries = rng.permutation(n), rows[rng.integers(0, n, 40)]
    kept = retrieve._fewest_copies(ids, rows, 6)
    assert kind != "copies" or len(kept) == 5006
    query, found, d = retrieve.nearest_pairs(ids, rows, np.arange(40), queries, 6)
    for i, q in enumerate(queries.astype(float)):
        far = ((rows.astype(float) - q) ** 2).sum(axis=1)
        want = np.lexsort((ids, far))[:6]
        assert found[query == i].tolist() == ids[want].tolist() and d[query == i].tolist() == far[want].tolist()


def test_blocks_of_queries_and_rows_by_pairs(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 3), ("ASKED_BLOCK", 7), ("ROW_BLOCK", 20)):
        monkeypatch.setattr(retrieve, name, value)
    rows = np.random.default_rng(3).integers(0, 3, (90, 4)).astype("float32")
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, embedding array<float>")
    found = sorted((r.query_id, r["rank"], r.id) for r in retrieve.nearest(base, base.where("id % 3 = 0").withColumnRenamed("id", "query_id"), 5).collect())
    want = [np.lexsort((np.arange(90), ((rows - rows[q]) ** 2).sum(axis=1)))[:5] for q in range(0, 90, 3)]
    assert found == [(q, k + 1, int(i)) for q, at in zip(range(0, 90, 3), want) for k, i in enumerate(at)]


def test_turns_of_one_vector_ask_once(spark, sf_dir, tmp_path, monkeypatch):
    from orrery.plans import catalog

    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{c}" if c % 4 else None) for c in range(100) for t in range(4)] + [(5, 9, None, "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(i, f"d{i}") for i in range(10)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    asked, nearest = [], retrieve.nearest
    monkeypatch.setattr(retrieve, "nearest", lambda base, queries, *more: asked.append(queries.count()) or nearest(base, queries, *more))
    got = {(r.conv_id, r.turn): (r.n, r.digest is None) for r in catalog.QUERIES["question_contexts"](spark, str(tmp_path)).collect()}
    assert asked == [10] and got == {(c, t): (6, False) if role == "user" and text else (None, True) for c, t, role, text in rows}


def test_numbered_and_split(spark):
    rows = [(i % 7, i) for i in range(50)] + [(None, 99)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = [(r.a, r.b) for r in report.numbered(df, ["a", "b"]).orderBy("pos").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r)) and report.numbered(df.limit(0), ["a"]).count() == 0
    split = dataset.split(spark.range(1000).withColumnRenamed("id", "k"), "k")
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 900, "validation": 90, "test": 10}


def test_truncation_cuts_the_prompt_too(spark):
    from orrery.operators.providers import StubTokenizer

    df = spark.createDataFrame([("abcdef", "abc"), ("abcdef", "abcde"), (None, None)], "full string, prompt string")
    rows = dataset.tokenised(df, "full", "prompt", StubTokenizer(), 4).collect()
    assert [(r.input_ids, r.attention_mask, r.prompt_length) for r in rows] == [([97, 98, 99, 100], [1] * 4, 3), ([97, 98, 99, 100], [1] * 4, 4), ([], [], 0)]
    with pytest.raises(Exception, match="differ in length"):
        spark.sql("select array(1, 2) ids, array(1) labels").select(dataset.of_one_length(F.col("ids"), F.col("labels"))).collect()
    long = " ".join(map(str, range(5000)))
    assert spark.createDataFrame([(long,)], "t string").select(F.size(dataset.truncated(F.split("t", " ")))).first()[0] == 4096


def test_ids_are_handed_on_in_small_parts(spark):
    from orrery.operators.providers import StubTokenizer

    parts = []

    class Counted:
        schema = spark.createDataFrame([("", "")], "full string, prompt string").schema

        def drop(self, *names):
            return self

        def mapInPandas(self, run, schema):
            parts.extend(run([pd.DataFrame({"full": ["abcd"] * 1000 + [None], "prompt": ["ab"] * 1001})]))

    dataset.tokenised(Counted(), "full", "prompt", StubTokenizer())
    assert sum(map(len, parts)) == 1001 and max(map(len, parts)) <= 256
    rows = dataset.tokenised(spark.range(1000).selectExpr("concat('é', id) full", "cast(id as string) prompt").coalesce(1), "full", "prompt", StubTokenizer(), 3).collect()
    assert len(rows) == 1000 and all(r.input_ids == [ord(c) for c in r.full][:3] and r.attention_mask == [1] * len(r.input_ids) and r.prompt_length == len(r.prompt) for r in rows)


def test_shards_and_index(spark, tmp_path):
    rng = np.random.default_rng(1)
    shards = [rng.random((n, 3)).astype("float32") for n in (4, 2, 3)]
    for i, v in enumerate(shards):
        np.save(tmp_path / f"data_{i}.npy", v)
        (tmp_path / f"metadata_rank_{i}.json").write_text(json.dumps([{"filename": f"f{i}", "chunk_index": k, "text": f"é{i}{k}"} for k in range(len(v))]))
    folder = tmp_path.as_uri()
    merged = files.merged_shards(array_shards.read_array_shards(spark, folder), array_shards.read_metadata_shards(spark, folder))
    rows = merged.orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == list(range(9)) and [r.text for r in rows] == [f"é{i}{k}" for i, n in enumerate((4, 2, 3)) for k in range(n)]
    assert np.allclose([r.embedding for r in rows], np.concatenate(shards))
    files.write_index(merged, f"{folder}/index")
    assert files.read_index(spark, f"{folder}/index").count() == 9
    with pytest.raises(Exception):
        files.write_index(merged.drop("text"), f"{folder}/other")
    files.write_shards(merged, f"{folder}/shards", 3, "chunk_id")
    assert sorted(r.chunk_id for r in files.read_shards(spark, f"{folder}/shards").collect()) == list(range(9))
    assert not files.removed(spark, f"{folder}/shards") and files.removed(spark, f"{folder}/shards", really=True) and not files.exists(spark, f"{folder}/shards")


def test_versions_and_cache(spark, tmp_path):
    root = f"{tmp_path.as_uri()}/t"
    one, two = (files.Versioned(spark, root) for _ in range(2))
    writers = [threading.Thread(target=w.write, args=(spark.range(n),)) for w, n in ((one, 1), (two, 2), (one, 3))]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert sorted(one._versions()) == [1, 2, 3]
    one.write(one.read().union(spark.range(10)))
    assert two.read().count() in (11, 12, 13)
    assert files.cached(spark.range(3), root + "c").count() == files.cached(spark.range(3), root + "c", "k").count() == 3


def test_link_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    assert links.matching(df).count() == 3 and links.matching(df, F.col("url") == "a").count() == 2
    assert [r.url for r in links.sorted_values(df, "url").collect()] == ["a", "b"]


def test_commands_from_files_to_training_rows(spark, tmp_path):
    folder, out = tmp_path / "in", f"{tmp_path.as_uri()}/out"
    folder.mkdir()
    body = " ".join(["and this is the text of a body."] * 30)
    for i in range(20):
        (folder / f"a{i}.xml").write_text(f"<x><abstract><p>About {i}.</p></abstract><body><p>{i} {body}</p></body></x>")
    (folder / "b.pdf").write_bytes(("\n" * 6 + "Abstract. We\n" + f"{body}\n" * 30).encode())
    run = lambda stage, source, to, *more: cli.main([stage, "--input", source, "--output", f"{out}/{to}", "--stand-in", *more], spark)
    run("articles", folder.as_uri(), "articles")
    got = {r.filename: r for r in spark.read.parquet(f"{out}/articles").collect()}
    assert len(got) == 21 and got["a3"].text_source == "xml" and got["a3"].abstract_text == "About 3." and got["b"].text_source == "pdf" and got["b"].text
    run("ingest", f"{out}/articles", "index", "--chunk-size", "400", "--overlap", "50")
    run("questions", f"{out}/articles", "questions")
    run("contexts", f"{out}/questions", "contexts", "--index", f"{out}/index", "--amount", "2")
    run("answers", f"{out}/contexts", "answers")
    rows = {r.filename: r for r in spark.read.parquet(f"{out}/answers").collect()}
    assert len(rows) == 21 and rows["b"].qa is None and rows["b"].context is None
    assert rows["a3"].qa.question == "About 3.?" and rows["a3"].qa.answer.startswith("Reply to: Question: About 3.") and len(rows["a3"].context) == 2
    run("split", f"{out}/answers", "split")
    assert spark.read.parquet(f"{out}/split").count() == 21
    run("tokenise", f"{out}/answers", "tokens")
    assert all(len(r.labels) == len(r.input_ids) and r.labels[0] == -100 and r.labels[-1] != -100 for r in spark.read.parquet(f"{out}/tokens").collect())
    run("infer", f"{out}/answers", "answered", "--model", "m")
    assert {r.model for r in spark.read.parquet(f"{out}/answered").collect()} == {"m"}
    run("describe", f"{out}/index", "described")
    assert {r.statistic: r.chunk_index for r in spark.read.parquet(f"{out}/described").collect()}["min"] == 0
    with pytest.raises(ValueError):
        report.described_frame(spark.createDataFrame([("a",)], "a string"))
