"""What is done once: replies by a log, tables by their plan, links of a stream; and batches, shards and commands."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery import __main__ as cli
from orrery.operators import dataset, fetch, links, qa, retrieve
from orrery.operators.providers import StubEmbedder, StubTokenizer
from orrery.sources import array_shards, files, json_arrays
from orrery.streaming import seen


class Logged:
    """Writes down what it is asked, in a file for each call; fails on prompts that a file names."""

    def __init__(self, folder):
        self.folder = str(folder)

    def reply(self, conversations, **settings):
        import os
        import uuid

        asked = [c[-1]["content"] for c in conversations]
        bad = open(f"{self.folder}/bad").read().split()
        if any(x in bad for x in asked):
            raise RuntimeError("down")
        with open(f"{self.folder}/{uuid.uuid4().hex}.asked", "w") as f:
            f.write("\n".join(asked))
        assert os.path.exists(self.folder)
        return [f"re {x}" for x in asked]


def asked(folder):
    return sorted(x for p in folder.glob("*.asked") for x in p.read_text().split())


def test_a_prompt_is_asked_once_over_two_runs(spark, tmp_path):
    (tmp_path / "bad").write_text("q5 q17 q18")
    names = [f"q{i}" for i in range(24)] + ["q3", "q3"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(names)] + [(99, None)], "id int, q string").withColumn("prompt", F.when(F.col("q").isNotNull(), qa.plain_prompt(F.col("q"))))
    run = lambda **more: {r.id: r for r in qa.replied_once(df, "prompt", Logged(tmp_path), f"{tmp_path}/log", batch=1, per_task=5, **more).collect()}
    first = run()
    assert len(first) == 27 and first[0].reply == "re q0" and first[24].reply == "re q3" and first[99].reply is None and first[99].reply_error is None
    assert {i for i in first if first[i].reply_error} == {5, 17, 18} and first[5].reply_error == "RuntimeError: down"
    (tmp_path / "bad").write_text("")
    second = run()
    assert all(second[i].reply == f"re {x}" for i, x in enumerate(names)) and not any(r.reply_error for r in second.values())
    assert asked(tmp_path) == sorted(f"q{i}" for i in range(24))
    assert {i: r.reply for i, r in run().items()} == {i: r.reply for i, r in second.items()} and len(asked(tmp_path)) == 24
    run(model="other")
    assert len(asked(tmp_path)) == 48


def test_a_broken_run_keeps_what_its_tasks_committed(spark, tmp_path):
    (tmp_path / "bad").write_text("")

    class Breaking(Logged):
        def reply(self, conversations, **settings):
            if conversations[0][-1]["content"] == "q7":
                import os

                while len([x for x in os.listdir(self.folder) if x.endswith(".asked")]) < 8:  # others first
                    import time

                    time.sleep(0.05)
                time.sleep(2)
                os._exit(3)  # as when an executor is lost
            return super().reply(conversations, **settings)

    df = spark.createDataFrame([(f"q{i}",) for i in range(12)], "q string").withColumn("prompt", qa.plain_prompt(F.col("q")))
    with pytest.raises(Exception):
        qa.replied_once(df, "prompt", Breaking(tmp_path), f"{tmp_path}/log", batch=1, per_task=1).collect()
    done = {r.reply for r in spark.read.schema(qa.LOG).parquet(f"{tmp_path}/log").collect()}
    assert done and "re q7" not in done
    before = asked(tmp_path)
    found = qa.replied_once(df, "prompt", Logged(tmp_path), f"{tmp_path}/log", batch=1).collect()
    assert sorted(r.reply for r in found) == sorted(f"re q{i}" for i in range(12))
    again = [x for x in asked(tmp_path) if asked(tmp_path).count(x) > 1]
    assert len(asked(tmp_path)) - len(before) == 12 - len(done) and not {f"re {x}" for x in again} & done


def test_the_plan_and_its_files_are_the_key(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/cache"
    spark.range(10).write.parquet(src)
    read = lambda: spark.read.parquet(src)
    count = lambda: len([p for p in (tmp_path / "cache").iterdir()])
    assert files.cached(read().where("id > 3"), root).count() == files.cached(read().where("id > 3"), root).count() == 6 and count() == 1
    assert files.cached(read().where("id > 4"), root).count() == 5 and count() == 2
    files.cached(read().where("id > 3"), root, "model 2")
    assert count() == 3

    def udf(k):
        return F.pandas_udf(lambda s: s + k, "long")

    assert [files.cached(read().select(udf(k)("id").alias("x")), root).agg(F.sum("x")).first()[0] for k in (1, 2, 1)] == [55, 65, 55] and count() == 5
    spark.range(2).write.mode("append").parquet(src)
    assert files.cached(read().where("id > 3"), root).count() == 6 and count() == 6
    rows = lambda x: spark.createDataFrame([(x,)], "a int").select("a")
    with pytest.raises(ValueError):
        files.plan_key(rows(1))
    assert files.plan_key(spark.sql("select * from values (1), (2) t(a)")) != files.plan_key(spark.sql("select * from values (1), (3) t(a)"))


def test_two_increments_give_the_batch_anti_join(spark, tmp_path):
    page = lambda i, *urls: (i, "https://h.example.org/", "".join(f'<a href="{u}">x</a>' for u in urls))
    first = [page(1, "/a", "/a", "https://h.example.org/articles/1/2/2020/"), page(2, "/b", "x.png")]
    second = [page(3, "/a", "/c", "/c"), page(4, "/c", "https://h.example.org/articles/1/2/2020/", "https://h.example.org/articles/1/3/2021/")]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, seen.PAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")
        query = seen.seen(seen.pages(spark, f"{tmp_path}/pages", 1)).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    out = spark.read.schema(seen.SEEN).parquet(f"{tmp_path}/out")
    old, new = (links.hrefs(spark.createDataFrame(x, seen.PAGES)) for x in (first, second))
    want = {r.url: r["count"] for r in links.new_links(new, old).groupBy("url").count().collect()}
    fresh = {r.key: r.new for r in out.where("kind = 'link' and new > 0").collect()}
    assert {k: v for k, v in fresh.items() if k not in {r.url for r in old.collect()}} == want == {"https://h.example.org/c": 3, "https://h.example.org/articles/1/3/2021/": 1}
    told = {r["kind"]: (r["keys"], r["new"], r["skipped"]) for r in seen.counters(out).collect()}
    assert told == {"link": (5, 8, 2), "file": (2, 2, 1)}


def test_batches_in_order(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("i"), F.sequence(F.lit(0), (F.col("id") % 21).cast("int")).alias("input_ids")).repartition(5)
    rows = sorted(dataset.padded_batches(dataset.in_batches(df, ["i"], 16)).collect(), key=lambda r: r.i)
    assert [(r.batch, r.place) for r in rows] == [divmod(i, 16) for i in range(100)]
    for b in range(7):
        longest = max((99 - r.i) % 21 + 1 for r in rows if r.batch == b)
        assert {len(r.input_ids) for r in rows if r.batch == b} == {-(-longest // 8) * 8}


def test_shards_by_ranges(spark, tmp_path):
    rng = np.random.default_rng(1)
    shards = [rng.random((n, 5)).astype(t) for n, t in ((40, "float32"), (1, "float64"), (0, "float32"), (33, "float16"))]
    for i, v in enumerate(shards):
        np.save(tmp_path / f"data_{i}.npy", v)
        (tmp_path / f"metadata_rank_{i}.json").write_text(json.dumps([{"filename": f"f{i}", "chunk_index": k, "text": f"é}}{k}"} for k in range(len(v))], indent=1))
    for folder in (str(tmp_path), tmp_path.as_uri()):
        vectors = array_shards.read_array_shards(spark, folder, range_bytes=200)
        assert vectors.rdd.getNumPartitions() == 4 + 1 + 0 + 2
        merged = files.merged_shards(vectors, array_shards.read_metadata_shards(spark, folder))
        rows = merged.orderBy("chunk_id").collect()
        assert [r.chunk_id for r in rows] == list(range(74)) and [r.chunk_index for r in rows] == [*range(40), 0, *range(33)]
        assert np.allclose([r.embedding for r in rows], np.concatenate(shards).astype("float32"))
    np.save(tmp_path / "data_9.npy", np.asfortranarray(np.ones((3, 2))))
    with pytest.raises(Exception, match="row by row"):
        array_shards.read_array_shards(spark, str(tmp_path)).count()


def test_fields_of_an_earlier_pass_are_replaced(spark):
    df = spark.createDataFrame([("abc",)], "url string")

    class Once:
        def fetch(self, url):
            return url

    twice = fetch.fetched(fetch.fetched(df, Once(), wait=(0, 0)), Once(), wait=(0, 0))
    assert twice.columns == ["url", "html", "attempts", "error"] and twice.count() == 1
    e = retrieve.embedded(retrieve.embedded(df, "url", StubEmbedder()), "url", StubEmbedder())
    assert e.columns == ["url", "embedding"] and e.count() == 1
    t = dataset.tokenised(dataset.tokenised(df, "url", "url", StubTokenizer()), "url", "url", StubTokenizer())
    assert len(t.columns) == 4 and t.count() == 1


def test_texts_are_cut_before_they_are_embedded(spark):
    df = spark.createDataFrame([("ab" * 50,), ("ababab",), (None,)], "t string")
    cut = [r.embedding for r in retrieve.embedded(df, "t", StubEmbedder(), StubTokenizer(), 6).collect()]
    assert cut[0] == cut[1] and cut[2] == retrieve.embedded(df, "t", StubEmbedder()).collect()[2].embedding


def test_commands_with_json_and_without_a_model(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"filename": "é", "abstract_text": "About.", "text": "t"}, {"filename": "g", "abstract_text": ""}]))
    with pytest.raises(SystemExit):
        cli.main(["questions", "--input", f"{tmp_path}/a.json", "--output", f"{tmp_path}/q.json"], spark)
    cli.main(["questions", "--input", f"{tmp_path}/a.json", "--output", f"{tmp_path}/q.json", "--json", "--stand-in"], spark)
    found = json.loads((tmp_path / "q.json").read_text(encoding="utf-8"))
    assert {r["filename"]: (r["qa"] or {}).get("question") for r in found} == {"é": "About.?", "g": None}
    assert json_arrays.read_json_array(spark, f"{tmp_path}/q.json", files.ARTICLES_QA).count() == 2


class Counted:
    """Replies with the size of the call and the place in it; fails on a call that has q20."""

    def reply(self, conversations, **settings):
        asked = [c[-1]["content"] for c in conversations]
        if "q20" in asked:
            raise RuntimeError("down")
        return [f"{len(asked)}:{i}:{x}" for i, x in enumerate(asked)]


def test_calls_of_a_fixed_size_in_order(spark):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(40)] + [(100 + i, None) for i in range(5)], "i int, q string").repartition(6)
    asked = df.withColumn("prompt", F.when(F.col("q").isNotNull(), qa.plain_prompt(F.col("q"))))
    rows = {r.i: r for r in qa.replied_in_batches(asked, "prompt", Counted(), ["i"]).collect()}
    assert len(rows) == 45 and all(rows[100 + i].reply is None and rows[100 + i].reply_error is None for i in range(5))
    for i in range(40):
        batch = i // 16
        assert rows[i].reply == (None if batch == 1 else f"{(16, 16, 8)[batch]}:{i % 16}:q{i}") and rows[i].reply_error == ("RuntimeError: down" if batch == 1 else None)
