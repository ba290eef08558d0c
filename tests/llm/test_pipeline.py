"""The pipeline stage by stage against plain Python on the small table."""

import hashlib

import corpus_pipeline
from orrery.llm import packing, pii
from tests.llm.test_corpus_operators import brute_components, brute_lines


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns and all(r.n_chars == len(r.text) for r in after if r.text is not None)
        if name == "quality":
            bad = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").collect()}
            gone = set(before) - {r.doc_id for r in after}
            assert gone and len(gone & bad) >= 0.9 * len(bad & set(before)) and all(r.text == before[r.doc_id].text for r in after)
        elif name == "line_dedup":
            want = {i: sha for i, _, _, _, sha in brute_lines([(r.doc_id, r.text) for r in before.values()])}
            assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in after} == want
        elif name == "near_duplicates":
            groups = brute_components([(r.doc_id, r.text) for r in before.values()])
            assert {r.doc_id for r in after} == {i for i, (_, c) in groups.items() if i == c}
        elif name == "personal_data":
            assert {r.doc_id: r.text for r in after} == {i: pii.redacted(r.text) for i, r in before.items()}
        else:
            tokens = packing.WordTokenizer(packing.public_vocabulary())
            assert {(r.doc_id, r.doc_tokens) for r in after} == {(i, len(tokens.encode(r.text)) + 1) for i, r in before.items()}
        before = {r.doc_id: r for r in after} if name != "packing" else before
    assert len(after) == corpus_pipeline.run(spark, sf_dir).count()


def test_packing_stage_returns_the_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens, got = packing.WordTokenizer(packing.public_vocabulary()), {}
    for r in corpus_pipeline.pack(spark, docs, sf_dir).orderBy("doc_id", "start").collect():
        assert len(r.ids) == r.length
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == {i: tokens.encode(t or "") + [packing.END_ID] for i, t in texts.items()}


def test_stages_take_nulls_repeats_and_clashing_columns(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, class string"
    good = [r.text for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").orderBy("doc_id").collect()][:4]
    rows = [(i, t, "en", "s", len(t), 1.0, "r", "c") for i, t in enumerate(good)]
    rows += [rows[0], rows[0], (None, good[1], None, None, None, None, None, None), (7, None, "en", "s", 0, 0.0, "", ""), (None, None, None, None, None, None, None, None), (8, "", "en", "s", 0, 0.0, "", ""), (9, "mail a.b@c.org now", "en", "s", 18, 0.0, "", "")]
    docs = spark.createDataFrame(rows, schema)
    model_free = dict(corpus_pipeline.STAGES)
    kept = model_free["quality"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() <= len(rows)
    lines = model_free["line_dedup"](spark, docs, sf_dir)
    assert lines.columns == docs.columns and lines.count() == len(rows) and lines.where("text is null").count() == 2
    near = model_free["near_duplicates"](spark, docs, sf_dir).collect()
    assert sorted((r.doc_id is None, r.text is None, r.text == "") for r in near if not r.text) == [(False, False, True), (False, True, False), (True, True, False)]
    assert sum(r.text == good[0] for r in near) == 1 and [r.doc_id for r in near if r.text == good[1]] == [None]
    private = {(r.doc_id, r.text) for r in model_free["personal_data"](spark, docs, sf_dir).collect()}
    assert (9, pii.redacted("mail a.b@c.org now")) in private and (7, None) in private
    packed = model_free["packing"](spark, docs, sf_dir)
    assert packed.where("doc_id is null").count() >= 2 and packed.where("doc_id = 7").count() == 1
    nothing = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0, name
