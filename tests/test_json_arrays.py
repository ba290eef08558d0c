"""JSON arrays over many tasks: round trips, hard texts, and what isn't an array."""

import json
import random

import pytest
from pyspark.sql import functions as F

from orrery.sources import json_arrays as J

SCHEMA = "i long, t string, a array<struct<b: string>>, o struct<x: double, y: string>"


def records(n):
    rng = random.Random(n)
    bits = ["{", "}", "[", "]", '"', "\\", ",", "é", "\n", "😀", "x" * 50, ' "}', "\\\"}", "{}", ":", "null"]
    text = lambda: "".join(rng.choices(bits, k=rng.randrange(12)))
    return [{"i": i, "t": rng.choice([text(), None]), "a": [{"b": text()} for _ in range(rng.randrange(4))], "o": rng.choice([None, {"x": 0.5, "y": text()}])} for i in range(n)]


def plain(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("indent", [None, 4])
@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_any_split_gives_the_same_records(spark, tmp_path, indent, split):
    rows = records(60)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text(" [ ]\n", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps([{"i": 1000}, {"t": "y" * 5000}, {}]), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = J.read_json_array(spark, str(tmp_path), SCHEMA)
        if split == "1000":
            assert found.rdd.getNumPartitions() > 5
        got = plain(found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    none = {"i": None, "t": None, "a": None, "o": None}
    want = [*rows, none | {"i": 1000}, none | {"t": "y" * 5000}, none]
    assert got == sorted(json.dumps(r, sort_keys=True) for r in want)


def test_parts_are_one_array(spark, tmp_path):
    rows = records(200)
    df = spark.read.schema(SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 7))
    J.write_json_array(df, f"{tmp_path}/parts")
    whole = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "parts").glob("part-*")))
    assert len(list((tmp_path / "parts").glob("part-*"))) > 1 and sorted(json.dumps(r, sort_keys=True) for r in json.loads(whole)) == plain(df)
    assert "é" in whole
    J.merged_file(spark, f"{tmp_path}/parts", f"{tmp_path}/one.json")
    assert json.loads((tmp_path / "one.json").read_text(encoding="utf-8")) == json.loads(whole)
    assert plain(J.read_json_array(spark, f"{tmp_path}/one.json", SCHEMA)) == plain(df)
    J.write_json_array(df.where("false"), f"{tmp_path}/parts")
    assert "".join(p.read_text() for p in sorted((tmp_path / "parts").glob("part-*"))).strip() == "[]"


@pytest.mark.parametrize("text", ['[{"i": 1}, {"i": 2}', '[{"i": 1}, {"i": "2}]', '{"i": 1}', '[1, {"i": 2}]', '[{"i": 1}] x', '[[{"i": 1}]]'])
def test_what_is_no_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="JSON array"):
        J.read_json_array(spark, str(tmp_path), SCHEMA).collect()
