"""Operators that map text by text: equal to brute force, to the public libraries, or round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import byte_bpe, media, packing, pii
from orrery.llm.common import keyed_text


def strings(alphabet, n, longest=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(*byte_bpe.public_vocabulary())


def test_bpe_equals_the_library(codec):
    import tiktoken

    path, pattern = byte_bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    for s in [*strings("ab c'st\n\t 12!é\x1f漢😀", 5000), "", "a" * 30000, " " * 9999, "ab" * 9999, " lead", "trail "]:
        ids = codec.encode(s)
        assert ids == library.encode_ordinary(s)
        assert codec.decode(ids) == s.encode()


def test_rank_queue_order():
    rng = random.Random(4)
    queue, held = byte_bpe.RankQueue(3000), []
    for _ in range(5000):
        if held and rng.random() < 0.45:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            entry = (rng.randrange(3000), rng.randrange(100))
            queue.push(*entry)
            held.append(entry)


def test_bpe_rows(spark):
    path, pattern = byte_bpe.public_vocabulary()
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "a b", 9), (2, "a b", 9)], "doc_id long, text string, n_tokens int")
    rows = byte_bpe.digest(keyed_text(df), path, pattern).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 2, 2]
    assert {r.decoded_sha256 for r in rows} == {hashlib.sha256(x).hexdigest() for x in (b"", b"a b")}
    back = byte_bpe.decode(byte_bpe.encode(df, path, pattern), path, pattern)
    assert sorted(bytes(r.payload) for r in back.collect()) == [b"", b"", b"a b", b"a b"]
    assert byte_bpe.digest(keyed_text(df.limit(0)), path, pattern).count() == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and pii.luhn(re.sub("[ -]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(c.isdigit() for c in m) <= 15),
)


def test_pii_equals_the_patterns():
    parts = ["a", "@", ".", "-", "1", "25", "+", " ", "(", "é", "4111 1111 1111 1111", "%", "b.c", "999", "+1 555", "IBAN ", "https://"]
    for s in strings(parts, 30000, 18):
        found = pii.find(s)
        for kind, pattern, ok in BASE:
            assert found[kind] == [m.span() for m in re.finditer(pattern, s) if ok(m.group())], (s, kind)


def test_pii_added_kinds_and_redaction(spark):
    text = "IBAN DE89 3704 0044 0532 0130 00 ok, account no: 12345678, https://u:p@h.org/x and https://h.org/y"
    found = pii.find(text)
    assert [text[a:b] for a, b in found["account"]] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [text[a:b] for a, b in found["url"]] == ["https://u:p@h.org"]
    assert pii.redacted("é me@a.org!") == "é [EMAIL]!"
    clean = "The account of 1234 was in 2020, version 1.2.3 and 300.1.1.1."
    assert pii.redacted(clean) == clean
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a@b.co", "z")], "doc_id long, text string, spans string")
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()] == [None, "", "[EMAIL]"]
    assert pii.spans(df).count() == 3 and pii.spans(df.limit(0)).count() == 0


def test_word_tokenizer_equals_the_library():
    t = packing.WordTokenizer(packing.public_vocabulary())
    cases = [f"b{chr(c)}{chr(c)}A1{chr(c)}!  {chr(c)} x'S" for c in range(0x250)]
    for s in [*cases, *strings("aB c'st\n\t 12!éÇİ.,", 2000), "", "<|endoftext|> a", "漢字 かな", "é"]:
        assert t.encode(s) == t.tokenizer.encode(s, add_special_tokens=False).ids, s


def test_word_tokenizer_holds_words_as_bytes_of_ids():
    t = packing.WordTokenizer(packing.public_vocabulary())
    for s in ["stch. keitä, İA ȺȾ b\x85c\x1b'S 12", "漢字 <|endoftext|>", ""]:
        assert t.packed(s) == np.array(t.encode(s), "<u4").tobytes() and t.encode(s) == t.tokenizer.encode(s, add_special_tokens=False).ids
    assert t.young and all(type(ids) is bytes for ids in t.young.values())


def test_word_tokenizer_with_another_split_goes_to_the_library(tmp_path):
    import json

    settings = json.load(open(packing.public_vocabulary()))
    settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[a-z]+ ?|\S"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(settings))
    t = packing.WordTokenizer(str(path))
    assert t.pieces is None and packing.WordTokenizer(packing.public_vocabulary()).pieces is not None
    assert t.encode("ab cd, e") == t.tokenizer.encode("ab cd, e", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 6000])
def test_cuts(n):
    lengths = packing.cuts(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 2048 for x in lengths) and lengths == sorted(lengths, reverse=True)
    assert len(set(lengths)) == len([x for x in lengths if x < 2048]) + (n >= 2048)


def test_pack_rows(spark):
    path = packing.public_vocabulary()
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "a b c " * 900, 0), (3, "a b c " * 900, 0)], "doc_id long, text string, length int")
    rows = packing.pack(df, path).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    ids = packing.WordTokenizer(path).encode("a b c " * 900) + [1]
    for r in rows:
        whole = ids if r.doc_id == 3 else [1]
        assert r.ids == whole[r.start : r.start + r.length] and r.doc_tokens == len(whole)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sorted(r.length for r in rows if r.doc_id == 3) == sorted(packing.cuts(len(ids)) * 2)
    batches = packing.pack(df.coalesce(1), path, batch_tokens=4096).groupBy("batch_id").agg(F.sum("length"), F.min("length"), F.max("length")).collect()
    assert all(r[1] <= 4096 and r[2] == r[3] == int(r[0].split(":")[0]) for r in batches) and len(batches) < len(rows)
    assert packing.pack(df.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, path, most=100)


def test_media_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "é" * 40), (4, "x" * 64), (4, "x" * 64)], "doc_id long, text string")
    rows = media.features(media.store(df, f"{tmp_path.as_uri()}/a")).collect()
    assert len(rows) == 5
    for r in rows:
        text = {4: "x" * 64, None: "é" * 40}.get(r.doc_id, "")
        n, payload = media.payload(text)
        assert (r.n_bytes, r.payload_bytes) == (n, len(payload)) and r.payload_bytes % 64 == 0 and r.payload_bytes > 0
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.media_sha256 == hashlib.sha256(media.wav(payload)).hexdigest() and r.media_bytes == len(media.wav(payload))
    assert len({r.feature for r in rows if r.doc_id in (1, 2)}) == 1
    assert media.store(df.limit(0), f"{tmp_path.as_uri()}/b").count() == 0


def test_media_appends_and_overwrites(spark, tmp_path):
    folder = f"{tmp_path.as_uri()}/d"
    one = lambda i: spark.createDataFrame([(i, f"text {i}")], "doc_id long, text string")
    assert [sorted(r.doc_id for r in media.store(one(i), folder).collect()) for i in range(3)] == [[0], [0, 1], [0, 1, 2]]
    media.read(spark, folder).where("doc_id = 1").write.format("media_archive").mode("overwrite").save(f"{folder}2")
    media.store(one(9), f"{folder}2")
    media.read(spark, folder).where("doc_id = 2").write.format("media_archive").mode("overwrite").save(f"{folder}2")
    assert [r.doc_id for r in media.read(spark, f"{folder}2").collect()] == [2]


def test_media_plans_bounded_ranges(monkeypatch):
    monkeypatch.setattr(media, "RANGE_BYTES", 100)
    archives = [(f"{i}", 10 + 37 * i) for i in range(20)]
    for most in (3, 1000):
        ranges = media.planned(archives, most)
        assert len(ranges) <= max(most, 1) or most == 1000
        for name, n in archives:
            cuts = sorted((a, b) for r in ranges for x, a, b in r.stretches if x == name)
            assert cuts[0][0] == 0 and cuts[-1][1] == n and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))
    assert media.planned([]) == []


def test_media_ranges_and_retry(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(media, "RANGE_BYTES", 300)
    df = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(200)], "doc_id long, text string").coalesce(1)
    folder = f"{tmp_path.as_uri()}/c"
    assert media.store(df, folder).count() == 200
    reader = media.ArchiveReader(folder)
    ranges = reader.partitions()
    assert len(ranges) > 5
    failed = []
    real = media.zipfile.ZipFile.read

    def flaky(self, info, *a):
        if info.filename not in failed:
            failed.append(info.filename)
            raise OSError("lost")
        return real(self, info, *a)

    monkeypatch.setattr(media.zipfile.ZipFile, "read", flaky)
    found = [x for r in ranges for b in reader.read(r) for x in b.column("doc_id").to_pylist()]
    assert sorted(found) == list(range(200)) and len(failed) == 200
