"""Operators over the whole corpus against brute force on small tables."""

import collections
import functools
import hashlib
import math
import operator
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import iblt, jaccard_join, line_dedup, maxent_lm, quality_gam, queries, suffix_dedup
from orrery.llm.common import keyed_text

ODD = [(1, None), (2, ""), (None, "a b c d e f g. x"), (4, "a b c d e f g. x"), (4, "a b c d e f g. x"), (6, "one")]


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, periodic and odd texts."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    base = [word() for _ in range(60)]
    passage = " ".join(word() for _ in range(55))
    rows = [(1, None), (2, ""), (3, "short"), (4, "xy" * 300), (5, "z" * 99), (6, "é ß " * 60)]
    for i in range(7, 90):
        words = list(base) if i % 2 else [word() for _ in range(rng.randrange(1, 80))]
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = word()
        text = " ".join(words)
        if i % 5 == 0:
            text = text[: len(text) // 2] + "\n" + passage + ".\n" + text[len(text) // 2 :]
        rows.append((i, text.capitalize()))
    rows += [(100 + i, rows[20 + i][1]) for i in range(9)] + [(90, rows[30][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def read_print(text):
    """``n``, bits and blocks (three tables of cells each) of a fingerprint's text."""
    n, bits, cells = text.split(":")
    cells = [(int(c.split(".")[0]), int(c.split(".")[1], 16)) if c else (0, 0) for c in cells.split(",")]
    size = 3 * iblt.CELLS
    return int(n), int(bits), [cells[a : a + size] for a in range(0, len(cells), size)]


def plain_likeness(a, b, digests):
    """By subtracting and peeling the fingerprints' texts alone; None where a block doesn't peel.  ``digests`` knows each digest's cells."""
    (n, k, x), (_, l, y) = read_print(a), read_print(b)
    to = 1 << min(k, l)
    fold = lambda blocks: [[(sum(blk[c][0] for blk in blocks[j::to]), functools.reduce(operator.xor, (blk[c][1] for blk in blocks[j::to]))) for c in range(len(blocks[0]))] for j in range(to)]
    only_a = only_b = 0
    for p, q in zip(fold(x), fold(y)):
        cells = [[c - d, e ^ f] for (c, e), (d, f) in zip(p, q)]
        while pure := next((c for c in cells if abs(c[0]) == 1 and c[1] in digests), None):
            sign, digest = pure
            only_a, only_b = only_a + (sign == 1), only_b + (sign == -1)
            for i in digests[digest]:
                cells[i] = [cells[i][0] - sign, cells[i][1] ^ digest]
        if any(c != [0, 0] for c in cells):
            return None
    return (n - only_a) / (n + only_b) if n + only_b else 1.0


def test_likeness_is_that_of_the_returned_fingerprints(spark, docs):
    df = keyed_text(frame(spark, docs))
    order = sorted(docs, key=lambda r: -r[0])
    edits = [(t or "")[: len(t or "") - len(t or "") // 2] + (u or "")[: len(t or "") // 2] for (_, t), (_, u) in zip(order, order[1:] + order[:1])]
    texts = spark.createDataFrame([(t or "",) for _, t in docs] + [(t,) for t in edits], "text string")
    entries = texts.select(F.explode(iblt._entries(iblt.paragraph_digests(F.col("text")), iblt.CELLS, 1)).alias("e")).select("e.*").distinct().collect()
    cells = {e.k & (1 << 64) - 1: (e.p, iblt.CELLS + e.q, 2 * iblt.CELLS + e.r) for e in entries}
    found = [(plain_likeness(r.fingerprint, r.edited_fingerprint, cells), r.near_edited) for r in iblt.fingerprints(df).collect()]
    assert all(p is None or p == pytest.approx(q) for p, q in found) and sum(p is not None for p, _ in found) > 0.8 * len(found)


def test_fingerprints(spark, docs):
    got = {r.doc_id: r for r in iblt.fingerprints(keyed_text(frame(spark, docs))).collect()}
    order = sorted(docs, key=lambda r: -r[0])
    units = lambda t: {p for p in re.split(r"\n+|(?<=[a-e][.!?]) +", t) if p}
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(alike(units(t), units(edited))) and r.near_next == pytest.approx(alike(units(t), units(after)))
    by_text = collections.defaultdict(set)
    for i, t in docs:
        by_text[t or ""].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_peeling_recovers_the_difference(spark):
    df = spark.createDataFrame([(list(range(30)), list(range(20, 50)))], "a array<long>, b array<long>")
    digest = lambda c: F.transform(c, lambda x: iblt._checked(F.xxhash64(x)))
    row = df.select(iblt.difference(digest("a"), digest("b")).alias("d"), iblt.peeled(iblt.subtracted(iblt.sketch(digest("a"), 2), iblt.sketch(digest("b"), 2)), 2).alias("stuck"), digest("a").alias("x"), digest("b").alias("y")).first()
    assert set(row.d.only_a) == set(row.x) - set(row.y) and set(row.d.only_b) == set(row.y) - set(row.x)
    assert row.stuck is None  # 40 differences don't fit 6 cells; a larger sketch is tried


def brute_components(rows):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [(i, grams(t)) for i, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[max(top(x), top(y))] = min(top(x), top(y))
    low = collections.defaultdict(lambda: math.inf)
    for x in range(len(rows)):
        low[top(x)] = min(low[top(x)], rows[x][0])
    return {i: (len(s), low[top(x)]) for x, (i, s) in enumerate(sets)}


def test_jaccard_join(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(keyed_text(frame(spark, docs))).collect()}
    want = brute_components(docs)
    assert got == want and 30 < len({c for _, c in want.values()}) < len(docs) - 15


def test_small_regions_are_joined_before_the_rounds(spark, monkeypatch):
    """Rounds shuffle all open entries, again and again: what only two or three texts share isn't among those, and sets are fetched by pair."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    twins = [words(60) for _ in range(12)]
    rows = [(2 * i + j, " ".join(w + ["end"] * j)) for i, w in enumerate(twins) for j in (0, 1)]
    rows += [(100 + i, " ".join(words(40) + twins[i][:20])) for i in range(12)]  # share a passage with two, linked with none
    many = words(60)
    rows += [(200 + i, " ".join(many[:i] + many[i + 1 :])) for i in range(0, 60, 6)]
    sizes, assigned = [], jaccard_join._assigned

    def spied(entries, *rest):
        sizes.extend(r["count"] for r in entries.groupBy("seed").count().collect())
        return assigned(entries, *rest)

    monkeypatch.setattr(jaccard_join, "_assigned", spied)
    monkeypatch.setattr(jaccard_join, "PAIRS", 5)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows).items()}
    assert sizes and min(sizes) > jaccard_join.SMALL


def test_region_tasks_work_in_shares_of_the_shingles_range():
    rng = np.random.default_rng(4)
    blocks = [(np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)), rng.integers(0, 9, n)) for n in (5000, 0, 1, 7000)]
    blocks[0][0][:2] = 0
    blocks[3][0][-3:] = (1 << 64) - 1
    shares = list(jaccard_join.in_ranges(blocks))
    assert max(len(k) for k, _ in shares) < 1200
    assert all(a.max() < b.min() for (a, _), (b, _) in zip(shares, shares[1:]))
    every = sorted((int(k), int(v)) for b in blocks for k, v in zip(*b))
    assert sorted((int(k), int(v)) for share in shares for k, v in zip(*share)) == every


def brute_removed(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        marked = bytearray(len(data))
        for k in range(len(data) - width + 1):
            s = data[k : k + width]
            if s in seen:
                marked[k : k + width] = b"\1" * width
            else:
                seen.add(s)
        kept = bytes(c for c, m in zip(data, marked) if not m)
        spans = sum(m and (k == 0 or not marked[k - 1]) for k, m in enumerate(marked))
        out[i] = (len(data), sum(marked), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 3])
def test_suffix_dedup(spark, docs, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(keyed_text(frame(spark, docs))).collect()}
    assert got == brute_removed(docs, 100)


@pytest.mark.parametrize("limit", [{}, {"HOT_STRINGS": 50}, {"FLUSH_STRINGS": 100, "FLUSH_BYTES": 1000, "CHUNK": 300}])
def test_suffix_dedup_of_periodic_texts(spark, monkeypatch, limit):
    """Texts of few keys with very long stretches: no sort holds more strings than a bounded number, and parts of long texts keep all their strings."""
    rng = random.Random(17)
    line = "".join(rng.choice("abcdefgh") for _ in range(90))
    rows = [(i, f"{i} " + line * rng.randrange(3, 9) + "".join(rng.choice("xyz ") for _ in range(rng.randrange(150)))) for i in range(60)] + [(60, "ab" * 900), (61, "ba" * 700)]
    for name, value in limit.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    if "HOT_STRINGS" in limit:
        found = suffix_dedup.repeated(keyed_text(frame(spark, rows)), 3).where("class is null").collect()
        assert found and all(r.strings <= suffix_dedup.HOT for r in found)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(keyed_text(frame(spark, rows))).collect()}
    assert got == brute_removed(rows, 100)


def test_suffix_dedup_where_no_string_of_a_hot_key_repeats_in_its_task(spark, monkeypatch):
    """Every repeating key is hot and every text is handed on by itself, so its strings are all different."""
    for name, value in {"HOT": 1, "FLUSH_STRINGS": 1, "CHUNK": 300}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(23)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = word(400)
    rows = [(i, word(rng.randrange(1, 200)) + passage + word(rng.randrange(1, 200))) for i in range(12)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(keyed_text(frame(spark, rows))).collect()}
    assert got == brute_removed(rows, 100)


def test_stretches_of_long_texts_in_bounded_memory():
    data = random.Random(3).randbytes(6 << 20)
    tracemalloc.start()
    key, owner, start, count, _ = suffix_dedup.stretches([b"short", data])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20 and set(owner.tolist()) == {1}
    assert start[0] == 0 and (start[1:] == start[:-1] + count[:-1]).all() and start[-1] + count[-1] == len(data) - 99


def test_single_stretches_are_told_apart_from_those_that_repeat_themselves():
    rng = random.Random(5)
    for n in range(400):
        piece = bytes(rng.choice(b"abcdef") for _ in range(rng.randrange(1, 70)))
        s = (piece * 200)[: 100 + rng.randrange(120)] if n % 2 else bytes(rng.choice(b"abcdef") for _ in range(150))
        strings = [s[i : i + 100] for i in range(len(s) - 99)]
        assert suffix_dedup._may_repeat(s, 100) or len(set(strings)) == len(strings)
        lo, hi = suffix_dedup.string_hashes(np.frombuffer(s, np.uint8), 100)
        assert len(set(zip(lo.tolist(), hi.tolist()))) == len(set(strings)) and len(lo) == len(strings)
    assert not suffix_dedup._may_repeat(bytes(range(150)), 100)


def brute_repeats(texts, width):
    """Length and places of every string of at least ``width`` that repeats and whose occurrences differ on both sides."""
    places = collections.defaultdict(list)
    for t, text in enumerate(texts):
        for a in range(len(text)):
            for b in range(a + width, len(text) + 1):
                places[text[a:b]].append((t, a))
    ends = lambda p, i: {(q, a) if not 0 <= a + i < len(texts[q]) else texts[q][a + i] for q, a in p}  # noqa: E731  an end is like no other
    return {(len(s), tuple(p)) for s, p in places.items() if len(p) > 1 and len(ends(p, -1)) > 1 and len(ends(p, len(s))) > 1}


def test_maximal_repeats():
    rng = random.Random(9)
    for texts in [[b"banana", b"ananas"], [b"aaaaaaaa"], [b"abcabcabc", b"xabcabcy", b"bcab"], *[[bytes(rng.choice(b"ab") for _ in range(rng.randrange(3, 14))) for _ in range(rng.randrange(1, 6))] for _ in range(60)]]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        count = np.array([max(0, len(t) - 2) for t in texts])
        begins = np.cumsum([0] + [len(t) for t in texts[:-1]])
        step = np.concatenate([np.arange(c) for c in count])
        at = np.repeat(begins, count) + step
        before = np.where(step > 0, data[np.maximum(at - 1, 0)].astype(int), -1)
        groups = suffix_dedup.repeat_groups(np.lib.stride_tricks.sliding_window_view(data, 3)[at], before, np.repeat(np.cumsum(count) - 1, count))
        owner = np.repeat(np.arange(len(texts)), count)
        got = {(d, tuple(sorted((int(owner[i]), int(step[i])) for i in rows))) for rows, d in groups}
        assert got == brute_repeats(texts, 3), texts


def brute_lines(rows, per_cent=75):
    """Per row: the numbers of its lines that a line at an earlier position matches, and what is left."""

    def grams(line):
        w = [x for x in re.split("[ \t\r\f\v]", line.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    low = -(1 << 63)
    each = [(low if i is None else i, k, grams(x)) for i, t in rows for k, x in enumerate((t or "").split("\n"))]
    out = []
    for i, t in rows:
        all_, gone = (t or "").split("\n"), []
        for k, x in enumerate(all_):
            g = grams(x)
            if any((j, m) < (low if i is None else i, k) and 100 * len(g & h) >= per_cent * len(g | h) for j, m, h in each if g and h):
                gone.append(k)
        out.append((i, len(all_), len(gone), ",".join(map(str, gone)), hashlib.sha256("\n".join(x for k, x in enumerate(all_) if k not in gone).encode()).hexdigest()))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def op8(spark, rows, folder):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    got = key(tuple(r) for r in line_dedup.op8_line_dedup(spark, str(folder)).collect())
    assert got == key(con.execute(line_dedup.ORACLE).fetchall())
    return got


def test_line_dedup(spark, docs, tmp_path):
    got = op8(spark, docs, tmp_path)
    assert got == key(brute_lines(docs)) and sum(r[2] for r in got) > 20
    df = frame(spark, docs).withColumn("row", F.lit(1)).withColumn("gone", F.lit(2))
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect() if r.gone + r.row == 3}
    digests = {i: sha for i, _, _, _, sha in got}
    assert all(texts[i] is None if t is None else hashlib.sha256(texts[i].encode()).hexdigest() == digests[i] for i, t in docs)


@pytest.mark.parametrize("few", [80, -1])
def test_line_dedup_groups(spark, tmp_path, few, monkeypatch):
    """Chains and large groups of near copies, common passages, repeated ids, null ids, ties, long and odd lines."""
    monkeypatch.setattr(line_dedup, "FEW_LEVEL", few)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    base, passage = [word() for _ in range(30)], " ".join(word() for _ in range(20))
    rows = [(None, "Subscribe now"), (None, "x y"), (5, "subscribe  now\nalone"), (5, "x\ty\nalone too"), (5, "x\ty\nalone too"), (7, None), (8, ""), (9, " \n\t"), (10, " ".join([word() for _ in range(3000)] * 2))]
    for i in range(20, 80):
        base[rng.randrange(30)] = word()  # each a near copy of the one before
        rows.append((i, "\n".join([" ".join(base), word(), f"{passage} {' '.join(word() for _ in range(rng.randrange(12)))}", "a b c d", "a b c d"])))
    rng.shuffle(rows)
    got = op8(spark, rows, tmp_path)
    assert got == key(brute_lines(rows))
    assert {r[3] for r in got if r[0] == 5} == {"0"} and sum(r[2] for r in got) > 130


def test_line_dedup_short_lines(spark):
    rows = [(1, "Chapter One\n\nx\na b c d"), (2, "chapter  one\n \nX\nA b c d e"), (3, "a b c d\nchapter two\n\nchapter one x"), (4, "a b c d e\nb a c d")]
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert texts == {1: rows[0][1], 2: " \nA b c d e", 3: "chapter two\n\nchapter one x", 4: "b a c d"}


def test_thresholds_under_three_of_four(spark):
    word = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    rows = [(1, word(0, 6)), (2, word(0, 7)), (3, word(20, 25)), (4, word(20, 26)), (5, word(40, 50))]
    for per_cent, linked in ((75, []), (60, [(1, 2)]), (50, [(1, 2), (3, 4)])):
        got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(spark, rows), per_cent).collect()}
        assert got == {i: i for i, _ in rows} | {b: a for a, b in linked}
        assert {(r.doc_id, *r.gone) for r in line_dedup.removed(frame(spark, rows), per_cent).collect()} == {(b, 0) for _, b in linked}
    with pytest.raises(ValueError):
        line_dedup.removed(frame(spark, rows), 0)


def test_language_model(spark, docs):
    df = keyed_text(frame(spark, docs)).withColumn("learn", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    got = {r.doc_id: r for r in maxent_lm.score_texts(df).collect()}
    tokens = {i: [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", (t or ""))] + [None] for i, t in docs}
    learned = [i for i in tokens if zlib.crc32(str(i).encode()) % 10]
    c = collections.Counter(w for i in learned for w in tokens[i])
    n, scale = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
    for i, words in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(c[w] > 0 for w in words), n, zlib.crc32(str(i).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / scale) for w in words))
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_language_model_shuffles_few_changes_and_gaps_of_hashes(spark, docs):
    assert [maxent_lm.training_tasks(n) for n in (0, 1, 12, 101, 6000)] == [1, 1, 12, 12, 375]
    sent = maxent_lm.blocks(maxent_lm.dealt(keyed_text(frame(spark, docs)).withColumn("learn", F.lit(True)), 1), 16)
    gaps = np.frombuffer(maxent_lm.frames_of(sent.where("kind = 0").first()["payload"], 6)[4], np.uint64)
    known = {w for _, t in docs for w in maxent_lm.words(t or "")} | {maxent_lm.END}
    assert np.cumsum(gaps, dtype=np.uint64).tolist() == sorted(maxent_lm.xxhash.xxh3_64_intdigest(w) for w in known)


def trained(docs):
    """The model of ``score_texts`` and its blocks, opened."""
    size, parts = 1, 16
    sent = maxent_lm.written(maxent_lm.blocks(maxent_lm.dealt(docs, size), parts))
    model = maxent_lm.start_model(maxent_lm.statistics(sent, parts), parts)
    ready = maxent_lm.written(maxent_lm.assembled(sent, maxent_lm.replies(sent, model, parts)))
    model = maxent_lm.train(ready, model)
    return model, [maxent_lm.opened(model, r.payload) for r in ready.select("payload").collect()]


def test_maxent_training_holds_a_copy_of_one_table_at_a_time():
    """A block of 3000 words, and two tables of 16 MB: a shard copies one of them and keeps its squares, but not both at once."""
    rng = np.random.default_rng(3)
    n, width, rows = 3000, 16, 1 << 18
    tables = [np.zeros((rows, width), np.float32) for _ in range(2)]
    depth = np.full(width, 2)
    prior = np.zeros(width, np.float32)
    model = maxent_lm.Model(depth, np.ones(width), prior, (np.zeros((width, 16), np.float32), np.zeros((width, 16, 16), np.float32)), 0.1, 10.0, n, n, *tables)
    h = np.sort(rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    seen = rng.integers(1, 1000, n)
    payload = maxent_lm.framed(np.arange(3), np.zeros(3, bool), np.ones(3, bool), np.array([4000, 1, 2999]), h, rng.integers(0, n, 7000).astype(np.uint32), seen, np.zeros(n, np.float32))
    tracemalloc.start()
    changed = [bool(change.any()) for change in maxent_lm.descended(model, payload, 0, 1)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert changed == [True, True] and peak < 3.5 * tables[0].nbytes


def plain_log10(m, b, tokens):
    """Token by token and factor by factor, with Python's own sums."""
    soft = lambda z, i: z[i] - math.log(sum(math.exp(x) for x in z))
    u = np.uint64
    out, history = [], [maxent_lm._BEFORE] * 2
    for w in tokens:
        last, skip = np.array([history[-1]], u), np.array([history[-2]], u)
        both = maxent_lm._mixed(last + (skip << u(1)), maxent_lm._MIX[2])
        row = lambda table, x: table[maxent_lm._rows(x, len(table))[0]].astype(float)
        if b.seen[w]:
            z = row(m.weights, last) + row(m.weights, skip ^ maxent_lm._MIX[0]) + row(m.weights, both ^ maxent_lm._MIX[1]) + m.class_prior
            p = soft(z.tolist(), b.cls[w]) + b.share[w] + math.log(1 - m.unknown)
            table = np.concatenate([m.digit_priors[0], m.digit_priors[1].reshape(-1, 16), np.zeros((1, 16))])
            for e in range(b.first[w], b.first[w] + b.depth[w]):
                node = b.node[e : e + 1]
                y = (row(m.digits, node) if b.prior[e] == len(table) - 1 else 0) + row(m.digits, node ^ last) + table[b.prior[e]]
                p += soft(y.tolist(), b.digit[e])
        else:
            p = math.log(m.unknown / m.unseen)
        out.append(p / math.log(10))
        history.append(b.feature[w])
    return out


def test_language_model_equals_plain_sums(spark, docs):
    df = keyed_text(frame(spark, docs)).withColumn("learn", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    model, opened = trained(df)
    scores = collections.defaultdict(list)
    for r in maxent_lm.score_texts(df).collect():
        scores[r.doc_id].append(r.score)
    for b in opened:
        starts = np.cumsum(b.sizes) - b.sizes
        for i, n, at in list(zip(b.ids.tolist(), b.sizes, starts))[:40]:
            want = plain_log10(model, b, b.sequence[at : at + n])
            assert np.allclose(maxent_lm.log10_probabilities(model, b)[at : at + n], want, atol=1e-4)
            assert any(x == pytest.approx(sum(want), abs=1e-2) for x in scores[i])


def test_language_model_adds_up_and_is_the_same_on_any_partitioning(spark, docs):
    df = keyed_text(frame(spark, docs)).withColumn("learn", F.lit(True))
    model, (b,) = trained(df)
    words = np.arange(len(b.seen))
    assert (b.seen > 0).all() and len(words) > 500
    for pair in ((b.feature[3], b.feature[9]), (maxent_lm._BEFORE, maxent_lm._BEFORE)):
        last, skip = (np.full(len(words), x) for x in pair)
        both = maxent_lm._mixed(last + (skip << np.uint64(1)), maxent_lm._MIX[2])
        p = np.exp(maxent_lm.log_probability(*maxent_lm.forward(model, b, words, last, skip, both)) + b.share) * (1 - model.unknown)
        assert 0.9 < p.sum() + model.unknown < 1 + 1e-3
    other = {(r.doc_id, round(r.score, 6)) for r in maxent_lm.score_texts(df.repartition(1)).collect()}
    assert {(r.doc_id, round(r.score, 6)) for r in maxent_lm.score_texts(df.repartition(7)).collect()} == other


def test_gibberish_scores_below_text_and_known_tokens_gain(spark, sf_dir):
    rng = random.Random(7)
    docs = keyed_text(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("learn", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    held = [(r.doc_id, r.text) for r in docs.where("not learn").collect() if len(r.text.split()) > 20]
    mixed = [(-1 - i, " ".join("".join(rng.sample(w, len(w))) for w in t.split())) for i, t in held]
    both = docs.union(spark.createDataFrame([(i, t, False) for i, t in mixed], docs.schema))
    found = {r.doc_id: r for r in maxent_lm.score_texts(both).collect()}
    mean = lambda ids, c: sum(found[i][c] for i in ids) / sum(found[i].n_tokens for i in ids)
    real, shuffled = [i for i, _ in held], [i for i, _ in mixed]
    assert mean(shuffled, "score") < mean(real, "score") - 0.5
    # tokens that are all known, by the model trained on these texts
    df = both.where("doc_id >= 0")
    model, opened = trained(df)
    gain = n = 0.0
    for b in opened:
        own = np.repeat(~b.learns, b.sizes) & (b.seen[b.sequence] > 0)
        base = np.log10((b.seen[b.sequence] + maxent_lm.SMOOTH) / (model.total + maxent_lm.SMOOTH * (model.types + 1)))
        gain, n = gain + (maxent_lm.log10_probabilities(model, b) - base)[own].sum(), n + own.sum()
    assert n > 500 and gain / n > 0
    rare = math.log10((1 - model.unknown) / model.total)
    assert math.log10(model.unknown / model.unseen) < rare


def test_language_model_predicts_rare_words(spark):
    rng = random.Random(5)
    a, b = ([f"{k}{i:03}x" for i in range(100)] for k in "ab")
    common = [f"c{i:04}x" for i in range(1200)] * 30
    rng.shuffle(common)
    texts = [" ".join(common[i : i + 60]) for i in range(0, len(common), 60)]
    for _ in range(20):
        order = rng.sample(range(100), 100)
        texts += [" ".join(f"{a[i]} {b[i]}" for i in order[k : k + 20]) for k in range(0, 100, 20)]
    held = [" ".join(f"{a[i]} {b[(i + turn) % 100]}" for i in range(100)) for turn in (0, 1)]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(10_000 + i, t, False) for i, t in enumerate(held)]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(2)
    got = {r.doc_id: r for r in maxent_lm.score_texts(df).where("held_out").collect()}
    assert got[10_000].base_score == pytest.approx(got[10_001].base_score)
    assert got[10_000].score > got[10_001].score + 10


def test_language_model_classes():
    assert [maxent_lm.growth(n) for n in (0, 1 << 17, 409_488, 1 << 21, 1 << 40)] == [1, 1, 2, 4, 16]
    assert maxent_lm.class_of(np.array([0, 1, 2, 3, 4, 1 << 40])).tolist() == [-1, 0, 1, 1, 2, 40]
    assert maxent_lm.depths(np.array([10**9, 1, 2, 16, 70, 10**9]), 16).tolist() == [1, 0, 1, 1, 2, 5]
    assert maxent_lm.depths(np.array([1, 2, 300]), 1 << 10).tolist() == [0, 3, 3]


def test_quality(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "cat", "sat", "well", "done"]) for _ in range(40)) + "."
    bad = lambda: " ".join(rng.choice(["###", "$$", "X!!", "|"]) for _ in range(40))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(400)] + [(900, None), (901, "")]
    df = keyed_text(frame(spark, rows))
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_gam.train(df, labels, quality_gam.remainder(3) != 1)
    held = quality_gam.with_score(df, model).where(quality_gam.remainder(3) == 1).where("doc_id < 400").collect()
    assert all((r.score >= 0.5) == (r.doc_id % 4 != 0) for r in held) and len(held) > 100
    assert model.tables and quality_gam.with_score(df, model).where("score is null").count() == 0
    empty = quality_gam.train(df, labels.limit(0), quality_gam.remainder(3) != 1)
    assert quality_gam.with_score(df, empty).count() == len(rows)


@pytest.mark.parametrize("run", [
    lambda d: iblt.fingerprints(d), lambda d: jaccard_join.near_duplicates(d), lambda d: suffix_dedup.dedup(d),
    lambda d: maxent_lm.score_texts(d.withColumn("learn", F.lit(True))),
], ids=["iblt", "jaccard", "suffix", "lm"])
def test_odd_and_empty_tables(spark, run):
    df = keyed_text(spark.createDataFrame(ODD, "doc_id long, text string"))
    assert run(df).count() == len(ODD)
    assert run(df.limit(0)).count() == 0


def test_line_dedup_odd_tables(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in ODD], "doc_id long, text string, line_no int, tokens string")
    kept = collections.Counter((r.doc_id, r.text, r.line_no, r.tokens) for r in line_dedup.dedup_lines(df).collect())
    first = "a b c d e f g. x"
    assert kept == {(1, None, 1, "x"): 1, (2, "", 1, "x"): 1, (None, first, 1, "x"): 1, (4, "", 1, "x"): 2, (6, "one", 1, "x"): 1}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
