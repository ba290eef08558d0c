"""Every ``opN_`` query on the small tables: columns, types and rows by its contract."""

import bisect
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from orrery.llm import byte_bpe, media, packing, pii, quality_gam, queries
from tests.llm.test_corpus_operators import brute_components, brute_lines, brute_removed
from tests.llm.test_text_operators import BASE

L, S, D, B, I = "bigint", "string", "double", "boolean", "int"
COLUMNS = {
    1: {"doc_id": L, "held_out": B, "n_tokens": L, "n_known": L, "train_tokens": L, "base_score": D, "score": D},
    2: {"doc_id": L, "n_tokens": L, "ids_sha256": S, "decoded_sha256": S},
    3: {"doc_id": L, "n_email": L, "n_ip": L, "n_card": L, "n_phone": L, "base_sha256": S, "spans": S},
    4: {"doc_id": L, "n_chars": L, "edited_sha256": S, "fingerprint": S, "edited_fingerprint": S, "near_edited": D, "near_next": D},
    5: {"doc_id": L, "n_bytes": L, "payload_bytes": L, "payload_sha256": S, "tail_crc32": L, "media_bytes": L, "media_sha256": S, "feature": S},
    6: {"doc_id": L, "n_bytes": L, "n_removed": L, "n_spans": L, "kept_sha256": S},
    7: {"doc_id": L, "n_shingles": L, "component_id": L},
    8: {"doc_id": L, "n_lines": L, "n_removed": L, "removed": S, "kept_sha256": S},
    9: {"doc_id": L, "held_out": B, "score": D, "predicted": I},
    10: {"doc_id": L, "start": L, "length": L, "ids_crc32": L, "doc_tokens": L, "sequence_id": L, "offset": L},
}


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def rows(spark, sf_dir, texts):
    by_number = {int(re.match(r"op(\d+)_", name).group(1)): f for name, f in queries.QUERIES.items()}

    def run(number):
        df = by_number[number](spark, sf_dir)
        types = dict(df.dtypes)
        assert {k: types.get(k) for k in COLUMNS[number]} == COLUMNS[number]
        found = df.collect()
        if number != 10:
            assert sorted(r.doc_id for r in found) == sorted(texts)
        return found

    return run


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def held(i, modulus, remainder):
    return zlib.crc32(str(i).encode()) % modulus == remainder


def test_op1(rows, texts):
    tokens = {i: [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t)] + [None] for i, t in texts.items()}
    lower = lambda w: w if w is None else w
    ascii_lower = {i: [None if w is None else re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", texts[i])] + [None] for i in texts}
    c = collections.Counter(w for i in texts if not held(i, 10, 0) for w in ascii_lower[i])
    n = sum(c.values())
    found = rows(1)
    for r in found:
        own = ascii_lower[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 10, 0), len(tokens[r.doc_id]), sum(c[lower(w)] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in own))
        assert math.isfinite(r.score) and r.score < 0
    learned = [r for r in found if not r.held_out]
    assert sum(r.score for r in learned) > sum(r.base_score for r in learned)


def test_op2(rows, texts):
    import tiktoken

    path, pattern = byte_bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.codec(path, pattern).ranks, special_tokens={})
    for r in rows(2):
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(texts[r.doc_id]))


def test_op3(rows, texts):
    for r in rows(3):
        spans = [[(m.start(), m.end()) for m in re.finditer(p, texts[r.doc_id]) if ok(m.group())] for _, p, ok in BASE]
        base = ",".join(f"{k}:{a}:{b}" for (k, _, _), found in zip(BASE, spans) for a, b in found)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == list(map(len, spans)) and r.base_sha256 == sha(base)
        assert set(filter(None, base.split(","))) <= set(r.spans.split(",")) and r.spans == pii.written(pii.find(texts[r.doc_id]), pii.KINDS)


def test_op4(rows, texts):
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    by_text = collections.defaultdict(set)
    for r in rows(4):
        t, u = texts[r.doc_id], texts[after[r.doc_id]]
        half = len(t) // 2
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(t[: len(t) - half] + u[:half]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[t].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len({x for v in by_text.values() for x in v}) > 0.9 * len(by_text)


def test_op5(rows, texts):
    for r in rows(5):
        data = texts[r.doc_id].encode()
        padded = data + b"\0" * (64 - len(data) % 64 if len(data) % 64 or not data else 0)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), sha(padded), zlib.crc32(padded[-64:]))
        x = np.frombuffer(padded, np.uint8).astype(float)
        p = np.array([v / len(x) for v in collections.Counter(padded).values()])
        want = [x.mean(), x.std(), math.sqrt((x**2).mean()), ((x[1:] >= 128) != (x[:-1] >= 128)).sum(), -(p * np.log2(p)).sum()]
        assert np.allclose([float(v) for v in r.feature.split(";")], want, atol=2e-6)
        assert media.samples(media.wav(padded)) == padded and r.media_bytes > r.payload_bytes


def test_op6(rows, texts):
    want = brute_removed(list(texts.items()), 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(6)} == want


def test_op7(rows, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(7)} == brute_components(list(texts.items()))


def test_op8(rows, texts):
    assert {tuple(r) for r in rows(8)} == set(brute_lines(list(texts.items())))


def test_op9(rows, spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = rows(9)
    assert all(r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    good = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 0]
    assert good and bad and np.mean([[g > b for b in bad] for g in good]) > 0.9


def test_op10(rows, texts):
    tokens = packing.WordTokenizer(packing.public_vocabulary())
    by_doc, filled = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows(10):
        by_doc[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids, at = [*tokens.tokenizer.encode(texts[i], add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_a_tree_is_the_best_cut():
    rng = np.random.default_rng(1)
    for _ in range(50):
        g, h = rng.normal(size=7), rng.random(7) + 1
        value = lambda a, b: g[a:b].sum() / (h[a:b].sum() + 1.0)
        gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0)
        cut = max(range(1, 7), key=lambda k: gain(0, k) + gain(k, 7))
        split = gain(0, cut) + gain(cut, 7) > gain(0, 7) + 1e-9
        want = [value(0, cut)] * cut + [value(cut, 7)] * (7 - cut) if split else [value(0, 7)] * 7
        assert np.allclose(quality_gam._tree(g, h, 2, 1.0, 1e-6), want)


def test_a_pair_is_the_best_of_four_parts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        g, h = rng.normal(size=(4, 5)), rng.random((4, 5)) + 1
        parts = lambda i, j: [(slice(None, i), slice(None, j)), (slice(None, i), slice(j, None)), (slice(i, None), slice(None, j)), (slice(i, None), slice(j, None))]
        gain = lambda i, j: sum(g[p].sum() ** 2 / (h[p].sum() + 1.0) for p in parts(i, j))
        i, j = max(((i, j) for i in range(1, 4) for j in range(1, 5)), key=lambda c: gain(*c))
        best, values = quality_gam._quad(g, h, 1.0, 1e-6)
        assert best == pytest.approx(gain(i, j))
        assert all(np.allclose(values[p], g[p].sum() / (h[p].sum() + 1.0)) for p in parts(i, j))


def test_a_score_is_a_sum_of_looked_up_values():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (200, len(quality_gam.FEATURES))).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 2)).astype(float)
    model = quality_gam.fit(x, y)
    assert model.pairs and ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.95
    for row, got in zip(x, model.margin(x)):
        want = model.intercept + sum(t[bisect.bisect_right(e.tolist(), v)] for e, t, v in zip(model.edges, model.tables, row))
        want += sum(t[bisect.bisect_right(a.tolist(), row[i])][bisect.bisect_right(b.tolist(), row[j])] for i, j, a, b, t in model.pairs)
        assert got == pytest.approx(want)


def test_scores_replace_a_column_of_that_name(spark):
    df = spark.createDataFrame([(1, "a b c", 5.0), (2, None, 6.0), (2, None, 6.0)], "doc_id long, text string, score double")
    model = quality_gam.fit(np.zeros((0, len(quality_gam.FEATURES))), np.zeros(0))
    found = quality_gam.with_score(df, model)
    assert found.columns == ["doc_id", "text", "score"] and [r.score for r in found.collect()] == [0.5] * 3
