"""Conversation tries, phrases and url filters against brute force and SQL, with nulls, ties, repeats and long inputs."""

import collections
import hashlib
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest

from orrery.llm import collocations, conversation_trie, link_trust


def by_sql(oracle, folder, name):
    con = duckdb.connect()
    con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    found = con.execute(oracle)
    columns = [d[0] for d in found.description]
    return columns, sorted(found.fetchall(), key=repr)


def same_as_sql(spark, tmp_path, df, name, query, oracle):
    df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    columns, want = by_sql(oracle, tmp_path, name)
    found = query(spark, str(tmp_path))
    assert sorted(found.columns) == sorted(columns)
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    assert got == want
    return want


TURNS = "conv_id long, turn long, role string, text string, n_children long"


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "") + "\0" + (text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h]) + tuple(turns[h:])
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, of in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(of) - 1) * len(p[-1][1]) if p else 0
    ends = collections.defaultdict(list)
    for c, turns in whole.items():
        ends[turns].append(c)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return {(min(of), len(p), min(members[p[:-1]]) if p else None, len(of), kids[p], leaves[p], saved[p], sha(p)) for p, of in members.items()}


def turns_at_random(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-3, 8), *range(95, 130), 200, 205, 950, 2**40]:
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["é", "b", "b", "", None]), turn))
    rows += [(7, None, "user", "null turn", 0), (7, None, "user", "null turn", 0), (7, 1, "user", "tie b", 0), (7, 1, "user", "tie a", 0), (None, 0, "user", "nobody", 0)]
    rows += [(120, t, "user", f"{t % 7}", 0) for t in range(n)] + [(121, t, "user", f"{t % 7}", 0) for t in range(n)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_tries_equal_plain_python(spark, monkeypatch, seed):
    monkeypatch.setattr(conversation_trie, "STRETCH", 4)
    rows = turns_at_random(seed, 40)
    random.Random(seed).shuffle(rows)
    found = [tuple(r) for r in conversation_trie.trie(spark.createDataFrame(rows, TURNS).repartition(5)).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_trie(rows)


def test_tries_equal_sql(spark, tmp_path):
    df = spark.createDataFrame(turns_at_random(3, 9), TURNS)
    rows = same_as_sql(spark, tmp_path, df, "conversations", conversation_trie.op11_conversation_trie, conversation_trie.ORACLE)
    assert any(r[1] == 0 for r in rows)


def test_turnless_conversations_end_at_the_root(spark):
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)  # its only turn is cut, its base isn't there
    (r,) = conversation_trie.trie(spark.createDataFrame([(alone, 0, "user", "x", 0)], TURNS)).collect()
    assert tuple(r) == (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())


def test_an_empty_table_has_no_trie(spark):
    assert conversation_trie.trie(spark.createDataFrame([], TURNS)).collect() == []


def test_many_ends_in_many_pieces(spark):
    rows = [(c, t, "user", "same", 0) for c in range(1000, 4000) for t in range(6)]
    found = {r.depth: r for r in conversation_trie.trie(spark.createDataFrame(rows, TURNS).repartition(4)).collect()}
    assert sorted(found) == list(range(7)) and found[6].n_convs == 3000
    assert found[6].ends_sha256 == hashlib.sha256(",".join(map(str, range(1000, 4000))).encode()).hexdigest()
    assert found[0].saved_tokens == 6 * 2999 * 4 and found[0].n_leaves == 1


DOCS = "doc_id long, text string, lang string, a long, phrase string"


def phrases_at_random(seed):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "Émile", "x", "of", "the"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", "\x0b"]) for _ in range(rng.randrange(120)))
        rows.append((i, text + "new york city hall", rng.choice(["en", "en", None, "de"]), 1, "p"))
    return rows + [(None, None, None, None, None), (1, "", "en", 1, "p"), (1, "", "en", 1, "p"), (2, "a a a a a a " * 60, "en", 1, "p"), (3, "na na " * 100, "de", 1, "p")]


def test_phrases_equal_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 16)
    df = spark.createDataFrame(phrases_at_random(1), DOCS)
    rows = same_as_sql(spark, tmp_path, df, "documents", collocations.op12_phrases, collocations.ORACLE)
    assert {r[0] for r in rows} >= {"en"} and any(r[2].count(" ") == 4 for r in rows)


def brute_phrases(rows, least, words, held):
    import re

    counts, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for m in range(1, words + 1):
                counts.update((lang or "und", tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    candidates = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    gone = {(lang, p[i:j]) for (lang, p), a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= held * candidates[lang, p[i:j]]}
    out = set()
    for (lang, p), a in candidates.items():
        if (lang, p) not in gone:
            cuts = [(1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.add((lang, " ".join(p), len(p), a, k, counts[lang, p[:k]], counts[lang, p[k:]], n[lang], score))
    return out


@pytest.mark.parametrize(("least", "words", "held", "few"), [(3, 4, 100, 1 << 18), (2, 5, 60, 1 << 18), (3, 5, 80, 5), (100, 5, 100, 0)])
def test_phrases_equal_plain_python(spark, monkeypatch, least, words, held, few):
    monkeypatch.setattr(collocations, "FEW", few)  # with few names the broadcast, with more the join
    rows = phrases_at_random(least)
    found = [tuple(r) for r in collocations.phrases(spark.createDataFrame(rows, DOCS).repartition(3), least, words, held).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_phrases(rows, least, words, held)


def test_blocks_end_between_pieces():
    opened = collocations._Open()
    for tokens in collocations._pieces(b"a b. c " * 3 + b"d"):
        opened.add(tokens)
    opened.add([b"e", b"a"])
    seq, words = opened.closed()
    assert [words[i] for i in seq] == [b"a", b"b", b"\n", b"c", b"a", b"b", b"\n", b"c", b"a", b"b", b"\n", b"c", b"d", b"\n"]
    assert [list(opened.words)[1:][i] for i in opened.parts[0]] == [b"e", b"a"]


def test_small_blocks_count_alike(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    rows = phrases_at_random(4)
    blocks = collocations.words_of(spark.createDataFrame(rows, DOCS).coalesce(1))  # workers see the real size; the driver's one only here
    assert blocks.count() >= 1
    run = collocations.phrases(spark.createDataFrame(rows * 2, DOCS), 6)
    assert {tuple(r) for r in run.collect()} == brute_phrases(rows * 2, 6, 5, 100)


def test_scores_past_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**12, 9 * 10**13, [4 * 10**12, 3 * 10**12], [5 * 10**12, 3 * 10**12])], "a long, n long, firsts array<long>, lasts array<long>")
    (r,) = df.select(collocations._lowest_cut(2).alias("c")).select("c.*").collect()
    assert (r.score, r.k, r.l, r.r) == (1000 * 3 * 10**12 * 9 * 10**13 // (4 * 10**12 * 5 * 10**12), 1, 4 * 10**12, 5 * 10**12)


def test_no_documents_no_phrases(spark):
    assert collocations.phrases(spark.createDataFrame([], DOCS)).collect() == []


PAGES = "page_id long, url string, html string, host string, trust string"
LINKED = [
    ("http://a.net/x", '<a href="http://b.io/">b</a><A HREF=//c.io/q>'), ("http://b.io/1", '<a class="x" href="HTTPS://A.net/">'), ("http://c.io/", "<a href=\"http://D.io\"><a href='http://a.net/y'>"),
    ("http://d.io/", None), (None, "<a href='//e.io/'>"), ("nothing", "<a href='//e.io/'>"), ("http://e.org/fr/1", "<a href='//d.io/'><a href='//b.io:80/'>"), ("http://e.org/fr/2", "<a <a href='//d.io/'>"),
    ("http://x.net", ""), ("http://Net/?q#/", "<a href='//d.io/'>"), ("http://g.io", "<a href='http://a.net'>"), ("http://g.io", None), ("http://Example.NET/en/1#x", "<a href='http://h.io'>"), ("https://w.example.com/de/?x", None),
    ("https://w.example.com/fr/", None), ("https://notexample.com/de/1", "<a data-href='//g.io' href='/own'>"), ("x://y://z/p", "<a href='mailto:a@b'>"), (None, None),
]


def test_links_equal_sql(spark, tmp_path):
    df = spark.createDataFrame([(i, u, h, "clash", "clash") for i, (u, h) in enumerate(LINKED)] + [(0, *LINKED[0], "clash", "clash")], PAGES)
    rows = {r[0]: r for r in same_as_sql(spark, tmp_path, df, "pages", link_trust.op13_link_trust, link_trust.ORACLE)}
    verdicts = {i: r[4] for i, r in rows.items()}
    assert verdicts[1] == verdicts[2] == verdicts[10] == "block" and verdicts[3] == verdicts[4] == "allow"
    assert rows[12][3] == "example.net/en/" and rows[13][3] == "example.com/de/" and rows[15][3] is None and rows[8][3] is None


def test_rules_take_the_longest(spark):
    rules = [("allow", "a.com", "/x/"), ("block", "com", "/"), ("block", "a.com", "/x/y/"), ("allow", "a.com", "/x/y/")]
    df = spark.createDataFrame([(u, None) for u in ("http://a.com/x/y/z", "http://b.a.com/x/1", "http://ba.com/x/", "http://com/", "http://a.com")], "url string, html string")
    found = {r.url: (r.rule, r.verdict) for r in link_trust.with_verdicts(df, rules).collect()}
    assert found == {"http://a.com/x/y/z": ("a.com/x/y/", "block"), "http://b.a.com/x/1": ("a.com/x/", "allow"), "http://ba.com/x/": ("com/", "block"), "http://com/": ("com/", "block"), "http://a.com": (None, "allow")}
    with pytest.raises(ValueError):
        link_trust.with_verdicts(df, [("maybe", "a", "/")])


def brute_trust(edges, seeds, damping, rounds):
    out = {h: [0.0, 0.0] for h in {x for e in edges for x in e} | set(seeds)}
    for k in (0, 1):
        pairs = {(a, b) if k == 0 else (b, a) for a, b in edges}
        degree = collections.Counter(a for a, _ in pairs)
        now = {h: seeds.get(h, (0, 0))[k] for h in out}
        for _ in range(rounds + 1):
            for h, v in now.items():
                out[h][k] += v
            new = dict.fromkeys(out, 0.0)
            for a, b in pairs:
                new[b] += damping * now[a] / degree[a]
            now = new
    return out


def test_trust_spreads_along_links_and_distrust_against_them(spark):
    rng = random.Random(5)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b) for a, b in ((rng.choice(hosts), rng.choice(hosts)) for _ in range(30)) if a != b}
    seeds = {"h1": (1.0, 0.0), "h2": (0.25, 0.5), "h3": (0.0, 1.0)}
    found = link_trust.propagated(spark.createDataFrame(sorted(edges), "a string, b string"), spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double"), rounds=6)
    want = brute_trust(edges, seeds, link_trust.DAMPING, 6)
    got = {r.host: (r.trust, r.distrust) for r in found.collect()}
    for h in want:
        assert got.get(h, (0.0, 0.0)) == pytest.approx(tuple(want[h]), abs=1e-9)


def test_no_pages_no_verdicts(spark):
    assert link_trust.with_verdicts(spark.createDataFrame([], PAGES)).collect() == []


def test_a_block_goes_up_in_bounded_memory():
    """A block's pairs are counted, and the block is packed, in little more than a few arrays of its size."""
    rng = np.random.default_rng(3)
    seq = rng.integers(-1, 1500, 1 << 20).astype(np.int32)
    name = np.where(rng.random(1500) < 0.9, np.arange(1500) + 7, -1)
    tracemalloc.start()
    up = collocations._longer(5, "en", seq, name)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70 << 20
    new, (left, right), counts = collocations._pairs_in(up.column("data")[0].as_py())
    known = np.append(name, -1)[seq]
    both = np.flatnonzero((known[:-1] >= 0) & (known[1:] >= 0))
    pairs, many = np.unique(known[both] << 32 | known[both + 1], return_counts=True)
    order = np.argsort(left << 32 | right)
    assert (pairs == (left << 32 | right)[order]).all() and (many == counts[order]).all()
    assert (np.flatnonzero(new >= 0) == both).all() and (left[new[both]] == known[both]).all() and (right[new[both]] == known[both + 1]).all()
