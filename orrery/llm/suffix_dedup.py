"""Suffix-array dedup: bytes covered by a long string that also starts earlier.

A string of ``width`` bytes belongs to the region of its smallest 16-byte gram
hash, so equal strings always meet in one region, and neighbouring strings of a
text mostly share one: a text is cut into stretches of strings with the same
region.  Three passes keep what is moved small:

1. Every text sends one 8-byte key per stretch (sorted, delta-coded, one block
   per task and share of the keys).  A key seen once can't hold a repeat.
2. Texts send the bytes of the stretches whose key repeats.  A task first
   drops stretches that equal one it has sent, since those are known to repeat.
3. A region task builds the suffix array of its stretches, by doubling the number of
   neighbouring strings that are told apart, and with it the common-prefix array.  A stack scan yields the
   prefix-interval tree's nodes of at least ``width`` bytes: each is a group of all occurrences
   of a string.  Nodes whose left extensions are all the same are dropped, since a longer string
   stands for them; the others are the maximal repeats.  All occurrences of one but the
   earliest are removed, at its whole length.

Keys with very many stretches (boundaries of a passage that a large share
of the texts hold) or strings (of periodic texts) go by the hash of each whole string instead, dealt and
pre-aggregated like the rest, so no region grows without bound.  Stretches that no other
one of their key differs from, and that can't repeat themselves, aren't sorted.

Equal texts are one class: only its first document is searched, and every
later copy is removed whole.  Matches never cross documents.  Null texts count as
empty; texts shorter than ``width`` stay whole.  Rows with equal ids and texts get
the same result; null ids count as the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, checkpointed, documents, framed, frames_of, map_arrow

WIDTH, GRAM = 100, 16
#: Strings of one stretch at most, so that periodic texts are cut too.
STRETCH = 4096
#: Keys that a task gathers before it hands them on; the same in bytes of stretches, as they lie in memory, and in strings of hot keys.
FLUSH_KEYS, FLUSH_BYTES, FLUSH_STRINGS = 1 << 20, 48 << 20, 1 << 19
PART_KEYS, PART_BYTES, SORT_STRINGS = 1 << 21, 24 << 20, 1 << 17
#: Bytes of texts whose strings are told apart at once (some ten times eight bytes for each), bytes of a stretch's entry besides its own, and of a hot string.
CHUNK, ENTRY, HOT_ENTRY = 1 << 20, 400, 40
#: A key with more stretches than this, or with more strings in them, goes string by string.
HOT, HOT_STRINGS = 4096, 1 << 18
#: At most this many hot keys are broadcast; beyond, they are joined.
BROADCAST_KEYS = 1 << 16
NULL_ID = (1 << 63) - 1

_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_HALVES = [(np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64), np.uint64(a), np.uint64(b)) for seed, a, b in ((7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), (11, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))]


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of each 16-byte gram, by doubling."""
    h = _BYTE[data]
    step = 1
    while step < GRAM:
        h = (h[:-step] * _MIX) ^ (h[step:] >> np.uint64(7)) ^ (h[step:] << np.uint64(21))
        h ^= h >> np.uint64(31)
        step *= 2
    return h * _MIX


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span, m = 1, h
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[: len(h) - width + 1], m[width - span : width - span + len(h) - width + 1])


def string_hashes(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every ``width`` neighbouring bytes, by doubling."""
    out = []
    for table, a, b in _HALVES:

        def both(x: np.ndarray, y: np.ndarray, a: np.uint64 = a, b: np.uint64 = b) -> np.ndarray:
            return (x ^ (x >> np.uint64(32))) * a + (y ^ (y >> np.uint64(29))) * b

        span, h = 1, table[data]
        while span * 2 <= width:
            h = both(h[:-span], h[span:])
            span *= 2
        n = len(data) - width + 1
        out.append(both(h[:n], h[width - span : width - span + n]))
    return out[0], out[1]


def _inner(h: np.ndarray, key: np.ndarray, span: int) -> np.ndarray:
    """Keys of which one stretch may hold two grams, so that a string may repeat inside it."""
    widest = ~sliding_min(np.pad(~key, span - 1, constant_values=~np.uint64(0)), span)  # largest key of the strings with each gram
    at = np.flatnonzero(widest == h)
    twin = (h[at[1:]] == h[at[:-1]]) & (at[1:] - at[:-1] <= span)
    return np.unique(h[at[1:]][twin])


def stretches(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, text, start and number of strings of each stretch of the texts, and whether it may repeat itself."""
    found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))]
    held, size = [], 0
    for i, t in enumerate(texts):
        for a in range(0, len(t) - width + 1, CHUNK):  # a long text in parts; each string lies in one
            held.append((i, a, t[a : a + CHUNK + width - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                found.append(_stretches(held, width))
                held, size = [], 0
    if held:
        found.append(_stretches(held, width))
    key, owner, start, count, inner = (np.concatenate(x) for x in zip(*found))
    return key, owner, start, count, inner


def _stretches(kept: list[tuple[int, int, bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Those of parts of texts: number of the text, where the part begins, and its bytes."""
    data = np.frombuffer(b"".join(t for _, _, t in kept), np.uint8)
    lengths = np.array([len(t) for _, _, t in kept])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    h = grams(data)
    key = sliding_min(h, width - GRAM + 1)  # of each string, also of those that cross texts
    n = len(key)
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(key[1:], key[:-1], out=fresh[1:])
    fresh[begins] = True
    last = begins + lengths - width  # a text's last string; what follows crosses into the next
    after = last + 1
    fresh[after[after < n]] = True
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, n))
    owner = np.searchsorted(begins, at, side="right") - 1
    inside = at <= last[owner]
    at, count, owner = at[inside], count[inside], owner[inside]
    if len(count) and count.max() > STRETCH:
        pieces = -(-count // STRETCH)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, owner, count = np.repeat(at, pieces) + step * STRETCH, np.repeat(owner, pieces), np.minimum(np.repeat(count, pieces) - step * STRETCH, STRETCH)
    index, offset = np.array([i for i, _, _ in kept]), np.array([a for _, a, _ in kept])
    return key[at], index[owner], at - begins[owner] + offset[owner], count, np.isin(key[at], _inner(h, key, width - GRAM + 1))


def class_of(data: bytes) -> int:
    """A signed 64-bit id of a text."""
    h = xxhash.xxh3_64_intdigest(data, 3)
    return h - (1 << 64) if h >> 63 else h


def repeated(docs: DataFrame, parts: int, width: int = WIDTH) -> DataFrame:
    """``class, key, start, strings`` of the stretches whose key repeats; and, with a null class, ``key`` and its number of stretches where that or its strings are too many for one sort."""
    bounded_batches(docs.sparkSession)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, seen = 0, set()

        def flush() -> pa.RecordBatch:
            key, owner, start, count, inner = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key, kind="stable")
            key, owner, start, count, inner = key[order], owner[order], start[order], count[order], inner[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            run = np.cumsum(first) - 1
            many = np.bincount(run, 1.0 + inner).astype(np.int64)
            more = np.bincount(run, count).astype(np.int64)[run] - count  # strings of the stretches that a key's first stands for
            twice = many[run] > 1  # known to repeat already: only a marker of these goes to the key's task
            sent = first
            part = (key % np.uint64(parts)).astype(np.int64)
            to = np.where(twice, owner.view(np.uint64) % np.uint64(parts), 0).astype(np.int64)
            rows = []
            by = np.lexsort((key, part))
            by = by[sent[by]]
            edges = np.searchsorted(part[by], np.arange(parts + 1))
            back = np.flatnonzero(twice)
            back = back[np.argsort(to[back], kind="stable")]
            back_edges = np.searchsorted(to[back], np.arange(parts + 1))
            for p in range(parts):
                a, b = by[edges[p] : edges[p + 1]], back[back_edges[p] : back_edges[p + 1]]
                if len(a) or len(b):
                    names, who = np.unique(owner[a], return_inverse=True)
                    rows.append((p, framed(np.diff(key[a], prepend=np.uint64(0)), names, who.astype(np.uint32), start[a].astype(np.uint32), count[a].astype(np.uint16), np.minimum(many[run[a]], 65535).astype(np.uint16), more[a].astype(np.uint32), key[b], owner[b], start[b].astype(np.uint32), count[b].astype(np.uint16))))
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["part", "keys"])

        for batch in batches:
            texts, classes = [], []
            for t in batch.column("text"):
                data = t.as_buffer().to_pybytes() if t.as_buffer() is not None else b""
                if len(data) >= width and (c := class_of(data)) not in seen:
                    seen.add(c)
                    texts.append(data)
                    classes.append(c)
            key, owner, start, count, inner = stretches(texts, width)
            held.append((key, np.array(classes, np.int64)[owner], start.astype(np.uint32), count.astype(np.uint16), inner))
            size += len(key)
            if size >= FLUSH_KEYS:
                yield flush()
                held, size = [], 0
                seen.clear()
        if size:
            yield flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, starts, counts, manys, mores = [], [], [], [], [], []
        for batch in batches:
            for blob in batch.column("keys"):
                f = frames_of(blob.as_py(), 11)
                key = np.cumsum(np.frombuffer(f[0], np.uint64), dtype=np.uint64)
                keys.append(key)
                owners.append(np.frombuffer(f[1], np.int64)[np.frombuffer(f[2], np.uint32)])
                starts.append(np.frombuffer(f[3], np.uint32))
                counts.append(np.frombuffer(f[4], np.uint16))
                manys.append(np.frombuffer(f[5], np.uint16))
                mores.append(np.frombuffer(f[6], np.uint32))
                if len(f[7]):
                    yield _stretch_rows(np.frombuffer(f[7], np.uint64), np.frombuffer(f[8], np.int64), np.frombuffer(f[9], np.uint32), np.frombuffer(f[10], np.uint16))
        if not keys:
            return
        key, owner, start, count, many, more = (np.concatenate(x) for x in (keys, owners, starts, counts, manys, mores))
        del keys, owners, starts, counts, manys, mores
        order = np.lexsort((start, owner, key))
        key, owner, start, count, many, more = key[order], owner[order], start[order], count[order], many[order].astype(np.int64), more[order]
        again = np.zeros(len(key), bool)  # the same stretch from several copies of its text
        again[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1]) & (start[1:] == start[:-1]) & (many[1:] == 1) & (many[:-1] == 1)
        key, owner, start, count, many, more = (x[~again] for x in (key, owner, start, count, many, more))
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        run = np.cumsum(first) - 1
        total = np.bincount(run, many).astype(np.int64)
        out = (total[run] > 1) & (many == 1)  # the others came by themselves
        for a in range(0, len(key), 1 << 16):
            o = out[a : a + (1 << 16)]
            yield _stretch_rows(*(x[a : a + (1 << 16)][o] for x in (key, owner, start, count)))
        is_hot = (total > HOT) | (np.bincount(run, count.astype(float) + more) > HOT_STRINGS)
        hot = np.flatnonzero(first)[is_hot]
        n = len(hot)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(key[hot].view(np.int64)), pa.nulls(n, pa.int64()), pa.array(total[is_hot])], names=["class", "key", "start", "strings"])

    sent = docs.select("text").mapInArrow(send, "part int, keys binary")
    return sent.repartition(parts, "part").mapInArrow(meet, "class long, key long, start long, strings long")


def _stretch_rows(key: np.ndarray, owner: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.ascontiguousarray(key).view(np.int64)), pa.array(start.astype(np.int64)), pa.array(count.astype(np.int64))], names=["class", "key", "start", "strings"])


def suffix_array(strings: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at rows of bytes, and the common prefix of each with the one before (0 where under a row's width).

    Row ``i + 1`` begins one byte after row ``i``, up to row ``last[i]``, where the text ends.
    A rank is the place where a row's group of equals begins; each round tells twice as many rows on apart.
    """
    n, width = strings.shape
    order = np.argsort(np.ascontiguousarray(strings).view(f"V{width}").ravel(), kind="stable")
    sorted_ = strings[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    ranks = [rank]
    while True:
        rank = ranks[-1]
        step = 1 << (len(ranks) - 1)
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        inside = tied + step <= last[tied]
        if not inside.any():
            break
        then = np.where(inside, rank[np.minimum(tied + step, n - 1)], -1 - tied)  # where the text ends first, like no other
        by = np.lexsort((then, rank[tied]))
        tied, then = tied[by], then[by]
        own = rank[tied]
        group = np.concatenate([[True], own[1:] != own[:-1]])
        begins = np.maximum.accumulate(np.where(group, np.arange(len(tied)), 0))
        split = group | np.concatenate([[True], then[1:] != then[:-1]])
        deeper = rank.copy()
        deeper[tied] = own + np.maximum.accumulate(np.where(split, np.arange(len(tied)), 0)) - begins
        ranks.append(deeper)
    order = np.argsort(ranks[-1], kind="stable")
    same = np.zeros(n, np.int64)  # rows from each on that equal those of the one before
    if n > 1:
        a, b = order[:-1], order[1:]
        m = np.zeros(n - 1, np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            x, y = a + m, b + m
            both = (x <= last[a]) & (y <= last[b])
            m += np.where(both & (ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)]), 1 << k, 0)
        same[1:] = m
    return order, np.where(same > 0, same + width - 1, 0)


def prefix_intervals(common: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Nodes ``(depth, first, last)`` of the common-prefix interval tree of at least ``least``, by a stack scan."""
    deep = common >= least
    at = np.flatnonzero(deep | np.append(deep[1:], False))  # all others are alone
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []  # depth and left end of the open intervals
    values, places = np.append(np.where(deep, common, 0)[at], -1).tolist(), at.tolist()
    for i in range(1, len(values)):
        depth = values[i]
        left = i - 1
        while stack and stack[-1][0] > depth:
            d, left = stack.pop()
            out.append((d, places[left], places[i - 1]))
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))
    return out


def repeat_groups(strings: np.ndarray, before: np.ndarray, last: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Maximal repeats of at least a row's width: all occurrences (rows) of each string whose left extensions differ, and its length.

    ``before`` has the byte before each row, or -1 where that isn't known (which differs from everything).
    """
    order, common = suffix_array(strings, last)
    nodes = prefix_intervals(common, strings.shape[1])
    if not nodes:
        return []
    depth, first, end = np.array(nodes).T
    left = before[order]
    differs = np.zeros(len(order), np.int64)
    differs[1:] = left[1:] != left[:-1]
    changes, unknown = np.cumsum(differs), np.concatenate([[0], np.cumsum(left == -1)])
    maximal = (changes[end] > changes[first]) | (unknown[end + 1] > unknown[first])
    return [(order[a : b + 1], d) for d, a, b in zip(depth[maximal].tolist(), first[maximal].tolist(), end[maximal].tolist())]


def _later(order_keys: tuple[np.ndarray, ...], groups: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The rows that aren't the earliest of their group, and their groups' lengths."""
    n = len(order_keys[0])
    rank = np.empty(n, np.int64)
    rank[np.lexsort(order_keys[::-1])] = np.arange(n)
    length = np.zeros(n, np.int64)
    for rows, depth in groups:
        earliest = rows[np.argmin(rank[rows])]
        kept = length[earliest]
        length[rows] = np.maximum(length[rows], depth)
        length[earliest] = kept
    at = np.flatnonzero(length)
    return at, length[at]


def _covered(owner: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes from ``start`` on as merged runs: owner, start, end."""
    if not len(start):  # no string repeats
        return owner, start, start
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    end = start + (length[order] if isinstance(length, np.ndarray) else length)
    other = np.ones(len(start), bool)
    other[1:] = owner[1:] != owner[:-1]
    far = np.int64(1) << 40  # beyond any text's end
    base = np.cumsum(other) * far
    reach = np.maximum.accumulate(end + base)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start + base)[1:] > reach[:-1]
    a = np.flatnonzero(fresh)
    b = np.append(a[1:], len(start)) - 1
    return owner[a], start[a], (reach - base)[b]


def _strings_of(pieces: list[tuple[bytes, int, int, int]], width: int) -> tuple[np.ndarray, ...]:
    """Both hashes, first id, class and start of every string of the stretches."""
    data = np.frombuffer(b"".join(s for s, *_ in pieces), np.uint8)
    lengths = np.array([len(s) for s, *_ in pieces])
    begins, count = np.cumsum(lengths) - lengths, lengths - width + 1
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(begins, count) + step
    lo, hi = string_hashes(data, width)
    place = np.array([p for _, *p in pieces], np.int64)
    return lo[at], hi[at], np.repeat(place[:, 0], count), np.repeat(place[:, 1], count), np.repeat(place[:, 2], count) + step


def _repeats(lo: np.ndarray, hi: np.ndarray, first: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each string, in the order that comes with it, equals the one before: the earliest of equals comes first."""
    order = np.lexsort((start, owner, first, hi, lo))
    again = np.zeros(len(lo), bool)
    again[1:] = (lo[order[1:]] == lo[order[:-1]]) & (hi[order[1:]] == hi[order[:-1]])
    return again, order


def _may_repeat(s: bytes, width: int) -> bool:
    """Whether a stretch may hold a string twice: then what all its strings share is there twice, too."""
    n = len(s) - width + 1
    return n > 1 and (n > width - GRAM + 1 or s.find(s[n - 1 : width], n) >= 0)


_RUNS = ["class", "start", "end"]


def _runs(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (owner, start, end)], names=_RUNS)


def removed_runs(texts: DataFrame, parts: int, width: int = WIDTH) -> DataFrame:
    """``class, start, end`` runs of bytes that repeat something earlier.

    ``texts`` has ``class, first`` (the class's first id), ``text`` and its
    repeating stretches ``found array<struct<key, start, strings, hot>>``.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[bytes, tuple[int, int, int, int]] = {}  # stretch: first id, class, start, key
        known: list[tuple[int, int, int]] = []  # runs that repeat an earlier stretch of this task
        hot: list[tuple[bytes, int, int, int]] = []  # stretches of hot keys: bytes, first id, class, start
        whole: list[tuple[np.ndarray, ...]] = []  # their strings: hashes, first id, class, start
        size, hot_bytes, n_whole = 0, 0, 0

        def flush() -> pa.RecordBatch:
            bins: dict[int, list] = {}
            for s, place in strings.items():
                bins.setdefault(place[3] % parts, [[], None, []])[0].append((place[3] & ((1 << 64) - 1), s, place))
            runs = [np.array(known, np.int64).reshape(-1, 3)]
            if whole:
                lo, hi, first, owner, start = (np.concatenate(x) for x in zip(*whole))
                again, order = _repeats(lo, hi, first, owner, start)
                runs.append(np.stack(_covered(owner[order[again]], start[order[again]], width), axis=1))
                once = order[~again]
                part = (lo[once] % np.uint64(parts)).astype(np.int64)
                by = np.argsort(part, kind="stable")
                once, edges = once[by], np.searchsorted(part[by], np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(edges)).tolist():
                    i = once[edges[p] : edges[p + 1]]
                    bins.setdefault(p, [[], None, []])[1] = lo[i], hi[i], np.stack((first[i], owner[i], start[i]), axis=1)
            every = np.concatenate(runs)
            to = (every[:, 0].view(np.uint64) + np.arange(len(every), dtype=np.uint64)) % np.uint64(parts)
            by = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[by], np.arange(parts + 1, dtype=np.uint64))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                bins.setdefault(p, [[], None, []])[2] = every[by[edges[p] : edges[p + 1]]]
            rows = []
            nothing = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
            for p, (a, b, c) in bins.items():
                a.sort(key=lambda x: x[0])
                rows.append((p, framed(
                    b"".join(s for _, s, _ in a), np.array([len(s) for _, s, _ in a], np.int64), np.array([q[:3] for _, _, q in a], np.int64), np.diff(np.array([k for k, _, _ in a], np.uint64), prepend=np.uint64(0)),
                    *(b or nothing), np.asarray(c, np.int64),
                )))
                a.clear()
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["part", "bytes"])

        for batch in batches:
            for c, first, text, found in zip(batch.column("class"), batch.column("first"), batch.column("text"), batch.column("found")):
                data, c, first = text.as_buffer().to_pybytes(), c.as_py(), first.as_py()
                for x in found.as_py():
                    start, n = x["start"], x["strings"]
                    s = data[start : start + n + width - 1]
                    if x["hot"]:
                        hot.append((s, first, c, start))
                        hot_bytes += len(s)
                        if hot_bytes >= CHUNK >> 2:
                            whole.append(_strings_of(hot, width))
                            n_whole += len(whole[-1][0])
                            hot, hot_bytes = [], 0
                        continue
                    place = (first, c, start, x["key"])
                    other = strings.get(s)
                    if other is None:
                        strings[s] = place
                        size += len(s) + ENTRY
                    else:
                        strings[s] = min(place, other)
                        late = max(place, other)
                        known.append((late[1], late[2], late[2] + len(s)))
                        size += ENTRY >> 1
                if size >= FLUSH_BYTES or n_whole >= FLUSH_STRINGS:
                    yield flush()
                    strings, known, whole, size, n_whole = {}, [], [], 0, 0
        if hot:
            whole.append(_strings_of(hot, width))
        if strings or known or whole:
            yield flush()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[bytes, tuple[int, int, int, int]] = {}
        low, high, places = [], [], []
        for batch in batches:
            for blob in batch.column("bytes"):
                f = frames_of(blob.as_py(), 8)
                ends = np.cumsum(np.frombuffer(f[1], np.int64)).tolist()
                keys = np.cumsum(np.frombuffer(f[3], np.uint64), dtype=np.uint64).tolist()
                a = 0
                late = []
                for b, (first, owner, start), key in zip(ends, np.frombuffer(f[2], np.int64).reshape(-1, 3).tolist(), keys):
                    s = bytes(f[0][a:b])
                    a = b
                    place = (first, owner, start, key)
                    other = strings.get(s)
                    if other is None:
                        strings[s] = place
                    else:
                        strings[s] = min(place, other)
                        x = max(place, other)
                        late.append((x[1], x[2], x[2] + len(s)))
                runs = np.concatenate([np.array(late, np.int64).reshape(-1, 3), np.frombuffer(f[7], np.int64).reshape(-1, 3)])
                if len(runs):
                    yield _runs(runs[:, 0], runs[:, 1], runs[:, 2])
                if len(f[4]):
                    low.append(np.frombuffer(f[4], np.uint64))
                    high.append(np.frombuffer(f[5], np.uint64))
                    places.append(np.frombuffer(f[6], np.int64).reshape(-1, 3))
        if low:
            lo, hi, at = np.concatenate(low), np.concatenate(high), np.concatenate(places)
            del low, high, places
            again, order = _repeats(lo, hi, at[:, 0], at[:, 1], at[:, 2])
            late = order[again]
            if len(late):
                yield _runs(*_covered(at[late, 1], at[late, 2], width))
            del lo, hi, at, again, order, late
        # strings of one key stay in one sort
        items = sorted(((place[3], s, place[:3]) for s, place in strings.items()), key=lambda x: x[0])
        del strings
        group: list = []
        n = 0
        for i, item in enumerate(items):
            same = i > 0 and item[0] == items[i - 1][0]
            if not same and not (i + 1 < len(items) and items[i + 1][0] == item[0]) and not _may_repeat(item[1], width):
                continue
            if n >= SORT_STRINGS and not same:
                yield from sort(group)
                group, n = [], 0
            group.append(item)
            n += len(item[1]) - width + 1
        yield from sort(group)

    def sort(group: list) -> Iterator[pa.RecordBatch]:
        if len(group) < 2 and not (group and len(group[0][1]) > width):
            return
        data = np.frombuffer(b"".join(s for _, s, _ in group), np.uint8)
        lengths = np.array([len(s) for _, s, _ in group])
        begins = np.cumsum(lengths) - lengths
        count = lengths - width + 1
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(begins, count) + step
        place = np.array([p for _, _, p in group], np.int64)
        first, owner, start = np.repeat(place[:, 0], count), np.repeat(place[:, 1], count), np.repeat(place[:, 2], count) + step
        before = np.where(step > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -1)
        last = np.repeat(np.cumsum(count) - 1, count)
        groups = repeat_groups(np.lib.stride_tricks.sliding_window_view(data, width)[at], before, last)
        if groups:
            rows, length = _later((first, owner, start), groups)
            yield _runs(*_covered(owner[rows], start[rows], length))

    bounded_batches(texts.sparkSession)
    sent = texts.select("class", "first", "text", "found").mapInArrow(send, "part int, bytes binary")
    return sent.repartition(parts, "part").mapInArrow(search, "class long, start long, end long")


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs`` (``doc_id, text``)."""

    def describe(batch: pa.RecordBatch) -> dict[str, list]:
        data = [t.as_py().encode() for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(x) for x in data], "class": [class_of(x) for x in data], "sha": [hashlib.sha256(x).hexdigest() for x in data]}

    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = checkpointed(map_arrow(docs, "doc_id long, n_bytes long, class long, sha string", describe).withColumn("id", F.coalesce("doc_id", F.lit(NULL_ID))))
    total = every.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    firsts = every.where(F.col("n_bytes") >= width).groupBy("class").agg(F.min("id").alias("first"))

    found = checkpointed(repeated(docs, max(least, total // 40 // PART_KEYS + 1), width))
    hot = found.where("class is null").select("key", F.lit(True).alias("is_hot"))
    few = hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    entries = found.where("class is not null").join(F.broadcast(hot) if few else hot, "key", "left")
    per_class = entries.groupBy("class").agg(F.collect_set(F.struct("key", "start", "strings", F.coalesce("is_hot", F.lit(False)).alias("hot"))).alias("found"))
    moved = entries.agg(F.sum(F.when(F.col("is_hot"), F.col("strings") * HOT_ENTRY).otherwise(F.col("strings") + width)).alias("n")).first()["n"] or 0

    def tag(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [class_of(t.as_py().encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(classes, pa.int64())], names=["id", "text", "class"])

    tagged = docs.withColumn("id", F.coalesce("doc_id", F.lit(NULL_ID))).select("id", "text").mapInArrow(tag, "id long, text string, class long")
    with_first = per_class.join(firsts, "class").select("class", F.col("first").alias("id"), "found")
    texts = tagged.join(with_first, ["class", "id"]).withColumnRenamed("id", "first")
    runs = removed_runs(texts, max(least, moved // PART_BYTES + 1), width)
    # not cut off from what is above: both joins then share one shuffle of the texts
    gone = runs.groupBy("class").agg(F.collect_set(F.struct("start", "end")).alias("runs"))

    def cut(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"class": batch.column("class"), "id": batch.column("id"), "n_removed": [], "n_spans": [], "kept": []}
        for text, found_runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
            data, at, kept = text.as_buffer().to_pybytes(), 0, hashlib.sha256()
            spans = merged([(r["start"], r["end"]) for r in found_runs])
            for a, b in spans:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            out["n_removed"].append(sum(b - a for a, b in spans))
            out["n_spans"].append(len(spans))
            out["kept"].append(kept.hexdigest())
        return out

    changed = map_arrow(tagged.join(gone.join(firsts, "class").withColumnRenamed("first", "id"), ["class", "id"]).select("class", "id", "text", "runs"), "class long, id long, n_removed long, n_spans long, kept string", cut).dropDuplicates(["class", "id"])
    rows = every.join(firsts, "class", "left").join(changed, ["class", "id"], "left")
    copy = F.coalesce(F.col("first") < F.col("id"), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir))


#: The same rows in SQL, over all 100-byte strings as hexadecimal digits.
ORACLE = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) hx, octet_length(encode(coalesce(text, ''))) n from documents),
p as (select doc_id, i, substr(hx, 2 * i + 1, 200) s from (select doc_id, hx, unnest(range(0, n - 99)) i from d where n >= 100)),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) r from p) where r > 1),
marked as (select *, case when i > lag(i) over (partition by doc_id order by i) + 100 or lag(i) over (partition by doc_id order by i) is null then 1 else 0 end begins from late),
runs as (select doc_id, min(i) a, max(i) + 100 b from (select *, sum(begins) over (partition by doc_id order by i) run from marked) group by doc_id, run),
gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) low, a high from runs union all
  select d.doc_id, coalesce(max(b), 0), max(n) from d left join runs using (doc_id) group by d.doc_id),
kept as (select doc_id, string_agg(substr(hx, 2 * low + 1, 2 * (high - low)), '' order by low) k from gaps join d using (doc_id) group by doc_id)
select d.doc_id, n n_bytes, coalesce(r.removed, 0)::bigint n_removed, coalesce(r.spans, 0)::bigint n_spans, sha256(unhex(k)) kept_sha256
from d join kept using (doc_id) left join (select doc_id, sum(b - a) removed, count(*) spans from runs group by doc_id) r using (doc_id)
"""
