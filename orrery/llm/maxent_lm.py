"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased (A-Z) words and one end per text.  Every word of the training
texts is modelled.  Words of like frequency (one power of two of their counts) form a class, and a class is
split further by the word's hash, four bits at a time, until a leaf holds a few words at most (words
seen once or a few times have shorter paths, as there is little to learn them from):

    P(w | h) = P(class | h) * P(digit 1 | class, h) * ... * P(digit d | digits before, h) * share of w in its leaf

Each factor is a softmax over sums of weight rows: a prior from exact counts (of classes
and of the first two digits; deeper ones start even), and one row for each feature
of the history: the last word and, for classes, the one before it (a skip) and both
together (an n-gram); digits after the second have a row of their own, too.  Rows are found by hash, those of digits also by the node they belong to; words seen
less than ``RARE`` times are features by their class.  A leaf's words share it by their counts.  The
Good-Turing share (of words seen once) belongs to the words never seen in training, whose number Chao's estimate
tells (from the words seen once, and two or three times); each has an equal part of it, so an unknown word costs more than one
seen once.  The probabilities of all words and of so many unknown ones add up to 1 at most (empty leaves keep a little).

Training is distributed gradient descent.  Texts are dealt to shards by a hash, so a
shard depends on the data and not on the cluster.  In every round each shard runs
sparse mini-batches (numpy, Adagrad) over its share of texts from the round's model,
all training texts are visited once over the rounds, and the shards' changes are
averaged row by row.  The tables grow with the number of distinct words (``growth``).

Counts are exact and never gathered anywhere whole: each shard sends its distinct words
to the tasks of their hash ranges and gets their counts and leaf shares back.

Null texts are empty (one end token); null ids count as held out; rows that repeat are learned and scored each
on their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discarded, documents, framed, frames_of, freed_shuffles, written

SMOOTH = 0.1
#: Words seen fewer times are known by their class in histories.
RARE = 4
#: Classes at most (powers of two of a count), bits of a digit, digits at most.
CLASSES, BITS, DIGITS = 48, 4, 6
WAYS = 1 << BITS
#: Hashed weight rows of classes and of digits, before growth.
CLASS_ROWS, DIGIT_ROWS = 1 << 15, 1 << 17
ROUNDS, RATE, MINI_BATCH = 3, 0.25, 16384
#: Bytes of text in a shard, shards a training task takes and fewest training tasks (each sends a change of the tables' size), distinct words a counting task holds, fewest counting tasks (a power of two).
SHARD_BYTES, SHARDS_A_TASK, LEAST_TASKS, PART_WORDS, LEAST_PARTS = 8 << 20, 16, 12, 1 << 21, 16
CHUNKS = 16
END = b""
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_BEFORE = np.uint64(0x1B873593CC9E2D51)


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # ASCII only, both


def growth(types: int) -> int:
    """How many times the constants the tables have as rows for so many distinct words; 16 at most, from 2**27 words on."""
    g = 1
    while g < 16 and types >= (2 * g) ** 3 << 15:
        g *= 2
    return g


def class_of(seen: np.ndarray) -> np.ndarray:
    """The power of two of a count; -1 for words never seen."""
    return np.minimum(np.frexp(seen.astype(float))[1] - 1, CLASSES - 1)


def depths(types: np.ndarray, parts: int) -> np.ndarray:
    """Digits of each class: a few words a leaf, no more than the words' counts can teach, and no leaf in two counting tasks."""
    least = max(1, -(-(parts.bit_length() - 1) // BITS))
    natural = np.round(np.log2(np.maximum(types, 1)) / BITS).astype(int)
    taught = np.maximum(1, np.arange(len(types)))
    return np.where(types > 1, np.clip(np.minimum(natural, taught), least, DIGITS), 0)


def dealt(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` (``doc_id, text, learn``) in shards by a hash of the row, each in order."""
    shards = max(1, size // SHARD_BYTES)
    rows = docs.select("doc_id", "text", "learn").withColumn("_at", F.xxhash64("doc_id", "text"))
    return rows.repartition(shards, "_at").sortWithinPartitions("_at", "doc_id").drop("_at")


def blocks(docs: DataFrame, parts: int) -> DataFrame:
    """``kind, block, part, payload``: tokenised blocks (kind 0) and, for each counting task, their distinct words with training counts (kind 1)."""
    bounded_batches(docs.sparkSession)
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        ids, learn, lengths, tokens = [], [], [], []
        number: dict[bytes, int] = defaultdict(count().__next__)
        size, done = 0, 0

        def flush() -> pa.RecordBatch:
            block = partition << 24 | done
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
            order = np.argsort(h, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            sequence, h = place[np.concatenate(tokens)], h[order]
            sizes = np.array(lengths, np.int64)
            counts = np.bincount(sequence[np.repeat(np.array(learn, bool), sizes)], minlength=len(h)).astype(np.uint32)
            none = np.array([i is None for i in ids])
            rows = [(0, -1, framed(np.array([i or 0 for i in ids], np.int64), none, np.array(learn, bool), sizes, np.diff(h, prepend=np.uint64(0)), sequence))]  # h ascends: gaps take less room
            part = (h >> shift).astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)):
                a, b = edges[p], edges[p + 1]
                rows.append((1, int(p), framed(np.diff(h[a:b], prepend=np.uint64(0)), counts[a:b])))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([p for _, p, _ in rows], pa.int32()), pa.array([x for _, _, x in rows], pa.binary())], names=["kind", "block", "part", "payload"])

        for batch in batches:
            for doc_id, text, learns in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("learn").to_pylist()):
                found = words(text.as_py())
                found.append(END)
                tokens.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
                ids.append(doc_id)
                learn.append(learns)
                lengths.append(len(found))
                size += len(found) * 6
                if size >= 2 * SHARD_BYTES:
                    yield flush()
                    ids, learn, lengths, tokens = [], [], [], []
                    number = defaultdict(count().__next__)
                    size, done = 0, done + 1
        if ids:
            yield flush()

    return docs.mapInArrow(run, "kind int, block long, part int, payload binary")


def _gathered(batches: Iterable[pa.RecordBatch]) -> tuple[list[tuple[int, int]], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray] | None:
    """Of one hash range: who sent words, which ones, the distinct words with their counts, and where the sent ones are among those."""
    senders, hashes, counts = [], [], []
    for batch in batches:
        for block, part, blob in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), batch.column("payload")):
            f = frames_of(blob.as_py(), 2)
            senders.append((block, part))
            hashes.append(np.cumsum(np.frombuffer(f[0], np.uint64), dtype=np.uint64))
            counts.append(np.frombuffer(f[1], np.uint32))
    if not senders:
        return None
    distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
    return senders, hashes, distinct, total, inverse


def statistics(sent: DataFrame, parts: int) -> DataFrame:
    """``class, digits, types, once, seen``: words, words seen once and tokens by class and first two digits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _gathered(batches)) is None:
            return
        _, _, distinct, total, _ = found
        h, total = distinct[total > 0], total[total > 0]
        cell = class_of(total) * WAYS**2 + (h >> np.uint64(64 - 2 * BITS)).astype(np.int64)
        n = CLASSES * WAYS**2
        types, once, seen = np.bincount(cell, minlength=n), np.bincount(cell[total == 1], minlength=n), np.bincount(cell, total, n).astype(np.int64)
        at = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (at // WAYS**2, at % WAYS**2, types[at], once[at], seen[at])], names=["class", "digits", "types", "once", "seen"])

    found = sent.where("kind = 1").select("block", "part", "payload").repartition(parts, "part").mapInArrow(run, "class long, digits long, types long, once long, seen long")
    return found.groupBy("class", "digits").agg(F.sum("types").alias("types"), F.sum("once").alias("once"), F.sum("seen").alias("seen"))


@dataclass
class Model:
    """Priors from the counts, and weight rows."""

    depth: np.ndarray  # digits of each class
    tokens: np.ndarray  # of each class
    class_prior: np.ndarray  # log share of each class
    digit_priors: tuple[np.ndarray, np.ndarray]  # log shares of the first digit by class, of the second by class and first
    unknown: float  # share of tokens never seen
    unseen: float  # words never seen, estimated
    total: int
    types: int
    weights: np.ndarray  # hashed history rows by class
    digits: np.ndarray  # hashed (history, node) rows by digit

    def priors(self) -> np.ndarray:
        """Those of digits, one after the other, and an even one at the end."""
        return np.concatenate([self.digit_priors[0], self.digit_priors[1].reshape(-1, WAYS), np.zeros((1, WAYS), np.float32)])


def unseen_words(once: float, twice: float) -> float:
    """Chao's estimate of the words there are besides those seen; no less than those seen once."""
    return max(1.0, once, once * once / (2 * max(1.0, twice)))


def start_model(stats: DataFrame, parts: int) -> Model:
    """Priors; ``CLASSES * 256`` sums at most reach the driver."""
    types, once, seen = (np.zeros((CLASSES, WAYS, WAYS)) for _ in range(3))
    with freed_shuffles(stats.sparkSession):
        for r in stats.collect():
            at = r["class"], r["digits"] // WAYS, r["digits"] % WAYS
            types[at], once[at], seen[at] = r["types"], r["once"], r["seen"]
    of_class = types.sum(axis=(1, 2))
    total, single, g = int(seen.sum()), max(float(once.sum()), SMOOTH), growth(int(of_class.sum()))
    width = int(np.flatnonzero(of_class).max(initial=0)) + 1
    share = lambda x: np.log((x + 1e-3) / (x + 1e-3).sum(axis=-1, keepdims=True)).astype(np.float32)
    tokens = seen.sum(axis=(1, 2))[:width]
    return Model(
        depths(of_class, parts)[:width], tokens, share(tokens), (share(seen.sum(axis=2)[:width]), share(seen[:width])), single / (total + single) if total else 1.0, unseen_words(single, float(of_class[1])),
        total, int(of_class.sum()), np.zeros((CLASS_ROWS * g, width), np.float32), np.zeros((DIGIT_ROWS * g, WAYS), np.float32),
    )


def replies(sent: DataFrame, model: Model, parts: int) -> DataFrame:
    """``block, part, payload``: for the words that a block sent, their counts and the log share of each in its leaf."""
    depth, tokens = model.depth, model.tokens

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _gathered(batches)) is None:
            return
        senders, hashes, distinct, total, inverse = found
        share = np.zeros(len(distinct), np.float32)
        at = np.flatnonzero(total)
        k = class_of(total[at])
        d = depth[k]
        leaf = np.where(d > 0, (distinct[at] >> (64 - BITS * np.maximum(d, 1)).astype(np.uint64)).astype(np.int64), 0)
        _, of = np.unique(k << (BITS * DIGITS) | leaf, return_inverse=True)
        own = np.bincount(of, total[at])[of] if len(at) else np.zeros(0)
        share[at] = np.log(total[at] / np.where(d > 0, own, tokens[k]))
        a = 0
        for (block, part), h in zip(senders, hashes):
            i = inverse[a : a + len(h)]
            a += len(h)
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([framed(total[i], share[i])], pa.binary())], names=["kind", "block", "part", "payload"])

    return sent.where("kind = 1").select("block", "part", "payload").repartition(parts, "part").mapInArrow(run, "kind int, block long, part int, payload binary")


def assembled(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """``block, payload``: every block with its words' counts and shares."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, fields, counts, shares = None, [], [], []

        def whole() -> pa.RecordBatch:
            payload = framed(*fields, np.concatenate(counts), np.concatenate(shares))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([payload], pa.binary())], names=["block", "payload"])

        for batch in batches:
            for kind, block, blob in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), batch.column("payload")):
                if block != current:
                    if current is not None:
                        yield whole()
                    current, fields, counts, shares = block, [], [], []
                if kind == 0:
                    fields = [bytes(x) for x in frames_of(blob.as_py(), 6)]
                else:
                    f = frames_of(blob.as_py(), 2)
                    counts.append(np.frombuffer(f[0], np.int64))
                    shares.append(np.frombuffer(f[1], np.float32))
        if current is not None:
            yield whole()

    own = sent.where("kind = 0").select("kind", "block", "part", "payload")
    n = max(1, own.count())
    together = own.unionByName(answers).repartition(n, "block").sortWithinPartitions("block", "kind", "part").select("kind", "block", "payload")
    return together.mapInArrow(run, "block long, payload binary")


@dataclass
class Block:
    """A block with what the model needs of each distinct word."""

    ids: np.ndarray
    none: np.ndarray
    learns: np.ndarray
    sizes: np.ndarray
    sequence: np.ndarray  # distinct words by token
    seen: np.ndarray
    share: np.ndarray
    cls: np.ndarray
    feature: np.ndarray  # what the word is in a history
    first: np.ndarray  # its first entry below
    depth: np.ndarray
    node: np.ndarray  # by entry (word and digit): the node's hash, the digit, its place among the priors
    digit: np.ndarray
    prior: np.ndarray


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * by
    return x ^ (x >> np.uint64(32))


def opened(m: Model, payload: bytes) -> Block:
    f = frames_of(payload, 8)
    kinds = (np.int64, np.bool_, np.bool_, np.int64, np.uint64, np.uint32, np.int64, np.float32)
    ids, none, learns, sizes, h, sequence, seen, share = (np.frombuffer(x, k) for x, k in zip(f, kinds))
    h = np.cumsum(h, dtype=np.uint64)
    cls = class_of(seen)
    depth = np.where(cls >= 0, m.depth[cls], 0)
    feature = _mixed(np.where(seen >= RARE, h, (cls + 2).astype(np.uint64)), _MIX[0])
    first = np.cumsum(depth) - depth
    entries = int(depth.sum())
    node, digit, prior = np.empty(entries, np.uint64), np.empty(entries, np.int8), np.empty(entries, np.int32)
    for a in range(0, len(h), MINI_BATCH):  # of some words at a time: a block has several entries for each
        own_depth = depth[a : a + MINI_BATCH]
        owner = np.repeat(np.arange(a, a + len(own_depth)), own_depth)
        i = slice(first[a], first[a] + len(owner))
        level = np.arange(i.start, i.stop) - first[owner]
        own, k = h[owner], cls[owner]
        digit[i] = (own >> (64 - BITS * (level + 1)).astype(np.uint64)).astype(np.int64) & (WAYS - 1)
        before = np.where(level > 0, own >> (64 - BITS * np.maximum(level, 1)).astype(np.uint64), np.uint64(0))
        node[i] = _mixed(before + ((k * 8 + level).astype(np.uint64) << np.uint64(40)), _MIX[1])
        prior[i] = np.where(level == 0, k, np.where(level == 1, len(m.depth) + k * WAYS + before.astype(np.int64), len(m.depth) * (1 + WAYS)))
    return Block(ids, none, learns, sizes, sequence, seen, share, cls, feature, first, depth, node, digit, prior)


def histories(feature: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each token's history: the word before, the one before that, and both; texts begin at ``starts``."""
    last, skip = np.full_like(feature, _BEFORE), np.full_like(feature, _BEFORE)
    last[1:], skip[2:] = feature[:-1], feature[:-2]
    last[starts] = _BEFORE
    skip[starts] = _BEFORE
    second = starts + 1
    skip[second[second < len(feature)]] = _BEFORE
    return last, skip, _mixed(last + (skip << np.uint64(1)), _MIX[2])


def _rows(x: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` (a power of two) by hash."""
    return (x * _MIX[2] >> np.uint64(65 - n.bit_length())).astype(np.int64)


def _sum_of(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = np.take(table, rows[0], axis=0)
    more = np.empty_like(z)
    for r in rows[1:]:
        z += np.take(table, r, axis=0, out=more, mode="clip")
    return z


@dataclass
class Factor:
    """Softmaxes of some tokens' classes or digits: rows of features (with the places they are for, or None for all), targets and shares before division."""

    rows: list[tuple[np.ndarray, np.ndarray | None]]
    target: np.ndarray
    shares: np.ndarray
    total: np.ndarray
    log: np.ndarray  # log probability of each target

    @staticmethod
    def of(z: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray | None]], target: np.ndarray) -> Factor:
        own = z[np.arange(len(z)), target]
        np.clip(z, -60, 60, out=z)
        np.exp(z, out=z)
        total = z @ np.ones(z.shape[1], z.dtype)
        return Factor(rows, target, z, total, np.clip(own, -60, 60).astype(float) - np.log(total))

    def descend(self, table: np.ndarray, squares: np.ndarray) -> None:
        """A gradient step on the weights, in place."""
        g = self.shares / self.total[:, None]
        g[np.arange(len(g)), self.target] -= 1
        for rows, places in self.rows:
            if len(rows):
                _descend(table, squares, rows, g if places is None else np.take(g, places, axis=0))


def class_factor(m: Model, b: Block, word: np.ndarray, last: np.ndarray, skip: np.ndarray, both: np.ndarray) -> Factor:
    """The model's factor of known words' classes, by their histories."""
    k = len(m.weights)
    rows = [_rows(last, k), _rows(skip ^ _MIX[0], k), _rows(both ^ _MIX[1], k)]
    z = _sum_of(m.weights, rows)
    z += m.class_prior
    return Factor.of(z, [(x, None) for x in rows], b.cls[word])


def digit_factor(m: Model, b: Block, word: np.ndarray, last: np.ndarray) -> tuple[Factor, np.ndarray]:
    """That of their digits, and the token of each digit."""
    depth = b.depth[word]
    token = np.repeat(np.arange(len(word)), depth)
    entry = np.repeat(b.first[word] - np.cumsum(depth) + depth, depth) + np.arange(len(token))
    node, prior, k = b.node[entry], b.prior[entry], len(m.digits)
    from_last = _rows(node ^ last[token], k)
    deep = np.flatnonzero(prior == len(m.depth) * (1 + WAYS))  # these have no prior of their own, but a row
    own = _rows(node[deep], k)
    y = np.take(m.digits, from_last, axis=0)
    y += np.take(m.priors(), prior, axis=0)
    y[deep] += np.take(m.digits, own, axis=0)
    return Factor.of(y, [(from_last, None), (own, deep)], b.digit[entry]), token


def forward(m: Model, b: Block, word: np.ndarray, last: np.ndarray, skip: np.ndarray, both: np.ndarray) -> tuple[Factor, Factor, np.ndarray]:
    """The model's factors for known words and their histories: classes, digits, and the token of each digit."""
    return class_factor(m, b, word, last, skip, both), *digit_factor(m, b, word, last)


def log_probability(classes: Factor, digits: Factor, token: np.ndarray) -> np.ndarray:
    return classes.log + np.bincount(token, digits.log, len(classes.log))


def _descend(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One Adagrad step of the rows that a mini-batch touches."""
    order = np.argsort(rows)
    sorted_ = rows[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    g = np.add.reduceat(np.take(gradient, order, axis=0), first, axis=0)
    at = sorted_[first]
    q = np.take(squares, at, axis=0)
    q += g * g
    squares[at] = q
    np.sqrt(q, out=q)
    g *= -RATE
    g /= q
    g += np.take(table, at, axis=0)
    table[at] = g


def descended(m: Model, payload: bytes, turn: int, rounds: int) -> Iterator[np.ndarray]:
    """What one shard's mini-batches of a round change in the weights: the classes' table, then the digits', as neither needs the other."""
    b = opened(m, payload)
    mine = b.learns & (np.arange(len(b.sizes)) % rounds == turn)
    if not mine.any():
        return
    word = b.sequence[np.repeat(mine, b.sizes)]
    own = b.sizes[mine]
    last, skip, both = histories(b.feature[word], np.cumsum(own) - own)
    parts = [slice(a, a + MINI_BATCH) for a in range(0, len(word), MINI_BATCH)]
    local = replace(m, weights=m.weights.copy())
    squares = np.full_like(m.weights, 1e-2)
    for i in parts:
        class_factor(local, b, word[i], last[i], skip[i], both[i]).descend(local.weights, squares)
    del squares
    yield np.subtract(local.weights, m.weights, out=local.weights)
    del local, skip, both
    local = replace(m, digits=m.digits.copy())
    squares = np.full_like(m.digits, 1e-2)
    for i in parts:
        digit_factor(local, b, word[i], last[i])[0].descend(local.digits, squares)
    del squares
    yield np.subtract(local.digits, m.digits, out=local.digits)


def bounds_of(rows: int) -> np.ndarray:
    """Where a table's chunks begin and end."""
    return np.linspace(0, rows, CHUNKS + 1).astype(int)


def training_tasks(shards: int) -> int:
    """How many tasks train: what they shuffle in a round is as many changes of the tables' size, and the tables grow with the input, too."""
    return max(1, min(shards, LEAST_TASKS), shards // SHARDS_A_TASK)


def train(ready: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """Rounds of local descent and averaging over shards; a change of the tables' size reaches the driver from each."""
    spark = ready.sparkSession
    model = replace(model, weights=model.weights.copy(), digits=model.digits.copy())
    n = ready.count()
    source = ready.select("payload").coalesce(training_tasks(n))
    for turn in range(rounds):
        held = spark.sparkContext.broadcast(model)  # the tables' size follows growth, 235 MB at most

        def descend(batches: Iterable[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            m: Model = held.value
            sums = [np.zeros_like(m.weights), np.zeros_like(m.digits)]
            touched = [np.zeros(len(x), np.uint16) for x in sums]
            for batch in batches:
                for payload in batch.column("payload"):
                    for table, change in enumerate(descended(m, payload.as_py(), turn, rounds)):
                        s, t = sums[table], touched[table]
                        for a in range(0, len(s), MINI_BATCH):  # a part at a time: nothing else of a table's size is made
                            part = change[a : a + MINI_BATCH]
                            s[a : a + MINI_BATCH] += part
                            t[a : a + MINI_BATCH] += part.any(axis=1)
                        del change, part
                pa.default_memory_pool().release_unused()
            for table, (s, t) in enumerate(zip(sums, touched)):
                bounds = bounds_of(len(s))
                blobs = [framed(s[a:b].astype(np.float16), t[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([table * CHUNKS + i for i in range(CHUNKS)], pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "change"])

        def average(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            touched: dict[int, np.ndarray] = {}
            for batch in batches:
                for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("change")):
                    f = frames_of(blob.as_py(), 2)
                    t = np.frombuffer(f[1], np.uint16).astype(np.int64)
                    sums[chunk] = sums.get(chunk, 0) + np.frombuffer(f[0], np.float16).astype(np.float32).reshape(len(t), -1)
                    touched[chunk] = touched.get(chunk, 0) + t
            for chunk, s in sums.items():
                blob = framed((s / np.maximum(touched[chunk], 1)[:, None]).astype(np.float32))
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([blob], pa.binary())], names=["chunk", "change"])

        with freed_shuffles(spark):
            rows = source.mapInArrow(descend, "chunk int, change binary").repartition(CHUNKS, "chunk").mapInArrow(average, "chunk int, change binary").collect()
        held.unpersist()
        while rows:  # a chunk at a time, in place
            r = rows.pop()
            table, i = (model.weights, model.digits)[r["chunk"] // CHUNKS], r["chunk"] % CHUNKS
            a, b = bounds_of(len(table))[i : i + 2]
            table[a:b] += np.frombuffer(frames_of(r["change"], 1)[0], np.float32).reshape(b - a, -1)
    return model


def log10_probabilities(m: Model, b: Block) -> np.ndarray:
    """Of every token of a block; in sparse batches."""
    starts = np.cumsum(b.sizes) - b.sizes
    last, skip, both = histories(b.feature[b.sequence], starts)
    out = np.full(len(b.sequence), np.log(m.unknown / m.unseen))
    known = np.flatnonzero(b.seen[b.sequence] > 0)
    for a in range(0, len(known), MINI_BATCH):
        i = known[a : a + MINI_BATCH]
        word = b.sequence[i]
        out[i] = log_probability(*forward(m, b, word, last[i], skip[i], both[i])) + b.share[word] + np.log1p(-m.unknown)
    return out / np.log(10)


def scored(ready: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text."""
    held = ready.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = held.value
        scale = m.total + SMOOTH * (m.types + 1)
        for batch in batches:
            for payload in batch.column("payload"):
                b = opened(m, payload.as_py())
                starts, n = np.cumsum(b.sizes) - b.sizes, len(b.ids)
                base = np.log10((b.seen + SMOOTH) / scale)[b.sequence]
                known = (b.seen > 0)[b.sequence].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.ids, mask=b.none), pa.array(~b.learns), pa.array(b.sizes), pa.array(np.add.reduceat(known, starts)), pa.array(np.full(n, m.total, np.int64)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(log10_probabilities(m, b), starts))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return ready.select("payload").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows of ``docs`` (``doc_id, text, learn``) that may be learned from; score all."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(LEAST_PARTS, 1 << (size // 24 // PART_WORDS).bit_length())
    sent = written(blocks(dealt(docs, size), parts))
    model = start_model(statistics(sent, parts), parts)
    answers = written(replies(sent, model, parts))
    ready = written(assembled(sent, answers))
    discarded(sent, answers)
    return scored(ready, train(ready, model, rounds))


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn_from = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(False))
    return score_texts(documents(spark, sf_dir).withColumn("learn", learn_from))
