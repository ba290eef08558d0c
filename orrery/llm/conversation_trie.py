"""Conversation prefix trie, summed up by leaf-peeling message passing.

Conversations are ordered by turn (null first; ties by role and text), null roles and texts are empty.  Every one is rebuilt:
the first ``h`` turns of its base (the conversation whose id is its own less its remainder by 100; all if it has fewer, none if it
isn't there), then its own after its first ``h``; ``h`` is the CRC32 of the decimal id by 6.  Each distinct sequence of
first turns is a node, from the root without turns; the rebuilt conversations that begin with it are its members.

Turns are numbered by ranges of the sorted rows, so a conversation may be of any length: a range numbers its own and adds
what earlier ranges have of the conversation.  A prefix's key is the exclusive or of 128 hash bits of each turn at its place,
taken over stretches of ``STRETCH`` turns and over what the stretches before them have.

A node's name is its smallest member and its depth.  All nodes that a conversation names form one run down the trie, from where a
smaller one leaves it to its own end, so a run is peeled as one: it holds a counter of the runs that hang on its nodes
and haven't finished; a finished run (at first those that nothing hangs on) sends the leaves and saved tokens of its top's subtree to
the run it hangs on, until only the root's is left and finishes.  Rounds follow how often smaller ids leave
a path, not how deep it is.  Then each run's nodes add up what lies below them, by stretches again.

The digest of a node's ends is over one string by its definition: ranges of the sorted ids make pieces of it, and one
task feeds a node's pieces to the hash in order, holding a batch at a time.

A null conversation id names no conversation, so its rows are left out; repeated rows are turns of their own; empty
texts and turnless conversations are nodes' turns and members like others; an empty table has no node, not even the root; other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discarded, table, written

EVERY, HEAD = 100, 6
#: Turns or nodes of one conversation that one task's window holds.
STRETCH = 4096
#: Characters by which equal turns' ties are parted into ranges; the sampled keys are at the driver.
TIE = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEAD)).cast("int")


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (``conv_id, range, at, t1, t2, chars``) and ranges (``conv_id, range, from, before, k``): a turn's number is ``at - from + before + 1``."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", F.concat(role, F.lit("\0"), text).alias("tie"), F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"), F.length(text).cast("long").alias("chars"))
    ranged = turns.repartitionByRange("conv_id", "turn", F.substring("tie", 1, TIE)).sortWithinPartitions("conv_id", "turn", "tie")
    at = F.monotonically_increasing_id()
    rows = written(ranged.select("conv_id", at.alias("at"), "t1", "t2", "chars").withColumn("range", F.shiftright("at", 33)), "turns")
    ranges = rows.groupBy("conv_id", "range").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("k"))
    before = F.sum("k").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range, not each turn
    return rows, written(ranges.withColumn("before", F.coalesce(before, F.lit(0))), "ranges")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, q, t1, t2, chars, length``: the turns of the rebuilt conversations, numbered from 1, and ``conv_id, length`` of each of them."""
    rows, ranges = numbered(conversations)
    pos = F.col("at") - F.col("from") + F.col("before") + 1
    firsts = rows.where(F.col("conv_id") % EVERY == 0).join(ranges, ["conv_id", "range"]).where(pos < HEAD)
    turn = F.struct(pos.alias("q"), "t1", "t2", "chars")
    heads = firsts.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))  # HEAD - 1 turns at most
    each = ranges.groupBy("conv_id").agg(F.sum("k").alias("n")).withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY).withColumn("h", head_turns(F.col("conv_id")))
    own_head = F.slice("head", F.lit(1), F.col("h"))
    known = each.join(heads, "base", "left").select("conv_id", "n", "h", F.coalesce(own_head, F.array().cast("array<struct<q:bigint,t1:bigint,t2:bigint,chars:bigint>>")).alias("head"))
    length = F.size("head") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    known = written(known.withColumn("length", length.cast("long")), "heads")
    moved = ranges.join(known.select("conv_id", "h", F.size("head").alias("m"), "length"), "conv_id")
    own = rows.join(moved, ["conv_id", "range"]).where(pos > F.col("h")).select("conv_id", (pos - F.col("h") + F.col("m")).alias("q"), "t1", "t2", "chars", "length")
    taken = known.select("conv_id", F.inline("head"), "length").select("conv_id", "q", "t1", "t2", "chars", "length")
    steps = written(own.union(taken), "steps")
    lengths = written(known.select("conv_id", "length"), "lengths")
    discarded(rows, ranges, known)
    return steps, lengths


def keyed(steps: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, chars, length``: the key of each prefix and of the one a turn shorter."""
    place = lambda k: F.xxhash64(F.lit(k), "q", "t1", "t2")
    marked = steps.select("conv_id", "q", place(1).alias("x1"), place(2).alias("x2"), "chars", "length", F.floor(F.col("q") / STRETCH).alias("s"))
    inner = Window.partitionBy("conv_id", "s").orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    held = marked.select("*", F.bit_xor("x1").over(inner).alias("k1"), F.bit_xor("x2").over(inner).alias("k2"))
    long = F.col("length") >= STRETCH
    before = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    stretches = marked.where(long).groupBy("conv_id", "s").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    stretches = stretches.select("conv_id", "s", *[F.coalesce(F.bit_xor(f"y{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    moved = held.where(long).join(stretches, ["conv_id", "s"]).withColumns({f"k{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}).drop("b1", "b2")
    both = held.where(~long).unionByName(moved)
    return written(both.select("conv_id", F.col("q").alias("depth"), "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)], "chars", "length"), "keys")


def digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: SHA-256 of each key's conversation ids, ascending and comma-joined."""
    bounded_batches(ends.sparkSession)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
            begins = np.concatenate([[0], new])
            ids = columns[3].tolist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(begins, [*new, len(ids)])]
            yield pa.RecordBatch.from_arrays([pa.array(c[begins]) for c in columns] + [pa.array(texts)], names=[*KEY, "first", "piece"])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, found = [], []
            for *own, _, piece in zip(*[c.to_pylist() for c in batch.columns]):
                if own != key:
                    if key is not None:
                        keys.append(key)
                        found.append(digest.hexdigest())
                    key, digest = own, hashlib.sha256(piece.encode())
                else:
                    digest.update(f",{piece}".encode())
            if keys:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*keys)), pa.array(found)], names=[*KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([*[pa.array([k]) for k in key], pa.array([digest.hexdigest()])], names=[*KEY, "ends_sha256"])

    key = "depth long, k1 long, k2 long"
    ranged = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    cut = ranged.mapInArrow(pieces, f"{key}, first long, piece string")
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, f"{key}, ends_sha256 string")


def _nodes(keys: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, n_convs, saved, length, ends_sha256`` of every node; ``length`` is that of its smallest member."""
    least = F.min(F.struct("conv_id", "length")).alias("least")
    inner = keys.groupBy(*KEY).agg(least, F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = lengths.agg(least, F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "least", "n_convs", zero.alias("p1"), zero.alias("p2"), zero.alias("chars"))
    ends = keys.where("depth = length").select(*KEY, "conv_id").union(lengths.where("length = 0").select(zero, zero, zero, "conv_id"))
    every = inner.unionByName(root).join(digests(ends), KEY, "left")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    return written(every.select("least.conv_id", *KEY, "p1", "p2", "n_convs", saved.alias("saved"), "least.length", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "nodes")


def _runs(nodes: DataFrame) -> DataFrame:
    """``conv_id, top, parent, remaining, leaves, saved``: the run of each conversation that names nodes, before any message."""
    runs = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "p1", "p2")).alias("at"), F.max("depth").alias("end"), F.sum("saved").alias("saved"))
    runs = runs.select("conv_id", F.col("at.depth").alias("top"), "at.p1", "at.p2", "end", "saved")
    over = nodes.select(F.col("conv_id").alias("parent"), (F.col("depth") + 1).alias("top"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    hung = written(runs.where("top > 0").join(over, ["top", "p1", "p2"]).drop("p1", "p2").unionByName(runs.where("top = 0").drop("p1", "p2").withColumn("parent", F.lit(None).cast("long"))), "hung")
    below = hung.where("parent is not null").groupBy(F.col("parent").alias("conv_id")).agg(F.count(F.lit(1)).alias("remaining"), F.max("top").alias("lowest"))
    is_leaf = F.col("lowest").isNull() | (F.col("lowest") <= F.col("end"))  # nothing hangs on the run's last node
    out = written(hung.join(below, "conv_id", "left").select("conv_id", "top", "parent", F.coalesce("remaining", F.lit(0)).alias("remaining"), is_leaf.cast("long").alias("leaves"), "saved"), "runs")
    discarded(hung)
    return out


def _peeled(runs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``conv_id, top, parent, leaves, saved`` of every run when all that hangs on it has finished, and the tables behind that."""
    states = [runs]
    while True:
        last = states[-1]
        sent = last.where("remaining = 0 and parent is not null").groupBy(F.col("parent").alias("conv_id")).agg(F.count(F.lit(1)).alias("_k"), F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        got = lambda c: F.coalesce(c, F.lit(0))
        left = last.where("remaining > 0").join(sent, "conv_id", "left")
        new = written(left.select("conv_id", "top", "parent", (F.col("remaining") - got("_k")).alias("remaining"), (F.col("leaves") + got("_leaves")).alias("leaves"), (F.col("saved") + got("_saved")).alias("saved")), "runs")
        states.append(new)
        if new.isEmpty():
            break
    finished = [s.where("remaining = 0").select("conv_id", "top", "parent", "leaves", "saved") for s in states]
    return reduce(DataFrame.union, finished), states


def trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (``conv_id, turn, role, text``): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    steps, lengths = rebuilt(conversations)
    keys = keyed(steps)
    nodes = _nodes(keys, lengths)
    discarded(steps, keys, lengths)
    runs, states = _peeled(_runs(nodes))
    met = runs.where("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("top") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("hung"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("more"))
    tops = runs.where("parent is not null").select("conv_id", F.col("top").alias("depth"), "parent")
    own = nodes.join(met, ["conv_id", "depth"], "left").join(tops, ["conv_id", "depth"], "left")
    goes_on = F.col("depth") < F.col("length")
    hung = F.coalesce("hung", F.lit(0))
    leaf = (~goes_on & (hung == 0)).cast("long")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id"))
    told = own.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", (hung + goes_on.cast("long")).alias("n_children"), "ends_sha256", "length",
        (leaf + F.coalesce("leaves", F.lit(0))).alias("x_leaves"), (F.col("saved") + F.coalesce("more", F.lit(0))).alias("x_saved"), F.floor(F.col("depth") / STRETCH).alias("s"),
    )
    told = written(told, "told")
    discarded(nodes, *states)
    sums = ("leaves", "saved")
    inner = Window.partitionBy("conv_id", "s").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    held = told.select("*", *[F.sum(f"x_{c}").over(inner).alias(c) for c in sums])
    long = F.col("length") >= STRETCH
    below = Window.partitionBy("conv_id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    stretches = told.where(long).groupBy("conv_id", "s").agg(*[F.sum(f"x_{c}").alias(c) for c in sums])
    stretches = stretches.select("conv_id", "s", *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"b_{c}") for c in sums])
    moved = held.where(long).join(stretches, ["conv_id", "s"]).withColumns({c: F.col(c) + F.col(f"b_{c}") for c in sums})
    both = held.where(~long).unionByName(moved.select(held.columns))
    return both.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
with own as (
  select conv_id c, coalesce(role, '') || chr(0) || coalesce(text, '') tie, coalesce(text, '') text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, '') || chr(0) || coalesce(text, '')) pos from conversations where conv_id is not null),
convs as (
  select c, c - c % 100 base, xor(list_reduce(flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda x, y: case when y >= 0 then xor(x, y) when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, 4294967295::bigint), 4294967295) % 6 h
  from (select distinct c from own)),
taken as (select v.c, o.pos q, o.tie, o.text from convs v join own o on o.c = v.base and o.pos <= v.h),
m as (select c, count(*) m from taken group by c),
steps as (
  select c, q, md5(tie) t, length(text) chars from taken union all
  select o.c, coalesce(m, 0) + pos - h, md5(tie), length(text) from own o join convs using (c) left join m using (c) where pos > h),
keys as (
  select c, q, chars, md5(string_agg(t, ',') over (partition by c order by q)) k from steps union all select c, 0, 0, '' from convs),
paths as (select *, lag(k) over (partition by c order by q) p, q = max(q) over (partition by c) ends from keys),
nodes as (
  select q, k, min(p) p, min(c) c, count(*) n, (count(*) - 1) * min(chars) saved, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) sha from paths group by q, k),
kids as (select q - 1 q, p k, count(*) n from nodes where q > 0 group by all),
told as (select nodes.*, coalesce(kids.n, 0) children from nodes left join kids using (q, k)),
sums as (
  select a.q, a.k, count(*) filter (children = 0) leaves, sum(saved) saved from told join paths a on a.c = told.c and a.q <= told.q group by all)
select t.c conv_id, t.q depth, up.c parent_conv_id, t.n n_convs, t.children n_children, s.leaves n_leaves, s.saved::bigint saved_tokens, t.sha ends_sha256
from told t join sums s using (q, k) left join nodes up on up.q = t.q - 1 and up.k = t.p
"""
