"""N-gram Jaccard join: an exact near-duplicate join in the Jaccard metric space.

Documents are points (their sets of five-word shingles) under the Jaccard
distance, and the join wants all pairs within ``r = 1 - 0.75``.  Between documents
with nothing in common every distance is 1, so sampled documents make useless
pivots.  The first pivots are therefore single shingles: under a global order a
document's nearest pivot is its first shingle, and the window in which a partner's
nearest pivots can lie is its first ``n - ceil(0.75 n) + 3`` shingles: linked texts
with different sets share three there.  A document is replicated to the Voronoi
regions of that window, so every linked pair meets in three regions at least; a class
that meets others in fewer links with nothing.  The triangle inequality through the
empty set gives the length filter; with the places of a shingle in both windows it
tells which region of a pair can be the first that it shares, and only that joins it.

A region of two or three classes is joined at once: it has no more pairs than classes.  Larger
regions join recursively, with documents as pivots.  Every open region draws one, the
member that meets most others and hasn't been drawn before;
each member is assigned to the pivot that it shares most regions with and held
against it.  Links merge components, regions whose members are in one component are
closed, and the others draw again, as long as a round closes a tenth of what is
open.  What is then left is joined pair by pair across components, where the parities of
both sets leave a link possible.  Nothing is capped.

The order puts shingles that several texts share last, each part by hash.  All
shingles are counted, exactly; the shared ones are marked in a filter of fixed size, whose
threshold rises with their number.  Any order gives the same links.
Texts with equal sets are one class throughout, so copies are never paired.  Shingles are 64-bit hashes.

Null and empty texts have no shingles and link with nothing; texts of fewer than
five words are one shingle.  Rows that repeat belong to one class; rows of one id with different texts are different
points, and a null id counts as none when the smallest id is sought.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discarded, documents, least_shared, map_arrow, written

WORDS, PER_CENT = 5, 75
#: Linked texts with different sets share this many shingles at least (3 of 4 is the smallest case at 75 per cent, fewer below:
#: ``least_shared``), so windows are that much wider and a class that meets others in fewer regions is dropped.
SHARED = 3
#: A shingle is frequent from this number of texts on, at least.
FREQUENT = 2
#: Bits of the filters of frequent shingles and of wanted classes (8 MB); one that fills up only filters less.
FILTER_BITS, FILTER_BLOCKS = 26, 64
#: Words of parities by which pairs are told apart before their sets are fetched.
PARITY_WORDS = 16
#: Entries that a task gathers before it hands them on, and that a region task holds (one of these is 24 bytes).
FLUSH, REGION_ENTRIES = 1 << 20, 1 << 21
#: Shares of the shingles' range in which a region task works.
RANGES = 16
#: Classes of a region whose pairs are all held against each other: no more pairs than classes.
SMALL = 3
#: Pairs that are broadcast at once (16 bytes each), so that of all sets only theirs are shuffled; more go one share after the other.
PAIRS = 1 << 20
#: Regions draw another pivot while a round leaves at most this share of the entries open.
WORTH = 0.9

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's word n-grams; A-Z are lower-cased."""
    words = text.encode().lower().split()  # ASCII only, both
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    m = min(n, width)
    out = np.full(n - m + 1, m, np.uint64)
    for j in range(m):
        out += h[j : n - m + 1 + j] * _MULTIPLIERS[j % 5] + np.uint64(j // 5)
    return np.unique(_mixed(out))


def class_of(s: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    h = xxhash.xxh3_64_intdigest(s.tobytes(), 11)
    return h - (1 << 64) if h >> 63 else h


def window(n: int, per_cent: int = PER_CENT) -> int:
    """How many of a set's first shingles the first ``least_shared`` that a partner has can be among."""
    return min(n, n - (per_cent * n + 99) // 100 + least_shared(per_cent, SHARED))


def in_ranges(blocks: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of columns, the first of which ascends, put together a share of its range at a time: what is made of them is a share, too."""
    bounds = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)
    cuts = [[0, *np.searchsorted(b[0], bounds).tolist(), len(b[0])] for b in blocks]
    for k in range(RANGES):
        yield tuple(np.concatenate([x[c[k] : c[k + 1]] for x, c in zip(column, cuts)]) for column in zip(*blocks))


def described(docs: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """One pass over the texts: ``doc_id, n, class`` (null where the set is empty), and ``key, seen`` of the shingles that are frequent.

    A task hands on its shingles once per class, in one sorted block for each part.
    """
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "n", "class", "part", "seeds"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            seed = np.concatenate(held)
            part = (seed % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((seed, part))
            seed, part = seed[order], part[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            filled = [p for p in range(parts) if edges[p] < edges[p + 1]]
            blobs = [zlib.compress(np.diff(seed[edges[p] : edges[p + 1]], prepend=np.uint64(0)).tobytes(), 1) for p in filled]
            return pa.RecordBatch.from_arrays([*(pa.nulls(len(filled), t) for t in types[:3]), pa.array(filled, pa.int32()), pa.array(blobs, pa.binary())], names=names)

        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column("text")]
            classes = [class_of(s) if len(s) else None for s in found]
            for s, c in zip(found, classes):
                if c is not None and c not in seen:
                    seen.add(c)
                    held.append(s)
                    size += len(s)
            columns = [batch.column("doc_id"), [len(s) for s in found], classes, [None] * len(found), [None] * len(found)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c.cast(t) for c, t in zip(columns, types)], names=names)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
                seen.clear()
        if size:
            yield flush()

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [(np.cumsum(np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint64), dtype=np.uint64),) for batch in batches for blob in batch.column("seeds")]
        for (seeds,) in in_ranges(blobs) if blobs else ():
            seed, count = np.unique(seeds, return_counts=True)
            many = count >= FREQUENT
            yield pa.RecordBatch.from_arrays([pa.array(seed[many].view(np.int64)), pa.array(count[many].astype(np.int64))], names=["key", "seen"])

    both = written(docs.select("doc_id", "text").mapInArrow(describe, "doc_id long, n long, class long, part int, seeds binary"))
    counted = written(both.where("part is not null").select("part", "seeds").repartition(parts, "part").mapInArrow(add, "key long, seen long"))
    every = written(both.where("part is null").select("doc_id", "n", "class"))
    discarded(both)
    return every, counted


def _bits_of(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) * _MULTIPLIERS[0] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bits_of(keys)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _filter(keys: DataFrame) -> np.ndarray:
    """Which of ``2**FILTER_BITS`` cells hold a ``key`` (packed), added up from tasks block by block."""
    width = (1 << FILTER_BITS) // FILTER_BLOCKS

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            mask[_bits_of(batch.column("key").to_numpy())] = True
        blocks = [(i, zlib.compress(np.packbits(mask[i * width : (i + 1) * width]).tobytes(), 1)) for i in range(FILTER_BLOCKS) if mask[i * width : (i + 1) * width].any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([b for _, b in blocks], pa.binary())], names=["block", "bits"])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, bits in zip(batch.column("block").to_pylist(), batch.column("bits")):
                part = np.frombuffer(zlib.decompress(bits.as_py()), np.uint8)
                totals[block] = totals[block] | part if block in totals else part
        for block, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "bits"])

    out = np.zeros((FILTER_BLOCKS, width // 8), np.uint8)
    for row in keys.select("key").mapInArrow(mark, "block int, bits binary").repartition(FILTER_BLOCKS, "block").mapInArrow(join, "block int, bits binary").collect():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def frequent_filter(frequent: DataFrame) -> np.ndarray:
    """The filter of the most frequent shingles, as many powers of two of their counts as fill an eighth of it."""
    per_power = {r["power"]: r["n"] for r in frequent.groupBy(F.floor(F.log2("seen")).alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 64 rows at most
    least, total = 63, 0
    while least and total + per_power.get(least - 1, 0) <= 1 << (FILTER_BITS - 3):
        least -= 1
        total += per_power.get(least, 0)
    return _filter(frequent.where(F.col("seen") >= float(1 << least)))


def regions(docs: DataFrame, frequent: np.ndarray, parts: int, per_cent: int = PER_CENT) -> DataFrame:
    """``seed, class, n, pos``: the classes replicated to each shingle's region, where there may be two or more; ``pos`` is the shingle's place in the class's order.

    A task gathers the windows of its texts and sends each region task one
    sorted block; a region task sees one share of the shingles.  Frequent shingles need
    no such meeting: they are dealt by class and pass as they are, so no task gathers one of them.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(frequent)  # FILTER_BITS fix its size
    names = ["part", "entries", "seed", "class", "n", "pos"]

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: list[np.ndarray] = []
        common: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []
        gathered = 0

        def flush() -> Iterator[pa.RecordBatch]:
            seed, many = np.concatenate(seeds), np.concatenate(common)
            lengths = np.array([len(s) for s in seeds])
            owner = np.repeat(np.array([o for o, _ in owners], np.int64), lengths)
            n = np.repeat(np.array([k for _, k in owners], np.int32), lengths)
            pos = (np.arange(len(seed)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            at = np.flatnonzero(many)
            for a in range(0, len(at), 65536):
                x = at[a : a + 65536]
                to = (owner[x].view(np.uint64) % np.uint64(parts)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.nulls(len(x), pa.binary()), pa.array(seed[x].view(np.int64)), pa.array(owner[x]), pa.array(n[x].astype(np.int64)), pa.array(pos[x].astype(np.int64))], names=names)
            seed, owner, n, pos = (x[~many] for x in (seed, owner, n, pos))
            part = (seed % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((seed, part))
            seed, owner, n, pos, part = seed[order], owner[order], n[order], pos[order], part[order]
            edges = np.searchsorted(part, np.arange(parts + 1))
            filled = [p for p in range(parts) if edges[p] < edges[p + 1]]
            blobs = []
            for p in filled:
                a, b = edges[p], edges[p + 1]
                blobs.append(zlib.compress(np.diff(seed[a:b], prepend=np.uint64(0)).tobytes() + owner[a:b].tobytes() + n[a:b].tobytes() + pos[a:b].tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(blobs, pa.binary()), *(pa.nulls(len(filled), pa.int64()) for _ in range(4))], names=names)

        seen: set[int] = set()
        for batch in batches:
            for t in batch.column("text"):
                s = shingles(t.as_py())
                if not len(s) or (c := class_of(s)) in seen:
                    continue
                seen.add(c)
                k = window(len(s), per_cent)
                many = _marked(held.value, s)
                first = np.flatnonzero(~many)[:k]  # sorted by hash already
                if len(first) < k:
                    first = np.concatenate([first, np.flatnonzero(many)[: k - len(first)]])
                seeds.append(s[first])
                common.append(many[first])
                owners.append((c, len(s)))
                gathered += k
                if gathered >= FLUSH:
                    yield from flush()
                    seeds, common, owners, gathered = [], [], [], 0
                    seen.clear()
        if seeds:
            yield from flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            passed = batch.filter(pc.is_null(batch.column("entries")))
            if passed.num_rows:
                yield passed.select(["seed", "class", "n", "pos"])
            for blob in batch.column("entries").drop_null():
                data = zlib.decompress(blob.as_buffer())
                k = len(data) // 24
                blocks.append((np.cumsum(np.frombuffer(data, np.uint64, k), dtype=np.uint64), np.frombuffer(data, np.int64, k, 8 * k), np.frombuffer(data, np.int32, k, 16 * k), np.frombuffer(data, np.int32, k, 20 * k)))
        for entries in in_ranges(blocks) if blocks else ():
            yield from shared(*entries)

    def shared(seed: np.ndarray, owner: np.ndarray, n: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What several classes have, once for each."""
        order = np.lexsort((owner, seed))
        seed, owner, n, pos = seed[order], owner[order], n[order], pos[order]
        fresh = np.ones(len(seed), bool)
        fresh[1:] = (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])
        seed, owner, n, pos = seed[fresh], owner[fresh], n[fresh], pos[fresh]
        same = np.zeros(len(seed) + 1, bool)
        same[1:-1] = seed[1:] == seed[:-1]
        met = same[:-1] | same[1:]
        seed, owner, n, pos = seed[met].view(np.int64), owner[met], n[met].astype(np.int64), pos[met].astype(np.int64)
        for a in range(0, len(seed), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 65536]) for x in (seed, owner, n, pos)], names=["seed", "class", "n", "pos"])

    sent = docs.select("text").mapInArrow(replicate, "part int, entries binary, seed long, class long, n long, pos long")
    # the blocks of one part go to one task; a part's blocks hold a bounded number of entries on average
    return written(sent.repartition(parts, "part").mapInArrow(meet, "seed long, class long, n long, pos long"))


def parities(s: np.ndarray) -> list[int]:
    """For each of ``64 * PARITY_WORDS`` low parts of hashes whether an odd number of shingles have it, as signed words."""
    odd = np.bincount((s & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def members(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, shingles binary, odd array<long>`` (their parities) of the ``wanted`` classes, one row each."""
    held = docs.sparkSession.sparkContext.broadcast(_filter(wanted.select(F.col("class").alias("key"))))  # FILTER_BITS fix its size

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            classes, blobs, odd = [], [], []
            for t in batch.column("text"):
                s = shingles(t.as_py())
                if len(s) and (c := class_of(s)) not in seen and _marked(held.value, np.array([c]))[0]:
                    seen.add(c)
                    classes.append(c)
                    blobs.append(s.tobytes())
                    odd.append(parities(s))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(blobs, pa.binary()), pa.array(odd, pa.list_(pa.int64()))], names=["class", "shingles", "odd"])

    found = docs.select("text").mapInArrow(find, "class long, shingles binary, odd array<long>")
    return written(found.join(wanted, "class", "left_semi").groupBy("class").agg(F.first("shingles").alias("shingles"), F.first("odd").alias("odd")))


def measured(pairs: DataFrame, known: DataFrame, per_cent: int) -> DataFrame:
    """The pairs ``a, b`` (each of them once, in a written table) whose whole sets are near enough."""
    shares = pairs.count() // PAIRS + 1

    def with_sets(k: int) -> DataFrame:
        own = F.broadcast(pairs if shares == 1 else pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(shares)) == k))
        left = known.select(F.col("class").alias("a"), F.col("shingles").alias("sa")).join(own, "a")
        right = known.select(F.col("class").alias("b"), F.col("shingles").alias("sb")).join(own, "b")
        return left.join(right, ["a", "b"]).select("a", "b", "sa", "sb")

    def intersect(batch: pa.RecordBatch) -> dict[str, list]:
        near = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            shared = int(np.count_nonzero(t[at] == s))
            near.append(100 * shared >= per_cent * (len(s) + len(t) - shared))
        return {"a": batch.column("a"), "b": batch.column("b"), "near": near}

    held = map_arrow(reduce(DataFrame.union, map(with_sets, range(shares))), "a long, b long, near boolean", intersect)
    return held.where("near").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of the graph of ``a, b`` links.

    Labels fall to the smallest neighbour's and then jump along labels, so a
    chain's length halves each round; lineage is cut every round.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    moved = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.col("node").alias("was"), F.least("node", "low").alias("component")))
    while True:
        labels = moved.select("node", "component")
        around = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        before, moved = moved, written(lower.join(jump, "component").select("node", "was", F.least("component", "further").alias("component")))
        discarded(before)
        if moved.where("was <> component").isEmpty():
            discarded(edges)
            return moved.drop("was")


def _alike(per_cent: int) -> Column:
    """The length filter."""
    return 100 * F.least("na", "nb") >= per_cent * F.greatest("na", "nb")


def _may_be_first(per_cent: int) -> Column:
    """Whether the shingle can be the first that a linked pair shares: what comes from it on must do for the pair."""
    return (100 + per_cent) * F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= per_cent * (F.col("na") + F.col("nb"))


def _few_differ(per_cent: int) -> Column:
    """Whether the parities leave it possible: two sets differ in as many shingles, at least, as their parities do."""
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.get("oa", F.lit(k)).bitwiseXOR(F.get("ob", F.lit(k)))) for k in range(PARITY_WORDS)])
    return (100 + per_cent) * (F.col("na") + F.col("nb") - differ) >= 2 * per_cent * (F.col("na") + F.col("nb"))


def _open(entries: DataFrame, found: DataFrame) -> DataFrame:
    """``entries`` with their components by the links found, of the regions that hold several."""
    labels = components(found).select(F.col("node").alias("class"), F.col("component").alias("label"))
    placed = entries.join(labels, "class", "left").select("seed", "class", "n", "pos", F.coalesce("label", "class").alias("component"))
    several = placed.groupBy("seed").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("seed")
    return written(placed.join(several, "seed", "left_semi"))


def _assigned(entries: DataFrame, drawn: DataFrame | None, per_cent: int) -> DataFrame:
    """``a, b``: each class with the one pivot, of those its regions draw, that it shares most regions with; none in its own component.

    A region draws the class that has most members in all its regions together and isn't among the ``drawn`` (``b``).
    """
    sizes = entries.groupBy("seed").agg(F.count(F.lit(1)).alias("size"))
    weights = entries.join(sizes, "seed").groupBy("class", "n", "component").agg(F.sum("size").alias("weight"))
    if drawn is not None:
        # not an anti-join, which would be done before the sums, on all entries
        before = drawn.select(F.col("b").alias("class"), F.lit(True).alias("drawn")).distinct()
        weights = weights.join(before, "class", "left").where("drawn is null").drop("drawn")
    state = F.struct("class", "n", "component")
    pivots = entries.select("seed", "class").join(weights, "class").groupBy("seed").agg(F.max_by(state, F.struct("weight", "class")).alias("p"))
    pivots = pivots.select("seed", F.col("p.class").alias("b"), F.col("p.n").alias("nb"), F.col("p.component").alias("cb"))
    met = entries.withColumnRenamed("n", "na").join(pivots, "seed").where((F.col("component") != F.col("cb")) & _alike(per_cent))
    shared = met.groupBy(F.col("class").alias("a"), "b").agg(F.count(F.lit(1)).alias("regions"))
    nearest = shared.groupBy("a").agg(F.max(F.struct("regions", "b")).alias("nearest"))
    return written(nearest.select("a", F.col("nearest.b").alias("b")))


def by_size(entries: DataFrame, per_cent: int = PER_CENT) -> tuple[DataFrame, DataFrame]:
    """``a, b``: the pairs that meet in a small region that can be the first they share; and the entries of the larger regions."""
    sizes = entries.groupBy("seed").count()
    few = entries.join(sizes.where(F.col("count").between(2, SMALL)), "seed", "left_semi")
    x, y = (few.select("seed", *[F.col(c).alias(k + side) for c, k in (("class", ""), ("n", "n"), ("pos", "i"))]) for side in "ab")
    met = x.join(y, "seed").where((F.col("a") < F.col("b")) & _alike(per_cent) & _may_be_first(per_cent))
    return written(met.select("a", "b").distinct()), written(entries.join(sizes.where(F.col("count") > SMALL), "seed", "left_semi"))


def links(entries: DataFrame, known: DataFrame, found: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """``a, b``: the links ``found`` and more, enough of them to connect whatever the join of these regions connects."""
    drawn = None
    open_ = _open(entries, found)
    left = open_.count()
    while left:
        pairs = _assigned(open_, drawn, per_cent)
        new = written(measured(pairs, known, per_cent))
        found = found.union(new)
        was, open_ = open_, _open(open_.drop("component"), found)
        drawn = pairs.select("b") if drawn is None else drawn.union(pairs.select("b"))
        discarded(was)
        before, left = left, open_.count()
        if left > WORTH * before:
            break
    if not left:
        return found
    # what the pivots have left in several components is joined pair by pair across those
    rows = open_.join(known.select("class", "odd"), "class")
    x, y = (rows.select("seed", *[F.col(c).alias(k + side) for c, k in (("class", ""), ("n", "n"), ("pos", "i"), ("component", "c"), ("odd", "o"))]) for side in "ab")
    rest = x.join(y, "seed").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _alike(per_cent) & _may_be_first(per_cent) & _few_differ(per_cent))
    pairs = written(rest.select("a", "b").distinct())
    discarded(open_)
    found = found.union(written(measured(pairs, known, per_cent)))
    discarded(pairs)
    return found


def near_duplicates(docs: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0  # more than four bytes a shingle
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 4 * (102 - per_cent) // 100 // REGION_ENTRIES + 1)
    every, frequent = described(docs, parts)
    met = regions(docs, frequent_filter(frequent), parts, per_cent)
    discarded(frequent)
    several = met.groupBy("seed").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("seed")
    meeting = written(met.join(several, "seed", "left_semi").distinct())
    discarded(met)
    wanted = written(meeting.groupBy("class").count().where(F.col("count") >= least_shared(per_cent, SHARED)).select("class"))
    entries = written(meeting.join(wanted, "class", "left_semi"))
    discarded(meeting)
    discarded(wanted)
    pairs, large = by_size(entries, per_cent)
    discarded(entries)
    asked = written(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).union(large.select("class")).distinct())
    known = members(docs, asked)
    discarded(asked)
    found = links(large, known, written(measured(pairs, known, per_cent)), per_cent)
    discarded(pairs, large, known)
    classes = every.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"))
    joined = components(found).select(F.col("node").alias("class"), "component")
    of_class = classes.join(joined, "class", "left").select("class", "first", F.coalesce("component", "class").alias("component"))
    lowest = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    final = of_class.join(lowest, "component").select("class", "component_id")
    return every.join(final, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


#: The same rows in SQL: all pairs that share a shingle, and what links reach.
ORACLE = r"""
with recursive t as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) g from t),
n as (select doc_id, count(*) n from s group by doc_id),
pairs as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select x, y from pairs join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 75 * (a.n + b.n - k)),
ways as (select x, y from links union all select y, x from links),
reached as (select doc_id x, doc_id y from documents union select r.x, b.y from reached r join ways b on b.x = r.y)
select d.doc_id, coalesce(n, 0) n_shingles, component_id from documents d left join n using (doc_id) join (select x, min(y) component_id from reached group by x) on x = d.doc_id
"""
