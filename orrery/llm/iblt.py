"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document's paragraphs (lines, cut at some sentence ends so that an edit touches
few of them) are hashed to 64-bit digests, each distinct digest counted once.  So
that one sketch never grows with the document, digests are dealt to blocks by their own low
bits, a power of two of them with about four each, and every block has a small sketch of its
own: three tables of ``s`` cells, where a digest is added to one cell of each
(``count`` and xor of digests, which carry check bits).  These sketches are the
fingerprint, whose size so follows the number of paragraphs.

To compare two versions the one with more blocks is folded to the other's number (blocks
whose low bits agree are added up), and the sketches are subtracted, which cancels
what both share.  Peeling cells that hold a single digest recovers the
paragraphs that differ.  If a block doesn't peel, the pair is sketched again from the
digests, in the larger number of blocks and with three times the cells and then more, block by block;
a block that fails at the last size is compared by its digests, so the result is always whole.

DataFrame functions only; the work is linear in the document, and the single shuffle puts neighbouring
documents together.  Null texts count as empty; two texts without paragraphs are alike.  Repeated rows keep their number: rows are
ordered by id and then by a hash of their text; null ids come last.  Rows of one id share a range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents

#: Cells of one table of a block's sketch in the fingerprint, and of the larger ones that are tried after it.
CELLS, TRIES = 4, (12, 36, 144)
#: Digests of a block on average, at most; rounds of peeling.
BLOCK, ROUNDS = 4, 10
#: At most this many ranges of ids; bounds are found on the driver from as many quantiles.
MOST_RANGES = 1 << 16
#: A paragraph ends at a line break, and within long lines after the sentences
#: whose last letter is one of these: the text alone decides where it is cut.
PARAGRAPH_END = r"\n+|(?<=[a-e][.!?]) +"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _checked(h: Column) -> Column:
    """A digest: the high 40 bits of a hash, and 24 check bits of those."""
    return _let(h.bitwiseAND(F.lit(-1 << 24)), lambda high: high.bitwiseOR(F.xxhash64(high).bitwiseAND(F.lit((1 << 24) - 1))))


def _is_digest(k: Column) -> Column:
    high = k.bitwiseAND(F.lit(-1 << 24))
    return k.bitwiseXOR(F.xxhash64(high)).bitwiseAND(F.lit((1 << 24) - 1)) == 0


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the non-empty paragraphs, in order; 24 bits check the rest."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: _checked(F.xxhash64(p))))


def _entries(digests: Column, s: int, sign: int) -> Column:
    """Digests with their cell in each of three tables of ``s``."""
    place = lambda h, j: F.pmod(F.shiftrightunsigned(h, 20 * j).bitwiseAND(F.lit((1 << 20) - 1)), F.lit(s)).cast("int")
    hashed = F.transform(digests, lambda d: F.struct(d.alias("k"), F.xxhash64(d, F.lit(7)).alias("h")))
    return F.transform(hashed, lambda e: F.struct(F.lit(sign).alias("c"), e["k"].alias("k"), place(e["h"], 0).alias("p"), place(e["h"], 1).alias("q"), place(e["h"], 2).alias("r")))


def _cell(c: Column, k: Column) -> Column:
    return F.struct(c.alias("c"), k.alias("k"))


def _folded(entries: Column, table: str, i: Column, start: Column, sign: int = 1) -> Column:
    """Cell ``i`` of a table with the entries added (or removed) on top of ``start``."""
    return F.aggregate(F.filter(entries, lambda e: e.getField(table) == i), start, lambda a, e: _cell(a["c"] + sign * e["c"], a["k"].bitwiseXOR(e["k"])))


def sketch(digests: Column, s: int) -> Column:
    """``array<struct<c,k>>`` of three tables of ``s`` cells."""
    empty = _cell(F.lit(0), F.lit(0).cast("long"))
    indexes = F.sequence(F.lit(0), F.lit(s - 1))

    def table(es: Column, t: str) -> Column:
        return F.transform(indexes, lambda i: _folded(es, t, i, empty))

    return _let(_entries(digests, s, 1), lambda es: F.concat(table(es, "p"), table(es, "q"), table(es, "r")))


def subtracted(a: Column, b: Column) -> Column:
    """Cell by cell difference of two sketches of the same size."""
    return F.zip_with(a, b, lambda x, y: _cell(x["c"] - y["c"], x["k"].bitwiseXOR(y["k"])))


def peeled(cells: Column, s: int) -> Column:
    """``struct<only_a, only_b>`` arrays of the digests that differ; null if peeling gets stuck."""
    none = F.array().cast("array<bigint>")
    state = lambda c, a, b: F.struct(c.alias("cells"), a.alias("a"), b.alias("b"))

    def without(current: Column, entries: Column) -> Column:
        def table(j: int, t: str) -> Column:
            return F.transform(F.slice(current, 1 + j * s, s), lambda c, i: _folded(entries, t, i, c, -1))

        return F.concat(table(0, "p"), table(1, "q"), table(2, "r"))

    def step(st: Column, _: Column) -> Column:
        pure = F.filter(st["cells"], lambda c: ((c["c"] == 1) | (c["c"] == -1)) & _is_digest(c["k"]))
        of = lambda found, sign: F.array_distinct(F.transform(F.filter(found, lambda c: c["c"] == sign), lambda c: c["k"]))

        def remove(ab: Column) -> Column:
            both = F.concat(_entries(ab["x"], s, 1), _entries(ab["y"], s, -1))
            return state(_let(both, lambda es: without(st["cells"], es)), F.concat(st["a"], ab["x"]), F.concat(st["b"], ab["y"]))

        return _let(pure, lambda found: F.when(F.size(found) == 0, st).otherwise(_let(F.struct(of(found, 1).alias("x"), of(found, -1).alias("y")), remove)))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(cells, none, none), step)
    return _let(done, lambda st: F.when(F.forall(st["cells"], lambda c: (c["c"] == 0) & (c["k"] == 0)), F.struct(st["a"].alias("only_a"), st["b"].alias("only_b"))))


def difference(a: Column, b: Column) -> Column:
    """Digests in one list only, by subtracting and peeling; larger on failure.

    After the largest size (a block of four or so digests in 432 cells, which
    fails only if two digests share all three cells) the lists themselves
    are compared, so the result is always whole.
    """

    def attempt(s: int) -> Column:
        return peeled(subtracted(sketch(a, s), sketch(b, s)), s)

    exact = F.struct(F.array_except(a, b).alias("only_a"), F.array_except(b, a).alias("only_b"))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.struct(a.alias("only_a"), b.alias("only_b"))).otherwise(F.coalesce(*[attempt(s) for s in TRIES], exact))


def _power(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), bits)


def _bits(n: Column) -> Column:
    """How many bits tell the blocks of ``n`` digests apart."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(1)) / F.lit(BLOCK)))).cast("int")


def _blocks(digests: Column, bits: Column) -> Column:
    """Digests dealt to ``2 ** bits`` blocks, in two steps: by the upper half of the block's number, then by the lower."""
    low = F.floor((bits + 1) / 2).cast("int")
    number = lambda d: F.shiftrightunsigned(d, 25).bitwiseAND(_power(bits) - 1)
    upper = lambda d: F.call_function("shiftrightunsigned", number(d), low)
    first = F.transform(F.sequence(F.lit(0), _power(bits - low) - 1), lambda g: F.filter(digests, lambda d: upper(d) == g))
    return F.flatten(F.transform(first, lambda ds: F.transform(F.sequence(F.lit(0), _power(low) - 1), lambda g: F.filter(ds, lambda d: number(d).bitwiseAND(_power(low) - 1) == g))))


def fingerprint(digests: Column) -> Column:
    """``struct<n, bits, blocks>``: the number of digests and the sketches of their ``2 ** bits`` blocks."""
    return _let(_bits(F.size(digests)), lambda k: F.struct(F.size(digests).alias("n"), k.alias("bits"), F.transform(_blocks(digests, k), lambda ds: sketch(ds, CELLS)).alias("blocks")))


def folded(blocks: Column, bits: Column, to: Column) -> Column:
    """The sketches of ``2 ** to`` blocks from those of more: the sums of those with the same low bits."""
    added = lambda x, y: F.zip_with(x, y, lambda c, d: _cell(c["c"] + d["c"], c["k"].bitwiseXOR(d["k"])))
    empty = F.array_repeat(_cell(F.lit(0), F.lit(0).cast("long")), 3 * CELLS)
    sums = F.transform(F.sequence(F.lit(0), _power(to) - 1), lambda j: F.aggregate(F.sequence(j, _power(bits) - 1, _power(to)), empty, lambda x, i: added(x, F.get(blocks, i))))
    return F.when(bits == to, blocks).otherwise(sums)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness (0 to 1) of two ``struct<digests, print>``, from the difference of their fingerprints; two without digests are alike."""
    sizes = lambda d: F.struct(F.size(d["only_a"]).alias("x"), F.size(d["only_b"]).alias("y"))

    def small(p: Column, q: Column) -> Column:
        to = F.least(p["bits"], q["bits"])
        return F.zip_with(folded(p["blocks"], p["bits"], to), folded(q["blocks"], q["bits"], to), lambda x, y: _let(peeled(subtracted(x, y), CELLS), lambda d: F.when(d.isNotNull(), sizes(d))))

    def larger(bits: Column) -> Column:
        return F.zip_with(_blocks(a["digests"], bits), _blocks(b["digests"], bits), lambda x, y: _let(difference(x, y), sizes))

    whole = lambda found: F.when(F.forall(found, lambda d: d.isNotNull()), found).otherwise(_let(F.greatest(a["print"]["bits"], b["print"]["bits"]), larger))
    found = _let(small(a["print"], b["print"]), whole)
    total = F.aggregate(found, F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")), lambda t, d: F.struct((t["x"] + d["x"]).alias("x"), (t["y"] + d["y"]).alias("y")))
    n = a["print"]["n"]
    return _let(total, lambda t: F.when(n + t["y"] == 0, F.lit(1.0)).otherwise((n - t["x"]) / (n + t["y"])))


def written(print_: Column) -> Column:
    """A fingerprint as text: ``n:bits:`` and its cells, joined by commas; an empty cell is empty, others are ``count.xor`` (hex)."""
    cell = lambda c: F.when((c["c"] == 0) & (c["k"] == 0), F.lit("")).otherwise(F.concat(c["c"].cast("string"), F.lit("."), F.lower(F.hex(c["k"]))))
    return F.concat_ws(":", print_["n"].cast("string"), print_["bits"].cast("string"), F.array_join(F.transform(F.flatten(print_["blocks"]), cell), ","))


def _range_of(bounds: list[int], key: Column) -> Column:
    """How many bounds are below ``key``, by binary search; -1 for null."""
    if not bounds:
        return F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0))
    steps = len(bounds).bit_length()
    array = F.lit(bounds)
    state = lambda lo, hi: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    def halve(st: Column, _: Column) -> Column:
        mid = F.floor((st["lo"] + st["hi"]) / 2).cast("int")
        return F.when(st["lo"] >= st["hi"], st).otherwise(F.when(F.get(array, mid) < key, state(mid + 1, st["hi"])).otherwise(state(st["lo"], mid)))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state(F.lit(0), F.lit(len(bounds))), halve)
    return F.when(key.isNull(), F.lit(-1)).otherwise(found["lo"])


def with_next(df: DataFrame, key: str, payload: list[str], tie: Column) -> DataFrame:
    """``df`` and ``next``, the payload of the row that follows by descending ``key``; after the last, the first.

    Rows are dealt to ranges of the key.  The first row of each range is
    also sent to the range before it, so each range is sorted by itself and
    no task sees the whole order.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    ranges = max(1, min(MOST_RANGES, max(4 * partitions, rows // 4096), rows))
    quantiles = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(df.agg(F.percentile_approx(key, quantiles, 4 * ranges).alias("b")).first()["b"] or [])) if quantiles else []
    dealt = df.withColumn("_range", _range_of(bounds, F.col(key))).withColumn("_tie", tie)
    order = F.struct(F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("k"), "_tie")
    heads = dealt.groupBy("_range").agg(F.max(order).alias("head"))
    everything = Window.partitionBy(F.lit(0)).orderBy(F.desc("_range"))
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # at most MOST_RANGES + 1 rows
    to = heads.withColumn("_to", F.coalesce(F.lag("_range").over(everything), F.last("_range").over(whole)))
    copies = dealt.withColumn("head", order).join(F.broadcast(to.select("_to", "head")), "head").drop("head")
    both = dealt.withColumn("_copy", F.lit(0)).unionByName(copies.withColumn("_range", F.col("_to")).drop("_to").withColumn("_copy", F.lit(1)))
    within = Window.partitionBy("_range").orderBy("_copy", F.desc_nulls_last(key), F.desc("_tie"))
    return both.withColumn("next", F.lead(F.struct(*payload)).over(within)).where("_copy = 0").drop("_copy", "_range", "_tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edit, with their likenesses (see ``op4``)."""
    docs = docs.withColumn("digests", paragraph_digests(F.col("text")))
    paired = with_next(docs, "doc_id", ["text", "digests"], F.xxhash64("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    made = paired.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "digests", F.col("next.digests").alias("next_digests"))
    made = made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "digests", "next_digests", paragraph_digests(F.col("edited")).alias("edited_digests"))
    sides = {"own": "digests", "edit": "edited_digests", "after": "next_digests"}
    made = made.select("doc_id", "n_chars", "edited_sha256", *[F.struct(F.col(c).alias("digests"), fingerprint(F.col(c)).alias("print")).alias(k) for k, c in sides.items()])
    return made.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("own.print")).alias("fingerprint"), written(F.col("edit.print")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
