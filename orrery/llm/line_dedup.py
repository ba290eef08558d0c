"""Line dedup: an exact set-similarity join of lines; later matches go.

A line's tokens are its distinct five-word shingles (letters in lower case); a line
of one to four words has its whole word sequence as its single token, so equal ones
match.  Two lines match when the Jaccard likeness of their tokens is 0.75 or more,
and a line is removed when a line before it matches it.  A line's position is its
document's id and then its number; lines of different rows may share one, and then
neither comes before the other.  All lines are judged on the input, not on what is
left.  Lines without a word always stay.

Equal lines are one class, told by their hash.  Tokens are ordered by rarity, that of a
shingle's first word, from a fixed-size sketch of all word counts (any order gives
the same result).  A class is sent to the tokens of
its prefix, ``n - ceil(0.75 n) + 1`` of the rarest, of which matching classes share
one; tokens of one class only go.  Classes that meet pass a length filter, a
positional filter and a parity filter: two sets differ by at least as many tokens as
their parity words differ in bits.  What is left is verified on whole token sets.

So that groups of copies aren't paired, every class first meets the earliest of
each of its tokens, and those that find no match meet the earliest of those, as long as a
round closes a quarter of them.  What is then still open meets all earlier classes.

DataFrame functions only.  A null text has no lines and stays null; a null id comes
before all others; empty tables give empty results.  Rows are told apart by id and text, so rows
that repeat an id keep their own lines, and equal rows get equal results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discarded, documents, written

WORDS, PER_CENT = 5, 75
#: Counters of the rarity sketch; its levels travel as one literal of this many small numbers.
SKETCH = 1 << 15
#: A token has the level of its first word above this many bits of its hash.
HASH_BITS = 56
#: Levels are four times log2 of a count.  Tokens up to this one are in fewer than 2**20 lines, so a task can hold all of one.
FEW_LEVEL = 80
NO_ID = -(1 << 63)
#: Rounds against the earliest go on while at most this share of the entries is left open by one.
WORTH = 0.75


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, line`` (from 0) of the non-empty lines; ``row`` is a hash of the whole text."""
    each = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return each.where("line <> ''")


def _split(line: Column) -> Column:
    """Lower-case words, and empty strings between neighbouring spaces."""
    others = "\t\r\f\v"
    has_others = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in others])
    return F.split(F.lower(F.when(has_others, F.translate(line, others, "    ")).otherwise(line)), " ")


def _bucket(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(SKETCH - 1))


def shingles(line: Column, levels: Column | None = None) -> Column:
    """Distinct hashes of the line's shingles; with ``levels`` (of word buckets) in ascending order, rarest first."""

    def of(words: Column) -> Column:
        token = lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WORDS)])  # noqa: E731  past the end: of fewer words
        if levels is None:
            found = F.transform(words, token)
        else:
            level = lambda w: F.get(levels, _bucket(w).cast("int")).cast("long")
            found = F.transform(words, lambda w, i: F.shiftleft(level(w), HASH_BITS).bitwiseOR(token(w, i).bitwiseAND(F.lit((1 << HASH_BITS) - 1))))
        return F.array_distinct(F.slice(found, F.lit(1), F.greatest(F.lit(1), F.size(words) - (WORDS - 1))))

    distinct = _let(F.array_remove(_split(line), ""), of)
    return distinct if levels is None else F.sort_array(distinct)


def rarity_levels(docs: DataFrame) -> Column:
    """An array literal: for each of ``SKETCH`` buckets of words, four times log2 of how many fell there."""
    spaced = F.lower(F.replace("text", F.lit("\n"), F.lit(" ")))
    buckets = docs.select(F.explode(F.split(spaced, " ")).alias("word")).groupBy(_bucket(F.col("word")).alias("bucket"))
    rows = buckets.agg(F.floor(4 * F.log2(F.count(F.lit(1)) + 1)).cast("int").alias("level")).collect()  # SKETCH rows at most
    levels = [0] * SKETCH
    for r in rows:
        levels[r["bucket"]] = min(127, r["level"])
    return F.from_json(F.lit("[" + ",".join(map(str, levels)) + "]"), "array<int>")


def _size(place: str) -> Column:
    return F.shiftright(place, 32)


def _may_match(per_cent: int) -> Column:
    """The length, positional and parity filters of two packed places (size above, position in order below) that share a token.

    By its positions the token can be the first that a matching pair shares: from it on there are tokens enough.
    """
    na, nb = _size("pa"), _size("pb")
    i, j = (F.col(p).bitwiseAND(F.lit(0xFFFFFFFF)) for p in ("pa", "pb"))
    length = 100 * F.least(na, nb) >= per_cent * F.greatest(na, nb)
    positions = (100 + per_cent) * F.least(na - i, nb - j) >= per_cent * (na + nb)
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a.w{k}").bitwiseXOR(F.col(f"b.w{k}"))) for k in (0, 1)])
    parity = (100 + per_cent) * (na + nb - differ) >= 2 * per_cent * (na + nb)
    return length & positions & parity


def _parity(tokens: Column, word: int) -> Column:
    """64 parities: bit ``k`` tells whether an odd number of tokens have ``k`` as their low bits, and ``word`` above those."""
    own = F.filter(tokens, lambda t: F.shiftright(t, 6).bitwiseAND(F.lit(1)) == word)
    return F.aggregate(own, F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))))


def _classes(everything: DataFrame, levels: Column, per_cent: int) -> DataFrame:
    """``class, first, last, n, prefix`` of every class of lines with words: its earliest and latest position and its rarest tokens."""
    place = F.struct("doc_id", "line_no")
    made = everything.select(F.xxhash64("line").alias("class"), place.alias("place"), shingles(F.col("line"), levels).alias("tokens"))
    n = F.size("tokens")
    prefix = F.slice("tokens", F.lit(1), (n - F.floor((per_cent * n + 99) / 100) + 1).cast("int"))
    made = made.select("class", "place", n.alias("n"), prefix.alias("prefix"))
    return written(made.groupBy("class").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.first("n").alias("n"), F.first("prefix").alias("prefix")).where("n > 0"))


def _met(classes: DataFrame) -> DataFrame:
    """``token, class, place`` of the prefix tokens that several classes have.

    A token whose first word is frequent may be in any share of the lines: those are counted after a map-side
    sum and joined, which splits skewed keys.  The others are counted in one window.
    """
    sent = classes.select("class", "n", F.posexplode("prefix").alias("pos", "token"))
    sent = sent.select("token", "class", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos")).alias("place"))
    few = F.shiftright("token", HASH_BITS) <= FEW_LEVEL
    rare = sent.where(few).withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("k > 1").drop("k")
    many = sent.where(~few)
    return rare.union(many.join(many.groupBy("token").count().where("count > 1").select("token"), "token"))


def _tokens_of(everything: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, tokens`` of the wanted classes."""
    hashed = everything.select("line", F.xxhash64("line").alias("class"))
    known = hashed.join(wanted, "class", "left_semi").groupBy("class").agg(F.first("line").alias("line"))
    return written(known.select("class", shingles(F.col("line")).alias("tokens")))


def _verified(pairs: DataFrame, tokens: DataFrame, per_cent: int) -> DataFrame:
    """The classes ``b`` of the pairs ``a, b`` whose whole token sets are alike enough."""
    whole = pairs.join(tokens.select(F.col("class").alias("a"), F.col("tokens").alias("ta")), "a").join(tokens.select(F.col("class").alias("b"), F.col("tokens").alias("tb")), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    return whole.where(100 * shared >= per_cent * (F.size("ta") + F.size("tb") - shared)).select(F.col("b").alias("class")).distinct()


def _pairs(before: DataFrame, after: DataFrame, per_cent: int) -> DataFrame:
    """``a, b``: classes that share a token of their prefixes, where the first comes earlier and no filter parts them."""
    a = before.select("token", F.col("me").alias("a"), F.col("place").alias("pa"))
    b = after.select("token", F.col("me").alias("b"), F.col("place").alias("pb"))
    met = a.join(b, "token").where((F.col("a.first") < F.col("b.first")) & _may_match(per_cent))
    return met.select(F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct()


def _near(everything: DataFrame, met: DataFrame, spots: DataFrame, per_cent: int) -> DataFrame:
    """``class`` of every class whose first line a different, earlier class matches."""
    tokens = _tokens_of(everything, met.select("class").distinct())
    about = spots.select("class", "first").join(tokens.select("class", *[_parity(F.col("tokens"), k).alias(f"w{k}") for k in (0, 1)]), "class")
    entries = written(met.join(about, "class").select("token", "place", F.struct("first", "class", "w0", "w1").alias("me")))
    discarded(met)
    found, open_ = [], entries
    left = open_.count()
    while left:
        earliest = open_.groupBy("token").agg(F.min(F.struct("me", "place")).alias("e")).select("token", "e.me", "e.place")
        new = written(_verified(_pairs(earliest, open_, per_cent), tokens, per_cent))
        found.append(new)
        was, open_ = open_, written(open_.join(new, F.col("me.class") == new["class"], "left_anti"))
        if was is not entries:
            discarded(was)
        before, left = left, open_.count()
        if left > WORTH * before:
            break
    near = written(reduce(DataFrame.union, found, _verified(_pairs(entries, open_, per_cent), tokens, per_cent)))
    discarded(tokens, entries, *found, *([open_] if open_ is not entries else []))
    return near


def removed(docs: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """``doc_id, row, gone``: the numbers of the lines that an earlier line matches, in order, of each row that has any.

    ``docs`` has ``doc_id, text``; here a null id is the smallest number, and ``row`` is a hash of the text.
    """
    if not 1 <= per_cent <= 100:
        raise ValueError("the likeness must be 1 to 100 per cent")
    everything = lines(docs)
    classes = _classes(everything, rarity_levels(docs), per_cent)
    spots = written(classes.select("class", "first", "last"))
    met = written(_met(classes))
    discarded(classes)
    near = _near(everything, met, spots, per_cent)
    about = spots.join(near.withColumn("near", F.lit(True)), "class", "left").where(F.col("near") | (F.col("first") < F.col("last")))
    hashed = everything.select("doc_id", "row", "line_no", F.xxhash64("line").alias("class"))
    late = hashed.join(about, "class").where(F.coalesce("near", F.lit(False)) | (F.col("first") < F.struct("doc_id", "line_no")))
    gone = written(late.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("line_no")).alias("gone")))
    discarded(spots, near)
    return gone


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers (ascending), by the stretches between them."""

    def between(s: Column) -> Column:
        stretch = lambda k: F.slice(s["all"], F.get(s["cut"], k) + 2, F.get(s["cut"], k + 1) - F.get(s["cut"], k) - 1)
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["cut"]) - 2), stretch)), "\n")

    all_ = F.split(text, "\n")
    return _let(F.struct(all_.alias("all"), F.concat(F.array(F.lit(-1)), gone, F.array(F.size(all_))).alias("cut")), between)


def dedup_lines(df: DataFrame, per_cent: int = PER_CENT, gone: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` (``doc_id, text, ...``) without the lines that an earlier line matches.

    Columns whose names begin with ``__line_`` are reserved.  ``gone`` names a column for the removed lines' numbers.
    """
    found = removed(df.select("doc_id", "text"), per_cent).select(F.col("doc_id").alias("__line_doc"), F.col("row").alias("__line_row"), F.col("gone").alias("__line_gone"))
    same = (F.coalesce(df["doc_id"], F.lit(NO_ID)) == F.col("__line_doc")) & (F.xxhash64(df["text"]) == F.col("__line_row"))
    joined = df.join(found, same, "left").withColumn("text", F.when(F.col("__line_gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("__line_gone"))))
    return joined.select(*df.columns, *([F.coalesce("__line_gone", F.array().cast("array<int>")).alias(gone)] if gone else []))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its lines, those removed (numbers, comma-joined) and the digest of the text that is left."""
    docs = documents(spark, sf_dir).withColumn("n_lines", F.size(F.split("text", "\n")).cast("long"))
    kept = dedup_lines(docs, gone="removed")
    return kept.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
with each as (select row_number() over () k, doc_id, text from (select distinct doc_id, coalesce(text, '') text from documents)),
lines as (
  select k, coalesce(doc_id, -9223372036854775808) d, unnest(range(0, len(l))) i, unnest(l) line from (select k, doc_id, string_split(text, chr(10)) l from each)),
words as (
  select k, d, i, list_filter(string_split(translate(lower(line), chr(9) || chr(13) || chr(12) || chr(11), '    '), ' '), lambda w: w <> '') w from lines),
tokens as (
  select distinct k, d, i, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda p: array_to_string(w[p:p+4], ' '))) t from words where len(w) > 0),
sizes as (select k, i, count(*) n from tokens group by all),
pairs as (
  select b.k, b.i, a.k ak, a.i ai, count(*) shared
  from tokens a join tokens b on a.t = b.t and (a.d < b.d or (a.d = b.d and a.i < b.i)) group by all),
gone as (
  select p.k, list(distinct p.i order by p.i) g from pairs p
  join sizes x on x.k = p.k and x.i = p.i
  join sizes y on y.k = p.ak and y.i = p.ai
  where 100 * shared >= 75 * (x.n + y.n - shared) group by p.k),
kept as (
  select doc_id, text, string_split(text, chr(10)) l, coalesce(g, []) g from each left join gone using (k))
select documents.doc_id, cast(len(l) as bigint) n_lines, cast(len(g) as bigint) n_removed, array_to_string(g, ',') removed,
  sha256(array_to_string(list_filter(l, lambda x, p: not list_contains(g, p - 1)), chr(10))) kept_sha256
from documents join kept on documents.doc_id is not distinct from kept.doc_id and coalesce(documents.text, '') = kept.text
"""
