"""Phrase collocations by hierarchical pair naming.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at
spaces and tabs into words.  A phrase is two to five words in a row of one piece; it is
a candidate when its language (null: ``und``) has it ``LEAST`` times or more, overlaps included.

Level by level, adjacent frequent (k-1)-grams make a k-gram, so a k-gram is the pair of
the ids of its first and its last k - 1 words.  Words are dealt to blocks of about ``BLOCK``
positions of one language; a block counts its distinct pairs by itself, the counts are summed over
all blocks, the frequent pairs get an id each (a name, in a table of all of them), and the names go
back to each block's distinct pairs, not to the positions: up to ``FEW`` of them as a broadcast, more by a
shuffled join.  A pair's two ids are its parent pointers: by them the counts of all its first and last parts, which the cuts
need, come from the level before, and so does the test of what a longer candidate holds.

A candidate's score is that of its lowest-scoring cut into two parts with counts ``l`` and ``r``:
``floor(1000 * a * n / (l * r))`` with ``n`` words in the language, in whole numbers of any
size.  A candidate goes when a longer one that holds it has ``HELD`` per cent of its count:
every candidate between the two then has so too, so one more word is enough to look at.

A null text is empty; repeated rows count as often as they are there; null and repeated ids don't
matter; an empty table has no phrases; other columns are never read.  Ties in the ranking
go by the phrase's bytes, which are distinct in a language.  A block only ends between
pieces; a piece longer than a block makes a longer block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, discarded, framed, frames_of, table, written

LEAST, WORDS, TOP, HELD = 100, 5, 2000, 100
#: Positions of a block; rows of an Arrow batch that leaves a task; names that are broadcast, after a count, when there are no more.
BLOCK, ROWS, FEW = 1 << 21, 1 << 16, 1 << 18
#: Bytes of a text that are split at once.
CHUNK = 1 << 20

_BETWEEN = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
#: A block: its sequence of numbers of words or pairs (-1: none), those words or pairs, and how often it has each.
BLOCKS = "block long, lang string, data binary"


class _Locals(dict):
    """Numbers words from 1 as they come; -1 is no word, 0 parts two pieces."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The text's words in lower case, with line feeds between pieces and at the end, a stretch at a time."""
    data, at = text.lower().translate(_BETWEEN), 0  # bytes.lower is A-Z only
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end
    yield [b"\n"]


class _Open:
    """The words of one language that aren't in a block yet."""

    def __init__(self):
        self.words, self.parts, self.size, self.enough = _Locals(), [], 0, BLOCK

    def add(self, tokens: list[bytes]) -> None:
        ids = np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(ids[ids >= 0])
        self.size += len(self.parts[-1])

    def closed(self) -> tuple[np.ndarray, list[bytes]]:
        """What ends with a piece, with its words; the rest begins anew."""
        seq, words = np.concatenate(self.parts), list(self.words)[1:]
        last = int(np.flatnonzero(seq == 0)[-1]) if (seq == 0).any() else -1
        rest = [words[i] for i in seq[last + 1 :]]
        self.__init__()
        self.add(rest)
        self.enough = max(BLOCK, 2 * len(rest))  # a piece that doesn't end isn't looked through again and again
        return seq[: last + 1], words


def words_of(docs: DataFrame) -> DataFrame:
    """``BLOCKS`` of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        opened: dict[str, _Open] = {}

        def closed(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal block
            seq, words = opened[lang].closed()
            counts = np.bincount(seq, minlength=len(words))[1:]
            used = np.flatnonzero(counts)  # words after the last piece's end may be none of this block's
            if len(used):
                number = np.full(len(words), -1, np.int32)
                number[used + 1] = np.arange(len(used))
                yield _block(block, lang, number[seq], b"\n".join(words[i + 1] for i in used), counts[used])
                block += 1

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                for tokens in _pieces(text):
                    opened.setdefault(lang, _Open()).add(tokens)
                    if opened[lang].size >= opened[lang].enough:
                        yield from closed(lang)
                if len(opened) > 1 and sum(o.size for o in opened.values()) >= 2 * BLOCK:
                    for name in list(opened):
                        yield from closed(name)
                        del opened[name]
        for lang in opened:
            yield from closed(lang)

    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, BLOCKS)


def _block(block: int, lang: str, seq: np.ndarray, *keys_and_counts: np.ndarray | bytes) -> pa.RecordBatch:
    data = framed(seq.astype("<i4"), *(x if isinstance(x, bytes) else x.astype("<i8") for x in keys_and_counts))
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([lang], pa.string()), pa.array([data], pa.binary())], names=["block", "lang", "data"])


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, str, pa.Buffer]]:
    """The blocks of a batch; their data isn't copied."""
    for block, lang, data in zip(*batch.columns):
        yield block.as_py(), lang.as_py(), data.as_buffer()


def _words_in(data: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """A block's sequence, words and counts."""
    seq, words, counts = frames_of(data, 3)
    return np.frombuffer(seq, "<i4"), bytes(words).split(b"\n"), np.frombuffer(counts, "<i8")


def _pairs_in(data: bytes) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """A block's sequence, pairs and counts."""
    seq, *rest = frames_of(data, 4)
    left, right, counts = (np.frombuffer(x, "<i8") for x in rest)
    return np.frombuffer(seq, "<i4"), (left, right), counts


def _listed(blocks: DataFrame, level: int) -> DataFrame:
    """``block, at, <key>, n``: each block's distinct words (``lang, word``) or pairs (``left, right``), numbered."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, data in _each(batch):
                _, keys, counts = _words_in(data) if level == 1 else _pairs_in(data)
                for a in range(0, len(counts), ROWS):
                    k = len(counts[a : a + ROWS])
                    own = [pa.array([lang] * k), pa.array(keys[a : a + ROWS], pa.binary()).cast(pa.string())] if level == 1 else [pa.array(x[a : a + ROWS]) for x in keys]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.array(np.arange(a, a + k, dtype=np.int32)), *own, pa.array(counts[a : a + ROWS])], names=["block", "at", *_key(level), "n"])

    return blocks.mapInArrow(run, f"block long, at int, {'lang string, word string' if level == 1 else 'left long, right long'}, n long")


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _key(level: int) -> list[str]:
    return ["lang", "word"] if level == 1 else ["left", "right"]


def _longer(block: int, lang: str, seq: np.ndarray, name: np.ndarray) -> pa.RecordBatch | None:
    """The block one level up, from its sequence and the names of what is frequent (by number; -1 for others)."""
    name = np.append(name, -1)  # the last entry is that of -1
    known = (name >= 0)[seq]
    both = np.flatnonzero(known[:-1] & known[1:]).astype(np.int32)
    del known
    if not len(both):
        return None
    pair = seq[both].astype(np.int64)
    pair *= len(name)
    pair += seq[both + 1]
    order = np.argsort(pair)
    pair, both = pair[order], both[order]
    del order
    fresh = np.ones(len(pair), bool)
    np.not_equal(pair[1:], pair[:-1], out=fresh[1:])
    new = np.full(len(seq), -1, np.int32)
    new[both] = np.cumsum(fresh, dtype=np.int32) - 1
    del both
    begins = np.flatnonzero(fresh)
    pairs, counts = pair[begins], np.diff(begins, append=len(pair))
    del pair, fresh, begins
    return _block(block, lang, new, name[pairs // len(name)], name[pairs % len(name)], counts)


def _named(blocks: DataFrame, level: int, least: int) -> DataFrame:
    """``id, <key>, a`` of what its language (in the key, or told by the parents) has often enough; ids are numbers from 0."""
    counted = _listed(blocks, level).groupBy(*_key(level)).agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    names = written(counted.withColumn("at", F.monotonically_increasing_id()), "names")
    task = F.shiftright("at", 33)
    sizes = names.groupBy(task.alias("task")).count().orderBy("task").collect()  # a row a task
    begins, n = [], 0
    for r in sizes:
        begins.append((r["task"], n))
        n += r["count"]
    starts = names.sparkSession.createDataFrame(begins, "task long, start long")
    numbered = names.join(F.broadcast(starts), task == F.col("task")).select((F.col("at") - F.shiftleft("task", 33) + F.col("start")).alias("id"), *_key(level), "a")
    numbered.few, numbered.written_to = n <= FEW, names.written_to
    return numbered


def _lookup(names: pa.Table, level: int) -> Callable[[str, object], np.ndarray]:
    """The names of a block's keys, from a table of ``FEW`` at most."""
    if level == 1:
        by_lang: dict[str, dict[bytes, int]] = {}
        for rows in names.to_batches(ROWS):
            for i, lang, word in zip(rows.column("id").to_pylist(), rows.column("lang").to_pylist(), rows.column("word").cast(pa.binary()).to_pylist()):
                by_lang.setdefault(lang, {})[word] = i
        return lambda lang, words: np.fromiter((by_lang.get(lang, {}).get(w, -1) for w in words), np.int64, len(words))
    left, right, ids = (names.column(c).to_numpy() for c in ("left", "right", "id"))
    order = np.lexsort((right, left))
    left, right, ids = left[order], right[order], ids[order]
    firsts, begins = np.unique(left, return_index=True)
    right_of, own = np.unique(right, return_inverse=True)
    packed = np.repeat(np.arange(len(firsts)), np.diff([*begins, len(left)])) * (len(right_of) + 1) + own  # ascending, as left and right are

    def find(_: str, pair: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        places = []
        for known, wanted in zip((firsts, right_of), pair):
            at = np.searchsorted(known, wanted)
            places.append(np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == wanted), at, -1) if len(known) else np.full(len(wanted), -1))
        key = places[0] * (len(right_of) + 1) + places[1]
        at = np.minimum(np.searchsorted(packed, key), max(0, len(packed) - 1))
        return np.where((places[0] >= 0) & (places[1] >= 0) & (packed[at] == key), ids[at], -1) if len(packed) else np.full(len(key), -1)

    return find


def _paired(blocks: DataFrame, names: DataFrame, level: int) -> DataFrame:
    """The blocks one level up."""
    read = _words_in if level == 1 else _pairs_in
    if names.few:
        held = blocks.sparkSession.sparkContext.broadcast(names.select("id", *_key(level)).toArrow())

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = _lookup(held.value, level)
            for batch in batches:
                for block, lang, data in _each(batch):
                    seq, keys, _ = read(data)
                    if (up := _longer(block, lang, seq, find(lang, keys))) is not None:
                        yield up

        return written(blocks.mapInArrow(run, BLOCKS), "blocks")
    found = _listed(blocks, level).join(names.select(*_key(level), "id"), _key(level)).select("block", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("binary").alias("data"), "at", "id")
    heads = blocks.select("*", F.lit(None).cast("int").alias("at"), F.lit(None).cast("long").alias("id"))
    empty = _arrow(BLOCKS).empty_table()

    def up(group: pa.Table) -> pa.Table:
        head = int(np.flatnonzero(group.column("data").is_valid().to_numpy())[0])
        seq, _, counts = read(group.column("data")[head].as_py())
        name = np.full(len(counts), -1, np.int64)
        own = group.filter(group.column("at").is_valid())
        name[own.column("at").to_numpy()] = own.column("id").to_numpy()
        made = _longer(group.column("block")[head].as_py(), group.column("lang")[head].as_py(), seq, name)
        return empty if made is None else pa.Table.from_batches([made])

    return written(heads.unionByName(found).groupBy("block").applyInArrow(up, BLOCKS), "blocks")


def _described(names: DataFrame, before: DataFrame) -> DataFrame:
    """Phrases with the counts of their first and last 1, 2, ... words, through the parent pointers."""
    first = before.select("lang", F.col("id").alias("left"), F.col("phrase").alias("_phrase"), F.col("firsts").alias("_firsts"))
    last = before.select(F.col("id").alias("right"), F.col("last"), F.col("lasts").alias("_lasts"))
    joined = names.join(first, "left").join(last, "right")
    more = lambda c: F.concat(c, F.array("a"))
    made = joined.select("id", "lang", "left", "right", "a", F.concat_ws(" ", "_phrase", "last").alias("phrase"), "last", more("_firsts").alias("firsts"), more("_lasts").alias("lasts"))
    return written(made, "phrases")


def _lowest_cut(words: int) -> Column:
    """``score, k, l, r`` of the lowest-scoring cut of a phrase of so many words; ties to the smallest ``k``."""
    wide = lambda c: c.cast("decimal(20,0)")

    def cut(k: int) -> Column:
        l, r = F.get("firsts", F.lit(k - 1)), F.get("lasts", F.lit(words - k - 1))
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide(F.col("a")) * wide(F.col("n")), wide(l) * wide(r))
        return F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.array(*[cut(k) for k in range(1, words)]))


def phrases(docs: DataFrame, least: int = LEAST, words: int = WORDS, held: int = HELD) -> DataFrame:
    """``lang, phrase, words, a, k, l, r, n, score`` of every candidate of ``docs`` (``lang, text``) that no longer one stands for.

    Phrases of 2 to ``words`` words with a count of ``least`` or more; one that a longer candidate with ``held`` per cent of
    its count holds goes.
    """
    if words < 2 or least < 1 or not 1 <= held <= 100:
        raise ValueError("phrases have two words or more, are there once or more, and are held to 1 to 100 per cent")
    blocks = written(words_of(docs), "blocks")
    sizes = written(_listed(blocks, 1).groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    names = _named(blocks, 1, least)
    infos = [written(names.select("id", "lang", "a", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("a").alias("firsts"), F.array("a").alias("lasts")), "phrases")]
    for level in range(2, words + 1):
        was, own = blocks, names
        blocks = _paired(was, own, level - 1)
        discarded(was, own)
        names = _named(blocks, level, least)
        infos.append(_described(names, infos[-1]))
    discarded(blocks, names)
    out = None
    for k, info in enumerate(infos[1:], 2):
        kept = info
        if k < words:
            up = infos[k]
            most = up.select(F.col("left").alias("id"), "a").union(up.select("right", "a")).groupBy("id").agg(F.max("a").alias("_most"))
            kept = info.join(most, "id", "left").where(F.col("_most").isNull() | (100 * F.col("_most") < held * F.col("a")))
        cut = kept.join(sizes, "lang").select("lang", "phrase", F.lit(k).alias("words"), "a", "n", _lowest_cut(k).alias("cut"))
        part = cut.select("lang", "phrase", "words", "a", "cut.k", "cut.l", "cut.r", "n", "cut.score")
        out = part if out is None else out.union(part)
    found = written(out, "found")
    discarded(sizes, *infos)
    return found


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases by score, count and the phrase itself."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases(table(spark, sf_dir, "documents")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)  # each task keeps its own first TOP before the shuffle
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with w as (
  select row_number() over () d, coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) piece from w),
s as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') ws from p),
g as (
  select lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) phrase
  from s, (select unnest([1, 2, 3, 4, 5]) m) where len(ws) >= m),
f as (select lang, m, phrase, count(*) a from g group by all having count(*) >= 100),
n as (select lang, sum(a)::bigint n from (select lang, count(*) a from g where m = 1 group by lang) group by lang),
c as (select *, string_split(phrase, ' ') ws from f where m > 1),
held as (
  select distinct x.lang, x.phrase from c x join c y on x.lang = y.lang and y.m > x.m and 100 * y.a >= 100 * x.a and contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
cuts as (
  select c.lang, c.phrase, c.a, n, k, l.a l, r.a r, ((1000::hugeint * c.a * n) // (l.a::hugeint * r.a))::bigint score
  from (select *, unnest(range(1, m)) k from c) c join n using (lang)
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[1:k], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[k + 1:c.m], ' ')),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) i from cuts) where i = 1)
select lang, rank, phrase, a, l, r, n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from best where not exists (select 1 from held h where h.lang = best.lang and h.phrase = best.phrase)) where rank <= 2000
"""
