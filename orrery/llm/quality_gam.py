"""Quality classifier: a generalised additive model with pairwise interactions.

Every text feature is cut into bins; a score is the sum of one table entry per
feature and one per chosen pair.  The tables are learned by cyclic boosting:
round after round, each feature in turn gets a shallow tree (a few leaves over
its bins) fitted to the current gradient, and its leaf values are added to the
feature's table at a small rate.  Pairs are then ranked by the gain of a
two-by-two split of the remaining gradient, and boosted the same way.  Scoring is
one table lookup per term over whole batches.

Training is on a bounded sample (``max_rows`` labelled rows, the first by a hash
of the id), so the driver holds that many feature rows at most; scoring covers
every row.  Null and empty texts have the features of the empty text; rows that repeat get equal scores; a tie in
the sample's hash goes to the smaller id, then label; without labels every score is 0.5.  Ids,
languages, sources and labels are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, keyed_text, map_arrow, table

#: The bound on labelled rows that the driver learns from.
MAX_ROWS = 20_000

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "letters", "upper", "digits", "spaces", "symbols", "sentence_marks", "commas",
    "non_ascii", "lines_per_word", "line_words", "short_lines", "repeated_lines", "distinct_words", "top_word", "long_words", "one_byte_words", "bars",
)


def _classes() -> np.ndarray:
    """A class for each byte: letter, upper, digit, space, symbol, sentence mark, comma, beyond ASCII, bar."""
    kind = np.full(256, 4, np.int64)
    for i in range(256):
        c = chr(i)
        if i >= 128:
            kind[i] = 7
        elif c.isalpha():
            kind[i] = 1 if c.isupper() else 0
        elif c.isdigit():
            kind[i] = 2
        elif c.isspace():
            kind[i] = 3
        elif c in ".?":
            kind[i] = 5
        elif c in ",;:'":
            kind[i] = 6
        elif c == "|":
            kind[i] = 8
    return kind


_CLASS = _classes()


def text_features(text: str) -> list[float]:
    data = text.encode()
    n = max(1, len(data))
    kinds = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=9) / n
    words = text.split()
    m = max(1, len(words))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x]
    k = max(1, len(lines))
    lengths = [x.count(" ") + 1 for x in lines]
    return [
        np.log1p(len(data)), np.log1p(len(words)), sizes.sum() / m, kinds[0] + kinds[1] + kinds[7], kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6],
        kinds[7], len(lines) / m, sum(lengths) / k, sum(x < 6 for x in lengths) / k, 1 - len(set(lines)) / k, len(counts) / m, max(counts.values(), default=0) / m,
        np.count_nonzero(sizes > 24) / m, np.count_nonzero(sizes == 1) / m, kinds[8],
    ]


def features(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x array<double>`` of every row."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        return {"doc_id": batch.column("doc_id"), "x": [text_features(t.as_py()) for t in batch.column("text")]}

    return map_arrow(keyed_text(df, key, text), "doc_id long, x array<double>", rows)


@dataclass
class Gam:
    """Bin edges and lookup tables; ``score`` sums them over a feature matrix."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, left, right, values in self.pairs:
            out += values[np.searchsorted(left, x[:, i], side="right"), np.searchsorted(right, x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """Leaf value of each bin: the best cut of any leaf, until there are ``leaves``."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    cuts = [0, len(g)]

    def gain(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, 0
        gl, hl = cg[a + 1 : b] - cg[a], ch[a + 1 : b] - ch[a]
        gr, hr = cg[b] - cg[a + 1 : b], ch[b] - ch[a + 1 : b]
        got = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
        got[(hl < least) | (hr < least)] = 0
        k = int(np.argmax(got))
        return float(got[k]), a + 1 + k

    while len(cuts) <= leaves:
        best, at = max(gain(a, b) for a, b in zip(cuts, cuts[1:]))
        if best <= 1e-9:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quad(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """The best two-by-two split of a grid, its gain and its cell values."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def parts(c: np.ndarray) -> list[np.ndarray]:
        a, row, col, all_ = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return [a, row - a, col - a, all_ - row - col + a]

    gs, hs = parts(cg), parts(ch)
    if gs[0].size == 0:
        return 0.0, np.zeros_like(g)
    gain = sum(x**2 / (y + ridge) for x, y in zip(gs, hs))
    gain = np.where(np.min(np.stack(hs), axis=0) < least, 0, gain)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [x[i, j] / (y[i, j] + ridge) for x, y in zip(gs, hs)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 60, rate: float = 0.15, leaves: int = 3, n_pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 30, ridge: float = 1.0, least: float = 1.0) -> Gam:
    """Learn the tables by cyclic boosting of the logistic loss; deterministic."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0:
        return Gam(0.0, [np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [])
    n = x.shape[1]
    edges = [_edges(x[:, j], bins) for j in range(n)]
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    margin = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(binned):
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])), leaves, ridge, least)
            tables[j] += step
            margin += step[b]
    coarse = [_edges(x[:, j], pair_bins) for j in range(n)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cells[i] * shape[1] + cells[j], w, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = sorted(((-_quad(grid(i, j, g), grid(i, j, h), ridge, least)[0], i, j) for i, j in combinations(range(n), 2)))
    pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for gain, i, j in gains[:n_pairs] if gain < 0]
    for _ in range(pair_rounds):
        for i, j, _, _, values in pairs:
            g, h = slopes()
            step = rate * _quad(grid(i, j, g), grid(i, j, h), ridge, least)[1]
            values += step
            margin += step[cells[i], cells[j]]
    return Gam(start, edges, tables, pairs)


def train(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", max_rows: int = MAX_ROWS) -> Gam:
    """Learn from the ``max_rows`` labelled rows that come first by a hash of the id.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id`` and the label;
    ``keep`` chooses the ids that may be learned from.  The sample of ids is
    bounded, so it is broadcast, and texts are never shuffled.
    """
    rank = F.xxhash64("doc_id")
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & keep).select("doc_id", F.col(label).cast("int").alias("y")).orderBy(rank, "doc_id", "y").limit(max_rows)
    known = docs.join(F.broadcast(ids), "doc_id")
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = [text_features(t.as_py()) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("y").cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    sample = known.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, x array<double>")
    rows = sample.orderBy(rank, "doc_id", "y", F.col("x").cast("string")).limit(max_rows).toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, np.array(rows.column("y").to_pylist(), float))


def with_score(df: DataFrame, model: Gam, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``df`` and the score, in place of a column of that name; one map, no shuffle."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    df = df.drop(name)
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array([text_features(t.as_py() or "") for t in batch.column(text)], float)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, DoubleType())]))


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    scored = with_score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
