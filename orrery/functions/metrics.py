"""Sentence metrics from published definitions, as expressions: BLEU (13a tokens), ROUGE-2 and ROUGE-L F1.

Overlaps count an n-gram as often as both sides have it: equal n-grams are numbered, and numbered ones are a set.
The longest common subsequence is a fold over the reference's tokens with a bit for each token of the prediction, ``BITS`` to a word.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

if TYPE_CHECKING:
    from ..operators.providers import TokenVectors

# The mteval-13a tokenizer's rules, applied in order.
RULES_13A = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
WHITE = r"(?U)[\s\x1c-\x1f]+"
#: Bits of a word; two words and a carry add up to less than 2**63.
BITS = 62
FULL = (1 << BITS) - 1


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def tokens_13a(text: Column) -> Column:
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), *ENTITIES):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for rule, to in RULES_13A:
        text = F.regexp_replace(text, rule, to)
    return F.filter(F.split(text, WHITE), lambda t: t != "")


def rouge_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    made = F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, made).otherwise(F.array().cast("array<string>"))


def _runs(ordered: Column, value: Callable[[Column], Column]) -> Column:
    """``start, k`` of each run of equal values of a sorted array that isn't empty."""
    n = F.size(ordered)
    at = lambda i: value(F.get(ordered, i))
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (at(i) != at(i - 1)))
    return let(starts, lambda s: F.transform(s, lambda a, j: F.struct(a.alias("start"), (F.coalesce(F.get(s, j + 1), n) - a).alias("k"))))


def _numbered(grams: Column) -> Column:
    """The n-grams, each with which of its equals it is."""
    each = lambda s: lambda run: F.transform(F.sequence(F.lit(1), run["k"]), lambda i: F.concat(F.get(s, run["start"]), F.lit(" "), i.cast("string")))
    made = let(F.sort_array(grams), lambda s: F.flatten(F.transform(_runs(s, lambda x: x), each(s))))
    return F.when(F.size(grams) > 0, made).otherwise(grams)


def _repeats(grams: Column) -> Column:
    """What is left of the n-grams when one of each is taken away."""
    return let(F.sort_array(grams), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))


def _overlap(p: Column, r: Column, n: int) -> Column:
    """Size of the intersection of the n-grams as multisets: as sets, and then the numbered repeats."""

    def of(s: Column) -> Column:
        a, b = s["a"], s["b"]
        repeated = (F.size(F.array_distinct(a)) < F.size(a)) & (F.size(F.array_distinct(b)) < F.size(b))
        more = F.size(F.array_intersect(*[let(_repeats(x), _numbered) for x in (a, b)]))
        return F.size(F.array_intersect(a, b)) + F.when(repeated, more).otherwise(0)

    return let(F.struct(_ngrams(p, n).alias("a"), _ngrams(r, n).alias("b")), of)


def _both(prediction: Column, reference: Column, tokens: Callable[[Column], Column], body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of both sides' tokens; null counts as empty."""
    own = [tokens(F.coalesce(x, F.lit(""))) for x in (prediction, reference)]
    return let(F.struct(own[0].alias("p"), own[1].alias("r")), lambda s: body(s["p"], s["r"]))


def bleu(prediction: Column, reference: Column, order: int = 4) -> Column:
    """Geometric mean of clipped n-gram precisions times the brevity penalty; unsmoothed."""

    def of(p: Column, r: Column) -> Column:
        hits = F.array(*[_overlap(p, r, n) for n in range(1, order + 1)])

        def score(h: Column) -> Column:
            logs = sum((F.log(F.get(h, F.lit(n - 1)) / (F.size(p) - (n - 1))) for n in range(1, order + 1)), F.lit(0.0))
            penalty = F.when(F.size(p) > F.size(r), 1.0).otherwise(F.exp(1 - F.size(r) / F.size(p)))
            return F.when(F.array_min(h) > 0, penalty * F.exp(logs / order)).otherwise(0.0)

        return let(hits, score)

    return _both(prediction, reference, tokens_13a, of)


def _f1(hit: Column, predicted: Column, wanted: Column) -> Column:
    return F.when(hit > 0, 2 * hit / (predicted + wanted)).otherwise(0.0)


def rouge_2(prediction: Column, reference: Column) -> Column:
    return _both(prediction, reference, rouge_tokens, lambda p, r: let(_overlap(p, r, 2), lambda hit: _f1(hit, F.size(p) - 1, F.size(r) - 1)))


def _marks(tokens: Column, words: Column) -> Column:
    """``token, words`` of each distinct token: the bits of its places."""
    placed = F.sort_array(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    bit = lambda i: F.call_function("shiftleft", _long(1), i % BITS)
    word = lambda own: lambda w: F.aggregate(own, _long(0), lambda a, x: a.bitwiseOR(F.when(F.floor(x["i"] / BITS) == w, bit(x["i"])).otherwise(_long(0))))
    one = lambda s: lambda run: F.struct(F.get(s, run["start"])["t"].alias("token"), F.transform(words, word(F.slice(s, run["start"] + 1, run["k"]))).alias("words"))
    return let(placed, lambda s: F.transform(_runs(s, lambda x: x["t"]), one(s)))


def _common(p: Column, r: Column) -> Column:
    """Length of the longest common subsequence of two arrays that aren't empty: the bits that the fold has cleared."""
    words = F.sequence(_long(0), F.floor((F.size(p) - 1) / BITS))

    def fold(marks: Column) -> Column:
        tokens = F.transform(marks, lambda m: m["token"])
        places = let(tokens, lambda known: F.filter(F.transform(r, lambda t: F.array_position(known, t).cast("int")), lambda k: k > 0))

        def step(row: Column, k: Column) -> Column:
            own = F.get(marks, k - 1)["words"]

            def word(state: Column, w: Column) -> Column:
                v, m = F.get(row, w.cast("int")), F.get(own, w.cast("int"))
                total = v + v.bitwiseAND(m) + state["carry"]
                kept = total.bitwiseAND(_long(FULL)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))
                return F.struct(F.shiftright(total, BITS).alias("carry"), F.concat(state["out"], F.array(kept)).alias("out"))

            start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("out"))
            return F.aggregate(words, start, word, lambda s: s["out"])

        row = F.aggregate(places, F.transform(words, lambda w: _long(FULL)), step)
        return F.aggregate(row, F.lit(0), lambda n, v: n + BITS - F.bit_count(v))

    return let(_marks(p, words), fold)


def rouge_l(prediction: Column, reference: Column) -> Column:
    """F1 of the longest common subsequence."""

    def of(p: Column, r: Column) -> Column:
        hit = F.when((F.size(p) > 0) & (F.size(r) > 0), _common(p, r)).otherwise(0)
        return let(hit, lambda h: _f1(h, F.size(p), F.size(r)))

    return _both(prediction, reference, rouge_tokens, of)


def greedy_match(model: TokenVectors) -> Callable[[Sequence[str], Sequence[str]], list[float]]:
    """F1 of pairs by greedy matching: each token goes with the most similar one of the other text."""

    def score(predictions: Sequence[str], references: Sequence[str]) -> list[float]:
        out = []
        for p, r in zip(predictions, references):
            a, b = model.vectors([p, r])
            if not len(a) or not len(b):
                out.append(0.0)
                continue
            alike = a @ b.T
            precision, recall = float(alike.max(axis=1).mean()), float(alike.max(axis=0).mean())
            out.append(2 * precision * recall / (precision + recall) if precision + recall else 0.0)
        return out

    return score
