"""The metrics' expressions against plain Python from the same definitions."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.functions import metrics


def tokens_13a(text):
    text = text.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for name, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = text.replace(name, char)
    text = re.sub(r"([{-~[-` -&(-+:-@/])", r" \1 ", f" {text} ")
    text = re.sub(r"([^0-9])([.,])", r"\1 \2 ", text)
    text = re.sub(r"([.,])([^0-9])", r" \1 \2", text)
    return re.sub(r"([0-9])(-)", r"\1 \2 ", text).split()


def grams(tokens, n):
    return Counter(zip(*(tokens[i:] for i in range(n))))


def bleu(prediction, reference):
    p, r = tokens_13a(prediction or ""), tokens_13a(reference or "")
    logs = 0.0
    for n in range(1, 5):
        hit = sum((grams(p, n) & grams(r, n)).values())
        if not hit:
            return 0.0
        logs += math.log(hit / (len(p) - n + 1))
    return (1.0 if len(p) > len(r) else math.exp(1 - len(r) / len(p))) * math.exp(logs / 4)


def rouge_tokens(text):
    return [t for t in re.split("[^a-z0-9]+", (text or "").lower()) if t]


def f1(hit, a, b):
    return 2 * hit / (a + b) if hit else 0.0


def rouge_2(prediction, reference):
    p, r = (grams(rouge_tokens(t), 2) for t in (prediction, reference))
    return f1(sum((p & r).values()), sum(p.values()), sum(r.values()))


def rouge_l(prediction, reference):
    p, r = rouge_tokens(prediction), rouge_tokens(reference)
    row = [0] * (len(p) + 1)
    for t in r:
        new = [0]
        for j, x in enumerate(p):
            new.append(row[j] + 1 if x == t else max(row[j + 1], new[j]))
        row = new
    return f1(row[-1], len(p), len(r))


def pairs():
    rng = random.Random(4)
    words = ["the", "The", "cat", "3.5", "1-2", "é", "mat.", "a,b", "&quot;x&amp;", "sat-\non", "<skipped>", "x\n", "{z}", "it's", " ", "100%", "b.5"]
    made = [(" ".join(rng.choices(words, k=rng.randrange(60))), " ".join(rng.choices(words, k=rng.randrange(60)))) for _ in range(60)]
    long = [" ".join(rng.choices("abcdefg", k=n)) for n in (61, 62, 63, 124, 125, 400)]
    made += [(a, b) for a in long for b in long[::2]] + [(a, a) for a in long]
    return made + [("the cat sat on the mat.", "the cat sat on the mat ."), ("the cat", "the cat sat"), ("a b c", "a b d"), ("", "a"), ("a", ""), ("", ""), (None, "a"), ("a b", None), (None, None), ("a " * 70, "a " * 65)]


@pytest.mark.parametrize("name", ["bleu", "rouge_2", "rouge_l"])
def test_scores_equal_plain_python(spark, name):
    rows = pairs()
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "i int, p string, r string").repartition(4)
    found = {r.i: r.s for r in df.select("i", getattr(metrics, name)(F.col("p"), F.col("r")).alias("s")).collect()}
    for i, p in enumerate(rows):
        assert found[i] == pytest.approx(globals()[name](*p), abs=1e-12), p
    assert any(0 < s < 1 for s in found.values()) and found[len(rows) - 10] >= 0.99 * (name != "bleu")


def test_a_tie_in_the_seventh_place_goes_up(spark):
    df = spark.createDataFrame([(" ".join("ab" for _ in range(5)), " ".join(["ab"] * 5 + [f"w{i}" for i in range(246)]))], "p string, r string")
    (r,) = df.select(F.round(metrics.rouge_l(F.col("p"), F.col("r")), 6).alias("s")).collect()
    assert r.s == 0.039063  # 10 / 256


def test_two_models_are_compared(spark, tmp_path):
    from orrery import __main__ as cli
    from orrery.operators import report

    answers = "question string, reference_answer string, model_answer string, model string"
    base = [("q0", "the cat sat on the mat today", "the cat sat on the mat today", "b"), ("q1", "a b c d e", "x", "b"), ("q2", "r", None, "b"), ("q1", "a b c d e", "a b c d", "b"), ("q3", "one two three", None, "b")]
    tuned = [("q0", "the cat sat on the mat today", "the cat", "t"), ("q1", "a b c d e", "a b c d e", "t"), ("q2", "r", None, "t"), ("q3", "one two three", "one two", "t")]
    for name, rows in (("base", base), ("tuned", tuned)):
        spark.createDataFrame(rows, answers).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    cli.main(["evaluate", "--input", f"{tmp_path}/base", "--other", f"{tmp_path}/tuned", "--output", f"{tmp_path}/scores"], spark)
    found = {r.question: r for r in spark.read.parquet(f"{tmp_path}/scores").collect()}
    assert sorted(found) == ["q0", "q1", "q3"] and [found[q].pos for q in ("q0", "q1", "q3")] == [0, 1, 4]
    assert found["q1"].base_answer == "a b c d" and found["q3"].base_answer is None
    for q, ref, b, t in (("q0", *base[0][1:3], "the cat"), ("q1", "a b c d e", "a b c d", "a b c d e"), ("q3", "one two three", None, "one two")):
        for name, f in (("BLEU", bleu), ("ROUGE_2", rouge_2), ("ROUGE_L", rouge_l)):
            assert (found[q][f"{name}_base"], found[q][f"{name}_finetuned"]) == pytest.approx((f(b, ref), f(t, ref)))
    values = [r[f"ROUGE_L_{s}"] for r in found.values() for s in ("base", "finetuned")]
    low, high = min(values), max(values)
    for r in found.values():
        norm = [(r[f"ROUGE_L_{s}"] - low) / (high - low) for s in ("base", "finetuned")]
        assert [r.ROUGE_L_base_norm, r.ROUGE_L_finetuned_norm, r.ROUGE_L_diff] == pytest.approx([*norm, norm[1] - norm[0]])
        assert r.mean_finetuned == pytest.approx((r.BLEU_finetuned_norm + r.ROUGE_2_finetuned_norm + r.ROUGE_L_finetuned_norm) / 3)
    cli.main(["rank", "--input", f"{tmp_path}/scores", "--output", f"{tmp_path}/ranked", "--amount", "2"], spark)
    ranked = spark.read.parquet(f"{tmp_path}/ranked").orderBy("rank").collect()
    assert [r.question for r in ranked][0] == "q1" and len(ranked) == 4
    more = report.compared(*[spark.read.parquet(f"{tmp_path}/{n}").withColumn("pos", F.monotonically_increasing_id()) for n in ("base", "tuned")], "pos", {"own": lambda p, r: [float(len(x)) for x in p]})
    assert {r.question: r.own_finetuned for r in more.collect()} == {"q0": 7.0, "q1": 9.0, "q3": 7.0}
