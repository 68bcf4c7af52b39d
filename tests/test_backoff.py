"""Back-off models: probabilities sum to one, equal plain counting, and longer contexts help."""

import math
import os
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quarry.operators import backoff
from quarry.operators.backoff import backoff_losses, backoff_model, gram_probabilities
from quarry.session import checkpoint_dir

TRAIN = ["the cat sat on the mat", "The cat ate the fish", "a dog sat on the cat", "the the the the", "", None, "fish"]
WORDS = sorted({w for t in TRAIN if t for w in t.lower().split()})


def plain(order, discount=0.75):
    """p(word, context) by the definition."""
    grams = Counter()
    for t in TRAIN:
        toks = [""] * (order - 1) + (t or "").lower().split()
        grams.update(tuple(toks[i - order + 1:i + 1]) for i in range(order - 1, len(toks)))
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    after = {k: defaultdict(dict) for k in tables}
    for k, table in tables.items():
        for g, c in table.items():
            after[k][g[:-1]][g[-1]] = c

    def p(word, context):
        k = len(context) + 1
        shorter = 1 / (len(after[1][()]) + 1) if k == 1 else p(word, context[1:])
        seen = after[k].get(context)
        if not seen:
            return shorter
        t = sum(seen.values())
        return max(seen.get(word, 0) - discount, 0) / t + discount * len(seen) / t * shorter
    return p


def test_probabilities_sum_to_one_and_equal_plain_counting(spark):
    train = spark.createDataFrame([(t, "x") for t in TRAIN], "text string, lang string")
    for order in (1, 2, 3):
        model = backoff_model(train, "lang", order)
        contexts = [("",) * (order - 1), ("the",) * (order - 1), ("on", "the")[-(order - 1):] if order > 1 else (), ("never", "seen")[:order - 1]]
        contexts = sorted(set(contexts))
        names = [f"w{i}" for i in range(order, 0, -1)]
        asked = spark.createDataFrame([("x", *c, w) for c in contexts for w in WORDS + ["unknownword"]], ["lang", *names])
        p = plain(order)
        got = defaultdict(float)
        for r in gram_probabilities(asked, model, "lang").collect():
            context = tuple(r[n] for n in names[:-1])
            assert math.isclose(r.p, p(r.w1, context), rel_tol=1e-12)
            got[context] += r.p
        assert len(got) == len(contexts) and all(math.isclose(v, 1.0, rel_tol=1e-12) for v in got.values())


def test_losses_and_their_edges(spark):
    train = spark.createDataFrame([(t, "x") for t in TRAIN], "text string, lang string")
    test = spark.createDataFrame([("the cat sat on the fish",), ("dog",), (None,), ("",)], "text string")
    loss = {n: {r.dataset: r for r in backoff_losses(train, test, "lang", ["x", "none"], n).collect()} for n in (1, 2, 3)}
    for n, by in loss.items():
        p, toks = plain(n), [""] * (n - 1) + "the cat sat on the fish".split()
        want = -sum(math.log(p(toks[i], tuple(toks[i - n + 1:i]))) for i in range(n - 1, len(toks))) / 6
        assert math.isclose(by["x"].loss, want, rel_tol=1e-12)
        assert (by["x"].tokens, by["x"].samples, by["x"].batches) == (6, 4, 1) and by["none"].loss is None
    assert loss[3]["x"].loss < loss[1]["x"].loss
    empty = backoff_losses(train, test.where(F.lit(False)), "lang", ["x"], 2).first()
    assert (empty.loss, empty.tokens, empty.samples) == (None, 0, 0)


def test_corpora_asked_together_are_as_asked_alone(spark):
    train = spark.createDataFrame([(t, c) for t in TRAIN for c in ("x", None)] + [("a cat sat", "y"), ("the cat", "y")], "text string, lang string")
    words = [("", "the", "cat"), ("the", "cat", "sat"), ("on", "the", "cat"), ("a", "cat", "never"), ("the", "cat", "sat")]
    asked = spark.createDataFrame([(*w, i) for i, w in enumerate(words)], "w3 string, w2 string, w1 string, n long")
    model = backoff_model(train, "lang", 3)
    together = {(r.lang, r.n): r.p for r in gram_probabilities(asked, model, "lang", corpora=["x", "y", "none"]).collect()}
    alone = asked.withColumn("lang", F.explode(F.array(F.lit("x"), F.lit("y"), F.lit("none"), F.lit(None).cast("string"))))
    alone = {(r.lang, r.n): r.p for r in gram_probabilities(alone, model, "lang").collect()}
    assert together == {k: v for k, v in alone.items() if k[0]} and len(together) == 15 and len(alone) == 20
    p = plain(3)
    for i, w in enumerate(words):
        assert math.isclose(together["x", i], p(w[2], w[:2]), rel_tol=1e-12)
        assert together["none", i] is None and alone[None, i] is None and together["y", i] != together["x", i]


def test_what_is_written_stays_near_the_size_of_the_texts(spark, monkeypatch):
    draw = random.Random(7)
    texts = [" ".join(f"word{int(draw.paretovariate(0.6)) % 4000}" for _ in range(100)) for _ in range(1500)]
    train = spark.createDataFrame([(t, "xyz"[i % 3]) for i, t in enumerate(texts)], "text string, lang string").repartition(4)
    test = spark.createDataFrame([(t,) for t in texts[:150]], "text string")
    written = []

    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(checkpoint_dir(spark)) for f in names if f.startswith("part-"))

    def noted(df, cut=backoff.cut_lineage):
        before, out = size(), cut(df)
        written.append(size() - before)
        return out

    monkeypatch.setattr(backoff, "cut_lineage", noted)
    rows = backoff_losses(train, test, "lang", ["x", "y", "z"], 3).collect()
    assert len(rows) == 3 and all(r.loss > 0 and r.tokens == 15000 for r in rows)
    assert 0 < max(written) < sum(map(len, texts)) / 2      # a row for each gram took 1.5 times the texts
