"""Chains of closes found in parallel equal the walk over all rows."""

import random

import pytest

from quarry.operators import chains
from quarry.operators.packing import pack_short


def walk(sizes, limit):
    total = last = number = 0
    out = []
    for s in sizes:
        total += s
        closes = total - last > limit
        out.append((number, closes))
        if closes:
            last, number = total, number + 1
    return out


@pytest.mark.parametrize("seed,limit,sizes", [(1, 10, (1, 8)), (2, 25, (1, 40)), (3, 7, (1, 3000)), (4, 50, (50, 51))])
def test_chain_equals_walk(spark, monkeypatch, seed, limit, sizes):
    monkeypatch.setattr(chains, "SPAN", 4)              # many stretches, several levels of composition
    monkeypatch.setattr(chains, "FAN", 3)
    r = random.Random(seed)
    size = [r.choice([r.randrange(*sizes), sizes[0], sizes[1]]) for _ in range(700 if sizes[1] < 1000 else 60)]
    ends = [sum(size[:i + 1]) for i in range(len(size))]
    rows = spark.createDataFrame([(i, 1, e - s, e) for i, (e, s) in enumerate(zip(ends, size))], "key long, weight long, before long, end long")
    got = sorted((x.key, x.number, x.closes) for x in chains.chain_numbers(rows, limit).collect())
    assert got == [(i, n, c) for i, (n, c) in enumerate(walk(size, limit))]


def test_chain_of_no_rows(spark):
    rows = spark.createDataFrame([], "key long, weight long, before long, end long")
    assert chains.chain_numbers(rows, 5).count() == 0


def test_packs_equal_the_sequential_rule(spark, monkeypatch):
    monkeypatch.setattr(chains, "SPAN", 3)
    monkeypatch.setattr(chains, "FAN", 4)
    r = random.Random(7)
    texts = [None, ""] + [" ".join("w" * r.randrange(1, 9) for _ in range(r.choice([2, 12, 20, 30, 39, 60]))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packs, buf = [], []
    for i, t in enumerate(texts):
        n = len((t or "").split())
        if 10 <= n < 40:
            buf.append(i)
            b = "".join(texts[j] + " " for j in buf)
            if len(b) > 200:
                if min(len(b.split()), 100) >= 40:
                    packs.append((buf[0], buf[-1], len(buf), min(len(b.split()), 100), len(b)))
                buf = []
    kept = sum(len((t or "").split()) >= 40 for t in texts)
    got = pack_short(docs, max_length=100, min_length=40, pack_min=10, max_samples=lambda k: 3 * k + 20).orderBy("pack_id").collect()
    assert len(packs) > 30
    assert [(x.first_doc, x.last_doc, x.n_texts, x.n_tokens, x.chars) for x in got] == packs[:2 * kept + 20]
    some = pack_short(docs, max_length=100, min_length=40, pack_min=10, max_samples=2 * kept + 9)
    assert some.count() == min(len(packs), kept + 9)
    assert pack_short(docs, max_length=100, min_length=40, pack_min=10, max_samples=kept).count() == 0
