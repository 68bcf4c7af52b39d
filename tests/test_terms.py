"""Terms in token streams: the trie against all runs, and both ways of J5 against each other."""

import random

from quarry.operators import stats, terms


def test_trie_equals_all_runs():
    r = random.Random(4)
    for _ in range(200):
        words = [[r.choice("abc") for _ in range(r.randint(1, 4))] for _ in range(r.randint(1, 12))]
        names = sorted({" ".join(w) for w in words})
        tokens = [r.choice("abcd") for _ in range(r.randint(0, 30))]
        runs = {" ".join(tokens[i:i + k]) for k in range(1, 5) for i in range(len(tokens) - k + 1)}
        got = terms.TermTrie(t.split(" ") for t in names).matches(tokens)
        assert {names[i] for i in got} == {t for t in names if t in runs}


def test_both_ways_agree(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["Alpha", "beta", "gamma.", "delta", "\n"]) for _ in range(r.randint(0, 40))), "x") for i in range(120)]
    corpus = spark.createDataFrame(rows + [(500, None, "x"), (501, "", "x"), (3, "alpha beta", "x")], "doc_id long, text string, term string").repartition(5)
    listed = spark.createDataFrame([("alpha",), ("ALPHA  beta",), ("beta delta alpha",), ("alpha beta delta alpha",), ("none",), ("",), (None,), ("alpha",)], "term string")
    walked = sorted(map(tuple, stats.augment_with_terms(corpus, listed, per_term=7).collect()))
    monkeypatch.setattr(terms, "BROADCAST_TERMS", 0)
    joined = sorted(map(tuple, stats.augment_with_terms(corpus, listed, per_term=7).collect()))
    assert walked == joined and len({t for t, _, _ in walked}) >= 3
    assert terms.rows_with_terms(corpus.repartition(200), ["gamma. gamma. gamma. gamma. gamma."], "doc_id").count() < 20      # batches without a hit
    assert stats.augment_with_terms(corpus.limit(0), listed, per_term=2).count() == 0
