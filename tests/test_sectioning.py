"""Sections under a budget against all ways to cut."""

import itertools
import random

from quarry.operators.sectioning import UNIT, best_cuts, budget_sections, cut_cost


def brute(cost, budget):
    n, best = len(cost), None
    for k in range(n):
        for cuts in itertools.combinations(range(1, n), k):
            ends = [*cuts, n]
            if all(b - a <= budget for a, b in zip([0, *ends], ends)):
                value = (len(ends), sum(cost[c - 1] for c in cuts))
                best = value if best is None else min(best, value)
        if best:
            return best


def test_cuts_equal_all_ways():
    r = random.Random(2)
    for _ in range(150):
        cost, budget = [r.choice([0, 1, 2, 4]) for _ in range(r.randint(1, 11))], r.randint(1, 5)
        ends = best_cuts(cost, budget)
        assert ends[-1] == len(cost) and all(0 < b - a <= budget for a, b in zip([0, *ends], ends))
        assert (len(ends), sum(cost[e - 1] for e in ends[:-1])) == brute(cost, budget)
    assert best_cuts([], 3) == []


def test_costs():
    assert [cut_cost(u) for u in ("a\n \n", "a\n", "end. ", 'end."  ', "word ", "1.5 ")] == [0, 1, 2, 2, 4, 4]


def test_sections_join_to_the_text(spark):
    texts = ["  one two three. four five\n\nsix seven eight nine\nten", "short text", None, "", " \n ", "w " * 5000, "a b \U0001f600 c d\x0be f g"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], "again")]
    df = spark.createDataFrame(rows, "id long, text string, section string")
    got = budget_sections(df, "id", budget=4).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
        assert r.n_tokens == len(UNIT.findall(r.section)) <= 4
    assert set(by) == {0, 5, 6} and len(by[5]) == 2 * 1250
    for i in (0, 6):
        parts = sorted(by[i], key=lambda r: r.section_pos)
        assert "".join(r.section for r in parts) == texts[i]
    assert len(by[0]) == 3 and min(by[0], key=lambda r: r.section_pos).section == "  one two three. "      # the end of a sentence
    assert budget_sections(df.limit(0), "id").count() == 0
