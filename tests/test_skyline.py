"""Skyline of settings against all pairs."""

import random

from quarry.operators.metrics import skyline


def test_skyline_equals_all_pairs(spark):
    r = random.Random(1)
    rows = [(i, c, round(12 - c + 3 * r.random(), 1), r.choice([None, float("nan"), 1.0, 2.0, 3.0, 3.0]))
            for i, c in enumerate(r.choices(range(12), k=400))]
    df = spark.createDataFrame(rows, "id long, cost int, loss double, gain double").repartition(9)
    ok = [x for x in rows if x[3] is not None and x[3] == x[3]]
    beats = lambda a, b: a[1] <= b[1] and a[2] <= b[2] and a[3] >= b[3] and a[1:] != b[1:]
    want = sorted(x for x in ok if not any(beats(y, x) for y in ok))
    got = skyline(df, ["cost", "loss"], ["gain"])
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == want and len(want) > 2
    assert skyline(df.limit(0), ["cost"]).count() == 0
