"""Reuse distances against a list that is walked request by request."""

import random

import numpy as np

from quarry.operators.reuse import cache_curve, earlier_greater, reuse_distances

SCHEMA = "request_id long, input_key string, start_us long"


def walked(rows):
    """(distance, gap) of every reuse, by the list of inputs in order of their last use."""
    recent, last, out = [], {}, {}
    for rid, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        if key is not None and key in last:
            out[rid] = (len(recent) - 1 - recent.index(key), at - last[key])
            recent.remove(key)
        recent.append(key if key is not None else ("none", rid))
        last[key] = at
    return out


def hot_log(n=700, seed=3):
    r = random.Random(seed)
    return [(i, r.choice(["hot"] * 10 + [None] + [f"k{j}" for j in range(20)]), 1_000_000 * r.randrange(n // 2)) for i in range(n)]


def test_earlier_greater_equals_all_pairs():
    r = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 50, 257):
        place, value = r.integers(0, max(1, n // 2), n), r.permutation(n) * 3
        want = [int(((place < p) & (value > v)).sum()) for p, v in zip(place, value)]
        assert earlier_greater(place, value).tolist() == want


def test_distances_equal_the_walk(spark):
    rows = hot_log()
    log = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = walked(rows)
    for width in (16, 100, None):
        got = {x.request_id: (x.distance, x.gap_us) for x in reuse_distances(log, width=width).collect()}
        assert got == want, width


def test_curve_equals_simulated_caches(spark):
    rows = hot_log(300, 8)
    log = spark.createDataFrame(rows, SCHEMA)
    got = {(x.capacity, x.max_age_s): (x.requests, x.hits) for x in cache_curve(log, [1, 5, 50], [None, 20], width=32).collect()}
    for (capacity, age), (requests, hits) in got.items():
        kept, want = {}, 0
        for rid, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
            key = key if key is not None else ("none", rid)
            if key in kept:
                want += age is None or at - kept[key] <= age * 1_000_000
                del kept[key]
            kept[key] = at
            if len(kept) > capacity:
                del kept[next(iter(kept))]
        assert (requests, hits) == (300, want)
    assert len(got) == 6


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert reuse_distances(empty).count() == 0
    assert [tuple(r) for r in cache_curve(empty, [4]).collect()] == [(4, None, 0, 0, None)]
    assert reuse_distances(spark.createDataFrame([(1, "a", 5)], SCHEMA)).count() == 0
