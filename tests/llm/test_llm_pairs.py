"""Near duplicates, decontamination, fingerprints: brute force and defined cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.common import NON_WORD, SPACE, shingle_hashes, word_hashes
from quarry.llm.decontaminate import contaminated, keep_clean
from quarry.llm.fingerprint import containment, decode, distinct, fingerprints, merge, merge_by, neighbour_fingerprints, resemblance, sketches
from quarry.llm.graph import components
from quarry.llm.near_dup import band_plan, keep_one, near_duplicates, signature, xor_limit

SCHEMA = "doc_id long, text string, id string, n long, odd string"        # names that clash with inner ones


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], SCHEMA)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    s = {i: shingles(t, k) for i, t in rows if i is not None}
    comp = {i: i for i in s}
    ids = sorted(s)
    for _ in ids:
        old = dict(comp)
        for a in ids:
            for b in ids:
                if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if old == comp:
            break
    return {i: (len(s[i]), comp[i]) for i in s}


def corpus(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for base in range(12):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([4, 30, 120]))]
        for copy in range(rnd.choice([1, 2, 9])):
            w = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((i, " ".join(w)))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "One"), (i + 4, "one"), (i + 5, "two words"), (i + 6, "TWO\vwords")]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, k, percent):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows), words=k, percent=percent).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(rows, k, percent).items()}


def test_hot_group_of_near_copies_is_whole(spark):
    rnd = random.Random(1)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(260):                               # more than one block once the block is small
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(150)] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    import quarry.llm.near_dup as m
    old, m.BLOCK = m.BLOCK, 64
    try:
        got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), words=3, percent=85).collect()}
    finally:
        m.BLOCK = old
    assert got == {i: c for i, (_, c) in brute(rows, 3, 85).items()}


def test_rows_of_a_hot_group_are_linear(spark, monkeypatch):
    """The smallest id is far from most of its group: parts hold less than two rows a member and no link is lost."""
    import quarry.llm.near_dup as m
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(9 if i == 0 else rnd.randrange(0, 9)):
            w[rnd.randrange(150)] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    made, groups = [], m.map_groups

    def counted(dealt, keys, *rest):
        made.append((dealt.count(), dealt.select("id", "key").distinct().count()))
        return groups(dealt, keys, *rest)

    monkeypatch.setattr(m, "map_groups", counted)
    monkeypatch.setattr(m, "BLOCK", 100)
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), words=3, percent=85).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 3, 85).items()}
    assert made and max(n for _, n in made) > 100 and all(n <= 2 * members for n, members in made)


def test_near_duplicates_defined_cases(spark):
    long_text = " ".join(f"t{i}" for i in range(300_000))
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (3, long_text), (4, long_text + " end"), (5, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows), words=3, percent=85).collect()
                 if r.doc_id is not None)
    assert got == [(1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (3, 299_998, 3, True), (4, 299_999, 3, False), (5, 0, 5, True)]
    kept = keep_one(frame(spark, rows), words=3, percent=85)
    assert kept.columns == ["doc_id", "text", "id", "n", "odd"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 5]
    assert near_duplicates(frame(spark, []).limit(0)).count() == 0
    assert keep_one(frame(spark, []).limit(0)).count() == 0


def test_sketch_bound_holds_at_the_threshold():
    rng = np.random.default_rng(3)
    for n in (20, 150, 1500, 20_000):
        apart = int(n * 0.15 / 2)                      # |A & B| / |A | B| just above 0.85
        for _ in range(20):
            pool = rng.integers(1, 2 ** 63, n + apart, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[apart:])
            if 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
                continue
            x, y = (np.frombuffer(signature(s, 4, 2)[1], np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= xor_limit(float(len(a)), float(len(b)), 85)
    bands, r = band_plan(85)
    assert (1 - 0.85 ** r) ** bands < 1e-6


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 4), (None, 4), (5, 5)] + [(i, i + 1) for i in range(20, 60)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 61)}}
    assert components(links.limit(0)).count() == 0


def test_word_hashes_follow_words():
    texts = ["Ab c\x0bd", None, "", "é É ab", "x" * 3_000_000 + " ab", "a " * 700_000]
    h, off = word_hashes(texts, SPACE)
    assert list(np.diff(off)) == [3, 0, 0, 3, 2, 700_000]
    assert h[0] == h[off[3] + 2] == h[off[4] + 1] and h[off[3]] != h[off[3] + 1]
    assert len(set(h[off[5]:].tolist())) == 1
    h, off = word_hashes(["a-b_c 1", "ab"], NON_WORD)
    assert list(np.diff(off)) == [4, 1]
    assert [len(s) for s in shingle_hashes(h, off, 5)] == [1, 1]


def brute_leaks(docs, items):
    import re
    from collections import Counter

    def words(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def grams(w):
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    out = {}
    for d, t in docs:
        dw = words(t)
        for i, b in items:
            bw = words(b)
            if not bw:
                continue
            if len(bw) < 5:
                at = [p for p in range(len(dw) - len(bw) + 1) if dw[p:p + len(bw)] == bw]
                if at:
                    out[d, i] = (1.0, at[0])
                continue
            g, h = grams(bw), grams(dw)
            w = min(len(g), len(h))
            for s in range(len(h) - w + 1 if w else 0):
                both = sum((Counter(h[s:s + w]) & Counter(g)).values())
                sim = both / (w + len(g) - both)
                if sim >= 0.8 and sim > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (sim, s)
    return out


def test_decontamination_matches_brute_force(spark):
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([6, 20, 45])))) for i in range(15)]
    items += [(50, "la la la la la la la la"), (51, "Kurz und gut"), (52, ""), (53, None), (54, items[0][1])]
    docs = []
    for d in range(40):
        w = [rnd.choice(vocab) for _ in range(60)]
        if d % 2:
            x = rnd.choice(items[:16])[1].split()
            x[rnd.choice([-1, -2])] = rnd.choice([x[-1], "zz"])
            at = rnd.randrange(60)
            w[at:at] = [y.upper() + "," for y in x]
        docs.append((d, " ".join(w)))
    docs += [(90, "kurz, UND gut."), (91, None), (92, ""), (93, "la " * 40), (94, items[1][1]), (95, " ".join(items[2][1].split()[1:]))]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in contaminated(frame(spark, docs), bench).collect()}
    want = brute_leaks(docs, items)
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)
    assert sum(1 for d, _ in want if d < 40) >= 10
    import quarry.llm.decontaminate as m
    old, m.ITEMS_PER_BLOCK = m.ITEMS_PER_BLOCK, 4      # the benchmark in blocks gives the same
    try:
        again = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in contaminated(frame(spark, docs), bench).collect()}
    finally:
        m.ITEMS_PER_BLOCK = old
    assert again == got
    left = keep_clean(frame(spark, docs + docs[:2] + [(None, items[1][1])]), bench)
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == sorted(d for d, _ in docs + docs[:2] if d not in {x for x, _ in want})
    assert left.where("doc_id is null").count() == 1
    assert contaminated(frame(spark, docs), bench.limit(0)).count() == 0
    assert contaminated(frame(spark, []).limit(0), bench).count() == 0


def test_fingerprints_match_brute_force(spark):
    rows = [(i, t) for i, t in corpus(8)] + [(100, "ü" * 7 + " " + "wort " * 3000), (101, "a b"), (102, "a b")]
    import quarry.llm.fingerprint as m
    old, m.ROWS_PER_RUN = m.ROWS_PER_RUN, 7            # several runs
    try:
        got = {r.doc_id: r for r in neighbour_fingerprints(frame(spark, rows)).collect()}
    finally:
        m.ROWS_PER_RUN = old
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    prints = {}
    for at, (i, t) in enumerate(order):
        t, nxt = t or "", order[(at + 1) % len(order)][1] or ""
        h = len(t) // 2
        edited = t[:len(t) - h] + nxt[:h]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingles(t, 5), shingles(edited, 5), shingles(nxt, 5)
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 0.12
        assert abs(r.near_next - (len(a & c) / len(a | c) if a | c else 1)) < 0.12
        assert prints.setdefault(t.lower().replace("\v", " "), r.fingerprint) == r.fingerprint
    plain = {r.doc_id: r.fingerprint for r in fingerprints(frame(spark, rows)).collect()}
    assert plain == {i: r.fingerprint for i, r in got.items()}
    assert neighbour_fingerprints(frame(spark, []).limit(0)).count() == 0
    one = neighbour_fingerprints(frame(spark, [(3, "x y z")])).collect()[0]
    assert one.near_next == 1.0
    same = neighbour_fingerprints(frame(spark, [(3, "x y"), (3, "x y"), (None, "q"), (3, "b")])).collect()
    assert len(same) == 4 and sum(r.doc_id is None for r in same) == 1


def test_sketch_estimates_and_merging(spark):
    a, b = (" ".join(f"t{i}" for i in range(lo, hi)) for lo, hi in ((0, 4000), (1000, 4000)))
    x, y = sketches([a, b])
    assert abs(resemblance(x, y) - 0.75) < 0.1 and abs(containment(y, x) - 1) < 0.1 and abs(distinct(x) / 3996 - 1) < 0.2
    parts = [" ".join(f"t{i}" for i in range(lo, hi + 4)) for lo, hi in ((0, 2000), (2000, 3996))]
    p, q = sketches(parts)
    assert (merge(p, q) == x).all()
    f = fingerprints(spark.createDataFrame([(1, parts[0]), (1, parts[1]), (2, ""), (2, None)], "doc_id long, text string"))
    got = {r.doc_id: r.fingerprint for r in merge_by(f, "doc_id").collect()}
    assert (decode(got[1]) == x).all() and got[2] == ""


def test_window_fingerprints_number_repeats():
    import quarry.llm.decontaminate as m
    sh = np.random.default_rng(1).integers(0, 12, 200).astype(np.uint64)
    for size in (1, 7, 30):
        got = m.window_simhash(sh, 3, 150, size)
        for start in range(3, 151):
            window = sh[start:start + size]
            number = np.array([(window[:k + 1] == x).sum() for k, x in enumerate(window)])
            assert (np.packbits(m._bits(window, number).sum(axis=0) > 0) == got[start - 3]).all()


def index_finds(items, text):
    import quarry.llm.decontaminate as m
    index = m.ItemIndex([i for i, _ in items], [t for _, t in items])
    words, off = word_hashes([text], NON_WORD)
    return index.matches(words, shingle_hashes(words, off, 5)[0], 80)


def test_decontamination_finds_items_whose_repeats_the_page_lacks():
    for seed in range(40):
        rnd = random.Random(seed)
        base = [f"u{rnd.randrange(10 ** 9)}" for _ in range(164)]
        page = [f"x{i}" for i in range(300)] + base + [f"y{i}" for i in range(300)]
        assert [x[0] for x in index_finds([(1, " ".join(base + ["la"] * 20))], " ".join(page))] == [1]       # 160 of 200


def test_decontamination_of_many_items_with_one_opening_is_linear():
    import time
    rnd = random.Random(3)
    opening = "the quick brown fox jumps".split()

    def sentence():
        return " ".join(opening + [f"v{rnd.randrange(5000)}" for _ in range(40)])

    items = [(i, sentence()) for i in range(3000)]
    big = " ".join(f"v{rnd.randrange(5000)}" for _ in range(15000))
    text = " ".join([sentence() for _ in range(2000)] + [items[77][1], big, " ".join(opening * 5000)])
    start = time.time()
    assert sorted(x[0] for x in index_finds(items + [(9000, big)], text)) == [77, 9000]
    assert time.time() - start < 20
