"""Ranked search, line deduplication and fill-in-middle against brute force, and their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm.common import NON_WORD, word_hashes
from quarry.llm.fim import fill_in_middle, restored
from quarry.llm.line_dedup import dedup_lines
from quarry.llm.ranked_search import BLOCK, Shard, build_index, ranked, search, shard_rows, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# -- fill-in-middle ------------------------------------------------------------------------

def cut(doc_id, text):
    """(n, form, prefix, middle, output) by plain Python."""
    text = text or ""
    units = re.findall(WORD, text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_matches_brute_force(spark):
    r = random.Random(3)
    pieces = ["a", "Zwei", "$1", "\\", "<P", "M>", "<S", "\n", "\n\n", " ", "\t", "\x0b", "\x0c\r", " ", "ü", "😀", "\x00", " ", "(", "{3}", "<"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(0, 40))) for _ in range(400)]
    texts += [None, "", " ", "\n\t", "<P>", "x <S> y", "x<M>", "word", " word ", "w " * 300_000, " " * 200_000, "x" * 200_000]
    rows = [(i, t, "c", 7) for i, t in enumerate(texts)] + [(5, texts[5], "c", 7), (None, "null id goes plain or not", "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    made = fill_in_middle(docs)
    got = made.select("*", restored("output", "form").alias("back")).collect()
    assert len(got) == len(rows)
    by_id = {i: t for i, t, *_ in rows}
    for x in got:
        assert (x.n, x.form, x.prefix_chars, x.middle_chars, x.output) == cut(x.doc_id, by_id[x.doc_id])
        assert x.back == (by_id[x.doc_id] or "")
    assert {x.form for x in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs.limit(0)).count() == 0


# -- line deduplication --------------------------------------------------------------------

def deduped(rows, min_docs=2, min_chars=10):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    last = float("inf")
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs
                or min(held[key(x)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_line_dedup_matches_brute_force(spark, min_docs):
    r = random.Random(min_docs)
    pool = [f"a line that stands in some texts {i}" for i in range(60)] + ["short", "", " ", "TEN CHARS!", "ten chars!", "ΑΒΓ line with Ä", "αβγ line with ä"]
    rows = []
    for i in range(300):
        lines = [r.choice(pool) for _ in range(r.randrange(0, 12))] + [f"only in {i} and nowhere else"] * r.randrange(0, 3)
        lines = [r.choice(["", " ", "\t\x0b"]) + (x.upper() if r.random() < .2 and x.isascii() else x) + r.choice(["", "\r", " "]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "a very common line\n" * 5_000 + "end"), (304, "A Very Common Line \n" * 3),
             (7, rows[7][1]), (9, "another text of an id that exists\n" + pool[0]), (None, pool[1]), (None, pool[1] + "\nmine alone, mine alone"),
             (305, "x" * 300_000), (306, "x" * 300_000 + "\r")]
    docs = spark.createDataFrame([(*x, "c", 1) for x in rows], "doc_id long, text string, kept string, pos int")
    got = [tuple(x) for x in dedup_lines(docs, min_docs=min_docs).collect()]
    assert sorted(got, key=repr) == deduped(rows, min_docs)


def test_line_dedup_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(empty).count() == 0
    # a line of every document is broadcast, a rare one is joined: both ways are taken
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('the line of all texts\nline number ', div(id, 2)) as text")
    got = {x.doc_id: x for x in dedup_lines(docs, min_chars=5).collect()}
    assert got[0].n_dropped == 0 and got[1].n_dropped == 2 and got[1].kept == "" and got[2].kept == "line number 1"


# -- ranked search -------------------------------------------------------------------------

def best(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // n_words
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
                    for t, c in Counter(TERM.findall(lower(text))).items() if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def corpus(r, n, vocabulary=400):
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(r.choices(words, odds, k=r.randrange(1, 120))) + r.choice(["", ".", " Ünï-çode É", "\x00x"]) for _ in range(n)], words


@pytest.mark.parametrize("shard_words", [3_000, 20_000])
def test_search_matches_brute_force(spark, shard_words):
    r = random.Random(shard_words)
    texts, words = corpus(r, 700)
    docs = list(enumerate(texts)) + [(700, None), (701, ""), (702, "..!"), (None, texts[3]), (3, texts[3]), (703, texts[3]),
                                     (704, "w1 " * 30_000 + "w399")]
    items = [(i, " ".join(r.choices(words, k=r.randrange(1, 25)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "nowhere"), (33, "w0 w0 w0 W1 nowhere"), (34, texts[3]), (35, " ".join(words))]
    d = spark.createDataFrame([(*x, "c", 1) for x in docs], "doc_id long, text string, term string, score int")
    q = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    index = build_index(d, shard_words=shard_words).cache()
    got = [tuple(x) for x in search(index, q).collect()]
    assert sorted(got, key=repr) == best(docs, items)
    index.unpersist()


def test_search_edges(spark):
    d = spark.createDataFrame([(1, "alpha beta"), (2, "beta")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "beta alpha"), (1, "alpha"), (None, "beta")], "item_id long, text string")
    got = sorted(((x.item_id, x.rank, x.doc_id) for x in ranked(d, q).collect()), key=repr)
    # two rows of one item id are two queries; "beta" stands in all documents but still weighs something
    assert got == sorted([(1, 1, 1), (1, 2, 2), (1, 1, 1), (None, 1, 2), (None, 2, 1)], key=repr)
    assert ranked(d.limit(0), q).count() == 0
    assert ranked(d, q.limit(0)).count() == 0
    assert ranked(d.where("doc_id > 5"), q).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_items_in_blocks(spark, monkeypatch):
    import quarry.llm.ranked_search as module
    r = random.Random(1)
    texts, words = corpus(r, 200)
    docs, items = list(enumerate(texts)), [(i, " ".join(r.choices(words, k=6))) for i in range(12)]
    monkeypatch.setattr(module, "ITEM_CHARS", 60)
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(x) for x in got.collect()), key=repr) == best(docs, items)


def test_block_maxima_spare_blocks():
    """A rare and a very common term: most blocks of the common one stay packed, and the result is exact."""
    r = random.Random(9)
    n = 40 * BLOCK
    texts = ["common " * r.randrange(1, 4) + "filler " * r.randrange(1, 30) + ("rare" if i % 500 == 0 else "") for i in range(n)]
    words, off = word_hashes(texts, NON_WORD)
    rows = shard_rows(0, list(range(n)), words, np.diff(off))
    shard = Shard(rows, n, len(words))
    term = word_hashes(["common rare"], NON_WORD)[0].view(np.int64).tolist()
    df = {t: int(rows.loc[(rows["term"] == t) & (rows["block"] >= 0), "n_docs"].sum()) for t in term}
    docs, scores = shard.best({t: weight(df[t], n) for t in term}, 0, 10)
    want = best(list(enumerate(texts)), [(0, "common rare")])
    assert sorted(zip(docs.tolist(), scores.tolist())) == sorted((d, s) for _, _, d, s in want)
    assert shard.decoded < 20 < sum(b - a for a, b in shard.lists.values())
