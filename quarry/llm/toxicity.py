"""Toxicity by nearest labelled examples under TF-IDF cosine.

Terms are words and word beginnings (``PREFIXES`` letters). A vocabulary is
chosen on a bounded labelled sample by sequential covering: the term that is
most associated with the label (log-likelihood ratio) among the positives that
fewer than ``COVER`` chosen terms explain, again and again. Without the covering
a family of near copies would fill the vocabulary with its incidental words.

Examples become unit TF-IDF vectors over the vocabulary; equal vectors are one
entry with its counts of either label. A block-max inverted index holds, for
each term and block of entries, the largest weight; a query visits blocks by
falling upper bound and stops when no block can beat the k-th cosine, so the
neighbours are exact. Votes are weighted by closeness and calibrated by isotonic
regression on leave-one-out votes of the examples. A text with no vocabulary
term has no neighbour and gets the share of positives among such examples.

The vocabulary, examples and index are bounded by ``MAX_EXAMPLES``; texts are
scored whole, where they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import slices, to_workers
from quarry.llm.quality import fold

#: Bound of the labelled rows that vocabulary and examples are taken from.
MAX_EXAMPLES = 16_000
#: Bounds of the vocabulary: terms looked at by the covering, terms chosen.
MAX_TERMS, MAX_VOCABULARY = 2_000, 256
PREFIXES = (4, 5)
COVER = 2
MIN_DF, MIN_RATIO = 4, 20.0        # least documents and log-likelihood ratio of a term
MIN_SHARE = 0.9                    # least share of positives among the documents of a term
NEIGHBOURS = 15
BLOCK = 64

WORD = re.compile(r"[^\W\d_]+")


def term_counts(text) -> Counter:
    """Words and word beginnings (marked by a trailing ``*``) of a whole text; none for null."""
    words = Counter(WORD.findall(text.lower())) if isinstance(text, str) else Counter()
    out = Counter(words)
    for w, n in words.items():
        for k in PREFIXES:
            if len(w) > k:
                out[w[:k] + "*"] += n
    return out


class BlockMaxIndex:
    """Inverted index over unit vectors with the largest weight of each term in each block of entries."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int = BLOCK):
        # entries with the same heaviest term stand together, which keeps block bounds tight
        self.order = sorted(range(len(vectors)), key=lambda i: (max(vectors[i], key=vectors[i].get, default=-1), i))
        self.block, self.n = block, len(vectors)
        self.blocks = -(-self.n // block)
        self.weights = np.zeros((n_terms, self.blocks * block), np.float64)
        for at, i in enumerate(self.order):
            for t, w in vectors[i].items():
                self.weights[t, at] = w
        self.best = self.weights.reshape(n_terms, self.blocks, block).max(axis=2) if self.blocks else np.zeros((n_terms, 0))

    def search(self, vector: dict[int, float], k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The ``k`` entries of largest positive cosine as (cosine, entry), ties by entry number."""
        if not self.n or not vector:
            return []
        t, w = np.fromiter(vector, int), np.fromiter(vector.values(), float)
        bound = w @ self.best[t]
        top: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(top) == k and bound[b] < top[-1][0]:
                break
            s = w @ self.weights[t, b * self.block:(b + 1) * self.block]
            for at in np.flatnonzero(s > 0):
                i = self.order[b * self.block + at]
                if i != skip:
                    top.append((float(min(1.0, round(s[at], 12))), i))
            top.sort(key=lambda x: (-x[0], x[1]))
            del top[k:]
        return top


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit (pool adjacent violators)."""
    pools: list[list[float]] = []                       # [sum w*y, sum w, x from, x to]
    for a, b, c in sorted(zip(x, y, w)):
        pools.append([b * c, c, a, a])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            s, n, _, to = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += n
            pools[-1][3] = to
    px = [v for p in pools for v in (p[2], p[3])]
    py = [v for p in pools for v in ((p[0] / p[1],) * 2)]
    return np.array(px), np.array(py)


@dataclass
class Neighbours:
    """Fitted model; ``score`` gives the score and the evidence of one text."""
    base: float = 0.5
    vocabulary: dict = field(default_factory=dict)      # term -> number
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    index: BlockMaxIndex | None = None
    good: np.ndarray = field(default_factory=lambda: np.zeros(0))   # examples of label 0 and 1 behind each entry
    bad: np.ndarray = field(default_factory=lambda: np.zeros(0))
    first: list = field(default_factory=list)           # smallest example id of each entry
    knots: tuple = (np.zeros(1), np.full(1, 0.5))

    def counts(self, text) -> dict[str, int]:
        out: Counter = Counter()
        if isinstance(text, str) and self.vocabulary:
            v = self.vocabulary
            for w, n in Counter(WORD.findall(text.lower())).items():
                if w in v:
                    out[w] += n
                for k in PREFIXES:
                    if len(w) > k and (p := w[:k] + "*") in v:
                        out[p] += n
        return out

    def vector(self, counts: dict[str, int]) -> dict[int, float]:
        raw = {self.vocabulary[t]: (1 + np.log(n)) * self.idf[self.vocabulary[t]] for t, n in sorted(counts.items())}
        norm = np.sqrt(sum(w * w for w in raw.values()))
        return {t: float(w / norm) for t, w in raw.items()} if norm > 0 else {}

    def vote(self, near: list[tuple[float, int]], out: tuple[int, int, int] = (-1, 0, 0)) -> float:
        """Closeness-weighted share of positives; ``out`` leaves examples of an entry aside."""
        yes = no = 0.0
        for c, i in near:
            w = 1 / (1.05 - c)
            g, b = self.good[i], self.bad[i]
            if i == out[0]:
                g, b = g - out[1], b - out[2]
            n = g + b
            if n > 0:                                   # an entry of many examples weighs more, but not in proportion
                yes += w * np.sqrt(n) * b / n
                no += w * np.sqrt(n) * g / n
        return (yes + 0.5 * self.base) / (yes + no + 0.5)

    def score(self, text) -> tuple[float, list[tuple[float, int]], list[str]]:
        c = self.counts(text)
        near = self.index.search(self.vector(c), NEIGHBOURS) if c and self.index else []
        if not near:
            return self.base, [], []
        return float(np.interp(self.vote(near), *self.knots)), [(s, self.first[i]) for s, i in near[:3]], sorted(c)


def ratio(pos, neg, n_pos: int, n_neg: int):
    """Log-likelihood ratio of a term's presence with the label."""
    pos, neg = np.asarray(pos, float), np.asarray(neg, float)
    n = n_pos + n_neg
    df = pos + neg

    def part(o, e):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(o > 0, o * np.log(o / e), 0)

    return 2 * (part(pos, df * n_pos / n) + part(neg, df * n_neg / n) + part(n_pos - pos, (n - df) * n_pos / n)
             + part(n_neg - neg, (n - df) * n_neg / n))


def cover(terms: list[str], has: np.ndarray, y: np.ndarray) -> list[str]:
    """Terms (columns of ``has``) chosen by sequential covering; of a word and its beginnings only one is chosen."""
    covered = np.zeros(len(y), int)
    stems = [t.rstrip("*") for t in terms]
    neg = has[y == 0].sum(0)
    free = np.ones(len(terms), bool)
    chosen: list[int] = []
    while len(chosen) < MAX_VOCABULARY and free.any():
        open_ = (y == 1) & (covered < COVER)
        pos = has[open_].sum(0)
        g = ratio(pos, neg, max(1, int(open_.sum())), max(1, int((y == 0).sum())))
        g[(pos < MIN_DF) | ~free] = 0
        best = int(np.argmax(g))
        if g[best] < MIN_RATIO:
            break
        chosen.append(best)
        covered += has[:, best]
        free &= [not (s.startswith(stems[best]) or stems[best].startswith(s)) for s in stems]
    return [terms[i] for i in chosen]


def build(rows: list[tuple[int, int, dict[str, int]]], vocabulary: list[str]) -> Neighbours:
    """Model from examples ``(id, label, term counts)`` over the vocabulary, one per distinct text."""
    m = Neighbours(vocabulary={t: i for i, t in enumerate(vocabulary)})
    plain = [y for _, y, c in rows if not c]
    m.base = (sum(plain) + 0.5) / (len(plain) + 1)
    df = Counter(t for _, _, c in rows for t in c)
    m.idf = np.array([np.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary])
    entries: dict[tuple, list] = {}
    for i, y, c in sorted(rows, key=lambda r: (r[0], r[1])):
        if c:
            v = m.vector(c)
            e = entries.setdefault(tuple((t, round(w, 6)) for t, w in sorted(v.items())), [v, 0, 0, i])
            e[1 + y] += 1
    m.index = BlockMaxIndex([e[0] for e in entries.values()], len(vocabulary))
    m.good, m.bad = np.array([e[1] for e in entries.values()], float), np.array([e[2] for e in entries.values()], float)
    m.first = [e[3] for e in entries.values()]
    raw, y, w = [], [], []
    for i, e in enumerate(entries.values()):             # leave one example out at a time
        near = m.index.search(e[0], NEIGHBOURS + 1)
        for label, n in ((0, e[1]), (1, e[2])):
            if n:
                raw.append(m.vote(near, (i, 1 - label, label)))
                y.append(label)
                w.append(n)
    if raw:
        x, p = isotonic(np.array(raw), np.array(y, float), np.array(w, float))
        n = sum(w)
        m.knots = (x, (p * n + m.base) / (n + 1))        # never quite 0 or 1
    return m


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
        max_examples: int = MAX_EXAMPLES) -> Neighbours:
    """Model from at most ``max_examples`` labelled rows (smallest hashes of the id); equal texts count once.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1); rows without either are ignored.
    """
    to_workers(docs.sparkSession)
    picked = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").orderBy(F.xxhash64("id"), "id", "y").limit(max_examples))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(picked), "id")
            .groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("h"))
            .agg(F.min(F.struct("id", "y", "text")).alias("r")).select("r.*"))

    def vocabulary(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                pos, neg = Counter(), Counter()
                for y, t in zip(pdf["y"], pdf["text"]):
                    (pos if y else neg).update(term_counts(t).keys())
                terms = list(pos | neg)
                yield pd.DataFrame({"term": terms, "pos": [pos[t] for t in terms], "neg": [neg[t] for t in terms]})

    totals = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    if not n_pos or not n_neg:
        return Neighbours(base=(n_pos + 0.5) / (n_pos + n_neg + 1))
    found = (rows.mapInPandas(vocabulary, "term string, pos long, neg long")
             .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where(f"pos >= {MIN_DF} and pos >= {MIN_SHARE} * (pos + neg)"))
    found = found.orderBy(F.desc(F.col("pos") - 10 * F.col("neg")), "term").limit(MAX_TERMS).toPandas()
    terms = sorted(found["term"])
    known = set(terms)

    def vectors(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                got = [{t: n for t, n in term_counts(x).items() if t in known} for x in pdf["text"]]
                yield pd.DataFrame({"id": pdf["id"], "y": pdf["y"], "t": [list(g) for g in got], "n": [list(g.values()) for g in got]})

    ex = rows.mapInPandas(vectors, "id long, y int, t array<string>, n array<long>").toPandas()
    examples = [(int(i), int(y), dict(zip(t, map(int, n)))) for i, y, t, n in zip(ex["id"], ex["y"], ex["t"], ex["n"])]
    at = {t: i for i, t in enumerate(terms)}
    has = np.zeros((len(examples), len(terms)), bool)
    for r, (_, _, c) in enumerate(examples):
        has[r, [at[t] for t in c]] = True
    chosen = sorted(cover(terms, has, np.array([y for _, y, _ in examples]))) if terms else []
    keep = set(chosen)
    return build([(i, y, {t: n for t, n in c.items() if t in keep}) for i, y, c in examples], chosen)


def score(docs: DataFrame, model: Neighbours, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, score, evidence, terms)`` for every row.

    evidence: up to three nearest labelled examples as (cosine, example id);
    terms: the vocabulary terms that the text holds. Defined cases: null, empty
    and all other texts without a vocabulary term get the model's base share,
    repeated rows get equal scores, other columns are never read, an empty table
    gives an empty result.
    """
    to_workers(docs.sparkSession)

    def run(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                out = [model.score(t) for t in pdf["text"]]
                yield pd.DataFrame({"id": pdf["id"], "score": [o[0] for o in out],
                                    "evidence": [[{"cosine": c, "example": e} for c, e in o[1]] for o in out],
                                    "terms": [o[2] for o in out]})

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInPandas(run, "id long, score double, evidence array<struct<cosine:double,example:long>>, terms array<string>") \
        .withColumnRenamed("id", id_col)


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: int = 0, parts: int = 5, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, held_out, score, predicted, neighbours, terms)``, learned from the labels outside the held-out fold."""
    known = labels.where(fold("doc_id", parts) != held_out).select("doc_id", F.col("toxic").alias("label"))
    near = F.array_join(F.transform("evidence", lambda e: F.concat(e["example"].cast("string"), F.lit(":"), F.round(e["cosine"], 4).cast("string"))), ",")
    return score(docs, fit(docs, known)).select(
        "doc_id", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), near.alias("neighbours"), F.array_join("terms", ",").alias("terms"))
