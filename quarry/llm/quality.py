"""Quality classifier: generalised additive model with pairwise interactions.

Each text is described by a few surface features (case, symbols, repetition,
line shape ...). Cyclic boosting visits the features in turn; each visit fits a
tree of at most four leaves to the current residuals of one binned feature and
adds it to that feature's lookup table. The strongest pairs are then boosted
the same way with trees over two features. A score is the logistic function of
an intercept plus one table entry per feature and per pair, read for a whole
batch at once.

Features are computed where the texts are (``mapInPandas``); only the feature
rows of a bounded labelled sample (``MAX_EXAMPLES``, chosen by a hash of the id)
come to the driver for the fit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, shingle_hashes, slices, to_workers, word_hashes

#: Bound of the labelled rows that the model is fitted on.
MAX_EXAMPLES = 20_000
FEATURES = ("log_words", "word_bytes", "upper", "digit", "symbol", "stop", "shout", "pipe", "distinct_words",
            "top_word", "distinct_triples", "repeated_lines", "line_words", "non_ascii", "symbol_end")

_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _SHOUT, _PIPE, _SYMBOL, _HIGH = range(9)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x80:] = _UPPER, _LOWER, _DIGIT, _HIGH
_KIND[SPACE] = _SPACE
for _c in b".,;:'\"()-":
    _KIND[_c] = _STOP
for _c in b"!?":
    _KIND[_c] = _SHOUT
_KIND[ord("|")] = _PIPE


def features(texts) -> np.ndarray:
    """One row of ``FEATURES`` per text; a null text counts as empty, an empty one is all zeros."""
    words, off = word_hashes(texts, SPACE)
    triples = shingle_hashes(words, off, 3)
    out = np.zeros((len(off) - 1, len(FEATURES)))
    for i, t in enumerate(texts):
        n = int(off[i + 1] - off[i])
        if not n:
            continue
        data = t.encode("utf-8", "replace")
        a = _KIND[np.frombuffer(data, np.uint8)]
        c = np.bincount(a, minlength=9)
        ink = max(1, len(a) - c[_SPACE])
        _, counts = np.unique(words[off[i]:off[i + 1]], return_counts=True)
        lines = [x for x in t.split("\n") if x.strip()]
        odd = a[:-1] >= _PIPE
        ends = np.count_nonzero(odd & (a[:-1] <= _SYMBOL) & (a[1:] == _SPACE)) + int(a[-1] in (_PIPE, _SYMBOL))
        out[i] = (np.log1p(n), ink / n, c[_UPPER] / max(1, c[_UPPER] + c[_LOWER]), c[_DIGIT] / ink, c[_SYMBOL] / ink,
                  c[_STOP] / ink, c[_SHOUT] / ink, c[_PIPE] / ink, len(counts) / n, counts.max() / n,
                  len(np.unique(triples[i])) / len(triples[i]), 1 - len(set(lines)) / len(lines),
                  np.log1p(n / len(lines)), c[_HIGH] / ink, ends / n)
    return out


@dataclass
class Gam:
    """Lookup tables of the model: ``tables[j][bin]`` and ``pairs[(j, k)][bin_j, bin_k]``."""
    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: dict = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        m = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            m += t[b[j]]
        for (j, k), t in self.pairs.items():
            m += t[b[j], b[k]]
        return m

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _split(g: np.ndarray, h: np.ndarray, lam: float, least: float) -> tuple[float, int]:
    """(gain, first bin of the right side) of the best cut of binned gradients; 0 when none helps."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    if not len(gl):
        return 0.0, 0
    gain = gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - g.sum() ** 2 / (h.sum() + lam)
    gain[(hl < least) | (hr < least)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, lam: float, least: float) -> np.ndarray:
    """Value of each bin under a tree of depth two over the ordered bins."""
    value = np.zeros(len(g))
    parts = [(0, len(g))]
    for _ in range(2):
        nxt = []
        for a, b in parts:
            gain, cut = _split(g[a:b], h[a:b], lam, least)
            nxt += [(a, a + cut), (a + cut, b)] if gain > 1e-9 else [(a, b)]
        parts = nxt
    for a, b in parts:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + lam)
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray, lam: float, least: float) -> tuple[float, np.ndarray]:
    """(gain, values) of a tree that cuts one feature, then the other on each side; the better order wins."""
    best = (0.0, np.zeros_like(g))
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        _, cut = _split(gg.sum(1), hh.sum(1), lam, least)
        cuts = range(1, len(gg), max(1, len(gg) // 8)) if not cut else {cut, *range(1, len(gg), max(1, len(gg) // 8))}
        for c in cuts:
            value, total = np.zeros_like(gg), 0.0
            for rows in (slice(0, c), slice(c, None)):
                a, b = gg[rows].sum(0), hh[rows].sum(0)
                _, at = _split(a, b, lam, least)
                for cols in (slice(0, at), slice(at, None)):
                    s, w = a[cols].sum(), b[cols].sum()
                    if w > 0:
                        value[rows, cols] = s / (w + lam)
                        total += s * s / (w + lam)
            if total > best[0]:
                best = (total, value.T if flip else value)
    return best


def fit_gam(x: np.ndarray, y: np.ndarray, bins: int = 32, cycles: int = 60, pair_cycles: int = 20, n_pairs: int = 6,
            rate: float = 0.2, lam: float = 1.0, least: float = 1.0) -> Gam:
    """Cyclic boosting under logistic loss. No rows give score 0.5; one class gives its smoothed share."""
    y = np.asarray(y, float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    q = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], q)) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    b = model.bins(x)
    m = np.full(len(y), model.intercept)

    def residual():
        p = 1 / (1 + np.exp(-m))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for j, t in enumerate(model.tables):
            r, w = residual()
            step = rate * _tree(np.bincount(b[j], r, len(t)), np.bincount(b[j], w, len(t)), lam, least)
            t += step
            m += step[b[j]]

    def grid(j, k):
        r, w = residual()
        shape = (len(model.tables[j]), len(model.tables[k]))
        cell = b[j] * shape[1] + b[k]
        return (np.bincount(cell, r, shape[0] * shape[1]).reshape(shape), np.bincount(cell, w, shape[0] * shape[1]).reshape(shape))

    d = x.shape[1]
    gains = sorted(((_pair_tree(*grid(j, k), lam, least)[0], j, k) for j in range(d) for k in range(j + 1, d)
                    if len(model.tables[j]) > 1 and len(model.tables[k]) > 1), reverse=True)
    model.pairs = {(j, k): np.zeros((len(model.tables[j]), len(model.tables[k]))) for g, j, k in gains[:n_pairs] if g > 0}
    for _ in range(pair_cycles):
        for (j, k), t in model.pairs.items():
            step = rate * _pair_tree(*grid(j, k), lam, least)[1]
            t += step
            m += step[b[j], b[k]]
    return model


def _feature_rows(batches):
    for big in batches:
        for pdf in slices(big, "text"):
            yield pd.DataFrame(features(pdf["text"]), columns=list(FEATURES)).assign(y=pdf["y"].to_numpy())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
        max_examples: int = MAX_EXAMPLES) -> Gam:
    """Model from at most ``max_examples`` labelled rows (the smallest hashes of the id, so any run picks the same).

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1); rows without either are
    ignored. Only feature rows of the sample reach the driver.
    """
    to_workers(docs.sparkSession)
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
              .where("id is not null and y is not null").orderBy(F.xxhash64("id"), "id", "y").limit(max_examples))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    got = (rows.join(F.broadcast(picked), "id").select("text", "y")
           .mapInPandas(_feature_rows, ", ".join(f"{c} double" for c in (*FEATURES, "y"))).toPandas())
    got = got.sort_values(list(got.columns))       # the order of rows must not matter
    return fit_gam(got[list(FEATURES)].to_numpy(), got["y"].to_numpy())


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, score)`` for every row; null and empty texts are scored as texts without words.

    Defined cases: nulls in any column are allowed, repeated rows get equal
    scores, other columns are never read, an empty table gives an empty result.
    """
    to_workers(docs.sparkSession)

    def run(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                yield pd.DataFrame({"id": pdf["id"], "score": model.score(features(pdf["text"]))})

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInPandas(run, "id long, score double").withColumnRenamed("id", id_col)


def fold(id_col: str, parts: int) -> F.Column:
    """crc32 of the id as text, modulo ``parts``; a null id is in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % parts


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: int = 2, parts: int = 4, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, learned from the labels outside the held-out fold."""
    known = labels.where(fold("doc_id", parts) != held_out).select("doc_id", F.col("quality").alias("label"))
    return score(docs, fit(docs, known)).select(
        "doc_id", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns unchanged."""
    to_workers(docs.sparkSession)
    model = fit(docs, labels.where(fold("doc_id", 4) != 2).select("doc_id", F.col("quality").alias("label")))
    text = next(i for i, c in enumerate(docs.columns) if c == "text")

    def run(batches):
        for big in batches:
            for pdf in slices(big.set_axis([f"c{i}" for i in range(big.shape[1])], axis=1), f"c{text}"):
                yield pdf[model.score(features(pdf[f"c{text}"])) >= threshold].set_axis(big.columns, axis=1)

    return docs.mapInPandas(run, docs.schema)
