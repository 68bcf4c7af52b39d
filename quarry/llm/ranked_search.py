"""Ranked lexical search by Block-Max MaxScore over sharded inverted indexes.

Index (``build_index``): every task turns its documents into shards of about
``SHARD_WORDS`` words, without a shuffle. A shard has one row per block of at
most ``BLOCK`` postings of a term: first and last document, the competitive
(count, length) pairs of the block, and the postings packed by byte width. One
more row holds ids and lengths of the shard's documents. The competitive pairs
are those that no other posting of the block beats in both, so a block's exact
maximum follows for any collection statistics; the index can be written once and
searched later.

Search (``search``), for a block of items at a time:

1. Collection statistics and, per term of the items, its document frequency, its
   largest and its ``k``-th largest block maximum. The latter belongs to ``k``
   different documents, which bounds an item's k-th best score from below.
2. Per shard and item, MaxScore: lists are ordered by their bounds; those whose
   bounds together stay below the threshold are non-essential. Essential lists
   give candidates, range by range of documents; on non-essential lists the
   maximum of the block that would hold a candidate decides first, and only
   blocks that can still matter are unpacked. Documents are rejected only if
   their bound is below the threshold, so equal scores are never lost.
3. The shards' heaps are merged by score and id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import NON_WORD, U64, map_groups, slices, to_workers, word_hashes
from quarry.session import cut_lineage, scratch

#: Words after which a task closes a shard; a document is never split.
SHARD_WORDS = 1_000_000
BLOCK = 128
#: Documents whose essential lists are added up at a time.
RANGE = 1024
#: Characters of items that are searched for (and sent to the tasks) at a time.
ITEM_CHARS = 2_000_000
INDEX = ("shard long, term long, block int, n_docs int, first int, last int, words long, "
         "impacts binary, postings binary, ids binary")
_WIDTH = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def _widths(x: np.ndarray) -> np.ndarray:
    return np.where(x < 1 << 8, 1, np.where(x < 1 << 16, 2, 4))


def _competitive(block: np.ndarray, tf: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (tf, n) that no posting of their block beats in both, and how many each block has."""
    order = np.lexsort((n, -tf, block))
    # a running minimum of the length that starts anew with each block
    low = n[order] - block[order] * (int(n.max()) + 1)
    keep = np.concatenate([[True], low[1:] < np.minimum.accumulate(low)[:-1]])
    at = order[keep]
    return np.column_stack([tf[at], n[at]]).astype(np.int32), np.bincount(block[at], minlength=int(block[-1]) + 1)


def shard_rows(shard: int, ids: list, words: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """The index rows of one shard; ``counts`` are the words of each document."""
    null = np.array([i is None or i != i for i in ids], bool)
    named = np.array([0 if x else int(i) for i, x in zip(ids, null)], np.int64)
    head = {"shard": shard, "term": 0, "block": -1, "n_docs": int((counts > 0).sum()), "first": 0, "last": len(ids) - 1,
            "words": int(counts.sum()), "impacts": None, "postings": counts.astype(np.int32).tobytes(),
            "ids": named.tobytes() + null.astype(np.uint8).tobytes()}
    out = {k: [v] for k, v in head.items()}
    if len(words):
        order = np.argsort(words, kind="stable")
        term, doc = words[order], np.repeat(np.arange(len(ids)), counts)[order]
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]))
        tf = np.diff(new, append=len(term))
        term, doc = term[new], doc[new]
        begins = np.concatenate([[True], term[1:] != term[:-1]])
        at = np.flatnonzero(begins)
        inside = np.arange(len(term)) - np.repeat(at, np.diff(at, append=len(term)))
        start = np.flatnonzero(inside % BLOCK == 0)
        size = np.diff(start, append=len(term))
        end = start + size
        gap = np.diff(doc, prepend=0)
        gap[start] = 0
        pairs, n_pairs = _competitive(np.repeat(np.arange(len(start)), size), tf, counts[doc])
        cut = np.concatenate([[0], np.cumsum(n_pairs)]) * 8
        raw = pairs.tobytes()
        wide_gap, wide_tf = _widths(np.maximum.reduceat(gap, start)), _widths(np.maximum.reduceat(tf, start))
        as_gap = {w: gap.astype(t).tobytes() for w, t in _WIDTH.items()}
        as_tf = {w: tf.astype(t).tobytes() for w, t in _WIDTH.items()}
        packed = [bytes((g, f)) + as_gap[g][s * g:e * g] + as_tf[f][s * f:e * f]
                  for s, e, g, f in zip(start.tolist(), end.tolist(), wide_gap.tolist(), wide_tf.tolist())]
        cuts = cut.tolist()
        rows = len(start)
        for k, v in {"shard": [shard] * rows, "term": term[start].view(np.int64).tolist(), "block": (inside[start] // BLOCK).tolist(),
                     "n_docs": size.tolist(), "first": doc[start].tolist(), "last": doc[end - 1].tolist(), "words": [0] * rows,
                     "impacts": [raw[a:b] for a, b in zip(cuts, cuts[1:])], "postings": packed, "ids": [None] * rows}.items():
            out[k].extend(v)
    return pd.DataFrame(out)


def _index_rows(shard_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        words: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        for big in batches:
            for pdf in slices(big, "text"):
                w, off = word_hashes(pdf["text"], NON_WORD)
                ids.extend(pdf["id"].astype(object).where(pdf["id"].notna(), None).tolist())
                words.append(w)
                counts.append(np.diff(off))
                held += len(w)
                if held >= shard_words:
                    yield shard_rows(part << 32 | seq, ids, np.concatenate(words), np.concatenate(counts))
                    ids, words, counts, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield shard_rows(part << 32 | seq, ids, np.concatenate(words), np.concatenate(counts))
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Index rows of every row of ``docs`` (columns ``INDEX``), each shard made by one task.

    A null or empty text is a document without terms; a null id is kept as null.
    """
    to_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(_index_rows(shard_words), INDEX)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factor(n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    return 25 + (75 * n * n_docs) // max(n_words, 1)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block_maxima(impacts: list[bytes], n_docs: int, n_words: int) -> np.ndarray:
    pairs = np.frombuffer(b"".join(impacts), np.int32).reshape(-1, 2).astype(np.int64)
    start = np.concatenate([[0], np.cumsum([len(x) // 8 for x in impacts])[:-1]])
    return np.maximum.reduceat(impact(pairs[:, 0], length_factor(pairs[:, 1], n_docs, n_words)), start)


class Shard:
    """The lists of one shard that a set of items needs. ``decoded`` counts the unpacked blocks."""

    def __init__(self, rows: pd.DataFrame, n_docs: int, n_words: int):
        head = rows[rows["block"] < 0].iloc[0]
        lists = rows[rows["block"] >= 0]
        lengths = np.frombuffer(head["postings"], np.int32).astype(np.int64)
        self.size = len(lengths)
        self.ids = np.frombuffer(head["ids"][:8 * self.size], np.int64)
        self.null = np.frombuffer(head["ids"][8 * self.size:], np.uint8).astype(bool)
        self.m = length_factor(lengths, n_docs, n_words)
        self.first, self.last = lists["first"].to_numpy(np.int64), lists["last"].to_numpy(np.int64)
        self.packed = lists["postings"].tolist()
        self.count = lists["n_docs"].tolist()
        term = lists["term"].to_numpy(np.int64)
        self.top = _block_maxima(lists["impacts"].tolist(), n_docs, n_words) if len(lists) else np.zeros(0, np.int64)
        at = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, int)
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(term[at], at, [*at[1:], len(term)])}
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def decoded(self) -> int:
        return len(self.cache)

    def block(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of block ``j``, unpacked once."""
        if j not in self.cache:
            raw, c = self.packed[j], self.count[j]
            gap = np.frombuffer(raw, _WIDTH[raw[0]], c, 2).astype(np.int64)
            tf = np.frombuffer(raw, _WIDTH[raw[1]], c, 2 + c * raw[0]).astype(np.int64)
            doc = self.first[j] + np.cumsum(gap)
            self.cache[j] = doc, impact(tf, self.m[doc])
        return self.cache[j]

    def best(self, weights: dict[int, int], floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the shard's ``k`` best with a score of at least ``floor`` and above 0."""
        lists = sorted(((w * int(self.top[a:b].max()), t, w, a, b) for t, w in weights.items() if w > 0 and t in self.lists
                        for a, b in [self.lists[t]]))
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not lists:
            return docs, scores
        reach = np.cumsum([x[0] for x in lists])            # what lists 0..i can give together
        theta = max(floor, 1)
        for lo in range(0, self.size, RANGE):
            hi = min(lo + RANGE, self.size)
            weak = int(np.searchsorted(reach, theta, "left"))
            if weak == len(lists):
                break                                        # all lists together stay below the threshold
            acc = np.zeros(hi - lo, np.int64)
            for _, _, w, a, b in lists[weak:]:
                begin = a + int(np.searchsorted(self.last[a:b], lo, "left"))
                end = a + int(np.searchsorted(self.first[a:b], hi, "left"))
                for j in range(begin, end):
                    d, f = self.block(j)
                    x, y = (0, len(d)) if d[0] >= lo and d[-1] < hi else np.searchsorted(d, (lo, hi), "left")
                    acc[d[x:y] - lo] += w * f[x:y]
            cand = np.flatnonzero(acc)
            for i in range(weak - 1, -1, -1):
                below = int(reach[i])
                cand = cand[acc[cand] + below >= theta]
                if not len(cand):
                    break
                _, _, w, a, b = lists[i]
                j = a + np.searchsorted(self.last[a:b], cand + lo, "left")
                holds = j < b
                holds[holds] = self.first[j[holds]] <= cand[holds] + lo
                top = np.where(holds, w * self.top[np.minimum(j, b - 1)], 0)
                live = acc[cand] + top + (below - lists[i][0]) >= theta
                cand, j, holds = cand[live], j[live], holds[live]
                for x in np.unique(j[holds]):
                    here = cand[holds & (j == x)]
                    d, f = self.block(int(x))
                    p = np.minimum(np.searchsorted(d, here + lo), len(d) - 1)
                    hit = d[p] == here + lo
                    acc[here[hit]] += w * f[p[hit]]
            cand = cand[acc[cand] >= theta]
            if len(cand):
                docs, scores = np.concatenate([docs, cand + lo]), np.concatenate([scores, acc[cand]])
                if len(docs) > k:
                    keep = np.lexsort((self.ids[docs], self.null[docs], -scores))[:k]
                    docs, scores = docs[keep], scores[keep]
                if len(docs) == k:
                    theta = max(theta, int(scores.min()))
        return docs, scores


def _search_shard(queries: list[tuple], n_docs: int, n_words: int, k: int) -> Callable:
    def run(g: pd.DataFrame):
        shard = Shard(g, n_docs, n_words)
        out = []
        for q, item, weights, floor in queries:
            docs, scores = shard.best(weights, floor, k)
            if len(docs):
                ids = pd.array(shard.ids[docs], "Int64")
                ids[shard.null[docs]] = pd.NA
                out.append(pd.DataFrame({"q": q, "item": item, "doc": ids, "score": scores}))
        return pd.concat(out).astype({"item": "Int64"}) if out else None
    return run


def _maxima(n_docs: int, n_words: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"term": pdf["term"], "n_docs": pdf["n_docs"],
                                    "top": _block_maxima(pdf["impacts"].tolist(), n_docs, n_words)})
    return run


def _search_block(index: DataFrame, items: list[tuple], base: int, n_docs: int, n_words: int, k: int) -> DataFrame:
    """The merged heaps of a bounded list of (item id, text)."""
    spark = index.sparkSession
    words, off = word_hashes([t for _, t in items], NON_WORD)
    bags = [Counter(words[a:b].view(np.int64).tolist()) for a, b in zip(off[:-1], off[1:])]
    terms = spark.createDataFrame([(t,) for t in set().union(*bags)] if len(words) else [], "term long")
    wanted = F.broadcast(terms)                              # at most the words of ITEM_CHARS characters
    blocks = index.where("block >= 0").join(wanted, "term", "left_semi").select("term", "n_docs", "impacts")
    made = blocks.mapInPandas(_maxima(n_docs, n_words), "term long, n_docs long, top long")
    place = Window.partitionBy("term").orderBy(F.desc("top"))
    frequency = made.groupBy("term").agg(F.sum("n_docs").alias("df"))
    high = made.withColumn("r", F.row_number().over(place)).where(F.col("r") == k).select("term", "top")
    df_of = {r.term: r.df for r in frequency.collect()}
    kth = {r.term: r.top for r in high.collect()}
    queries = []
    for i, ((item, _), bag) in enumerate(zip(items, bags)):
        weights = {t: c * weight(df_of[t], n_docs) for t, c in bag.items() if t in df_of}
        if weights:
            queries.append((base + i, item, weights, max(w * kth.get(t, 0) for t, w in weights.items())))
    needed = (index.join(wanted.withColumn("wanted", F.lit(True)), "term", "left").where("wanted or block < 0")
              .select("shard", "term", "block", "n_docs", "first", "last", "impacts", "postings", "ids"))
    return map_groups(needed, ["shard"], ["term", "block"], _search_shard(queries, n_docs, n_words, k),
                      "q long, item long, doc long, score long")


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = 10,
           id_col: str = "doc_id") -> DataFrame:
    """``(<item_col>, rank, <id_col>, score)``: the ``k`` best documents of ``index`` for every row of ``items``.

    Every row of ``items`` is a query of its own. Documents with score 0 are not
    listed; equal scores are in ascending order of the id, nulls last.
    """
    spark = index.sparkSession
    to_workers(spark)
    total = index.where("block < 0").agg(F.sum("n_docs").alias("n"), F.sum("words").alias("w")).first()
    rows = items.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // ITEM_CHARS))
    empty = spark.createDataFrame([], f"{item_col} long, rank int, {id_col} long, score long")
    results = []
    for p in range(parts if total.n and chars else 0):
        mine = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p)
        block = sorted(((r.item, r.text) for r in mine.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if not block:
            continue
        heaps = _search_block(index, block, p << 32, total.n, total.w, k)
        place = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        best = heaps.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        results.append(cut_lineage(best.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")))
    for r in results:
        empty = empty.union(r)
    return results[0] if len(results) == 1 else empty


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = 10) -> DataFrame:
    """Index ``docs``, search every row of ``items``: ``(<item_col>, rank, <id_col>, score)``.

    Terms are maximal runs of letters and digits outside ASCII punctuation, A-Z
    lower-cased, compared by 64-bit hashes; all scores are 64-bit integers.

    Defined cases: null or empty texts have no terms, so such documents are
    neither counted nor found and such items give no rows; repeated documents
    are listed one by one; a document without an id is listed with a null id; an
    empty table gives an empty result; other columns are never read. A long text
    is one document of one shard.
    """
    spark = docs.sparkSession
    with scratch(spark, "search") as folder:
        build_index(docs, id_col, text_col).write.parquet(folder)
        return search(spark.read.parquet(folder), items, item_col, item_text, k, id_col)
