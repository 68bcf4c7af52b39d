"""Benchmark decontamination by SimHash windows of item size.

For every benchmark item of n words, windows of n words are slid over each
document. Windows and items are fingerprinted by a 64-bit SimHash of their
5-word shingles, the second occurrence of a shingle hashed apart from the first,
so that the fingerprints estimate the very similarity that is verified.
Fingerprints are cut into ``PARTS`` blocks of 8 bits; if two differ in at most
``RADIUS`` bits, some block differs in at most ``RADIUS // PARTS`` bits, so looking
up every block value within that distance finds all items within the radius.
Candidates are verified by the exact weighted (multiset) Jaccard similarity of
the shingles.

A window that reaches the similarity shares many shingles with its item, so only
windows that hold as many shingles of the items of their size are fingerprinted:
a fixed-size bitmap and a sorted lookup find the shared shingles while the document
is read, and sums over their places count them for all windows at once. Windows
are taken in pieces that bound the memory. ``RADIUS`` lies more than 4.5 standard
deviations above the distance expected at similarity 0.8.

The benchmark is read in blocks of at most about ``ITEMS_PER_BLOCK`` items; each
block's index is broadcast and the documents are streamed past it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import NON_WORD, U64, mix64, rows_with_ids, shingle_hashes, slices, to_workers, word_hashes
from quarry.session import cut_lineage

WORDS = 5
PERCENT = 80
PARTS, RADIUS = 8, 23
ITEMS_PER_BLOCK = 10_000
MAP_BITS = 22
PIECE_WINDOWS = 4096                # windows fingerprinted at once, fewer where they meet many items
PIECE_PAIRS = 1 << 22               # bound on windows times items of their size held at once

_NEAR = np.array([[bin(a ^ b).count("1") <= RADIUS // PARTS for b in range(256)] for a in range(256)])
_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int8) * 2 - 1      # +1 / -1 a bit


def _bits(shingles: np.ndarray, number: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each shingle's hash, by which occurrence of the shingle it is."""
    with np.errstate(over="ignore"):
        h = mix64(mix64(shingles ^ U64(0xA5A5A5A5_5A5A5A5A)) + number.astype(U64) * U64(0x9E3779B97F4A7C15))
    return _BYTE[h.view(np.uint8).reshape(-1, 8)].reshape(-1, 64)


def window_simhash(shingles: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` shingles that start at ``first`` to ``last``; one row of 8 bytes each.

    A window's sum over its (shingle, occurrence) pairs follows from that of the
    window before: the highest occurrence of the shingle that leaves goes, the
    next one of the shingle that enters comes.
    """
    part = shingles[first:last + size]
    place = np.arange(len(part))
    _, kind = np.unique(part, return_inverse=True)
    known = np.sort(kind * (len(part) + 1) + place)

    def count(at: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Occurrences of the shingle at ``at[0]`` from place ``low`` to ``at[1]``."""
        base = kind[at[0]] * (len(part) + 1)
        return np.searchsorted(known, base + at[1], "right") - np.searchsorted(known, base + low, "left")

    total = np.zeros(64, np.int64)
    for a in range(0, size, 1 << 16):
        p = place[a:min(size, a + (1 << 16))]
        total += _bits(part[p], count(np.stack([p, p]), np.zeros_like(p))).sum(axis=0, dtype=np.int64)
    sums = np.empty((last - first + 1, 64), np.int32)
    sums[0] = total
    if last > first:
        gone = place[:last - first]
        come = gone + size
        sums[1:] = (_bits(part[come], count(np.stack([come, come]), gone + 1)).astype(np.int32)
                    - _bits(part[gone], count(np.stack([gone, come - 1]), gone)))
    return np.packbits(np.cumsum(sums, axis=0) > 0, axis=1)


def simhash(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint of one shingle sequence as 8 bytes."""
    return window_simhash(shingles, 0, 0, len(shingles))[0]


def shared_counts(shingles: np.ndarray, place: np.ndarray, kinds: np.ndarray, most: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """Sum of the smaller counts of every shingle in a window and in an item, for windows that start at ``first`` to ``last``.

    ``kinds`` (sorted) and ``most`` are the item's shingles and counts, ``place``
    the places where the windows may hold one. A place counts unless its window
    holds the shingle before it as often as the item does.
    """
    place = place[(place >= first) & (place < last + size)]
    at = np.minimum(np.searchsorted(kinds, shingles[place]), len(kinds) - 1)
    mine = kinds[at] == shingles[place]
    at, place = at[mine], place[mine]
    order = np.lexsort((place, at))
    at, place = at[order], place[order]
    back = np.arange(len(at)) - most[at]                           # the occurrence that makes this one superfluous
    before = np.where((back >= 0) & (at[np.maximum(back, 0)] == at), place[np.maximum(back, 0)], -1)
    low, high = np.maximum(np.maximum(before, place - size) + 1, first), np.minimum(place, last)
    real = low <= high
    change = np.bincount(low[real] - first, minlength=last - first + 2) - np.bincount(high[real] + 1 - first, minlength=last - first + 2)
    return np.cumsum(change)[:last - first + 1]


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` < 5 words, as ``shingle_hashes`` hashes a text of k words."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        h = np.full(n, U64(0x51_7C_C1_B7_27_22_0A_95) + U64(k))
        for j in range(k):
            h = mix64((h + words[j:n + j]) * U64(0xC2B2AE3D27D4EB4F))
    return h


class ItemIndex:
    """Multi-index over the fingerprints of items, by window size; items without words are left out."""

    def __init__(self, ids: list[int], texts: list):
        words, off = word_hashes(texts, NON_WORD)
        sh = shingle_hashes(words, off, WORDS)
        long_ = [(i, s) for i, s, n in zip(ids, sh, np.diff(off)) if n >= WORDS]
        self.size = sorted({len(s) for _, s in long_})
        #: size -> (item, (its shingles in order, their counts))
        self.items = {m: [] for m in self.size}
        self.prints = {m: [] for m in self.size}
        for i, s in long_:
            self.items[len(s)].append((i, np.unique(s, return_counts=True)))
            self.prints[len(s)].append(simhash(s))
        self.prints = {m: np.array(p) for m, p in self.prints.items()}
        #: [size][part, byte] -> items whose byte of that part is near
        self.near = {m: np.stack([_NEAR[:, p[:, j]] for j in range(PARTS)]) for m, p in self.prints.items()}
        #: size -> shingles of its items in order, and how often one item holds each at most
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m, v in self.items.items():
            held = [counted for _, counted in v]
            kinds, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            most = np.zeros(len(kinds), np.int64)
            np.maximum.at(most, at, np.concatenate([c for _, c in held]))
            self.shingles[m] = kinds, most
        flat = np.concatenate([k for k, _ in self.shingles.values()]) if long_ else np.zeros(0, U64)
        size_of = np.repeat(np.array(list(self.shingles), np.int64), [len(k) for k, _ in self.shingles.values()])
        order = np.lexsort((size_of, flat))
        self.shared, self.shared_size = flat[order], size_of[order]
        self.map = np.zeros(1 << MAP_BITS, bool)
        self.map[(flat >> U64(64 - MAP_BITS)).astype(np.int64)] = True
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, s, n in zip(ids, sh, np.diff(off)):
            if 0 < n < WORDS:
                self.short.setdefault(int(n), {}).setdefault(int(s[0]), []).append(i)

    def matches(self, words: np.ndarray, shingles: np.ndarray, percent: int) -> list[tuple]:
        """(item, similarity, first word, words, differing bits) of every item that some window reaches."""
        best: dict[int, tuple] = {}
        for k, known in self.short.items():
            g = _grams(words, k)
            at = np.flatnonzero(np.isin(g, np.fromiter(known, U64, len(known))))
            for p in at[::-1]:
                for i in known[int(g[p])]:
                    best[i] = (i, 1.0, int(p), k, 0)
        if len(words) >= WORDS and len(self.shared):
            hit = np.flatnonzero(self.map[(shingles >> U64(64 - MAP_BITS)).astype(np.int64)])
            kinds = np.unique(shingles[hit])
            ranges = zip(np.searchsorted(self.shared, kinds, "left"), np.searchsorted(self.shared, kinds, "right"))
            sizes = [self.shared_size[a:b] for a, b in ranges if b > a]
            for m in np.unique(np.concatenate(sizes)) if sizes else ():
                self._windows(int(m), hit, shingles, percent, best)
        return list(best.values())

    def _windows(self, m: int, hit: np.ndarray, shingles: np.ndarray, percent: int, best: dict) -> None:
        """Finds the items of size ``m``; ``hit`` are the places that may hold a shingle of some item."""
        w = min(m, len(shingles))
        need = -(-percent * (w + m) // (100 + percent))             # shared shingles that the similarity asks for
        kinds, most = self.shingles[m]
        place = hit[np.isin(shingles[hit], kinds)]
        if len(place) < need:
            return
        first, last = max(0, int(place[0]) - w + 1), min(len(shingles) - w, int(place[-1]))
        starts = first + np.flatnonzero(shared_counts(shingles, place, kinds, most, first, last, w) >= need)     # of any items of the size
        prints, items = self.prints[m], self.items[m]
        span = max(1, min(PIECE_WINDOWS, PIECE_PAIRS // len(items)))
        while len(starts):
            end = int(np.searchsorted(starts, starts[0] + span))
            gap = np.flatnonzero(np.diff(starts[:end]) > w)
            piece, starts = np.split(starts, [int(gap[0]) + 1 if len(gap) else end])
            first, last = int(piece[0]), int(piece[-1])
            mine = window_simhash(shingles, first, last, w)[piece - first]
            near = np.zeros((len(piece), len(items)), bool)
            for j in range(PARTS):
                near |= self.near[m][j][mine[:, j]]
            window, other = np.nonzero(near)
            bits = np.bitwise_count(mine[window] ^ prints[other]).sum(axis=1)
            close = bits <= RADIUS
            window, other, bits = window[close], other[close], bits[close]
            order = np.argsort(other, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(other[order])) + 1) if len(order) else ():
                item, counted = items[other[run[0]]]
                both = shared_counts(shingles, place, *counted, first, last, w)[piece[window[run]] - first]
                k = int(np.argmax(both))                            # the first of the best
                likeness = int(both[k]) / (w + m - int(both[k]))
                if both[k] >= need and (item not in best or likeness > best[item][1]):
                    best[item] = (item, likeness, int(piece[window[run[k]]]), w + WORDS - 1, int(bits[run[k]]))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``(<id_col>, <item_col>, similarity, start_word, n_words, bits)``: one row per document row and item found in it.

    Words are runs of a-z (A-Z lower-cased), 0-9 and non-ASCII characters.
    similarity is the best window's (the first of equals). Defined cases: null or
    wordless texts and items match nothing; an item of fewer than five words
    matches its exact words only; a document shorter than an item is one window;
    items without an id are left out, documents without an id are reported with
    a null id; repeated document rows are reported each, repeated item rows
    once; empty tables give an empty result; other columns are never read.
    """
    spark = docs.sparkSession
    to_workers(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    items = cut_lineage(items)
    blocks = -(-items.count() // ITEMS_PER_BLOCK)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, item long, similarity double, start_word long, n_words long, bits int"
    parts = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        shared = spark.sparkContext.broadcast(ItemIndex([r.i for r in rows], [r.t for r in rows]))

        def run(batches, shared=shared):
            index = shared.value
            for big in batches:
                for pdf in slices(big, "text"):
                    words, off = word_hashes(pdf["text"], NON_WORD)
                    out = []
                    for i, sh, s, e in zip(pdf["id"], shingle_hashes(words, off, WORDS), off[:-1], off[1:]):
                        out += [(i, *m) for m in index.matches(words[s:e], sh, percent)]
                    if out:
                        yield pd.DataFrame(out, columns=["id", "item", "similarity", "start_word", "n_words", "bits"])

        parts.append(base.mapInPandas(run, schema))
    found = spark.createDataFrame([], schema)
    for p in parts:
        found = found.unionByName(p) if len(parts) > 1 else p
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, all columns unchanged; rows without an id stay."""
    bad = contaminated(docs, benchmark, id_col, text_col).where(F.col(id_col).isNotNull()).select(id_col)
    return rows_with_ids(docs, id_col, bad, "left_anti")
