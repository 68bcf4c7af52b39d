"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the ``K`` smallest of the distinct hashes (48 bits) of
its word shingles. Sketches of parts merge by taking the ``K`` smallest of their
union. From two sketches follow resemblance (share of the ``K`` smallest of the
union that are in both), containment and the number of distinct shingles.

A sketch is carried as one string: twelve hexadecimal digits a value, ascending.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, U64, shingle_hashes, slices, to_workers, word_hashes

K = 256
WORDS = 5
HASH_BITS = 48
ROWS_PER_RUN = 4_000
#: Most runs that a table is cut into; beyond it runs get longer (they are streamed, not held).
MAX_RUNS = 65_536


def sketches(texts, k: int = K, words: int = WORDS) -> list[np.ndarray]:
    """Ascending bottom-k hashes of each text; a null or blank text has none."""
    w, off = word_hashes(texts, SPACE)
    out = []
    for sh in shingle_hashes(w, off, words):
        h = sh >> U64(64 - HASH_BITS)
        if len(h) > 8 * k:                               # the k smallest distinct are among the smallest with repeats
            low = h[h <= np.partition(h, 4 * k)[4 * k]]
            u = np.unique(low)
            out.append(u[:k] if len(u) >= k else np.unique(h)[:k])
        else:
            out.append(np.unique(h)[:k])
    return out


def encode(sketch: np.ndarray) -> str:
    return np.ascontiguousarray(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes().hex()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex("".join("0000" + text[i:i + 12] for i in range(0, len(text), 12))), ">u8")
    return raw.astype(U64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0 ** HASH_BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both; two sketches without shingles are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return len(np.intersect1d(np.intersect1d(a, b, True), both, True)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """``(<id_col>, fingerprint, distinct_shingles)`` for every row; null and blank texts have the empty fingerprint."""
    to_workers(docs.sparkSession)

    def run(batches):
        for big in batches:
            for pdf in slices(big, "text"):
                sk = sketches(pdf["text"], k, words)
                yield pd.DataFrame({"id": pdf["id"], "fingerprint": [encode(s) for s in sk], "distinct_shingles": [distinct(s, k) for s in sk]})

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInPandas(run, "id long, fingerprint string, distinct_shingles double").withColumnRenamed("id", id_col)


def merge_by(prints: DataFrame, key: str, k: int = K, column: str = "fingerprint") -> DataFrame:
    """One merged fingerprint per ``key`` from the fingerprints of its parts.

    The k smallest distinct values are found by rank, which Spark cuts to k rows
    per key before and after the shuffle, so a key with very many parts is not
    gathered in one task.
    """
    v = prints.select(key, F.explode(F.expr(f"transform(sequence(1, greatest(1, length({column}) div 12)), i -> substring({column}, (i - 1) * 12 + 1, 12))")).alias("v"))
    low = v.distinct().withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.col("v") == "", "v"))).where(f"r <= {k}")
    return low.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("v")), "").alias(column))


# -- a text against its edited form and against its neighbour ---------------------------

def _neighbour_rows(k: int, words: int):
    """Rows of one run in descending order of the id; the last row of a run only serves the one before it."""
    import hashlib

    def run(batches):
        for g in pieces(batches):
            ids, texts = g["id"].tolist(), [t if isinstance(t, str) else "" for t in g["text"]]
            own = sketches(texts, k, words)
            halves = [len(t) // 2 for t in texts[:-1]]
            edited = [t[:len(t) - h] + nxt[:h] for t, h, nxt in zip(texts[:-1], halves, texts[1:])]
            es = sketches(edited, k, words)
            keep = ~g["guard"].to_numpy(bool)[:-1]
            out = pd.DataFrame({
                "id": ids[:-1], "n_chars": [len(t) for t in texts[:-1]],
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [encode(s) for s in own[:-1]], "edited_fingerprint": [encode(s) for s in es],
                "near_edited": [resemblance(a, b, k) for a, b in zip(own[:-1], es)],
                "near_next": [resemblance(a, b, k) for a, b in zip(own[:-1], own[1:])],
                "distinct_shingles": [distinct(s, k) for s in own[:-1]]}, columns=[
                    "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "distinct_shingles"])
            yield out[keep]

    def pieces(batches):
        """Pieces of a run of bounded text; consecutive pieces share the row between them."""
        last = None
        for big in batches:
            for pdf in slices(big, "text"):
                for _, g in pdf.groupby("run", sort=False):
                    if last is not None and last["run"].iat[0] == g["run"].iat[0]:
                        g = pd.concat([last, g])
                    last = g.iloc[-1:]
                    if len(g) > 1:
                        yield g
    return run


def _run_of(order, tops: list[int]):
    """Index of the last of the descending ``tops`` that is not below ``order``: by every step-th top, then within the step."""
    step = max(1, math.isqrt(len(tops)))
    coarse = F.array(*[F.lit(t) for t in tops[::step]])
    at = (F.size(F.filter(coarse, lambda t: t >= order)) - 1) * step
    fine = F.slice(F.array(*[F.lit(t) for t in tops]), at + 1, step)
    return at + F.size(F.filter(fine, lambda t: t >= order)) - 1


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    The next document is the one that follows in descending order of the id
    (after the last: the first). The edited text has its last ``floor(n / 2)``
    code points replaced by the first as many of the next document's.

    Documents are cut into runs of consecutive ids (the bounds come from Spark's
    range partitioner, a row per run); every run also gets a copy of the row
    that follows it, so each text is shuffled once and no order over the whole
    table is needed.

    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, distinct_shingles). Defined cases: a null text
    counts as empty; an empty text has the empty fingerprint, alike (1.0) only
    to an empty one; rows that repeat an id follow each other in the order of
    their texts; rows without an id come last; a single row is its own next
    document; other columns are never read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    to_workers(spark)
    low = F.lit(-(1 << 63))                              # stands for a missing id: last in descending order
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), low).alias("o"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.count()
    runs = min(MAX_RUNS, max(1, total // ROWS_PER_RUN))
    part = rows.select("o").repartitionByRange(runs, F.desc("o")).groupBy(F.spark_partition_id()).agg(F.max("o").alias("top"))
    tops = sorted((r.top for r in part.collect()), reverse=True)         # first id of each run, one number a run
    schema = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, distinct_shingles double")
    if not tops:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    # equal ids share a run, so a run starts where the id first reaches a top
    rows = rows.withColumn("run", _run_of(F.col("o"), tops))
    # the first row of a run (smallest text of its largest id) guards the run before; the very first guards the last
    head = rows.where(F.col("o").isin(*tops)).groupBy("run", "o").agg(F.min("text").alias("text"))
    guard = (head.withColumn("run", F.when(F.col("run") == 0, len(tops) - 1).otherwise(F.col("run") - 1))
             .select("o", F.lit(None).cast("long").alias("id"), "text", "run", F.lit(True).alias("guard")))
    dealt = rows.withColumn("guard", F.lit(False)).unionByName(guard).repartition("run").sortWithinPartitions("run", "guard", F.desc("o"), "text")
    out = dealt.select("id", "text", "run", "guard").mapInPandas(_neighbour_rows(k, words), schema)
    return out.withColumnRenamed("id", id_col)
