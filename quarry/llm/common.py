"""Shared helpers of the operators: table access, bounded joins, vectorised word hashing.

Words are hashed for a whole Arrow batch at once with numpy (prefix sums of a
polynomial in the bytes), so no Python object is made per word. Texts longer
than ``PIECE_BYTES`` are hashed piece by piece at word boundaries, which keeps
memory bounded for any text length.
"""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import cut_lineage, ship_package

PIECE_BYTES = 1 << 18
#: Rows of an Arrow batch: texts and sets are long, and JVM and worker each hold a batch.
BATCH_ROWS = 256
BROADCAST_IDS = 2_000_000          # ids are broadcast only up to this checked count

U64 = np.uint64
_R = U64(0x9E3779B97F4A7C15)       # odd, so it has an inverse modulo 2^64


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


_POW = np.cumprod(np.concatenate([[U64(1)], np.full(2 * PIECE_BYTES, _R, U64)]))
_INV = np.cumprod(np.concatenate([[U64(1)], np.full(2 * PIECE_BYTES, U64(_inverse(int(_R))), U64)]))

#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (lower-cased text).
NON_WORD = np.zeros(256, bool)
NON_WORD[0x00:0x30] = NON_WORD[0x3A:0x61] = NON_WORD[0x7B:0x80] = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def to_workers(spark: SparkSession) -> None:
    """Executors import this package from the archive that Spark ships; batches get small unless the session sets a size."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) == 10_000:            # Spark's default
        spark.conf.set(rows, BATCH_ROWS)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints of tables that nothing refers to any more.

    Spark does so when the driver's JVM collects garbage; a job of many rounds
    would otherwise keep the files of all its rounds until that happens.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def saver(spark: SparkSession, folder: str) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a table into ``folder`` (a ``scratch`` folder) and reads it back.

    For tables that loops derive from one another: a checkpoint keeps the size
    estimate of the plan it came from, and those of joins multiply from round to
    round, while a written table has the size of its files.
    """
    def save(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return save


def rows_with_ids(df: DataFrame, col: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``col`` is (``left_semi``) or is not (``left_anti``) in ``ids``.

    ``ids`` has one column named ``col``. It is counted first and broadcast only
    up to ``BROADCAST_IDS`` rows; beyond that Spark picks a shuffled join.
    """
    ids = cut_lineage(ids.distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, col, how)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _hash_piece(buf: bytes, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``buf`` and their start offsets; ``buf`` ends with a separator."""
    a = np.frombuffer(buf, np.uint8)
    edge = np.flatnonzero(np.diff(sep[a].view(np.int8), prepend=np.int8(1)))
    start, end = edge[0::2], edge[1::2]                # a word begins where the mask falls, ends where it rises
    with np.errstate(over="ignore"):
        p = np.empty(len(a) + 1, U64)
        p[0] = 0
        np.cumsum((a.astype(U64) + U64(1)) * _POW[:len(a)], out=p[1:])
        h = (p[end] - p[start]) * _INV[start]
        return mix64(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93)), start


def _pieces(data: bytes, sep: np.ndarray) -> Iterator[bytes]:
    """Slices of one long text, cut where a separator stands (a longer word is one slice)."""
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        while end < len(data) and not sep[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(texts: Iterable, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) and the offsets of each text's words.

    Null texts count as empty. Words longer than ``PIECE_BYTES`` are hashed by
    their digest instead of the polynomial.
    """
    import hashlib
    out: list[np.ndarray] = []
    counts: list[int] = []
    small: list[bytes] = []
    size = 0

    def flush():
        nonlocal size
        if not small:
            return
        h, start = _hash_piece(b" ".join(small) + b" ", sep)
        ends = np.cumsum([len(s) + 1 for s in small])
        counts.extend(np.diff(np.searchsorted(start, ends), prepend=0).tolist())
        out.append(h)
        small.clear()
        size = 0

    for t in texts:
        data = t.encode("utf-8", "replace").lower() if isinstance(t, str) else b""
        if len(data) >= PIECE_BYTES:
            flush()
            n = 0
            for piece in _pieces(data, sep):
                if len(piece) >= 2 * PIECE_BYTES - 1:     # one enormous word (perhaps after a separator)
                    mask = sep[np.frombuffer(piece, np.uint8)]
                    words = [w for w in piece.translate(bytes(32 if m else i for i, m in enumerate(sep))).split(b" ") if w] \
                        if mask.any() else [piece]
                    h = np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
                                  if len(w) >= PIECE_BYTES else int(_hash_piece(w + b" ", sep)[0][0]) for w in words], U64)
                else:
                    h, _ = _hash_piece(piece + b" ", sep)
                out.append(h)
                n += len(h)
            counts.append(n)
            continue
        if size + len(data) > PIECE_BYTES:
            flush()
        small.append(data)
        size += len(data) + 1
    flush()
    off = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) if counts else np.zeros(1, np.int64)
    return (np.concatenate(out) if out else np.zeros(0, U64)), off.astype(np.int64)


def shingle_hashes(words: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text the hashes of its k-word shingles in order; fewer words make one shingle, none make none."""
    with np.errstate(over="ignore"):
        n = len(words) - k + 1
        roll = np.zeros(max(n, 0), U64)
        m = U64(1)
        for j in range(k if n > 0 else 0):
            m = U64((int(m) * 0xC2B2AE3D27D4EB4F) % (1 << 64))
            roll += words[j:j + n] * m
        roll = mix64(roll + U64(k))
        res = []
        for s, e in zip(off[:-1], off[1:]):
            if e - s >= k:
                res.append(roll[s:e - k + 1])
            elif e > s:
                h = U64(0x51_7C_C1_B7_27_22_0A_95) + U64(e - s)
                for w in words[s:e]:
                    h = mix64((h + w) * U64(0xC2B2AE3D27D4EB4F))
                res.append(np.array([h], U64))
            else:
                res.append(np.zeros(0, U64))
        return res


def slices(pdf: pd.DataFrame, text: str, limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Runs of rows of about ``limit`` characters of text (at least one row each)."""
    n = pdf[text].str.len().fillna(0).to_numpy()
    if not len(n):
        return
    group = (np.cumsum(n) // limit).astype(np.int64)
    cut = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cut], [*cut, len(pdf)]):
        yield pdf.iloc[a:b]


def sorted_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal ``keys`` from batches that arrive sorted by them; one group is held at a time."""
    held: list[pd.DataFrame] = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[keys]
        change = (k != k.shift()).any(axis=1).to_numpy()
        cut = np.flatnonzero(change)
        bounds = [0, *[c for c in cut if c], len(pdf)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = pdf.iloc[a:b]
            key = tuple(part[keys].iloc[0])
            if held and key != last:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def map_groups(df: DataFrame, keys: list[str], order: list, fn: Callable, schema: str) -> DataFrame:
    """``fn(group) -> frame or None`` for every group, streamed from partitions sorted by the keys.

    Unlike ``applyInPandas`` the cost per group is a slice, so many small groups
    are cheap. The caller bounds the size of a group.
    """
    def run(batches):
        for g in sorted_groups(batches, keys):
            res = fn(g)
            if res is not None and len(res):
                yield res

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
