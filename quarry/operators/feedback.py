"""Quantization with error feedback (V1): rounding that keeps dot products with the table's own vectors.

Round to nearest treats elements alike. What a search over the table needs is
that ``e . y`` is small for the vectors ``y`` of the table, ``e`` being the error
of one vector: its mean square is ``e' G e`` with the Gram matrix ``G = X'X / n``.

With ``H = G + damp * mean(diag G) * I = M' D M`` (``M`` unit lower triangular in
the order of rounding, ``D`` diagonal), ``e' H e = sum_j D_j (e_j + sum_{k<j} M_jk e_k)^2``,
so element j is rounded at ``x_j + sum_{k<j} M_jk e_k``: what the elements before it
lost is made up for as far as it can be.

``G`` is summed in the tasks (one numpy product a batch, one matrix a task) and
then by a grouped sum; only the dimension's square reaches the driver, the table's
rows never do. Rounding works on Arrow batches and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.vectors import BIT_CHOICES
from quarry.session import ship_package

MAX_DIMENSION = 4096                   # the matrix is held by the driver and by each task
DAMP = 0.01                            # fixed value: share of the mean diagonal that is added to it


def _stack(vectors: pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the vectors with ``dim`` finite numbers, those vectors as rows)."""
    ok = np.array([v is not None and len(v) == dim for v in vectors], bool)
    x = np.array([np.asarray(v, np.float64) for v in vectors[ok]], np.float64).reshape(-1, dim)
    finite = np.isfinite(x).all(axis=1)
    ok[np.flatnonzero(ok)[~finite]] = False
    return ok, x[finite]


def gram_matrix(df: DataFrame, vec_col: str = "embedding", dim: int | None = None) -> tuple[np.ndarray, int]:
    """``(X'X / n, n)`` over the vectors of ``dim`` finite numbers (default: the longest vector's length).

    Vectors that are null, of another length or hold a null or a number that is
    not finite are left out. Without any vector the matrix is all zeros.
    """
    ship_package(df.sparkSession)
    if dim is None:
        dim = df.agg(F.max(F.size(vec_col))).first()[0] or 0
        dim = max(dim, 0)
    if dim > MAX_DIMENSION:
        raise ValueError(f"vectors of {dim} elements; at most {MAX_DIMENSION}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((dim, dim)), 0
        for pdf in batches:
            _, x = _stack(pdf["v"], dim)
            total += x.T @ x
            n += len(x)
        if n:
            yield pd.DataFrame({"i": range(dim), "g": list(total), "n": n})

    parts = df.select(F.col(vec_col).cast("array<double>").alias("v")).mapInPandas(run, "i int, g array<double>, n long")
    cells = parts.select("i", "n", F.posexplode("g").alias("k", "x")).groupBy("i", "k").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    rows = cells.toPandas()
    gram, n = np.zeros((dim, dim)), int(rows["n"].max()) if len(rows) else 0
    if n:
        gram[rows["i"], rows["k"]] = rows["x"] / n
    return (gram + gram.T) / 2, n


def feedback_matrix(gram: np.ndarray, damp: float = DAMP, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(order, M)``: the order of rounding and the unit lower triangular factor in that order.

    ``descending`` rounds the elements of the largest squares first; otherwise the
    order is the given one. A matrix of zeros gives no feedback.
    """
    diagonal = np.diag(gram)
    order = np.argsort(-diagonal, kind="stable") if descending else np.arange(len(gram))
    if not len(gram) or diagonal.sum() <= 0:
        return order, np.eye(len(gram))
    h = (gram + damp * diagonal.mean() * np.eye(len(gram)))[np.ix_(order, order)]
    upper = np.linalg.cholesky(h[::-1, ::-1])[::-1, ::-1]          # h = upper upper'
    return order, (upper / np.diag(upper)).T


def _round(x: np.ndarray) -> np.ndarray:
    return np.trunc(x + np.copysign(0.5, x))                       # halves away from zero, as SQL rounds


def round_rows(x: np.ndarray, bits: int, group_size: int, sym: bool, order: np.ndarray,
               m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, zeros, restored) of the rows of ``x``; scales and zeros are those of round to nearest."""
    n, dim = x.shape
    starts = np.arange(0, dim, group_size)
    low, high = (-2.0 ** (bits - 1), 2.0 ** (bits - 1) - 1) if sym else (0.0, 2.0 ** bits - 1)
    if sym:
        scales = np.maximum.reduceat(np.abs(x), starts, axis=1) / high if dim else np.zeros((n, 0))
        zeros = np.zeros_like(scales)
    else:
        least = np.minimum(np.minimum.reduceat(x, starts, axis=1), 0) if dim else np.zeros((n, 0))
        scales = (np.maximum(np.maximum.reduceat(x, starts, axis=1), 0) - least) / high if dim else least
        zeros = np.where(scales > 0, _round(-least / np.where(scales > 0, scales, 1)), 0)
    codes, restored, error = np.zeros((n, dim), np.int32), np.zeros((n, dim)), np.zeros((n, dim))
    for a, j in enumerate(order):
        s, z = scales[:, j // group_size], zeros[:, j // group_size]
        goal = x[:, j] + error[:, :a] @ m[a, :a]                   # errors stand in the order of rounding
        q = np.where(s > 0, _round(goal / np.where(s > 0, s, 1)) + z, z)
        codes[:, j] = np.clip(q, low, high)
        restored[:, j] = (codes[:, j] - z) * s
        error[:, a] = x[:, j] - restored[:, j]
    return codes, scales, zeros, restored


def quantize_feedback(df: DataFrame, vec_col: str = "embedding", bits: int = 4, group_size: int = 128, sym: bool = True,
                      damp: float = DAMP, descending: bool = False, gram: np.ndarray | None = None) -> DataFrame:
    """V1 with feedback: adds ``codes array<int>``, ``scales``, ``zeros`` and ``dequant``, as ``quantize`` does.

    ``gram`` is that of ``gram_matrix`` (computed from ``df`` if not given; give it
    to quantize new vectors by an older table's). Sizes are those of the plain codes.
    Vectors that ``gram_matrix`` leaves out get nulls; an empty table gives an empty result.
    """
    if bits not in BIT_CHOICES:
        raise ValueError(f"bits must be one of {BIT_CHOICES}")
    if group_size < 1:
        raise ValueError("group_size must be at least 1")
    spark = df.sparkSession
    ship_package(spark)
    if gram is None:
        gram, _ = gram_matrix(df, vec_col)
    dim = len(gram)
    shared = spark.sparkContext.broadcast(feedback_matrix(gram, damp, descending))

    @F.pandas_udf("codes array<int>, scales array<double>, zeros array<double>, dequant array<double>")
    def rounded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        order, m = shared.value
        for vectors in batches:
            ok, x = _stack(vectors, dim)
            out = {}
            for c, values in zip(("codes", "scales", "zeros", "dequant"), round_rows(x, bits, group_size, sym, order, m)):
                row = iter(values)
                out[c] = pd.Series([next(row) if k else None for k in ok], dtype=object)
            yield pd.DataFrame(out)

    q = df.withColumn("_q", rounded(F.col(vec_col).cast("array<double>")))
    return q.select("*", "_q.codes", "_q.scales", "_q.zeros", "_q.dequant").drop("_q")


def projected_error(df: DataFrame, gram: np.ndarray, vec_col: str = "embedding", deq_col: str = "dequant") -> DataFrame:
    """Adds ``projected``: the mean square of the error's dot product with the vectors behind ``gram``; null without a vector."""
    spark = df.sparkSession
    ship_package(spark)
    dim = len(gram)
    shared = spark.sparkContext.broadcast(gram)

    @F.pandas_udf("double")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for errors in batches:
            ok, e = _stack(errors, dim)
            out = np.full(len(errors), np.nan)
            out[ok] = ((e @ shared.value) * e).sum(axis=1)
            yield pd.Series(out).where(ok, None)

    error = F.zip_with(F.col(vec_col).cast("array<double>"), F.col(deq_col), lambda a, b: a - b)
    return df.withColumn("projected", project(error))


def feedback_report(df: DataFrame, settings, vec_col: str = "embedding", damp: float = DAMP) -> DataFrame:
    """Per (bits, group_size, sym): ``plain_error`` of round to nearest and ``feedback_error``, both ``projected``, and their means' ratio.

    One Gram matrix for all settings, and one pass over the table per setting; the settings are few by nature.
    """
    from functools import reduce

    from quarry.operators.vectors import quantize
    gram, _ = gram_matrix(df, vec_col)
    v = df.select(vec_col)
    parts = []
    for bits, group_size, sym in settings:
        q = quantize_feedback(v, vec_col, bits, group_size, sym, damp, gram=gram).select(vec_col, "dequant")
        fed = projected_error(q, gram, vec_col).select(vec_col, F.col("projected").alias("fed"))
        plain = projected_error(quantize(fed, vec_col, bits, group_size, sym), gram, vec_col)
        parts.append(plain.agg(F.avg("projected").alias("plain_error"), F.avg("fed").alias("feedback_error")).select(
            F.lit(bits).alias("bits"), F.lit(group_size).alias("group_size"), F.lit(sym).alias("sym"), "plain_error", "feedback_error",
            F.try_divide("feedback_error", "plain_error").alias("ratio")))
    return reduce(DataFrame.unionByName, parts)
