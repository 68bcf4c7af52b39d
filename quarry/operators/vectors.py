"""Group-wise low-bit quantization of an embeddings table (V1) and sweeps over it.

Plain round-to-nearest per group of ``group_size`` consecutive elements:

* symmetric: ``scale = max|x| / (2^(bits-1) - 1)``, ``q = clamp(round(x / scale), -2^(bits-1), 2^(bits-1) - 1)``
* asymmetric: ``scale = (max - min) / (2^bits - 1)``, ``zero = round(-min / scale)``,
  ``q = clamp(round(x / scale) + zero, 0, 2^bits - 1)``

Everything is a higher-order array expression on the row (``transform``,
``slice``, ``array_max``, ``zip_with``, ``aggregate``): no UDF, no shuffle.
The report explodes the (small, literal) list of settings onto each vector,
so the table is scanned once for all settings, and aggregates per setting with
partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Supported bit widths and the float width being compressed.
BIT_CHOICES = (3, 4, 8)
FLOAT_BITS = 32


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def quantize_expr(v: Column, bits, group_size, sym) -> Column:
    """Struct ``(codes, scales, zeros)`` of a double array ``v``.

    ``bits``, ``group_size`` and ``sym`` may be literals or columns, so one
    scan can evaluate many settings (see ``quant_report``).
    """
    b, gs, sy = _c(bits), _c(group_size), _c(sym)
    qmax_sym = F.pow(F.lit(2.0), b - 1) - 1
    levels = F.pow(F.lit(2.0), b) - 1
    n_groups = F.ceil(F.size(v) / gs).cast("int")
    idx = F.sequence(F.lit(0), n_groups - 1)

    def part(g):
        return F.slice(v, g * gs + 1, gs)

    def bounds(g):                     # asymmetric: 0 always lies in the range, so a constant group keeps its value
        p = part(g)
        return F.least(F.array_min(p), F.lit(0.0)), F.greatest(F.array_max(p), F.lit(0.0))

    def scale(g):
        low, high = bounds(g)
        return F.when(sy, F.array_max(F.transform(part(g), lambda x: F.abs(x))) / qmax_sym).otherwise((high - low) / levels)

    def zero(g):
        low, high = bounds(g)
        return F.when(sy | (high == low), F.lit(0.0)).otherwise(F.round(-low / ((high - low) / levels)))

    lo = F.when(sy, -F.pow(F.lit(2.0), b - 1)).otherwise(F.lit(0.0))
    hi = F.when(sy, qmax_sym).otherwise(levels)
    st = F.struct(F.transform(idx, scale).alias("scales"), F.transform(idx, zero).alias("zeros"))

    def grp(i):
        return F.floor(i / gs).cast("int")

    def code(x, i, sc, zr):
        s_, z_ = sc[grp(i)], zr[grp(i)]
        raw = F.when(s_ == 0, z_).otherwise(F.round(x / s_) + z_)
        return F.least(F.greatest(raw, lo), hi).cast("int")

    # name the intermediate once: scales/zeros are computed a single time per row
    return F.transform(F.array(st), lambda t: F.struct(
        F.transform(v, lambda x, i: code(x, i, t["scales"], t["zeros"])).alias("codes"),
        t["scales"].alias("scales"), t["zeros"].alias("zeros")))[0]


def quantize(df: DataFrame, vec_col: str = "embedding", bits: int = 4, group_size: int = 128,
             sym: bool = True) -> DataFrame:
    """V1: adds ``codes array<int>``, ``scales``, ``zeros`` and ``dequant`` (``array<double>``)."""
    if bits not in BIT_CHOICES:
        raise ValueError(f"bits must be one of {BIT_CHOICES}")
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    q = df.withColumn("_q", quantize_expr(v, bits, group_size, sym))
    out = q.select("*", "_q.codes", "_q.scales", "_q.zeros").drop("_q")
    return out.withColumn("dequant", dequantize(group_size))


def dequantize(group_size, codes: str = "codes", scales: str = "scales", zeros: str = "zeros") -> Column:
    """V1 inverse: ``(code - zero) * scale`` per element."""
    gs = _c(group_size)
    return F.transform(codes, lambda c, i: (c - F.col(zeros)[F.floor(i / gs).cast("int")])
                       * F.col(scales)[F.floor(i / gs).cast("int")])


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def error_columns(df: DataFrame, vec_col: str = "embedding", deq_col: str = "dequant") -> DataFrame:
    """Per vector: MSE, cosine similarity, max absolute error."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    d = F.col(deq_col)
    diff = F.zip_with(v, d, lambda a, b: a - b)
    mse = F.try_divide(_sum(F.transform(diff, lambda e: e * e)), F.size(v))
    dot = _sum(F.zip_with(v, d, lambda a, b: a * b))
    nv = F.sqrt(_sum(F.transform(v, lambda a: a * a)))
    nd = F.sqrt(_sum(F.transform(d, lambda a: a * a)))
    cos = F.try_divide(dot, nv * nd)
    return (df.withColumn("mse", mse).withColumn("cosine", cos)
              .withColumn("max_error", F.array_max(F.transform(diff, lambda e: F.abs(e)))))


def compression_ratio(dim, bits, group_size, sym) -> Column:
    """Original float bits over packed bits: codes plus one 32-bit scale (and a zero point
    of ``bits`` bits when asymmetric) per group."""
    d, b, gs, sy = _c(dim), _c(bits), _c(group_size), _c(sym)
    groups = F.ceil(d / gs)
    packed = d * b + groups * (F.lit(FLOAT_BITS) + F.when(sy, F.lit(0)).otherwise(b))
    return d * FLOAT_BITS / packed


def quant_report(df: DataFrame, settings: Sequence[tuple[int, int, bool]], vec_col: str = "embedding") -> DataFrame:
    """V1 report: per (bits, group_size, sym) the mean MSE, mean cosine, max error and compression ratio.

    The settings list is exploded onto every row, so the table is read once for
    all settings; the aggregate is partial per setting (one row per setting
    per partition before the shuffle).
    """
    for bits, _gs, _sym in settings:
        if bits not in BIT_CHOICES:
            raise ValueError(f"bits must be one of {BIT_CHOICES}")
    st = F.array(*[F.struct(F.lit(b).alias("bits"), F.lit(g).alias("group_size"), F.lit(y).alias("sym"))
                   for b, g, y in settings])
    x = df.select(vec_col, F.explode(st).alias("_s")).select(vec_col, "_s.*")
    v = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    q = x.withColumn("_q", quantize_expr(v, F.col("bits"), F.col("group_size"), F.col("sym")))
    q = q.select(vec_col, "bits", "group_size", "sym", "_q.codes", "_q.scales", "_q.zeros")
    q = error_columns(q.withColumn("dequant", dequantize(F.col("group_size"))), vec_col)
    return q.groupBy("bits", "group_size", "sym").agg(
        F.avg("mse").alias("mean_mse"), F.avg("cosine").alias("mean_cosine"), F.max("max_error").alias("max_error"),
        F.avg(compression_ratio(F.size(vec_col), F.col("bits"), F.col("group_size"), F.col("sym")))
        .alias("compression_ratio"))
