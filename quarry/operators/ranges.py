"""Running sums and exact percentiles over an order that spans the whole table.

An un-partitioned window would pull every row into one task. Instead rows are
dealt to ranges of the order with Spark's range partitioner (it samples a bounded
number of keys per task), written to the checkpoint folder so that the ranges
stay fixed, and summed per range; offsets are a running sum over one row per
range, and the rest is a window within a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def running_before(df: DataFrame, order: str, weight: str, part: Sequence[str] = (), name: str = "before") -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` over the rows of the same ``part`` that come earlier in ``order``.

    ``order`` must be unique within a part.
    """
    part = list(part)
    ranged = cut_lineage(df.repartitionByRange(*part, order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*part, "_range").agg(F.sum(weight).alias("_sum"), F.min(order).alias("_first"))
    earlier = Window.partitionBy(*part).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_off", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    sums = sums.select(*[F.col(c).alias(f"_part{i}") for i, c in enumerate(part)], F.col("_range").alias("_at"), "_off")
    on = F.col("_range") == F.col("_at")
    for i, c in enumerate(part):
        on = on & F.col(c).eqNullSafe(F.col(f"_part{i}"))
    inner = Window.partitionBy(*part, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_off") + F.coalesce(F.sum(weight).over(inner), F.lit(0))
    return ranged.join(sums, on).select(*df.columns, before.alias(name))


def exact_percentiles(df: DataFrame, value: str, levels: Sequence[float], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``(*by, n, max, p: array)``: linearly interpolated percentiles of ``value``, nulls left out.

    Values are counted first (``weight`` gives counts that are there already), a
    running sum gives each value's ranks, and a grouped aggregate picks the two
    values next to each level, so no task holds the values of a group.
    """
    by = list(by)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(count.alias("_c"))
    ranks = running_before(counts, "_v", "_c", by, "_lo")
    if by:
        totals = ranks.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]).agg(F.sum("_c").alias("n"), F.max("_v").alias("max"))
        on = F.lit(True)
        for i, c in enumerate(by):
            on = on & F.col(c).eqNullSafe(F.col(f"_by{i}"))
        rows = ranks.join(totals, on)
    else:
        rows = ranks.withColumns({"n": ranks.select(F.sum("_c")).scalar(), "max": ranks.select(F.max("_v")).scalar()})

    def at(index):
        return F.max(F.when((F.col("_lo") <= index) & (index < F.col("_lo") + F.col("_c")), F.col("_v")))

    aggs = []
    for i, p in enumerate(levels):
        t = F.lit(float(p)) * (F.col("n") - 1)
        aggs += [at(F.floor(t)).alias(f"_a{i}"), at(F.ceil(t)).alias(f"_b{i}")]
    out = rows.groupBy(*by).agg(F.max("n").alias("n"), F.max("max").alias("max"), *aggs)

    def between(i: int, p: float):
        t = F.lit(float(p)) * (F.col("n") - 1)
        return F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (t - F.floor(t))

    return out.select(*by, "n", "max", F.array(*[between(i, p) for i, p in enumerate(levels)]).alias("p"))
