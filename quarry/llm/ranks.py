"""Positions within groups without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window partition holds on average.
ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 32


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def positions(df: DataFrame, part: list[str], uniform: str, ties: list[str], buckets: int, name: str = "pos") -> DataFrame:
    """``df`` with ``name``: 0-based position of each row in its ``part`` by the order of ``uniform`` (a 64-bit hash).

    A part is cut into ``buckets`` ranges of the hash; their sizes are summed
    (one row per part and range) and rows are numbered within a range, so a part
    that holds most rows still spreads over ``buckets`` window partitions. Equal
    hashes are ordered by ``ties``.
    """
    share = (F.col(uniform).cast("double") / F.lit(2.0 ** 64) + 0.5) * buckets      # signed 64-bit to [0, buckets)
    df = df.withColumn("_b", F.least(F.floor(share), F.lit(buckets - 1)).cast("int"))
    # dealt by part and range: a part that comes here as one partition (from a join on it) is spread
    df = df.repartition(*part, "_b")
    sizes = df.groupBy(*part, "_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*part, "_b", F.coalesce(before, F.lit(0)).alias("_before"))
    on: Column = df["_b"] == sizes["_b"]
    for c in part:
        on = on & df[c].eqNullSafe(sizes[c])
    inner = F.row_number().over(Window.partitionBy(*[df[c] for c in part], df["_b"]).orderBy(uniform, *ties)) - 1
    return df.join(sizes, on).select(*[df[c] for c in df.columns if c != "_b"], (F.col("_before") + inner).cast("long").alias(name))
