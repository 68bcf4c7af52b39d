"""Seeded sampling, quotas, shuffles, unions and backfill.

Determinism comes from a hex md5 of ``key|seed`` (see ``seeded_hash``), never
from ``rand()`` or ``df.sample``: the same seed gives the same rows under any
partitioning.

Top-n plans: rows are first ranked per (group, salt), where the salt is the
task's partition number modulo ``SALTS``; Spark cuts each task's rows to the
wanted number before the shuffle. Only the survivors, at most ``SALTS`` times the
quota, are ranked per group. So a group that holds a third of the table is
spread over ``SALTS`` tasks, the input is read once, and any orderable key works.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import min_chars, seeded_hash

# Tasks that share the first ranking of one group.
SALTS = 64

# ---------------------------------------------------------------------------
# Calibration mix presets (samples per source, 512 rows each)
# ---------------------------------------------------------------------------
MIX_PRESETS = {
    "radiology": {"pubmedqa": 307, "pmc_patients": 154, "custom_radiology": 51},
    "general_medical": {"medqa": 256, "pubmedqa": 256},
    "clinical_notes": {"pmc_patients": 307, "asclepius_notes": 205},
    "balanced": {"pubmedqa": 205, "pmc_patients": 154, "medqa": 153},
}
DEFAULT_TOTAL = 512
# ---------------------------------------------------------------------------


def scale_quota(samples: int, total: int, base: int = DEFAULT_TOTAL) -> int:
    """W5 for one source: ``int(samples * total / base)`` when ``total != base``."""
    return samples if total == base else int(samples * (total / base))


def scale_quotas(quotas: Mapping[str, int], total: int, base: int = DEFAULT_TOTAL) -> dict[str, int]:
    """Scale every quota of a preset; truncation may lose rows (by design)."""
    return {k: scale_quota(int(v), total, base) for k, v in quotas.items()}


def _group_literal_df(df: DataFrame, group_col: str, quotas: Mapping) -> DataFrame:
    gtype = df.schema[group_col].dataType
    schema = T.StructType([T.StructField(group_col, gtype, True),
                           T.StructField("_quota", T.LongType(), False)])
    return df.sparkSession.createDataFrame([(g, int(q)) for g, q in quotas.items()], schema)


def top_per_group(df: DataFrame, group_col: str, quotas: Mapping | int, order: Sequence[str],
                  rank_col: str = "rank") -> DataFrame:
    """Exact first ``quotas[g]`` rows of every group ``g`` in ``order``, ranked from 1 in ``rank_col``.

    ``quotas`` is a mapping (groups outside it are dropped) or one number for all
    groups. ``order`` must be unique within a group for a reproducible result.
    """
    if isinstance(quotas, int):
        most, quota, base = quotas, F.lit(quotas), df
    else:
        quotas = {g: int(q) for g, q in quotas.items() if int(q) > 0}
        if not quotas:
            return df.limit(0).withColumn(rank_col, F.lit(1).cast("int"))
        most = max(quotas.values())
        quota = F.element_at(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]), F.col(group_col))
        base = df.filter(F.col(group_col).isin(list(quotas)))       # pushed to the scan
    salted = base.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    first = Window.partitionBy(group_col, "_salt").orderBy(*order)
    kept = salted.withColumn("_r", F.row_number().over(first)).filter((F.col("_r") <= most) & (F.col("_r") <= quota))
    last = Window.partitionBy(group_col).orderBy(*order)
    return (kept.withColumn(rank_col, F.row_number().over(last))
                .filter((F.col(rank_col) <= most) & (F.col(rank_col) <= quota)).drop("_salt", "_r"))


def head_by_order(df: DataFrame, n: int, key: str, tie: str | None = None) -> DataFrame:
    """First ``n`` rows in ``(key, tie)`` order: per salt first, so at most ``SALTS * n`` rows meet."""
    order = [key] + ([tie] if tie else [])
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    w = Window.partitionBy("_salt").orderBy(*order)
    kept = salted.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return kept.drop("_salt", "_r").orderBy(*order).limit(n)


def sample_seeded(df: DataFrame, n: int, seed: int, key: str = "doc_id",
                  rank_col: str = "rank") -> DataFrame:
    """``min(n, size)`` rows without replacement, reproducible per seed."""
    h = df.withColumn("_h", seeded_hash(key, seed))
    return (head_by_order(h, n, "_h", key)
            .withColumn(rank_col, F.row_number().over(Window.orderBy("_h", key))).drop("_h"))   # n rows


def apply_quota(df: DataFrame, source_col: str, quotas: Mapping, seed: int,
                key: str = "doc_id", rank_col: str = "rank") -> DataFrame:
    """J6 + W3: per source, the seeded sample of ``min(quota, size)`` rows."""
    h = df.withColumn("_h", seeded_hash(key, seed))
    return top_per_group(h, source_col, quotas, ["_h", key], rank_col).drop("_h")


def missing_quota_sources(df: DataFrame, source_col: str, quotas: Mapping) -> DataFrame:
    """Quota sources without any row (reported, then skipped)."""
    qdf = _group_literal_df(df, source_col, quotas).select(source_col)
    present = df.select(source_col).filter(F.col(source_col).isin(list(quotas))).distinct()
    return qdf.join(present, source_col, "left_anti")


def shuffle_trim(df: DataFrame, total: int, seed: int, key: str = "doc_id",
                 pos_col: str = "pos", tie: str | None = None) -> DataFrame:
    """Seeded shuffle, then the head ``total`` rows; ``pos_col`` keeps the order.

    ``tie`` breaks ties between copies of one key (a row drawn by two sources).
    """
    h = df.withColumn("_s", seeded_hash(key, seed, "shuffle")).withColumn("_tie", F.struct(key, *([tie] if tie else [])))
    top = head_by_order(h, total, "_s", "_tie")
    return top.withColumn(pos_col, F.row_number().over(Window.orderBy("_s", "_tie"))).drop("_s", "_tie")


def mix_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate sources by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def relabel_source(df: DataFrame, label: str, col: str = "source") -> DataFrame:
    """Overwrite the source label (stand-in source)."""
    return df.withColumn(col, F.lit(label))


def head_n(df: DataFrame, n: int, key: str, tie: str | None = None) -> DataFrame:
    """First ``n`` rows by a key (and tie-break), bounded at any scale (``head_by_order``)."""
    return head_by_order(df, n, key, tie)


def backfill(main: DataFrame, fallback: DataFrame, target: int, key: str = "doc_id",
             text_col: str = "text", min_len: int = 200, order: str | None = None) -> DataFrame:
    """When ``main`` has fewer than ``target // 2`` rows, append the head
    ``target - n`` fallback rows whose stripped text is longer than ``min_len``.

    The decision needs ``n``; it is a one-row aggregate read as a scalar, so the whole
    thing stays one lazy plan (a scalar subquery, no join). The fallback head is a TakeOrderedAndProject of
    at most ``target`` rows.
    """
    n_main = main.select(F.count(F.lit(1))).scalar()   # scalar subquery, one value
    head = (head_by_order(fallback.filter(min_chars(text_col, min_len)), target, order or key)
            .withColumn("_pos", F.row_number().over(Window.orderBy(order or key))))   # <= target rows
    add = (head.filter((n_main < F.lit(target // 2)) & (F.col("_pos") <= F.lit(target) - n_main))
               .drop("_pos"))
    return main.unionByName(add, allowMissingColumns=True)


def dedupe_overlap(df: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """U4: texts drawn more than once by a mix, with the sources that drew them."""
    return (df.groupBy(F.sha2(F.col(text_col), 256).alias("text_hash"))
              .agg(F.count(F.lit(1)).alias("copies"),
                   F.array_sort(F.collect_set(source_col)).alias("sources"))
              .filter(F.col("copies") > 1))


def apply_quota_disjoint(df: DataFrame, source_col: str, quotas: Mapping, seed: int, key: str = "doc_id",
                         rank_col: str = "rank") -> DataFrame:
    """J6 with per-source salted hashes (U4 ``disjoint``): the draw of each source is still seeded."""
    h = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}|"),
                                           F.col(source_col).cast("string"))))
    return top_per_group(h, source_col, quotas, ["_h", key], rank_col).drop("_h")
