"""Batches, routing and packing of short texts.

W1 needs a global row index: ``global_index``, a running count over ranges of the
order key (see ``ranges``).

W2 is a buffer of texts that resets, yet no task walks it: a pack closes where the
running sum of characters first exceeds the last close by the limit, and that
chain of closes is found by composing bounded stretches (see ``chains``). Texts
that cannot be packed are left out before texts are shuffled to their packs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import MIN_TOKENS, PACK_MIN_TOKENS, route_by_length, token_count, truncate_tokens
from quarry.operators.chains import chain_numbers
from quarry.operators.ranges import running_before
from quarry.session import cut_lineage, ship_package

# Calibration defaults.
DEFAULT_MAX_LENGTH = 2048
DEFAULT_MAX_SAMPLES = 512


def global_index(df: DataFrame, order_col: str, idx_col: str = "idx") -> DataFrame:
    """0-based position of every row in ``order_col`` order (``order_col`` unique, any orderable type)."""
    return running_before(df.withColumn("_one", F.lit(1)), order_col, "_one", name=idx_col).drop("_one")


def assign_batches(df: DataFrame, size: int, order_col: str) -> DataFrame:
    """Consecutive slices of ``size`` rows in ``order_col`` order (``batch_id`` 0-based)."""
    return (global_index(df, order_col)
            .withColumn("batch_id", F.floor(F.col("idx") / F.lit(size)).cast("long")))


def route(df: DataFrame, text_col: str = "text", max_length: int = DEFAULT_MAX_LENGTH,
          min_length: int = MIN_TOKENS, pack_min: int = PACK_MIN_TOKENS) -> DataFrame:
    """P6 + P7: tokens after truncation to ``max_length`` and the route class."""
    n_raw = token_count(text_col)
    return (df.withColumn("n_tokens", F.least(n_raw, F.lit(max_length)))
              .withColumn("route", route_by_length(text_col, "n_tokens", min_length, pack_min)))


def truncated(df: DataFrame, text_col: str = "text", max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """P6 applied: ``text`` rewritten only where it has more than ``max_length`` tokens."""
    return df.withColumn(text_col, truncate_tokens(text_col, max_length))


def _pack_members(cand: DataFrame, max_length: int, min_length: int, budget: int) -> DataFrame:
    """``(pack, member)`` of the first ``budget`` kept packs of ``cand`` (key, chars, ntok), numbered from 0."""
    sums = running_before(cand.withColumn("chars", F.col("chars") + 1), "key", "chars")          # text + " "
    rows = sums.select("key", F.col("ntok").alias("weight"), "before", (F.col("before") + F.col("chars")).alias("end"))
    placed = cut_lineage(chain_numbers(rows, 2 * max_length))
    packs = placed.groupBy("number").agg(F.sum("weight").alias("ntok"), F.bool_or("closes").alias("closed"))
    packs = packs.where(F.col("closed") & (F.least("ntok", F.lit(max_length)) >= min_length)).select("number")
    kept = global_index(packs, "number", "pack").where(F.col("pack") < budget)
    return placed.join(kept, "number").select("pack", F.col("key").alias("member"))


def pack_short(df: DataFrame, key: str = "doc_id", text_col: str = "text",
               max_length: int = DEFAULT_MAX_LENGTH, min_length: int = MIN_TOKENS,
               max_samples: int | Callable[[int], int] = DEFAULT_MAX_SAMPLES, pack_min: int = PACK_MIN_TOKENS,
               n_shards: int = 1) -> DataFrame:
    """Packs of short texts, in key order.

    Packing runs only when fewer than ``max_samples // 2`` texts were kept;
    texts are appended with a trailing space, a pack closes once the buffer
    exceeds ``2*max_length`` characters, is truncated to ``max_length`` tokens
    and kept when it has at least ``min_length`` tokens; packing stops when
    kept texts plus packs reach ``max_samples`` (a number, or a function of the
    number of kept texts); the unfinished tail is dropped.

    ``n_shards = 1`` is the sequential rule over all candidates, run in parallel.
    More shards give another rule: a candidate belongs to the shard
    ``key mod n_shards``, and each shard packs its candidates with its share of
    the budget (the first shards get one more).

    Defined cases: a null or empty text is no candidate; ``key`` is unique and
    not null; an empty table gives an empty result.

    Returns one row per pack: ``pack_id`` (``pack number * n_shards + shard``),
    ``first_doc, last_doc, n_texts, n_tokens, chars, text``.
    """
    ship_package(df.sparkSession)
    routed = cut_lineage(route(df.select(key, text_col), text_col, max_length, min_length, pack_min)
                         .select(F.col(key).cast("long").alias("key"), "route",
                                 F.length(text_col).cast("long").alias("chars"),
                                 token_count(text_col).cast("long").alias("ntok")))
    kept = routed.filter(F.col("route") == "keep").count()
    wanted = max_samples(kept) if callable(max_samples) else max_samples
    rest = wanted - kept if kept < wanted // 2 else 0
    cand = routed.filter(F.col("route") == "pack").select("key", "chars", "ntok")
    members = None
    for shard in range(n_shards):
        mine = cand if n_shards == 1 else cand.where(F.pmod("key", F.lit(n_shards)) == shard)
        budget = rest // n_shards + (shard < rest % n_shards)
        part = _pack_members(mine if budget else mine.limit(0), max_length, min_length, budget)
        part = part.select((F.col("pack") * n_shards + shard).alias("pack_id"), "member")
        members = part if members is None else members.unionByName(part)
    texts = (route(df.select(key, text_col), text_col, max_length, min_length, pack_min).where(F.col("route") == "pack")
             .select(F.col(key).cast("long").alias("member"), text_col))
    packed = texts.join(members, "member").groupBy("pack_id").agg(
        F.min("member").alias("first_doc"), F.max("member").alias("last_doc"),
        F.count(F.lit(1)).alias("n_texts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("member", text_col))),
                                 lambda s: F.concat(s[text_col], F.lit(" "))), "").alias("_buf"))
    return (packed.withColumn("chars", F.length("_buf"))
                  .withColumn("n_tokens", F.least(token_count("_buf"), F.lit(max_length)))
                  .withColumn("text", truncate_tokens("_buf", max_length))
                  .drop("_buf"))


def calibration_set(df: DataFrame, key: str = "doc_id", text_col: str = "text",
                    max_length: int = DEFAULT_MAX_LENGTH, min_length: int = MIN_TOKENS,
                    max_samples: int | Callable[[int], int] = DEFAULT_MAX_SAMPLES, pack_min: int = PACK_MIN_TOKENS,
                    n_shards: int = 1) -> DataFrame:
    """K2 core: kept texts (truncated) plus packs, as ``(kind, seq_key, n_tokens, text)``."""
    routed = route(df.select(key, text_col), text_col, max_length, min_length, pack_min)
    kept = (routed.filter(F.col("route") == "keep")
                  .select(F.lit("text").alias("kind"), F.col(key).cast("long").alias("seq_key"),
                          "n_tokens", truncate_tokens(text_col, max_length).alias("text")))
    packs = pack_short(df, key, text_col, max_length, min_length, max_samples, pack_min, n_shards)
    return kept.unionByName(packs.select(F.lit("pack").alias("kind"), F.col("pack_id").alias("seq_key"),
                                         "n_tokens", "text"))
