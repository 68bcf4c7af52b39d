"""Reuse distances of a request log and the cache hits that follow from them.

The distance of a request is the number of distinct other inputs asked since its
input was asked last. A cache of ``C`` answers that drops the least recently
asked one serves the request exactly if the distance is under ``C``; an answer
kept for a time after its last use serves it if the gap is no longer than that.
So one pass gives the hits of every capacity and age.

A request at place ``i`` whose input was last asked at place ``p`` has
``i - p - 1`` places between; those of them that ask an input again, first asked
after ``p`` too, add nothing. They are the earlier requests with a later last
place, so the distances need one count per request over (place, last place).
Places are cut into chunks of about ``16 * sqrt(n)`` places, for both
coordinates. Pairs of chunks are summed by a grid (n / 512 cells); what shares a
chunk is counted within it by numpy, in one group per chunk, which holds at most
a chunk's places however often an input is asked. Nothing depends on how many
requests an input has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranges import running_before
from quarry.session import cut_lineage, ship_package

CHUNK_FACTOR = 16           # chunk of places: this times the square root of the log's length


def earlier_greater(place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each element the number of elements with a smaller ``place`` and a greater ``value`` (values are distinct).

    In order of falling value, an element of the right half of a block of places
    counts the elements of the left half that came before it, for blocks of 2, 4, 8, ... places.
    """
    out = np.zeros(len(place), dtype=np.int64)
    if len(place) < 2:
        return out
    falling = np.argsort(-value, kind="stable")
    at = (place - place.min())[falling]
    for bit in range(int(at.max()).bit_length()):
        order = np.argsort(at >> (bit + 1), kind="stable")
        block = at[order] >> (bit + 1)
        right = (at[order] >> bit) & 1
        left_before = np.concatenate(([0], np.cumsum(1 - right)))
        start = np.searchsorted(block, block, side="left")
        seen = left_before[:-1] - left_before[start]
        out[falling[order]] += np.where(right == 1, seen, 0)
    return out


def _last_uses(log: DataFrame, key_col: str, time_col: str, id_col: str, width: int) -> DataFrame:
    """Requests whose input was asked before: ``id_col, key_col, pos, prev, gap_us``.

    The last use is looked up within a chunk of places; the first request of an
    input in a chunk takes the input's last place in the chunks before.
    """
    rows = log.select(id_col, key_col, time_col, F.struct(time_col, id_col).alias("_order"), F.lit(1).alias("_one"))
    rows = running_before(rows, "_order", "_one", name="pos").where(F.col(key_col).isNotNull())
    rows = rows.select(id_col, key_col, F.struct("pos", F.col(time_col).alias("at")).alias("use"), F.floor(F.col("pos") / width).alias("_chunk"))
    within = F.lag("use").over(Window.partitionBy(key_col, "_chunk").orderBy("use.pos"))
    last = rows.groupBy(key_col, "_chunk").agg(F.max("use").alias("_last"))
    before = last.select(key_col, "_chunk", F.lag("_last").over(Window.partitionBy(key_col).orderBy("_chunk")).alias("_before"))
    used = rows.withColumn("_within", within).join(before, [key_col, "_chunk"])
    prev = F.coalesce("_within", "_before")
    return (used.where(prev.isNotNull())
            .select(id_col, key_col, F.col("use.pos").alias("pos"), prev["pos"].alias("prev"), (F.col("use.at") - prev["at"]).alias("gap_us")))


def _nested(uses: DataFrame, width: int) -> DataFrame:
    """``uses`` with ``nested``: the uses that are earlier and whose previous place is later."""
    ship_package(uses.sparkSession)
    uses = cut_lineage(uses.withColumns({"_pc": F.floor(F.col("pos") / width), "_vc": F.floor(F.col("prev") / width)}))

    def in_chunk(place: str, out: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf[out] = earlier_greater(pdf[place].to_numpy(), pdf["prev"].to_numpy())
            return pdf
        return run

    narrow = uses.select("pos", "prev", "_pc", "_vc")
    schema = "pos long, prev long, _pc long, _vc long, _near long"
    near = narrow.groupBy("_pc").applyInPandas(in_chunk("pos", "_near"), schema)                       # same chunk of places
    both = near.groupBy("_vc").applyInPandas(in_chunk("_pc", "_far"), schema + ", _far long")          # earlier chunk, same chunk of last places
    cells = uses.groupBy("_pc", "_vc").agg(F.count(F.lit(1)).alias("_n"))
    edge = uses.agg(F.coalesce(F.max("_pc"), F.lit(-1)).alias("top"))
    grid = (edge.where("top >= 0").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("top"))).alias("_pc"))
            .select("_pc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pc"))).alias("_vc")))   # a last place is never in a later chunk
    grid = grid.join(cells, ["_pc", "_vc"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    later = Window.partitionBy("_pc").orderBy(F.desc("_vc")).rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
    above = Window.partitionBy("_vc").orderBy("_pc").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("_cross", F.coalesce(F.sum("_later").over(above), F.lit(0))).select("_pc", "_vc", "_cross")
    counted = both.join(grid, ["_pc", "_vc"]).select("pos", (F.col("_near") + F.col("_far") + F.col("_cross")).alias("nested"))
    return uses.drop("_pc", "_vc").join(counted, "pos")


def reuse_distances(log: DataFrame, key_col: str = "input_key", time_col: str = "start_us", id_col: str = "request_id",
                    width: int | None = None) -> DataFrame:
    """``id_col, key_col, distance, gap_us`` of every request whose input was asked before.

    Requests are ordered by time, then id (ids are unique). ``distance`` counts
    the distinct other inputs since the last use, ``gap_us`` is the time since
    then. A request without an input is an input of its own: it is never served
    and counts for the others. An empty log gives no rows. ``width`` is the
    number of places of a chunk (by default from the log's length).
    """
    width = width or max(1, CHUNK_FACTOR * math.isqrt(log.count()))
    uses = _nested(_last_uses(log, key_col, time_col, id_col, width), width)
    return uses.select(id_col, key_col, (F.col("pos") - F.col("prev") - 1 - F.col("nested")).alias("distance"), "gap_us")


def cache_curve(log: DataFrame, capacities: Sequence[int], max_ages_s: Sequence[int | None] = (None,), **names) -> DataFrame:
    """``capacity, max_age_s, requests, hits, hit_rate`` for every capacity and age of a cache.

    An answer is served while at most ``capacity`` inputs are kept (the least
    recently asked one goes) and its last use is at most ``max_age_s`` seconds
    ago (None: no limit). All settings come from one aggregate of the reuses.
    """
    uses = reuse_distances(log, **names)
    settings = [(c, a) for c in capacities for a in max_ages_s]
    hits = [F.count_if((F.col("distance") < c) & (F.lit(True) if a is None else F.col("gap_us") <= a * 1_000_000)) for c, a in settings]
    row = uses.agg(F.array(*[F.struct(F.lit(c).cast("long").alias("capacity"), F.lit(a).cast("long").alias("max_age_s"), h.alias("hits"))
                             for (c, a), h in zip(settings, hits)]).alias("s"))
    total = log.agg(F.count(F.lit(1)).alias("requests"))
    return (row.crossJoin(total).select("requests", F.explode("s").alias("s"))             # one row each
            .select("s.capacity", "s.max_age_s", "requests", "s.hits", F.round(F.try_divide(F.col("s.hits"), F.col("requests")), 6).alias("hit_rate")))
