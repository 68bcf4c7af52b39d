"""Chains of jumps over a running sum, without walking the table in one task.

A pack closes at the first row whose running end exceeds the last close by more
than ``limit``, so the closes are a chain: from a threshold v to the first end
above v, and on with v = end + ``limit``. Only the threshold passes from one
stretch of rows to the next, and a stretch can be entered in few ways: the last
close before it lies at most ``limit`` behind its begin. So every stretch becomes
a table of steps ``[lo, hi) -> (closes, threshold behind)``; ``FAN`` neighbouring
stretches are composed into one, level by level, until one is left, whose entry is
known; the entries then go back down the levels, and each stretch of rows is walked
from its own. All groups are bounded: a stretch spans ``SPAN * limit`` units of the
running sum, a composition holds the steps of ``FAN`` stretches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

SPAN = 256
FAN = 256
_STEPS = "at long, lo long, hi long, closes long, behind long"


def _row_steps(limit: int):
    """Steps of one stretch of rows (``at, before, end``)."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("end")
        before, end = g["before"].to_numpy(np.int64), g["end"].to_numpy(np.int64)
        follow = np.searchsorted(end, end + limit, "right")
        closes, behind = np.ones(len(end), np.int64), end + limit
        for i in range(len(end) - 1, -1, -1):
            j = follow[i]
            if j < len(end):
                closes[i], behind[i] = closes[j] + 1, behind[j]
        entry = before <= before[0] + limit
        return pd.DataFrame({"at": g["at"].iat[0], "lo": before[entry], "hi": end[entry],
                             "closes": closes[entry], "behind": behind[entry]})
    return run


def _lookup(g: pd.DataFrame) -> list[tuple]:
    """Per stretch of a group, in order: (at, lo, hi, closes, behind) as arrays."""
    g = g.sort_values(["at", "lo"])
    return [(int(at), *(p[c].to_numpy(np.int64) for c in ("lo", "hi", "closes", "behind"))) for at, p in g.groupby("at", sort=True)]


def _through(parts: list[tuple], v: int, first: int = 0) -> tuple[int, int, list[tuple]]:
    """Closes, threshold and the entries of the stretches from ``first`` on when the threshold is ``v`` before them."""
    n, entries = 0, []
    for at, _, hi, closes, behind in parts[first:]:
        entries.append((at, v, n))
        i = int(np.searchsorted(hi, v, "right"))
        if i < len(hi):                                 # else the stretch ends before the threshold
            n, v = n + int(closes[i]), int(behind[i])
    return n, v, entries


def _composed(limit: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        parts = _lookup(g)
        begin = int(parts[0][1][0])
        out = []
        for k, (_, lo, hi, closes, behind) in enumerate(parts):
            if int(lo[0]) > begin + limit:
                break
            for a, b, c, v in zip(lo.tolist(), hi.tolist(), closes.tolist(), behind.tolist()):
                if a <= begin + limit:
                    n, v, _ = _through(parts, v, k + 1)
                    out.append((int(g["up"].iat[0]), a, b, c + n, v))
        return pd.DataFrame(out, columns=["at", "lo", "hi", "closes", "behind"])
    return run


def _entries(g: pd.DataFrame) -> pd.DataFrame:
    """Entries of the stretches of one composed stretch, from its own entry (``v``, ``base``)."""
    _, _, found = _through(_lookup(g), int(g["v"].iat[0]))
    base = int(g["base"].iat[0])
    return pd.DataFrame([(at, v, base + n) for at, v, n in found], columns=["at", "v", "base"])


def _numbered(limit: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("end")
        end = g["end"].to_numpy(np.int64)
        v, close = int(g["v"].iat[0]), np.zeros(len(end), np.int64)
        while (i := int(np.searchsorted(end, v, "right"))) < len(end):
            close[i] = 1
            v = int(end[i]) + limit
        number = int(g["base"].iat[0]) + np.cumsum(close) - close
        return pd.DataFrame({"key": g["key"], "weight": g["weight"], "number": number, "closes": close.astype(bool)})
    return run


def chain_numbers(rows: DataFrame, limit: int) -> DataFrame:
    """``(key, weight, number, closes)`` for ``rows`` (key, weight, before, end: running sums in order, each end above its before).

    ``number`` is the number of closes before the row, ``closes`` whether a
    close is at it; the first one is at the first end above ``limit``. The rows
    behind the last close have the number of all closes.
    """
    rows = cut_lineage(rows.select("key", "weight", "before", "end", F.floor(F.col("before") / (SPAN * limit)).cast("long").alias("at")))
    levels = [cut_lineage(rows.groupBy("at").applyInPandas(_row_steps(limit), _STEPS))]
    top = levels[0].agg(F.max("at")).first()[0]
    while top:                                          # one stretch, number 0, is left
        up = levels[-1].withColumn("up", F.floor(F.col("at") / FAN).cast("long"))
        levels.append(cut_lineage(up.groupBy("up").applyInPandas(_composed(limit), _STEPS)))
        top //= FAN
    spark = rows.sparkSession
    entry = spark.createDataFrame([(0, limit, 0)], "at long, v long, base long")
    for steps in levels[-2::-1]:
        below = steps.withColumn("up", F.floor(F.col("at") / FAN).cast("long"))
        entry = cut_lineage(below.join(entry.withColumnRenamed("at", "up"), "up")
                            .groupBy("up").applyInPandas(_entries, "at long, v long, base long"))
    return rows.join(entry, "at").groupBy("at").applyInPandas(_numbered(limit), "key long, weight long, number long, closes boolean")
