"""Sharding by balanced label propagation.

Documents that share a group key (here: equal texts) are linked with each
other. Every linked document starts in a shard by its hash. Each round counts
the members of every group per shard, and members outside the shard where most
of their neighbours are want to move there. A quota (the shard's capacity less
those that stay) admits the moves in hash order; who finds no room tries the
next shard with room in a later round, so a group larger than a shard fills as
few shards as possible. Linked documents of one group and shard are
interchangeable, so the rounds work on the counts per (group, shard): joins of
narrow tables, whatever the size of a group. Documents without links have no
preference and fill what capacity is left, which makes the counts of the shards
differ by one at most (law ``rows``).

The only things that come to the driver are per-shard totals (one row a shard).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.ranks import buckets_for, positions
from quarry.session import cut_lineage

MAX_ROUNDS = 12
LEAST_PER_SHARD = 8


def _loads(state: DataFrame, shards: int) -> list[int]:
    got = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("c").alias("n")).collect()}
    return [got.get(j, 0) for j in range(shards)]


def propagate(state: DataFrame, capacity: list[int]) -> DataFrame:
    """Final ``(key, shard, c)`` of linked documents, from their first counts; loads end within ``capacity``.

    Ends when no document moves, or after ``MAX_ROUNDS``; an overflow left by
    moves that were refused is handed to the shards with room.
    """
    spark, shards = state.sparkSession, len(capacity)
    state = cut_lineage(state)
    for _ in range(MAX_ROUNDS):
        load = _loads(state, shards)
        room = spark.createDataFrame([(j, capacity[j] - load[j]) for j in range(shards)], "shard int, room long")
        seen = state.join(F.broadcast(room), "shard")
        # a shard attracts while it has room; of equal counts the one with room wins
        rank = F.struct("c", (F.col("room") > 0).alias("open"), F.xxhash64("key", "shard").alias("tie"), "shard")
        best = (seen.groupBy("key").agg(F.max(F.when(F.col("room") > 0, rank)).alias("best")).where("best is not null"))
        want = (seen.select("key", "shard", "c", rank.alias("own")).join(best, "key")
                .where("best.shard <> shard and best > own")
                .select("key", F.col("shard").alias("source"), F.col("best.shard").alias("shard"), F.col("c").alias("m")))
        want = cut_lineage(want)
        leaving = {r.source: r.n for r in want.groupBy("source").agg(F.sum("m").alias("n")).collect()}
        if not leaving:
            return _repair(state, capacity)
        quota = spark.createDataFrame([(j, capacity[j] - load[j] + leaving.get(j, 0)) for j in range(shards)], "shard int, quota long")
        flows = _running(want, "m").join(F.broadcast(quota), "shard")
        moved = flows.select("key", "source", "shard", F.greatest(F.lit(0), F.least("m", F.col("quota") - F.col("before"))).alias("m")).where("m > 0")
        moved = cut_lineage(moved)
        if not moved.limit(1).count():
            return _repair(state, capacity)
        change = (state.select("key", "shard", "c")
                  .union(moved.select("key", "shard", F.col("m").alias("c")))
                  .union(moved.select("key", F.col("source").alias("shard"), (-F.col("m")).alias("c"))))
        state = cut_lineage(change.groupBy("key", "shard").agg(F.sum("c").alias("c")).where("c > 0"))
    return _repair(state, capacity)


def _running(flows: DataFrame, amount: str) -> DataFrame:
    """``before``: the sum of ``amount`` of the flows into the same shard that come earlier in hash order."""
    f = flows.withColumn("_h", F.xxhash64("key", "source")).withColumn("_b", F.pmod(F.col("_h"), F.lit(1024)).cast("int"))
    sums = f.groupBy("shard", "_b").agg(F.sum(amount).alias("_s"))
    w = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "_b", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum(amount).over(Window.partitionBy("shard", "_b").orderBy("_h", "key", "source")
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return f.join(sums, ["shard", "_b"]).withColumn("before", F.col("_before") + inner).drop("_h", "_b", "_before")


def _repair(state: DataFrame, capacity: list[int]) -> DataFrame:
    """Hands what exceeds a shard's capacity to shards with room, in ranges (two tables of one row a shard)."""
    spark, load = state.sparkSession, _loads(state, len(capacity))
    over = [(j, load[j] - capacity[j]) for j in range(len(capacity)) if load[j] > capacity[j]]
    if not over:
        return state
    ranges, at = [], 0                                   # (from shard, offset in its overflow, to shard, how many)
    rooms = [[j, capacity[j] - load[j]] for j in range(len(capacity)) if load[j] < capacity[j]]
    for j, n in over:
        off = 0
        while n:
            take = min(n, rooms[at][1])
            ranges.append((j, off, rooms[at][0], take))
            off, n = off + take, n - take
            rooms[at][1] -= take
            at += rooms[at][1] == 0
    table = spark.createDataFrame(ranges, "shard int, off long, target int, n long")
    run = _running(state.select("key", "shard", F.col("shard").alias("source"), "c"), "c")
    part = (run.join(F.broadcast(table), "shard")
            .withColumn("m", F.least(F.col("before") + F.col("c"), F.col("off") + F.col("n")) - F.greatest("before", "off"))
            .where("m > 0"))
    change = (state.select("key", "shard", "c").union(part.select("key", F.col("target").alias("shard"), F.col("m").alias("c")))
              .union(part.select("key", "shard", (-F.col("m")).alias("c"))))
    return cut_lineage(change.groupBy("key", "shard").agg(F.sum("c").alias("c")).where("c > 0"))


def assign(rows: DataFrame, shards: int, id_col: str, key_col: str) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within a shard).

    ``rows`` is a narrow table; rows of equal non-null ``key_col`` are linked.
    Null keys are linked with nothing. Repeated rows are separate rows.
    """
    rows = cut_lineage(rows.withColumn("_h", F.xxhash64(id_col, key_col)))
    total = rows.count()
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    nb = buckets_for(total)
    # counts per (key, first shard) come before any join, so a hot key is a row per task and shard; hash
    # order may exceed a capacity by chance, the quotas and the final repair restore it
    counts = (rows.where(F.col(key_col).isNotNull())
              .groupBy(F.col(key_col).alias("key"), F.pmod("_h", F.lit(shards)).cast("int").alias("shard")).agg(F.count("*").alias("c")))
    members = F.sum("c").over(Window.partitionBy("key"))             # at most one row per shard
    state = cut_lineage(counts.withColumn("members", members).where("members > 1").drop("members"))
    if state.limit(1).count():
        state = propagate(state, capacity)
    load = _loads(state, shards)

    whole = state.groupBy("key").agg(F.count("*").alias("parts"), F.min("shard").alias("one"))
    home = cut_lineage(whole.select(F.col("key").alias(key_col), "parts", "one"))
    tagged = rows.join(home, key_col, "left")
    linked = tagged.where("parts = 1").drop("parts").withColumnRenamed("one", "shard")
    # groups that fill more than one shard: by position within the group
    split = positions(tagged.where("parts > 1").drop("parts", "one"), [key_col], "_h", [id_col], nb)
    w = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (state.join(home.where("parts > 1").select(F.col(key_col).alias("key")), "key")
              .withColumn("lo", F.coalesce(F.sum("c").over(w), F.lit(0))).withColumnRenamed("key", key_col))
    split = (split.join(ranges, key_col).where((F.col("pos") >= F.col("lo")) & (F.col("pos") < F.col("lo") + F.col("c")))
             .drop("lo", "c", "pos"))
    # rows without links fill what is left of every shard
    free, at = [], 0
    for j in range(shards):
        free.append((j, at, at + capacity[j] - load[j]))
        at = free[-1][2]
    single = positions(tagged.where("parts is null").withColumn("_all", F.lit(0)).drop("parts", "one"), ["_all"], "_h", [id_col], nb).drop("_all")
    place = F.array(*[F.lit(hi) for _, _, hi in free])
    single = single.withColumn("shard", F.size(F.filter(place, lambda hi: hi <= F.col("pos")))).drop("pos")
    cols = [*rows.columns, "shard"]
    done = cut_lineage(linked.select(cols).unionByName(split.select(cols)).unionByName(single.select(cols)))
    # single rows of a shard lie in one stretch of the first hash: slots go by another one
    done = done.withColumn("_s", F.xxhash64(F.lit("slot"), "_h"))
    return positions(done, ["shard"], "_s", ["_h", id_col], max(LEAST_PER_SHARD, nb // shards), "slot").drop("_h", "_s")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    size: UTF-8 bytes of the text plus 8; law ``rows``: the shards' row counts
    differ by one at most. Equal texts are linked. Defined cases: a null text has
    size 8, crc32 0 and no link; empty texts are equal texts; null ids are
    allowed; repeated rows are rows of their own; other columns are never read;
    an empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"),
                       F.unhex(F.md5(text)).alias("key"))
    return assign(rows, shards, "doc_id", "key").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
