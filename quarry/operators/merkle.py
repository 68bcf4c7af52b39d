"""Proof that an append-only log was not altered (S16): hash trees per day, a chain of the days' roots.

A record's leaf is the SHA-256 of its columns, each written with its length, so
no two records share a text. The leaves of a day, in order, are hashed sixteen
at a time, level by level, up to the day's root; the roots are chained in order
of the days. A seal is one row per day, and its last link stands for the whole
log. Places come from a running count over ranges (``running_before``) and a
level is one grouped aggregate of at most sixteen hashes per group, so a day
with most of the records is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranges import running_before
from quarry.operators.requests import ntz_micros
from quarry.session import cut_lineage

FANOUT = 16
GENESIS = "0" * 64


def _written(df: DataFrame, name: str) -> Column:
    """A column's value as text, without the session's time zone."""
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    if kind == "timestamp":
        c = F.unix_micros(c)
    elif kind == "timestamp_ntz":
        c = ntz_micros(c)
    elif kind in ("struct", "array", "map", "variant"):
        c = F.to_json(c)
    return F.hex(c) if kind == "binary" else c.cast("string")


def leaf_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the columns' values as ``length:text``, null as ``-``."""
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (_written(df, c) for c in columns)]
    return F.sha2(F.concat(F.lit("leaf|"), *parts), 256)


def _node_hash(children: Column) -> Column:
    return F.sha2(F.concat(F.lit("node|"), F.concat_ws("|", children)), 256)


def _link(previous: Column, day: Column, n: Column, root: Column) -> Column:
    return F.sha2(F.concat_ws("|", previous, day, n.cast("string"), root), 256)


def leaves(records: DataFrame, id_col: str, order_cols: Sequence[str], day_col: str = "date", columns: Sequence[str] | None = None) -> DataFrame:
    """``(day, id, pos, hash)``: every record's leaf and its place in its day.

    ``columns`` are the sealed ones (default: all but the day, which the tree
    stands for). Records are ordered by ``order_cols``, then by id and leaf;
    fully equal records stay apart by an arbitrary number, which changes no hash.
    A null day is a day of its own.
    """
    columns = list(columns or [c for c in records.columns if c != day_col])
    rows = records.select(F.col(day_col).alias("day"), F.col(id_col).alias("id"), leaf_hash(records, columns).alias("hash"),
                          F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]).alias("_by"))
    rows = cut_lineage(rows.withColumn("_no", F.monotonically_increasing_id()))      # the numbers must not change between reads
    rows = rows.select("day", "id", "hash", F.struct("_by", "id", "hash", "_no").alias("_order"), F.lit(1).alias("_one"))
    return running_before(rows, "_order", "_one", ["day"], "pos").select("day", "id", "pos", "hash")


def tree(leaf_rows: DataFrame) -> DataFrame:
    """``(day, level, pos, hash, id, n)``: all nodes, leaves (level 0, with their ids) up to the roots; ``n`` is the day's record count.

    A day's levels end where one node is left.
    """
    counts = leaf_rows.groupBy(F.col("day").alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    level = cut_lineage(leaf_rows.join(counts, F.col("day").eqNullSafe(F.col("_d")))
                        .select("day", F.lit(0).alias("level"), "pos", "hash", F.col("id").cast("string").alias("id"), "n"))
    out, most = level, level.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    depth, width = 0, 1
    while width < most:                                   # a sixteenth of the rows each time
        depth, above = depth + 1, F.floor(F.col("pos") / FANOUT)
        grouped = level.where(F.col("n") > width).groupBy("day", "n", above.alias("pos")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("c"))
        level = cut_lineage(grouped.select("day", F.lit(depth).alias("level"), "pos", _node_hash(F.col("c.hash")).alias("hash"),
                                           F.lit(None).cast("string").alias("id"), "n"))
        out, width = out.unionByName(level), width * FANOUT
    return out


def seal(nodes: DataFrame, after: str = GENESIS) -> DataFrame:
    """``(day, n, root, chain)``: the days' roots, each link made of the one before (``after``: the link to go on from).

    Days are put in order in one row (one entry per day); a null day comes first.
    """
    top = nodes.groupBy("day", "n").agg(F.max_by("hash", "level").alias("root"))
    days = top.agg(F.sort_array(F.collect_list(F.struct("day", "n", "root"))).alias("days"))

    def add(links: Column, d: Column) -> Column:
        return F.concat(links, F.array(_link(F.element_at(links, -1), F.coalesce(d["day"].cast("string"), F.lit("-")), d["n"], d["root"])))

    links = days.select("days", F.reduce("days", F.array(F.lit(after)), add).alias("links"))
    return (links.select(F.explode(F.arrays_zip("days", F.slice("links", 2, F.size("days")).alias("chain"))).alias("e"))
            .select("e.days.*", "e.chain"))


def inclusion_proofs(nodes: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """``(day, id, pos, path)`` per record of ``ids``: on each level the node's slot and all hashes of its group.

    Only groups on a wanted path are gathered. A record without such an id gives no row.
    """
    wanted = nodes.where("level = 0").join(ids.select(F.col(id_col).cast("string").alias("id")).distinct(), "id", "left_semi")
    steps = wanted.select("day", "id", "pos", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), _height(F.col("n")) - 1))).alias("level"))
    scale = F.pow(F.lit(float(FANOUT)), F.col("level")).cast("long")
    steps = steps.withColumn("_at", F.floor(F.col("pos") / scale)).withColumn("_up", F.floor(F.col("_at") / FANOUT))
    groups = nodes.withColumn("_up", F.floor(F.col("pos") / FANOUT)).alias("g")
    need = steps.select("day", "level", "_up").distinct().alias("w")
    same = F.col("g.day").eqNullSafe(F.col("w.day")) & (F.col("g.level") == F.col("w.level")) & (F.col("g._up") == F.col("w._up"))
    sides = groups.join(need, same, "left_semi").groupBy("day", "level", "_up").agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("c")).alias("x")
    on = F.col("s.day").eqNullSafe(F.col("x.day")) & (F.col("s.level") == F.col("x.level")) & (F.col("s._up") == F.col("x._up"))
    path = F.struct(F.col("s.level").alias("level"), (F.col("s._at") % FANOUT).cast("int").alias("slot"), F.col("x.c.hash").alias("hashes"))
    return (steps.alias("s").join(sides, on).groupBy("s.day", "s.id", "s.pos").agg(F.sort_array(F.collect_list(path)).alias("path")))


def _height(n: Column) -> Column:
    """Levels above the leaves of a day with ``n`` records."""
    h = F.lit(0)
    for level in range(15):
        h = h + (n > F.lit(FANOUT ** level)).cast("int")
    return h


def verify_proofs(leaf_rows: DataFrame, proofs: DataFrame, sealed: DataFrame) -> DataFrame:
    """``(day, id, pos, ok)``: whether the record's leaf as it is now leads along its path to the sealed root.

    ``leaf_rows`` are ``(id, hash)`` of the records to prove; a record whose proof is missing is not ok.
    """
    p = proofs.join(sealed.select(F.col("day").alias("_d"), "root", "n"), F.col("day").eqNullSafe(F.col("_d"))).drop("_d")
    j = leaf_rows.select(F.col("id").cast("string").alias("id"), "hash").join(p, "id", "left")
    end = F.reduce("path", F.col("hash"), lambda acc, s: F.when(s["hashes"][s["slot"]] == acc, _node_hash(s["hashes"])))
    end = F.when(F.col("n") == 1, F.col("hash")).otherwise(end)
    return j.select("day", "id", "pos", F.coalesce(end == F.col("root"), F.lit(False)).alias("ok"))


def altered(old_nodes: DataFrame, new_nodes: DataFrame) -> DataFrame:
    """``(id, finding, day, new_day)`` of records that differ between a kept tree and the log's tree as it is now.

    One finding per id: ``changed`` (other content), ``moved`` (same content, other day), ``dropped``
    and ``added`` (a repeated record, too). Only days whose roots differ are
    compared, by (day, id, leaf), so a lost record does not touch the ones after it.
    """
    a, b = (seal(t).select("day", F.struct("n", "root").alias(c)) for t, c in ((old_nodes, "a"), (new_nodes, "b")))
    differ = (a.withColumnRenamed("day", "da").join(b.withColumnRenamed("day", "db"), F.col("da").eqNullSafe(F.col("db")), "full")
              .where(~F.col("a").eqNullSafe(F.col("b"))).select(F.coalesce("da", "db").alias("_d")))
    sides = [t.where("level = 0").join(differ, F.col("day").eqNullSafe(F.col("_d")), "left_semi").select("day", "id", "hash", F.lit(sign).alias("v"))
             for t, sign in ((old_nodes, 1), (new_nodes, -1))]
    left = sides[0].unionByName(sides[1]).groupBy("day", "id", "hash").agg(F.sum("v").alias("v")).where("v <> 0")
    lost, gained = F.col("v") > 0, F.col("v") < 0
    by_id = left.groupBy("id").agg(F.max(F.when(lost, F.struct("hash", "day"))).alias("o"), F.max(F.when(gained, F.struct("hash", "day"))).alias("w"))
    finding = (F.when(F.col("w").isNull(), F.lit("dropped")).when(F.col("o").isNull(), F.lit("added"))
               .when(F.col("o.hash") == F.col("w.hash"), F.lit("moved")).otherwise(F.lit("changed")))
    return by_id.select("id", finding.alias("finding"), F.col("o.day").alias("day"), F.col("w.day").alias("new_day"))
