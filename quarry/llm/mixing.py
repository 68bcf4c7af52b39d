"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

* Targets: sources weigh 3, 1, 2, repeating, in code point order (null last) and
  share ``ratio`` times all words; a target stops at ``limit`` times its source,
  the excess goes to the others by weight. That is one water level, found with
  window sums over one row per source.
* Blocks: a source of n documents is cut into about sqrt(n) blocks by a hash of
  the id; a document longer than the mean block (there are fewer of them than
  blocks) is a block of its own. The blocks stand in a hashed (permuted) order. A
  source is taken whole as often as its target allows. Of the rest, the long
  documents are settled first: each is drawn with the share of the source that is
  wanted, while they fit, and more are taken, shortest first, where the others
  would not fill the rest. Then come as many whole blocks as fit, and from the
  next ``PARTS`` blocks the documents that fit, largest first.
* Splitting tree: the block quotas of all sources are dealt to ``shards`` output
  shards of equal block counts. A node splits its shards in halves and draws how
  many blocks of each source go left from the multivariate hypergeometric
  distribution (source after source, by inversion of a hashed uniform). A
  source's permuted block uses are then cut into consecutive, disjoint runs, one
  a shard; within a shard, rows are ordered by a hash.

Only DataFrame and SQL functions are used. Tables other than the documents have
one row per source, per shard and source, or per block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

WEIGHTS = (3, 1, 2)
RATIO = 1.5
LIMIT = 2
SEED = 17
PARTS = 4                          # blocks that the last documents of a source are drawn from
BROADCAST_BLOCKS = 500_000         # block tables are broadcast only up to this checked count


def words_of(text: str | Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(*cols) -> Column:
    """Hashed uniform number in [0, 1)."""
    return F.xxhash64(*cols).cast("double") / F.lit(2.0 ** 64) + 0.5


def targets(sources: DataFrame, weights=WEIGHTS, ratio: float = RATIO, limit: float = LIMIT) -> DataFrame:
    """``sources`` (source, n, words) with number, weight and target of each; one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    s = (sources.withColumn("number", F.row_number().over(order) - 1).withColumn("weight", w)
         .withColumn("cap", F.col("words") * float(limit)))
    # sources reach their cap in the order of cap / weight while the water rises
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("_total", F.sum("words").over(every) * float(ratio))
         .withColumn("_full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("_open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_open")))
    # the level is settled at the first source whose cap lies above it; without one every source is at its cap
    first = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("number"), F.col("_level").alias("level")))).over(every)
    s = s.withColumn("_water", first["level"])
    return s.withColumn("target", F.coalesce(F.least("cap", F.col("_water") * F.col("weight")), F.col("cap"))).drop(
        "_total", "_full", "_open", "_level", "_water", "cap")


def _ln_factorial(n: Column) -> Column:
    """Stirling's series, right to 1e-3 from n = 1 on; 0 for n < 1."""
    x = F.greatest(n.cast("double"), F.lit(1.0))
    s = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n < 1, 0.0).otherwise(s)


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Number of marked ones among ``draws`` of ``total`` without replacement, at the quantile ``u``."""
    low, high = F.greatest(F.lit(0), draws - (total - marked)).cast("long"), F.least(marked, draws).cast("long")

    def log_weight(x: Column) -> Column:
        return -(_ln_factorial(x) + _ln_factorial(marked - x) + _ln_factorial(draws - x)
                 + _ln_factorial(total - marked - draws + x))

    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (marked + 1) / (total + 2)).cast("long")))
    top = log_weight(mode)
    weights = F.transform(F.sequence(low, high), lambda x: F.exp(log_weight(x) - top))
    need = u * F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    below = F.aggregate(
        weights, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["n"] + F.when(a["sum"] + w <= need, 1).otherwise(0)).cast("long").alias("n")))
    return F.least(low + below["n"], high)


def split_tree(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``(shard, number, blocks)``: block counts of every source and shard.

    ``quotas`` has ``number`` and ``blocks``, one row per source; row sums are the
    quotas and shard sums differ by one at most.
    """
    q = F.array_sort(F.collect_list(F.struct(F.col("number").cast("int").alias("number"), F.col("blocks").cast("long").alias("k"))))
    node = quotas.agg(q.alias("q")).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "q")
    total = F.aggregate("q", F.lit(0).cast("long"), lambda a, s: a + s["k"])
    node = node.withColumn("all", total)
    for _ in range(max(1, math.ceil(math.log2(shards)))):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")

        def capacity(a: Column, b: Column) -> Column:    # blocks of the shards from a to b
            extra = F.col("all") % shards
            return (F.floor(F.col("all") / shards) * (b - a) + F.greatest(F.lit(0), F.least(b, extra) - F.least(a, extra))).cast("long")

        here = F.aggregate("q", F.lit(0).cast("long"), lambda a, s: a + s["k"])
        zero = F.struct(here.alias("n"), capacity(F.col("lo"), F.col("mid")).alias("m"),
                        F.array().cast("array<struct<number:int,k:bigint>>").alias("out"))

        def draw(a: Column, s: Column) -> Column:
            x = hypergeometric(a["n"], s["k"], a["m"], _uniform(F.lit(seed), F.col("lo"), F.col("hi"), s["number"]))
            return F.transform(F.array(x), lambda v: F.struct(
                (a["n"] - s["k"]).alias("n"), (a["m"] - v).alias("m"),
                F.concat(a["out"], F.array(F.struct(s["number"].alias("number"), v.alias("k")))).alias("out")))[0]

        node = node.withColumn("mid", mid).withColumn("left", F.aggregate("q", zero, draw)["out"])
        rest = F.zip_with("q", "left", lambda s, x: F.struct(s["number"].alias("number"), (s["k"] - x["k"]).alias("k")))
        halves = F.when(F.col("hi") - F.col("lo") > 1, F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("left").alias("q")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), rest.alias("q")))).otherwise(
            F.array(F.struct("lo", "hi", "q")))
        node = cut_lineage(node.select("all", F.explode(halves).alias("h")).select("h.lo", "h.hi", "h.q", "all"))
    return node.select(F.col("lo").alias("shard"), F.explode("q").alias("s")).select(
        "shard", F.col("s.number").alias("number"), F.col("s.k").alias("blocks"))


def plan(rows: DataFrame, shards: int = 16, weights=WEIGHTS, ratio: float = RATIO, limit: float = LIMIT, seed: int = SEED) -> dict[str, DataFrame]:
    """Decisions of the mix over ``rows`` (id, source, size), as small tables.

    ``sources``: source, number, words, target, n_blocks. ``blocks``: source
    number, block, uses (shards that take the whole block). ``picked``: source
    number, id, use (shard) of the documents taken from partly drawn blocks. Rows
    that repeat an id within a source are taken together.
    """
    src = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    src = targets(src, weights, ratio, limit)
    src = cut_lineage(src.withColumn("n_blocks", F.ceil(F.sqrt("n")).cast("long"))
                      .withColumn("rounds", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words") + 1e-9)).otherwise(0).cast("int"))
                      .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("rounds") * F.col("words"))))
    longs = long_documents(rows, src, seed)
    tagged = with_block(rows, src, longs, seed)
    block = tagged.groupBy("number", "block").agg(F.sum("size").alias("w"))
    order = Window.partitionBy("number", "long").orderBy(F.xxhash64(F.lit(seed + 1), "number", "block"), "block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    block = (block.join(bounded(src.select("number", "rounds", "rest", "words", "n_blocks")), "number")
             .withColumn("long", F.col("block") >= F.col("n_blocks")))
    block = settle_long(block, order, seed).withColumn("pos", F.row_number().over(order) - 1).withColumn("upto", F.sum("w").over(upto))
    # whole blocks up to the first that does not fit; that one is drawn in part
    misfit = F.min(F.when(~F.col("long") & (F.col("upto") > F.col("rest")), F.col("pos"))).over(Window.partitionBy("number"))
    here = ~F.col("long") & (F.col("rest") > 0)
    block = cut_lineage(block.withColumn("cut", misfit)
                        .withColumn("extra", F.when(F.col("long"), F.col("taken")).otherwise(here & (F.col("cut").isNull() | (F.col("pos") < F.col("cut")))))
                        .withColumn("part", F.coalesce(F.col("pos") == F.col("cut"), F.lit(False)) & here)
                        .withColumn("offers", F.coalesce((F.col("pos") >= F.col("cut")) & (F.col("pos") < F.col("cut") + PARTS), F.lit(False)) & here)
                        .withColumn("left", F.col("rest") - (F.col("upto") - F.col("w")))
                        .select("number", "block", "pos", "long", "rounds", "extra", "part", "offers", "left"))
    # uses of blocks in order: whole rounds, then the drawn ones (a partly drawn block is a use as well)
    run = Window.partitionBy("number").orderBy("round", "long", "pos")
    uses = (block.withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds"))))
            .where((F.col("round") < F.col("rounds")) | F.col("extra") | F.col("part"))
            .withColumn("at", F.row_number().over(run) - 1)
            .select("number", "block", "at", "left", (F.col("part") & (F.col("round") == F.col("rounds"))).alias("part")))
    uses = cut_lineage(uses)
    leaf = split_tree(uses.groupBy("number").agg(F.count("*").alias("blocks")), shards, seed)
    run = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaf = (leaf.withColumn("lo", F.coalesce(F.sum("blocks").over(run), F.lit(0))).where("blocks > 0")
            .select("number", "shard", "lo", (F.col("lo") + F.col("blocks")).alias("hi")))
    uses = cut_lineage(uses.join(leaf, "number").where("at >= lo and at < hi").drop("lo", "hi"))
    blocks = cut_lineage(uses.where("not part").groupBy("number", "block").agg(F.sort_array(F.collect_list("shard")).alias("uses")))

    # documents of the partly drawn blocks, about PARTS * sqrt(n) a source, largest first, while they fit
    use = uses.where("part").select("number", F.col("shard").alias("use"), "left")
    offered = block.where("offers").select("number", "block").join(bounded(use), "number")
    cand = (tagged.join(bounded(offered), ["number", "block"])
            .groupBy("number", "use", "left", "id").agg(F.sum("size").alias("size"))
            .groupBy("number", "use", "left")
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), F.xxhash64(F.lit(seed + 2), "id").alias("h"), "id"))).alias("docs")))
    fit = F.aggregate(
        "docs", F.struct(F.col("left").cast("double").alias("left"), F.array().cast("array<bigint>").alias("ids")),
        lambda a, d: F.when((-d["s"] <= a["left"]) & (d["s"] < 0) & d["id"].isNotNull(),
                            F.struct((a["left"] + d["s"]).alias("left"), F.concat(a["ids"], F.array(d["id"])).alias("ids"))).otherwise(a))
    picked = cut_lineage(cand.select("number", "use", F.explode(fit["ids"]).alias("id")))
    return {"sources": src, "longs": longs, "blocks": blocks, "picked": picked, "uses": uses}


def bounded(t: DataFrame) -> DataFrame:
    """``t``, to be broadcast if its counted rows are within ``BROADCAST_BLOCKS``."""
    return F.broadcast(t) if t.count() <= BROADCAST_BLOCKS else t


def _numbered(rows: DataFrame, src: DataFrame) -> DataFrame:
    """``rows`` with their source's number, blocks and words."""
    small = bounded(src.select(F.col("source").alias("_s"), "number", "n_blocks", F.col("words").alias("_words")))
    return rows.join(small, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def long_documents(rows: DataFrame, src: DataFrame, seed: int = SEED) -> DataFrame:
    """``(number, id, long_block)`` of the ids with a row longer than the mean block of their source.

    Fewer than ``n_blocks`` a source, numbered from ``n_blocks`` on.
    """
    numbered = _numbered(rows, src).where(F.col("id").isNotNull() & (F.col("size") * F.col("n_blocks") > F.col("_words")))
    ids = numbered.select("number", "n_blocks", "id").distinct()
    order = Window.partitionBy("number").orderBy(F.xxhash64(F.lit(seed + 4), "id"), "id")
    return cut_lineage(ids.select("number", "id", (F.col("n_blocks") + F.row_number().over(order) - 1).alias("long_block")))


def settle_long(block: DataFrame, order, seed: int = SEED) -> DataFrame:
    """``block`` with ``taken`` (long documents that are drawn) and ``rest`` lowered by their words.

    ``order`` is the hashed order of a source's long (or other) blocks. A source's
    long documents are drawn with probability ``rest / words`` and taken up to the
    first that does not fit any more; while the other documents could not fill
    what is left, the shortest ones not drawn are added as far as they fit.
    """
    every = Window.partitionBy("number")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = F.col("long") & (F.col("w") <= F.col("rest")) & (_uniform(F.lit(seed + 5), "number", "block") * F.col("words") < F.col("rest"))
    out = block.withColumn("_drawn", drawn)
    out = out.withColumn("taken", F.col("_drawn") & (F.sum(F.when(F.col("_drawn"), F.col("w")).otherwise(0)).over(upto) <= F.col("rest")))
    out = out.withColumn("_left", F.col("rest") - F.sum(F.when(F.col("taken"), F.col("w")).otherwise(0)).over(every))
    out = out.withColumn("_others", F.sum(F.when(~F.col("long"), F.col("w")).otherwise(0)).over(every))
    more = F.when(F.col("long") & ~F.col("taken"), F.col("w")).otherwise(0)
    rising = Window.partitionBy("number").orderBy("w", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with_it = F.sum(more).over(rising)
    added = (more > 0) & (F.col("_left") - (with_it - more) > F.col("_others")) & (with_it <= F.col("_left"))
    out = out.withColumn("taken", F.col("taken") | added)
    rest = F.col("rest") - F.sum(F.when(F.col("taken"), F.col("w")).otherwise(0)).over(every)
    return out.withColumn("rest", rest).drop("_drawn", "_left", "_others")


def with_block(rows: DataFrame, src: DataFrame, longs: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` with the number of their source and their block."""
    return (_numbered(rows, src).drop("_words").join(bounded(longs), ["number", "id"], "left")
            .withColumn("block", F.coalesce("long_block", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("n_blocks")))).drop("n_blocks", "long_block"))


def apply_plan(rows: DataFrame, decided: dict[str, DataFrame], seed: int = SEED) -> DataFrame:
    """``rows`` (with id and source) plus ``number`` and ``uses``: the shards that take the row, once per use."""
    part = decided["picked"].groupBy("number", "id").agg(F.sort_array(F.collect_list("use")).alias("_part"))
    out = (with_block(rows, decided["sources"], decided["longs"], seed)
           .join(bounded(decided["blocks"]), ["number", "block"], "left")
           .join(bounded(cut_lineage(part)), ["number", "id"], "left"))
    none = F.array().cast("array<int>")
    return out.withColumn("uses", F.concat(F.coalesce("uses", none), F.coalesce("_part", none))).drop("_part", "block")


def mix_report(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, size, source_size, target, taken, shards)`` for every row of ``docs``.

    shards: the output shards that take the row, comma-joined. Defined cases: a
    null text has size 0; a null source is a source of its own, ordered last;
    rows without an id are never in a partly drawn block's choice; rows of size
    0 take nothing; repeated rows are rows of their own and share their fate;
    other columns are never read; an empty table gives an empty result.
    """
    rows = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                                   words_of(F.col(text_col).cast("string")).alias("size")))
    decided = plan(rows, shards)
    out = apply_plan(rows, decided).join(bounded(decided["sources"].select("number", F.col("words").alias("source_size"), "target")), "number")
    return out.select(F.col("id").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                      (F.col("size") * F.size("uses")).cast("long").alias("taken"), F.array_join(F.col("uses").cast("array<string>"), ",").alias("shards"))


def mixed_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", place: bool = True) -> DataFrame:
    """The mixed rows: every row of ``docs`` as often as it is taken, all columns unchanged.

    With ``place`` the columns ``mix_shard`` and ``mix_order`` (a hash to sort by
    within the shard) are added; it is an error if ``docs`` has such columns then.
    Null texts have size 0 and rows of size 0 are not taken unless their block
    is; a null source is a source of its own; repeated rows share their fate; an
    empty table gives an empty result.
    """
    if place and {"mix_shard", "mix_order"} & set(docs.columns):
        raise ValueError("docs has a column mix_shard or mix_order already")
    tagged = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.struct(*docs.columns).alias("row"))
    sizes = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                                    words_of(F.col(text_col).cast("string")).alias("size")))
    out = apply_plan(tagged, plan(sizes, shards)).select("id", "row", F.posexplode("uses").alias("use", "shard"))
    order = F.xxhash64(F.lit(SEED + 3), "id", "use")
    return out.select("row.*", *([F.col("shard").alias("mix_shard"), order.alias("mix_order")] if place else []))


def write_shards(mixed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Writes placed rows under ``path/mix_shard=N``, each file a hash range in local order."""
    spread = F.pmod(F.shiftright("mix_order", 40), F.lit(max(1, mixed.count() // rows_per_file))).cast("int")
    (mixed.withColumn("_f", spread).repartition("mix_shard", "_f").sortWithinPartitions("mix_shard", "_f", "mix_order")
     .drop("_f").write.mode("overwrite").partitionBy("mix_shard").parquet(path))
