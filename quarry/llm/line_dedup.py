"""Line deduplication with SQL functions: drop the lines that many documents share.

1. Texts are exploded to lines; a line's key is the line without white space at
   its ends, A-Z lower-cased, and two 64-bit hashes stand for it. Only hashes,
   ids and positions travel from here on, never the lines.
2. One aggregate per key (partial before its shuffle, so a line that stands in
   every document costs one row per task): the smallest id that holds it, and
   whether enough documents do.
3. Lines of shared keys outside the smallest document become the positions to
   drop. Keys with more than 1 in ``HOT_SHARE`` of all lines are fewer than
   ``HOT_SHARE`` by arithmetic, so they are broadcast; the lines of all other
   keys meet theirs in a shuffled join that no key can skew.
4. Texts meet their positions in one join by id and text hash and are put
   together again by position inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

BLANK = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is hot if it has more than this part of all lines; at most so many keys are.
HOT_SHARE = 10_000
_NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text, and the pair that names a row: rows without an id count as one last document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
            .select("id", "text", F.coalesce("id", F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("row")))


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """``(doc, row, pos, h1, h2)`` of every line whose key has ``min_chars`` code points."""
    return (rows.select("doc", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .select("doc", "row", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
            .select("doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))


def shared_keys(lines: DataFrame, min_docs: int = 2) -> DataFrame:
    """``(h1, h2, owner, n)`` of the keys that at least ``min_docs`` documents hold."""
    least = [F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count("*").alias("n")]
    if min_docs <= 2:          # two documents hold a key if its smallest and its largest id differ: one shuffle
        enough = F.col("owner") < F.col("last") if min_docs == 2 else F.lit(True)
        return lines.groupBy("h1", "h2").agg(*least).where(enough).drop("last")
    found = lines.groupBy("h1", "h2").agg(*least, F.count_distinct("doc").alias("docs"))
    return found.where(F.col("docs") >= min_docs).drop("last", "docs")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                min_chars: int = 10) -> DataFrame:
    """``(<id_col>, n_lines, n_dropped, kept)``: every text without its repeated lines.

    Lines end at ``\\n``. A key of at least ``min_chars`` code points that at
    least ``min_docs`` documents hold loses all its lines outside the document
    with the smallest id that holds it (there, all of them stay). Other lines
    stay in their order.

    Defined cases: a null or empty text is one empty line; a text that loses all
    lines becomes empty; rows of one id are one document, whatever their texts;
    rows without an id count together as one document after all others; equal
    rows get equal results; other columns are never read; an empty table gives
    an empty result. Lines of any length and number are read whole.
    """
    rows = _rows(docs, id_col, text_col)
    lines = cut_lineage(_lines(rows, min_chars))
    shared = cut_lineage(shared_keys(lines, min_docs))
    limit = lines.count() / HOT_SHARE
    outside = F.col("doc") != F.col("owner")
    hot = F.broadcast(shared.where(F.col("n") > limit).drop("n"))       # fewer than HOT_SHARE rows
    cold = shared.where(F.col("n") <= limit).drop("n")
    gone = (lines.join(hot, ["h1", "h2"]).where(outside).select("doc", "row", "pos")
            .unionByName(lines.join(hot, ["h1", "h2"], "left_anti").join(cold, ["h1", "h2"]).where(outside)
                         .select("doc", "row", "pos")))
    # equal rows of one id would list each position once a row
    gone = gone.groupBy("doc", "row").agg(F.collect_set("pos").alias("gone"))
    # the lines travel as an array, so that no expression splits a text twice
    parts = rows.select("id", "doc", "row", F.split("text", "\n").alias("lines")).join(gone, ["doc", "row"], "left")
    n = F.size("lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return parts.select(F.col("id").alias(id_col), n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"),
                        F.array_join(kept, "\n").alias("kept"))
