"""JSON-lines input and output.

Line numbers: Spark's text reader gives no line number, and a window over a
whole file would put the file in one task. ``indexed_lines`` numbers lines
exactly and in parallel: every row knows its file and the start offset of
its split (``_metadata``); rows inside a split arrive in file order, so a
per-split rank plus the running count of the earlier splits (one small row
per split) is the line's position. Blank lines (after strip) are not counted,
like the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import stripped

CALIBRATION_SCHEMA = T.StructType([T.StructField("text", T.StringType()),
                                   T.StructField("source", T.StringType()),
                                   T.StructField("type", T.StringType())])


def indexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with ``file`` and 1-based ``line_no`` among non-blank lines (per file)
    and ``pos`` (0-based, over all files in path order)."""
    t = (spark.read.text(path)
              .select(F.col("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("_m"))
              .filter(stripped("value") != F.lit("")))
    sizes = t.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before_all = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offs = (sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                 .withColumn("_goff", F.coalesce(F.sum("_n").over(before_all), F.lit(0))))  # one row per split
    w = Window.partitionBy("file", "block").orderBy("_m")
    # one row per split: small, but it grows with the input, so AQE decides on a broadcast
    return (t.join(offs.select("file", "block", "_off", "_goff"), ["file", "block"])
             .withColumn("_r", F.row_number().over(w))
             .select(F.col("value").alias("line"), "file",
                     (F.col("_off") + F.col("_r")).alias("line_no"),
                     (F.col("_goff") + F.col("_r") - 1).alias("pos")))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = CALIBRATION_SCHEMA,
               max_samples: int | None = None) -> DataFrame:
    """One JSON object per line, blank lines skipped, a malformed line fails the job (FAILFAST).

    Spark's JSON reader reads the files; only a cap needs line numbers, and then
    only the first ``max_samples`` lines (in path and line order) are parsed.
    """
    if max_samples is None:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = indexed_lines(spark, path).filter(F.col("pos") < F.lit(max_samples))
    parsed = lines.select("pos", F.from_json(stripped("line"), schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def read_jsonl_checked(spark: SparkSession, path: str,
                       schema: T.StructType = CALIBRATION_SCHEMA) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good rows, bad lines with file and 1-based index, counts (total, valid, bad)).

    An empty input (no non-blank line) is an error, raised when the counts are read.
    """
    s = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

    def parsed(lines: DataFrame) -> DataFrame:
        r = lines.withColumn("r", F.from_json(stripped("line"), s, mode))
        return r.withColumn("is_bad", F.col("r").isNull() | F.col("r._corrupt").isNotNull())

    plain = parsed(spark.read.text(path).select(F.col("value").alias("line")).filter(stripped("line") != F.lit("")))
    good = plain.filter(~F.col("is_bad")).select(*[F.col(f"r.{f.name}") for f in schema.fields])
    bad = parsed(indexed_lines(spark, path)).filter("is_bad").select("file", "line_no", "line")   # line numbers for these only
    counts = plain.agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("is_bad")).alias("valid"),
                       F.count_if("is_bad").alias("bad"))
    counts = counts.withColumn(
        "total", F.when(F.col("total") > 0, F.col("total")).otherwise(F.raise_error(F.lit("File is empty"))))
    return good, bad, counts


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line (a folder of part files), replacing earlier output."""
    df.write.mode("overwrite").json(path)


def sample_stats(df: DataFrame, source_col: str = "source", type_col: str = "type") -> DataFrame:
    """S8 content, long form ``(section, key, n)``: total, counts by source and by type (missing -> 'unknown').

    One aggregate by (source, type); its rows give all three sections.
    """
    def name(c: str):
        return F.coalesce(F.col(c), F.lit("unknown")) if c in df.columns else F.lit("unknown")

    g = df.groupBy(name(source_col).alias("s"), name(type_col).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    entry = F.explode(F.array(F.struct(F.lit("total").alias("section"), F.lit("all").alias("key")),
                              F.struct(F.lit("sources").alias("section"), F.col("s").alias("key")),
                              F.struct(F.lit("types").alias("section"), F.col("t").alias("key"))))
    return g.select(entry.alias("e"), "n").groupBy("e.section", "e.key").agg(F.sum("n").alias("n"))


def write_stats(df: DataFrame, path: str, **kw) -> None:
    """The stats sidecar as JSON lines, one per section entry."""
    sample_stats(df, **kw).write.mode("overwrite").json(path)
