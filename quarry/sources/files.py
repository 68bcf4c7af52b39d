"""File inventories and completeness checks over many directories.

``binaryFile`` lists files with their length; the ``content`` column is never
selected, so no file body is read (column pruning of the binary source).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.metrics import fmt_fixed

# Size units (each step divides by 1024; PB after TB).
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root``: path, directory, name, lower-cased extension (null if none), length."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return as_listing(files, "path", "length")


def as_listing(df: DataFrame, path: str | Column, length: str | Column) -> DataFrame:
    """A listing from any table with a path and a length per row (an object-store inventory, crawled addresses ...)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    files = df.select(col(path).alias("path"), col(length).cast("long").alias("length"))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))
    return files.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), name.alias("name"),
                        F.when(ext != "", ext).alias("ext"), "length")


def format_size(size: str | Column) -> Column:
    """Human size: divide by 1024 through B..TB, two decimals, then PB."""
    s = (F.col(size) if isinstance(size, str) else size).cast("double")
    out = None
    for i, unit in enumerate(SIZE_UNITS):
        cond = s < F.lit(1024.0 ** (i + 1))
        txt = F.concat(fmt_fixed(s / F.lit(1024.0 ** i), 2), F.lit(f" {unit}"))
        out = F.when(cond, txt) if out is None else out.when(cond, txt)
    return out.otherwise(F.concat(fmt_fixed(s / F.lit(1024.0 ** len(SIZE_UNITS)), 2), F.lit(" PB")))


def file_inventory(files: DataFrame) -> DataFrame:
    """S13 per directory: total bytes, file count, display size, and bytes per extension
    (files without an extension count in the total only)."""
    per_dir = files.groupBy("dir").agg(F.sum("length").alias("total_size_bytes"),
                                       F.count(F.lit(1)).alias("file_count"))
    per_ext = (files.filter(F.col("ext").isNotNull()).groupBy("dir", "ext").agg(F.sum("length").alias("b"))
                    .groupBy("dir").agg(F.map_from_entries(F.collect_list(F.struct("ext", format_size("b"))))
                                        .alias("extensions")))
    return (per_dir.join(per_ext, "dir", "left")
                   .withColumn("total_size", format_size("total_size_bytes")))


def missing_required(files: DataFrame, required: Sequence[str]) -> DataFrame:
    """(dir, name) of required names absent from each directory (left-anti join)."""
    dirs = files.select("dir").distinct()
    need = dirs.select("dir", F.explode(F.array(*[F.lit(r) for r in required])).alias("name"))
    return need.join(files.select("dir", "name"), ["dir", "name"], "left_anti")


def check_complete(files: DataFrame, required: Sequence[str], any_of: Sequence[str]) -> DataFrame:
    """Per directory, the missing required names, whether any file matches one of the
    ``any_of`` regexes, and the verdict (nothing missing and a match)."""
    miss = missing_required(files, required).groupBy("dir").agg(
        F.array_sort(F.collect_list("name")).alias("missing"))
    pattern = "|".join(f"(?:{p})" for p in any_of)
    has = files.groupBy("dir").agg(F.bool_or(F.col("name").rlike(pattern)).alias("has_match"))
    out = has.join(miss, "dir", "left").withColumn(
        "missing", F.coalesce("missing", F.array().cast("array<string>")))
    return out.withColumn("complete", (F.size("missing") == 0) & F.col("has_match"))
