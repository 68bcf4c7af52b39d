"""Connected components of a link table by minimum-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saver
from quarry.session import cut_lineage, scratch


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id that occurs in ``links``; component is the smallest id reachable.

    Every round takes the minimum over the neighbours (a partial aggregate
    before the shuffle, so a hot vertex costs one row per task) and then jumps
    to the label of the label. The labels are written to the checkpoint folder
    each round, so a lost executor costs at most one round. Null ends are
    ignored; an empty table gives an empty result.
    """
    spark = links.sparkSession
    with scratch(spark, "components") as folder:
        save = saver(spark, folder)
        e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
        edges = save(e.union(e.select("v", "u")).distinct())
        labels = save(edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m"))
                      .select("id", F.least("id", "m").alias("component")))
        while True:
            near = (edges.join(labels.withColumnRenamed("id", "v"), "v")
                    .groupBy(F.col("u").alias("id")).agg(F.min("component").alias("m")))
            step = labels.join(near, "id").select("id", "component", F.least("component", "m").alias("m"))
            jump = labels.select(F.col("id").alias("m"), F.col("component").alias("c2"))
            new = save(step.join(jump, "m", "left")
                       .select("id", F.least("m", "c2").alias("component"),
                               (F.least("m", "c2") < F.col("component")).alias("moved")))
            labels = new.select("id", "component")
            if not new.where("moved").limit(1).count():
                return cut_lineage(labels)
