"""Evaluation metrics and reports (A12-A14, J2, J3, P16, W9, S12, K5 lines).

Metric tables are long: ``(run or phase, metric, value)``. Comparisons are
joins on the metric name against an ordered metric list that is a small
literal table (its size is the list the caller passes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage, ship_package

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
METRIC_PREFERENCE = ("acc", "acc_norm", "exact_match")      # first present wins
DEFAULT_COMPARE_METRICS = ("ppl_wikitext2", "ppl_c4", "task_hellaswag", "task_arc_easy", "task_mmlu",
                           "latency_ms", "throughput_tps")
SPEED_GOOD = 5.0       # tokens/s: >= 5 good, >= 1 slow, else very slow
SPEED_SLOW = 1.0
# ---------------------------------------------------------------------------


def pick_metric(df: DataFrame, preference: Sequence[str] = METRIC_PREFERENCE,
                keep_cols: Sequence[str] = ()) -> DataFrame:
    """First present metric of the preference list; else the whole record as JSON in ``raw``."""
    present = [c for c in preference if c in df.columns]
    name = None
    for c in present:
        cond = F.col(c).isNotNull()
        name = F.when(cond, F.lit(c)) if name is None else name.when(cond, F.lit(c))
    value = F.coalesce(*[F.col(c).cast("double") for c in present]) if present else F.lit(None).cast("double")
    name = name if name is not None else F.lit(None).cast("string")
    raw = F.when(value.isNull(), F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return df.select(*keep_cols, name.alias("metric_name"), value.alias("metric"), raw.alias("raw"))


def latency_by_batch(timings: DataFrame, batch_col: str = "batch_size", seconds_col: str = "seconds",
                     warmup_col: str = "warmup") -> DataFrame:
    """Per batch size, mean latency (ms), samples/s, total time, iterations; warm-up excluded."""
    t = timings.filter(~F.col(warmup_col))
    agg = t.groupBy(batch_col).agg(F.sum(seconds_col).alias("total_time"), F.count(F.lit(1)).alias("iterations"))
    avg_s = F.try_divide(F.col("total_time"), F.col("iterations"))
    return (agg.withColumn("avg_latency_ms", avg_s * 1000)
               .withColumn("throughput_samples_per_sec", F.try_divide(F.col(batch_col), avg_s)))


def throughput(gen: DataFrame, tokens_col: str = "tokens_generated", time_col: str = "time_seconds",
               by: Sequence[str] = ()) -> DataFrame:
    """tokens/s as sum of tokens over sum of time (not the mean of rates), the
    repeat-run variant (mean of per-row rates), items/s, mean latency, speed tier."""
    g = gen.groupBy(*by) if by else gen
    out = g.agg(F.sum(tokens_col).alias("total_tokens"), F.sum(time_col).alias("total_time"),
                F.count(F.lit(1)).alias("items"),
                F.avg(F.when(F.col(time_col) > 0, F.col(tokens_col) / F.col(time_col))).alias("mean_rate"),
                F.avg(time_col).alias("mean_latency_s"))
    tps = F.when(F.col("total_time") > 0, F.try_divide(F.col("total_tokens"), F.col("total_time"))).otherwise(F.lit(0.0))
    out = (out.withColumn("tokens_per_sec", tps)
              .withColumn("items_per_sec", F.when(F.col("total_time") > 0,
                                                  F.try_divide(F.col("items"), F.col("total_time")))))
    tier = (F.when(F.col("tokens_per_sec") >= SPEED_GOOD, F.lit("good"))
             .when(F.col("tokens_per_sec") >= SPEED_SLOW, F.lit("slow")).otherwise(F.lit("very slow")))
    return out.withColumn("speed_tier", tier)


def summary_metrics(ppl: DataFrame | None, tasks: DataFrame | None, latency: DataFrame | None,
                    run_cols: Sequence[str] = ()) -> DataFrame:
    """Long table of ``ppl_<dataset>``, ``task_<task>``, unweighted ``avg_perplexity`` /
    ``avg_task_score``, and batch-1 ``latency_ms`` / ``throughput_tps`` (samples per second,
    the historical key). Errors and non-numbers are left out; a stage without numbers has no row.

    Inputs: ``ppl (dataset, perplexity[, error])``, ``tasks (task, metric)``,
    ``latency (batch_size, avg_latency_ms, throughput_samples_per_sec)``.
    """
    rc = list(run_cols)
    parts = []
    if ppl is not None:
        p = ppl
        if "error" in p.columns:
            p = p.filter(F.col("error").isNull())
        p = p.filter(F.col("perplexity").isNotNull())
        parts.append(p.select(*rc, F.concat(F.lit("ppl_"), F.col("dataset")).alias("metric"),
                              F.col("perplexity").cast("double").alias("value")))
        g = p.groupBy(*rc) if rc else p
        parts.append(g.agg(F.avg("perplexity").alias("value")).filter(F.col("value").isNotNull())
                      .select(*rc, F.lit("avg_perplexity").alias("metric"), "value"))
    if tasks is not None:
        t = tasks.filter(F.col("metric").isNotNull())
        parts.append(t.select(*rc, F.concat(F.lit("task_"), F.col("task")).alias("metric"),
                              F.col("metric").cast("double").alias("value")))
        g = t.groupBy(*rc) if rc else t
        parts.append(g.agg(F.avg("metric").alias("value")).filter(F.col("value").isNotNull())
                      .select(*rc, F.lit("avg_task_score").alias("metric"), "value"))
    if latency is not None:
        b1 = latency.filter(F.col("batch_size") == 1)
        parts.append(b1.select(*rc, F.lit("latency_ms").alias("metric"),
                               F.col("avg_latency_ms").cast("double").alias("value")))
        parts.append(b1.select(*rc, F.lit("throughput_tps").alias("metric"),
                               F.coalesce(F.col("throughput_samples_per_sec"), F.lit(0.0)).cast("double")
                               .alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare(baseline: DataFrame, candidate: DataFrame, metrics: Sequence[str] = DEFAULT_COMPARE_METRICS,
            metric_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Per metric of the ordered list: baseline, candidate, delta, delta% (0 when the
    baseline is 0); a missing side leaves delta and delta% null (rendered N/A)."""
    spark = baseline.sparkSession
    order = spark.createDataFrame([(i, m) for i, m in enumerate(metrics)], "pos int, metric string")
    b = baseline.select(F.col(metric_col).alias("metric"), F.col(value_col).alias("baseline"))
    c = candidate.select(F.col(metric_col).alias("metric"), F.col(value_col).alias("candidate"))
    j = order.join(b, "metric", "left").join(c, "metric", "left")
    delta = F.col("candidate") - F.col("baseline")
    pct = F.when(F.col("baseline") == 0, F.lit(0.0)).otherwise(F.try_divide(delta, F.col("baseline")) * 100)
    return j.select("pos", "metric", "baseline", "candidate", delta.alias("delta"), pct.alias("delta_pct"))


def fmt_fixed(c: str | Column, digits: int = 3, sign: bool = False) -> Column:
    """``%.Nf`` like Python: half-even at exact ties (``bround``), then fixed digits.

    Java's formatter alone rounds exact ties up (0.8125 -> 0.813, Python 0.812).
    """
    x = F.col(c) if isinstance(c, str) else c
    # format_string renders null as text ("nul" at %.3f), so keep nulls null
    return F.when(x.isNotNull(), F.format_string(("%+." if sign else "%.") + f"{digits}f", F.bround(x, digits)))


def comparison_text(cmp: DataFrame) -> DataFrame:
    """J2 display strings: ``%.3f`` numbers, ``%+.1f%%`` change, ``N/A`` when a side is missing."""
    na = F.lit("N/A")
    both = F.col("baseline").isNotNull() & F.col("candidate").isNotNull()
    return cmp.select("pos", "metric",
                      F.coalesce(fmt_fixed("baseline"), na).alias("baseline_text"),
                      F.coalesce(fmt_fixed("candidate"), na).alias("candidate_text"),
                      F.when(both, fmt_fixed("delta")).otherwise(na).alias("delta_text"),
                      F.when(both, F.concat(fmt_fixed("delta_pct", 1, sign=True), F.lit("%")))
                       .otherwise(na).alias("delta_pct_text"))


def latest_run(metrics: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str = "ts") -> DataFrame:
    """Newest record per key by ``order`` (time, then an id for equal times); partial aggregation, no window."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in metrics.columns if c not in keys]
    latest = metrics.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return latest.select(*keys, "_r.*")


def sweep_gain(runs: DataFrame, param_col: str, quality_col: str, time_col: str) -> DataFrame:
    """Change in quality and time against the previous step of an ordered sweep.

    The sweep is one row per setting (tiny), so the un-partitioned ``lag`` is bounded.
    """
    w = Window.orderBy(param_col)
    prev_q, prev_t = F.lag(quality_col).over(w), F.lag(time_col).over(w)
    return (runs.withColumn("quality_change", F.col(quality_col) - prev_q)
                .withColumn("time_change_pct", F.try_divide(F.col(time_col) - prev_t, prev_t) * 100))


def _undominated(batches):
    """Rows of vectors (all measures lower-is-better) that no other one dominates, batch by batch; only those are held."""
    import numpy as np
    import pandas as pd

    held = None
    for pdf in batches:
        new = pdf.to_numpy(float)
        cols = pdf.columns
        both = new if held is None else np.vstack([held, new])
        # whoever dominates a vector has a smaller sum, so one pass in that order is enough
        both = both[np.lexsort((*both.T, both.sum(axis=1)))]
        keep = np.empty((0, both.shape[1]))
        for v in both:
            worse = (keep <= v).all(axis=1) & (keep < v).any(axis=1)
            if not worse.any():
                keep = np.vstack([keep, v])
        held = keep
    if held is not None and len(held):
        yield pd.DataFrame(held, columns=cols)


def skyline(runs: DataFrame, lower: Sequence[str], higher: Sequence[str] = ()) -> DataFrame:
    """The settings that no other one beats: as good in every measure and better in one.

    Small values of ``lower`` and large values of ``higher`` are better. The
    distinct measure vectors are reduced to local skylines per task, those are
    merged by fewer and fewer tasks, and the rows with a vector that is left
    come out. A task holds one skyline (the settings worth a choice), not its input.

    Defined cases: rows with a null or NaN measure are left out; rows of equal
    measures all stay; an empty table gives an empty result.
    """
    ship_package(runs.sparkSession)
    measures = [F.col(c).cast("double") for c in lower] + [-F.col(c).cast("double") for c in higher]
    names = [f"_m{i}" for i in range(len(measures))]
    known = runs.select("*", *[m.alias(n) for m, n in zip(measures, names)])
    for n in names:
        known = known.where(F.col(n).isNotNull() & ~F.isnan(n))
    schema = ", ".join(f"{n} double" for n in names)
    left = cut_lineage(known.select(*names).distinct().mapInPandas(_undominated, schema))
    parts = left.select(F.spark_partition_id()).distinct().count()
    while parts > 1:
        parts = -(-parts // 8)
        left = cut_lineage(left.repartition(parts).mapInPandas(_undominated, schema))
    return known.join(left, names, "left_semi").drop(*names)


def best_under(runs: DataFrame, quality_col: str, bound_col: str, bound: float,
               lower_is_better: bool = True, key_cols: Sequence[str] = ()) -> DataFrame:
    """The best setting subject to ``bound_col < bound``; ties go to the smallest ``key_cols``."""
    ok = runs.filter(F.col(bound_col) < F.lit(bound))
    q = F.col(quality_col) if lower_is_better else -F.col(quality_col)
    return ok.agg(F.min_by(F.struct(*runs.columns), F.struct(q, *key_cols)).alias("_b")).filter("_b is not null").select("_b.*")


def round_robin(df: DataFrame, items: DataFrame, order_col: str, item_order_col: str) -> DataFrame:
    """Row i (in ``order_col`` order) gets item ``i % k`` (items in ``item_order_col`` order).

    Both sides are numbered by ``global_index`` (no un-partitioned window) and joined on ``idx % k``.
    """
    from quarry.operators.packing import global_index
    k = items.select(F.count(F.lit(1))).scalar()
    it = global_index(items, item_order_col, "item_pos")
    rows = global_index(df, order_col).withColumn("item_pos", F.pmod(F.col("idx"), k))
    return rows.join(it, "item_pos")


def report_text(lines: DataFrame, key: Sequence[str] | str, pos_col: str = "pos", line_col: str = "line",
                sep: str = "\n") -> DataFrame:
    """K5: one text per report key from (key, pos, line) rows; a report is bounded by its sections."""
    keys = [key] if isinstance(key, str) else list(key)
    return lines.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos_col, line_col))),
                                 lambda s: s[line_col]), sep).alias("report"),
        F.count(F.lit(1)).alias("n_lines"))


def bar(score: str | Column, width: int = 40, char: str = "=") -> Column:
    """K5 text variant: a bar of ``int(score * width)`` signs."""
    n = F.floor(F.col(score) * width if isinstance(score, str) else score * width).cast("int")
    return F.repeat(F.lit(char), F.greatest(n, F.lit(0)))


def category_bars(categories: DataFrame, category_col: str = "category", score_col: str = "score") -> DataFrame:
    """K5 text variant: ``category | percent | bar`` lines, one per category (score 0..1)."""
    line = F.concat(F.rpad(category_col, 25, " "), F.lit(" "), F.lpad(fmt_fixed(F.col(score_col) * 100, 1), 5, " "), F.lit("% |"), bar(score_col))
    return categories.select(F.col(category_col), line.alias("line"))


# Headings of the report sections, in order.
SECTIONS = ("# Evaluation Report", "## Model Information", "## Hardware Configuration", "## Summary Metrics",
            "## Perplexity Results", "## Task Evaluation Results", "## Latency Measurements")
SUMMARY_HEAD = ("| Metric | Value |", "|--------|-------|")
LATENCY_HEAD = ("| Batch Size | Latency (ms) | Throughput (samples/s) |", "|------------|-------------|------------------------|")


def markdown_lines(summary: DataFrame, ppl: DataFrame | None = None, tasks: DataFrame | None = None, latency: DataFrame | None = None,
                   model: dict | None = None, hardware: dict | None = None, generated: str = "N/A") -> DataFrame:
    """K5 lines ``(pos, line)`` of a markdown report: header with the time, model, hardware, summary (three digits),
    perplexity and task results (three digits), latency table (two digits). A section without content is left out."""
    spark = summary.sparkSession

    def fixed(sec: int, lines: Sequence[str]) -> DataFrame:
        return spark.createDataFrame([((sec, i, ""), x) for i, x in enumerate(lines)],
                                     "pos struct<_sec:int,_no:int,_sort:string>, line string")

    def body(sec: int, rows: DataFrame, sort: Column, line: Column) -> DataFrame:
        return rows.select(F.struct(F.lit(sec).alias("_sec"), F.lit(99).alias("_no"), sort.cast("string").alias("_sort")).alias("pos"), line.alias("line"))

    def item(k: Column, v: Column) -> Column:
        return F.concat(F.lit("- **"), k, F.lit("**: "), v)

    parts = [fixed(0, [SECTIONS[0], f"Generated: {generated}"])]
    for sec, values in ((1, model), (2, hardware)):
        if values:
            parts.append(fixed(sec, [SECTIONS[sec], *[f"- **{k}**: {v}" for k, v in values.items()]]))
    parts += [fixed(3, [SECTIONS[3], *SUMMARY_HEAD]),
              body(3, summary, F.col("metric"), F.concat(F.lit("| "), F.col("metric"), F.lit(" | "), fmt_fixed("value", 3), F.lit(" |")))]
    if ppl is not None:
        rows = ppl.filter(F.col("perplexity").isNotNull())
        parts += [fixed(4, [SECTIONS[4]]), body(4, rows, F.col("dataset"), item(F.col("dataset"), fmt_fixed("perplexity", 3)))]
    if tasks is not None:
        rows = tasks.filter(F.col("metric").isNotNull())
        parts += [fixed(5, [SECTIONS[5]]), body(5, rows, F.col("task"), item(F.col("task"), fmt_fixed("metric", 3)))]
    if latency is not None:
        cells = [F.col("batch_size").cast("string"), F.coalesce(fmt_fixed("avg_latency_ms", 2), F.lit("N/A")),
                 F.coalesce(fmt_fixed("throughput_samples_per_sec", 2), F.lit("N/A"))]
        parts += [fixed(6, [SECTIONS[6], *LATENCY_HEAD]),
                  body(6, latency, F.lpad(F.col("batch_size").cast("string"), 12, "0"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
