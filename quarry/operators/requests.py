"""Serving-log analytics (A17-A21, W7, W8, S16 helpers).

``request_log`` maps a raw event table onto the request-log shape used here:
request_id, ts (timestamp instant), ts_ntz (wall clock), start_us/end_us
(epoch microseconds), latency_s, status, reason, confidence, input_key,
user_id, day. Nothing depends on the session time zone.

Percentiles are exact and distributed (``ranges.exact_percentiles``).

Panels read the log once: one grouped aggregate over the columns a panel needs,
whose few rows are then turned into the panel's sections.

Concurrency (W7) sums starts and ends per instant, then runs one sum over the
instants in ranges of equal row counts (``ranges.running_before``), so a burst is
spread like any other stretch; arrivals within an instant have a closed form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranges import exact_percentiles, running_before

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
PANEL_PERCENTILES = (0.50, 0.75, 0.90, 0.95, 0.99)
SLA_P95_SECONDS = 3.0               # SLA: P95 latency under 3 s
REVIEW_CONFIDENCE = 0.95            # below this, a result goes to human review
RETENTION_DAYS = 30
OFF_PEAK_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)     # 10 PM to 6 AM
# ---------------------------------------------------------------------------

US = 1_000_000


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` wall-clock value (no time zone involved)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c)


def micros_ntz(c: Column) -> Column:
    """Inverse of ``ntz_micros``."""
    return F.timestamp_add("MICROSECOND", c, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def request_log(events: DataFrame) -> DataFrame:
    """Events -> request log (bindings of FIXTURES: latency = value seconds,
    failed = event_type 'error', confidence = (100 - k) / 100, input = user|k).

    Times do not depend on the session time zone: ``start_us``/``end_us`` are
    epoch microseconds of the wall-clock ``ts_ntz`` read as UTC, ``ts`` is that
    instant as a ``timestamp`` (for watermarks and windows), and ``day`` and
    hours are taken from ``ts_ntz``.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    is_ntz = events.schema["ts"].dataType.typeName() == "timestamp_ntz"
    ts_ntz = F.col("ts") if is_ntz else micros_ntz(F.unix_micros(F.col("ts")))
    start = ntz_micros(ts_ntz)
    return events.select(
        F.col("event_id").alias("request_id"), F.timestamp_micros(start).alias("ts"), ts_ntz.alias("ts_ntz"),
        F.col("user_id"),
        start.alias("start_us"),
        (start + F.round(F.col("value") * US).cast("long")).alias("end_us"),
        F.col("value").alias("latency_s"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.col("event_type").alias("reason"),
        ((F.lit(100) - k) / F.lit(100.0)).alias("confidence"),
        F.concat_ws("|", F.col("user_id").cast("string"), k.cast("string")).alias("input_key"),
        F.to_date(ts_ntz).alias("day"))


def latency_panel(log: DataFrame, latency_col: str = "latency_s", by: Sequence[str] = (),
                  percentiles: Sequence[float] = PANEL_PERCENTILES, sla: float = SLA_P95_SECONDS) -> DataFrame:
    """Requests, P50/P75/P90/P95/P99/max and the SLA flag (P95 under ``sla`` seconds)."""
    out = exact_percentiles(log, latency_col, percentiles, by)
    cols = [F.round(F.col("p")[i], 6).alias(f"p{int(round(p * 100))}") for i, p in enumerate(percentiles)]
    out = out.select(*by, F.col("n").alias("requests"), *cols, F.round("max", 6).alias("max"))
    return out.withColumn("sla_ok", F.col("p95") < F.lit(sla))


def _sections(counted: DataFrame, entries: Sequence[tuple[str, Column, Column | None]]) -> DataFrame:
    """``(section, key, n)`` summed from rows with a count ``n``: each entry is (section, key, condition)."""
    items = [F.when(F.lit(True) if cond is None else cond,
                    F.struct(F.lit(name).alias("section"), key.cast("string").alias("key"), F.col("n"))) for name, key, cond in entries]
    return (counted.select(F.explode(F.array(*items)).alias("e")).where("e is not null").select("e.*")
            .groupBy("section", "key").agg(F.sum("n").alias("n")))


def request_panel(log: DataFrame) -> DataFrame:
    """Totals by status with percents, failures by reason, mean requests per day.

    Long form ``(section, key, n, percent)`` from one aggregate by status, reason and day.
    """
    counted = log.groupBy("status", "reason", "day").agg(F.count(F.lit(1)).alias("n"))
    failed = F.col("status") == "failed"
    s = _sections(counted, [("status", F.col("status"), None), ("failure_reason", F.col("reason"), failed),
                            ("total", F.lit("requests"), None), ("per_day", F.col("day"), None)])
    share = F.try_divide(F.lit(100.0) * F.col("n"), F.sum("n").over(Window.partitionBy("section")))
    s = s.withColumn("percent", F.when(F.col("section") != "per_day", F.round(share, 6)))
    daily = F.col("section") == "per_day"
    out = (s.groupBy("section", F.when(daily, F.lit("mean")).otherwise(F.col("key")).alias("key"))
           .agg(F.round(F.avg(F.col("n").cast("double")), 6).alias("n"), F.max("percent").alias("percent")))
    empty = log.sparkSession.createDataFrame([("total", "requests", 0.0, 100.0), ("per_day", "mean", None, None)],
                                             "section string, key string, n double, percent double")
    return out.unionByName(empty.join(out.select("section").distinct(), "section", "left_anti"))


def review_reason(log: DataFrame, threshold: float = REVIEW_CONFIDENCE, added_col: str | None = "n_added") -> Column:
    """T3/A19 routing rule: failed, else confidence under the threshold, else terms added by the
    output (when the log carries an added-terms count, see U3), else null (publish)."""
    r = (F.when(F.col("status") == "failed", F.lit("failed"))
          .when(F.col("confidence") < F.lit(threshold), F.lit("low_confidence")))
    if added_col and added_col in log.columns:
        r = r.when(F.col(added_col) > 0, F.lit("added_terms"))
    return r


def review_panel(log: DataFrame, threshold: float = REVIEW_CONFIDENCE,
                 decisions: DataFrame | None = None) -> DataFrame:
    """Review queue size and share, split by reason; with a reviewer decision table
    ``(request_id, decision)`` ('approved' / 'revised') also the approval and revision rates
    among reviewed items."""
    r = log.withColumn("review_reason", review_reason(log, threshold))
    decision = F.lit(None).cast("string")
    if decisions is not None:
        r = r.join(decisions.select("request_id", F.col("decision").alias("_decision")), "request_id", "left")
        decision = F.when(F.col("review_reason").isNotNull(), F.col("_decision"))
    counted = r.groupBy("review_reason", decision.alias("decision")).agg(F.count(F.lit(1)).alias("n"))
    queued = F.col("review_reason").isNotNull()
    s = _sections(counted, [("all", F.lit("all"), None), ("queue", F.lit("all"), queued), ("reason", F.col("review_reason"), queued),
                            ("decision", F.col("decision"), F.col("decision").isNotNull())])
    whole = Window.partitionBy()                           # a handful of rows
    total = F.sum(F.when(F.col("section") == "all", F.col("n"))).over(whole)
    of = F.when(F.col("section") == "queue", total).otherwise(F.sum("n").over(Window.partitionBy("section")))
    out = s.withColumn("percent", F.round(F.try_divide(F.lit(100.0) * F.col("n"), of), 6)).where("section <> 'all'")
    # an empty queue still has its row
    idle = log.sparkSession.createDataFrame([("queue", "all", 0, None)], "section string, key string, n long, percent double")
    return out.unionByName(idle.join(out.select("section").distinct(), "section", "left_anti"))


def cache_hit_rate(log: DataFrame, key_col: str = "input_key", by_day: bool = True) -> DataFrame:
    """Requests whose input was served before (per day or over all): requests less first occurrences.

    One aggregate by (input, day); the first occurrence of an input is on its
    earliest day, so neither the log nor a hot input is joined or ranked.
    """
    daily = log.groupBy(key_col, "day").agg(F.count(F.lit(1)).alias("_n"))
    first = F.when(F.col("day") == F.min("day").over(Window.partitionBy(key_col)), 1).otherwise(0)
    g = daily.withColumn("_first", first).groupBy(*(["day"] if by_day else []))
    return (g.agg(F.sum("_n").alias("requests"), (F.sum("_n") - F.sum("_first")).alias("hits"))
             .withColumn("hit_rate", F.round(F.try_divide(F.col("hits"), F.col("requests")), 6)))


def before_after(df: DataFrame, answer_col: str, phase_col: str, value_col: str | None = None,
                 phases: Sequence[str] = ("before", "after")) -> DataFrame:
    """Share of each answer per phase, percent change, and mean value per arm (one read)."""
    b, a = phases
    aggs = []
    for p in phases:
        here = F.col(phase_col) == p
        aggs.append(F.count_if(here).alias(f"n_{p}"))
        if value_col:
            aggs.append(F.round(F.avg(F.when(here, F.col(value_col))), 6).alias(f"mean_{p}"))
    every = Window.partitionBy()                           # one row per answer
    out = df.groupBy(answer_col).agg(*aggs).where(F.col(f"n_{b}") + F.col(f"n_{a}") > 0)
    for p in phases:
        out = out.withColumn(f"share_{p}", F.try_divide(F.col(f"n_{p}"), F.sum(f"n_{p}").over(every)))
    change = F.try_divide(F.col(f"share_{a}") - F.col(f"share_{b}"), F.col(f"share_{b}")) * 100
    return (out.withColumn("change_pct", F.round(change, 6))
               .withColumn(f"share_{b}", F.round(F.col(f"share_{b}") * 100, 6))
               .withColumn(f"share_{a}", F.round(F.col(f"share_{a}") * 100, 6)))


def active_counts(log: DataFrame) -> DataFrame:
    """Per instant ``t``: starts, ends and the active count before it (half-open intervals [start, end))."""
    ev = log.select(F.explode(F.array(
        F.struct(F.col("start_us").alias("t"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
        F.struct(F.col("end_us").alias("t"), F.lit(0).alias("starts"), F.lit(1).alias("ends")))).alias("e")).select("e.*")
    instants = ev.groupBy("t").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    return running_before(instants.withColumn("delta", F.col("starts") - F.col("ends")), "t", "delta", name="active_before")


def concurrency(log: DataFrame) -> DataFrame:
    """Maximum simultaneous requests; the active count at arrivals and the queue ahead of an arrival, mean and maximum.

    At an instant ends come first; its s arrivals then see 1 .. s more active
    requests than before, which sums in closed form.
    """
    a = active_counts(log).withColumn("left", F.col("active_before") - F.col("ends"))
    seen = F.col("starts") * F.col("left") + F.col("starts") * (F.col("starts") + 1) / 2
    some = F.col("starts") > 0
    return a.agg(F.max(F.when(some, F.col("left") + F.col("starts"))).alias("max_concurrent"),
                 F.round(F.try_divide(F.sum(seen), F.sum("starts")), 6).alias("mean_active_at_arrival"),
                 F.round(F.try_divide(F.sum(seen), F.sum("starts")) - 1, 6).alias("mean_queue_ahead"),
                 F.max(F.when(some, F.col("left") + F.col("starts") - 1)).alias("max_queue_ahead"))


def peaks(log: DataFrame, off_peak_hours: Sequence[int] = OFF_PEAK_HOURS) -> DataFrame:
    """Busiest hour of day and busiest day (ties -> earliest), mean per day, requests per off-peak hour.

    One aggregate by day and hour. The off-peak rate counts every off-peak hour
    of the days that the log covers, hours without requests included.
    """
    counted = log.groupBy("day", F.hour("ts_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    off = F.col("hour").isin(list(off_peak_hours))
    s = _sections(counted, [("busiest_hour", F.format_string("%02d", "hour"), None), ("busiest_day", F.col("day"), None),
                            ("mean_per_day", F.col("day"), None), ("off_peak_per_hour", F.lit(""), off)])
    days = F.count_if(F.col("section") == "busiest_day").over(Window.partitionBy())     # one row per day and hour of day
    s = s.withColumn("_days", days)
    g = s.groupBy(F.col("section").alias("metric")).agg(
        F.min_by(F.struct("key", "n"), F.struct(-F.col("n"), F.col("key"))).alias("top"), F.avg("n").alias("mean"),
        F.sum("n").alias("sum"), F.max("_days").alias("days"))
    busiest = F.col("metric").startswith("busiest")
    key = F.when(F.col("metric") == "busiest_hour", F.col("top.key").cast("int").cast("string")).when(busiest, F.col("top.key")).otherwise("")
    value = (F.when(busiest, F.col("top.n").cast("double")).when(F.col("metric") == "mean_per_day", F.round("mean", 6))
             .otherwise(F.round(F.try_divide(F.col("sum"), F.col("days") * len(off_peak_hours)), 6)))
    return g.select("metric", key.alias("key"), value.alias("value"))


def retention_cutoff_us(as_of: str, days: int) -> Column:
    """``as_of - days`` in epoch microseconds (``as_of`` a wall-clock date-time, read as UTC)."""
    return ntz_micros(F.lit(as_of).cast("timestamp_ntz")) - F.lit(int(days) * 86_400 * US)
