"""Driver queries that run Structured Streaming jobs over ``events`` and read their sinks back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.catalog import register
from quarry.plans.queries_events import LOG_CTE, REVIEW_CTE, added_counts
from quarry.session import cut_lineage, scratch, table
from quarry.streaming import jobs

@register("stream_latency", f"WITH {LOG_CTE},\n" + """
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, latency_s, status FROM log)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS requests,
       count(*) FILTER (WHERE status = 'failed') AS failed, round(quantile_cont(latency_s, 0.5), 6) AS p50,
       round(quantile_cont(latency_s, 0.95), 6) AS p95, round(quantile_cont(latency_s, 0.95), 6) < 3.0 AS sla_ok
FROM w GROUP BY window_start
""")
def q_stream_latency(spark, sf_dir):
    """Hourly windows with watermark; all windows, the open one included, are read back from the sink."""
    with scratch(spark, "stream_latency") as out:
        data = jobs.run_updates(jobs.latency_counts(jobs.event_stream(spark, sf_dir)), out)
        counts = jobs.newest(spark, data, ["window_start", "window_end", "latency_s", "status"])
        return cut_lineage(jobs.latency_windows(cut_lineage(counts)))


@register("stream_latency_sketch", f"WITH {LOG_CTE},\n" + """
u AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, latency_s, status, greatest(round(latency_s * 1000000)::BIGINT, 0) AS us FROM log),
b AS (SELECT *, greatest(length(bin(us)) - 8, 0)::INTEGER AS shift FROM u),
v AS (SELECT *, (((us >> shift) << shift) + ((1::BIGINT << shift) >> 1)) / 1000000 AS value FROM b),
p AS (SELECT window_start, count(*) AS requests, count(*) FILTER (WHERE status = 'failed') AS failed, quantile_cont(value, 0.5) AS p50,
             quantile_cont(value, 0.95) AS p95, quantile_cont(latency_s, 0.5) AS e50, quantile_cont(latency_s, 0.95) AS e95 FROM v GROUP BY window_start)
SELECT window_start, requests, failed, round(p50 * 1e9)::BIGINT AS p50_ns, round(p95 * 1e9)::BIGINT AS p95_ns,
       abs(p50 - e50) <= e50 / 256 + 1e-6 AND abs(p95 - e95) <= e95 / 256 + 1e-6 AS within_bound FROM p
""")
def q_stream_latency_sketch(spark, sf_dir):
    """T1 with bounded state: hourly percentiles from the bucket counts, held against the exact batch panel."""
    from quarry.operators.ranges import exact_percentiles
    from quarry.operators.requests import request_log
    with scratch(spark, "stream_sketch") as out:
        data = jobs.run_updates(jobs.latency_sketch(jobs.event_stream(spark, sf_dir)), out)
        counts = cut_lineage(jobs.newest(spark, data, ["window_start", "window_end", "latency_s", "status"]))
    hour = F.date_trunc("hour", "ts_ntz").cast("timestamp_ntz").alias("window_start")
    exact = exact_percentiles(request_log(table(spark, sf_dir, "events")).select(hour, "latency_s"), "latency_s", [0.5, 0.95], ["window_start"])
    near = exact_percentiles(counts, "latency_s", [0.5, 0.95], ["window_start"], weight="n").select("window_start", F.col("p").alias("q"))
    total = counts.groupBy("window_start").agg(F.sum("n").alias("requests"),
                                               F.sum(F.when(F.col("status") == "failed", F.col("n")).otherwise(0)).alias("failed"))
    ok = F.lit(True)
    for i in range(2):
        ok = ok & (F.abs(F.col("q")[i] - F.col("p")[i]) <= F.col("p")[i] / 256 + 1e-6)
    return total.join(near, "window_start").join(exact.select("window_start", "p"), "window_start").select(
        "window_start", "requests", "failed", *[F.round(F.col("q")[i] * 1e9).cast("long").alias(n) for i, n in enumerate(("p50_ns", "p95_ns"))],
        ok.alias("within_bound"))


@register("stream_dedupe", f"WITH RECURSIVE {LOG_CTE},\n" + """
o AS (SELECT input_key, request_id, start_us, row_number() OVER (PARTITION BY input_key ORDER BY start_us, request_id) AS i FROM log),
walk(input_key, i, request_id, start_us, first_request, first_us) AS (
  SELECT input_key, i, request_id, start_us, request_id, start_us FROM o WHERE i = 1
  UNION ALL
  SELECT o.input_key, o.i, o.request_id, o.start_us,
         CASE WHEN o.start_us < w.first_us + 3600000000 THEN w.first_request ELSE o.request_id END,
         CASE WHEN o.start_us < w.first_us + 3600000000 THEN w.first_us ELSE o.start_us END
  FROM walk w JOIN o ON o.input_key = w.input_key AND o.i = w.i + 1)
SELECT input_key, first_request, first_us, count(*) AS requests, max(start_us) AS last_us FROM walk GROUP BY ALL
""")
def q_stream_dedupe(spark, sf_dir):
    """The answer to a request serves the same input for an hour; the requests that are computed and what each serves."""
    with scratch(spark, "stream_dedupe") as out:
        data = jobs.run_updates(jobs.serve_with_ttl(jobs.event_stream(spark, sf_dir)), out)
        return cut_lineage(jobs.served(jobs.newest(spark, data, ["request_id"])))


@register("stream_review", f"WITH {REVIEW_CTE}\n" + """
SELECT CASE WHEN rr IS NOT NULL THEN 'review' ELSE 'publish' END AS route, coalesce(rr, 'none') AS reason,
       count(*) AS n, count(DISTINCT request_id) AS distinct_requests
FROM r GROUP BY 1, 2
""")
def q_stream_review(spark, sf_dir):
    """foreachBatch writes the review queue (failed, low confidence, added terms) and the published set; read back."""
    from quarry.operators.requests import review_reason
    with scratch(spark, "stream_review") as out:
        added = cut_lineage(added_counts(spark, sf_dir))
        review, publish = jobs.stream_review_route(jobs.event_stream(spark, sf_dir), out, added)
        u = None
        for route, path in (("review", review), ("publish", publish)):
            rows = spark.read.parquet(path)
            part = rows.select(F.lit(route).alias("route"), F.coalesce(review_reason(rows), F.lit("none")).alias("reason"), "request_id")
            u = part if u is None else u.unionByName(part)
        return cut_lineage(u.groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("distinct_requests")))


AS_OF = "2024-01-31 12:00:00"


@register("retention", f"WITH {LOG_CTE}\n" + f"""
SELECT CAST(ts AS DATE) AS date, count(*) AS records_before,
       count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS records_after,
       round(sum(confidence) FILTER (WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY), 6) AS confidence_after
FROM log GROUP BY 1
""")
def q_retention(spark, sf_dir):
    """T4: the audit log streamed into date partitions, records of 30 days and more removed from disk; counts before and after."""
    with scratch(spark, "retention") as out:
        path = jobs.audit_stream(jobs.event_stream(spark, sf_dir), out)
        before = cut_lineage(jobs.read_audit(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("records_before")))
        jobs.purge(spark, path, AS_OF, 30)
        after = jobs.read_audit(spark, path).groupBy("date").agg(
            F.count(F.lit(1)).alias("records_after"), F.round(F.sum("confidence_score"), 6).alias("confidence_after"))
        return cut_lineage(before.join(after, "date", "left").select(
            "date", "records_before", F.coalesce("records_after", F.lit(0)).alias("records_after"), "confidence_after"))


@register("audit_append", f"WITH {LOG_CTE}\n" + f"""
SELECT CAST(request_id AS VARCHAR) AS report_id, sha256('audit' || CAST(user_id AS VARCHAR)) AS patient_mrn,
       start_us AS generated_us, ts AS generated_at, '{jobs.AUDIT_MODEL_VERSION}' AS model_version, sha256(input_key) AS input_hash,
       len(reason) + 65 AS output_chars, confidence AS confidence_score, false AS human_reviewed, NULL::VARCHAR AS reviewer_id,
       NULL::TIMESTAMP AS reviewed_at, CAST(ts AS DATE) AS date
FROM log
""")
def q_audit_append(spark, sf_dir):
    """Audit records appended (batch writer, date partitions) and read back, all columns.

    The output hash covers the decimal text of a double, which engines print
    differently; its length (and the reason's) stands for it.
    """
    from quarry.operators.requests import request_log
    with scratch(spark, "audit") as out:
        lg = request_log(table(spark, sf_dir, "events"))
        jobs.audit_append(jobs.audit_records(lg), out)
        r = cut_lineage(jobs.read_audit(spark, out))
    reasons = lg.select(F.col("request_id").cast("string").alias("report_id"), F.length("reason").alias("_n"))
    return r.join(reasons, "report_id").select(
        "report_id", "patient_mrn", "generated_us", F.col("generated_at").cast("timestamp_ntz").alias("generated_at"), "model_version", "input_hash",
        (F.length("output_hash") + 1 + F.col("_n")).cast("long").alias("output_chars"), F.round("confidence_score", 6).alias("confidence_score"),
        "human_reviewed", "reviewer_id", F.col("reviewed_at").cast("timestamp_ntz").alias("reviewed_at"), "date")


# Sealed audit records: the output's latency as a decimal text, which all engines print alike.
SEALED = ["report_id", "patient_mrn", "generated_us", "model_version", "input_hash", "output_hash", "confidence_score", "human_reviewed", "reviewer_id"]
SEAL_LEVELS = 7                                       # of the SQL below: days of up to 16^7 records


def sealed_records(spark, sf_dir):
    from quarry.operators.requests import request_log
    lg = request_log(table(spark, sf_dir, "events"))
    return jobs.audit_records(lg.withColumn("latency_s", F.col("latency_s").cast("decimal(18,6)")))


def _seal_sql():
    text = {"report_id": "CAST(request_id AS VARCHAR)", "patient_mrn": "sha256('audit' || CAST(user_id AS VARCHAR))",
            "generated_us": "CAST(start_us AS VARCHAR)", "model_version": f"'{jobs.AUDIT_MODEL_VERSION}'", "input_hash": "sha256(input_key)",
            "output_hash": "sha256(reason || '|' || CAST(CAST(latency_s AS DECIMAL(18,6)) AS VARCHAR))",
            "confidence_score": "CAST(confidence AS VARCHAR)", "human_reviewed": "'false'", "reviewer_id": "NULL::VARCHAR"}
    parts = " || ".join(f"coalesce(length({text[c]}) || ':' || {text[c]}, '-')" for c in SEALED)
    levels = f"""leaf AS (SELECT day, CAST(request_id AS VARCHAR) AS id, start_us, sha256('leaf|' || {parts}) AS hash FROM log),
l0 AS (SELECT day, row_number() OVER (PARTITION BY day ORDER BY start_us, id) - 1 AS pos, hash, count(*) OVER (PARTITION BY day) AS left_n FROM leaf)"""
    for i in range(1, SEAL_LEVELS + 1):
        levels += f""",
l{i} AS (SELECT day, pos, hash, count(*) OVER (PARTITION BY day) AS left_n FROM (
  SELECT day, pos // 16 AS pos, CASE WHEN any_value(left_n) = 1 THEN any_value(hash)
         ELSE sha256('node|' || string_agg(hash, '|' ORDER BY pos)) END AS hash FROM l{i - 1} GROUP BY day, pos // 16))"""
    return levels


@register("audit_seal", f"WITH RECURSIVE {LOG_CTE},\n{_seal_sql()}" + f""",
r AS (SELECT l.day, (SELECT count(*) FROM log WHERE log.day = l.day) AS n, l.hash AS root, row_number() OVER (ORDER BY l.day) AS i FROM l{SEAL_LEVELS} l),
walk(i, day, n, root, chain) AS (
  SELECT i, day, n, root, sha256('{"0" * 64}' || '|' || day || '|' || n || '|' || root) FROM r WHERE i = 1
  UNION ALL SELECT r.i, r.day, r.n, r.root, sha256(w.chain || '|' || r.day || '|' || r.n || '|' || r.root) FROM walk w JOIN r ON r.i = w.i + 1)
SELECT day, n, root, chain FROM walk
""")
def q_audit_seal(spark, sf_dir):
    """The audit log written by date and read back; a hash tree per day and the chain of the days' roots."""
    from quarry.operators.merkle import leaves, seal, tree
    with scratch(spark, "audit_seal") as out:
        jobs.audit_append(sealed_records(spark, sf_dir), out)
        nodes = tree(leaves(jobs.read_audit(spark, out), "report_id", ["generated_us"], columns=SEALED))
    return seal(nodes)


@register("audit_altered", f"WITH {LOG_CTE},\n" + """
f AS (SELECT CAST(request_id AS VARCHAR) AS id, day, CASE WHEN request_id % 97 = 5 THEN 'dropped' WHEN request_id % 89 = 7 THEN 'changed'
             WHEN request_id % 83 = 3 THEN 'moved' END AS finding FROM log)
SELECT id, finding, day, CASE finding WHEN 'dropped' THEN NULL WHEN 'moved' THEN CAST(day + INTERVAL 1 DAY AS DATE) ELSE day END AS new_day
FROM f WHERE finding IS NOT NULL
UNION ALL SELECT CAST(-request_id AS VARCHAR), 'added', NULL, day FROM log WHERE request_id % 1000 = 1
""")
def q_audit_altered(spark, sf_dir):
    """A copy of the audit log with records dropped, changed, moved to the next day and added; the seal names each."""
    from quarry.operators.merkle import altered, leaves, tree
    r = sealed_records(spark, sf_dir)
    rid = F.col("report_id").cast("long")
    dropped, changed, moved = rid % 97 == 5, rid % 89 == 7, rid % 83 == 3
    forged = r.where(~dropped).withColumn("confidence_score", F.when(changed, F.col("confidence_score") + 1).otherwise(F.col("confidence_score")))
    forged = forged.withColumn("date", F.when(moved & ~changed, F.date_add("date", 1)).otherwise(F.col("date")))
    forged = forged.unionByName(r.where(rid % 1000 == 1).withColumn("report_id", (-rid).cast("string")))
    old, new = (tree(leaves(x, "report_id", ["generated_us"], columns=SEALED)) for x in (r, forged))
    return altered(old, new)
