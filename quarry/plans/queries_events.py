"""Driver queries over ``events`` (serving log), ``labels`` and perplexity over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.catalog import register
from quarry.plans.queries_scoring import ADDED_SQL
from quarry.session import table

TOKRX = "'[^ \\t\\n\\r\\f]+'"

LOG_CTE = """log AS (
  SELECT event_id AS request_id, ts, user_id, epoch_us(ts) AS start_us,
         epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS end_us, value AS latency_s,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status, event_type AS reason,
         (100 - CAST(json_extract(props, '$.k') AS INTEGER)) / 100.0 AS confidence,
         CAST(user_id AS VARCHAR) || '|' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS input_key,
         CAST(ts AS DATE) AS day, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type, value, event_id
  FROM events)"""


def log(spark, sf_dir):
    from quarry.operators.requests import request_log
    return request_log(table(spark, sf_dir, "events"))


@register("latency_panel", f"WITH {LOG_CTE}\n" + """
SELECT count(*) AS requests, round(quantile_cont(latency_s, 0.5), 6) AS p50,
       round(quantile_cont(latency_s, 0.75), 6) AS p75, round(quantile_cont(latency_s, 0.9), 6) AS p90,
       round(quantile_cont(latency_s, 0.95), 6) AS p95, round(quantile_cont(latency_s, 0.99), 6) AS p99,
       round(max(latency_s), 6) AS max, round(quantile_cont(latency_s, 0.95), 6) < 3.0 AS sla_ok
FROM log
""")
def q_latency_panel(spark, sf_dir):
    """Exact latency percentiles and the P95 SLA flag."""
    from quarry.operators.requests import latency_panel
    return latency_panel(log(spark, sf_dir))


@register("request_panel", f"WITH {LOG_CTE}\n" + """
SELECT 'status' AS section, status AS key, CAST(count(*) AS DOUBLE) AS n,
       round(100.0 * count(*) / (SELECT count(*) FROM log), 6) AS percent FROM log GROUP BY status
UNION ALL
SELECT 'failure_reason', reason, CAST(count(*) AS DOUBLE),
       round(100.0 * count(*) / (SELECT count(*) FROM log WHERE status = 'failed'), 6)
FROM log WHERE status = 'failed' GROUP BY reason
UNION ALL SELECT 'total', 'requests', CAST(count(*) AS DOUBLE), 100.0 FROM log
UNION ALL SELECT 'per_day', 'mean', round(count(*) / count(DISTINCT day), 6), NULL FROM log
""")
def q_request_panel(spark, sf_dir):
    """Totals, success/failure shares, failure reasons, mean per day."""
    from quarry.operators.requests import request_panel
    return request_panel(log(spark, sf_dir))


# Bindings of the review queries: the terms added by the first answer of conversation ``request_id`` (U3),
# and the reviewer's decision from the quality label of document ``request_id``.
def added_counts(spark, sf_dir):
    """(request_id, n_added): terms that the first answer of a conversation adds to its question."""
    from quarry.plans.queries_scoring import added_terms_of
    t = added_terms_of(spark, sf_dir).where("turn <= 1")
    return t.groupBy(F.col("conv_id").alias("request_id")).agg(F.sum("n_added").alias("n_added"))


def review_log(spark, sf_dir):
    return log(spark, sf_dir).join(added_counts(spark, sf_dir), "request_id", "left").withColumn(
        "n_added", F.coalesce("n_added", F.lit(0)))


def decisions(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("request_id")).agg(
        F.when(F.max("quality") == 1, "approved").otherwise("revised").alias("decision"))


REVIEW_CTE = f"""{LOG_CTE},
{ADDED_SQL},
ac AS (SELECT conv_id AS request_id, sum(n_added) AS n_added FROM added_of WHERE turn <= 1 GROUP BY 1),
dc AS (SELECT doc_id AS request_id, CASE WHEN max(quality) = 1 THEN 'approved' ELSE 'revised' END AS decision
       FROM labels GROUP BY 1),
r AS (SELECT request_id, CASE WHEN status = 'failed' THEN 'failed' WHEN confidence < 0.95 THEN 'low_confidence'
                              WHEN coalesce(n_added, 0) > 0 THEN 'added_terms' END AS rr
      FROM log LEFT JOIN ac USING (request_id))"""


@register("review_panel", f"WITH {REVIEW_CTE},\n" + """
rd AS (SELECT decision, count(*) AS n FROM r JOIN dc USING (request_id) WHERE rr IS NOT NULL GROUP BY 1)
SELECT 'queue' AS section, 'all' AS key, count(*) AS n,
       round(100.0 * count(*) / (SELECT count(*) FROM log), 6) AS percent FROM r WHERE rr IS NOT NULL
UNION ALL
SELECT 'reason', rr, count(*), round(100.0 * count(*) / (SELECT count(*) FROM r WHERE rr IS NOT NULL), 6)
FROM r WHERE rr IS NOT NULL GROUP BY rr
UNION ALL SELECT 'decision', decision, n, round(100.0 * n / (SELECT sum(n) FROM rd), 6) FROM rd
""")
def q_review_panel(spark, sf_dir):
    """Review queue (failed, confidence < 0.95 or added terms): size, share, reasons, approval and revision rates."""
    from quarry.operators.requests import review_panel
    return review_panel(review_log(spark, sf_dir), decisions=decisions(spark, sf_dir))


@register("cache_hits", f"WITH {LOG_CTE},\n" + """
f AS (SELECT day, row_number() OVER (PARTITION BY input_key ORDER BY start_us, request_id) > 1 AS hit FROM log)
SELECT day, count(*) AS requests, count(*) FILTER (WHERE hit) AS hits,
       round(count(*) FILTER (WHERE hit) / count(*), 6) AS hit_rate
FROM f GROUP BY day
""")
def q_cache_hits(spark, sf_dir):
    """Per day, requests whose input had been served before."""
    from quarry.operators.requests import cache_hit_rate
    return cache_hit_rate(log(spark, sf_dir))


CACHE_SIZES, CACHE_AGES = [10, 100, 1000, 10000], [3600, 86400, None]


@register("cache_curve", f"WITH {LOG_CTE},\n" + f"""
o AS (SELECT input_key, start_us, row_number() OVER (ORDER BY start_us, request_id) AS i FROM log),
u AS (SELECT i, start_us, lag(i) OVER w AS p, start_us - lag(start_us) OVER w AS gap FROM o WINDOW w AS (PARTITION BY input_key ORDER BY i)),
r AS (SELECT * FROM u WHERE p IS NOT NULL),
nested AS (SELECT r.i, count(*) AS n FROM r JOIN r q ON q.i < r.i AND q.p > r.p GROUP BY r.i),
d AS (SELECT r.i - r.p - 1 - coalesce(nested.n, 0) AS distance, gap FROM r LEFT JOIN nested USING (i)),
c(capacity) AS (VALUES {", ".join(f"({c}::BIGINT)" for c in CACHE_SIZES)}),
a(max_age_s) AS (VALUES {", ".join("(NULL::BIGINT)" if x is None else f"({x}::BIGINT)" for x in CACHE_AGES)}),
h AS (SELECT capacity, max_age_s, (SELECT count(*) FROM log) AS requests,
             count(distance) FILTER (WHERE distance < capacity AND (max_age_s IS NULL OR gap <= max_age_s * 1000000)) AS hits
      FROM c CROSS JOIN a LEFT JOIN d ON true GROUP BY capacity, max_age_s)
SELECT *, round(hits / requests, 6) AS hit_rate FROM h
""")
def q_cache_curve(spark, sf_dir):
    """Hits of caches of several capacities and ages, by reuse distances."""
    from quarry.operators.reuse import cache_curve
    return cache_curve(log(spark, sf_dir), CACHE_SIZES, CACHE_AGES)


@register("before_after", f"WITH {LOG_CTE},\n" + """
p AS (SELECT event_type, value, CASE WHEN day(ts) <= 15 THEN 'before' ELSE 'after' END AS phase FROM log),
t AS (SELECT phase, count(*) AS tot FROM p GROUP BY phase),
a AS (SELECT event_type,
             count(*) FILTER (WHERE phase = 'before') AS n_before, count(*) FILTER (WHERE phase = 'after') AS n_after,
             round(avg(value) FILTER (WHERE phase = 'before'), 6) AS mean_before,
             round(avg(value) FILTER (WHERE phase = 'after'), 6) AS mean_after
      FROM p GROUP BY event_type)
SELECT event_type, n_before, n_after, mean_before, mean_after,
       round(100.0 * n_before / (SELECT tot FROM t WHERE phase = 'before'), 6) AS share_before,
       round(100.0 * n_after / (SELECT tot FROM t WHERE phase = 'after'), 6) AS share_after,
       round(CASE WHEN n_before = 0 THEN NULL ELSE
         ((n_after / (SELECT tot FROM t WHERE phase = 'after')) - (n_before / (SELECT tot FROM t WHERE phase = 'before')))
         / (n_before / (SELECT tot FROM t WHERE phase = 'before')) * 100 END, 6) AS change_pct
FROM a
""")
def q_before_after(spark, sf_dir):
    """Share of each event type in days 1-15 vs 16-30, change, and mean value per arm."""
    from quarry.operators.requests import before_after
    lg = log(spark, sf_dir).withColumn(
        "phase", F.when(F.dayofmonth("ts_ntz") <= 15, F.lit("before")).otherwise(F.lit("after")))
    return before_after(lg, "reason", "phase", "latency_s").withColumnRenamed("reason", "event_type")


@register("concurrency", f"WITH {LOG_CTE},\n" + """
ev AS (SELECT start_us AS t, 1 AS delta, 1 AS is_start FROM log
       UNION ALL SELECT end_us, -1, 0 FROM log),
a AS (SELECT is_start, sum(delta) OVER (ORDER BY t, delta ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active
      FROM ev)
SELECT max(active) AS max_concurrent, round(avg(active) FILTER (WHERE is_start = 1), 6) AS mean_active_at_arrival,
       round(avg(active) FILTER (WHERE is_start = 1) - 1, 6) AS mean_queue_ahead,
       max(active - 1) FILTER (WHERE is_start = 1) AS max_queue_ahead
FROM a
""")
def q_concurrency(spark, sf_dir):
    """Maximum simultaneous requests over [ts, ts + latency), mean and maximum queue ahead of an arrival."""
    from quarry.operators.requests import concurrency
    return concurrency(log(spark, sf_dir))


@register("peaks", f"WITH {LOG_CTE},\n" + """
h AS (SELECT hour(ts) AS hour, count(*) AS n FROM log GROUP BY 1),
d AS (SELECT day, count(*) AS n FROM log GROUP BY 1)
SELECT 'busiest_hour' AS metric, CAST(arg_min(hour, (-n, hour)) AS VARCHAR) AS key,
       CAST(arg_min(n, (-n, hour)) AS DOUBLE) AS value FROM h
UNION ALL SELECT 'busiest_day', CAST(arg_min(day, (-n, day)) AS VARCHAR), CAST(arg_min(n, (-n, day)) AS DOUBLE) FROM d
UNION ALL SELECT 'mean_per_day', '', round(avg(n), 6) FROM d
UNION ALL SELECT 'off_peak_per_hour', '', round(count(*) / ((SELECT count(DISTINCT day) FROM log) * 8), 6)
FROM log WHERE hour(ts) >= 22 OR hour(ts) < 6
""")
def q_peaks(spark, sf_dir):
    """Busiest hour and day, mean per day, requests per off-peak hour (10 PM to 6 AM)."""
    from quarry.operators.requests import peaks
    return peaks(log(spark, sf_dir))


TIMINGS_CTE = """timings AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 8 END AS batch_size,
         event_id % 10 = 0 AS warmup, value AS seconds, ts FROM events)"""


def timings(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.element_at(F.array(F.lit(1), F.lit(4), F.lit(8)),
                                 (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int")).alias("batch_size"),
                    (F.pmod(F.col("event_id"), F.lit(10)) == 0).alias("warmup"),
                    F.col("value").alias("seconds"), F.col("ts"))


@register("latency_by_batch", f"WITH {TIMINGS_CTE}\n" + """
SELECT batch_size, round(sum(seconds), 6) AS total_time, count(*) AS iterations,
       round(sum(seconds) / count(*) * 1000, 6) AS avg_latency_ms,
       round(batch_size / (sum(seconds) / count(*)), 6) AS throughput_samples_per_sec
FROM timings WHERE NOT warmup GROUP BY batch_size
""")
def q_latency_by_batch(spark, sf_dir):
    """Per batch size (1/4/8 by user), warm-up rows excluded."""
    from quarry.operators.metrics import latency_by_batch
    r = latency_by_batch(timings(spark, sf_dir))
    return r.select("batch_size", F.round("total_time", 6).alias("total_time"), "iterations",
                    F.round("avg_latency_ms", 6).alias("avg_latency_ms"),
                    F.round("throughput_samples_per_sec", 6).alias("throughput_samples_per_sec"))


@register("throughput", f"WITH {LOG_CTE}\n" + """
SELECT event_type, sum(k) AS total_tokens, round(sum(value), 6) AS total_time, count(*) AS items,
       round(avg(CASE WHEN value > 0 THEN k / value END), 6) AS mean_rate,
       round(avg(value), 6) AS mean_latency_s,
       round(CASE WHEN sum(value) > 0 THEN sum(k) / sum(value) ELSE 0 END, 6) AS tokens_per_sec,
       round(count(*) / sum(value), 6) AS items_per_sec,
       CASE WHEN sum(k) / sum(value) >= 5 THEN 'good' WHEN sum(k) / sum(value) >= 1 THEN 'slow'
            ELSE 'very slow' END AS speed_tier
FROM log GROUP BY event_type
""")
def q_throughput(spark, sf_dir):
    """generations = events (tokens = k, time = value), per event type."""
    from quarry.operators.metrics import throughput
    e = table(spark, sf_dir, "events").select(
        "event_type", F.get_json_object("props", "$.k").cast("int").alias("tokens_generated"),
        F.col("value").alias("time_seconds"))
    t = throughput(e, by=["event_type"])
    return t.select("event_type", "total_tokens", F.round("total_time", 6).alias("total_time"), "items",
                    F.round("mean_rate", 6).alias("mean_rate"), F.round("mean_latency_s", 6).alias("mean_latency_s"),
                    F.round("tokens_per_sec", 6).alias("tokens_per_sec"),
                    F.round("items_per_sec", 6).alias("items_per_sec"), "speed_tier")


# --------------------------------------------------------------------------- perplexity
PPL_DATASETS = ["de", "en", "es", "fr", "zz"]   # zz has no training rows: its record carries the error


def _ppl_sql(datasets):
    vals = ", ".join(f"('{d}')" for d in datasets)
    lst = ", ".join(f"'{d}'" for d in datasets)
    return f"""
train AS (SELECT lang, unnest(regexp_extract_all(lower(text), {TOKRX})) AS token FROM documents WHERE lang IN ({lst})),
counts AS (SELECT lang, token, count(*) AS c FROM train GROUP BY 1, 2),
totals AS (SELECT lang, sum(c) AS N, count(*) AS V FROM counts GROUP BY 1),
test AS (SELECT conv_id * 1000 + turn AS tid, text FROM conversations),
tt AS (SELECT tid, token, count(*) AS k
       FROM (SELECT tid, unnest(regexp_extract_all(lower(text), {TOKRX})) AS token FROM test) GROUP BY 1, 2),
seen AS (SELECT c.lang, tt.tid, sum(tt.k * ln(c.c + 1)) AS s FROM tt JOIN counts c USING (token) GROUP BY 1, 2),
grid AS (SELECT t.tid, len(regexp_extract_all(lower(t.text), {TOKRX})) AS tokens, d.lang
         FROM test t CROSS JOIN (VALUES {vals}) d(lang)),
losses AS (
  SELECT g.lang AS dataset, g.tokens AS padded_len, g.tokens,
         CASE WHEN g.tokens > 0 THEN (g.tokens * ln(tot.N + tot.V) - coalesce(s.s, 0)) / g.tokens END AS loss
  FROM grid g LEFT JOIN totals tot USING (lang) LEFT JOIN seen s ON s.lang = g.lang AND s.tid = g.tid)"""


def ngram_losses(spark, sf_dir, datasets=PPL_DATASETS):
    from quarry.operators.perplexity import ngram_losses as nl
    return nl(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations").select("text"), "lang", datasets)


@register("ngram_perplexity", "WITH " + _ppl_sql(PPL_DATASETS[:4]) + """
SELECT dataset, round(exp(sum(loss * tokens) FILTER (WHERE padded_len >= 2) /
                          sum(tokens) FILTER (WHERE padded_len >= 2)), 6) AS perplexity,
       round(sum(loss * tokens) FILTER (WHERE padded_len >= 2) / sum(tokens) FILTER (WHERE padded_len >= 2), 6) AS loss,
       sum(tokens) FILTER (WHERE padded_len >= 2) AS total_tokens, count(*) AS num_samples,
       count(*) FILTER (WHERE padded_len >= 2) AS num_batches
FROM losses GROUP BY dataset
""")
def q_ngram_perplexity(spark, sf_dir):
    """A7 -> A5: conversation texts scored by an add-one unigram model of each language's documents."""
    from quarry.operators.perplexity import perplexity
    p = perplexity(ngram_losses(spark, sf_dir, PPL_DATASETS[:4]))
    return p.select("dataset", F.round("perplexity", 6).alias("perplexity"), F.round("loss", 6).alias("loss"),
                    "total_tokens", "num_samples", "num_batches")


def _backoff_sql(order, name):
    """Loss per corpus of a back-off model of ``order`` words, as CTE ``name``; tables g1..gn, x1..xn."""
    w = lambda k: ", ".join(f"w{i}" for i in range(k, 0, -1))               # noqa: E731
    lagged = ", ".join(f"CASE WHEN i >= {k} THEN toks[i - {k - 1}] ELSE '' END AS w{k}" for k in range(order, 0, -1))
    split = f"regexp_extract_all(lower(text), {TOKRX})"
    sql = f"""
{name}t AS (SELECT lang, toks, unnest(range(1, len(toks) + 1)) AS i FROM (SELECT lang, {split} AS toks FROM documents WHERE lang IN ('de', 'en', 'es', 'fr'))),
{name}g{order} AS (SELECT lang, {w(order)}, count(*) AS c FROM (SELECT lang, {lagged} FROM {name}t) GROUP BY ALL),
{name}q AS (SELECT {w(order)}, count(*) AS n FROM (SELECT {lagged} FROM (SELECT toks, unnest(range(1, len(toks) + 1)) AS i
  FROM (SELECT {split} AS toks FROM conversations) WHERE len(toks) >= 2)) GROUP BY ALL)"""
    for k in range(order, 0, -1):
        if k < order:
            sql += f",\n{name}g{k} AS (SELECT lang, {w(k)}, count(*) AS c FROM {name}g{k + 1} GROUP BY ALL)"
        context = "".join(f", w{i}" for i in range(k, 1, -1))
        sql += f",\n{name}x{k} AS (SELECT lang{context}, sum(c) AS t, count(*) AS k FROM {name}g{k} GROUP BY ALL)"
    sql += f",\n{name}p0 AS (SELECT {name}q.*, lang, 1.0::DOUBLE / (k + 1) AS p FROM {name}q CROSS JOIN {name}x1)"
    for k in range(1, order + 1):
        on_g = " AND ".join(["g.lang = b.lang"] + [f"g.w{i} = b.w{i}" for i in range(1, k + 1)])
        on_x = " AND ".join(["x.lang = b.lang"] + [f"x.w{i} = b.w{i}" for i in range(2, k + 1)])
        sql += f""",
{name}p{k} AS (SELECT b.* REPLACE (CASE WHEN x.t IS NULL THEN b.p ELSE greatest(coalesce(g.c, 0) - 0.75::DOUBLE, 0) / x.t + 0.75::DOUBLE * x.k / x.t * b.p END AS p)
  FROM {name}p{k - 1} b LEFT JOIN {name}g{k} g ON {on_g} LEFT JOIN {name}x{k} x ON {on_x})"""
    return sql + f",\n{name} AS (SELECT lang AS dataset, {order} AS words, sum(-ln(p) * n) / sum(n) AS loss, sum(n)::BIGINT AS total_tokens FROM {name}p{order} GROUP BY lang)"


@register("backoff_perplexity", "WITH " + ",".join(_backoff_sql(n, f"m{n}") for n in (2, 3)) + """
SELECT dataset, words, round(loss, 6) AS loss, total_tokens FROM (SELECT * FROM m2 UNION ALL SELECT * FROM m3)
""")
def q_backoff_perplexity(spark, sf_dir):
    """A7 -> A5: conversation texts scored by back-off models of two and three words of each language's documents."""
    from quarry.operators.backoff import backoff_losses
    from quarry.operators.perplexity import perplexity
    out = None
    for words in (2, 3):
        losses = backoff_losses(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"), "lang", PPL_DATASETS[:4], words)
        r = perplexity(losses).select("dataset", F.lit(words).alias("words"), F.round("loss", 6).alias("loss"), "total_tokens")
        out = r if out is None else out.unionByName(r)
    return out


@register("perplexity_suite", "WITH " + _ppl_sql(PPL_DATASETS) + """,
agg AS (
  SELECT dataset,
         max(CASE WHEN padded_len >= 2 AND (loss IS NULL OR isnan(loss) OR isinf(loss)) THEN 1 ELSE 0 END) AS any_bad,
         sum(loss * tokens) FILTER (WHERE padded_len >= 2 AND NOT (loss IS NULL OR isnan(loss) OR isinf(loss))) AS lw,
         sum(tokens) FILTER (WHERE padded_len >= 2 AND NOT (loss IS NULL OR isnan(loss) OR isinf(loss))) AS tok
  FROM losses GROUP BY dataset)
SELECT dataset,
       CASE WHEN any_bad = 1 THEN 'non-finite loss' WHEN coalesce(tok, 0) = 0 THEN 'no tokens' END AS error,
       CASE WHEN any_bad = 0 AND coalesce(tok, 0) > 0 THEN round(exp(lw / tok), 6) END AS perplexity,
       coalesce(tok, 0) AS total_tokens
FROM agg
""")
def q_perplexity_suite(spark, sf_dir):
    """The suite over five datasets; 'zz' has no training corpus and yields an error record."""
    from quarry.operators.perplexity import perplexity_suite
    s = perplexity_suite(ngram_losses(spark, sf_dir, PPL_DATASETS))
    return s.select("dataset", "error", F.round("perplexity", 6).alias("perplexity"),
                    F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"))


# --------------------------------------------------------------------------- P16, A12, K3, J2, S12
def task_records(spark, sf_dir):
    """Per-document task records: acc when not toxic, acc_norm when toxic, nothing when unlabeled."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select("doc_id", "source",
                    F.when(F.col("toxic") == 0, F.col("quality").cast("double")).alias("acc"),
                    F.when(F.col("toxic") == 1, F.col("quality").cast("double")).alias("acc_norm"),
                    F.lit(None).cast("double").alias("exact_match"))


TASKS_CTE = """rec AS (
  SELECT d.doc_id, d.source, CASE WHEN l.toxic = 0 THEN CAST(l.quality AS DOUBLE) END AS acc,
         CASE WHEN l.toxic = 1 THEN CAST(l.quality AS DOUBLE) END AS acc_norm, CAST(NULL AS DOUBLE) AS exact_match
  FROM documents d LEFT JOIN labels l USING (doc_id)),
picked AS (
  SELECT doc_id, source,
         CASE WHEN acc IS NOT NULL THEN 'acc' WHEN acc_norm IS NOT NULL THEN 'acc_norm'
              WHEN exact_match IS NOT NULL THEN 'exact_match' END AS metric_name,
         coalesce(acc, acc_norm, exact_match) AS metric,
         CASE WHEN coalesce(acc, acc_norm, exact_match) IS NULL
              THEN to_json(struct_pack(doc_id := doc_id, source := source)) END AS raw
  FROM rec)"""


@register("pick_metric", f"WITH {TASKS_CTE}\nSELECT doc_id, metric_name, metric, raw FROM picked")
def q_pick_metric(spark, sf_dir):
    """First present of acc / acc_norm / exact_match per task record, else the raw record."""
    from quarry.operators.metrics import pick_metric
    return pick_metric(task_records(spark, sf_dir), keep_cols=["doc_id"]).select(
        "doc_id", "metric_name", "metric", "raw")


def evaluation_parts(spark, sf_dir):
    """The three stages of an evaluation: perplexity (A6), task scores (P16 per source), latency."""
    from quarry.operators.metrics import latency_by_batch, pick_metric
    from quarry.operators.perplexity import perplexity_suite
    picked = pick_metric(task_records(spark, sf_dir), keep_cols=["source"])
    return {"perplexity": perplexity_suite(ngram_losses(spark, sf_dir, PPL_DATASETS)),
            "tasks": picked.groupBy(F.col("source").alias("task")).agg(F.avg("metric").alias("metric")),
            "latency": latency_by_batch(timings(spark, sf_dir))}


def summary_of(parts):
    from quarry.operators.metrics import summary_metrics
    return summary_metrics(parts["perplexity"], parts["tasks"], parts["latency"])


SUMMARY_SQL = "WITH " + _ppl_sql(PPL_DATASETS) + f""",
agg AS (
  SELECT dataset,
         max(CASE WHEN padded_len >= 2 AND (loss IS NULL OR isnan(loss) OR isinf(loss)) THEN 1 ELSE 0 END) AS any_bad,
         sum(loss * tokens) FILTER (WHERE padded_len >= 2 AND NOT (loss IS NULL OR isnan(loss) OR isinf(loss))) AS lw,
         sum(tokens) FILTER (WHERE padded_len >= 2 AND NOT (loss IS NULL OR isnan(loss) OR isinf(loss))) AS tok
  FROM losses GROUP BY dataset),
ppl AS (SELECT dataset, exp(lw / tok) AS perplexity FROM agg WHERE any_bad = 0 AND coalesce(tok, 0) > 0),
{TASKS_CTE},
tasks AS (SELECT source AS task, avg(metric) AS metric FROM picked GROUP BY source),
{TIMINGS_CTE},
lat AS (SELECT batch_size, sum(seconds) / count(*) * 1000 AS avg_latency_ms,
               batch_size / (sum(seconds) / count(*)) AS tps FROM timings WHERE NOT warmup GROUP BY batch_size),
long AS (
  SELECT 'ppl_' || dataset AS metric, perplexity AS value FROM ppl
  UNION ALL SELECT 'avg_perplexity', avg(perplexity) FROM ppl
  UNION ALL SELECT 'task_' || task, metric FROM tasks WHERE metric IS NOT NULL
  UNION ALL SELECT 'avg_task_score', avg(metric) FROM tasks WHERE metric IS NOT NULL
  UNION ALL SELECT 'latency_ms', avg_latency_ms FROM lat WHERE batch_size = 1
  UNION ALL SELECT 'throughput_tps', coalesce(tps, 0) FROM lat WHERE batch_size = 1)"""


@register("summary_metrics", SUMMARY_SQL + "\nSELECT metric, round(value, 6) AS value FROM long")
def q_summary_metrics(spark, sf_dir):
    """Perplexities (A6), task scores (P16 per source), batch-1 latency (A13) flattened."""
    s = summary_of(evaluation_parts(spark, sf_dir))
    return s.select("metric", F.round("value", 6).alias("value"))


@register("evaluate_suite", SUMMARY_SQL + """
SELECT CASE WHEN metric LIKE 'ppl_%' OR metric = 'avg_perplexity' THEN 'perplexity'
            WHEN metric LIKE 'task_%' OR metric = 'avg_task_score' THEN 'tasks' ELSE 'latency' END AS stage,
       metric, round(value, 6) AS value, printf('%.3f', value) AS display
FROM long
""")
def q_evaluate_suite(spark, sf_dir):
    """K3: three independent stages, computed once (checkpoint), flattened (A12), saved as JSON, one-row CSV and
    a markdown report (S10, K5); what is returned is read back from the JSON output."""
    from quarry.operators.metrics import fmt_fixed, markdown_lines, report_text
    from quarry.session import cut_lineage, scratch
    from quarry.sources.results import save_results
    parts = {k: cut_lineage(v) for k, v in evaluation_parts(spark, sf_dir).items()}
    s = cut_lineage(summary_of(parts))
    lines = markdown_lines(s, parts["perplexity"], parts["tasks"], parts["latency"], model=REPORT_MODEL, hardware=REPORT_HARDWARE, generated=REPORT_TIME)
    with scratch(spark, "evaluate") as out:
        for fmt in ("json", "csv", "markdown"):                     # S10, all three formats
            path = save_results(s, out, fmt, "run", report_lines=report_text(lines, []))
            if fmt == "json":
                back = cut_lineage(spark.read.json(path))
    stage = (F.when(F.col("metric").startswith("ppl_") | (F.col("metric") == "avg_perplexity"), F.lit("perplexity"))
              .when(F.col("metric").startswith("task_") | (F.col("metric") == "avg_task_score"), F.lit("tasks"))
              .otherwise(F.lit("latency")))
    return back.select(stage.alias("stage"), "metric", F.round("value", 6).alias("value"), fmt_fixed("value", 3).alias("display"))


REPORT_MODEL = {"name": "unigram", "languages": "de, en, es, fr"}
REPORT_HARDWARE = {"engine": "spark"}
REPORT_TIME = "2024-02-01T00:00:00"


@register("markdown_report", SUMMARY_SQL + f""",
lines(sec, sort, line) AS (
  SELECT 0, 0.0, '# Evaluation Report' UNION ALL SELECT 0, 1.0, 'Generated: {REPORT_TIME}'
  UNION ALL SELECT 1, 0.0, '## Model Information' UNION ALL SELECT 1, 1.0, '- **name**: unigram'
  UNION ALL SELECT 1, 2.0, '- **languages**: de, en, es, fr'
  UNION ALL SELECT 2, 0.0, '## Hardware Configuration' UNION ALL SELECT 2, 1.0, '- **engine**: spark'
  UNION ALL SELECT 3, 0.0, '## Summary Metrics' UNION ALL SELECT 3, 1.0, '| Metric | Value |' UNION ALL SELECT 3, 2.0, '|--------|-------|'
  UNION ALL SELECT 3, 2.0 + row_number() OVER (ORDER BY metric), '| ' || metric || ' | ' || printf('%.3f', value) || ' |' FROM long
  UNION ALL SELECT 4, 0.0, '## Perplexity Results'
  UNION ALL SELECT 4, row_number() OVER (ORDER BY dataset), '- **' || dataset || '**: ' || printf('%.3f', perplexity) FROM ppl
  UNION ALL SELECT 5, 0.0, '## Task Evaluation Results'
  UNION ALL SELECT 5, row_number() OVER (ORDER BY task), '- **' || task || '**: ' || printf('%.3f', metric) FROM tasks WHERE metric IS NOT NULL
  UNION ALL SELECT 6, 0.0, '## Latency Measurements' UNION ALL SELECT 6, 1.0, '| Batch Size | Latency (ms) | Throughput (samples/s) |'
  UNION ALL SELECT 6, 2.0, '|------------|-------------|------------------------|'
  UNION ALL SELECT 6, 2.0 + row_number() OVER (ORDER BY batch_size),
                   '| ' || batch_size || ' | ' || printf('%.2f', avg_latency_ms) || ' | ' || printf('%.2f', tps) || ' |' FROM lat)
SELECT sec AS section, count(*) AS lines, string_agg(line, chr(10) ORDER BY sort) AS text FROM lines GROUP BY sec
""")
def q_markdown_report(spark, sf_dir):
    """K5: the evaluation report by section (header, model, hardware, summary, perplexity, tasks, latency)."""
    from quarry.operators.metrics import markdown_lines, report_text
    from quarry.session import cut_lineage
    parts = {k: cut_lineage(v) for k, v in evaluation_parts(spark, sf_dir).items()}        # the summary and the sections read them
    lines = markdown_lines(cut_lineage(summary_of(parts)), parts["perplexity"], parts["tasks"], parts["latency"], model=REPORT_MODEL,
                           hardware=REPORT_HARDWARE, generated=REPORT_TIME)
    t = report_text(lines.withColumn("section", F.col("pos._sec")), "section")
    return t.select("section", F.col("n_lines").alias("lines"), F.col("report").alias("text"))


PHASE_METRICS = ["requests", "error_rate", "mean_latency_s", "latency_ms", "throughput_tps", "gpu_memory_gb"]


@register("compare_halves", f"WITH {LOG_CTE},\n{TIMINGS_CTE},\n" + """
ph AS (SELECT *, CASE WHEN day(ts) <= 15 THEN 'before' ELSE 'after' END AS phase FROM log),
m AS (
  SELECT phase, 'requests' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ph GROUP BY phase
  UNION ALL SELECT phase, 'error_rate', avg(CASE WHEN status = 'failed' THEN 1.0 ELSE 0.0 END) FROM ph GROUP BY phase
  UNION ALL SELECT phase, 'mean_latency_s', avg(latency_s) FROM ph GROUP BY phase
  UNION ALL SELECT CASE WHEN day(ts) <= 15 THEN 'before' ELSE 'after' END, 'latency_ms',
                   sum(seconds) / count(*) * 1000 FROM timings WHERE NOT warmup AND batch_size = 1 GROUP BY 1
  UNION ALL SELECT CASE WHEN day(ts) <= 15 THEN 'before' ELSE 'after' END, 'throughput_tps',
                   1 / (sum(seconds) / count(*)) FROM timings WHERE NOT warmup AND batch_size = 1 GROUP BY 1),
o(pos, metric) AS (VALUES (0, 'requests'), (1, 'error_rate'), (2, 'mean_latency_s'), (3, 'latency_ms'),
                          (4, 'throughput_tps'), (5, 'gpu_memory_gb'))
SELECT o.pos, o.metric, round(b.value, 6) AS baseline, round(c.value, 6) AS candidate,
       round(c.value - b.value, 6) AS delta,
       round(CASE WHEN b.value = 0 THEN 0.0 ELSE (c.value - b.value) / b.value * 100 END, 6) AS delta_pct
FROM o LEFT JOIN m b ON b.metric = o.metric AND b.phase = 'before'
       LEFT JOIN m c ON c.metric = o.metric AND c.phase = 'after'
""")
def q_compare_halves(spark, sf_dir):
    """Days 1-15 (baseline) against days 16-30 (candidate); an unmeasured metric stays null. One aggregate of the log."""
    from quarry.operators.metrics import compare
    from quarry.session import cut_lineage
    lg = log(spark, sf_dir).withColumn(
        "phase", F.when(F.dayofmonth("ts_ntz") <= 15, F.lit("before")).otherwise(F.lit("after")))
    first = (F.pmod(F.col("user_id"), F.lit(3)) == 0) & (F.pmod(F.col("request_id"), F.lit(10)) != 0)     # batch size 1, no warm-up
    agg = lg.groupBy("phase").agg(F.count(F.lit(1)).cast("double").alias("requests"),
                                  F.avg((F.col("status") == "failed").cast("double")).alias("error_rate"),
                                  F.avg("latency_s").alias("mean_latency_s"), F.avg(F.when(first, F.col("latency_s"))).alias("_t"))
    m = cut_lineage(agg.select("phase", F.expr(
        "stack(5, 'requests', requests, 'error_rate', error_rate, 'mean_latency_s', mean_latency_s, "
        "'latency_ms', _t * 1000, 'throughput_tps', 1 / _t) as (metric, value)")))
    c = compare(m.filter(F.col("phase") == "before"), m.filter(F.col("phase") == "after"), PHASE_METRICS)
    return c.select("pos", "metric", *[F.round(x, 6).alias(x) for x in ("baseline", "candidate", "delta", "delta_pct")])


@register("latest_run", """
SELECT event_type AS run_id, arg_max(ts, (ts, event_id)) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY event_type
""")
def q_latest_run(spark, sf_dir):
    """Newest record per run key (runs keyed by event type; equal times: the larger id)."""
    from quarry.operators.metrics import latest_run
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("run_id"), "ts", "event_id", "value")
    return latest_run(e, "run_id", ["ts", "event_id"]).select("run_id", "ts", "event_id", "value")
