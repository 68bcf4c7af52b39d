"""Structured Streaming jobs over the request log (T1-T4) and the audit sink.

Sources are file streams (``readStream.parquet`` with an explicit schema). Every
job writes under a folder that the caller owns (on a cluster: shared storage) and
keeps its checkpoint there, so starting a job again on the same folder resumes
after the last committed batch. The helpers run a query with ``availableNow``
(process what is there, then stop).

T1 keeps one aggregate per event-time window, T2 the last computed request and the
requests after the watermark per input, dealt into groups of inputs. Both emit in update mode: each micro-batch writes its changed rows to ``batch_id=N`` (rewriting it makes a
retry idempotent), and readers take the newest row of each key. So the window
that is still open at the end of the input comes out, too, state is dropped
behind the watermark, and the answer does not depend on how the events fall into
files as long as none is later than the watermark.

``events.ts`` is ``timestamp_ntz``; watermarks need ``timestamp``, so the
request log derives the instant from epoch microseconds of the wall-clock
value (independent of the session time zone) and keeps the wall clock as
``ts_ntz``; window bounds are turned back into wall-clock values the same way.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ranges import exact_percentiles
from quarry.operators.requests import (PANEL_PERCENTILES, REVIEW_CONFIDENCE, SLA_P95_SECONDS, micros_ntz, request_log,
                                       retention_cutoff_us, review_reason)
from quarry.session import cut_lineage, ship_package

# Window length and the (ours) watermark delay.
WINDOW = "1 hour"
WATERMARK = "10 minutes"
#: Leading binary digits that a latency keeps in the sketch.
SKETCH_BITS = 8


def event_stream(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                 max_files: int | None = None) -> DataFrame:
    """Events as a stream; the schema comes from the files once (a footer read, no data)."""
    schema = spark.read.parquet(os.path.join(folder, file_glob)).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def run_to_parquet(df: DataFrame, out: str, mode: str = "append", partition_by: list[str] | None = None) -> str:
    """Run a streaming frame to a parquet folder with ``availableNow`` and wait for it."""
    w = (df.writeStream.format("parquet").outputMode(mode)
           .option("path", os.path.join(out, "data"))
           .option("checkpointLocation", os.path.join(out, "checkpoint"))
           .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return os.path.join(out, "data")


def run_updates(df: DataFrame, out: str) -> str:
    """Run an aggregating stream in update mode; every batch writes its changed rows to ``batch_id=N``."""
    data = os.path.join(out, "data")
    q = (df.writeStream.outputMode("update")
           .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(os.path.join(data, f"batch_id={i}")))
           .option("checkpointLocation", os.path.join(out, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return data


def newest(spark: SparkSession, data: str, keys: list[str]) -> DataFrame:
    """The last state of every key of an update-mode sink."""
    rows = spark.read.parquet(data)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_r"))
    return last.select(*keys, "_r.*")


def _bounds(*cols):
    """Window bounds as wall-clock values."""
    return [micros_ntz(F.unix_micros("window.start")).alias("window_start"),
            micros_ntz(F.unix_micros("window.end")).alias("window_end"), *cols]


def latency_counts(events: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """T1 stream: requests per (window, latency, status).

    State has a row per distinct value of an open window, spread over all state
    partitions, instead of one map of values per window.
    """
    log = request_log(events).withWatermark("ts", watermark)
    g = log.groupBy(F.window("ts", window), "latency_s", "status").agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds("latency_s", "status", "n"))


def bucket_value(seconds: Column, bits: int = SKETCH_BITS) -> Column:
    """Middle of the value's bucket: whole microseconds with their ``bits`` leading binary digits.

    At most ``2 ** (bits - 1)`` buckets a power of two, each within
    ``2 ** -bits`` of its values, relatively (values below ``2 ** bits``
    microseconds are kept). Null stays null, negative values count as 0.
    """
    us = F.greatest(F.round(seconds * 1_000_000).cast("long"), F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(us)) - bits, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", us, shift), shift)
    half = F.call_function("shiftright", F.call_function("shiftleft", F.lit(1).cast("long"), shift), F.lit(1))
    return F.when(seconds.isNotNull(), (low + half) / 1_000_000)


def latency_sketch(events: DataFrame, window: str = WINDOW, watermark: str = WATERMARK, bits: int = SKETCH_BITS) -> DataFrame:
    """T1 stream with bounded state: requests per (window, bucket of the latency, status).

    The counts of a window are a mergeable sketch: counts of parts, files or
    windows add up. State per window is at most ``2 ** (bits - 1)`` rows a power of
    two of the latency, however many requests and distinct values there are
    (``latency_counts`` keeps each value). ``latency_windows`` gives the panel;
    buckets keep the order of values, so every percentile is within ``2 ** -bits``
    of the exact one, relatively (half a microsecond more from rounding).
    """
    log = request_log(events).withColumn("latency_s", bucket_value(F.col("latency_s"), bits)).withWatermark("ts", watermark)
    g = log.groupBy(F.window("ts", window), "latency_s", "status").agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds("latency_s", "status", "n"))


def latency_windows(counts: DataFrame, sla: float = SLA_P95_SECONDS) -> DataFrame:
    """T1 panel over the counts: per window requests, failures, exact P50/P95 latency and the SLA flag."""
    bounds = ["window_start", "window_end"]
    p = exact_percentiles(counts, "latency_s", [PANEL_PERCENTILES[0], PANEL_PERCENTILES[3]], bounds, weight="n")
    failed = counts.groupBy(*bounds).agg(F.sum("n").alias("requests"), F.sum(F.when(F.col("status") == "failed", F.col("n")).otherwise(0)).alias("failed"))
    return failed.join(p.drop("n", "max"), bounds).select(
        *bounds, "requests", "failed", F.round(F.col("p")[0], 6).alias("p50"), F.round(F.col("p")[1], 6).alias("p95"),
        (F.col("p")[1] < F.lit(sla)).alias("sla_ok"))


TTL_ROWS = "input_key string, request_id long, start_us long, first_request long, first_us long"
_TTL_STATE = "input_keys array<string>, us array<long>, ids array<long>, settled array<boolean>"
#: Groups that the inputs are dealt into; part of a running job's state, so a folder keeps the number it began with.
TTL_GROUPS = 4096
#: Start of a request without a time.
_NO_TIME = -2 ** 63


def _serve(ttl_us: int):
    """Decides the requests of one group of inputs, each input in event-time order; see ``serve_with_ttl``."""
    def run(key, batches, state):
        import numpy as np
        import pandas as pd

        # rows of the state: per input the last computed request that is final (settled), and the requests after the watermark
        old = state.get if state.exists else ([], [], [], [])
        new = [] if state.hasTimedOut else [(b["input_key"].to_numpy(object), b["start_us"].to_numpy(np.int64), b["request_id"].to_numpy(np.int64))
                                            for b in batches]
        watermark = state.getCurrentWatermarkMs() * 1000
        names = np.concatenate([np.array(old[0], object), *[x for x, _, _ in new]])
        us = np.concatenate([np.array(old[1], np.int64), *[x for _, x, _ in new]])
        ids = np.concatenate([np.array(old[2], np.int64), *[x for _, _, x in new]])
        final = np.concatenate([np.array(old[3], bool), np.zeros(len(us) - len(old[3]), bool)])
        fresh = np.arange(len(us)) >= len(old[0])
        untimed = us == _NO_TIME                                   # serve nothing, are served by nothing
        if untimed.any():
            n = pd.array([pd.NA] * int(untimed.sum()), "Int64")
            yield pd.DataFrame({"input_key": names[untimed], "request_id": ids[untimed], "start_us": n, "first_request": ids[untimed], "first_us": n})
            names, us, ids, final, fresh = (x[~untimed] for x in (names, us, ids, final, fresh))
        code, inputs = pd.factorize(names)
        order = np.lexsort((ids, us, ~final, code))
        code, us, ids, final, fresh = (x[order] for x in (code, us, ids, final, fresh))
        # an answer serves until ttl after it was computed: jump from one computed request to the next of the input
        times = np.unique(us)
        place = code * (len(times) + 1) + np.searchsorted(times, us)
        jump = np.searchsorted(place, code * (len(times) + 1) + np.searchsorted(times, us + ttl_us)).tolist()
        ends = np.searchsorted(code, np.arange(len(inputs)), "right").tolist()
        computed, at = [], 0
        for end in ends:
            while at < end:
                computed.append(at)
                at = jump[at]
        by = np.repeat(np.array(computed, np.int64), np.diff([*computed, len(us)])) if computed else np.zeros(0, np.int64)
        # no request up to the watermark can come any more: of those, the last computed one of the input stays while it serves
        is_open = us > watermark
        past = np.flatnonzero(~is_open)
        last = past[np.append(code[past][1:] != code[past][:-1], True)] if len(past) else past
        kept = by[last][us[by[last]] + ttl_us > watermark]
        stay = np.concatenate([kept, np.flatnonzero(is_open)])
        if len(stay):
            wake = us[is_open].max() if is_open.any() else (us[kept] + ttl_us).max()
            state.update((inputs[code[stay]].tolist(), us[stay].tolist(), ids[stay].tolist(), (np.arange(len(stay)) < len(kept)).tolist()))
            state.setTimeoutTimestamp(max(int(wake) // 1000 + 1, watermark // 1000 + 1))
        else:
            state.remove()
        told = np.isin(code, code[fresh]) & ~final
        if told.any():
            yield pd.DataFrame({"input_key": inputs[code[told]], "request_id": ids[told], "start_us": us[told], "first_request": ids[by[told]],
                                "first_us": us[by[told]]})
    return run


def serve_with_ttl(events: DataFrame, ttl_seconds: int = 3600, watermark: str = WATERMARK, groups: int = TTL_GROUPS) -> DataFrame:
    """T2 stream: every request with the request whose answer serves it (``TTL_ROWS``).

    The first request of an input is computed; its answer serves requests of the
    same input that start less than ``ttl_seconds`` after it, the next later one
    is computed again. State per input is the last computed request that is final
    and the requests after the watermark; a timer drops it once both are past.
    Rows come in update mode: a request that is not final yet is decided again
    when an earlier one arrives, and the newest row of a request counts. So the
    answer does not depend on how the requests fall into files. Requests without
    a start are computed and serve no other; those without an input are left out.

    Inputs are dealt by hash into ``groups`` that are decided as arrays, so the
    cost of a call is paid per group and not per input. A group's requests of one
    micro-batch meet in one call; ``max_files`` of the source bounds a micro-batch.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    ship_package(events.sparkSession)
    log = request_log(events).where("input_key is not null").withWatermark("ts", watermark)
    log = log.select("ts", "input_key", F.coalesce("start_us", F.lit(_NO_TIME)).alias("start_us"), "request_id",
                     F.pmod(F.xxhash64("input_key"), F.lit(groups)).alias("_group"))
    return log.groupBy("_group").applyInPandasWithState(_serve(ttl_seconds * 1_000_000), TTL_ROWS, _TTL_STATE, "update",
                                                        GroupStateTimeout.EventTimeTimeout)


def served(rows: DataFrame) -> DataFrame:
    """Per computed request its input, start and the requests it serves (itself included)."""
    return (rows.groupBy("input_key", "first_request", "first_us").agg(F.count(F.lit(1)).alias("requests"),
                                                                       F.max("start_us").alias("last_us")))


def first_occurrences(events: DataFrame, key: str = "input_key", ttl: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """T2 stream: per (input, fixed window of ``ttl``) the first request and the number of requests; the first
    one is computed, the others are served from the cache. State is dropped with the window."""
    log = request_log(events).withWatermark("ts", watermark)
    g = log.groupBy(F.window("ts", ttl), key).agg(F.min(F.struct("start_us", "request_id")).alias("_first"), F.count(F.lit(1)).alias("requests"))
    return g.select(*_bounds(key, F.col("_first.request_id").alias("first_request"), "requests"))


def route_batch(batch: DataFrame, batch_id: int, out: str, threshold: float = REVIEW_CONFIDENCE) -> None:
    """T3 sink: one micro-batch split in two folders; rewriting ``batch_id=N`` makes a retry idempotent."""
    routed = batch.withColumn("route", F.when(review_reason(batch, threshold).isNotNull(), F.lit("review"))
                              .otherwise(F.lit("publish")))
    for route in ("review", "publish"):
        (routed.filter(F.col("route") == route).drop("route")
               .write.mode("overwrite").parquet(os.path.join(out, route, f"batch_id={batch_id}")))


def stream_review_route(events: DataFrame, out: str, added: DataFrame | None = None) -> tuple[str, str]:
    """Failed results, results of low confidence and results that add terms go to the human queue, the rest is published.

    ``added`` is a table ``(request_id, n_added)`` of added-term counts (U3), joined to every micro-batch.
    """
    log = request_log(events)
    if added is not None:
        log = log.join(added, "request_id", "left").withColumn("n_added", F.coalesce("n_added", F.lit(0)))
    q = (log.writeStream.foreachBatch(lambda b, i: route_batch(b, i, out))
            .option("checkpointLocation", os.path.join(out, "checkpoint"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return os.path.join(out, "review"), os.path.join(out, "publish")


AUDIT_MODEL_VERSION = "quarry-eval-1"


def audit_records(log: DataFrame, salt: str = "audit") -> DataFrame:
    """S16 record shape: ids, masked subject, hashes, confidence, review flags (never updated in place)."""
    return log.select(
        F.col("request_id").cast("string").alias("report_id"),
        F.sha2(F.concat(F.lit(salt), F.col("user_id").cast("string")), 256).alias("patient_mrn"),
        F.col("ts").alias("generated_at"),
        F.col("start_us").alias("generated_us"),
        F.lit(AUDIT_MODEL_VERSION).alias("model_version"),
        F.sha2(F.col("input_key"), 256).alias("input_hash"),
        F.sha2(F.concat_ws("|", F.col("reason"), F.col("latency_s").cast("string")), 256).alias("output_hash"),
        F.col("confidence").alias("confidence_score"),
        F.lit(False).alias("human_reviewed"),
        F.lit(None).cast("string").alias("reviewer_id"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
        F.col("day").alias("date"))


def audit_append(records: DataFrame, path: str) -> None:
    """S16 batch sink: append-only, partitioned by date."""
    records.write.mode("append").partitionBy("date").parquet(path)


def audit_stream(events: DataFrame, out: str) -> str:
    """S16 streaming sink: the same records appended by a parquet file sink with a checkpoint."""
    return run_to_parquet(audit_records(request_log(events)), out, partition_by=["date"])


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The date partitions that are there now (a stream's own file list would still name removed ones)."""
    return spark.read.option("basePath", path).parquet(os.path.join(path, "date=*"))


def purge(spark: SparkSession, path: str, as_of: str, days: int = 30) -> list[str]:
    """T4: removes records at or before ``as_of - days`` from a sink partitioned by date; returns the removed dates.

    Whole date partitions before the cutoff are deleted as folders; the cutoff's
    own day is rewritten without its old records. ``as_of`` is a parameter, never now().
    """
    cutoff_us = retention_cutoff_us(as_of, days)
    day = F.to_date(micros_ntz(cutoff_us))
    df = read_audit(spark, path)
    old = [str(r.date) for r in df.where(F.col("date") < day).select("date").distinct().orderBy("date").collect()]   # one a day
    split = df.where((F.col("date") == day) & (F.col("generated_us") <= cutoff_us))
    if split.limit(1).count():
        kept = cut_lineage(df.where((F.col("date") == day) & (F.col("generated_us") > cutoff_us)))
        if kept.limit(1).count():
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
        else:
            old.append(str(split.select("date").first().date))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in old:
        fs.delete(fs_path(os.path.join(path, f"date={d}")), True)
    return old
