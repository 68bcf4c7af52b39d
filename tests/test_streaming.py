"""Structured Streaming jobs on small file streams: file layout, late rows, restart, removal."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators.requests import request_log
from quarry.session import checkpoint_dir, scratch
from quarry.streaming import jobs

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
WINDOW = ["window_start", "window_end"]


def events(spark, rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, h, m), 1, et, v, '{"k": 1}') for i, h, m, et, v in rows], EVENT)


def stream(spark, src, per_batch=1):
    return (spark.readStream.schema(EVENT).option("maxFilesPerTrigger", per_batch)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(src))


def latency(spark, src, out):
    data = jobs.run_updates(jobs.latency_counts(stream(spark, src)), out)
    return jobs.latency_windows(jobs.newest(spark, data, [*WINDOW, "latency_s", "status"]))


def test_late_rows_are_dropped_and_the_open_window_comes_out(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    events(spark, [(1, 10, 5, "view", 1.0), (2, 10, 20, "error", 3.0), (3, 11, 30, "view", 2.0)]).coalesce(1).write.parquet(src + "/b1")
    # the second batch moves the watermark to 12:30; the third brings a row older than the watermark
    events(spark, [(5, 12, 40, "view", 1.0)]).coalesce(1).write.parquet(src + "/b2")
    events(spark, [(4, 10, 10, "view", 9.0)]).coalesce(1).write.parquet(src + "/b3")
    got = {r.window_start.hour: (r.requests, r.failed, r.p50) for r in latency(spark, src, out).collect()}
    assert got == {10: (2, 1, 2.0), 11: (1, 0, 2.0), 12: (1, 0, 1.0)}


def test_one_file_and_ten_files_give_the_same(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    rows = e.orderBy("ts").collect()
    answers = []
    for n in (1, 10):
        src = str(tmp_path / f"src{n}")
        step = -(-len(rows) // n)
        for i in range(n):
            spark.createDataFrame(rows[i * step:(i + 1) * step], e.schema).coalesce(1).write.parquet(f"{src}/b{i:02d}")
        lat = sorted(map(tuple, latency(spark, src, str(tmp_path / f"lat{n}")).collect()))
        data = jobs.run_updates(jobs.first_occurrences(stream(spark, src)), str(tmp_path / f"first{n}"))
        first = sorted(map(tuple, jobs.newest(spark, data, [*WINDOW, "input_key"]).collect()))
        answers.append((lat, first))
    assert answers[0] == answers[1]
    log = request_log(e).withColumn("hour", F.date_trunc("hour", F.col("ts_ntz").cast("timestamp")))
    assert len(answers[0][1]) == log.select("hour", "input_key").distinct().count()
    assert sum(x[2] for x in answers[0][0]) == len(rows)


def test_restart_on_the_same_folder_resumes(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    events(spark, [(1, 10, 5, "view", 1.0)]).coalesce(1).write.parquet(src + "/b1")
    assert latency(spark, src, out).count() == 1
    events(spark, [(2, 10, 20, "view", 3.0), (3, 11, 0, "view", 1.0)]).coalesce(1).write.parquet(src + "/b2")
    got = {r.window_start.hour: r.requests for r in latency(spark, src, out).collect()}
    assert got == {10: 2, 11: 1}                         # the first file is not read again


def test_review_routes(spark, tmp_path):
    src = str(tmp_path / "src")
    events(spark, [(1, 10, 0, "view", 1.0), (2, 10, 5, "view", 1.0), (3, 10, 6, "error", 1.0)]).coalesce(1).write.parquet(src + "/b1")
    added = spark.createDataFrame([(2, 4), (9, 1)], "request_id long, n_added long")
    review, publish = jobs.stream_review_route(stream(spark, src), str(tmp_path / "out"), added)
    assert sorted(r.request_id for r in spark.read.parquet(review).collect()) == [2, 3]
    assert [r.request_id for r in spark.read.parquet(publish).collect()] == [1]


def test_purge_removes_old_records_from_disk(spark, tmp_path):
    path = str(tmp_path / "audit")
    e = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i // 4, 6 * (i % 4)), 1, "view", 1.0, '{"k": 1}') for i in range(16)], EVENT)
    jobs.audit_append(jobs.audit_records(request_log(e)), path)
    assert jobs.purge(spark, path, "2024-01-05 12:00:00", 3) == ["2024-01-01"]
    assert sorted(d for d in os.listdir(path) if d.startswith("date=")) == ["date=2024-01-02", "date=2024-01-03", "date=2024-01-04"]
    assert sorted(int(r.report_id) for r in jobs.read_audit(spark, path).collect()) == [7, *range(8, 16)]


def test_scratch_folder_is_removed(spark):
    with scratch(spark, "test") as out:
        spark.range(3).write.parquet(out)
        assert os.path.isdir(out.replace("file:", ""))
    assert not os.path.exists(out.replace("file:", ""))


def test_no_machine_local_checkpoints_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        applicationId = "cluster-app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_time_to_live_equals_the_walk_for_any_file_layout(spark, tmp_path):
    """Requests two hours apart at most, in 1 and 6 files, shuffled within the watermark; a restart in between."""
    import random
    r = random.Random(4)
    minute = sorted(r.randrange(0, 600) for _ in range(150))
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m, seconds=r.randrange(60)), r.randrange(2), "view", 1.0, '{"k": %d}' % r.randrange(3))
            for i, m in enumerate(minute)]
    e = spark.createDataFrame(rows, EVENT)
    want, last = {}, {}
    for x in request_log(e).orderBy("start_us", "request_id").collect():
        us, by = last.get(x.input_key, (None, None))
        if us is None or x.start_us >= us + 3_600_000_000:
            us, by = last[x.input_key] = x.start_us, x.request_id
        want[x.request_id] = by
    assert 3 < len(set(want.values())) < 100
    late = sorted(rows, key=lambda x: (x[1] + dt.timedelta(minutes=r.randrange(0, 8)), x[0]))     # up to 8 minutes out of order
    for n in (1, 6):
        src, out = str(tmp_path / f"ttl{n}"), str(tmp_path / f"ttl-out{n}")
        step = -(-len(late) // n)
        parts = [late[i * step:(i + 1) * step] for i in range(n)]
        for i, part in enumerate(parts):
            spark.createDataFrame(part, EVENT).coalesce(1).write.parquet(f"{src}/b{i:02d}")
            if i == 2:
                jobs.run_updates(jobs.serve_with_ttl(stream(spark, src)), out)                    # stops here and goes on below
        data = jobs.run_updates(jobs.serve_with_ttl(stream(spark, src)), out)
        got = jobs.newest(spark, data, ["request_id"]).collect()
        assert {x.request_id: x.first_request for x in got} == want


def test_latency_sketch_is_bounded_and_near(spark, tmp_path):
    """Every request has another latency: few state rows a window, percentiles within the stated bound."""
    import random
    r = random.Random(2)
    e = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i % 3, i % 60), 1, "view", 10 ** r.uniform(-3, 4), "{}") for i in range(4000)], EVENT)
    src = str(tmp_path / "sketch")
    e.repartition(4).write.parquet(src)
    data = jobs.run_updates(jobs.latency_sketch(stream(spark, src, per_batch=10)), str(tmp_path / "sketch-out"))
    counts = jobs.newest(spark, data, [*WINDOW, "latency_s", "status"]).cache()
    exact = {x.h: x for x in request_log(e).groupBy(F.hour("ts_ntz").alias("h")).agg(
        F.count("*").alias("n"), F.percentile("latency_s", 0.5).alias("p50"), F.percentile("latency_s", 0.95).alias("p95"),
        F.count_distinct("latency_s").alias("d"), F.log2(F.max("latency_s") / F.min("latency_s")).alias("octaves")).collect()}
    sizes = {x.h: x["count"] for x in counts.groupBy(F.hour("window_start").alias("h")).count().collect()}
    for x in jobs.latency_windows(counts).collect():
        y = exact[x.window_start.hour]
        assert x.requests == y.n and sizes[x.window_start.hour] <= 128 * (y.octaves + 2)
        assert abs(x.p50 - y.p50) <= y.p50 / 256 + 2e-6 and abs(x.p95 - y.p95) <= y.p95 / 256 + 2e-6
    one = spark.range(1).select(*[jobs.bucket_value(F.lit(v)).alias(f"v{i}") for i, v in enumerate((None, -1.0, 0.0, 255e-6, 1.0, 1e12))]).first()
    assert (one.v0, one.v1, one.v2, one.v3) == (None, 0.0, 0.0, 255e-6) and abs(one.v4 - 1) < 1 / 256 and abs(one.v5 / 1e12 - 1) < 1 / 256


def test_many_inputs_are_decided_in_one_call_as_the_watermark_moves():
    """One group of 300 inputs over several calls: answers equal the walk, settled inputs leave the state, a timer empties it."""
    import random

    import pandas as pd

    class State:
        get, exists, hasTimedOut, watermark = None, False, False, 0

        def getCurrentWatermarkMs(self):
            return self.watermark

        def update(self, value):
            self.get, self.exists = value, True

        def remove(self):
            self.get, self.exists = None, False

        def setTimeoutTimestamp(self, ms):
            assert ms > self.watermark
            self.wake = ms

    r, hour = random.Random(7), 3_600_000_000
    rows = sorted((r.randrange(1, 20 * hour), i, f"in{r.randrange(300)}") for i in range(4000))
    want, last = {}, {}
    for us, i, name in rows:
        if name not in last or us >= last[name][0] + hour:
            last[name] = (us, i)
        want[i] = last[name][1]
    assert 300 < len(set(want.values())) < 4000
    serve, state, got, top = jobs._serve(hour), State(), {}, 0
    for n in range(0, 4000, 500):
        part = rows[n:n + 500]
        r.shuffle(part)                                     # any order within a call
        frame = pd.DataFrame([(name, us, i) for us, i, name in part], columns=["input_key", "start_us", "request_id"])
        for out in serve((0,), iter([frame[:200], frame[200:]]), state):
            got.update(zip(out["request_id"], out["first_request"]))
        top = max(top, *[us for us, _, _ in part])
        state.watermark = (top - 1) // 1000 - 600_000       # counts from the next call on
    assert got == want
    state.hasTimedOut = True
    for _ in range(2):                                      # requests become final, then their answers end
        state.watermark = state.wake
        assert not list(serve((0,), iter([]), state)) and (not state.exists or all(state.get[3]))
    assert not state.exists


def test_requests_without_a_start_are_computed_alone(spark, tmp_path):
    rows = [(1, None), (2, dt.datetime(2024, 1, 1, 10, 0)), (3, dt.datetime(2024, 1, 1, 10, 30)), (4, None), (5, dt.datetime(2024, 1, 1, 11, 0))]
    src = str(tmp_path / "src")
    spark.createDataFrame([(i, t, 1, "view", 1.0, '{"k": 1}') for i, t in rows], EVENT).coalesce(1).write.parquet(src + "/b1")
    data = jobs.run_updates(jobs.serve_with_ttl(stream(spark, src), groups=2), str(tmp_path / "out"))
    got = {x.request_id: (x.first_request, x.first_us is None) for x in jobs.newest(spark, data, ["request_id"]).collect()}
    assert got == {1: (1, True), 2: (2, False), 3: (2, False), 4: (4, True), 5: (5, False)}
