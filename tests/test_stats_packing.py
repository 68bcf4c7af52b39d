"""Statistics, batches, packing, perplexity and quantization invariants."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import packing as pk
from quarry.operators import perplexity as pp
from quarry.operators import stats as st
from quarry.operators import vectors as vq


def test_distribution_sums_to_100(spark):
    df = spark.createDataFrame([(x,) for x in "aaabbc"], "k string")
    rows = st.distribution(df, "k").collect()
    assert [r.k for r in rows] == ["a", "b", "c"]
    assert sum(r.percent for r in rows) == pytest.approx(100.0)


def test_length_stats_population_std(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n_tokens int")
    r = st.length_stats(df).collect()[0]
    assert r.median == 2.5 and r.std == pytest.approx(math.sqrt(1.25), abs=1e-6) and r.total_tokens == 10


def test_global_index_and_batches(spark):
    df = spark.range(0, 1000, 3).select(F.col("id").alias("k")).repartition(7)
    b = pk.assign_batches(df, 10, "k").collect()
    idx = sorted((r.k, r.idx) for r in b)
    assert [i for _, i in idx] == list(range(len(idx)))
    assert all(r.batch_id == r.idx // 10 for r in b)


def _walk(rows, max_length, min_length, max_samples, kept):
    """Reference loop over (key, chars, ntok) rows, for comparison."""
    if kept >= max_samples // 2:
        return []
    packs, buf, members, toks = [], 0, [], 0
    for k, ch, nt in rows:
        buf += ch + 1
        members.append(k)
        toks += nt
        if buf > 2 * max_length:
            if min(toks, max_length) >= min_length:
                packs.append(members)
            buf, members, toks = 0, [], 0
            if kept + len(packs) >= max_samples:
                break
    return packs


def test_pack_short_matches_sequential_loop(spark):
    texts = [(i, " ".join(["w%d" % j for j in range(50 + (i * 37) % 150)])) for i in range(120)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    # every text has 50..199 tokens, under min_length=250: all are pack candidates, none is kept
    got = pk.pack_short(df, max_length=600, min_length=250, max_samples=10).orderBy("pack_id").collect()
    ref = _walk([(k, len(t), len(t.split())) for k, t in texts], 600, 250, 10, 0)
    assert len(ref) == 10
    assert [(r.first_doc, r.last_doc, r.n_texts) for r in got] == [(m[0], m[-1], len(m)) for m in ref]
    assert all(r.chars > 1200 for r in got)


def test_packs_that_are_thrown_away_cost_no_budget(spark):
    # long tokens close packs of too few tokens; the texts after them still fill the budget
    texts = [(i, " ".join(["x" * 40] * 60)) for i in range(200)] + [(1000 + i, " ".join(["ab"] * 100)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = pk.pack_short(df, max_length=600, min_length=250, max_samples=10).collect()
    assert len(got) == 10 and min(r.first_doc for r in got) >= 1000 and all(r.n_tokens >= 250 for r in got)


def test_pack_short_not_needed_when_enough_kept(spark):
    texts = [(i, " ".join(["w"] * 300)) for i in range(10)] + [(100 + i, " ".join(["w"] * 60)) for i in range(50)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert pk.pack_short(df, max_samples=10).count() == 0       # 10 kept >= 10 // 2


def test_perplexity_edge_cases(spark):
    losses = spark.createDataFrame([("d", 1, 1, 9.0, 1), ("d", 2, 5, 2.0, 5), ("e", 1, 1, 1.0, 1)],
                                   "dataset string, batch_id long, padded_len int, loss double, tokens long")
    got = {r.dataset: r for r in pp.perplexity(losses).collect()}
    assert got["d"].perplexity == pytest.approx(math.exp(2.0)) and got["d"].num_batches == 1
    assert got["d"].num_samples == 2
    assert got["e"].loss == float("inf") and got["e"].total_tokens == 0
    suite = {r.dataset: r for r in pp.perplexity_suite(losses).collect()}
    assert suite["e"].error == "no tokens" and suite["d"].error is None


def test_quantization_error_within_half_scale(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    for bits, gs, sym in [(4, 16, True), (3, 32, False), (8, 64, True)]:
        q = vq.error_columns(vq.quantize(e, "embedding", bits, gs, sym))
        bad = q.filter(F.col("max_error") > F.array_max("scales") / 2 + 1e-9).count()
        assert bad == 0
    with pytest.raises(ValueError):
        vq.quantize(e, "embedding", 5, 16, True)


def test_compare_baseline_zero_and_missing(spark):
    from quarry.operators.metrics import compare, comparison_text
    b = spark.createDataFrame([("x", 0.0), ("y", 2.0)], "metric string, value double")
    c = spark.createDataFrame([("x", 1.0), ("y", 3.0)], "metric string, value double")
    rows = {r.metric: r for r in comparison_text(compare(b, c, ["x", "y", "z"])).collect()}
    assert rows["x"].delta_pct_text == "+0.0%" and rows["y"].delta_pct_text == "+50.0%"
    assert rows["z"].baseline_text == "N/A" and rows["z"].delta_text == "N/A"


def test_augment_terms_multiword_and_quota(spark):
    corpus = spark.createDataFrame([(1, "Chest pain and fever"), (2, "pain chest"), (3, "chest  PAIN today"),
                                    (4, "fever only"), (5, "xchest pain")], "doc_id long, text string")
    terms = spark.createDataFrame([("chest pain",), ("fever",)], "term string")
    got = st.augment_with_terms(corpus, terms, per_term=5).collect()
    by = {}
    for r in got:
        by.setdefault(r.term, set()).add(r.doc_id)
    assert by == {"chest pain": {1, 3}, "fever": {1, 4}}
    capped = st.augment_with_terms(corpus, terms, per_term=1).collect()
    assert sorted(r.term for r in capped) == ["chest pain", "fever"]


def test_global_index_skewed_keys(spark):
    # keys crowded at one end
    df = spark.range(0, 3000).select((F.pow(F.col("id"), 3) + F.col("id")).cast("long").alias("k")).repartition(5)
    got = sorted((r.k, r.idx) for r in pk.global_index(df, "k").collect())
    assert [i for _, i in got] == list(range(3000))


def test_empty_inputs_do_not_divide_by_zero(spark):
    from quarry.operators import requests as rq
    from quarry.operators import scoring as sc
    empty = spark.createDataFrame([], "coverage_score double, tokens_generated long")
    r = sc.validation_summary(empty).collect()[0]
    assert r.total_tests == 0 and r.pass_rate is None
    docs = spark.createDataFrame([], "text string, n_tokens int")
    assert {x.check: x.value for x in st.quality_checks(docs).collect()}["domain_percent"] is None
    assert st.min_length_sweep(docs).count() == 4
    ev = spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                   "props string")
    log = rq.request_log(ev)
    assert rq.request_panel(log).count() == 2          # total and per-day rows, no failure
    assert rq.review_panel(log).count() == 1


def test_review_panel_decisions_and_added_terms(spark):
    from quarry.operators import requests as rq
    ev = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 1, "error", 1.0, '{"k": 1}'), (2, "2024-01-01 00:01:00", 1, "view", 1.0, '{"k": 50}'),
         (3, "2024-01-01 00:02:00", 2, "view", 1.0, '{"k": 1}'), (4, "2024-01-01 00:03:00", 3, "view", 1.0, '{"k": 2}')],
        "event_id long, ts string, user_id long, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    log = rq.request_log(ev).withColumn("n_added", F.when(F.col("request_id") == 3, 2).otherwise(0))
    dec = spark.createDataFrame([(1, "approved"), (2, "revised"), (3, "approved")], "request_id long, decision string")
    rows = {(r.section, r.key): (r.n, r.percent) for r in rq.review_panel(log, decisions=dec).collect()}
    assert rows[("queue", "all")] == (3, 75.0)
    assert rows[("reason", "failed")][0] == 1 and rows[("reason", "low_confidence")][0] == 1
    assert rows[("reason", "added_terms")][0] == 1
    assert rows[("decision", "approved")] == (2, round(200 / 3, 6)) and rows[("decision", "revised")][0] == 1


def test_pack_short_sharded_invariants(spark):
    texts = [(i, " ".join(["w%d" % j for j in range(50 + (i * 37) % 150)])) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = pk.pack_short(df, max_length=600, min_length=250, max_samples=12, n_shards=3).collect()
    assert 0 < len(got) <= 12
    assert len({r.pack_id for r in got}) == len(got)
    assert all(r.chars > 1200 and r.n_tokens >= 250 for r in got)
    spans = [(r.first_doc, r.last_doc, r.n_texts) for r in got]
    assert sum(n for _, _, n in spans) <= len(texts)           # every text used at most once overall
    one = pk.pack_short(df, max_length=600, min_length=250, max_samples=12, n_shards=1).collect()
    assert len(one) == 12


def test_burst_is_spread_and_exact(spark):
    from quarry.operators import requests as rq
    burst = spark.range(9995).select((F.col("id") % 50).alias("start_us"), (F.col("id") % 50 + 30).alias("end_us"))
    log = burst.union(spark.createDataFrame([(10 ** 12 + i * 10 ** 11, 10 ** 12 + i * 10 ** 11 + 5) for i in range(5)], "start_us long, end_us long"))
    got = rq.concurrency(log).collect()[0]
    ev = sorted([(r.start_us, 1) for r in log.collect()] + [(r.end_us, -1) for r in log.collect()])
    active, seen = 0, []
    for _, d in ev:
        active += d
        if d == 1:
            seen.append(active)
    assert (got.max_concurrent, got.max_queue_ahead) == (max(seen), max(seen) - 1)
    assert got.mean_active_at_arrival == pytest.approx(sum(seen) / len(seen), abs=1e-6)


def test_exact_percentiles_by_group(spark):
    import numpy as np
    from quarry.operators.ranges import exact_percentiles
    rng = np.random.default_rng(1)
    data = {"a": rng.random(501), "b": np.array([2.0]), "c": np.repeat([1.0, 3.0], [5, 200])}
    df = spark.createDataFrame([(g, float(x)) for g, v in data.items() for x in v] + [("a", None)], "g string, x double").repartition(7)
    for r in exact_percentiles(df, "x", [0.1, 0.5, 0.99], ["g"]).collect():
        assert r.n == len(data[r.g]) and r.max == data[r.g].max()
        assert np.allclose(r.p, np.quantile(data[r.g], [0.1, 0.5, 0.99]))


def test_constant_group_survives_asymmetric_quantization(spark):
    df = spark.createDataFrame([([0.5] * 8,), ([-0.25] * 8,), ([0.0] * 8,)], "embedding array<double>")
    for r in vq.quantize(df, "embedding", 4, 8, False).collect():
        assert r.dequant == pytest.approx(r.embedding, abs=1e-9)


def test_stage_without_numbers_has_no_row(spark):
    from quarry.operators.metrics import summary_metrics
    ppl = spark.createDataFrame([("d", None, "no tokens")], "dataset string, perplexity double, error string")
    tasks = spark.createDataFrame([("t", None)], "task string, metric double")
    assert summary_metrics(ppl, tasks, None).count() == 0
