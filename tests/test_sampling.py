"""Seeded sampling invariants, quotas, backfill, mix."""

from pyspark.sql import functions as F

from quarry.operators import sampling as sm
from quarry.plans.mix import prepare_mix


def docs(spark, n=300, parts=8):
    return spark.range(n).select(F.col("id").alias("doc_id"),
                                 F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b")
                                 .otherwise("c").alias("lang"),
                                 F.concat(F.lit("x" * 120), F.col("id").cast("string")).alias("text")) \
                .repartition(parts)


def test_scale_quotas_golden():
    assert sm.scale_quotas({"a": 307, "b": 154, "c": 51}, 256) == {"a": 153, "b": 77, "c": 25}
    assert sm.scale_quotas({"a": 307, "b": 154, "c": 51}, 1000) == {"a": 599, "b": 300, "c": 99}
    assert sm.scale_quotas({"a": 205, "b": 154, "c": 153}, 256) == {"a": 102, "b": 77, "c": 76}
    assert sm.scale_quotas({"a": 205, "b": 154, "c": 153}, 1000) == {"a": 400, "b": 300, "c": 298}


def test_same_seed_same_rows_any_partitioning(spark):
    a = {r.doc_id for r in sm.apply_quota(docs(spark, parts=1), "lang", {"a": 10, "b": 500}, 7).collect()}
    b = {r.doc_id for r in sm.apply_quota(docs(spark, parts=8), "lang", {"a": 10, "b": 500}, 7).collect()}
    assert a == b


def test_quota_respected_and_min_size(spark):
    got = sm.apply_quota(docs(spark), "lang", {"a": 10, "b": 500, "zz": 5}, 42).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"a": 10, "b": 100}


def test_top_per_group_equals_plain_window(spark):
    from pyspark.sql import Window
    d = docs(spark, n=5000, parts=90).withColumn("_h", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("|42"))))
    q = {"a": 100, "b": 1, "c": 3000}
    got = {(r.doc_id, r.rank) for r in sm.top_per_group(d, "lang", q, ["_h", "doc_id"]).collect()}
    w = Window.partitionBy("lang").orderBy("_h", "doc_id")
    ranked = d.withColumn("r", F.row_number().over(w)).collect()
    assert got == {(r.doc_id, r.r) for r in ranked if r.r <= q[r.lang]}
    same = {(r.doc_id, r.rank) for r in sm.top_per_group(d, "lang", 7, ["_h", "doc_id"]).collect()}
    assert same == {(r.doc_id, r.r) for r in ranked if r.r <= 7}
    assert sm.top_per_group(d, "lang", {"a": 0}, ["_h"]).count() == 0


def test_sample_seeded_prefix_property(spark):
    d = docs(spark)
    small = [r.doc_id for r in sm.sample_seeded(d, 20, 42).orderBy("rank").collect()]
    big = [r.doc_id for r in sm.sample_seeded(d, 50, 42).orderBy("rank").collect()]
    assert big[:20] == small


def test_backfill_rules(spark):
    main = docs(spark, n=10).filter(F.col("lang") == "a")          # 4 rows
    fb = docs(spark, n=100).withColumn("text", F.lit("y" * 201))
    out = sm.backfill(main, fb, 20)
    assert out.count() == 20
    none = sm.backfill(docs(spark, n=10), fb, 20)                   # n = 10 = target // 2: no backfill
    assert none.count() == 10


def test_mix_result_never_refilled(spark):
    d = docs(spark, n=3000).withColumn("text", F.concat_ws(" ", F.array_repeat(F.lit("w"), 300)))
    m = prepare_mix(d, {"a": 50, "b": 20}, total=60, seed=1)   # W5: quotas scale to 5 and 2
    assert m.count() == 7
    m2 = prepare_mix(d, {"a": 5, "b": 5}, total=512, seed=1)
    assert m2.count() == 10


def test_head_by_order_is_exact_for_any_key_type(spark):
    d = docs(spark, n=20000, parts=100).withColumn("k", (F.col("doc_id") * 7919) % 20011)
    want = sorted(r.k for r in d.select("k").collect())
    assert [r.k for r in sm.head_by_order(d, 1500, "k", "doc_id").collect()] == want[:1500]
    s = d.withColumn("k", F.format_string("k%03d", "doc_id"))
    assert [r.k for r in sm.head_by_order(s, 3, "k").collect()] == ["k000", "k001", "k002"]


def test_mix_starts_no_job_while_it_is_built(spark):
    from quarry.plans.mix import mix_distribution
    d = docs(spark, n=600)
    group = "build-only"
    spark.sparkContext.setJobGroup(group, "plan building")
    mix_distribution(d, {"a": 30, "b": 20}, total=50, seed=1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []


def test_disjoint_quota_breaks_shared_prefix(spark):
    pop = docs(spark, n=3000).filter(F.col("lang") == "a")
    two = pop.withColumn("lang", F.lit("s1")).unionByName(pop.withColumn("lang", F.lit("s2")))
    same = sm.apply_quota(two, "lang", {"s1": 30, "s2": 30}, 42).collect()
    s1 = {r.doc_id for r in same if r.lang == "s1"}
    s2 = {r.doc_id for r in same if r.lang == "s2"}
    assert s1 == s2                       # same seed over the same table: the same rows (U4)
    dj = sm.apply_quota_disjoint(two, "lang", {"s1": 30, "s2": 30}, 42).collect()
    d1 = {r.doc_id for r in dj if r.lang == "s1"}
    d2 = {r.doc_id for r in dj if r.lang == "s2"}
    assert len(d1) == len(d2) == 30 and len(d1 & d2) < 30


def test_preset_mix_skips_unknown_and_relabels_stand_in(spark):
    from quarry.plans.mix import prepare_preset_mix
    d = docs(spark, n=3000).withColumn("text", F.concat_ws(" ", F.array_repeat(F.col("doc_id").cast("string"), 300)))
    tables = {"pmc_patients": (d.filter(F.col("lang") == "b"), lambda df: F.col("text"))}
    mix, skipped = prepare_preset_mix("radiology", tables, total=512, seed=3)
    assert skipped == ["pubmedqa"]
    rows = mix.collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, set()).add(r.doc_id)
    assert len(by["PMC-Patients"]) == 154 and len(by["PMC-Patients (radiology-filtered)"]) == 51
    assert by["PMC-Patients (radiology-filtered)"] <= by["PMC-Patients"]      # same seed: a prefix
    with __import__("pytest").raises(ValueError):
        prepare_preset_mix("nonexistent", tables)
