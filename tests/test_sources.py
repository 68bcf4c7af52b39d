"""JSONL readers and writers, stats sidecar, results, registry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.sources import jsonl, registry, results


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_read_jsonl_checked_blank_and_malformed(spark):
    d = tempfile.mkdtemp()
    write(os.path.join(d, "a.jsonl"), '{"text": "one"}\n\n   \n{"text": "two", "source": "s"}\nnot json\n{"text": "three"}\n')
    good, bad, counts = jsonl.read_jsonl_checked(spark, d)
    c = counts.collect()[0]
    assert (c.total, c.valid, c.bad) == (4, 3, 1)
    assert [(r.line_no, r.line) for r in bad.collect()] == [(3, "not json")]
    assert sorted(r.text for r in good.collect()) == ["one", "three", "two"]


def test_read_jsonl_head_and_failfast(spark):
    d = tempfile.mkdtemp()
    write(os.path.join(d, "a.jsonl"), "".join('{"text": "t%d"}\n' % i for i in range(10)))
    assert sorted(r.text for r in jsonl.read_jsonl(spark, d, max_samples=3).collect()) == ["t0", "t1", "t2"]
    assert jsonl.read_jsonl(spark, d).count() == 10
    write(os.path.join(d, "b.jsonl"), "{broken\n")
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, d).collect()


def test_empty_file_is_an_error(spark):
    d = tempfile.mkdtemp()
    write(os.path.join(d, "a.jsonl"), "\n\n")
    with pytest.raises(Exception):
        jsonl.read_jsonl_checked(spark, d)[2].collect()


def test_stats_missing_source_is_unknown(spark):
    df = spark.createDataFrame([("a", "s1", None), ("b", None, "t")], "text string, source string, type string")
    got = {(r.section, r.key): r.n for r in jsonl.sample_stats(df).collect()}
    assert got == {("total", "all"): 2, ("sources", "s1"): 1, ("sources", "unknown"): 1, ("types", "unknown"): 1, ("types", "t"): 1}


def test_save_results_formats(spark):
    d = tempfile.mkdtemp()
    m = spark.createDataFrame([("ppl_x", 1.5), ("latency_ms", 2.0)], "metric string, value double")
    p = results.save_results(m, d, "csv", "20240101_000000")
    assert spark.read.option("header", True).csv(p).columns == ["latency_ms", "ppl_x"]
    results.save_results(m, d, "json", "20240101_000000")
    with pytest.raises(ValueError):
        results.save_results(m, d, "xml", "x")
    with pytest.raises(ValueError):
        results.save_results(m.withColumnRenamed("metric", "m"), d, "csv", "x")


def test_registry_unknown_and_skip(spark):
    reg = {"a": registry.SourceEntry("t", text_column="text"), "b": registry.SourceEntry("t")}
    df = spark.createDataFrame([(i, "x" * (40 + i)) for i in range(30)], "doc_id long, text string")
    read = lambda name: df
    with pytest.raises(ValueError):
        registry.load_source(spark, reg, "zz", 5, read)
    # the head of 2*5 rows holds keys 0..9, all <= 50 characters: a shortfall, not a refill
    assert registry.load_source(spark, reg, "a", 5, read).count() == 0
    got = registry.load_source(spark, reg, "a", 20, read).collect()   # head of 30 rows: keys 11..29 pass
    assert sorted(int(r.key) for r in got) == list(range(11, 30))
    named = df.withColumn("doc_id", F.format_string("k%02d", "doc_id"))
    assert sorted(r.key for r in registry.load_source(spark, reg, "a", 20, lambda n: named).collect()) == [f"k{i}" for i in range(11, 30)]
    assert registry.load_source(spark, reg, "b", 5, read).count() == 0
    rows, skipped = registry.load_with_failover(spark, reg, ["a", "zz"], 5, read)
    assert skipped == ["zz"]


def test_load_test_cases_document(spark):
    d = tempfile.mkdtemp()
    write(os.path.join(d, "cases.json"), '{"metadata": {"model": "m"}, "test_cases": ['
          + ",".join('{"id": "c%d", "category": "k", "task": "t", "input": "i", "expected_elements": ["a"], '
                     '"difficulty": "easy"}' % i for i in range(7)) + "]}")
    assert results.load_test_cases(spark, d).count() == 7
    assert [r.id for r in results.load_test_cases(spark, d, head=5).orderBy("case_pos").collect()] == \
        ["c0", "c1", "c2", "c3", "c4"]


def test_load_source_observes_shortfall(spark, caplog):
    from pyspark.sql import Observation
    reg = {"a": registry.SourceEntry("t", text_column="text")}
    df = spark.createDataFrame([(i, "x" * (40 + i)) for i in range(30)], "doc_id long, text string")
    obs = Observation("load_a")
    rows = registry.load_source(spark, reg, "a", 20, lambda n: df, observation=obs).collect()
    assert registry.warn_shortfall("a", obs, 20) == len(rows) == 19
    assert "gave 19 of the 20 rows" in caplog.text
