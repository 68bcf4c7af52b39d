"""Coverage, summaries, golden category breakdown (FIXTURES B1), chat rendering."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import scoring as sc

# FIXTURES B1: found/total per case and its category.
GOLDEN = [
    ("clin_001", "clinical_qa", 6, 6), ("clin_002", "clinical_qa", 6, 6), ("clin_003", "clinical_qa", 5, 7),
    ("clin_004", "clinical_qa", 5, 6), ("pat_001", "patient_communication", 6, 7),
    ("pat_002", "patient_communication", 5, 7), ("rad_001", "radiology", 6, 8), ("rad_002", "radiology", 7, 7),
    ("rad_003", "radiology", 5, 6), ("rad_004", "radiology", 4, 7), ("med_001", "medication", 6, 6),
    ("med_002", "medication", 6, 6), ("med_003", "medication", 7, 7), ("diag_001", "diagnosis", 3, 6),
    ("diag_002", "diagnosis", 5, 7),
]


def test_coverage_words_vs_substring(spark):
    df = spark.createDataFrame([("chest pain was severe", ["pain chest", "severe", "fever", "severe"]),
                                ("anything", [])], "output string, expected_elements array<string>")
    w = sc.coverage(df, mode="words").collect()
    s = sc.coverage(df, mode="substring").collect()
    assert w[0].elements_found == ["pain chest", "severe", "severe"] and w[0].elements_missing == ["fever"]
    assert s[0].elements_found == ["severe", "severe"] and s[0].elements_missing == ["pain chest", "fever"]
    assert w[0].coverage_score == pytest.approx(0.75)
    assert w[1].coverage_score == 1.0 and s[1].coverage_score == 1.0


def test_golden_category_breakdown(spark):
    rows = [(i, c, f / t) for i, c, f, t in GOLDEN]
    df = spark.createDataFrame(rows, "test_id string, category string, coverage_score double")
    got = {r.category: (r.test_count, round(r.avg_coverage, 1), round(r.pass_rate, 1))
           for r in sc.category_breakdown(df).collect()}
    assert got == {"medication": (3, 100.0, 100.0), "clinical_qa": (4, 88.7, 100.0),
                   "patient_communication": (2, 78.6, 100.0), "radiology": (4, 78.9, 75.0),
                   "diagnosis": (2, 60.7, 50.0)}
    s = sc.validation_summary(df, tokens_col=None).collect()[0]
    assert s.total_tests == 15 and s.passed_tests == 13
    # the published 83.2 is the mean of per-case scores rounded to one decimal (83.24);
    # the unrounded mean is 83.254
    assert round(s.average_coverage, 1) == 83.2 and round(s.pass_rate, 1) == 86.7
    assert round(s.avg_coverage_score * 100, 3) == 83.254


def test_throughput_golden(spark):
    from quarry.operators.metrics import throughput
    # B2: 6,619 tokens in 20.57 s over 15 prompts.
    df = spark.createDataFrame([(6619, 20.57)], "tokens_generated long, time_seconds double")
    r = throughput(df).collect()[0]
    assert round(r.tokens_per_sec, 1) == 321.8


def test_keyword_score_tiers(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("a", True), ("a", True), ("a", False),
                                ("b", True), ("b", False)], "suite string, hit boolean")
    got = {r.suite: (r.hits, r.tests, r.tier) for r in sc.keyword_score(df).collect()}
    assert got == {"a": (4, 5, "strong"), "b": (1, 2, "weak"), "overall": (5, 7, "moderate")}


def conv(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_render_conversation_rules(spark):
    rows = [(1, 0, "system", "SYS"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"),
            (2, 0, "user", "a"), (2, 1, "user", "b"),                       # two users in a row: invalid
            (3, 0, "user", "a"), (3, 1, "tool", "t"), (3, 2, "user", "c")]  # extra role on odd slot: valid
    got = {r.conv_id: (r.valid, r.rendered) for r in sc.render_conversation(conv(spark, rows)).collect()}
    assert got[1] == (True, "<|begin_of_text|>SYSUser: hi\nAssistant: yo<|end_of_text|>\n")
    assert got[2] == (False, None)
    assert got[3] == (True, "<|begin_of_text|>User: a\nUser: c\n")


def test_render_conversation_raise(spark):
    rows = [(2, 0, "user", "a"), (2, 1, "user", "b")]
    with pytest.raises(Exception):
        sc.render_conversation(conv(spark, rows), raise_error=True).collect()


def test_added_terms(spark):
    pairs = spark.createDataFrame([(1, "liver lesion seen", "liver lesion and fracture"),
                                   (2, "fracture", "fracture")], "id long, original string, summary string")
    vocab = spark.createDataFrame([("liver",), ("lesion",), ("fracture",)], "term string")
    got = {r.id: (r.added_terms, r.valid) for r in sc.added_terms(pairs, ["id"], "original", "summary", vocab).collect()}
    assert got == {1: (["fracture"], False), 2: ([], True)}


def test_consistency(spark):
    runs = spark.createDataFrame([("p", "x"), ("p", "x"), ("q", "x"), ("q", "y")], "prompt string, output string")
    got = sorted((r.runs, r.consistent) for r in sc.consistency(runs).collect())
    assert got == [(2, False), (2, True)]
