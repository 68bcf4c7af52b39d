"""Edge cases of the text expressions (FIXTURES B6)."""

from pyspark.sql import functions as F

from quarry.functions import text as tx


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_min_chars_strict_and_strips_tabs(spark):
    rows = [("a" * 50,), ("\t" + "a" * 50 + "\n",), ("a" * 51,), (None,)]
    assert one(spark, tx.min_chars("t", 50), rows, "t string") == [False, False, True, False]


def test_token_count_and_truncate(spark):
    rows = [("a  b\tc\nd",), ("",), (None,), ("x\x0by z",)]
    assert one(spark, tx.token_count("t"), rows, "t string") == [4, 0, 0, 2]
    out = one(spark, tx.truncate_tokens("t", 2), [("a  b\tc",), ("a b",)], "t string")
    assert out == ["a b", "a b"]
    # rows at the limit are returned unchanged (whitespace kept)
    assert one(spark, tx.truncate_tokens("t", 2), [("a \t b",)], "t string") == ["a \t b"]


def test_length_class_bounds_inclusive(spark):
    rows = [(255,), (256,), (4096,), (4097,)]
    assert one(spark, tx.length_class("n"), rows, "n int") == ["too_short", "accepted", "accepted", "too_long"]


def test_route_by_length(spark):
    rows = [("x", 49), ("x", 50), ("x", 255), ("x", 256), ("", 300), (None, 300)]
    got = one(spark, tx.route_by_length("t", "n"), rows, "t string, n int")
    assert got == ["drop", "pack", "pack", "keep", "drop", "drop"]


def test_format_mcq_empty_and_null_choices(spark):
    rows = [("Q", ["a", "b"]), ("Q", []), ("Q", None)]
    got = one(spark, tx.format_mcq("q", "c"), rows, "q string, c array<string>")
    assert got == ["Q\n\nOptions:\n1. a\n2. b", "Q", "Q"]


def test_format_qa(spark):
    assert one(spark, tx.format_qa("q", "a"), [("Q", "A"), (None, "A")], "q string, a string") == ["Q\n\nA", "\n\nA"]


def test_extract_response(spark):
    rows = [("prompt Assistant: said assistant  hello ", "prompt"), ("prompt and more", "prompt"), ("pro", "prompt")]
    got = one(spark, tx.extract_response("f", "p"), rows, "f string, p string")
    assert got == ["hello", "and more", "pro"]


def test_has_any_case_insensitive_literal(spark):
    rows = [("The Patient is here",), ("a.b",), ("axb",), (None,)]
    assert one(spark, tx.has_any("t", ["patient"]), rows, "t string") == [True, False, False, False]
    assert one(spark, tx.has_any("t", ["a.b"]), rows, "t string") == [False, True, False, False]


def test_max_tokens_tier(spark):
    rows = [(999,), (1000,), (2499,), (2500,)]
    assert one(spark, tx.max_tokens_tier("n"), rows, "n int") == [150, 250, 250, 400]


def test_identifier_reason(spark):
    rows = [("mail me: a.b@example.org",), ("call +1 (743) 555-3824",), ("nothing here",),
            ("card 4316522678525456",), ('token = "abc"',)]
    assert one(spark, tx.identifier_reason("t"), rows, "t string") == ["email", "phone", None, "card", "secret"]


def test_fill_template_placeholder(spark):
    rows = [("m1", None)]
    e = tx.fill_template("{{MODEL}} / {{SIZE}}", {"MODEL": "m", "SIZE": "s"})
    assert one(spark, e, rows, "m string, s string") == ["m1 / TBD"]


def test_render_prompt_markers(spark):
    p = one(spark, tx.render_prompt("q", system=None), [("hi",)], "q string")[0]
    assert p == "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>" \
                "<|start_header_id|>assistant<|end_header_id|>\n\n"


def test_content_hash_is_sha256(spark):
    import hashlib
    assert one(spark, tx.content_hash("t"), [("abc",)], "t string") == [hashlib.sha256(b"abc").hexdigest()]


def test_format_qa_variants(spark):
    import pytest
    df = spark.createDataFrame([("Q", "A"), ("Q", ""), (None, "A")], "q string, a string")
    assert [r.text for r in tx.format_qa_rows(df, "q", "a", on_missing="drop").collect()] == ["Q\n\nA"]
    assert len(tx.format_qa_rows(df, "q", "a").collect()) == 3
    with pytest.raises(Exception):
        tx.format_qa_rows(df, "q", "a", on_missing="error").collect()


def test_drop_prompt_prefix_and_encryption(spark):
    assert one(spark, tx.drop_prompt_prefix("f", "p"), [("prompt  answer ", "prompt")], "f string, p string") == ["answer"]
    key = "0123456789abcdef"
    got = one(spark, tx.decrypt_id(tx.encrypt_id("i", key), key), [("mrn-42",)], "i string")
    assert got == ["mrn-42"]
