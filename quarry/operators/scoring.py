"""Scoring of model outputs held in tables.

Per-row work is native array/string functions; rollups are grouped aggregates.
The only collect_list calls gather one conversation or one report, which are
bounded by construction, never a whole category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import (BEGIN_OF_TEXT, END_OF_TEXT, STRIP_CHARS, col, lower_tokens,
                                   token_count)

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
PASS_THRESHOLD = 0.6          # a case passes at >= 60 % coverage
QUICK_PASS_THRESHOLD = 0.5    # quick check: PASS at >= 50 %, else WARN
TIER_STRONG = 0.8             # keyword score tiers: >= 0.8 strong, >= 0.6 moderate, else weak
TIER_MODERATE = 0.6
# ---------------------------------------------------------------------------


def pair_outputs(cases: DataFrame, outputs: DataFrame, on: Sequence[str] | str = "test_id",
                 how: str = "inner") -> DataFrame:
    """Cases matched to outputs by key (``how='left'`` keeps cases without output)."""
    return cases.join(outputs, on, how)


def cases_without_output(cases: DataFrame, outputs: DataFrame, on: Sequence[str] | str = "test_id") -> DataFrame:
    """J1 left variant: cases that have no output (left-anti join)."""
    return cases.join(outputs, on, "left_anti")


def coverage(df: DataFrame, expected_col: str = "expected_elements", output_col: str = "output",
             mode: str = "words") -> DataFrame:
    """Found / missing lists (order and duplicates kept) and the 0..1 coverage score.

    ``mode='words'``: element substring, or a multi-word element whose every
    word occurs somewhere; ``mode='substring'``: substring only. An empty
    expected list scores 1.0; a missing output is an empty one.
    """
    low = F.col("_low")

    def hit(e: Column) -> Column:
        el = F.lower(e)
        direct = low.contains(el)
        if mode == "substring":
            return direct
        words = F.split(F.btrim(el, F.lit(STRIP_CHARS)), r"[ \t\n\r\f\u000b]+")
        return direct | ((F.size(words) > 1) & F.forall(words, lambda w: low.contains(w)))

    flags = F.transform(expected_col, lambda e: F.struct(e.alias("e"), hit(e).alias("h")))
    n = F.size(expected_col)
    return (df.withColumn("_low", F.lower(F.coalesce(F.col(output_col), F.lit("")))).withColumn("_flags", flags)
              .withColumn("elements_found", F.transform(F.filter("_flags", lambda x: x["h"]), lambda x: x["e"]))
              .withColumn("elements_missing", F.transform(F.filter("_flags", lambda x: ~x["h"]), lambda x: x["e"]))
              .withColumn("coverage_score", F.when(n > 0, F.size("elements_found") / n).otherwise(F.lit(1.0)))
              .drop("_low", "_flags"))


def validation_summary(results: DataFrame, score_col: str = "coverage_score", latency_col: str | None = None,
                       tokens_col: str | None = "tokens_generated", total_time: Column | float | None = None,
                       threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Tests, passed, pass rate, mean coverage (raw and of 1-decimal percents), tokens, throughput."""
    s = F.col(score_col)
    aggs = [F.count(F.lit(1)).alias("total_tests"),
            F.count_if(s >= F.lit(threshold)).alias("passed_tests"),
            F.avg(s).alias("avg_coverage_score"),
            F.avg(F.round(s * 100, 1)).alias("average_coverage")]
    if latency_col:
        aggs += [F.avg(latency_col).alias("avg_latency_ms"), (F.sum(latency_col) / 1000).alias("total_time_seconds")]
    if tokens_col:
        aggs.append(F.sum(tokens_col).alias("total_tokens"))
    out = results.agg(*aggs).withColumn(
        "pass_rate", F.try_divide(F.col("passed_tests"), F.col("total_tests")) * 100)
    if tokens_col and total_time is not None:
        t = total_time if isinstance(total_time, Column) else F.lit(float(total_time))
        out = out.withColumn("tokens_per_second", F.when(t > 0, F.try_divide(F.col("total_tokens"), t))
                             .otherwise(F.lit(0.0)))
    return out


def quick_verdict(score: str | Column) -> Column:
    """A9 quick variant: PASS at >= 50 %, else WARN."""
    return F.when(col(score) >= F.lit(QUICK_PASS_THRESHOLD), F.lit("PASS")).otherwise(F.lit("WARN"))


def category_breakdown(results: DataFrame, category_col: str = "category",
                       score_col: str = "coverage_score", threshold: float = PASS_THRESHOLD) -> DataFrame:
    """A10: per category the count, mean coverage (percent, unrounded) and pass rate (percent)."""
    s = F.col(score_col)
    return results.groupBy(category_col).agg(
        F.count(F.lit(1)).alias("test_count"),
        (F.avg(s) * 100).alias("avg_coverage"),
        (F.avg(F.when(s >= F.lit(threshold), 1.0).otherwise(0.0)) * 100).alias("pass_rate"))


def tier(score: str | Column) -> Column:
    s = col(score)
    return (F.when(s >= F.lit(TIER_STRONG), F.lit("strong"))
             .when(s >= F.lit(TIER_MODERATE), F.lit("moderate")).otherwise(F.lit("weak")))


def keyword_score(results: DataFrame, suite_col: str = "suite", hit_col: str = "hit",
                  overall_label: str = "overall") -> DataFrame:
    """Hits / tests per suite plus an overall row, with a strength tier."""
    h = F.col(hit_col).cast("int")
    per = results.groupBy(F.col(suite_col).cast("string").alias("suite")).agg(
        F.count(F.lit(1)).alias("tests"), F.sum(h).alias("hits"))
    tot = results.agg(F.count(F.lit(1)).alias("tests"), F.sum(h).alias("hits")) \
                 .select(F.lit(overall_label).alias("suite"), "tests", "hits")
    both = per.unionByName(tot)
    return both.withColumn("score", F.try_divide(F.col("hits"), F.col("tests"))).withColumn("tier", tier("score"))


def consistency(runs: DataFrame, prompt_col: str = "prompt", output_col: str = "output") -> DataFrame:
    """One row per prompt; consistent when every run produced the same text."""
    return (runs.groupBy(F.sha2(F.col(prompt_col), 256).alias("prompt_hash"))
                .agg(F.count(F.lit(1)).alias("runs"),
                     F.count_distinct(F.sha2(F.col(output_col), 256)).alias("distinct_outputs"))
                .withColumn("consistent", F.col("distinct_outputs") == 1))


def added_terms(pairs: DataFrame, id_cols: Sequence[str], original_col: str, summary_col: str,
                vocabulary: DataFrame, term_col: str = "term") -> DataFrame:
    """Vocabulary terms of the summary that are absent from the original; valid iff none.

    Both texts of a pair are exploded at once, cut to the vocabulary, and one
    aggregate per (pair, term) tells which side had it. Lists are gathered per
    pair (one summary each). A missing text has no terms.
    """
    ids = list(id_cols)

    def side(c: str, original: bool) -> Column:
        return F.transform(F.coalesce(F.array_distinct(lower_tokens(c)), F.array().cast("array<string>")),
                           lambda t: F.struct(t.alias(term_col), F.lit(original).alias("_orig")))

    toks = pairs.select(*ids, F.explode(F.concat(side(original_col, True), side(summary_col, False))).alias("_x"))
    toks = toks.select(*ids, f"_x.{term_col}", "_x._orig").join(vocabulary.select(term_col).distinct(), term_col, "left_semi")
    added = toks.groupBy(*ids, term_col).agg(F.max("_orig").alias("_orig")).filter(~F.col("_orig"))
    per = added.groupBy(*ids).agg(F.array_sort(F.collect_list(term_col)).alias("added_terms"))
    return (pairs.select(*ids).join(per, ids, "left")
                 .withColumn("added_terms", F.coalesce("added_terms", F.array().cast("array<string>")))
                 .withColumn("n_added", F.size("added_terms"))
                 .withColumn("valid", F.col("n_added") == 0))


def render_conversation(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text",
                        add_generation_prompt: bool = False, raise_error: bool = False) -> DataFrame:
    """One chat string per conversation.

    A leading system turn becomes a plain prefix; then ``User: ..\\n`` and
    ``Assistant: ..<eos>\\n``; other roles print nothing. The order rule only
    asks that ``user`` sits exactly on the even positions after the system
    turn; violators get ``valid = false`` and a null text (or an error with
    ``raise_error``).
    """
    msgs = F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                                F.col(text_col).alias("text"))))
    g = turns.groupBy(conv_col).agg(msgs.alias("_m"))
    first_sys = F.coalesce(F.col("_m")[0]["role"] == "system", F.lit(False))
    g = (g.withColumn("_sys", F.when(first_sys, F.col("_m")[0]["text"]).otherwise(F.lit("")))
          .withColumn("_rest", F.when(first_sys, F.slice("_m", 2, F.greatest(F.size("_m") - 1, F.lit(0))))
                                .otherwise(F.col("_m"))))
    valid = F.forall(F.transform("_rest", lambda m, i: (m["role"] == "user") == (i % 2 == 0)), lambda b: b)
    body = F.array_join(F.transform("_rest", lambda m: (
        F.when(m["role"] == "user", F.concat(F.lit("User: "), m["text"], F.lit("\n")))
         .when(m["role"] == "assistant", F.concat(F.lit("Assistant: "), m["text"], F.lit(END_OF_TEXT + "\n")))
         .otherwise(F.lit("")))), "")
    text = F.concat(F.lit(BEGIN_OF_TEXT), F.coalesce(F.col("_sys"), F.lit("")), body)
    if add_generation_prompt:
        text = F.concat(text, F.lit("Assistant:"))
    out = g.withColumn("valid", valid).withColumn("n_messages", F.size("_m"))
    rendered = F.when(F.col("valid"), text)
    if raise_error:
        rendered = rendered.otherwise(
            F.raise_error(F.lit("a user turn must stand on every even position after the system turn")))
    return out.withColumn("rendered", rendered).drop("_m", "_sys", "_rest")


def turn_pairs(conversations: DataFrame, question: str = "input", answer: str = "output") -> DataFrame:
    """Every user turn with the assistant turn that follows it (null when there is none)."""
    u = conversations.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias(question))
    a = conversations.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias(answer))
    return pair_outputs(u, a, ["conv_id", "turn"], "left")


def user_turn_cases(conversations: DataFrame) -> DataFrame:
    """Cases from user turns (FIXTURES bindings): expected elements are the distinct lower-cased tokens, sorted,
    and the first two tokens as one multi-word element; the category is the turn number; the output is the
    next assistant turn, null when there is none."""
    toks = lower_tokens("input")
    pair = F.when(F.size(toks) >= 2, F.array(F.array_join(F.slice(toks, 1, 2), " "))).otherwise(F.array().cast("array<string>"))
    exp = F.concat(F.array_sort(F.array_distinct(toks)), pair)
    return turn_pairs(conversations).select("conv_id", "turn", F.col("turn").cast("string").alias("category"), "input",
                                            F.coalesce(exp, F.array().cast("array<string>")).alias("expected_elements"), "output")


# A blank line ends a section; the line breaks stay with the section before them.
SECTION_BOUNDARY = r"(?<=\n\n)(?=[^\n])"


def split_sections(df: DataFrame, id_col: str, text_col: str = "text", min_tokens: int = 3500,
                   boundary: str = SECTION_BOUNDARY) -> DataFrame:
    """Texts over ``min_tokens`` tokens split after blank lines, one row per section; nothing is dropped."""
    long_rows = df.filter(token_count(text_col) > min_tokens)
    return long_rows.select(id_col, F.posexplode(F.split(F.col(text_col), boundary)).alias("section_pos", "section"))


def combine_sections(sections: DataFrame, id_col: str, section_col: str = "section") -> DataFrame:
    """P14 recombination: sections back in order give the text itself (bounded: one document per group)."""
    return sections.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_pos", section_col))),
                                 lambda s: s[section_col]), "").alias("combined"),
        F.count(F.lit(1)).alias("n_sections"))
