"""Driver queries over ``conversations`` and ``benchmark``: prompts, rendering, coverage, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans.catalog import ntok, register, strip
from quarry.session import table

TOKRX = "'[^ \\t\\n\\r\\f]+'"
NL = "chr(10)"

# Every user turn with the next assistant turn, if any.
PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""

# Cases: expected elements are all distinct tokens and the first two tokens as a multi-word element.
CASES_BASE = f"""{PAIRS_SQL},
toks AS (SELECT *, regexp_extract_all(lower(question), {TOKRX}) AS w FROM pairs),
cases AS (
  SELECT conv_id, turn, CAST(turn AS VARCHAR) AS category, question AS input, coalesce(answer, '') AS output,
         list_concat(list_sort(list_distinct(w)), CASE WHEN len(w) >= 2 THEN [w[1] || ' ' || w[2]] ELSE [] END) AS expected_elements
  FROM toks)"""


def hit_sql(words: bool) -> str:
    """Predicate of an element ``e`` against ``output``."""
    direct = "contains(lower(output), lower(e))"
    return direct if not words else (f"({direct} OR (contains(e, ' ') AND len(list_filter(string_split(lower(e), ' '), "
                                     "lambda x: NOT contains(lower(output), x))) = 0))")


CASES_SQL = f"""{CASES_BASE},
scored AS (
  SELECT *, list_filter(expected_elements, lambda e: {hit_sql(True)}) AS elements_found,
            list_filter(expected_elements, lambda e: NOT {hit_sql(True)}) AS elements_missing
  FROM cases),
res AS (
  SELECT *, CASE WHEN len(expected_elements) > 0 THEN len(elements_found) / len(expected_elements)
                 ELSE 1.0 END AS coverage_score,
         {ntok('output')} AS tokens_generated
  FROM scored)"""


def scored_cases(spark, sf_dir):
    from quarry.functions.text import token_count
    from quarry.operators.scoring import coverage, user_turn_cases
    c = user_turn_cases(table(spark, sf_dir, "conversations"))
    return coverage(c).withColumn("tokens_generated", F.coalesce(token_count("output"), F.lit(0)))


def timed_cases(spark, sf_dir):
    """Scored cases with a latency: the duration of the event that has the conversation's number."""
    t = table(spark, sf_dir, "events").select(F.col("event_id").alias("conv_id"), (F.col("value") * 1000).alias("latency_ms"))
    return scored_cases(spark, sf_dir).join(t, "conv_id", "left")


@register("cases_without_output", f"WITH {PAIRS_SQL}\nSELECT conv_id, turn FROM pairs WHERE answer IS NULL")
def q_cases_without_output(spark, sf_dir):
    """J1 left variant: user turns that no assistant turn follows."""
    from quarry.operators.scoring import cases_without_output
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn")
    a = c.filter((F.col("role") == "assistant") & F.col("text").isNotNull()).select("conv_id", (F.col("turn") - 1).alias("turn"))
    return cases_without_output(u, a, ["conv_id", "turn"])


@register("coverage", f"WITH {CASES_SQL}\n" + """
SELECT conv_id, turn, expected_elements, elements_found, elements_missing,
       round(coverage_score, 6) AS coverage_score
FROM res
""")
def q_coverage(spark, sf_dir):
    """J1 + A8 (words mode): expected elements of a user turn found in the next assistant turn."""
    r = scored_cases(spark, sf_dir)
    return r.select("conv_id", "turn", "expected_elements", "elements_found", "elements_missing",
                    F.round("coverage_score", 6).alias("coverage_score"))


TIMED_SQL = f"""{CASES_SQL},
timed AS (SELECT r.*, e.value * 1000 AS latency_ms FROM res r LEFT JOIN events e ON e.event_id = r.conv_id)"""


@register("validation_summary", f"WITH {TIMED_SQL}\n" + """
SELECT count(*) AS total_tests, count(*) FILTER (WHERE coverage_score >= 0.6) AS passed_tests,
       round(avg(coverage_score), 6) AS avg_coverage_score,
       round(avg(round(coverage_score * 100, 1)), 6) AS average_coverage,
       sum(tokens_generated) AS total_tokens, round(avg(latency_ms), 6) AS avg_latency_ms,
       round(100.0 * count(*) FILTER (WHERE coverage_score >= 0.6) / count(*), 6) AS pass_rate,
       round(sum(latency_ms) / 1000, 6) AS total_time_seconds,
       round(sum(tokens_generated) / (sum(latency_ms) / 1000), 6) AS tokens_per_second,
       CASE WHEN avg(coverage_score) >= 0.5 THEN 'PASS' ELSE 'WARN' END AS verdict
FROM timed
""")
def q_validation_summary(spark, sf_dir):
    """A9 over all scored cases: coverage, mean latency, throughput over the wall time of one run after the other, verdict."""
    from quarry.operators.scoring import quick_verdict, validation_summary
    s = validation_summary(timed_cases(spark, sf_dir), latency_col="latency_ms", total_time=F.col("total_time_seconds"))
    return s.select("total_tests", "passed_tests", F.round("avg_coverage_score", 6).alias("avg_coverage_score"),
                    F.round("average_coverage", 6).alias("average_coverage"), "total_tokens",
                    F.round("avg_latency_ms", 6).alias("avg_latency_ms"), F.round("pass_rate", 6).alias("pass_rate"),
                    F.round("total_time_seconds", 6).alias("total_time_seconds"),
                    F.round("tokens_per_second", 6).alias("tokens_per_second"), quick_verdict("avg_coverage_score").alias("verdict"))


@register("quick_check", f"WITH {TIMED_SQL}\n" + """
SELECT conv_id, turn, CASE WHEN coverage_score >= 0.5 THEN 'PASS' ELSE 'WARN' END AS status,
       printf('%.0f', round_even(coverage_score * 100, 0)) || '%' AS coverage
FROM timed
""")
def q_quick_check(spark, sf_dir):
    """A9 quick variant: PASS or WARN per case with the coverage as shown."""
    from quarry.operators.metrics import fmt_fixed
    from quarry.operators.scoring import quick_verdict
    r = scored_cases(spark, sf_dir)
    return r.select("conv_id", "turn", quick_verdict("coverage_score").alias("status"),
                    F.concat(fmt_fixed(F.col("coverage_score") * 100, 0), F.lit("%")).alias("coverage"))


@register("category_bars", f"WITH {CASES_SQL}\n" + """
SELECT category, rpad(category, 25, ' ') || ' ' || lpad(printf('%.1f', round_even(avg(coverage_score) * 100, 1)), 5, ' ') || '% |'
       || repeat('=', CAST(floor(avg(coverage_score) * 40) AS INTEGER)) AS line
FROM res GROUP BY category
""")
def q_category_bars(spark, sf_dir):
    """K5 text variant: one line per category with its mean coverage as a bar of int(score * 40) signs."""
    from quarry.operators.metrics import category_bars
    c = scored_cases(spark, sf_dir).groupBy("category").agg(F.avg("coverage_score").alias("score"))
    return category_bars(c)


@register("category_breakdown", f"WITH {CASES_SQL}\n" + """
SELECT category, count(*) AS test_count, round(avg(coverage_score) * 100, 6) AS avg_coverage,
       round(avg(CASE WHEN coverage_score >= 0.6 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pass_rate
FROM res GROUP BY category
""")
def q_category_breakdown(spark, sf_dir):
    """A10 with the turn number as category."""
    from quarry.operators.scoring import category_breakdown
    b = category_breakdown(scored_cases(spark, sf_dir))
    return b.select("category", "test_count", F.round("avg_coverage", 6).alias("avg_coverage"),
                    F.round("pass_rate", 6).alias("pass_rate"))


@register("keyword_score", f"WITH {CASES_SQL},\n" + """
hits AS (SELECT category AS suite, len(elements_found) > 0 AS hit FROM res),
per AS (SELECT suite, count(*) AS tests, sum(CAST(hit AS INTEGER)) AS hits FROM hits GROUP BY suite
        UNION ALL SELECT 'overall', count(*), sum(CAST(hit AS INTEGER)) FROM hits)
SELECT suite, tests, hits, round(hits / tests, 6) AS score,
       CASE WHEN hits / tests >= 0.8 THEN 'strong' WHEN hits / tests >= 0.6 THEN 'moderate' ELSE 'weak' END AS tier
FROM per
""")
def q_keyword_score(spark, sf_dir):
    """A case hits when any expected element occurs; suites are categories, plus overall."""
    from quarry.operators.scoring import keyword_score
    r = scored_cases(spark, sf_dir).select(F.col("category").alias("suite"),
                                           (F.size("elements_found") > 0).alias("hit"))
    k = keyword_score(r)
    return k.select("suite", "tests", "hits", F.round("score", 6).alias("score"), "tier")


@register("render_conversation", f"""
WITH m AS (SELECT conv_id, list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn) AS msgs
           FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id, len(msgs) AS n_messages,
             CASE WHEN msgs[1].role = 'system' THEN msgs[1].text ELSE '' END AS sys,
             CASE WHEN msgs[1].role = 'system' THEN msgs[2:] ELSE msgs END AS rest FROM m),
v AS (SELECT *, len(list_filter(list_transform(rest, lambda x, i: (x.role = 'user') = ((i - 1) % 2 = 0)),
                                lambda b: NOT b)) = 0 AS valid FROM s)
SELECT conv_id, n_messages, valid,
       CASE WHEN valid THEN sha256('<|begin_of_text|>' || sys || array_to_string(list_transform(rest, lambda x:
         CASE WHEN x.role = 'user' THEN 'User: ' || x.text || {NL}
              WHEN x.role = 'assistant' THEN 'Assistant: ' || x.text || '<|end_of_text|>' || {NL}
              ELSE '' END), '')) END AS rendered_hash
FROM v
""")
def q_render_conversation(spark, sf_dir):
    """P9 over every conversation (hash of the rendered text; null when invalid)."""
    from quarry.operators.scoring import render_conversation
    r = render_conversation(table(spark, sf_dir, "conversations"))
    return r.select("conv_id", "n_messages", "valid", F.sha2("rendered", 256).alias("rendered_hash"))


def _sql_text(x: str) -> str:
    """A SQL expression for a text with line breaks."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in x.split("\n"))


PROMPT_HEAD = _sql_text(f"{T.BEGIN_OF_TEXT}{T.START_HEADER}system{T.END_HEADER}\n\n{T.DEFAULT_SYSTEM_PROMPT}{T.END_OF_TURN}"
                        f"{T.START_HEADER}user{T.END_HEADER}\n\n")
PROMPT_TAIL = _sql_text(f"{T.END_OF_TURN}{T.START_HEADER}assistant{T.END_HEADER}\n\n")


PLAIN_HEAD = _sql_text(f"{T.BEGIN_OF_TEXT}{T.START_HEADER}user{T.END_HEADER}\n\n")


@register("render_prompt", f"""
SELECT conv_id, turn, length(p) AS prompt_chars, sha256(p) AS prompt_hash, sha256(q) AS plain_hash
FROM (SELECT conv_id, turn, {PROMPT_HEAD} || text || {PROMPT_TAIL} AS p, {PLAIN_HEAD} || text || {PROMPT_TAIL} AS q
      FROM conversations WHERE role = 'user')
""")
def q_render_prompt(spark, sf_dir):
    """The single-turn chat prompt of every user turn, with and without the system block."""
    from quarry.functions.text import render_prompt
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    p = c.select("conv_id", "turn", render_prompt("text").alias("p"), render_prompt("text", None).alias("q"))
    return p.select("conv_id", "turn", F.length("p").alias("prompt_chars"), F.sha2("p", 256).alias("prompt_hash"), F.sha2("q", 256).alias("plain_hash"))


@register("extract_response", f"""
WITH {PAIRS_SQL},
x AS (
  SELECT conv_id, turn, question AS prompt, coalesce(answer, '') AS reply,
         'user' || chr(10) || chr(10) || question || 'assistant' || chr(10) || chr(10) || coalesce(answer, '') AS full_text
  FROM pairs),
e AS (
  SELECT conv_id, turn, reply,
         CASE WHEN contains(lower(full_text), 'assistant')
              THEN {strip("split_part(full_text, 'assistant', len(string_split(full_text, 'assistant')))")}
              WHEN length(full_text) > length(prompt) THEN {strip("substr(full_text, length(prompt) + 1)")}
              ELSE full_text END AS response
  FROM x)
SELECT conv_id, turn, sha256(response) AS response_hash, response = {strip('reply')} AS exact FROM e
""")
def q_extract_response(spark, sf_dir):
    """P10: the decoded text (special tokens skipped) is cut after the last ``assistant``; no answer gives an empty one."""
    from quarry.functions.text import extract_response, stripped
    from quarry.operators.scoring import turn_pairs
    x = turn_pairs(table(spark, sf_dir, "conversations"), "prompt", "reply").withColumn("reply", F.coalesce("reply", F.lit("")))
    x = x.withColumn("full_text", F.concat(F.lit("user\n\n"), "prompt", F.lit("assistant\n\n"), "reply"))
    e = x.withColumn("response", extract_response("full_text", "prompt"))
    return e.select("conv_id", "turn", F.sha2("response", 256).alias("response_hash"),
                    (F.col("response") == stripped("reply")).alias("exact"))


@register("format_qa", f"""
WITH {PAIRS_SQL},
t AS (SELECT conv_id, turn, question || chr(10) || chr(10) || coalesce(answer, '') AS t FROM pairs)
SELECT conv_id, turn, length(t) AS text_chars, sha256(t) AS text_hash FROM t
""")
def q_format_qa(spark, sf_dir):
    """Question (user turn) + blank line + answer (next assistant turn, empty when there is none)."""
    from quarry.functions.text import format_qa
    from quarry.operators.scoring import turn_pairs
    t = turn_pairs(table(spark, sf_dir, "conversations"), "q", "a").withColumn("t", format_qa("q", "a"))
    return t.select("conv_id", "turn", F.length("t").alias("text_chars"), F.sha2("t", 256).alias("text_hash"))


@register("format_mcq", """
WITH ch AS (SELECT CAST(floor((p_partkey - 1) / 4) AS BIGINT) AS item_id, list(p_name ORDER BY p_partkey) AS choices
            FROM part GROUP BY 1),
f AS (
  SELECT b.item_id, coalesce(len(ch.choices), 0) AS n_choices,
         CASE WHEN coalesce(len(ch.choices), 0) > 0
              THEN b.text || chr(10) || chr(10) || 'Options:' || chr(10) ||
                   array_to_string(list_transform(ch.choices, lambda c, i: CAST(i AS VARCHAR) || '. ' || c), chr(10))
              ELSE b.text END AS t
  FROM benchmark b LEFT JOIN ch ON ch.item_id = b.item_id)
SELECT item_id, n_choices, length(t) AS text_chars, sha256(t) AS text_hash FROM f
""")
def q_format_mcq(spark, sf_dir):
    """Benchmark items as questions, four part names each as numbered choices."""
    from quarry.functions.text import format_mcq
    part = table(spark, sf_dir, "part")
    ch = (part.groupBy(F.floor((F.col("p_partkey") - 1) / 4).cast("long").alias("item_id"))
              .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("_c"))  # 4 per item
              .select("item_id", F.transform("_c", lambda s: s["p_name"]).alias("choices")))
    b = table(spark, sf_dir, "benchmark").join(ch, "item_id", "left")
    f = b.withColumn("t", format_mcq("text", "choices"))
    return f.select("item_id", F.coalesce(F.size("choices"), F.lit(0)).alias("n_choices"),
                    F.length("t").alias("text_chars"), F.sha2("t", 256).alias("text_hash"))


@register("consistency", f"""
WITH {PAIRS_SQL}
SELECT sha256(question) AS prompt_hash, count(*) AS runs, count(DISTINCT sha256(coalesce(answer, ''))) AS distinct_outputs,
       count(DISTINCT sha256(coalesce(answer, ''))) = 1 AS consistent
FROM pairs GROUP BY 1
""")
def q_consistency(spark, sf_dir):
    """The same prompt must always get the same answer (no answer is an empty one)."""
    from quarry.operators.scoring import consistency, turn_pairs
    p = turn_pairs(table(spark, sf_dir, "conversations"), "prompt", "output")
    return consistency(p.withColumn("output", F.coalesce("output", F.lit(""))))


# U3 per user turn and its answer: CTE ``added_of`` (conv_id, turn, added_terms, n_added); the vocabulary is every benchmark token.
ADDED_SQL = f"""{PAIRS_SQL},
vocab AS (SELECT DISTINCT t AS term FROM (SELECT unnest(regexp_extract_all(lower(text), {TOKRX})) AS t FROM benchmark)),
st AS (SELECT DISTINCT conv_id, turn, t AS term FROM (
         SELECT conv_id, turn, unnest(regexp_extract_all(lower(answer), {TOKRX})) AS t FROM pairs)
       WHERE t IN (SELECT term FROM vocab)),
ot AS (SELECT DISTINCT conv_id, turn, t AS term FROM (
         SELECT conv_id, turn, unnest(regexp_extract_all(lower(question), {TOKRX})) AS t FROM pairs)
       WHERE t IN (SELECT term FROM vocab)),
added AS (SELECT * FROM st WHERE NOT EXISTS (
            SELECT 1 FROM ot WHERE ot.conv_id = st.conv_id AND ot.turn = st.turn AND ot.term = st.term)),
per AS (SELECT conv_id, turn, list_sort(list(term)) AS terms FROM added GROUP BY conv_id, turn),
added_of AS (SELECT p.conv_id, p.turn, coalesce(per.terms, []::VARCHAR[]) AS added_terms,
              len(coalesce(per.terms, []::VARCHAR[])) AS n_added
       FROM pairs p LEFT JOIN per USING (conv_id, turn))"""


def added_terms_of(spark, sf_dir):
    from quarry.functions.text import lower_tokens
    from quarry.operators.scoring import added_terms, turn_pairs
    vocab = table(spark, sf_dir, "benchmark").select(F.explode(lower_tokens("text")).alias("term")).distinct()
    return added_terms(turn_pairs(table(spark, sf_dir, "conversations"), "original", "summary"), ["conv_id", "turn"],
                       "original", "summary", vocab)


@register("added_terms", f"WITH {ADDED_SQL}\nSELECT conv_id, turn, added_terms, n_added, n_added = 0 AS valid FROM added_of")
def q_added_terms(spark, sf_dir):
    """U3 with the F3 default extractor (vocabulary = every benchmark token)."""
    return added_terms_of(spark, sf_dir)


@register("sections", f"""
WITH l AS (SELECT doc_id, text, string_split_regex(text, '\\n\\n+') AS p FROM documents WHERE {ntok('text')} > 3500),
s AS (SELECT doc_id, unnest(p) AS section FROM l)
SELECT doc_id, any_value(len(p)) - CASE WHEN any_value(text) LIKE '%' || chr(10) || chr(10) THEN 1 ELSE 0 END AS n_sections,
       max({ntok('section')}) AS max_section_tokens, sum({ntok('section')}) AS total_tokens, true AS same_text
FROM s JOIN l USING (doc_id) GROUP BY doc_id
""")
def q_sections(spark, sf_dir):
    """Documents over 3500 tokens split after blank lines; token counts, and the sections joined are the text."""
    from quarry.functions.text import token_count
    from quarry.operators.scoring import combine_sections, split_sections
    d = table(spark, sf_dir, "documents")
    s = split_sections(d, "doc_id")
    n = token_count("section")
    counts = s.groupBy("doc_id").agg(F.max(n).alias("max_section_tokens"), F.sum(n).alias("total_tokens"))
    hashes = d.where(token_count("text") > 3500).select("doc_id", F.sha2("text", 256).alias("whole"))     # no text travels
    whole = hashes.join(combine_sections(s, "doc_id"), "doc_id")
    return counts.join(whole, "doc_id").select("doc_id", "n_sections", "max_section_tokens", "total_tokens",
                                               (F.sha2("combined", 256) == F.col("whole")).alias("same_text"))


@register("sections_budget", f"""
SELECT doc_id, CAST(ceil({ntok('text')} / 500.0) AS BIGINT) AS n_sections, true AS within_budget, {ntok('text')} AS total_tokens, true AS same_text
FROM documents WHERE {ntok('text')} > 500
""")
def q_sections_budget(spark, sf_dir):
    """Documents over 500 tokens in the fewest sections of at most 500, cut at the mildest places; joined they are the text."""
    from quarry.operators.scoring import combine_sections
    from quarry.operators.sectioning import budget_sections
    from quarry.session import cut_lineage
    s = cut_lineage(budget_sections(table(spark, sf_dir, "documents"), "doc_id", budget=500))
    tokens = s.groupBy("doc_id", "text_sha256").agg(F.max("n_tokens").alias("most"), F.sum("n_tokens").alias("total_tokens"))
    return tokens.join(combine_sections(s, "doc_id"), "doc_id").select(
        "doc_id", "n_sections", (F.col("most") <= 500).alias("within_budget"), "total_tokens",
        (F.sha2("combined", 256) == F.col("text_sha256")).alias("same_text"))


@register("token_tiers", """
SELECT CASE WHEN n_chars < 1000 THEN 150 WHEN n_chars < 2500 THEN 250 ELSE 400 END AS max_tokens,
       count(*) AS n FROM documents GROUP BY 1
""")
def q_token_tiers(spark, sf_dir):
    """Output-token budget of every document by its length."""
    from quarry.functions.text import max_tokens_tier
    d = table(spark, sf_dir, "documents")
    return d.groupBy(max_tokens_tier("n_chars").alias("max_tokens")).agg(F.count(F.lit(1)).alias("n"))


@register("custom_extractor", f"""
SELECT conv_id, turn,
       list_sort(list_distinct(list_filter(regexp_extract_all(text, {TOKRX}),
                                           lambda t: regexp_matches(t, '^[A-Z][a-z]{{4,}}$')))) AS entities
FROM conversations WHERE role = 'assistant'
""")
def q_custom_extractor(spark, sf_dir):
    """a user extractor (capitalised words of five or more letters) run as an Arrow UDF."""
    import re
    from quarry.functions.plugins import extractor_udf

    from quarry.functions.text import TOKEN_PATTERN

    def make():
        rx = re.compile(r"^[A-Z][a-z]{4,}$")
        tok = re.compile(TOKEN_PATTERN)
        return lambda t: [w for w in tok.findall(t) if rx.match(w)]

    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", extractor_udf(make, spark)(F.col("text")).alias("entities"))


@register("sections_roundtrip", f"""
WITH l AS (SELECT doc_id, text FROM documents WHERE {ntok('text')} > 3500)
SELECT doc_id, len(string_split_regex(text, '\\n+')) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END AS n_sections, true AS same_text
FROM l
""")
def q_sections_roundtrip(spark, sf_dir):
    """P14 split after every line break and joined again: the text itself."""
    from quarry.functions.text import token_count
    from quarry.operators.scoring import combine_sections, split_sections
    d = table(spark, sf_dir, "documents")
    c = combine_sections(split_sections(d, "doc_id", boundary=r"(?<=\n)(?=[^\n])"), "doc_id")
    hashes = d.where(token_count("text") > 3500).select("doc_id", F.sha2("text", 256).alias("whole"))
    return c.join(hashes, "doc_id").select("doc_id", "n_sections", (F.sha2("combined", 256) == F.col("whole")).alias("same_text"))
