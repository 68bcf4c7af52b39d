"""Driver queries for readers, writers, registries, plug-ins and composite jobs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quarry.plans.catalog import ntok, register, strip
from quarry.plans.queries_corpus import pack_budget, pack_ctes
from quarry.plans.queries_scoring import CASES_BASE, hit_sql
from quarry.session import cut_lineage, scratch, table

TOKRX = "'[^ \\t\\n\\r\\f]+'"


# --------------------------------------------------------------------------- S3, S5, F4
def registry():
    from quarry.sources.registry import SourceEntry
    return {
        "src0": SourceEntry("documents", "source = 'src0'", text_column="text"),
        "src1": SourceEntry("qa_view", "source = 'src1'", format_fn="format_qa"),
        "src2": SourceEntry("mcq_view", "source = 'src2'", format_fn="format_mcq"),
        "src3": SourceEntry("documents", "source = 'src3'"),            # no text rule: skipped with a warning
        "src5": SourceEntry("documents", "source = 'src5'", text_column="text"),   # alternate of src4
    }


def _reader(spark, sf_dir):
    def read(name):
        d = table(spark, sf_dir, "documents")
        if name == "qa_view":      # first line as the question, the rest as the answer
            return d.select("doc_id", "source", F.substring_index("text", "\n", 1).alias("QUESTION"),
                            F.expr("substr(text, length(substring_index(text, '\\n', 1)) + 2)").alias("LONG_ANSWER"))
        if name == "mcq_view":     # language and source as the two choices
            return d.select("doc_id", "source", F.col("text").alias("question"),
                            F.array("lang", "source").alias("choices"))
        return table(spark, sf_dir, name)
    return read


REG_SQL = f"""
WITH d AS (SELECT * FROM documents),
s0 AS (SELECT doc_id AS key, text FROM d WHERE source = 'src0' ORDER BY doc_id LIMIT 80),
s1 AS (SELECT doc_id AS key,
              split_part(text, chr(10), 1) || chr(10) || chr(10) ||
              CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS text
       FROM d WHERE source = 'src1' ORDER BY doc_id LIMIT 80),
s2 AS (SELECT doc_id AS key, text || chr(10) || chr(10) || 'Options:' || chr(10) || '1. ' || lang || chr(10) || '2. ' || source AS text
       FROM d WHERE source = 'src2' ORDER BY doc_id LIMIT 80),
s5 AS (SELECT doc_id AS key, text FROM d WHERE source = 'src5' ORDER BY doc_id LIMIT 80),
u AS (
  SELECT * FROM (SELECT 'src0' AS source, key, text FROM s0 WHERE length({strip('text')}) > 50 ORDER BY key LIMIT 40)
  UNION ALL SELECT * FROM (SELECT 'src1', key, text FROM s1 WHERE length({strip('text')}) > 50 ORDER BY key LIMIT 40)
  UNION ALL SELECT * FROM (SELECT 'src2', key, text FROM s2 WHERE length({strip('text')}) > 50 ORDER BY key LIMIT 40)
  UNION ALL SELECT * FROM (SELECT 'src4', key, text FROM s5 WHERE length({strip('text')}) > 50 ORDER BY key LIMIT 40))
SELECT source, CAST(key AS VARCHAR) AS key, sha256(text) AS text_hash FROM u
"""


@register("registry_load", REG_SQL)
def q_registry_load(spark, sf_dir):
    """Registry loads of up to 40 rows each from a head of 80; src3 has no text rule (empty,
    with a warning) and src4 is not registered, so its alternate src5 is loaded under its name."""
    from quarry.sources.registry import load_with_failover
    rows, skipped = load_with_failover(spark, registry(), ["src0", "src1", "src2", "src3", "src4"], 40,
                                       _reader(spark, sf_dir), alternates={"src4": "src5"})
    return rows.select("source", "key", F.sha2("text", 256).alias("text_hash"))


def _md5(key, tag):
    return f"md5(concat(CAST({key} AS VARCHAR), '{tag}'))"


SAMPLE_SQL = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_md5('doc_id', '|42')}, doc_id) AS rk FROM documents),
a AS (SELECT doc_id, split_part(text, chr(10), 1) || chr(10) || chr(10) ||
             CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS text,
             'qa' AS source, 'qa' AS type FROM r WHERE lang = 'en' AND rk <= 50),
b AS (SELECT doc_id, text, 'cases' AS source, 'case_report' AS type FROM r
      WHERE lang = 'de' AND rk <= 40 AND length({strip('text')}) > 100),
c AS (SELECT doc_id, text, 'notes' AS source, 'clinical_note' AS type FROM r
      WHERE lang = 'es' AND rk <= 400 AND length({strip('text')}) > 100),
d AS (SELECT doc_id, text, 'cases (stand-in)' AS source, 'case_report' AS type FROM r
      WHERE lang = 'de' AND rk <= 13 AND length({strip('text')}) > 100)
SELECT source, type, doc_id, sha256(text) AS text_hash FROM (
  SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM d)
"""


@register("source_sample", SAMPLE_SQL)
def q_source_sample(spark, sf_dir):
    """Seeded loaders: QA (50 en), cases (40 de, > 100 chars after sampling), notes (400 es,
    more than exist: min(n, size)), and a stand-in re-drawn from de with the same seed and relabelled."""
    from quarry.functions.text import format_qa
    from quarry.operators.sampling import relabel_source
    from quarry.sources.registry import sample_source
    d = table(spark, sf_dir, "documents")
    q = F.substring_index("text", "\n", 1)
    ans = F.expr("substr(text, length(substring_index(text, '\\n', 1)) + 2)")
    a = sample_source(d.filter(F.col("lang") == "en"), 50, 42, format_qa(q, ans), "qa", "qa")
    b = sample_source(d.filter(F.col("lang") == "de"), 40, 42, F.col("text"), "cases", "case_report",
                      min_len_after=100)
    c = sample_source(d.filter(F.col("lang") == "es"), 400, 42, F.col("text"), "notes", "clinical_note",
                      min_len_after=100)
    s = relabel_source(sample_source(d.filter(F.col("lang") == "de"), 13, 42, F.col("text"), "cases",
                                     "case_report", min_len_after=100), "cases (stand-in)")
    u = a.unionByName(b).unionByName(c).unionByName(s)
    return u.select("source", "type", "doc_id", F.sha2("text", 256).alias("text_hash"))


@register("preview", f"""
SELECT doc_id, source, lang, {ntok('text')} AS n_tokens, substr(text, 1, 200) || '...' AS preview
FROM documents ORDER BY doc_id LIMIT 3
""")
def q_preview(spark, sf_dir):
    """First three documents with token length and a 200-character preview."""
    from quarry.operators.stats import preview
    return preview(table(spark, sf_dir, "documents"), 3)


@register("eval_texts", f"""
WITH a AS (SELECT 'corpus_en' AS dataset, text FROM (SELECT * FROM documents WHERE lang = 'en'
           AND length({strip('text')}) > 0 ORDER BY doc_id LIMIT 200)),
b AS (SELECT 'corpus_fr' AS dataset, text FROM (SELECT * FROM documents WHERE lang = 'fr' ORDER BY doc_id LIMIT 200)
      WHERE length({strip('text')}) > 0),
c AS (SELECT 'corpus_de' AS dataset, text FROM (SELECT * FROM documents WHERE lang = 'de'
      AND length({strip('text')}) > 0 ORDER BY doc_id LIMIT 200))
SELECT dataset, count(*) AS n_texts, sum({ntok('text')}) AS tokens FROM (
  SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY dataset
""")
def q_eval_texts(spark, sf_dir):
    """Three evaluation corpora of up to 200 texts; the French one is cut before the blank filter."""
    from quarry.functions.text import token_count
    from quarry.sources.registry import load_eval_texts
    d = table(spark, sf_dir, "documents")
    parts = [load_eval_texts(d.filter(F.col("lang") == lg), 200, truncate_first=(lg == "fr"))
             .select(F.lit(f"corpus_{lg}").alias("dataset"), "text") for lg in ("en", "fr", "de")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(token_count("text")).alias("tokens"))


@register("custom_tokenizer", f"""
SELECT lang, sum({ntok('text')}) AS tokens, count(*) AS docs FROM documents GROUP BY lang
""")
def q_custom_tokenizer(spark, sf_dir):
    """token counts through the plug-in path (an Arrow-batched UDF built once per task)."""
    from quarry.functions.plugins import token_count_udf
    d = table(spark, sf_dir, "documents")
    n = token_count_udf()(F.col("text"))
    return d.groupBy("lang").agg(F.sum(n).alias("tokens"), F.count(F.lit(1)).alias("docs"))


# --------------------------------------------------------------------------- S1, S2, S7, S8
@register("jsonl_round_trip", """
SELECT 'total' AS section, 'all' AS key, count(*) AS n FROM documents
UNION ALL SELECT 'sources', coalesce(source, 'unknown'), count(*) FROM documents GROUP BY 2
UNION ALL SELECT 'types', coalesce(lang, 'unknown'), count(*) FROM documents GROUP BY 2
""")
def q_jsonl_round_trip(spark, sf_dir):
    """S7 -> S1 -> S8: documents written as JSON lines, read back, and the stats sidecar written and
    read back (total, counts by source, counts by type)."""
    from quarry.sources.jsonl import read_jsonl, write_jsonl, write_stats
    d = table(spark, sf_dir, "documents").select("text", "source", F.col("lang").alias("type"))
    with scratch(spark, "jsonl") as base:
        out = os.path.join(base, "calibration.jsonl")
        write_jsonl(d, out)
        write_stats(read_jsonl(spark, out), os.path.join(base, "calibration_stats.jsonl"))
        return cut_lineage(spark.read.json(os.path.join(base, "calibration_stats.jsonl"))).select("section", "key", "n")


@register("bad_lines", """
SELECT 'total' AS kind, (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS n
UNION ALL SELECT 'valid', (SELECT count(*) FROM documents)
UNION ALL SELECT 'bad', (SELECT count(*) FROM pages)
UNION ALL SELECT 'located', (SELECT count(*) FROM pages)
""")
def q_bad_lines(spark, sf_dir):
    """A folder of JSON lines (documents) mixed with raw non-JSON lines (page URLs) and blank
    lines; malformed lines are counted and located, blanks are skipped."""
    from quarry.sources.jsonl import read_jsonl_checked
    d = table(spark, sf_dir, "documents").select("text", "source", F.col("lang").alias("type"))
    p = table(spark, sf_dir, "pages").select(F.concat(F.col("url"), F.lit("\n")).alias("value"))
    with scratch(spark, "badlines") as base:
        out = os.path.join(base, "mixed")
        d.write.mode("overwrite").json(out)
        p.write.mode("append").text(out)
        good, bad, counts = read_jsonl_checked(spark, out)
        located = bad.select(F.count(F.lit(1)).alias("located"), F.count_distinct("file", "line_no").alias("places"))
        both = cut_lineage(counts.join(located))
    return both.select(F.explode(F.array(
        F.struct(F.lit("total").alias("kind"), F.col("total").alias("n")),
        F.struct(F.lit("valid").alias("kind"), F.col("valid").alias("n")),
        F.struct(F.lit("bad").alias("kind"), F.col("bad").alias("n")),
        F.struct(F.lit("located").alias("kind"), F.col("places").alias("n")))).alias("x")).select("x.*")


# --------------------------------------------------------------------------- S13, S14, J4
# Addresses of the crawled pages as files: without query and fragment, the page's bytes as length.
FILES_SQL = r"""f AS (
  SELECT regexp_replace(url, '[?#].*$', '') AS path, octet_length(encode(html)) AS length FROM pages),
l AS (SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '([^/]*)$', 1) AS name,
             nullif(lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '(\.[^./]*)$', 1)), '') AS ext, length FROM f)"""


def _size_sql(x: str) -> str:
    steps = " ".join(f"WHEN {x} < {1024 ** (i + 1)} THEN printf('%.2f', {x} / {float(1024 ** i)}) || ' {u}'"
                     for i, u in enumerate(("B", "KB", "MB", "GB", "TB")))
    return f"CASE {steps} ELSE printf('%.2f', {x} / {float(1024 ** 5)}) || ' PB' END"


def page_files(spark, sf_dir):
    from quarry.sources.files import as_listing
    return as_listing(table(spark, sf_dir, "pages"), F.regexp_replace("url", "[?#].*$", ""), F.octet_length("html"))


@register("file_inventory", f"WITH {FILES_SQL}," + f"""
e AS (SELECT dir, ext, sum(length) AS b FROM l WHERE ext IS NOT NULL GROUP BY 1, 2),
x AS (SELECT dir, string_agg(ext || '=' || {_size_sql('b')}, ',' ORDER BY ext) AS extensions FROM e GROUP BY 1),
t AS (SELECT dir, sum(length)::BIGINT AS total_size_bytes, count(*) AS file_count FROM l GROUP BY 1)
SELECT dir, total_size_bytes, file_count, {_size_sql('total_size_bytes')} AS total_size, coalesce(extensions, '') AS extensions
FROM t LEFT JOIN x USING (dir)
""")
def q_file_inventory(spark, sf_dir):
    """Bytes, file count and bytes per extension of every directory of the crawled addresses."""
    from quarry.sources.files import file_inventory
    i = file_inventory(page_files(spark, sf_dir))
    parts = F.transform(F.array_sort(F.map_entries("extensions")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return i.select("dir", "total_size_bytes", "file_count", "total_size", F.coalesce(F.array_join(parts, ","), F.lit("")).alias("extensions"))


@register("missing_files", f"WITH {FILES_SQL}," + """
need AS (SELECT dir, unnest(['7', '25', '474.html']) AS name FROM (SELECT DISTINCT dir FROM l)),
m AS (SELECT dir, string_agg(name, ',' ORDER BY name) AS missing FROM need ANTI JOIN l USING (dir, name) GROUP BY dir),
h AS (SELECT dir, bool_or(regexp_matches(name, '[.]html$')) AS has_match FROM l GROUP BY dir)
SELECT dir, has_match, coalesce(missing, '') AS missing, missing IS NULL AND has_match AS complete FROM h LEFT JOIN m USING (dir)
""")
def q_missing_files(spark, sf_dir):
    """Required names absent from each directory of the crawled addresses, and a completeness verdict."""
    from quarry.sources.files import check_complete
    c = check_complete(page_files(spark, sf_dir), ["7", "25", "474.html"], [r"[.]html$"])
    return c.select("dir", "has_match", F.array_join("missing", ",").alias("missing"), "complete")


# --------------------------------------------------------------------------- F2, J3, K5, P18
GEN_SQL = f"""
SELECT item_id AS prompt_id,
       CASE WHEN length(text) % 7 = 0 THEN NULL
            ELSE sha256(array_to_string(regexp_extract_all(text, {TOKRX})[1:len(regexp_extract_all(text, {TOKRX})) // 2], ' '))
       END AS output_hash,
       CASE WHEN length(text) % 7 = 0 THEN 0
            ELSE len(regexp_extract_all(text, {TOKRX})) // 2 END AS tokens_generated,
       CASE WHEN length(text) % 7 = 0 THEN 'ValueError: stub refuses this prompt' END AS error
FROM benchmark
"""


@register("batch_generate", GEN_SQL)
def q_batch_generate(spark, sf_dir):
    """a deterministic stand-in model over every benchmark prompt (latency kept out of the check)."""
    from quarry.functions.plugins import batch_generate, half_echo
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))
    g = batch_generate(b, half_echo)
    return g.select("prompt_id", F.sha2("output", 256).alias("output_hash"), "tokens_generated", "error")


@register("round_robin", """
WITH e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events),
b AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos FROM benchmark),
k AS (SELECT count(*) AS k FROM benchmark)
SELECT b.item_id, count(*) AS events, min(e.event_id) AS first_event
FROM e, k JOIN b ON b.pos = e.idx % k.k GROUP BY b.item_id
""")
def q_round_robin(spark, sf_dir):
    """Events in id order dealt to benchmark prompts in turn."""
    from quarry.operators.metrics import round_robin
    e = table(spark, sf_dir, "events").select("event_id")
    b = table(spark, sf_dir, "benchmark").select("item_id")
    r = round_robin(e, b, "event_id", "item_id")
    return r.groupBy("item_id").agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event"))


REPORT_TEMPLATE = "# Run {{RUN}}\nRequests: {{REQUESTS}}\nFailed: {{FAILED}}\nUsers: {{USERS}}\nModel: {{MODEL}}"


@register("report_lines", """
WITH r AS (SELECT event_type AS run_id, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS failed,
                  count(DISTINCT user_id) AS users FROM events GROUP BY 1),
hours AS (SELECT event_type AS run_id, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2),
hl AS (SELECT h.run_id, 100 + h.h AS pos,
              lpad(CAST(h.h AS VARCHAR), 2, '0') || ' ' || repeat('=', CAST(floor(h.n / m.mx * 40) AS INTEGER)) AS line
       FROM hours h JOIN (SELECT run_id, max(n) AS mx FROM hours GROUP BY 1) m USING (run_id)),
head AS (SELECT run_id, 0 AS pos,
                '# Run ' || run_id || chr(10) || 'Requests: ' || requests || chr(10) || 'Failed: ' || failed || chr(10)
                || 'Users: ' || users || chr(10) || 'Model: TBD' AS line FROM r),
lines AS (SELECT * FROM head UNION ALL SELECT * FROM hl)
SELECT run_id, count(*) AS n_lines, sha256(string_agg(line, chr(10) ORDER BY pos)) AS report_hash
FROM lines GROUP BY run_id
""")
def q_report_lines(spark, sf_dir):
    """One text report per run (event type): a filled template (missing model -> TBD) and
    hour-of-day lines with bars of int(share_of_peak * 40) signs."""
    from quarry.functions.text import fill_template
    from quarry.operators.metrics import bar, report_text
    e = table(spark, sf_dir, "events")
    r = e.groupBy(F.col("event_type").alias("run_id")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("event_type") == "error").alias("failed"),
        F.count_distinct("user_id").alias("users"))
    head = r.select("run_id", F.lit(0).alias("pos"), fill_template(REPORT_TEMPLATE, {
        "RUN": "run_id", "REQUESTS": "requests", "FAILED": "failed", "USERS": "users", "MODEL": None}).alias("line"))
    hours = e.groupBy(F.col("event_type").alias("run_id"), F.hour("ts").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    mx = hours.groupBy("run_id").agg(F.max("n").alias("mx"))
    hl = hours.join(mx, "run_id").select(
        "run_id", (F.lit(100) + F.col("h")).alias("pos"),
        F.concat(F.lpad(F.col("h").cast("string"), 2, "0"), F.lit(" "), bar(F.col("n") / F.col("mx"))).alias("line"))
    t = report_text(head.unionByName(hl), "run_id")
    return t.select("run_id", "n_lines", F.sha2("report", 256).alias("report_hash"))


# --------------------------------------------------------------------------- K2, S15
CALIBRATION_SAMPLES = 100_000      # as named in the manifest of ``run_manifest``


@register("build_calibration", "WITH RECURSIVE " + pack_ctes() + f""",
buf AS (SELECT pack_id, any_value(n_tokens) AS n_tokens, string_agg(text || ' ', '' ORDER BY i) AS b
        FROM members GROUP BY pack_id)
SELECT 'text' AS kind, doc_id AS seq_key, least({ntok('text')}, 2048) AS n_tokens,
       sha256(CASE WHEN {ntok('text')} > 2048
                   THEN array_to_string(regexp_extract_all(text, {TOKRX})[1:2048], ' ') ELSE text END) AS text_hash
FROM documents
WHERE text IS NOT NULL AND text <> '' AND least({ntok('text')}, 2048) >= 256
UNION ALL
SELECT 'pack', pack_id, n_tokens,
       sha256(CASE WHEN {ntok('b')} > 2048
                   THEN array_to_string(regexp_extract_all(b, {TOKRX})[1:2048], ' ') ELSE b END)
FROM buf
""")
def q_build_calibration(spark, sf_dir):
    """K2: route, truncate, pack (only when fewer than half the wanted texts are kept) and a run manifest
    whose sample count is observed during the write (no second scan)."""
    from quarry.operators.packing import calibration_set
    with scratch(spark, "calibration") as out:
        cal = calibration_set(table(spark, sf_dir, "documents"), max_samples=pack_budget)
        save_calibration(spark, cal, out, "3 * kept + 2")
        back = cut_lineage(spark.read.parquet(os.path.join(out, "data"))
                           .select("kind", "seq_key", "n_tokens", F.sha2("text", 256).alias("text_hash")))
    return back


def save_calibration(spark, cal, out, max_samples=CALIBRATION_SAMPLES):
    """Writes a calibration set with its manifest; the sample count is observed during the write."""
    from pyspark.sql import Observation
    from quarry.sources.results import run_manifest
    obs = Observation("calibration")
    cal.observe(obs, F.count(F.lit(1)).alias("num_samples"), F.sum("n_tokens").alias("total_tokens")) \
       .write.mode("overwrite").parquet(os.path.join(out, "data"))
    params = {"source": "documents", "max_length": 2048, "min_length": 256, "max_samples": max_samples}
    return run_manifest(spark, params, obs.get, os.path.join(out, "manifest"), timestamp="2024-02-01T00:00:00", output_dir=os.path.join(out, "data"))


@register("run_manifest", f"""
SELECT 'documents' AS source, 2048 AS max_length, 256 AS min_length, 100000 AS max_samples, count(*) AS num_samples,
       sum({ntok('text')}) AS total_tokens, '2024-02-01T00:00:00' AS timestamp, 'unknown' AS code_revision, true AS has_output_dir
FROM documents
""")
def q_run_manifest(spark, sf_dir):
    """The manifest of a written run (parameters, observed counts, time, code revision, output folder), read back."""
    from quarry.functions.text import token_count
    with scratch(spark, "manifest") as out:
        d = table(spark, sf_dir, "documents").select("doc_id", token_count("text").alias("n_tokens"))
        m = save_calibration(spark, d, out)
        return cut_lineage(m.select("source", "max_length", "min_length", "max_samples", "num_samples", "total_tokens", "timestamp",
                                    "code_revision", F.col("output_dir").endswith("/data").alias("has_output_dir")))


# --------------------------------------------------------------------------- K4, S9, S11
CASES_DOC_SQL = f"""{CASES_BASE},
sc AS (SELECT category, len(list_filter(expected_elements, lambda e: {hit_sql(False)})) AS found, len(expected_elements) AS total,
              {ntok('output')} AS tokens FROM cases),
c AS (SELECT *, CASE WHEN total > 0 THEN found / total ELSE 1.0 END AS coverage FROM sc)"""


@register("validate_cases", f"WITH {CASES_DOC_SQL}" + """
SELECT category, count(*) AS test_count, round(avg(coverage) * 100, 6) AS avg_coverage,
       round(100.0 * count(*) FILTER (WHERE coverage >= 0.6) / count(*), 6) AS pass_rate
FROM c GROUP BY category
""")
def q_validate_cases(spark, sf_dir):
    """K4: cases written as one nested document and loaded (S9), paired with the next assistant turn (J1, left), prompts
    rendered (P8), scored in substring mode (A8), saved (S11) and read back by category (A10)."""
    with scratch(spark, "validation") as out:
        validate(spark, sf_dir, out)
        return cut_lineage(spark.read.json(os.path.join(out, "v", "category_scores")).select(
            "category", "test_count", F.round("avg_coverage", 6).alias("avg_coverage"), F.round("pass_rate", 6).alias("pass_rate")))


@register("validation_document", f"WITH {CASES_DOC_SQL}" + """
SELECT 'unigram' AS model, '2024-02-01T00:00:00' AS date, count(*) AS total_tests,
       count(*) FILTER (WHERE coverage >= 0.6) AS passed_tests, round(avg(coverage), 6) AS avg_coverage_score,
       (SELECT count(*) FROM events) AS prompts,
       round((SELECT count(*) / sum(value) FROM events), 6) AS prompts_per_sec, round((SELECT avg(value) * 1000 FROM events), 6) AS avg_latency_ms,
       count(*) AS saved_cases
FROM c
""")
def q_validation_document(spark, sf_dir):
    """The saved summary document: metadata, metrics and the performance block, with the number of saved case records."""
    with scratch(spark, "validation") as out:
        validate(spark, sf_dir, out)
        doc = spark.read.json(os.path.join(out, "v", "summary"))
        cases = spark.read.json(os.path.join(out, "v", "detailed_results")).agg(F.count(F.lit(1)).alias("saved_cases"))
        return cut_lineage(doc.join(cases).select(
            "metadata.model", "metadata.date", "metrics.total_tests", "metrics.passed_tests",
            F.round("metrics.avg_coverage_score", 6).alias("avg_coverage_score"), F.col("performance_benchmark.items").alias("prompts"),
            F.round("performance_benchmark.items_per_sec", 6).alias("prompts_per_sec"),
            F.round(F.col("performance_benchmark.mean_latency_s") * 1000, 6).alias("avg_latency_ms"), "saved_cases"))


def validate(spark, sf_dir, out):
    from quarry.functions.text import render_prompt
    from quarry.operators.metrics import throughput
    from quarry.operators.scoring import category_breakdown, coverage, pair_outputs, user_turn_cases, validation_summary
    from quarry.sources.results import load_test_cases, save_test_cases, save_validation
    ident = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id")
    c = user_turn_cases(table(spark, sf_dir, "conversations"))
    cases = c.select(ident, "category", F.lit("qa").alias("task"), "input", "expected_elements", F.lit("n/a").alias("difficulty"))
    save_test_cases(cases, os.path.join(out, "cases"), {"name": "user turns"})
    loaded = load_test_cases(spark, os.path.join(out, "cases"))
    answers = c.where(F.col("output").isNotNull()).select(ident, "output")
    scored = coverage(pair_outputs(loaded, answers, "id", "left").withColumn("prompt", render_prompt("input")), mode="substring")
    detail = cut_lineage(scored.withColumn("passed", F.col("coverage_score") >= 0.6).drop("prompt"))
    gen = table(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").cast("int").alias("tokens_generated"), F.col("value").alias("time_seconds"))
    save_validation(detail, validation_summary(detail, tokens_col=None), category_breakdown(detail), throughput(gen),
                    {"model": "unigram", "date": "2024-02-01T00:00:00"}, os.path.join(out, "v"))
