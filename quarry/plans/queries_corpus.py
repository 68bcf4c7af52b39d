"""Driver queries over ``documents``: mix preparation, statistics, screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import COMPLEX_TERMS, UNCERTAINTY_MARKERS
from quarry.operators.stats import MEDICAL_KEYWORDS
from quarry.plans.catalog import ntok, register, strip
from quarry.plans.mix import mix_distribution
from quarry.session import table

# Mix bindings (FIXTURES): the radiology preset's three quotas mapped onto languages.
FLAGSHIP_QUOTAS = {"en": 307, "fr": 154, "de": 51}
SEED = 42


def _md5(key: str, seed_tag: str) -> str:
    return f"md5(concat(CAST({key} AS VARCHAR), '{seed_tag}'))"


MIX_SQL = f"""
WITH q(lang, quota) AS (VALUES ('en', 307), ('fr', 154), ('de', 51)),
ranked AS (
  SELECT d.doc_id, d.lang, d.text, q.quota,
         row_number() OVER (PARTITION BY d.lang ORDER BY {_md5('d.doc_id', '|42')}, d.doc_id) AS rk
  FROM documents d JOIN q ON d.lang = q.lang),
sampled AS (
  SELECT doc_id, lang, text FROM ranked
  WHERE rk <= quota AND length({strip('text')}) > 100),
band AS (
  SELECT doc_id, lang, {ntok('text')} AS n_tokens, {_md5('doc_id', '|42|shuffle')} AS s
  FROM sampled),
mix AS (
  SELECT * FROM band WHERE n_tokens BETWEEN 256 AND 4096 ORDER BY s, doc_id LIMIT 512)
"""


@register("mix_distribution", MIX_SQL + """
SELECT lang, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM mix), 6) AS percent
FROM mix GROUP BY lang ORDER BY n DESC, lang
""")
def q_mix_distribution(spark, sf_dir):
    """Flagship: K1 (W5, J6/W3, P3, U1, W4, P5) then A1 by lang."""
    return mix_distribution(table(spark, sf_dir, "documents"), FLAGSHIP_QUOTAS, total=512, seed=SEED)


# --------------------------------------------------------------------------- U4, U2
OVERLAP_SQL = f"""
WITH ranked AS (
  SELECT doc_id, lang, text,
         row_number() OVER (PARTITION BY lang ORDER BY {_md5('doc_id', '|42')}, doc_id) AS rk
  FROM documents WHERE lang IN ('en', 'fr')),
u AS (
  SELECT text, lang AS source FROM ranked WHERE (lang = 'en' AND rk <= 307) OR (lang = 'fr' AND rk <= 154)
  UNION ALL
  SELECT text, 'fr-standin' AS source FROM ranked WHERE lang = 'fr' AND rk <= 51)
SELECT sha256(text) AS text_hash, count(*) AS copies, list_sort(list_distinct(list(source))) AS sources
FROM u GROUP BY 1 HAVING count(*) > 1
"""


@register("mix_overlap", OVERLAP_SQL)
def q_mix_overlap(spark, sf_dir):
    """U4: a stand-in source re-drawn with the same seed repeats rows of the primary draw."""
    from quarry.operators.sampling import apply_quota, dedupe_overlap, mix_union, relabel_source
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    primary = apply_quota(docs, "lang", {"en": 307, "fr": 154}, SEED).withColumn("source", F.col("lang"))
    standin = relabel_source(apply_quota(docs, "lang", {"fr": 51}, SEED), "fr-standin")
    return dedupe_overlap(mix_union([primary, standin]))


BACKFILL_SQL = f"""
WITH main AS (SELECT doc_id, lang FROM documents WHERE lang = 'de'),
n AS (SELECT count(*) AS n FROM main),
fb AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS pos FROM documents
       WHERE lang = 'es' AND length({strip('text')}) > 200)
SELECT doc_id, lang FROM main
UNION ALL
SELECT doc_id, lang FROM fb, n WHERE n.n < 512 // 2 AND fb.pos <= 512 - n.n
"""


@register("backfill", BACKFILL_SQL)
def q_backfill(spark, sf_dir):
    """German rows topped up with the head of the Spanish rows (> 200 stripped characters)."""
    from quarry.operators.sampling import backfill
    docs = table(spark, sf_dir, "documents")
    main = docs.filter(F.col("lang") == "de").select("doc_id", "lang", "text")
    fb = docs.filter(F.col("lang") == "es").select("doc_id", "lang", "text")
    return backfill(main, fb, 512).select("doc_id", "lang")


# --------------------------------------------------------------------------- A2, A3, P5, A4
TOKENS_CTE = f"WITH t AS (SELECT doc_id, lang, text, {ntok('text')} AS n_tokens FROM documents)\n"


@register("length_stats", TOKENS_CTE + """
SELECT lang, count(n_tokens) AS rows, round(avg(n_tokens), 6) AS mean, round(median(n_tokens), 6) AS median,
       min(n_tokens) AS min, max(n_tokens) AS max, round(stddev_pop(n_tokens), 6) AS std,
       sum(n_tokens) AS total_tokens
FROM t GROUP BY lang
""")
def q_length_stats(spark, sf_dir):
    """A2 per language over all documents."""
    from quarry.operators.stats import length_stats, with_token_count
    return length_stats(with_token_count(table(spark, sf_dir, "documents")), by=["lang"])


@register("length_sweep", TOKENS_CTE + """
SELECT th AS threshold, count(*) FILTER (WHERE n_tokens >= th) AS passing,
       round(100.0 * count(*) FILTER (WHERE n_tokens >= th) / count(*), 6) AS percent,
       count(*) FILTER (WHERE n_tokens >= th) >= 256 AS ok
FROM t, (VALUES (256), (512), (1024), (2048)) v(th) GROUP BY th
""")
def q_length_sweep(spark, sf_dir):
    """A3 over all documents."""
    from quarry.operators.stats import min_length_sweep, with_token_count
    return min_length_sweep(with_token_count(table(spark, sf_dir, "documents")))


@register("length_bands", TOKENS_CTE + """
, c AS (SELECT *, CASE WHEN n_tokens < 256 THEN 'too_short' WHEN n_tokens > 4096 THEN 'too_long'
                  ELSE 'accepted' END AS length_class FROM t)
SELECT length_class, count(*) AS n,
       round(avg(CASE WHEN length_class = 'accepted' THEN n_tokens END), 6) AS mean,
       round(median(CASE WHEN length_class = 'accepted' THEN n_tokens END), 6) AS median,
       round(stddev_pop(CASE WHEN length_class = 'accepted' THEN n_tokens END), 6) AS std
FROM c GROUP BY length_class
""")
def q_length_bands(spark, sf_dir):
    """P5 class counts and statistics of the accepted band (256..4096)."""
    from quarry.operators.stats import length_bands, with_token_count
    return length_bands(with_token_count(table(spark, sf_dir, "documents")))


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


KW = _sql_list(MEDICAL_KEYWORDS)


@register("quality_checks", TOKENS_CTE + f"""
, a AS (
  SELECT count(*) FILTER (WHERE text IS NOT NULL AND text <> '') AS rows,
         count(*) FILTER (WHERE NOT (text IS NOT NULL AND text <> '')) AS no_text,
         count(*) FILTER (WHERE text IS NOT NULL AND text <> '' AND n_tokens >= 256) AS above_min,
         avg(CASE WHEN text IS NOT NULL AND text <> '' THEN n_tokens END) AS mean_len,
         count(*) FILTER (WHERE text IS NOT NULL AND text <> ''
                          AND len(list_filter({KW}, lambda k: contains(lower(text), k))) > 0) AS domain_rows
  FROM t)
SELECT 'rows_above_min_length' AS "check", CAST(above_min AS DOUBLE) AS value, CAST(256 AS DOUBLE) AS threshold,
       above_min >= 256 AS ok FROM a
UNION ALL SELECT 'sample_count', CAST(rows AS DOUBLE), CAST(512 AS DOUBLE), rows >= 512 FROM a
UNION ALL SELECT 'mean_length', round(mean_len, 6), CAST(500 AS DOUBLE), coalesce(mean_len > 500, false) FROM a
UNION ALL SELECT 'domain_percent', round(100.0 * domain_rows / rows, 6), CAST(70 AS DOUBLE),
                 coalesce(100.0 * domain_rows / rows > 70, false) FROM a
UNION ALL SELECT 'rows_without_text', CAST(no_text AS DOUBLE), CAST(0 AS DOUBLE), no_text = 0 FROM a
""")
def q_quality_checks(spark, sf_dir):
    """A4 over all documents."""
    from quarry.operators.stats import quality_checks, with_token_count
    return quality_checks(with_token_count(table(spark, sf_dir, "documents")))


# Keywords of the relevance query: the domain list plus stems common in the corpus languages.
RELEVANCE_WORDS = (*MEDICAL_KEYWORDS, "tion", "ment")
RELEVANCE_SQL_LIST = _sql_list(RELEVANCE_WORDS)


@register("domain_relevance", f"""
SELECT lang, count(*) AS rows,
       count(*) FILTER (WHERE len(list_filter({RELEVANCE_SQL_LIST}, lambda k: contains(lower(text), k))) > 0)
         AS domain_rows,
       round(100.0 * count(*) FILTER (WHERE len(list_filter({RELEVANCE_SQL_LIST}, lambda k: contains(lower(text), k))) > 0)
             / count(*), 6) AS percent
FROM documents GROUP BY lang
""")
def q_domain_relevance(spark, sf_dir):
    """P11 per language."""
    from quarry.operators.stats import domain_relevance
    return domain_relevance(table(spark, sf_dir, "documents"), keywords=RELEVANCE_WORDS)


COMPLEX = _sql_list(COMPLEX_TERMS)
UNCERTAIN = _sql_list(UNCERTAINTY_MARKERS)


@register("readability", f"""
SELECT lang, count(*) AS rows,
       count(*) FILTER (WHERE len(list_filter({COMPLEX}, lambda k: contains(lower(text), k))) = 0) AS simple_rows,
       count(*) FILTER (WHERE len(list_filter({UNCERTAIN}, lambda k: contains(lower(text), k))) > 0) AS uncertain_rows
FROM documents GROUP BY lang
""")
def q_readability(spark, sf_dir):
    """Rows free of complex terms and rows with an uncertainty marker, per language."""
    from quarry.functions.text import has_none, shows_uncertainty
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"),
                                 F.count_if(has_none("text")).alias("simple_rows"),
                                 F.count_if(shows_uncertainty("text")).alias("uncertain_rows"))


# --------------------------------------------------------------------------- A16, J5
# Term list: all distinct lower-cased benchmark tokens; for the augmentation also the first three tokens
# of every item as a phrase.
TERMS_SQL = f"""terms AS (
  SELECT DISTINCT t AS term FROM (SELECT unnest(regexp_extract_all(lower(text), {"'[^ \\t\\n\\r\\f]+'"})) AS t
                                  FROM benchmark))"""


def benchmark_terms(spark, sf_dir):
    from quarry.functions.text import lower_tokens
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.explode(lower_tokens("text")).alias("term")).distinct()


def benchmark_phrases(spark, sf_dir):
    from quarry.functions.text import lower_tokens
    b = table(spark, sf_dir, "benchmark").withColumn("_t", lower_tokens("text"))
    return b.filter(F.size("_t") >= 3).select(F.array_join(F.slice("_t", 1, 3), " ").alias("term")).distinct()


@register("term_share", f"""
WITH {TERMS_SQL},
toks AS (SELECT unnest(regexp_extract_all(lower(text), {"'[^ \\t\\n\\r\\f]+'"})) AS token FROM documents),
counts AS (SELECT token, count(*) AS c FROM toks GROUP BY token),
total AS (SELECT count(*) AS n FROM toks)
SELECT term, coalesce(c, 0) AS occurrences, round(100.0 * coalesce(c, 0) / n, 6) AS percent,
       coalesce(c, 0) / n < 0.00003 AS rare
FROM terms LEFT JOIN counts ON term = token, total
""")
def q_term_share(spark, sf_dir):
    """Share of each benchmark term among all document tokens."""
    from quarry.operators.stats import term_share
    return term_share(table(spark, sf_dir, "documents"), benchmark_terms(spark, sf_dir))


@register("augment_terms", f"""
WITH {TERMS_SQL},
bt AS (SELECT regexp_extract_all(lower(text), {"'[^ \\t\\n\\r\\f]+'"}) AS w FROM benchmark),
phrases AS (SELECT DISTINCT array_to_string(w[1:3], ' ') AS term FROM bt WHERE len(w) >= 3),
every AS (SELECT term FROM terms UNION SELECT term FROM phrases),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), {"'[^ \\t\\n\\r\\f]+'"}) AS w FROM documents),
dt AS (SELECT DISTINCT doc_id, t AS term FROM (
         SELECT doc_id, unnest(w) AS t FROM dw
         UNION ALL
         SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
         FROM dw WHERE len(w) >= 3)),
hits AS (SELECT dt.term, dt.doc_id FROM dt JOIN every USING (term)),
r AS (SELECT term, doc_id, row_number() OVER (PARTITION BY term ORDER BY {_md5('doc_id', '|42')}, doc_id) AS rank
      FROM hits)
SELECT term, doc_id, rank FROM r WHERE rank <= 3
""")
def q_augment_terms(spark, sf_dir):
    """Up to 3 seeded documents per benchmark word and per opening phrase of three words."""
    from quarry.operators.stats import augment_with_terms
    terms = benchmark_terms(spark, sf_dir).union(benchmark_phrases(spark, sf_dir))
    return augment_with_terms(table(spark, sf_dir, "documents"), terms, per_term=3)


# --------------------------------------------------------------------------- P19, P20
@register("identifier_screen", """
WITH c AS (
  SELECT CASE
    WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}') THEN 'email'
    WHEN regexp_matches(text, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN 'ssn'
    WHEN regexp_matches(text, '[0-9]{13,19}') THEN 'card'
    WHEN regexp_matches(text, '[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}') THEN 'ip'
    WHEN regexp_matches(text, '[+]?[0-9][0-9 ().-]{7,}[0-9]') THEN 'phone'
    WHEN regexp_matches(text, '(?i)(token|api_key|secret|password) *[=:] *"') THEN 'secret'
    ELSE 'clean' END AS reason
  FROM documents)
SELECT reason, count(*) AS n FROM c GROUP BY reason
""")
def q_identifier_screen(spark, sf_dir):
    """First identifier kind per document; counts per reason (``clean`` is kept)."""
    from quarry.functions.text import identifier_reason
    d = table(spark, sf_dir, "documents")
    return (d.select(F.coalesce(identifier_reason("text"), F.lit("clean")).alias("reason"))
             .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@register("content_hash", """
SELECT sha256(text) AS text_hash, count(*) AS copies, min(doc_id) AS first_doc,
       sha256(concat('quarry-salt', CAST(min(doc_id) AS VARCHAR))) AS first_doc_mask
FROM documents GROUP BY 1 HAVING count(*) > 1
""")
def q_content_hash(spark, sf_dir):
    """P20: exact copies by SHA-256, with the first document id masked."""
    from quarry.functions.text import content_hash, mask_id
    d = table(spark, sf_dir, "documents")
    return (d.groupBy(content_hash("text").alias("text_hash"))
             .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"))
             .filter(F.col("copies") > 1)
             .withColumn("first_doc_mask", mask_id("first_doc", "quarry-salt")))


# --------------------------------------------------------------------------- P6, P7, W1, W2
@register("route_lengths", f"""
SELECT CASE WHEN text IS NULL OR text = '' THEN 'drop'
            WHEN least({ntok('text')}, 2048) >= 256 THEN 'keep'
            WHEN least({ntok('text')}, 2048) >= 50 THEN 'pack' ELSE 'drop' END AS route,
       count(*) AS n, sum(least({ntok('text')}, 2048)) AS tokens
FROM documents GROUP BY 1
""")
def q_route_lengths(spark, sf_dir):
    """P7 after P6 (2048 tokens): rows and tokens per route."""
    from quarry.operators.packing import route
    r = route(table(spark, sf_dir, "documents"))
    return r.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"))


@register("truncate", f"""
SELECT doc_id, {ntok('text')} AS n_before,
       sha256(array_to_string(regexp_extract_all(text, {"'[^ \\t\\n\\r\\f]+'"})[1:2048], ' ')) AS truncated_hash
FROM documents WHERE {ntok('text')} > 2048
""")
def q_truncate(spark, sf_dir):
    """Documents over 2048 tokens and the hash of their truncated text."""
    from quarry.functions.text import token_count, truncate_tokens
    d = table(spark, sf_dir, "documents").withColumn("n_before", token_count("text"))
    return (d.filter(F.col("n_before") > 2048)
             .select("doc_id", "n_before", F.sha2(truncate_tokens("text", 2048, F.col("n_before")), 256)
                     .alias("truncated_hash")))


@register("batches", f"""
WITH i AS (SELECT doc_id, {ntok('text')} AS n_tokens, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
SELECT CAST(floor(idx / 64) AS BIGINT) AS batch_id, count(*) AS rows, min(doc_id) AS first_doc,
       max(doc_id) AS last_doc, sum(n_tokens) AS tokens
FROM i GROUP BY 1
""")
def q_batches(spark, sf_dir):
    """Consecutive batches of 64 documents in doc_id order."""
    from quarry.functions.text import token_count
    from quarry.operators.packing import assign_batches
    d = table(spark, sf_dir, "documents").select("doc_id", token_count("text").alias("n_tokens"))
    b = assign_batches(d, 64, "doc_id")
    return b.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_doc"),
                                     F.max("doc_id").alias("last_doc"), F.sum("n_tokens").alias("tokens"))


def pack_budget(kept: int) -> int:
    """Sequences wanted: three times the kept texts, so that packing runs at every size."""
    return 3 * kept + 2


def pack_ctes(max_length: int = 2048, min_length: int = 256, pack_min: int = 50) -> str:
    """Recursive-CTE oracle of W2 over all candidates in one sequence: CTEs ``r``, ``kept``, ``c``, ``walk``,
    ``packs`` and ``members`` (pack_id, doc_id, i) restricted to packs within the budget."""
    return f"""
r AS (SELECT doc_id, text, least({ntok('text')}, {max_length}) AS n_tokens FROM documents),
kept AS (SELECT count(*) AS k FROM r WHERE text IS NOT NULL AND text <> '' AND n_tokens >= {min_length}),
c AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, text, length(text) + 1 AS ch, n_tokens
      FROM r WHERE text IS NOT NULL AND text <> '' AND n_tokens >= {pack_min} AND n_tokens < {min_length}),
walk(i, pack_start, buf, toks) AS (
  SELECT i, i, ch, n_tokens FROM c WHERE i = 1
  UNION ALL
  SELECT c.i,
         CASE WHEN w.buf > {2 * max_length} THEN c.i ELSE w.pack_start END,
         CASE WHEN w.buf > {2 * max_length} THEN c.ch ELSE w.buf + c.ch END,
         CASE WHEN w.buf > {2 * max_length} THEN c.n_tokens ELSE w.toks + c.n_tokens END
  FROM walk w JOIN c ON c.i = w.i + 1),
closed AS (SELECT pack_start, i AS pack_end, least(toks, {max_length}) AS n_tokens FROM walk WHERE buf > {2 * max_length}),
packs AS (SELECT p.*, row_number() OVER (ORDER BY pack_start) - 1 AS no FROM closed p WHERE n_tokens >= {min_length}),
members AS (
  SELECT p.no AS pack_id, p.n_tokens, c.doc_id, c.i, c.text
  FROM packs p JOIN c ON c.i BETWEEN p.pack_start AND p.pack_end, kept
  WHERE kept.k < (3 * kept.k + 2) // 2 AND p.no < 2 * kept.k + 2)"""


PACK_SQL = "WITH RECURSIVE " + pack_ctes() + """
SELECT pack_id, min(doc_id) AS first_doc, max(doc_id) AS last_doc, count(*) AS n_texts, any_value(n_tokens) AS n_tokens
FROM members GROUP BY pack_id
"""


@register("pack_short", PACK_SQL)
def q_pack_short(spark, sf_dir):
    """W2 over all documents as one sequence; the budget follows from the number of kept texts."""
    from quarry.operators.packing import pack_short
    p = pack_short(table(spark, sf_dir, "documents"), max_samples=pack_budget)
    return p.select("pack_id", "first_doc", "last_doc", "n_texts", "n_tokens")


# --------------------------------------------------------------------------- W5, J6
@register("mix_scaled", MIX_SQL.replace("('en', 307), ('fr', 154), ('de', 51)", "('en', 153), ('fr', 77), ('de', 25)")
          .replace("LIMIT 512", "LIMIT 256") + """
SELECT lang, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM mix), 6) AS percent
FROM mix GROUP BY lang ORDER BY n DESC, lang
""")
def q_mix_scaled(spark, sf_dir):
    """K1 at 256 rows: W5 scales the 307/154/51 quotas to 153/77/25 (truncation loses a row)."""
    return mix_distribution(table(spark, sf_dir, "documents"), FLAGSHIP_QUOTAS, total=256, seed=SEED)


@register("quota_gaps", """
SELECT q.source FROM (VALUES ('en'), ('fr'), ('it'), ('pt')) q(source)
WHERE q.source NOT IN (SELECT DISTINCT lang FROM documents)
""")
def q_quota_gaps(spark, sf_dir):
    """Quota sources of a mix that have no rows (reported, then skipped by the mix)."""
    from quarry.operators.sampling import missing_quota_sources
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("source"))
    return missing_quota_sources(d, "source", {"en": 1, "fr": 1, "it": 1, "pt": 1})


PRESET_SQL = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_md5('doc_id', '|42')}, doc_id) AS rk FROM documents),
u AS (
  SELECT doc_id, 'PubMedQA' AS source,
         split_part(text, chr(10), 1) || chr(10) || chr(10) ||
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS text
  FROM r WHERE lang = 'en' AND rk <= 307
  UNION ALL
  SELECT doc_id, 'PMC-Patients', text FROM r WHERE lang = 'de' AND rk <= 154 AND length({strip('text')}) > 100
  UNION ALL
  SELECT doc_id, 'PMC-Patients (radiology-filtered)', text FROM r
  WHERE lang = 'de' AND rk <= 51 AND length({strip('text')}) > 100),
mix AS (SELECT * FROM u WHERE {ntok('text')} BETWEEN 256 AND 4096
        ORDER BY {_md5('doc_id', '|42|shuffle')}, doc_id, source LIMIT 512)
SELECT source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM mix), 6) AS percent
FROM mix GROUP BY source
"""


@register("preset_mix", PRESET_SQL)
def q_preset_mix(spark, sf_dir):
    """K1 from the radiology preset: PubMedQA = en (question/answer formatted), PMC-Patients = de
    (> 100 characters after sampling), custom_radiology = stand-in re-drawn from PMC-Patients with the
    same seed and relabelled, so its rows repeat PMC-Patients rows (kept, as in the source)."""
    from quarry.functions.text import format_qa
    from quarry.operators.stats import distribution
    from quarry.plans.mix import prepare_preset_mix
    d = table(spark, sf_dir, "documents")
    qa = (lambda df: format_qa(F.substring_index("text", "\n", 1),
                               F.expr("substr(text, length(substring_index(text, '\\n', 1)) + 2)")))
    tables = {"pubmedqa": (d.filter(F.col("lang") == "en"), qa),
              "pmc_patients": (d.filter(F.col("lang") == "de"), lambda df: F.col("text"))}
    mix, _skipped = prepare_preset_mix("radiology", tables, total=512, seed=SEED)
    return distribution(mix, "source").select("source", "n", "percent")
