"""Corpus statistics: distributions, length statistics, sweeps, checks, term shares
(A1-A4, A16, J5, P5, P15).

All of these are single-pass aggregates with map-side partial aggregation; totals
come from the grouped rows. Term lists meet vocabulary-sized counts or token
runs in one equi-join whose strategy Spark picks at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import MAX_TOKENS, MIN_TOKENS, has_any, length_class, lower_tokens, token_count
from quarry.session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Thresholds of the minimum-length sweep and the row count each must reach.
SWEEP_THRESHOLDS = (256, 512, 1024, 2048)
SWEEP_MIN_ROWS = 256
# Domain keywords of the relevance check (naive detection).
MEDICAL_KEYWORDS = ("patient", "clinical", "diagnosis", "treatment",
                    "medical", "disease", "symptom", "therapy")
# Quality check thresholds: rows, mean length, domain percent.
MIN_ROWS_RECOMMENDED = 512
MIN_MEAN_LENGTH = 500
MIN_DOMAIN_PERCENT = 70
# Share under which a term counts as rare (0.003 %).
RARE_TERM_SHARE = 0.00003
# ---------------------------------------------------------------------------


def _r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


def distribution(df: DataFrame, col: str, count_col: str = "n", pct_col: str = "percent") -> DataFrame:
    """A1: count and percent of total per value, largest first (ties by value).

    The total is a window sum over the grouped rows (one row per distinct value,
    like the sorted report itself), so the input is read once and lazily.
    """
    g = df.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias(count_col))
    total = F.sum(count_col).over(Window.partitionBy())
    return (g.withColumn(pct_col, _r(F.try_divide(F.lit(100.0) * F.col(count_col), total)))
             .orderBy(F.col(count_col).desc(), F.col(col)))


def with_token_count(df: DataFrame, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    return df if out in df.columns else df.withColumn(out, token_count(text_col))


def length_stats(df: DataFrame, len_col: str = "n_tokens", by: Sequence[str] = (),
                 approx: bool = False) -> DataFrame:
    """A2: rows, mean, median, min, max, population std and total tokens.

    ``median`` is exact; Spark keeps a map of distinct lengths per partial
    aggregate, which is bounded by the longest text, not by the row count.
    ``approx=True`` uses ``percentile_approx`` instead (a fixed-size sketch).
    """
    n = F.col(len_col)
    med = F.percentile_approx(n, 0.5, 10_000).cast("double") if approx else F.median(n)
    aggs = [F.count(n).alias("rows"), _r(F.avg(n)).alias("mean"), _r(med).alias("median"),
            F.min(n).alias("min"), F.max(n).alias("max"), _r(F.stddev_pop(n)).alias("std"),
            F.sum(n).alias("total_tokens")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def length_bands(df: DataFrame, len_col: str = "n_tokens", lo: int = MIN_TOKENS,
                 hi: int = MAX_TOKENS) -> DataFrame:
    """P5 report: per class the row count, plus A2 statistics of the accepted class."""
    classed = df.withColumn("length_class", length_class(len_col, lo, hi))
    n = F.col(len_col)
    acc = F.col("length_class") == "accepted"
    return classed.groupBy("length_class").agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(F.when(acc, n))).alias("mean"),
        _r(F.median(F.when(acc, n))).alias("median"),
        _r(F.stddev_pop(F.when(acc, n))).alias("std"))


def min_length_sweep(df: DataFrame, len_col: str = "n_tokens",
                     thresholds: Sequence[int] = SWEEP_THRESHOLDS,
                     min_rows: int = SWEEP_MIN_ROWS) -> DataFrame:
    """A3: per threshold, rows at or above it, their percent and an ok flag."""
    n = F.col(len_col)
    row = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(n >= F.lit(t)).alias(f"_c{t}") for t in thresholds])
    stack = "stack({k}, {pairs}) as (threshold, passing)".format(
        k=len(thresholds), pairs=", ".join(f"{t}, _c{t}" for t in thresholds))
    return (row.selectExpr("_total", stack)
               .select(F.col("threshold").cast("int"), F.col("passing"),
                       _r(F.try_divide(F.lit(100.0) * F.col("passing"), F.col("_total"))).alias("percent"),
                       (F.col("passing") >= F.lit(min_rows)).alias("ok")))


def quality_checks(df: DataFrame, text_col: str = "text", len_col: str = "n_tokens",
                   keywords: Sequence[str] = MEDICAL_KEYWORDS) -> DataFrame:
    """A4: one aggregate row, unpivoted to (check, value, threshold, ok).

    Rows without text are counted apart and left out of the other checks.
    """
    t = F.col(text_col)
    has_text = t.isNotNull() & (t != F.lit(""))
    n = F.when(has_text, F.col(len_col))
    row = df.agg(
        F.count_if(has_text).alias("rows"),
        F.count_if(~has_text).alias("no_text"),
        F.count_if(has_text & (F.col(len_col) >= F.lit(MIN_TOKENS))).alias("above_min"),
        F.avg(n).alias("mean_len"),
        F.count_if(has_text & has_any(t, keywords)).alias("domain_rows"))
    checks = row.select(
        F.lit(1).alias("_k"),
        F.array(
            F.struct(F.lit("rows_above_min_length").alias("check"), F.col("above_min").cast("double").alias("value"),
                     F.lit(float(MIN_TOKENS)).alias("threshold"), (F.col("above_min") >= MIN_TOKENS).alias("ok")),
            F.struct(F.lit("sample_count").alias("check"), F.col("rows").cast("double").alias("value"),
                     F.lit(float(MIN_ROWS_RECOMMENDED)).alias("threshold"),
                     (F.col("rows") >= MIN_ROWS_RECOMMENDED).alias("ok")),
            F.struct(F.lit("mean_length").alias("check"), _r(F.col("mean_len")).alias("value"),
                     F.lit(float(MIN_MEAN_LENGTH)).alias("threshold"),
                     F.coalesce(F.col("mean_len") > MIN_MEAN_LENGTH, F.lit(False)).alias("ok")),
            F.struct(F.lit("domain_percent").alias("check"),
                     _r(F.try_divide(F.lit(100.0) * F.col("domain_rows"), F.col("rows"))).alias("value"),
                     F.lit(float(MIN_DOMAIN_PERCENT)).alias("threshold"),
                     F.coalesce(F.try_divide(F.lit(100.0) * F.col("domain_rows"), F.col("rows")) > MIN_DOMAIN_PERCENT,
                                F.lit(False)).alias("ok")),
            F.struct(F.lit("rows_without_text").alias("check"), F.col("no_text").cast("double").alias("value"),
                     F.lit(0.0).alias("threshold"), (F.col("no_text") == 0).alias("ok")),
        ).alias("_checks"))
    return checks.select(F.inline("_checks"))


def domain_relevance(df: DataFrame, text_col: str = "text", by: str = "lang",
                     keywords: Sequence[str] = MEDICAL_KEYWORDS) -> DataFrame:
    """P11 rolled up: rows with any keyword, per group, with percent."""
    hit = has_any(text_col, keywords)
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(hit).alias("domain_rows"))
              .withColumn("percent", _r(F.try_divide(F.lit(100.0) * F.col("domain_rows"), F.col("rows")))))


def explode_tokens(df: DataFrame, id_col: str, text_col: str = "text", out: str = "token") -> DataFrame:
    """Lower-cased tokens, one row each (narrow; no shuffle)."""
    return df.select(id_col, F.explode(lower_tokens(text_col)).alias(out))


def term_share(corpus: DataFrame, terms: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               term_col: str = "term", rare_share: float = RARE_TERM_SHARE) -> DataFrame:
    """Share of each term among all tokens; absent terms get 0; rare flag.

    Tokens are counted first (partial aggregation: a hot token costs one row per
    task), so the term list meets a vocabulary-sized table, not the tokens; the
    total is the sum of the same counts.
    """
    counts = cut_lineage(explode_tokens(corpus, id_col, text_col, term_col)
                         .groupBy(term_col).agg(F.count(F.lit(1)).alias("occurrences")))
    total = counts.select(F.sum("occurrences")).scalar()
    tl = terms.select(F.lower(F.col(term_col)).alias(term_col)).distinct()
    out = tl.join(counts, term_col, "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
    share = F.try_divide(F.col("occurrences"), total)
    return out.select(term_col, "occurrences", _r(F.lit(100.0) * share).alias("percent"),
                      (share < F.lit(rare_share)).alias("rare"))


def augment_with_terms(corpus: DataFrame, terms: DataFrame, per_term: int, seed: int = 42,
                       text_col: str = "text", id_col: str = "doc_id", term_col: str = "term") -> DataFrame:
    """For each term, up to ``per_term`` documents containing it (seeded choice).

    A term matches where its words stand as consecutive lower-cased tokens. A
    counted list of up to ``terms.BROADCAST_TERMS`` terms goes to the executors as
    a trie that every text is walked through once; of a longer list, the word
    counts that occur say which token runs to look at, every text yields its
    distinct runs of those lengths, and one join on the run finds the hits. No
    text travels either way. The per-term ranking is ``top_per_group``. Result: (term, doc_id, rank).
    """
    from quarry.operators import terms as trie
    from quarry.operators.sampling import top_per_group
    from quarry.functions.text import seeded_hash

    words = F.split(F.btrim(F.lower(F.col(term_col))), r"[ \t\n\r\f]+")
    tl = cut_lineage(terms.select(F.array_join(words, " ").alias(term_col), F.size(words).alias("_k"))
                     .filter(F.col(term_col) != "").distinct())
    lengths = sorted(r._k for r in tl.select("_k").distinct().collect())       # distinct word counts of the terms
    if not lengths:
        return corpus.select(F.lit("").alias(term_col), id_col, F.lit(1).alias("rank")).limit(0)
    if tl.count() <= trie.BROADCAST_TERMS:
        hits = trie.rows_with_terms(corpus, [r[0] for r in tl.select(term_col).distinct().collect()], id_col, text_col, term_col)
        return top_per_group(hits.withColumn("_h", seeded_hash(id_col, seed)), term_col, per_term, ["_h", id_col]).select(term_col, id_col, "rank")
    toks = F.col("_t")

    def runs(k: int) -> Column:
        first = F.when(F.size(toks) >= k, F.slice(toks, 1, F.size(toks) - (k - 1)))
        return F.transform(first, lambda x, i: F.concat_ws(" ", x, *[F.get(toks, i + j) for j in range(1, k)]))

    every = F.concat(*[toks if k == 1 else F.coalesce(runs(k), F.array().cast("array<string>")) for k in lengths])
    held = corpus.select(id_col, lower_tokens(text_col).alias("_t")).select(id_col, F.explode(F.array_distinct(every)).alias(term_col))
    hits = held.join(tl.select(term_col), term_col).withColumn("_h", seeded_hash(id_col, seed))
    return top_per_group(hits, term_col, per_term, ["_h", id_col]).select(term_col, id_col, "rank")


def preview(df: DataFrame, n: int = 3, chars: int = 200, key: str = "doc_id", text_col: str = "text",
            cols: Sequence[str] = ("source", "lang")) -> DataFrame:
    """First ``n`` rows by key: labels, token length, first ``chars`` characters + ``...`` (always)."""
    from quarry.operators.sampling import head_by_order
    keep = [c for c in cols if c in df.columns]
    return (head_by_order(df, n, key)
              .select(key, *keep, token_count(text_col).alias("n_tokens"),
                      F.concat(F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, chars), F.lit("..."))
                      .alias("preview")))
