"""Token-weighted loss to perplexity (A5, A6) and a unigram loss source.

A5 works on a batch-loss table ``(dataset, batch_id, padded_len, loss, tokens)``:
``exp(sum(loss*tokens) / sum(tokens))`` per dataset; batches whose padded
length is under 2 are skipped; no tokens -> infinity. It is one grouped
aggregate. A6 keeps a failing dataset from hiding the others: scored rows
with a null or non-finite loss are flagged per row (no exception is raised)
and their dataset gets an ``error`` value instead of a number.

A7 fits an add-one unigram model per training corpus and scores test texts.
``ngram_losses`` gives the summed loss per corpus: the test tokens of all scored
texts are counted first, so two vocabulary-sized tables meet, no text and no
hot token. ``ngram_text_losses`` keeps the texts apart when that is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import lower_tokens, token_count


def perplexity(losses: DataFrame, by: str = "dataset", min_padded_len: int = 2) -> DataFrame:
    """A5: perplexity, loss, total_tokens, num_samples (all batches' samples), num_batches (scored)."""
    ok = F.col("padded_len") >= F.lit(min_padded_len)
    lw = F.when(ok, F.col("loss") * F.col("tokens"))
    n = F.when(ok, F.col("tokens"))
    samples = F.col("samples") if "samples" in losses.columns else F.lit(1)
    agg = losses.groupBy(by).agg(F.sum(lw).alias("_lw"), F.sum(n).alias("total_tokens"),
                                 F.sum(samples).alias("num_samples"),
                                 (F.sum("batches") if "batches" in losses.columns else F.count_if(ok)).alias("num_batches"))
    tokens = F.coalesce(F.col("total_tokens"), F.lit(0))
    loss = F.when(tokens > 0, F.col("_lw") / tokens).otherwise(F.lit(float("inf")))
    return (agg.withColumn("total_tokens", tokens).withColumn("loss", loss)
               .withColumn("perplexity", F.exp("loss")).drop("_lw"))


def perplexity_suite(losses: DataFrame, by: str = "dataset") -> DataFrame:
    """A5 per dataset plus an ``error`` column; a bad dataset does not stop the rest.

    A dataset errs when it has no usable tokens or a non-finite loss value.
    """
    scored = F.col("padded_len") >= F.lit(2)
    bad_row = scored & (F.col("loss").isNull() | F.isnan("loss") | (F.abs(F.col("loss")) == float("inf")))
    flagged = losses.withColumn("_bad", bad_row)
    bad = flagged.groupBy(by).agg(F.max(F.col("_bad").cast("int")).alias("_any_bad"))
    res = perplexity(flagged.filter(~F.col("_bad")), by).join(bad, by, "right")
    err = (F.when(F.col("_any_bad") == 1, F.lit("non-finite loss"))
            .when(F.coalesce(F.col("total_tokens"), F.lit(0)) == 0, F.lit("no tokens")))
    return (res.withColumn("error", err)
               .withColumn("perplexity", F.when(F.col("error").isNull(), F.col("perplexity")))
               .withColumn("loss", F.when(F.col("error").isNull(), F.col("loss")))
               .drop("_any_bad"))


def unigram_counts(train: DataFrame, corpus_col: str, text_col: str = "text") -> DataFrame:
    """Token counts per training corpus plus corpus totals N and vocabulary size V.

    The counts (one row per corpus and distinct token: vocabulary-sized, far
    smaller than the corpus) are checkpointed to the shared folder, so the two
    consumers do not each re-tokenize the training texts.
    """
    from quarry.session import cut_lineage
    toks = train.select(corpus_col, F.explode(lower_tokens(text_col)).alias("token"))
    counts = cut_lineage(toks.groupBy(corpus_col, "token").agg(F.count(F.lit(1)).alias("c")))
    totals = counts.groupBy(corpus_col).agg(F.sum("c").alias("N"), F.count(F.lit(1)).alias("V"))
    return counts, totals


def ngram_losses(train: DataFrame, test: DataFrame, corpus_col: str, datasets: list[str],
                 text_col: str = "text", min_len: int = 2) -> DataFrame:
    """A7 summed per training corpus: ``dataset, padded_len, loss, tokens, samples, batches`` (loss per token).

    With ``c`` a token's count in the corpus, ``N`` its token total and ``V`` its
    vocabulary size, a token costs ``ln(N+V) - ln(c+1)``; absent tokens cost
    ``ln(N+V)``. Texts under ``min_len`` tokens are counted as samples but not
    scored (``tokens`` of the scored ones). A corpus without training rows has a null loss.
    """
    counts, totals = unigram_counts(train.filter(F.col(corpus_col).isin(list(datasets))), corpus_col, text_col)
    toks = test.select(lower_tokens(text_col).alias("_t"))
    row = toks.agg(F.count(F.lit(1)).alias("samples"), F.count_if(F.size("_t") >= min_len).alias("batches"),
                   F.coalesce(F.sum(F.when(F.size("_t") >= min_len, F.size("_t"))), F.lit(0)).alias("tokens"))
    tt = (toks.filter(F.size("_t") >= min_len).select(F.explode("_t").alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("k")))
    seen = tt.join(counts, "token").groupBy(corpus_col).agg(F.sum(F.col("k") * F.log(F.col("c") + 1)).alias("_s"))
    grid = row.select("*", F.explode(F.array(*[F.lit(d) for d in datasets])).alias(corpus_col))
    grid = grid.join(totals, corpus_col, "left").join(seen, corpus_col, "left")
    n = F.col("tokens")
    loss = F.when(n > 0, (n * F.log(F.col("N") + F.col("V")) - F.coalesce("_s", F.lit(0.0))) / n)
    return grid.select(F.col(corpus_col).alias("dataset"), F.lit(min_len).alias("padded_len"), loss.alias("loss"), "tokens", "samples", "batches")


def ngram_text_losses(train: DataFrame, test: DataFrame, corpus_col: str, test_id: str, datasets: list[str],
                      text_col: str = "text") -> DataFrame:
    """A7 per (training corpus, test text), as batches of one text: ``dataset, batch_id, padded_len, loss, tokens``."""
    counts, totals = unigram_counts(train.filter(F.col(corpus_col).isin(list(datasets))), corpus_col, text_col)
    tt = (test.select(test_id, F.explode(lower_tokens(text_col)).alias("token"))
              .groupBy(test_id, "token").agg(F.count(F.lit(1)).alias("k")))
    seen = (tt.join(counts, "token")
              .groupBy(corpus_col, test_id).agg(F.sum(F.col("k") * F.log(F.col("c") + 1)).alias("_s")))
    grid = test.select(test_id, token_count(text_col).alias("tokens"),
                       F.explode(F.array(*[F.lit(d) for d in datasets])).alias(corpus_col))
    grid = grid.join(F.broadcast(totals), corpus_col, "left")   # one row per named corpus
    loss = (F.col("tokens") * F.log(F.col("N") + F.col("V")) - F.coalesce(F.col("_s"), F.lit(0.0))) / F.col("tokens")
    return (grid.join(seen, [corpus_col, test_id], "left")
                .select(F.col(corpus_col).alias("dataset"), F.col(test_id).alias("batch_id"),
                        F.col("tokens").alias("padded_len"),
                        F.when(F.col("tokens") > 0, loss).alias("loss"), F.col("tokens")))
