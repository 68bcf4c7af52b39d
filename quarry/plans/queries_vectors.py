"""Driver queries over ``embeddings``: group-wise quantization, report, sweep, best setting."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.catalog import register
from quarry.session import cut_lineage, table

REPORT_SETTINGS = [(3, 16, True), (3, 32, False), (4, 16, True), (4, 32, False), (4, 64, True), (8, 64, True)]
SWEEP_GROUPS = [8, 16, 32, 64]


def _q_sql(src: str, b: str, g: str, sym: str) -> str:
    """DuckDB: codes/scales/zeros/dequant for settings given as SQL expressions."""
    qmax = f"(pow(2.0, {b} - 1) - 1)"
    levels = f"(pow(2.0, {b}) - 1)"
    part = f"v[gi * {g} + 1 : gi * {g} + {g}]"
    return f"""
s AS (
  SELECT *, list_transform(range(0, CAST(ceil(len(v) / {g}) AS BIGINT)), lambda gi:
              CASE WHEN {sym} THEN list_max(list_transform({part}, lambda x: abs(x))) / {qmax}
                   ELSE (greatest(list_max({part}), 0.0) - least(list_min({part}), 0.0)) / {levels} END) AS scales,
            list_transform(range(0, CAST(ceil(len(v) / {g}) AS BIGINT)), lambda gi:
              CASE WHEN {sym} OR (list_max({part}) = 0 AND list_min({part}) = 0) THEN 0.0
                   ELSE round(-least(list_min({part}), 0.0)
                              / ((greatest(list_max({part}), 0.0) - least(list_min({part}), 0.0)) / {levels})) END) AS zeros
  FROM {src}),
q AS (
  SELECT *, list_transform(v, lambda x, i: CAST(
              least(greatest(CASE WHEN scales[CAST(floor((i - 1) / {g}) AS BIGINT) + 1] = 0
                                  THEN zeros[CAST(floor((i - 1) / {g}) AS BIGINT) + 1]
                                  ELSE round(x / scales[CAST(floor((i - 1) / {g}) AS BIGINT) + 1])
                                       + zeros[CAST(floor((i - 1) / {g}) AS BIGINT) + 1] END,
                             CASE WHEN {sym} THEN -pow(2.0, {b} - 1) ELSE 0.0 END),
                    CASE WHEN {sym} THEN {qmax} ELSE {levels} END) AS INTEGER)) AS codes
  FROM s),
d AS (
  SELECT *, list_transform(codes, lambda c, i: (c - zeros[CAST(floor((i - 1) / {g}) AS BIGINT) + 1])
                                               * scales[CAST(floor((i - 1) / {g}) AS BIGINT) + 1]) AS dq
  FROM q),
e AS (
  SELECT *,
    list_reduce(list_transform(list_zip(v, dq), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, x: a + x, 0.0)
      / len(v) AS mse,
    list_reduce(list_transform(list_zip(v, dq), lambda p: p[1] * p[2]), lambda a, x: a + x, 0.0)
      / (sqrt(list_reduce(list_transform(v, lambda a: a * a), lambda a, x: a + x, 0.0))
         * sqrt(list_reduce(list_transform(dq, lambda a: a * a), lambda a, x: a + x, 0.0))) AS cosine,
    list_max(list_transform(list_zip(v, dq), lambda p: abs(p[1] - p[2]))) AS max_error,
    len(v) * 32.0 / (len(v) * {b} + ceil(len(v) / {g}) * (32 + CASE WHEN {sym} THEN 0 ELSE {b} END)) AS ratio
  FROM d)"""


VEC_SRC = "vsrc AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"


@register("quant_codes", f"WITH {VEC_SRC}, {_q_sql('vsrc', '4', '16', 'true')}" + """
SELECT vec_id, array_to_string(codes, ',') AS codes_text, len(scales) AS n_groups,
       round(list_max(scales), 6) AS max_scale, round(mse * 1e6, 3) AS mse_e6,
       max_error <= list_max(scales) / 2 + 1e-12 AS within_half_scale
FROM e
""")
def q_quant_codes(spark, sf_dir):
    """V1: 4-bit symmetric codes in groups of 16 for every vector, with its error."""
    from quarry.operators.vectors import error_columns, quantize
    q = error_columns(quantize(table(spark, sf_dir, "embeddings"), "embedding", 4, 16, True))
    return q.select("vec_id", F.array_join("codes", ",").alias("codes_text"), F.size("scales").alias("n_groups"),
                    F.round(F.array_max("scales"), 6).alias("max_scale"),
                    F.round(F.col("mse") * 1e6, 3).alias("mse_e6"),
                    (F.col("max_error") <= F.array_max("scales") / 2 + 1e-12).alias("within_half_scale"))


def _settings_sql(settings):
    return ", ".join(f"({b}, {g}, {'true' if s else 'false'})" for b, g, s in settings)


def report_sql(settings):
    return (f"WITH {VEC_SRC}, st(bits, group_size, sym) AS (VALUES {_settings_sql(settings)}),\n"
            "src AS (SELECT vsrc.*, st.* FROM vsrc CROSS JOIN st),"
            + _q_sql("src", "bits", "group_size", "sym") + """,
rep AS (SELECT bits, group_size, sym, avg(mse) AS mean_mse, avg(cosine) AS mean_cosine,
               max(max_error) AS max_error, avg(ratio) AS compression_ratio
        FROM e GROUP BY bits, group_size, sym)""")


@register("quant_report", report_sql(REPORT_SETTINGS) + """
SELECT bits, group_size, sym, round(mean_mse * 1e6, 3) AS mean_mse_e6, round(mean_cosine, 6) AS mean_cosine,
       round(max_error, 6) AS max_error, round(compression_ratio, 6) AS compression_ratio
FROM rep
""")
def q_quant_report(spark, sf_dir):
    """V1 report over six (bits, group size, symmetric) settings, one scan of the table."""
    from quarry.operators.vectors import quant_report
    r = quant_report(table(spark, sf_dir, "embeddings"), REPORT_SETTINGS)
    return r.select("bits", "group_size", "sym", F.round(F.col("mean_mse") * 1e6, 3).alias("mean_mse_e6"),
                    F.round("mean_cosine", 6).alias("mean_cosine"), F.round("max_error", 6).alias("max_error"),
                    F.round("compression_ratio", 6).alias("compression_ratio"))


SWEEP_SETTINGS = [(4, g, True) for g in SWEEP_GROUPS]


@register("quant_sweep", report_sql(SWEEP_SETTINGS) + """
SELECT group_size, round(mean_mse * 1e6, 3) AS mean_mse_e6, round(compression_ratio, 6) AS compression_ratio,
       round((mean_mse - lag(mean_mse) OVER (ORDER BY group_size)) * 1e6, 3) AS mse_change_e6,
       round((compression_ratio - lag(compression_ratio) OVER (ORDER BY group_size))
             / lag(compression_ratio) OVER (ORDER BY group_size) * 100, 6) AS ratio_change_pct
FROM rep
""")
def q_quant_sweep(spark, sf_dir):
    """W9 sweep_gain: 4-bit symmetric over group sizes 8..64; change against the previous step."""
    from quarry.operators.metrics import sweep_gain
    from quarry.operators.vectors import quant_report
    r = quant_report(table(spark, sf_dir, "embeddings"), SWEEP_SETTINGS)
    g = sweep_gain(r, "group_size", "mean_mse", "compression_ratio")
    return g.select("group_size", F.round(F.col("mean_mse") * 1e6, 3).alias("mean_mse_e6"),
                    F.round("compression_ratio", 6).alias("compression_ratio"),
                    F.round(F.col("quality_change") * 1e6, 3).alias("mse_change_e6"),
                    F.round("time_change_pct", 6).alias("ratio_change_pct"))


@register("best_setting", report_sql(REPORT_SETTINGS) + """
SELECT bits, group_size, sym, round(mean_mse * 1e6, 3) AS mean_mse_e6, round(32 / compression_ratio, 6) AS bits_per_weight
FROM rep WHERE 32 / compression_ratio < 5 ORDER BY mean_mse, bits, group_size LIMIT 1
""")
def q_best_setting(spark, sf_dir):
    """W9 best_under: the lowest-error setting using under 5 bits per weight."""
    from quarry.operators.metrics import best_under
    from quarry.operators.vectors import quant_report
    r = quant_report(table(spark, sf_dir, "embeddings"), REPORT_SETTINGS).withColumn(
        "bits_per_weight", 32 / F.col("compression_ratio"))
    b = best_under(r, "mean_mse", "bits_per_weight", 5.0, key_cols=["bits", "group_size"])
    return b.select("bits", "group_size", "sym", F.round(F.col("mean_mse") * 1e6, 3).alias("mean_mse_e6"),
                    F.round("bits_per_weight", 6).alias("bits_per_weight"))


@register("setting_skyline", report_sql(REPORT_SETTINGS) + """
SELECT a.bits, a.group_size, a.sym, round(a.mean_mse * 1e6, 3) AS mean_mse_e6, round(32 / a.compression_ratio, 6) AS bits_per_weight
FROM rep a WHERE NOT EXISTS (
  SELECT 1 FROM rep b WHERE b.mean_mse <= a.mean_mse AND b.compression_ratio >= a.compression_ratio
                        AND (b.mean_mse < a.mean_mse OR b.compression_ratio > a.compression_ratio))
""")
def q_setting_skyline(spark, sf_dir):
    """W9 skyline: the settings that no other one beats in both error and size."""
    from quarry.operators.metrics import skyline
    from quarry.operators.vectors import quant_report
    r = skyline(cut_lineage(quant_report(table(spark, sf_dir, "embeddings"), REPORT_SETTINGS)), ["mean_mse"], ["compression_ratio"])
    return r.select("bits", "group_size", "sym", F.round(F.col("mean_mse") * 1e6, 3).alias("mean_mse_e6"),
                    F.round(32 / F.col("compression_ratio"), 6).alias("bits_per_weight"))


FEEDBACK_SETTINGS = [(3, 16, True), (4, 16, True), (4, 64, True), (8, 64, True)]


@register("quant_feedback", f"""
WITH RECURSIVE st(bits, group_size, sym) AS (VALUES {_settings_sql(FEEDBACK_SETTINGS)}),
{VEC_SRC},
el AS (SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM vsrc),
gram AS (SELECT a.i, b.i AS k, avg(a.x * b.x) AS g FROM el a JOIN el b USING (vec_id) GROUP BY a.i, b.i),
gram_row AS (SELECT i, list(g ORDER BY k) AS g FROM gram GROUP BY i),
damped AS (SELECT i, k, g + CASE WHEN i = k THEN 0.01 * (SELECT avg(g) FROM gram WHERE i = k) ELSE 0 END AS h FROM gram),
elim AS (
  SELECT (SELECT max(i) FROM gram) AS j, i, k, h FROM damped
  UNION ALL
  SELECT j - 1, i, k, h - h_ij * h_jk / h_jj
  FROM (SELECT *, max(h) FILTER (k = j) OVER (PARTITION BY i) AS h_ij, max(h) FILTER (i = j) OVER (PARTITION BY k) AS h_jk,
               max(h) FILTER (i = j AND k = j) OVER () AS h_jj FROM elim) AS x
  WHERE i < j AND k < j),
feed AS (SELECT a.j, list(a.h / b.h ORDER BY a.i) AS w FROM elim a JOIN elim b ON b.j = a.j AND b.i = b.j AND b.k = b.j
         WHERE a.k = a.j AND a.i < a.j GROUP BY a.j),
scaled AS (SELECT vec_id, v, bits, group_size, sym, list_transform(range(0, len(v)), lambda i:
             list_max(list_transform(v[(i // group_size) * group_size + 1 : (i // group_size + 1) * group_size], lambda x: abs(x)))
             / (pow(2.0, bits - 1) - 1)) AS s FROM vsrc CROSS JOIN st),
walk AS (
  SELECT *, 0 AS j, CAST([] AS DOUBLE[]) AS e FROM scaled
  UNION ALL
  SELECT vec_id, v, bits, group_size, sym, s, walk.j + 1,
         list_append(e, v[walk.j + 1] - CASE WHEN s[walk.j + 1] = 0 THEN 0 ELSE s[walk.j + 1] * greatest(-pow(2.0, bits - 1), least(pow(2.0, bits - 1) - 1,
           round((v[walk.j + 1] + CASE WHEN walk.j = 0 THEN 0 ELSE list_dot_product(w, e) END) / s[walk.j + 1]))) END)
  FROM walk LEFT JOIN feed ON feed.j = walk.j + 1 WHERE walk.j < len(v)),
err AS (
  SELECT bits, group_size, sym, vec_id, e AS fed, list_transform(range(1, len(v) + 1), lambda i: v[i] - CASE WHEN s[i] = 0 THEN 0
           ELSE s[i] * greatest(-pow(2.0, bits - 1), least(pow(2.0, bits - 1) - 1, round(v[i] / s[i]))) END) AS plain
  FROM walk WHERE j = len(v)),
proj AS (SELECT bits, group_size, sym, vec_id, sum(plain[i] * list_dot_product(g, plain)) AS plain, sum(fed[i] * list_dot_product(g, fed)) AS fed
         FROM err CROSS JOIN gram_row GROUP BY bits, group_size, sym, vec_id)
SELECT bits, group_size, sym, round(avg(plain) * 1e6, 3) AS plain_error_e6, round(avg(fed) * 1e6, 3) AS feedback_error_e6,
       round(avg(fed) / avg(plain), 6) AS ratio
FROM proj GROUP BY bits, group_size, sym
""")
def q_quant_feedback(spark, sf_dir):
    """V1 with error feedback: mean square error of dot products with the table's vectors, against round to nearest."""
    from quarry.operators.feedback import feedback_report
    r = feedback_report(table(spark, sf_dir, "embeddings"), FEEDBACK_SETTINGS)
    return r.select("bits", "group_size", "sym", F.round(F.col("plain_error") * 1e6, 3).alias("plain_error_e6"),
                    F.round(F.col("feedback_error") * 1e6, 3).alias("feedback_error_e6"), F.round("ratio", 6).alias("ratio"))
