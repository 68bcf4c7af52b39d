"""Driver queries of the operators (``opN_<name>``) and their DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import licenses
from quarry.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# -- 1: quality -------------------------------------------------------------------------

@query("op1_quality")
def op1_quality(spark, sf_dir):
    from quarry.llm.quality import quality_scores
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# -- 5: near duplicates -----------------------------------------------------------------

NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
ids AS (SELECT doc_id, s, dense_rank() OVER (ORDER BY s) AS sid FROM sh),
hot AS (SELECT sid FROM ids GROUP BY sid HAVING count(*) > 1),
c AS (SELECT doc_id, sid FROM ids SEMI JOIN hot USING (sid)),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM c x JOIN c y ON x.sid = y.sid AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * common >= 85 * (p.n + q.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, to_id) AS (
  SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.to_id),
low AS (SELECT doc_id, min(to_id) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""


@query("op5_near_duplicates", NEAR_SQL)
def op5_near_duplicates(spark, sf_dir):
    from quarry.llm.near_dup import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)


# -- 7: toxicity ------------------------------------------------------------------------

@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    from quarry.llm.toxicity import toxicity_scores
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# -- 10: sharding -----------------------------------------------------------------------

@query("op10_sharding")
def op10_sharding(spark, sf_dir):
    from quarry.llm.sharding import shard_documents
    return shard_documents(read(spark, sf_dir, "documents"))


# -- 6: mixing --------------------------------------------------------------------------

@query("op6_mixing")
def op6_mixing(spark, sf_dir):
    from quarry.llm.mixing import mix_report
    return mix_report(read(spark, sf_dir, "documents"))


# -- 4: fingerprints --------------------------------------------------------------------

@query("op4_fingerprints")
def op4_fingerprints(spark, sf_dir):
    from quarry.llm.fingerprint import neighbour_fingerprints
    return neighbour_fingerprints(read(spark, sf_dir, "documents"))


# -- 3: benchmark decontamination -------------------------------------------------------

LEAK_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
t AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM w),
sh AS (SELECT side, id, len(w) - 4 AS m, unnest(range(0, len(w) - 4)) AS pos,
              unnest(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) AS s
       FROM t WHERE len(w) >= 5),
item AS (SELECT id AS item_id, m, s, count(*) AS c FROM sh WHERE side = 'b' GROUP BY ALL),
hit AS (SELECT d.id AS doc_id, i.item_id, i.m, d.m AS n, d.pos, d.s, i.c FROM sh d JOIN item i ON d.side = 'd' AND d.s = i.s),
span AS (SELECT *, CASE WHEN m < n THEN m ELSE n END AS w FROM hit),
win AS (SELECT DISTINCT doc_id, item_id, m, n, w, unnest(range(greatest(0, pos - w + 1), least(pos, n - w) + 1)) AS start FROM span),
cnt AS (SELECT win.doc_id, win.item_id, win.m, win.w, start, hit.s, count(*) AS k, min(hit.c) AS c
        FROM win JOIN hit ON hit.doc_id = win.doc_id AND hit.item_id = win.item_id AND hit.pos >= start AND hit.pos < start + win.w
        GROUP BY win.doc_id, win.item_id, win.m, win.w, start, hit.s),
sim AS (SELECT doc_id, item_id, m, w, start, sum(least(k, c)) AS b, w + m - sum(least(k, c)) AS u FROM cnt GROUP BY doc_id, item_id, m, w, start),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY b / u DESC, start) AS r FROM sim WHERE 100 * b >= 80 * u)
SELECT doc_id, item_id, (b / u)::DOUBLE AS similarity, start::BIGINT AS start_word, (w + 4)::BIGINT AS n_words FROM best WHERE r = 1
UNION ALL
SELECT doc_id, item_id, 1.0, min(p)::BIGINT, len(bw)::BIGINT
FROM (SELECT d.id AS doc_id, b.id AS item_id, d.w AS dw, b.w AS bw, unnest(range(0, len(d.w) - len(b.w) + 1)) AS p
      FROM t b JOIN t d ON b.side = 'b' AND d.side = 'd' AND len(b.w) BETWEEN 1 AND 4) AS x
WHERE list_slice(dw, p + 1, p + len(bw)) = bw GROUP BY doc_id, item_id, bw
"""


@query("op3_decontamination", LEAK_SQL)
def op3_decontamination(spark, sf_dir):
    from quarry.llm.decontaminate import contaminated
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("bits")


# -- 2: licenses ------------------------------------------------------------------------

@query("op2_licenses", licenses.report_sql())
def op2_licenses(spark, sf_dir):
    return licenses.license_report(read(spark, sf_dir, "documents"))


# -- 9: HTML ----------------------------------------------------------------------------

@query("op9_html")
def op9_html(spark, sf_dir):
    from quarry.llm.html_text import extract
    return extract(read(spark, sf_dir, "pages"))


# -- 8: secrets -------------------------------------------------------------------------

@query("op8_secrets")
def op8_secrets(spark, sf_dir):
    from quarry.llm.secrets import secret_findings
    return secret_findings(read(spark, sf_dir, "documents"))


# -- 13: fill-in-middle -----------------------------------------------------------------

FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id::VARCHAR) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
d AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
f AS (SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                     WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", FIM_SQL)
def op13_fill_in_middle(spark, sf_dir):
    from quarry.llm.fim import fill_in_middle, restored
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored("output", "form"), 256).alias("restored_sha256"))


# -- 12: line deduplication -------------------------------------------------------------

LINES_SQL = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, pos, line, owner IS NOT NULL AND owner <> k.doc_id AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def op12_line_dedup(spark, sf_dir):
    from quarry.llm.line_dedup import dedup_lines
    left = dedup_lines(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


# -- 11: ranked search ------------------------------------------------------------------

RANK_SQL = r"""
WITH t AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'q', item_id, text FROM benchmark),
w AS (SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM t),
tf AS (SELECT id, term, count(*) AS tf FROM w WHERE side = 'd' GROUP BY ALL),
len AS (SELECT id, sum(tf)::BIGINT AS n FROM tf GROUP BY id),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nw FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT id AS item_id, term, count(*) AS c FROM w WHERE side = 'q' GROUP BY ALL),
qw AS (SELECT item_id, term, c * floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), tot),
s AS (SELECT item_id, id AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nw))))::BIGINT AS score
      FROM qw JOIN tf USING (term) JOIN len USING (id), tot GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""


@query("op11_ranked_search", RANK_SQL)
def op11_ranked_search(spark, sf_dir):
    from quarry.llm.ranked_search import ranked
    return ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
