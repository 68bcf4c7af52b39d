"""Secret scans: candidates from a pattern, false positives removed by a random forest.

Candidates are runs of at least ``LEAST`` characters of ``A-Za-z0-9+/_=-``. Each
is described by its length, its character transitions and shares, how much of it
dictionary words cover, the path it stands in and its neighbouring words. A
random forest (``pyspark.ml``) trained on labelled findings scores it.

DataFrame and SQL functions and ``pyspark.ml`` only: no Python runs on executors.
The dictionary holds the ``DICTIONARY`` most frequent short words of all texts;
the forest is fitted on at most ``MAX_POSITIVE`` + ``MAX_NEGATIVE`` labelled
findings (the smallest hashes of their place, so any run picks the same).
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, scratch

LEAST = 16
DICTIONARY = 300
MAX_POSITIVE, MAX_NEGATIVE = 5_000, 15_000
TREES, DEPTH, SEED = 20, 6, 7
MARK = "\uE000"
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
# Words that announce a credential.
ANNOUNCE = r"(?i)(token|secret|passw(or)?d|passphrase|api[_ -]?key|access[_ -]?key|auth|bearer|credential|private)"
FEATURES = ("length", "digits", "upper", "hex", "transitions", "distinct", "vowels", "covered", "in_path", "path_after",
            "quoted", "assigned", "announced", "prose")


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 6 letters a-z over all texts (ties in code point order)."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z]+")).alias("w")).where(F.length("w").between(3, 6))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return [r.w for r in top.collect()]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, start, candidate, before, after)``: every candidate of every whole text, with its surroundings.

    start counts code points. Up to 40 characters before and 20 after are given,
    as far as the next candidate.
    """
    text = F.col("_t")
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_t")).where(text.rlike(CANDIDATE))
    clean = F.when(F.contains(text, F.lit(MARK)), F.replace(text, F.lit(MARK), F.lit(" "))).otherwise(text)
    rows = rows.select(id_col, F.split(F.regexp_replace(clean, f"({CANDIDATE})", f"{MARK}$1{MARK}"), MARK, -1).alias("p"))
    ends = F.aggregate("p", F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<bigint>").alias("at")),
                       lambda a, x: F.struct((a["n"] + F.length(x)).alias("n"), F.concat(a["at"], F.array(a["n"])).alias("at")))["at"]
    rows = rows.select(id_col, "p", ends.alias("at")).select(id_col, "p", "at", F.explode(F.sequence(F.lit(1), F.size("p") - 2, F.lit(2))).alias("i"))

    def piece(offset: int) -> Column:
        return F.element_at("p", F.col("i") + offset + 1)

    return rows.select(id_col, F.element_at("at", F.col("i") + 1).alias("start"), piece(0).alias("candidate"),
                       F.expr("right(element_at(p, i), 40)").alias("before"), F.substring(piece(1), 1, 20).alias("after"))


def describe(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with the feature columns (doubles)."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    n = F.length(c).cast("double")

    def share(pattern: str) -> Column:                   # of the characters in the class
        return 1 - F.length(F.regexp_replace(c, pattern, "")) / n

    runs = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[+/_=-]+", "-")
    covered = F.lit(0.0)
    if words:
        covered = 1 - F.length(F.regexp_replace(F.lower(c), "|".join(sorted(map(re.escape, words), key=lambda w: (-len(w), w))), "")) / n
    values = {
        "length": F.least(n, F.lit(200.0)), "digits": share("[0-9]"), "upper": share("[A-Z]"), "hex": share("[0-9a-fA-F]"),
        "transitions": (F.length(runs) - 1) / n, "distinct": F.size(F.array_distinct(F.split(c, ""))) / n, "vowels": share("[aeiouAEIOU]"),
        "covered": covered, "in_path": before.rlike(r"([/\\@.]|://)\S*$"), "path_after": after.rlike(r"^[./\\@:]\S"),
        "quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"), "assigned": before.rlike(r"[=:]\s*[\"'`]?$"),
        "announced": before.rlike(ANNOUNCE + r"\W{0,8}$"), "prose": before.rlike(r"[a-z,.]\s+$") & (after.rlike(r"^[,.]?\s+\w") | (after == ""))}
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()})


def train(described: DataFrame, label_col: str = "label"):
    """Forest over labelled rows (0 or 1; others are ignored); a number (smoothed share) when one class is missing."""
    rows = described.where(F.col(label_col).isin(0, 1)).withColumn("_h", F.xxhash64(*described.columns))
    parts = [rows.where(F.col(label_col) == v).orderBy("_h").limit(n) for v, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    picked = cut_lineage(parts[0].unionByName(parts[1]).select(*FEATURES, F.col(label_col).cast("double").alias("label"), "_h"))
    n = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
    if not n.get(1.0) or not n.get(0.0):
        return (n.get(1.0, 0) + 0.5) / (sum(n.values()) + 1)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(picked.coalesce(1).sortWithinPartitions("_h"))
    model = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                   featureSubsetStrategy="sqrt").fit(data)
    # a loaded model is the trees alone; a fitted one drags its training summary, and with it the session, into tasks
    with scratch(described.sparkSession, "forest") as folder:
        model.write().save(folder)
        return RandomForestClassificationModel.load(folder)


def classify(described: DataFrame, model) -> DataFrame:
    """``described`` with ``score`` (0 to 1)."""
    if isinstance(model, float):
        return described.withColumn("score", F.lit(model))
    out = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="_v").transform(described).withColumnRenamed("_v", "v"))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("v", "rawPrediction", "probability", "prediction")


def seed_labels(found: DataFrame) -> Column:
    """Label of a finding whose surroundings leave no doubt, else null.

    1: a quoted value assigned to a name that announces a credential. 0: letters
    only, digits only, or part of an address or path.
    """
    c = F.col("candidate")
    sure = F.col("before").rlike(ANNOUNCE + r"\w*\s*[=:]\s*[\"'`]$") & F.col("after").rlike("^[\"'`]")
    never = c.rlike("^[A-Za-z]+$") | c.rlike("^[0-9]+$") | F.col("after").rlike(r"^[@.]\w") | F.col("before").rlike("@$")
    return F.when(sure, 1).when(never, 0)


def secret_findings(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(<id_col>, start, length, sha256, covered, announced, score, predicted)``, one row per candidate.

    ``labelled`` holds (id, start, label) of reviewed findings; without it the
    findings that ``seed_labels`` is sure of, outside a quarter of the ids, train
    the forest. The secret itself is not returned, only its hash. Defined cases:
    null and empty texts have no candidates; repeated rows report their findings
    each; ids may be null; other columns are never read; without labels of both
    classes every score is the smoothed share; an empty table gives no rows.
    """
    found = cut_lineage(describe(candidates(docs, id_col, text_col), dictionary(docs, text_col)))
    if labelled is None:
        fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4
        known = found.withColumn("label", F.when(fold != 2, seed_labels(found)))
    else:
        given = labelled.select(F.col(id_col).alias("_i"), F.col("start").alias("_s"), F.col("label").cast("int").alias("label")).dropDuplicates(["_i", "_s"])
        known = found.join(given, (found[id_col] == given["_i"]) & (found["start"] == given["_s"])).drop("_i", "_s")
    scored = classify(found, train(known))
    return scored.select(id_col, "start", F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("sha256"), "covered",
                         (F.col("announced") > 0).alias("announced"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
