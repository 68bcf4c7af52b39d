"""Quality, toxicity, secrets: held-out accuracy, exactness of the index, defined cases."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as E
from quarry.llm import quality, toxicity
from quarry.llm.secrets import candidates, describe, secret_findings

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,least", [("op1_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.92)])
def test_held_out_accuracy(spark, name, label, least):
    got = E.queries()[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held[label]).mean() >= least
    assert got.score.between(0, 1).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_defined_cases(spark, module):
    rows = [(1, "good words stand here " * 30, "a"), (2, None, "b"), (3, "", "c"), (None, "x", None), (4, "BAD!! " * 5, "d"), (4, "BAD!! " * 5, "d"),
            (5, "w" * 2_500_000, "e"), (6, "long text " * 200_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (None, 1), (2, None), (77, 1), (6, 1)], "doc_id long, label int")
    for known in (labels, labels.limit(0), labels.where("label = 1")):
        model = module.fit(docs, known)
        got = module.score(docs, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 4}) == 1
        assert module.score(docs.limit(0), model).count() == 0


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    a, b = (sorted((r.doc_id, r.score) for r in quality.quality_scores(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit_gam(x, y)
    assert ((m.score(x) > 0.5) == y).mean() > 0.97 and (0, 1) in m.pairs
    b = m.bins(x[:5])                                  # a score is the sum of its table entries
    want = [m.intercept + sum(t[b[j][i]] for j, t in enumerate(m.tables)) + sum(t[b[j][i], b[k][i]] for (j, k), t in m.pairs.items()) for i in range(5)]
    assert np.allclose(m.margin(x[:5]), want)


def test_keep_good_keeps_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.keep_good(docs, labels)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    scored = {r.doc_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    assert kept.schema == docs.schema and ids == {i for i, p in scored.items() if p}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(700):
        t = rng.choice(40, rng.integers(1, 6), replace=False)
        w = rng.random(len(t)) + 0.1
        vectors.append(dict(zip(map(int, t), map(float, w / np.linalg.norm(w)))))
    index = toxicity.BlockMaxIndex(vectors, 40, block=16)
    for q in vectors[:60]:
        all_ = sorted(((min(1.0, round(sum(w * v.get(t, 0) for t, w in q.items()), 12)), i) for i, v in enumerate(vectors)), key=lambda x: (-x[0], x[1]))
        want = [x for x in all_ if x[0] > 0][:15]
        got = index.search(q, 15)
        assert [i for _, i in got] == [i for _, i in want] and np.allclose([s for s, _ in got], [s for s, _ in want])
    assert toxicity.BlockMaxIndex([], 3).search({0: 1.0}, 5) == []


def test_isotonic_is_monotone():
    x, p = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 0, 1.0]), np.ones(5))
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all() and p[-1] == 1.0


def test_secret_places_and_forest(spark):
    key = "3f9a" * 10
    rows = [(i, f"text {i} token = \"{key[i % 7:]}{i:04d}\" and averyveryverylongwordhere more. mail x.{i}longaddresspart12345@host.example.com") for i in range(60)]
    rows += [(900, None), (901, ""), (902, "é " + key + " end"), (None, f'token = "{key}"'), (903, f'password: "{key}"'), (903, f'password: "{key}"')]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    texts = {i: t for i, t in rows}
    got = secret_findings(docs).collect()
    for r in got:
        t = texts[r.doc_id].replace("", " ")
        assert hashlib.sha256(t[r.start:r.start + r.length].encode()).hexdigest() == r.sha256
    flagged = {r.doc_id for r in got if r.predicted}
    assert {i for i in range(60)} <= flagged and 903 in flagged and None in flagged
    assert not any(r.predicted for r in got if r.covered == 0 and r.length == len("averyveryverylongwordhere"))
    assert sum(r.doc_id == 903 for r in got) == 2
    assert secret_findings(docs.limit(0)).count() == 0
    assert {r.score for r in secret_findings(docs.where("doc_id = 902")).collect()} == {0.5}
    reviewed = spark.createDataFrame([(r.doc_id, r.start, int(r.length > 30)) for r in got if r.doc_id is not None], "doc_id long, start long, label int")
    assert all(r.predicted == (r.length > 30) for r in secret_findings(docs, reviewed).collect())


def test_secret_features_stay_in_range(spark):
    docs = spark.createDataFrame([(1, "see http://host/path/abcdefghij0123456789 or KEY=ABCDEFGHIJKLMNOP=="), (2, "x" * 400)], "doc_id long, text string")
    rows = describe(candidates(docs), ["the", "host"]).collect()
    assert len(rows) == 3 and all(0 <= r[c] <= 1 for r in rows for c in ("digits", "upper", "hex", "transitions", "distinct", "vowels", "covered"))
