"""Quantization with error feedback against a brute-force solver, and its defined cases."""

import numpy as np
import pytest

from quarry.operators import feedback as fb
from quarry.operators import vectors as vq


def table_of(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")


def solved(x, gram, bits, group, damp, order):
    """After each rounding, the elements left are moved to the least e'He given the errors so far (a linear system each)."""
    h = gram + damp * np.diag(gram).mean() * np.eye(len(gram))
    out, codes = x.copy(), np.zeros(len(x), int)
    scale = np.repeat([np.abs(x[i:i + group]).max() / (2 ** (bits - 1) - 1) for i in range(0, len(x), group)], group)[:len(x)]
    for a, j in enumerate(order):
        done, left = order[:a], order[a:]
        move = np.linalg.solve(h[np.ix_(left, left)], h[np.ix_(left, done)] @ (x - out)[done]) if a else np.zeros(len(left))
        goal = x[j] + move[0]
        codes[j] = np.clip(np.trunc(goal / scale[j] + np.copysign(0.5, goal)), -2 ** (bits - 1), 2 ** (bits - 1) - 1)
        out[j] = codes[j] * scale[j]
    return codes, out


@pytest.fixture(scope="module")
def correlated():
    rng = np.random.default_rng(5)
    return rng.normal(size=(60, 3)) @ rng.normal(size=(3, 10)) + 0.2 * rng.normal(size=(60, 10))


def test_gram_matrix_equals_the_product(spark, correlated):
    gram, n = fb.gram_matrix(table_of(spark, correlated.tolist()).repartition(5))
    assert n == 60 and np.allclose(gram, correlated.T @ correlated / 60)


@pytest.mark.parametrize("bits,group,descending", [(3, 4, False), (4, 5, True), (8, 10, False)])
def test_codes_equal_the_solver(spark, correlated, bits, group, descending):
    df = table_of(spark, correlated.tolist())
    gram, _ = fb.gram_matrix(df)
    order, _ = fb.feedback_matrix(gram, descending=descending)
    assert list(order) == (list(np.argsort(-np.diag(gram), kind="stable")) if descending else list(range(10)))
    for r in fb.quantize_feedback(df, "embedding", bits, group, True, descending=descending).collect():
        codes, out = solved(correlated[r.vec_id], gram, bits, group, fb.DAMP, order)
        assert r.codes == codes.tolist() and np.allclose(r.dequant, out)


def test_projected_error_falls(spark, correlated):
    df = table_of(spark, correlated.tolist())
    rows = fb.feedback_report(df, [(3, 5, True), (4, 5, True), (4, 10, False)]).collect()
    assert all(r.ratio < 0.8 for r in rows)
    x = correlated
    q = {r.vec_id: r.dequant for r in vq.quantize(df, "embedding", 3, 5, True).collect()}
    brute = np.mean([np.mean((x @ (x[i] - np.array(q[i]))) ** 2) for i in range(len(x))])      # dot products with every vector
    assert rows[0].plain_error == pytest.approx(brute)


def test_without_correlation_codes_are_the_plain_ones(spark):
    rows = [[1.0 if i == j else 0.0 for j in range(6)] for i in range(6)] + [[0.0] * 6]
    df = table_of(spark, rows)
    plain = {r.vec_id: (r.codes, r.scales, r.zeros) for r in vq.quantize(df, "embedding", 4, 4, False).collect()}
    assert {r.vec_id: (r.codes, r.scales, r.zeros) for r in fb.quantize_feedback(df, "embedding", 4, 4, False).collect()} == plain


def test_defined_cases(spark):
    rows = [[1.0, 2.0, 3.0], None, [1.0], [], [1.0, None, 3.0], [float("nan"), 1.0, 1.0], [1.0, 2.0, 3.0], [0.0, 0.0, 0.0]]
    df = table_of(spark, rows).selectExpr("*", "'kept' as other")
    got = {r.vec_id: r for r in fb.quantize_feedback(df, "embedding", 4, 2).collect()}
    assert [i for i in got if got[i].codes is None] == [1, 2, 3, 4, 5] and got[0].codes == got[6].codes
    assert got[7].dequant == [0.0, 0.0, 0.0] and got[0].other == "kept" and len(got[0].scales) == 2
    assert fb.gram_matrix(df)[1] == 3
    empty = df.where("false")
    assert fb.quantize_feedback(empty).collect() == [] and fb.gram_matrix(empty)[1] == 0
    assert fb.feedback_report(empty, [(4, 2, True)]).first().ratio is None
    with pytest.raises(ValueError):
        fb.quantize_feedback(df, bits=5)
    with pytest.raises(ValueError):
        fb.gram_matrix(df, dim=fb.MAX_DIMENSION + 1)
