import math

import numpy as np
import pytest

from tallyspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "clash") for i, v in vectors], SCHEMA)


def brute(vectors, width):
    """Exact integers, then a dense symmetric eigenproblem of the centred rows."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in list(v) + [0.0] * (width - len(v))] for _, v in kept]
    n, s = len(x), [sum(c) for c in zip(*x)]
    gaps = [[n * a - b for a, b in zip(row, s)] for row in x]
    c = np.array(gaps, float) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    return [i for i, _ in kept], n, [sum(g * g for g in row) for row in gaps], c, e, q


def check(spark, vectors, width, components, simple=True):
    ids, n, deviation, c, e, q = brute(vectors, width)
    got = whitening.op13_whitening(frame(spark, vectors)).collect()
    assert len(got) == n * components
    z = {}
    for r in got:
        z.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], r["whitened"])
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
    assert sorted(z, key=str) == sorted(set(zip(ids, deviation)), key=str)
    all_z = np.array([[z[i, d][k + 1] for k in range(components)] for i, d in zip(ids, deviation)])
    assert np.abs(np.cov(all_z.T, bias=True) - np.eye(components)).max() < 1e-9
    if simple:  # eigenvalues apart: each component is that of the dense problem, up to its sign
        want = c @ q[:, :components] / np.sqrt(e[:components])
        sign = np.sign((want * all_z).sum(axis=0))
        assert np.abs(want * sign - all_z).max() < 1e-7
    else:
        # the space spanned is the same: whitened distances do not depend on the basis
        want = c @ q[:, :components] / np.sqrt(e[:components])
        assert np.abs(want @ want.T - all_z @ all_z.T).max() < 1e-7


def test_against_dense_eigenproblem(spark):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    data = (rng.standard_normal((300, 40)) * np.geomspace(8, .5, 40)) @ turn + 5
    check(spark, [(i, v.tolist()) for i, v in enumerate(data)], 40, 32)


def test_left_out_padded_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((80, 6)) * [9, 7, 5, 4, 3, 2])]
    vectors += [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5),
                (504, [1.0, 2.0]), (505, []), (None, [3.0] * 6), (507, [4.0] * 6), (507, [4.0] * 6)]
    check(spark, vectors, 6, 6)


def test_equal_eigenvalues_and_null_directions(spark):
    axes = [(2 * i + s, [float(sign * (i == j)) for j in range(5)] + [1.0, float(sign * (i == 0))])
            for i in range(5) for s, sign in enumerate((1, -1))]
    check(spark, axes, 7, 5, simple=False)


def test_large_mean_and_wide_range(spark):
    rng = np.random.default_rng(6)
    data = rng.standard_normal((120, 4)) * [20000, 40, 1, .25] + [60000, 0, -3, 1]
    check(spark, [(i, v.tolist()) for i, v in enumerate(data)], 4, 4)


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, []), (2, [])]])
def test_no_variance_gives_no_rows(spark, vectors):
    out = whitening.op13_whitening(frame(spark, vectors))
    assert out.columns == [c.split()[0] for c in whitening._ROWS.split(", ")]
    assert out.count() == 0


def test_deviation_beyond_a_long_is_null(spark):
    got = whitening.op13_whitening(frame(spark, [(1, [3e9]), (2, [-3e9]), (3, [0.0])])).collect()
    assert [(r["vec_id"], r["deviation"]) for r in got] == [(1, None), (2, None), (3, 0)]
