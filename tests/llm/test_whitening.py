import numpy as np

from tidemart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, 4, 5) for i, v in rows], SCHEMA)


def _rows(n, d, seed=1, decay=0.97):
    rnd = np.random.default_rng(seed)
    turn = np.linalg.qr(rnd.standard_normal((d, d)))[0]
    return (rnd.standard_normal((n, d)) * decay ** np.arange(d)) @ turn


def _exact(x, k):
    v = np.cov(x.T.astype(float) - x.mean(axis=0)[:, None], bias=True)
    values, axes = np.linalg.eigh(v)
    return values[::-1][:k], axes[:, ::-1][:, :k], np.trace(v)


def _checked(spark, vectors, k=32, guard=whitening.GUARD):
    got = whitening.whitened(_vectors(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), k, guard=guard).toPandas()
    x = (np.floor(64 * vectors.astype(np.float32).astype(float)) + 1_000_000).astype(np.int64)
    values, axes, trace = _exact(x, k)
    k, n = len(values), len(x)
    got = got.sort_values(["vec_id", "component"])
    assert len(got) == n * k and (got.n == n).all()
    w = got.whitened.to_numpy().reshape(n, k)
    want = (x - x.mean(axis=0)) @ (axes / np.sqrt(values))
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w - want * signs).max() < 1e-8
    assert np.allclose(got.explained.to_numpy().reshape(n, k)[0], values / trace, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-9
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert (got.deviation.to_numpy().reshape(n, k)[:, 0] == deviation).all()


def test_filtered_block_equals_eigenvectors(spark):
    """More dimensions than the block is wide: the filter has to find the axes."""
    _checked(spark, _rows(400, 90))
    _checked(spark, _rows(300, 40, seed=2, decay=0.6), k=6, guard=3)


def test_block_as_wide_as_the_space(spark):
    _checked(spark, _rows(200, 20, seed=3))


def test_flat_spectrum_needs_several_rounds(spark):
    vectors = _vectors(spark, [(i, v.tolist()) for i, v in enumerate(_rows(3000, 48, seed=5, decay=1.0))])
    passes = whitening._Passes(vectors.select("embedding"), 48, 64, 1_000_000)
    model = whitening.fit(passes, 8, 8)
    assert model.residual <= whitening.ROUNDING and model.passes > 20


def test_odd_vectors(spark):
    some = _rows(60, 5, seed=4)
    good = [(i, v.tolist()) for i, v in enumerate(some)]
    odd = [
        (100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4),
        (104, []), (105, [1.0, 2.0]), (106, [1e30] + [0.0] * 4),
    ]
    more = [(None, good[0][1]), (7, good[7][1])]
    got = whitening.whitened(_vectors(spark, good + odd + more)).toPandas()
    assert len(got) == 62 * 5 and set(got.n) == {62} and not set(got.vec_id.dropna()) & {i for i, _ in odd}
    twice = got[got.vec_id == 7].sort_values("component")
    assert twice.whitened.to_numpy().reshape(5, 2)[:, 0].tolist() == twice.whitened.to_numpy().reshape(5, 2)[:, 1].tolist()


def test_no_variance_gives_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        got = whitening.whitened(_vectors(spark, rows))
        assert got.collect() == [] and got.columns[:3] == ["vec_id", "component", "n"]


def test_axes_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(12)]
    got = whitening.whitened(_vectors(spark, rows)).toPandas()
    assert set(got.component) == {1} and abs(got.explained - 1).max() < 1e-12


def test_deviations_beyond_a_long(spark):
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 1.0]), (2, [0.0, 0.5])]
    got = {r["vec_id"]: r for r in whitening.whitened(_vectors(spark, rows)).filter("component = 1").collect()}
    x = [[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    exact = [sum((3 * v[j] - sum(u[j] for u in x)) ** 2 for j in range(2)) for v in x]
    assert [got[i]["deviation"] for i in range(3)] == [e if e < 1 << 63 else None for e in exact] and exact[0] >= 1 << 63
