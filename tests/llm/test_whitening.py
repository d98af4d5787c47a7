"""Whitening against a full eigendecomposition, exact deviations, and odd rows."""
import numpy as np
import pytest

from phenolens.llm import queries, whitening

from conftest import SF


def truth(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, [int(d) for d in ((n * x - s).astype(object) ** 2).sum(axis=1)], c @ q / np.sqrt(e), e / np.trace(c.T @ c / n)


def compare(rows, ids, vectors, k, id_col="vec_id"):
    n, deviation, white, explained = truth(vectors, k)
    assert len(rows) == len(ids) * k
    got = {(r[id_col], r["component"]): r for r in rows}
    found = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    found *= np.sign((found * white).sum(axis=0))
    assert np.abs(found - white).max() < 1e-7
    for i, d in zip(ids, deviation, strict=True):
        assert all(got[i, c + 1]["n"] == n and int(got[i, c + 1]["deviation"]) == d for c in range(k))
    assert all(abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 for r in rows)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and 0 <= rows[0]["identity_error"] < 1e-9


def test_query(spark):
    rows = queries.QUERIES["op13_whitening"](spark, SF["0.01"]).collect()
    data = queries.table(spark, SF["0.01"], "embeddings").collect()
    compare(rows, [r["vec_id"] for r in data], [r["embedding"] for r in data], 32)


@pytest.mark.parametrize("block", [1, 3, 16])
def test_spectra(spark, block):
    """Steep, equal and vanishing variances; components end where the variance does."""
    rng = np.random.default_rng(8)
    for scales in ([1000, 300, 10, 1, .3, .1], [5, 5, 5, 5, 0, 0], [400, 7, 7, .2, 0, 0]):
        vectors = (rng.normal(size=(60, 6)) * scales).tolist()
        rank = sum(s > 0 for s in scales)
        df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
        rows = whitening.whiten(df, block=block).collect()
        if len(set(scales[:rank])) == rank or scales[0] == 5:
            compare(rows, list(range(60)), vectors, rank)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [.5, -.25, 3.]), (2, [1., 2., -3.]), (None, [.1, .2, .3]), (3, [9., 0., 1.]), (3, [9., 0., 1.])]
    bad = [(4, None), (5, [1., None, 2.]), (6, [1., nan, 2.]), (7, [inf, 0., 0.]), (8, [1., 2.]), (9, []), (10, [1e300, 0., 0.])]
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in good + bad],
                               "vec_id long, embedding array<double>, entries string, n int")
    rows = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in rows} == {1, 2, 3, None} and len(rows) == 5 * 3
    _, deviation, _, _ = truth([v for _, v in good], 3)
    assert {(r["vec_id"], int(r["deviation"])) for r in rows} == set(zip([i for i, _ in good], deviation))
    for few in ([], [(1, [1., 2.])], [(1, [1., 2.]), (2, [1., 2.])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect() == []


def test_deviations_beyond_a_long(spark):
    vectors = [[1e8 * (i % 7), -3e7 * (i % 5)] for i in range(50)]
    df = spark.createDataFrame([(f"v{i}", v) for i, v in enumerate(vectors)], "id string, e array<double>")
    rows = whitening.whiten(df, "id", "e").collect()
    assert max(int(r["deviation"]) for r in rows) > 1 << 63
    compare(rows, [f"v{i}" for i in range(50)], vectors, 2, "id")
