"""Matrix operators against numpy, and properties of the NMF."""
import numpy as np
from pyspark.sql import functions as F

from phenolens.operators import matrix as mx
from phenolens.operators import nmf


def rows_df(spark, rows, key="row_id"):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)],
                                 f"{key} long, vec array<double>")


def long_df(spark, rows):
    return mx.entries_from_rows(rows_df(spark, rows), "row_id", "vec")


def dense(df, key, n_rows, n_cols):
    out = np.zeros((n_rows, n_cols))
    for r in df.collect():
        out[r[key]] = r["vec"]
    return out


RNG = np.random.default_rng(17)


def test_entries_row_major(spark):
    m = RNG.normal(size=(4, 5))
    e = {(r["row_id"], r["col_id"]): r["value"] for r in long_df(spark, m).collect()}
    assert e == {(i, j): m[i, j] for i in range(4) for j in range(5)}


def test_products_equal_numpy(spark):
    v, w, h = RNG.normal(size=(6, 4)), RNG.normal(size=(6, 3)), RNG.normal(size=(4, 3))
    long = long_df(spark, v)
    assert np.allclose(dense(mx.transpose_times(long, rows_df(spark, w), 3), "col_id", 4, 3), v.T @ w)
    by_col = rows_df(spark, h, key="col_id")
    assert np.allclose(dense(mx.multiply_by_columns(long, by_col, 3), "row_id", 6, 3), v @ h)


def test_hadamard_and_divide(spark):
    a = rows_df(spark, [[1, 2], [3, 4]])
    b = rows_df(spark, [[2, 2], [4, 8]])
    assert dense(mx.hadamard(a, b, "row_id"), "row_id", 2, 2).tolist() == [[2, 4], [12, 32]]
    got = dense(mx.divide(a, b, "row_id"), "row_id", 2, 2)
    assert np.allclose(got, [[0.5, 1.0], [0.75, 0.5]])


# two groups of rows by which columns they use: rows 0, 2, 4 the first two, rows 1, 3 the others
GROUPED = [[5, 4, 0, 0.2], [0, 0.1, 3, 6], [4, 6, 0.3, 0], [0.2, 0, 5, 5], [6, 5, 0.1, 0.1]]


def test_nmf_groups_rows(spark):
    res = nmf.run(long_df(spark, GROUPED), 2, 60, n_cols=4)
    cluster = {r["row_id"]: r["cluster"] for r in nmf.assign_clusters(res.w).collect()}
    assert cluster[0] == cluster[2] == cluster[4] != cluster[1] == cluster[3]
    assert np.all(dense(res.w, "row_id", 5, 2) >= 0)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(res.errors, res.errors[1:]))   # error never rises


def test_nmf_stops_when_the_error_settles_and_not_before(spark):
    v = long_df(spark, GROUPED)
    res = nmf.run(v, 2, 100, tol=1e-2, n_cols=4)
    changes = -np.diff(res.errors)
    assert 3 < res.iterations < 100 and changes[-1] <= 1e-2 and (changes[:-1] > 1e-2).all()
    assert nmf.run(v, 2, 5, tol=0.0, n_cols=4).iterations == 5


def test_nmf_keyed_equals_colocated(spark):
    v = long_df(spark, GROUPED)
    a = nmf.run(v, 2, 6, tol=0.0, n_cols=4)
    b = nmf.run_keyed(v, 2, 6, tol=0.0)
    assert np.allclose(a.errors, b.errors, rtol=1e-9)
    assert np.allclose(dense(a.w, "row_id", 5, 2), dense(b.w, "row_id", 5, 2), rtol=1e-9)


def test_frobenius_identity(spark):
    vm = np.array([[1.0, 0.0, 2.0], [0.0, 3.0, 0.5]])
    v = long_df(spark, vm.tolist()).where(F.col("value") != 0)
    w = rows_df(spark, [[0.5, 1.0], [2.0, 0.1]])
    h = rows_df(spark, [[0.3, 0.2], [1.0, 0.4], [0.7, 0.9]], key="col_id")   # by column
    err = mx.frobenius_error(mx.squared_norm(v), mx.transpose_times(v, w, 2), h, mx.gram(w, 2), mx.gram(h, 2))
    wm = np.array([[0.5, 1.0], [2.0, 0.1]])
    hm = np.array([[0.3, 0.2], [1.0, 0.4], [0.7, 0.9]]).T
    assert abs(err - np.sum((vm - wm @ hm) ** 2)) < 1e-12


def test_init_value_matches_numpy(spark):
    ids = spark.range(5).withColumnRenamed("id", "row_id")
    got = dense(nmf.init_factor(ids, "row_id", 3, 8803), "row_id", 5, 3)
    assert np.array_equal(got, nmf.init_matrix(np.arange(5), 3, 8803))
    assert np.all((got > 0) & (got <= 1))


def test_argmax_first_wins(spark):
    w = rows_df(spark, [[1, 3, 3], [5, 1, 5], [0, 0, 1]])
    got = {r["row_id"]: r["cluster"] for r in nmf.assign_clusters(w).collect()}
    assert got == {0: 1, 1: 0, 2: 2}


def test_sparse_pca_equals_dense_pca(spark):
    from conftest import SF
    from phenolens.operators import features as fe
    from phenolens.plans import evaluation as ev
    from phenolens.sources import starschema as ss
    tuples = fe.event_feature_tuples(ss.clinical_event_log(spark, SF["0.001"]))
    a = {r["patient_id"]: r["pca"].toArray() for r in ev.prepare(tuples, sparse=True).reduced.collect()}
    b = {r["patient_id"]: r["pca"].toArray() for r in ev.prepare(tuples, sparse=False).reduced.collect()}
    assert set(a) == set(b)
    ids = sorted(a)
    ma, mb = np.array([a[i] for i in ids]), np.array([b[i] for i in ids])
    signs = np.sign(np.sum(ma * mb, axis=0))          # each principal axis is defined up to its sign
    assert np.allclose(ma, mb * signs, atol=1e-7)


def test_components_are_eigenvectors_of_the_covariance(spark):
    from phenolens.operators import reduce as rd
    n, k = 40, 4
    x = RNG.poisson(0.7, size=(300, n)).astype(float) * RNG.uniform(1, 50, size=n)
    x[:, 1] = 3 * x[:, 0] + RNG.normal(size=300)   # an axis of its own
    x[:, 2] = 66.6                                 # constant: no share in any component
    x[5], x[5, 2] = 0, 66.6
    rows = spark.createDataFrame([(str(i), [int(c) for c in np.flatnonzero(r)], [float(v) for v in r[r != 0]])
                                  for i, r in enumerate(x)], "patient_id string, ids array<long>, vals array<double>")
    long = rows.select("patient_id", F.explode(F.arrays_zip("ids", "vals")).alias("e")).select(
        "patient_id", F.col("e.ids").alias("feature_id"), F.col("e.vals").alias("value"))
    stats = rd.column_stats(long, 300, n)
    out, pc = rd.sparse_pca(rows.repartition(3), stats, k)
    std = x.std(axis=0, ddof=1)
    std[2] = 1
    z = (x - x.mean(axis=0)) / std
    c = np.cov(z, rowvar=False)
    assert stats.inverse_std[2] == 0
    assert np.allclose(rd.covariance_times(rows, stats, np.eye(n)), c, atol=1e-10)
    lam = np.sort(np.linalg.eigvalsh(c))[::-1][:k]
    assert np.allclose(c @ pc, pc * lam, atol=1e-8) and np.allclose(pc.T @ pc, np.eye(k), atol=1e-10)
    got = {int(r["patient_id"]): r["pca"].toArray() for r in out.collect()}
    assert np.allclose(np.array([got[i] for i in range(300)]), z @ pc, atol=1e-8)


def test_leading_components_with_restarts():
    from phenolens.operators import reduce as rd
    n, k = 400, 3
    q = np.linalg.qr(RNG.normal(size=(n, n)))[0]
    lam = np.concatenate([[9.0, 9.0, 8.9], np.linspace(8.5, 0, n - 3)])   # a double value, and close ones
    m = (q * lam) @ q.T
    widths = []

    def times(b):
        widths.append(b.shape[1])
        return m @ b

    values, vectors = rd.leading_components(times, n, k)
    assert np.allclose(values, lam[:k], atol=1e-9) and np.allclose(m @ vectors, vectors * values, atol=1e-8)
    assert max(widths) <= 2 * k
    for size in (1, 2, 5):
        values, vectors = rd.leading_components(lambda b: np.diag(np.arange(size) * 1.0) @ b, size, min(k, size))
        assert np.allclose(values, np.arange(size)[::-1][:k])


def test_least_squares_against_every_support():
    """Each row's solution against the best over all sets of positive components."""
    from itertools import product
    for k in (1, 2, 4):
        f = RNG.normal(size=(9, k))
        f[:, -1] = f[:, 0] * 0.999 + 0.001 * f[:, -1] if k > 1 else f[:, -1]   # nearly alike
        g, b = f.T @ f, RNG.normal(size=(60, 9)) @ f
        x = nmf.least_squares(b, g)
        value = 0.5 * np.einsum("ni,ij,nj->n", x, g, x) - (b * x).sum(axis=1)
        best = np.zeros(60)
        for on in product([False, True], repeat=k):
            on = np.array(on)
            if on.any():
                s = np.linalg.solve(g[np.ix_(on, on)], b[:, on].T).T
                v = -0.5 * (b[:, on] * s).sum(axis=1)
                best = np.where((s >= 0).all(axis=1), np.minimum(best, v), best)
        assert (x >= 0).all() and np.allclose(value, best, atol=1e-7)
    assert (nmf.least_squares(np.array([[-1.0, -2.0]]), np.eye(2)) == 0).all()
    assert np.isfinite(nmf.least_squares(np.zeros((2, 2)), np.zeros((2, 2)))).all()


def test_nmf_settles_on_the_patients(spark):
    """Ends by its tolerance, all clusters populated, error below what 100 multiplicative rounds reach (5.17e6)."""
    from conftest import SF
    from phenolens.plans import evaluation as ev
    from phenolens.plans.catalog import feature_tuples
    inputs = ev.feature_inputs(feature_tuples(spark, SF["0.01"]))
    clusters, res = ev.nmf_clusters(inputs)
    assert res.iterations < 100 and abs(res.errors[-1] - res.errors[-2]) <= ev.NMF_TOL
    assert res.errors[-1] < 5.1e6 and all(b <= a * (1 + 1e-12) for a, b in zip(res.errors, res.errors[1:]))
    assert len({r["cluster"] for r in clusters.select("cluster").distinct().collect()}) == 3
    v, _ = ev.nmf_input(inputs)
    w, h = res.w.withColumnRenamed("vec", "w"), res.h.withColumnRenamed("vec", "h")
    dot = F.aggregate(F.zip_with("w", "h", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    cross, norm = (v.join(w, "row_id").join(F.broadcast(h), "col_id").select((F.col("value") * dot).alias("c"))
                   .agg(F.sum("c")).first()[0], mx.squared_norm(v))
    trace = sum(a * b for x, y in zip(mx.gram(res.w, 3), mx.gram(res.h, 3)) for a, b in zip(x, y))
    assert np.isclose(norm - 2 * cross + trace, res.errors[-1], rtol=1e-6)   # the factors have the error that is told
    inputs.release()


def test_a_round_writes_nothing(spark):
    """A round's job is one pass over the written blocks whose partial sums are all that is shuffled."""
    v = long_df(spark, GROUPED)
    blocks = nmf.lay_out(v, v.count())
    h = spark.sparkContext.broadcast(np.ones((4, 2)))
    for weights in (nmf.Weights(2, 1), nmf.Weights(2, 1, [h, h]), nmf.Weights(2, 1, exact=h)):
        wtv, wtw = nmf.round_products(blocks, weights, 4)
        w = dense(nmf.row_factor(blocks, weights), "row_id", 5, 2)
        assert np.allclose(wtv, np.array(GROUPED).T @ w) and np.allclose(wtw, w.T @ w)
    plan = nmf.row_factor(blocks, weights)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "nmf_blocks" in plan


def test_rows_without_entries_and_long_rows(spark):
    rows = [[1.0, 2, 3, 4], [0, 0, 0, 0], [2, 0, 0, 1], [0, 5, 0, 0]]
    v = long_df(spark, rows).where(F.col("value") != 0)
    ids = spark.range(4).withColumnRenamed("id", "row_id")
    blocks = nmf.lay_out(v, v.count(), ids, block_entries=3)
    assert blocks.count() >= 3   # the row with four entries is one of its own
    res = nmf.run(v, 2, 30, n_cols=4, row_ids=ids)
    assert res.w.count() == 4 and {r["row_id"]: r["vec"] for r in res.w.collect()}[1] == [0.0, 0.0]


def test_partials_add_up_on_the_driver_and_by_shuffle(spark, monkeypatch):
    parts = spark.createDataFrame([([0, 2], [1.0, 2.0]), ([2], [0.5]), ([], [])], "idx array<long>, val array<double>")
    assert mx.sum_partials(parts, 4).tolist() == mx.sum_partials(parts, 4, parts).tolist() == [1.0, 0.0, 2.5, 0.0]
    monkeypatch.setattr(mx, "COLLECTED_BYTES", 0)
    assert mx.sum_partials(parts, 4, parts).tolist() == [1.0, 0.0, 2.5, 0.0]
