"""k-means start and fit, EM rounds: against numpy, and independent of how rows are dealt."""
import numpy as np
import pytest

from phenolens.operators import clustering as cl

RNG = np.random.default_rng(3)
CENTERS = np.array([[0, 0, 0], [9, 1, 0], [0, 8, 8]], float)
POINTS = np.concatenate([c + RNG.normal(size=(70, 3)) * s for c, s in zip(CENTERS, (1.0, 0.7, 1.4))])


def rows(spark, points=POINTS, parts=3):
    return spark.createDataFrame([(f"p{i}", [float(x) for x in p]) for i, p in enumerate(points)],
                                 "id string, x array<double>").repartition(parts)


def test_start_and_fit_do_not_depend_on_partitions(spark):
    seen = [(cl.kmeans_start(rows(spark, parts=n), "id"), cl.kmeans_fit(rows(spark, parts=n), "id")) for n in (1, 7)]
    assert seen[0][0] == seen[1][0] and np.allclose(seen[0][1], seen[1][1], atol=1e-12)
    means = np.array([POINTS[i * 70:(i + 1) * 70].mean(axis=0) for i in range(3)])
    fit = np.array(seen[0][1])
    assert np.allclose(fit[np.argsort(fit @ [1, 10, 0])], means[np.argsort(means @ [1, 10, 0])], atol=1e-9)


def test_assign_puts_a_row_to_its_centre(spark):
    got = {r["id"]: r["cluster"] for r in cl.kmeans_assign(rows(spark), "x", id_col="id").collect()}
    groups = [{got[f"p{i}"] for i in range(g * 70, g * 70 + 70)} for g in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_few_distinct_rows_and_none(spark):
    same = rows(spark, [[1.0, 2.0]] * 5 + [[3.0, 4.0]] * 4)
    centers = cl.kmeans_start(same, "id")
    assert sorted(centers) == [[1.0, 2.0], [3.0, 4.0]]     # no third place to choose
    assert len({r["cluster"] for r in cl.kmeans_assign(same, "x", id_col="id").collect()}) == 2
    assert len({r["cluster"] for r in cl.gmm_assign(same, "x", id_col="id").collect()}) == 2
    none = rows(spark).limit(0)
    assert cl.kmeans_assign(none, "x", id_col="id").collect() == cl.gmm_assign(none, "x", id_col="id").collect() == []
    assert cl.choose([[0.0], [5.0], [6.0]], [3, 1, 4], 2) == [[6.0], [0.0]]


def mixture(x, model):
    """The same round in plain numpy, by densities."""
    d = x.shape[1]
    density = np.column_stack([w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m))
                               / np.sqrt((2 * np.pi) ** d * np.linalg.det(c))
                               for w, m, c in zip(model.weights, model.means, model.covariances)])
    r = density / density.sum(axis=1, keepdims=True)
    mass = r.sum(axis=0)
    means = (r.T @ x) / mass[:, None]
    cov = [((x - m) * r[:, [j]]).T @ (x - m) / mass[j] for j, m in enumerate(means)]
    return mass / len(x), means, np.array(cov), np.log(density.sum(axis=1)).sum()


@pytest.mark.parametrize("parts", [1, 6])
def test_em_round_against_numpy(spark, parts):
    start = cl.Mixture(np.array([.2, .5, .3]), CENTERS + 1, np.array([np.eye(3) * s for s in (1, 2, 3)]))
    model, likelihood = cl.em_step(rows(spark, parts=parts), start)
    weights, means, cov, want = mixture(POINTS, start)
    assert np.allclose(model.weights, weights) and np.allclose(model.means, means)
    assert np.allclose(model.covariances, cov) and np.isclose(likelihood, want)


def test_likelihood_never_falls_and_finds_the_groups(spark):
    model, history = cl.gmm_fit(rows(spark), "id", max_iter=12)
    assert len(history) > 2 and all(b >= a - 1e-9 * abs(a) for a, b in zip(history, history[1:]))
    assert np.allclose(np.sort(model.weights), 1 / 3, atol=0.02)
    got = {r["id"]: r["cluster"] for r in cl.gmm_assign(rows(spark), "x", id_col="id").collect()}
    assert len({got["p1"], got["p71"], got["p141"]}) == 3


def test_far_rows_have_a_finite_likelihood(spark):
    far = rows(spark, [[1e5, 0, 0], [-1e5, 0, 0], [0, 0, 0]])
    start = cl.Mixture(np.full(2, .5), np.zeros((2, 3)) + [[1], [-1]], np.repeat(np.eye(3)[None], 2, axis=0))
    model, likelihood = cl.em_step(far, start)
    assert np.isfinite(likelihood) and np.allclose(model.weights, 0.5)
