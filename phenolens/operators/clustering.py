"""k-means, Gaussian mixture and nearest-centre assignment (M4, M5, R2).

Both fits are rounds of one distributed pass each, from which only k centres or k
Gaussians' sums reach the driver. Nothing depends on partitions, the order of rows
or the number of cores: where a fit samples, a row is chosen by a hash of its id.

Nearest-centre assignment against a driver-held centre set is a pure column
expression: the k centres are literals in the plan, so it needs neither a join nor
a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.functions.vectors import squared_distance
from phenolens.operators.matrix import sum_partials
from phenolens.session import materialize

# FIXED VALUES of the clustering runs.
K = 3
MAX_ITERATIONS = 20
SEED = 8803
#: k-means||: rounds of oversampling, and rows that a round chooses on average, per centre wanted.
START_ROUNDS, OVERSAMPLING = 4, 2
#: A fit has settled when no centre moves further (squared), or the mean log-likelihood gains no more.
CENTER_TOL, LIKELIHOOD_TOL = 1e-8, 1e-6


def distances_to(arr: Column, centers: list[list[float]]) -> Column:
    """Squared distance of an array column to each literal centre."""
    return F.array(*[squared_distance(arr, F.array(*[F.lit(float(x)) for x in c])) for c in centers])


def nearest_center(arr: Column, centers: list[list[float]]) -> Column:
    """R2: index of the closest centre (first wins on ties)."""
    d = distances_to(arr, centers)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def as_arrays(df: DataFrame, features_col: str, id_col: str) -> DataFrame:
    """(id, x): the features as an array of doubles."""
    kind = df.schema[features_col].dataType.typeName()
    x = vector_to_array(features_col) if kind == "vector" or "udt" in kind.lower() else F.col(features_col).cast("array<double>")
    return df.select(F.col(id_col), x.alias("x"))


# --------------------------------------------------------------------------- k-means

def chance(id_col: str, salt: str) -> Column:
    """A number in [0, 1) from the md5 of the id and a salt: the first 52 bits. A null id is empty text."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def summed(rows: DataFrame, task: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``task``'s array of ``size`` numbers over all rows ``x``, in one pass: a task takes a batch as a matrix."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += task(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array([np.arange(size)], pa.list_(pa.int64())),
                                          pa.array([total], pa.list_(pa.float64()))], names=["idx", "val"])

    return sum_partials(rows.select("x").mapInArrow(partial, "idx array<long>, val array<double>"), size, rows)


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.column_stack([((x - c) ** 2).sum(axis=1) for c in centers])


def oversample(rows: DataFrame, id_col: str, k: int, seed: int = SEED, rounds: int = START_ROUNDS) -> list[list[float]]:
    """Candidates of k-means||: the row of the smallest chance, then in each round every row with a chance
    below OVERSAMPLING * k times its share of the squared distances to the candidates so far.

    About 1 + rounds * OVERSAMPLING * k rows come to the driver, in the order of their chances."""
    first = rows.orderBy(chance(id_col, f"{seed}:0"), id_col).select("x").first()
    if first is None:
        return []
    found = [list(first["x"])]
    kind = rows.schema[id_col].dataType.simpleString()
    for number in range(1, rounds + 1):
        known, wanted = np.array(found), float(OVERSAMPLING * k)
        total = summed(rows, lambda x, c=known: squared_distances(x, c).min(axis=1).sum()[None], 1)[0]
        if not total:
            break

        def draw(batches: Iterator[pa.RecordBatch], c=known, t=total) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    share = wanted * squared_distances(x, c).min(axis=1)
                    yield batch.filter(pa.array(batch.column(0).to_numpy(zero_copy_only=False) * t < share))

        drawn = rows.select(chance(id_col, f"{seed}:{number}").alias("u"), F.col(id_col).alias("id"), "x").mapInArrow(
            draw, f"u double, id {kind}, x array<double>")
        new = sorted(drawn.collect(), key=lambda r: (r["u"], r["id"] is not None, r["id"]))
        found += [list(r["x"]) for r in new]
    return found


def choose(candidates: list[list[float]], weights: list[int], k: int) -> list[list[float]]:
    """k of the weighted candidates: the heaviest, then the one with the largest weight times squared distance
    to those chosen (the first of equals). Fewer if the rest lies on chosen ones."""
    points, heavy = np.array(candidates, float), np.array(weights, float)
    if not len(points):
        return []
    chosen = [int(heavy.argmax())]
    while len(chosen) < k:
        d = ((points[:, None, :] - points[chosen][None]) ** 2).sum(axis=2).min(axis=1) * heavy
        if not d.max() > 0:
            break
        chosen.append(int(d.argmax()))
    return points[chosen].tolist()


def kmeans_start(rows: DataFrame, id_col: str, k: int = K, seed: int = SEED, rounds: int = START_ROUNDS) -> list[list[float]]:
    """Start centres by k-means|| from rows (id, x): candidates weighed by the rows nearest to them."""
    candidates = oversample(rows, id_col, k, seed, rounds)
    if not candidates:
        return []
    known = np.array(candidates)
    weights = summed(rows, lambda x: np.bincount(squared_distances(x, known).argmin(axis=1), minlength=len(known)), len(known))
    return choose(candidates, weights.tolist(), k)


def kmeans_fit(rows: DataFrame, id_col: str, k: int = K, max_iter: int = MAX_ITERATIONS,
               seed: int = SEED) -> list[list[float]]:
    """M4: centres after Lloyd's rounds from ``kmeans_start``. A centre that loses all rows keeps its place."""
    centers = np.array(kmeans_start(rows, id_col, k, seed))
    for _ in range(max_iter if len(centers) else 0):
        n, d = centers.shape

        def sums(x: np.ndarray, c=centers) -> np.ndarray:
            near = np.eye(n)[squared_distances(x, c).argmin(axis=1)]
            return np.concatenate([near.sum(axis=0), (near.T @ x).ravel()])

        flat = summed(rows, sums, n + n * d)
        held = flat[:n, None] > 0
        moved = np.where(held, flat[n:].reshape(n, d) / np.where(held, flat[:n, None], 1.0), centers)
        change, centers = ((moved - centers) ** 2).sum(axis=1).max(), moved
        if change <= CENTER_TOL:
            break
    return centers.tolist()


def kmeans_assign(df: DataFrame, features_col: str = "pca", k: int = K, max_iter: int = MAX_ITERATIONS,
                  seed: int = SEED, id_col: str = "patient_id") -> DataFrame:
    """M4: fit k-means (k-means|| start) and assign every row -> (id, cluster). No rows give no rows."""
    rows = as_arrays(df, features_col, id_col)
    kept = rows if df.is_cached else materialize(rows)
    centers = kmeans_fit(kept, id_col, k, max_iter, seed)
    if kept is not rows:
        kept.unpersist()
    cluster = nearest_center(F.col("x"), centers) if centers else F.lit(0)
    return as_arrays(df, features_col, id_col).select(id_col, cluster.alias("cluster"))


# --------------------------------------------------------------------------- Gaussian mixture

@dataclass
class Mixture:
    weights: np.ndarray       # (k)
    means: np.ndarray         # (k, d)
    covariances: np.ndarray   # (k, d, d)

    def log_parts(self, x: np.ndarray) -> np.ndarray:
        """log(weight * density) of every row for every Gaussian, by Cholesky factors."""
        out = np.empty((len(x), len(self.weights)))
        for j, (weight, mean, cov) in enumerate(zip(self.weights, self.means, self.covariances, strict=True)):
            factor = np.linalg.cholesky(cov)
            z = np.linalg.solve(factor, (x - mean).T)
            out[:, j] = (np.log(weight) if weight > 0 else -np.inf) - 0.5 * (
                (z * z).sum(axis=0) + x.shape[1] * np.log(2 * np.pi)) - np.log(np.diagonal(factor)).sum()
        return out


def _log_sum(parts: np.ndarray) -> np.ndarray:
    top = parts.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(parts - top).sum(axis=1, keepdims=True)))[:, 0]


def em_sums(rows: DataFrame, model: Mixture) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """E step in one pass over rows with ``x``: per Gaussian the sums of the responsibilities r, of r x and of r x xT,
    and the log-likelihood. The sums are about the model's means, and partitions' sums just add up."""
    k, d = model.means.shape

    def sums(x: np.ndarray) -> np.ndarray:
        parts = model.log_parts(x)
        whole = _log_sum(parts)
        r = np.exp(parts - whole[:, None])
        shifted = [x - m for m in model.means]
        return np.concatenate([
            r.sum(axis=0), *[r[:, j] @ shifted[j] for j in range(k)],
            *[((shifted[j] * r[:, [j]]).T @ shifted[j]).ravel() for j in range(k)], [whole.sum()]])

    flat = summed(rows, sums, k + k * d + k * d * d + 1)
    return flat[:k], flat[k:k + k * d].reshape(k, d), flat[k + k * d:-1].reshape(k, d, d), float(flat[-1])


def em_step(rows: DataFrame, model: Mixture) -> tuple[Mixture, float]:
    """M5: one round of expectation and maximisation; also the log-likelihood of the model that went in.

    A Gaussian that is responsible for no row keeps its place with weight 0."""
    mass, first, second, likelihood = em_sums(rows, model)
    n = mass.sum()
    weights, means, covariances = mass / n, model.means.copy(), model.covariances.copy()
    for j in np.flatnonzero(mass > 0):
        shift = first[j] / mass[j]
        means[j] = model.means[j] + shift
        spread = second[j] / mass[j] - np.outer(shift, shift)
        covariances[j] = (spread + spread.T) / 2
    return Mixture(weights, means, covariances), likelihood


def _floored(model: Mixture, least: float) -> Mixture:
    """Covariances with no axis shorter than ``least``: a Gaussian on a few equal rows stays one."""
    out = []
    for cov in model.covariances:
        values, axes = np.linalg.eigh(cov)
        out.append((axes * np.maximum(values, least)) @ axes.T)
    return Mixture(model.weights, model.means, np.array(out))


def gmm_fit(rows: DataFrame, id_col: str, k: int = K, max_iter: int = MAX_ITERATIONS,
            seed: int = SEED) -> tuple[Mixture | None, list[float]]:
    """M5: a mixture fitted from ``kmeans_start`` with the rows' own covariance, and the log-likelihood of each round."""
    centers = np.array(kmeans_start(rows, id_col, k, seed))
    if not len(centers):
        return None, []
    d = centers.shape[1]
    one = Mixture(np.ones(1), np.zeros((1, d)), np.eye(d)[None])
    whole, _ = em_step(rows, one)
    scale = max(np.trace(whole.covariances[0]) / d, 1e-12)
    least = 1e-6 * scale
    model = _floored(Mixture(np.full(len(centers), 1 / len(centers)), centers,
                             np.repeat(whole.covariances, len(centers), axis=0)), least)
    n, history = None, []
    for _ in range(max_iter):
        new, likelihood = em_step(rows, model)
        n = n or rows.count()
        if history and abs(likelihood - history[-1]) <= LIKELIHOOD_TOL * n:
            history.append(likelihood)
            break
        history.append(likelihood)
        model = _floored(new, least)
    return model, history


def likeliest(rows: DataFrame, model: Mixture, id_col: str) -> DataFrame:
    """(id, cluster): the Gaussian with the largest part of each row's density, the first of equals."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.log_parts(x).argmax(axis=1).astype(np.int32))],
                                                 names=[id_col, "cluster"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "x").mapInArrow(pick, f"`{id_col}` {kind}, cluster int")


def gmm_assign(df: DataFrame, features_col: str = "pca", k: int = K, max_iter: int = MAX_ITERATIONS,
               seed: int = SEED, id_col: str = "patient_id") -> DataFrame:
    """M5: fit a Gaussian mixture by EM and assign each row its most likely component. No rows give no rows."""
    rows = as_arrays(df, features_col, id_col)
    kept = rows if df.is_cached else materialize(rows)
    model, _ = gmm_fit(kept, id_col, k, max_iter, seed)
    if kept is not rows:
        kept.unpersist()
    out = as_arrays(df, features_col, id_col)
    return likeliest(out, model, id_col) if model else out.select(id_col, F.lit(0).alias("cluster"))
