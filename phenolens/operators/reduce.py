"""Standardisation and principal components (M1–M3): on sparse rows, and dense with pyspark.ml.

The id column travels with the vectors through every stage, so cluster
assignments are joined back to labels by patient id, never by position.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolens.operators.matrix import sum_partials

# FIXED VALUE: number of principal components kept before clustering.
N_COMPONENTS = 10


def standardize(df: DataFrame, input_col: str = "features", output_col: str = "scaled",
                with_mean: bool = True):
    """M1: subtract the column mean, divide by the sample standard deviation.

    Statistics are one distributed summary pass (partial aggregation);
    a constant column maps to 0. ``with_mean=False`` only divides, which
    keeps sparse vectors sparse (see ``sparse_pca`` for those).
    """
    model = StandardScaler(withMean=with_mean, withStd=True, inputCol=input_col, outputCol=output_col).fit(df)
    return model.transform(df), model


def principal_components(df: DataFrame, n_features: int, k: int = N_COMPONENTS,
                         input_col: str = "scaled", output_col: str = "pca"):
    """M2 + M3: fit PCA with min(k, n_features) components and project every row.

    The fit builds the n x n covariance from one distributed pass; n is the
    dictionary size (distinct features), not the number of patients.
    """
    model = PCA(k=min(k, n_features), inputCol=input_col, outputCol=output_col).fit(df)
    return model.transform(df), model



@dataclass
class ColumnStats:
    """What standardising needs: rows, and per feature the mean and 1 / sample std (0 if constant)."""
    n_rows: int
    mean: np.ndarray
    inverse_std: np.ndarray


def column_stats(long: DataFrame, n_rows: int, n_features: int) -> ColumnStats:
    """M1's statistics from the entries (patient_id, feature_id, value); a missing entry is 0.

    One aggregate by feature; its n rows are model-sized. The squares are summed about the mean of
    the entries, so that a constant column has no spread left over from rounding."""
    found = long.groupBy("feature_id").agg(F.count(F.lit(1)).alias("c"), F.avg("value").alias("m"),
                                           F.var_pop("value").alias("v")).toPandas()
    mean, squares = np.zeros(n_features), np.zeros(n_features)
    ids, c = found["feature_id"].to_numpy(), found["c"].to_numpy(np.float64)
    m, v = found["m"].to_numpy(), found["v"].to_numpy()
    mean[ids] = m * c / n_rows
    squares[ids] = v * c + m * m * c * (n_rows - c) / n_rows
    std = np.sqrt(squares / max(n_rows - 1, 1))
    return ColumnStats(n_rows, mean, np.divide(1.0, std, out=np.zeros_like(std), where=std > 0))


def _entries(pdf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's entries: row within the batch, feature id, value."""
    lens = pdf["ids"].map(len).to_numpy()
    return (np.repeat(np.arange(len(pdf)), lens), np.concatenate(pdf["ids"].to_numpy()).astype(np.int64),
            np.concatenate(pdf["vals"].to_numpy()).astype(np.float64))


def _project(pdf, z: np.ndarray) -> np.ndarray:
    owner, cols, vals = _entries(pdf)
    return np.column_stack([np.bincount(owner, weights=vals * z[cols, j], minlength=len(pdf))
                            for j in range(z.shape[1])])


def covariance_times(rows: DataFrame, stats: ColumnStats, q: np.ndarray) -> np.ndarray:
    """C q for the covariance C of the standardised columns, without C and without centring the rows.

    ``rows`` holds each patient's (ids, vals), none without entries. One job: a pass over the sparse rows
    gives each partition's part of Xᵀ(X q), of which only the sum (the size of q) comes to the driver;
    the mean's share is taken off there."""
    n, p = q.shape
    z = rows.sparkSession.sparkContext.broadcast(stats.inverse_std[:, None] * q)

    def partial(batches):
        acc = np.zeros((n, p))
        for pdf in batches:
            if len(pdf):
                owner, cols, vals = _entries(pdf)
                xq = _project(pdf, z.value)
                for j in range(p):
                    acc[:, j] += np.bincount(cols, weights=vals * xq[owner, j], minlength=n)
        flat = acc.ravel()
        idx = np.flatnonzero(flat)
        yield pd.DataFrame({"idx": [idx], "val": [flat[idx]]})

    parts = rows.select("ids", "vals").mapInPandas(partial, "idx array<long>, val array<double>")
    total = sum_partials(parts, n * p, rows).reshape(n, p) * stats.inverse_std[:, None]
    z.unpersist()
    centre = stats.mean * stats.inverse_std
    return (total - stats.n_rows * np.outer(centre, centre @ q)) / max(stats.n_rows - 1, 1)


# The subspace grows by twice as many directions as components and is cut back at eight times as many;
# it has settled once every component's residual is this small beside the largest variance.
SUBSPACE_TOL, SUBSPACE_ROUNDS, SUBSPACE_SEED = 1e-11, 200, 8803


def ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors that a symmetric matrix has within an orthonormal basis, and the
    vectors' images, from the basis' image."""
    small = basis.T @ image
    values, y = np.linalg.eigh((small + small.T) / 2)
    values, y = values[::-1], y[:, ::-1]
    return values, basis @ y, image @ y


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Each vector with its largest entry positive."""
    return vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def rayleigh_ritz(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step: orthonormalise a block, project the matrix on it, rotate. (Ritz values, Ritz vectors)"""
    basis = np.linalg.qr(block)[0]
    values, vectors, _ = ritz(basis, times(basis))
    return values, _signed(vectors)


def leading_components(times: Callable[[np.ndarray], np.ndarray], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric n x n matrix, given as a product, and their vectors.

    Block Krylov subspace with restarts: the residuals of the best vectors so far are the next
    directions. Holds n x 8k numbers, never n x n. Each vector's largest entry is positive."""
    block = min(n, 2 * k)
    basis = np.linalg.qr(np.random.default_rng(SUBSPACE_SEED).standard_normal((n, block)))[0]
    image = times(basis)
    for _ in range(SUBSPACE_ROUNDS):
        values, vectors, images = ritz(basis, image)
        rest = images[:, :block] - vectors[:, :block] * values[:block]
        if np.linalg.norm(rest[:, :k], axis=0).max() <= SUBSPACE_TOL * max(values[0], 1.0):
            break
        if basis.shape[1] + block > 4 * block:
            basis, image = vectors[:, : 2 * block], images[:, : 2 * block]
        for _ in range(2):   # once leaves traces of the basis in small residuals
            rest = rest - basis @ (basis.T @ rest)
        u, s, _ = np.linalg.svd(rest, full_matrices=False)
        u = u[:, s > 1e-13 * max(values[0], 1.0)]
        if not u.shape[1]:
            break
        u = np.linalg.qr(u - basis @ (basis.T @ u))[0]
        basis, image = np.hstack([basis, u]), np.hstack([image, times(u)])
    return values[:k], _signed(vectors[:, :k])


def sparse_pca(rows: DataFrame, stats: ColumnStats, k: int = N_COMPONENTS, output_col: str = "pca"):
    """M1-M3 on sparse rows (patient_id, ids, vals): the same as centring, scaling, PCA and projection.

    The projection of a centred row is pcᵀ(x / std) - pcᵀ(mean / std), so rows are never densified to
    the dictionary width. Returns the rows with ``output_col`` and the components (n x k)."""
    n = len(stats.mean)
    _, pc = leading_components(lambda q: covariance_times(rows, stats, q), n, min(k, n))
    z = rows.sparkSession.sparkContext.broadcast(stats.inverse_std[:, None] * pc)
    shift = (stats.mean * stats.inverse_std) @ pc

    def project(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"patient_id": pdf["patient_id"], "pca": list(_project(pdf, z.value) - shift)})

    out = rows.select("patient_id", "ids", "vals").mapInPandas(project, "patient_id string, pca array<double>")
    return out.select("patient_id", array_to_vector("pca").alias(output_col)), pc
