"""Distributed matrix operators on keyed DataFrames.

Representations (no positional pairing anywhere; every row carries its key):
- sparse/long   ``(row_id, col_id, value)``                     e.g. V
- row factor    ``(row_id, vec array<double>)`` of length k      e.g. W
- column factor ``(col_id, vec array<double>)`` of length k      e.g. H (k x n, stored by column)

k is small (the number of clusters); k x k products (Gram matrices) are
reduced to the driver as k*k numbers and applied as literal expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.operators.joins import join_small

EPS = 2.0e-15   # FIXED VALUE: added to every denominator of the multiplicative updates


def entries_from_rows(rows: DataFrame, row_col: str, array_col: str) -> DataFrame:
    """Row arrays -> row-major entries ``(row_id, col_id, value)`` (stays distributed)."""
    return rows.select(F.col(row_col).alias("row_id"),
                       F.posexplode(array_col).alias("col_id", "value")) \
        .select("row_id", F.col("col_id").cast("long"), F.col("value").cast("double"))


def factor_entries(factor: DataFrame, key: str, vec_col: str = "vec") -> DataFrame:
    """Row/column factor -> long ``(key, comp, value)``."""
    return factor.select(key, F.posexplode(vec_col).alias("comp", "value"))


def _sum_products(values: Column, vec: Column, k: int) -> list[Column]:
    return [F.sum(values * vec[j]).alias(f"_s{j}") for j in range(k)]


def _pack(k: int, name: str = "vec") -> Column:
    return F.array(*[F.coalesce(F.col(f"_s{j}"), F.lit(0.0)) for j in range(k)]).alias(name)


def multiply_by_columns(long: DataFrame, col_factor: DataFrame, k: int, out: str = "vec") -> DataFrame:
    """X (long) times D (k x n given by column) transposed: (X Dᵀ) rows -> (row_id, vec).

    ``col_factor`` has one row per column of X (the feature dictionary size);
    it is broadcast after a size check. The aggregation by ``row_id``
    is partial map-side.
    """
    joined = join_small(long, col_factor.select("col_id", F.col("vec").alias("_d")), "col_id")
    return joined.groupBy("row_id").agg(*_sum_products(F.col("value"), F.col("_d"), k)) \
        .select("row_id", _pack(k, out))


def transpose_times(long: DataFrame, row_factor: DataFrame, k: int, out: str = "vec") -> DataFrame:
    """Wᵀ V as a column factor (col_id, vec) = sum over rows i of v_ic * w_i.

    The row factor grows with the patients, so it is joined by its key and never marked for broadcasting."""
    joined = long.join(row_factor.select("row_id", F.col("vec").alias("_w")), "row_id")
    return joined.groupBy("col_id").agg(*_sum_products(F.col("value"), F.col("_w"), k)) \
        .select("col_id", _pack(k, out))


def gram(factor: DataFrame, k: int, vec_col: str = "vec") -> list[list[float]]:
    """FᵀF for a factor stored one k-vector per row: k*k sums, to the driver."""
    v = F.col(vec_col)
    row = factor.agg(*[F.sum(v[a] * v[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k)]).first()
    g = [[0.0] * k for _ in range(k)]
    for a in range(k):
        for b in range(a, k):
            val = row[f"g{a}_{b}"] or 0.0
            g[a][b] = g[b][a] = float(val)
    return g


def times_small(vec: Column, m: list[list[float]]) -> Column:
    """Row vector x (k x k literal): out[j] = sum_l vec[l] * m[l][j]."""
    k = len(m)
    return F.array(*[sum((vec[l] * F.lit(m[l][j]) for l in range(k)), F.lit(0.0)) for j in range(k)])


def hadamard(x: DataFrame, y: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Element-wise product of two key-aligned row factors."""
    j = x.select(key, F.col("vec").alias("_x")).join(y.select(key, F.col("vec").alias("_y")), key)
    return j.select(key, F.zip_with("_x", "_y", lambda a, b: a * b).alias("vec"))


def divide(x: DataFrame, y: DataFrame, key: str, eps: float = EPS) -> DataFrame:
    """Element-wise x / (y + eps) of two key-aligned row factors."""
    j = x.select(key, F.col("vec").alias("_x")).join(y.select(key, F.col("vec").alias("_y")), key)
    return j.select(key, F.zip_with("_x", "_y", lambda a, b: a / (b + F.lit(eps))).alias("vec"))


def squared_norm(long: DataFrame) -> float:
    """sum of v^2 over the stored (non-zero) entries."""
    return float(long.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0)


def frobenius_error(sq_norm_v: float, wtv: DataFrame, h: DataFrame, wtw: list[list[float]],
                    hht: list[list[float]]) -> float:
    """||V - W H||^2 over ALL entries (zeros included) without forming W H.

        = sum v^2 - 2 * sum_c h_c . (WᵀV)_c + sum_{j,l} (WᵀW)_{jl} (H Hᵀ)_{jl}

    Only the column factors (one row per feature) are joined here.
    """
    from phenolens.functions.vectors import dot
    cross = (wtv.select("col_id", F.col("vec").alias("_t")).join(h.select("col_id", F.col("vec").alias("_h")),
                                                                  "col_id")
             .agg(F.sum(dot(F.col("_t"), F.col("_h")))).first()[0] or 0.0)
    k = len(wtw)
    trace = sum(wtw[a][b] * hht[a][b] for a in range(k) for b in range(k))
    return sq_norm_v - 2.0 * float(cross) + trace


#: Partial arrays of all partitions come to the driver as they are if they take no more bytes than this.
COLLECTED_BYTES = 16 << 20


def sum_partials(parts: DataFrame, size: int, source: DataFrame | None = None) -> np.ndarray:
    """Sum of the partitions' partial arrays ``(idx, val)`` by index, as one model-sized array.

    ``source`` is the table that ``parts`` makes one row of each partition of. If so many arrays of ``size`` are within
    ``COLLECTED_BYTES``, the driver adds them up; otherwise they are shuffled by index, and their sums come."""
    out = np.zeros(size)
    if source is not None and source.rdd.getNumPartitions() * size * 16 <= COLLECTED_BYTES:
        for row in parts.toArrow().to_batches():
            for idx, val in zip(row.column(0), row.column(1)):
                np.add.at(out, idx.values.to_numpy(), val.values.to_numpy())
        return out
    total = (parts.select(F.explode(F.arrays_zip("idx", "val")).alias("e"))
             .groupBy(F.col("e.idx").alias("i")).agg(F.sum("e.val").alias("s")).toPandas())   # in Arrow batches
    out[total["i"].to_numpy(np.int64)] = total["s"].to_numpy()
    return out
