"""Whitening of embeddings by block Golub-Kahan-Lanczos bidiagonalisation.

The centred vectors are the rows of a matrix X that only the executors hold.
Products X v and X'u alternate: a task multiplies its rows by the columns v and
the products u = X v at once by its rows again, so one pass over the rows makes
one step. The left vectors are kept by their coefficients (u = X w), which lets
both sides be reorthogonalised in full against all earlier vectors with numbers
as long as one row. The singular vectors of the small (block) bidiagonal matrix
give the components, its singular values their deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import shared_table

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Columns that one step takes through the rows; 1 is the plain bidiagonalisation.
BLOCK = 16
#: Entries of the vectors packed into one row of the table that the passes read.
PACKED_ENTRIES = 1 << 20
#: What is left of a vector below this share of the largest singular value is rounding.
ROUNDING = 2.0 ** -50
#: Scaled entries beyond this don't fit the integers of the result.
LARGEST = float(1 << 62)


def scaled_entries(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are whole, and the entries floor(64 c) of those as one row each."""
    whole = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    entries = vectors.take(pa.array(at)).flatten().cast(pa.float64(), safe=False)
    rows = np.floor(entries.to_numpy(zero_copy_only=False).reshape(len(at), dims) * SCALE)  # nulls become NaN
    fit = (np.abs(rows) < LARGEST).all(axis=1)
    return at[fit], rows[fit].astype(np.int64)


def vector_length(df: DataFrame, column: str) -> int:
    """The most frequent length of the vectors, the longer of equally frequent ones; 0 if there are none."""
    top = (df.select(F.size(column).alias("d")).filter("d > 0").groupBy("d").count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return top["d"] if top else 0


def _smallest_type(rows: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if np.abs(rows).max(initial=0) <= np.iinfo(kind).max:
            return rows.astype(kind)
    return rows


def pack(df: DataFrame, column: str, dims: int) -> DataFrame:
    """(n, kind, entries, sums, low, high): blocks of vectors as bytes of integers, with their sums by dimension."""
    step = max(1, PACKED_ENTRIES // dims)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = scaled_entries(batch.column(0), dims)
            for part in (rows[i:i + step] for i in range(0, len(rows), step)):
                small = _smallest_type(part)
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([len(part)], pa.int64()), "kind": [small.dtype.str],
                    "entries": pa.array([small.tobytes()], pa.binary()),
                    "sums": pa.array([part.sum(axis=0).tolist()], pa.list_(pa.int64())),
                    "low": pa.array([int(part.min())], pa.int64()), "high": pa.array([int(part.max())], pa.int64())})

    return df.select(column).mapInArrow(
        packed, "n long, kind string, entries binary, sums array<long>, low long, high long")


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, without the rounding of a mean where n x - S fits an integer."""
    if n * (int(np.abs(rows).max(initial=0)) + 1) < 1 << 62:
        return (n * rows.astype(np.int64) - sums) / n
    return rows - sums / n


def _total(df: DataFrame, expression: str) -> np.ndarray:
    """Sum by place of an array column, as many numbers as one array has."""
    rows = (df.select(F.posexplode(F.expr(expression)).alias("place", "x")).groupBy("place")
            .agg(F.sum("x").alias("x")).collect())
    out = np.zeros(len(rows), dtype=object if any(isinstance(r["x"], int) for r in rows) else float)
    for r in rows:
        out[r["place"]] = r["x"]
    return out


class Rows:
    """The packed table with what a pass needs to centre it."""

    def __init__(self, packed: DataFrame, dims: int):
        self.packed, self.dims = packed, dims
        facts = packed.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).first()
        self.n, self.low, self.high = facts["n"] or 0, facts["low"], facts["high"]
        self.sums = _total(packed, "sums").astype(np.int64) if self.n else np.zeros(dims, np.int64)

    def _pass(self, task: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum over all blocks of an array that ``task`` makes of a block's centred rows."""
        n, sums, dims = self.n, self.sums, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for kind, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    rows = np.frombuffer(data.as_buffer(), dtype=kind).reshape(-1, dims)
                    total += task(_centred(rows, n, sums)).ravel()
            yield pa.RecordBatch.from_pydict({"part": pa.array([total.tolist()], pa.list_(pa.float64()))})

        return _total(self.packed.select("kind", "entries").mapInArrow(run, "part array<double>"), "part").astype(float)

    def product(self, w: np.ndarray) -> np.ndarray:
        """X'(X w): both products of a step in one pass."""
        return self._pass(lambda x: x.T @ (x @ w), w.size).reshape(w.shape)

    def trace(self) -> float:
        """Sum of the squares of all centred entries."""
        return float(self._pass(lambda x: np.array([(x * x).sum()]), 1)[0])

    def covariance(self, w: np.ndarray) -> np.ndarray:
        """Covariance of the projections X w, centred once more."""
        k = w.shape[1]

        def moments(x):
            y = x @ w
            return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

        got = self._pass(moments, k + k * k)
        mean = got[:k] / self.n
        return got[k:].reshape(k, k) / self.n - np.outer(mean, mean)


def _orthonormal(r: np.ndarray, least: float) -> np.ndarray:
    """A basis of the columns of ``r``, without directions shorter than ``least``."""
    if not r.shape[1]:
        return r
    left, size, _ = np.linalg.svd(r, full_matrices=False)
    return left[:, size > least]


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], dims: int, components: int, block: int = BLOCK,
                  tolerance: float = 1e-13) -> np.ndarray:
    """Right singular vectors of the rows behind ``product``, at least ``components`` of them where the rank allows.

    Every round takes ``block`` columns through the rows once. It ends when the
    triplets wanted leave a residual below ``tolerance`` of the largest singular
    value, or the vectors span all dimensions.
    """
    block = min(block, dims)
    v = np.linalg.qr(np.cos(np.outer(np.arange(1, dims + 1), np.arange(1, block + 1))) + np.eye(dims, block))[0]
    right, coefficients, back = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    largest = 0.0
    while True:
        # X v without its parts along earlier left vectors u = X w, as U'X v = (X'U)'v
        w = v - coefficients @ (back.T @ v)
        z = product(w)
        again = back.T @ w
        w, z = w - coefficients @ again, z - back @ again
        squares, turn = np.linalg.eigh((w.T @ z + z.T @ w) / 2)  # lengths of X w
        largest = max(largest, squares.max(initial=0))
        kept = squares > dims * ROUNDING * largest
        scale = turn[:, kept] / np.sqrt(squares[kept])
        coefficients, back = np.hstack([coefficients, w @ scale]), np.hstack([back, z @ scale])
        right = np.hstack([right, v])
        # X'u without its parts along earlier right vectors
        rest = z @ scale
        for _ in range(2):
            rest = rest - right @ (right.T @ rest)
        left, sizes, turned = np.linalg.svd(back.T @ right, full_matrices=False)  # (block) bidiagonal
        v = _orthonormal(rest, dims * ROUNDING * np.sqrt(largest))[:, :dims - right.shape[1]]
        if v.shape[1]:  # against what the division by short lengths magnified
            v = np.linalg.qr(v - right @ (right.T @ v))[0]
        residual = np.linalg.norm((back - right @ (right.T @ back)) @ left[:, :components], axis=0)
        if not v.shape[1] or (len(sizes) >= components and residual.max(initial=0) <= tolerance * np.sqrt(largest)):
            return right @ turned.T
        if not kept.any():
            return right @ turned.T


class Whitener:
    """Components as columns (unit length, falling variance), the variances, and the measured error."""

    def __init__(self, rows: Rows, components: int, block: int):
        trace = rows.trace() if rows.n else 0.0
        self.basis, self.variances, self.explained, self.error = np.zeros((rows.dims, 0)), np.zeros(0), np.zeros(0), 0.0
        if not trace > 0:
            return
        basis = np.linalg.qr(bidiagonalise(rows.product, rows.dims, components, block))[0]
        for _ in range(4):  # one rotation unless rounding asks for more
            z = rows.product(basis)
            squares, turn = np.linalg.eigh((basis.T @ z + z.T @ basis) / 2)
            order = np.argsort(-squares)[:components]
            order = order[squares[order] > rows.dims * ROUNDING * squares.max()]
            basis = np.linalg.qr(basis @ turn[:, order])[0] * np.sign(
                np.diagonal(np.linalg.qr(basis @ turn[:, order])[1]))
            self.basis, self.variances = basis, squares[order] / rows.n
            spread = rows.covariance(self.basis / np.sqrt(self.variances))
            self.error = float(np.abs(spread - np.eye(len(order))).max())
            if self.error < 1e-9:
                break
        self.explained = squares[order] / trace


def whiten(df: DataFrame, id_col: str = "vec_id", column: str = "embedding", components: int = COMPONENTS,
           dims: int | None = None, block: int = BLOCK) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each whole vector and component.

    Entries are taken as doubles and scaled to the integers floor(64 c) + 1000000;
    all else is of these. Vectors that are null, or hold a null or non-finite
    entry or one beyond the integers (2^62 / 64), have no rows and no part in the fit;
    neither have those of another length than ``dims`` (the most frequent length if
    not given). Repeated rows count and return each; a null id is an id like any
    other; other columns are not read. ``deviation`` is exact, a decimal(38,0).
    Components with no variance are left out, so a table of one vector, or of equal
    or no vectors, returns no rows. The driver holds as many numbers as
    dimensions times the vectors of the bidiagonalisation, never rows.
    """
    dims = dims or vector_length(df, column)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, deviation decimal(38,0), whitened array<double>"
    if dims:
        rows = Rows(shared_table(pack(df, column, dims), "packed_vectors"), dims)
        fit = Whitener(rows, components, block)
    if not dims or not len(fit.variances):
        empty = df.select(id_col).limit(0).select(
            F.col(id_col), F.lit(0).cast("decimal(38,0)").alias("deviation"),
            F.array().cast("array<double>").alias("whitened"))
        return _result(empty, id_col, 0, [], 0.0)
    n, sums, weights = rows.n, rows.sums, fit.basis / np.sqrt(fit.variances)
    reach = max(abs(n * rows.high - int(sums.min())), abs(n * rows.low - int(sums.max())))
    fits = dims * reach * reach < 1 << 63

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = pa.decimal128(38, 0)
        for batch in batches:
            at, entries = scaled_entries(batch.column(1), dims)
            ids = batch.column(0).take(pa.array(at))
            for i in range(0, len(at), max(1, PACKED_ENTRIES // dims)):
                part = entries[i:i + max(1, PACKED_ENTRIES // dims)]
                if fits:
                    apart = n * part - sums
                    deviation = pa.array((apart * apart).sum(axis=1)).cast(decimal)
                else:
                    apart = n * part.astype(object) - sums.astype(object)
                    deviation = pa.array([Decimal(int(x)) for x in (apart * apart).sum(axis=1)], decimal)
                white = _centred(part, n, sums) @ weights
                lists = pa.ListArray.from_arrays(
                    np.arange(len(part) + 1, dtype=np.int32) * weights.shape[1], pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, len(part)), deviation, lists],
                                                 names=[id_col, "deviation", "whitened"])

    return _result(df.select(id_col, column).mapInArrow(project, schema), id_col, n, fit.explained.tolist(), fit.error)


def _result(rows: DataFrame, id_col: str, n: int, explained: list[float], error: float) -> DataFrame:
    shares = F.array(*[F.lit(float(x)) for x in explained]) if explained else F.array().cast("array<double>")
    return rows.select(id_col, "deviation", F.posexplode("whitened").alias("place", "white")).select(
        id_col, (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("white").alias("whitened"), F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"))
