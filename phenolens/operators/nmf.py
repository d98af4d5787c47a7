"""Non-negative matrix factorisation V ~ W H.

V is the patient x feature matrix (``(row_id, col_id, value)``), W has one
k-vector per patient, H one k-vector per feature (k is small).

Plan of ``run``: V is laid out once as static blocks of whole rows (packed
arrays, written to the shared folder). A round is ONE pass over the blocks that
writes nothing: a task computes the W of its rows from the broadcast H, and
returns its part of Wᵀ V and Wᵀ W; their sum (at most (features + k) * k numbers a
partition leave the tasks) gives the next H and the error ||V - WH||² (by the
identity in ``matrix.frobenius_error``) on the driver. W is no state of the
rounds, so rounds cost the same from the first to the last, and a lost executor
costs its tasks and no more.

The first rounds are multiplicative updates from the start values,

    H <- H * (Wᵀ V) / (Wᵀ W H + eps)          W <- W * (V Hᵀ) / (W H Hᵀ + eps)

where a task repeats the few updates of its W from the H of each round so far.
Started from values that are nearly alike, they pull the components apart, but
settle slowly. From then on W, and in turn H, are minimised exactly (non-negative
least squares: the limit of many such updates against one pass over V), and H is
extrapolated from the last rounds; where that raises the error, the round is
taken again without. A component that the exact rounds empty sends the run back
to twice as many multiplicative ones.

``run_keyed`` makes multiplicative updates alone for models that no driver can
hold: W and H are both keyed DataFrames and every product is a join + aggregation
(``matrix``). The caller chooses; nothing switches by size.

Start values are deterministic arithmetic on the integer ids (``init_value``)
so a run is reproducible and SQL can repeat a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.functions.vectors import argmax
from phenolens.operators import matrix as mx
from phenolens.session import cut_lineage, partitions_for, scratch_path

# FIXED VALUES: linear-congruential start values in (0, 1], see init_value.
LCG_MULT, LCG_STEP, LCG_MOD = 1103515245, 12345, 2147483648
EPS = mx.EPS
H_SALT = 7919   # H uses seed + H_SALT so W and H start from different numbers


def init_value(ids: Column, j: int, salt: int) -> Column:
    """M8: ((id * 1103515245 + j * 12345 + salt) mod 2^31 + 1) / (2^31 + 1); ids < 2^31."""
    x = (ids.cast("long") * F.lit(LCG_MULT) + F.lit(j * LCG_STEP + salt)) % F.lit(LCG_MOD)
    return (x + F.lit(1)).cast("double") / F.lit(float(LCG_MOD + 1))


def init_factor(ids: DataFrame, key: str, k: int, salt: int) -> DataFrame:
    return ids.select(key, F.array(*[init_value(F.col(key), j, salt) for j in range(k)]).alias("vec"))


def _ratio_update(cur: Column, num: Column, den: Column) -> Column:
    return F.zip_with(F.zip_with(cur, num, lambda a, b: a * b), den,
                      lambda a, b: a / (b + F.lit(mx.EPS)))


def update_h(h: DataFrame, wtv: DataFrame, wtw: list[list[float]]) -> DataFrame:
    """M9: H * (WᵀV) / (WᵀW H + eps); features with no entry get WᵀV = 0."""
    k = len(wtw)
    zero = F.array(*[F.lit(0.0)] * k)
    j = h.join(wtv.select("col_id", F.col("vec").alias("_t")), "col_id", "left")
    return j.select("col_id", _ratio_update(F.col("vec"), F.coalesce(F.col("_t"), zero),
                                            mx.times_small(F.col("vec"), wtw)).alias("vec"))


def update_w(w: DataFrame, vht: DataFrame, hht: list[list[float]]) -> DataFrame:
    """W * (VHᵀ) / (W HHᵀ + eps); all-zero rows of V get VHᵀ = 0."""
    k = len(hht)
    zero = F.array(*[F.lit(0.0)] * k)
    j = w.join(vht.select("row_id", F.col("vec").alias("_t")), "row_id", "left")
    return j.select("row_id", _ratio_update(F.col("vec"), F.coalesce(F.col("_t"), zero),
                                            mx.times_small(F.col("vec"), hht)).alias("vec"))


def start_factors(v: DataFrame, k: int, seed: int, row_ids: DataFrame | None = None,
                  col_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    rows = row_ids if row_ids is not None else v.select("row_id").distinct()
    cols = col_ids if col_ids is not None else v.select("col_id").distinct()
    return init_factor(rows, "row_id", k, seed), init_factor(cols, "col_id", k, seed + H_SALT)


@dataclass
class NMFResult:
    w: DataFrame                      # (row_id, vec)
    h: DataFrame                      # (col_id, vec)
    errors: list[float] = field(default_factory=list)
    iterations: int = 0


def prepare_v(v_long: DataFrame) -> DataFrame:
    """Materialise V once (reliable checkpoint); every round reads it again."""
    return cut_lineage(v_long.select("row_id", "col_id", F.col("value").cast("double")))


def run_keyed(v_long: DataFrame, k: int, max_iterations: int = 100, tol: float = 1e-4, seed: int = 8803,
              row_ids: DataFrame | None = None, col_ids: DataFrame | None = None) -> NMFResult:
    """M7 with keyed factors: same rounds and stop rule as ``run``."""
    v = prepare_v(v_long)
    w, h = start_factors(v, k, seed, row_ids, col_ids)
    w, h = cut_lineage(w), cut_lineage(h)
    sq = mx.squared_norm(v)
    wtv = mx.transpose_times(v, w, k).cache()
    wtw, hht = mx.gram(w, k), mx.gram(h, k)
    err = mx.frobenius_error(sq, wtv, h, wtw, hht)
    errors, it = [err], 0
    while it < max_iterations:
        it += 1
        h_new = cut_lineage(update_h(h, wtv, wtw))
        hht = mx.gram(h_new, k)
        vht = mx.multiply_by_columns(v, h_new, k)
        w_new = cut_lineage(update_w(w, vht, hht))
        wtv.unpersist()
        w, h = w_new, h_new
        wtv = mx.transpose_times(v, w, k).cache()
        wtw = mx.gram(w, k)
        new_err = mx.frobenius_error(sq, wtv, h, wtw, hht)
        errors.append(new_err)
        change, err = abs(err - new_err), new_err
        if change <= tol:
            break
    wtv.unpersist()
    return NMFResult(w=w, h=h, errors=errors, iterations=it)


def one_round(v_long: DataFrame, w: DataFrame, h: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """One H update then one W update (M9 + M10), without checkpoints (for tests/queries)."""
    wtv = mx.transpose_times(v_long, w, k)
    h1 = update_h(h, wtv, mx.gram(w, k))
    w1 = update_w(w, mx.multiply_by_columns(v_long, h1, k), mx.gram(h1, k))
    return h1, w1


def assign_clusters(w: DataFrame) -> DataFrame:
    """cluster = index of the largest W component (first wins on ties)."""
    return w.select("row_id", argmax(F.col("vec")).alias("cluster"))


# --------------------------------------------------------------------------
# Default plan: static blocks of V, H broadcast, W computed where it is needed.
# --------------------------------------------------------------------------

#: Entries packed into one block, at most (a row with more is a block of its own).
BLOCK_ENTRIES = 1 << 17
BLOCK_SCHEMA = "ids binary, lens binary, cols binary, vals binary"
#: A block is multiplied as a dense matrix if at least this share of it is entries; otherwise entry by entry.
DENSE_SHARE = 0.2
#: Multiplicative rounds before the exact ones.
PLAIN_ROUNDS = 10
#: Rounds from which the next H is extrapolated.
MEMORY = 6


def init_matrix(ids: np.ndarray, k: int, salt: int) -> np.ndarray:
    """``init_value`` for a vector of ids in exact int64 arithmetic (same numbers as the Column)."""
    ids = ids.astype(np.int64)
    out = np.empty((len(ids), k))
    for j in range(k):
        x = (ids * LCG_MULT + (j * LCG_STEP + salt)) % LCG_MOD
        out[:, j] = (x + 1).astype(np.float64) / float(LCG_MOD + 1)
    return out


@dataclass
class Block:
    """Whole rows of V: their ids, and per entry the row's place, the column and the value."""
    ids: np.ndarray
    owner: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    dense: np.ndarray | None = None

    def matrix(self, n_cols: int) -> np.ndarray | None:
        """The block as a dense matrix, made once, if it is well filled."""
        if self.dense is None and len(self.vals) >= DENSE_SHARE * len(self.ids) * n_cols:
            self.dense = np.bincount(self.owner * n_cols + self.cols, self.vals, len(self.ids) * n_cols).reshape(-1, n_cols)
        return self.dense

    def times(self, h: np.ndarray) -> np.ndarray:
        """V H: one row per row of the block."""
        dense = self.matrix(len(h))
        if dense is not None:
            return dense @ h
        return np.column_stack([np.bincount(self.owner, self.vals * h[self.cols, j], len(self.ids))
                                for j in range(h.shape[1])])

    def transpose_times(self, w: np.ndarray, n_cols: int) -> np.ndarray:
        dense = self.matrix(n_cols)
        if dense is not None:
            return dense.T @ w
        return np.column_stack([np.bincount(self.cols, self.vals * w[self.owner, j], n_cols)
                                for j in range(w.shape[1])])


def _pack_rows(batches: Iterator[pa.RecordBatch], block_entries: int) -> Iterator[pa.RecordBatch]:
    """Entries sorted by row to blocks of whole rows; an entry without a column only names its row."""
    def packed(row, col, val):
        ids, lens = np.unique(row, return_counts=True)
        there = col >= 0
        lens = lens - np.bincount(np.searchsorted(ids, row[~there]), minlength=len(ids))
        arrays = (ids, lens.astype(np.int64), col[there], val[there])
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays],
                                          names=["ids", "lens", "cols", "vals"])

    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    for batch in batches:
        new = [batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False),
               batch.column(2).fill_null(0.0).to_numpy(zero_copy_only=False)]
        held = [np.concatenate(x) for x in zip(held, new, strict=True)]
        while len(held[0]) > block_entries:
            cut = np.searchsorted(held[0], held[0][block_entries])   # where the row that crosses the end begins
            if cut == 0:
                cut = np.searchsorted(held[0], held[0][0], side="right")
                if cut == len(held[0]):
                    break
            yield packed(*[x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield packed(*held)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids, lens, cols, vals = (np.frombuffer(batch.column(i)[at].as_buffer(), kind) for i, kind in
                                     enumerate((np.int64, np.int64, np.int64, np.float64)))
            yield Block(ids, np.repeat(np.arange(len(ids)), lens), cols, vals)


def lay_out(v: DataFrame, n_entries: int, row_ids: DataFrame | None = None, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """V as blocks (ids, lens, cols, vals) in the shared folder, dealt by row id.

    ``row_ids`` adds rows without entries. The number of partitions follows from the entries alone."""
    entries = v.select(F.col("row_id").cast("long"), F.col("col_id").cast("long"), F.col("value").cast("double"))
    if row_ids is not None:
        entries = entries.unionByName(row_ids.select(
            F.col("row_id").cast("long"), F.lit(None).cast("long").alias("col_id"), F.lit(None).cast("double").alias("value")))
    path = scratch_path(v.sparkSession, "nmf_blocks")
    dealt = entries.repartition(partitions_for(n_entries), "row_id").sortWithinPartitions("row_id", "col_id")
    dealt.mapInArrow(lambda batches: _pack_rows(batches, block_entries), BLOCK_SCHEMA).write.parquet(path)
    return v.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


def _pack_arrays(batches: Iterator[pa.RecordBatch], block_entries: int) -> Iterator[pa.RecordBatch]:
    """Rows (row_id, ids, vals) to blocks of as many whole rows as hold ``block_entries`` entries, or one row."""
    for batch in batches:
        lens = np.diff(batch.column(1).offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(lens)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + block_entries, side="right")) - 1)
            part = batch.slice(at, to - at)
            arrays = (part.column(0).to_numpy().astype(np.int64), lens[at:to].astype(np.int64),
                      part.column(1).flatten().to_numpy().astype(np.int64), part.column(2).flatten().to_numpy().astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays],
                                             names=["ids", "lens", "cols", "vals"])
            at = to


def lay_out_rows(rows: DataFrame, n_entries: int, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``lay_out`` of rows (row_id, ids, vals) with sorted ids: whole rows are dealt, not their entries."""
    path = scratch_path(rows.sparkSession, "nmf_blocks")
    dealt = rows.select(F.col("row_id").cast("long"), F.col("ids").cast("array<long>"), F.col("vals").cast("array<double>")).repartition(
        partitions_for(n_entries), "row_id").sortWithinPartitions("row_id")
    dealt.mapInArrow(lambda batches: _pack_arrays(batches, block_entries), BLOCK_SCHEMA).write.parquet(path)
    return rows.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


def least_squares(products: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Rows x >= 0 that minimise x G xᵀ / 2 - b x, for a row b of ``products`` each (block principal pivoting).

    Rows are solved together by the set of their positive components. A row whose
    exchanges stop helping changes one component at a time, which ends."""
    n, k = products.shape
    gram = gram + np.eye(k) * (1e-14 * np.trace(gram) + np.finfo(float).tiny)
    x, slope = np.zeros((n, k)), -products
    positive = np.zeros((n, k), bool)
    tries, fewest = np.full(n, 3), np.full(n, k + 1)
    noise = 1e-12 * np.abs(products).max(axis=1, initial=0.0)[:, None]
    power = 1 << np.arange(k)
    for _ in range(100 * k):   # far beyond what exchanges take; what rounding keeps exchanging is about 0
        wrong = np.where(positive, x < 0, slope < -noise)
        count = wrong.sum(axis=1)
        rows = np.flatnonzero(count)
        if not len(rows):
            return x
        better = count[rows] < fewest[rows]
        fewest[rows] = np.minimum(fewest[rows], count[rows])
        single = ~better & (tries[rows] <= 0)
        tries[rows] = np.where(better, 3, tries[rows] - 1)
        change = wrong[rows]
        last = k - 1 - change[:, ::-1].argmax(axis=1)
        change[single] = np.arange(k) == last[single, None]
        positive[rows] ^= change
        codes = positive[rows] @ power
        for code in np.unique(codes):
            same = rows[codes == code]
            on = positive[same[0]]
            solved = np.zeros((len(same), k))
            if on.any():
                solved[:, on] = np.linalg.solve(gram[np.ix_(on, on)], products[np.ix_(same, on)].T).T
            x[same], slope[same] = solved, np.where(on, 0.0, solved @ gram - products[same])
    return np.maximum(x, 0.0)


@dataclass
class Weights:
    """How the W of a block follows from broadcast factors H: by replayed multiplicative updates, or exactly."""
    k: int
    seed: int
    replayed: list[Broadcast] = field(default_factory=list)
    exact: Broadcast | None = None

    def of(self, block: Block) -> np.ndarray:
        if self.exact is not None:
            h = self.exact.value
            return least_squares(block.times(h), h.T @ h)
        w = init_matrix(block.ids, self.k, self.seed)
        for shared in self.replayed:
            h = shared.value
            w = w * block.times(h) / (w @ (h.T @ h) + EPS)
        return w


def round_products(blocks: DataFrame, weights: Weights, n_cols: int) -> tuple[np.ndarray, np.ndarray]:
    """Wᵀ V (n_cols x k) and Wᵀ W (k x k) in one pass over the blocks and one job.

    Entry (c, j) of Wᵀ V has index c * k + j, entry (a, b) of Wᵀ W n_cols * k + a * k + b."""
    k = weights.k

    def partial(batches):
        wtv, wtw = np.zeros((n_cols, k)), np.zeros((k, k))
        for block in _unpack(batches):
            w = weights.of(block)
            wtv += block.transpose_times(w, n_cols)
            wtw += w.T @ w
        flat = np.concatenate([wtv.ravel(), wtw.ravel()])
        idx = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array([idx], pa.list_(pa.int64())), pa.array([flat[idx]], pa.list_(pa.float64()))],
                                         names=["idx", "val"])

    flat = mx.sum_partials(blocks.mapInArrow(partial, "idx array<long>, val array<double>"), (n_cols + k) * k, blocks)
    return flat[: n_cols * k].reshape(n_cols, k), flat[n_cols * k:].reshape(k, k)


def row_factor(blocks: DataFrame, weights: Weights) -> DataFrame:
    """(row_id, vec): the W of all rows."""
    def rows(batches):
        for block in _unpack(batches):
            w = weights.of(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids), pa.ListArray.from_arrays(
                    np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel()))], names=["row_id", "vec"])

    return blocks.mapInArrow(rows, "row_id long, vec array<double>")


def _error(sq: float, h: np.ndarray, wtv: np.ndarray, wtw: np.ndarray) -> float:
    return float(sq - 2.0 * np.sum(h * wtv) + np.sum(wtw * (h.T @ h)))


def extrapolated(tried: list[np.ndarray], reached: list[np.ndarray]) -> np.ndarray:
    """The next H to try: the mix of the last rounds' results whose changes cancel best (Anderson's), made non-negative."""
    if len(tried) < 2:
        return reached[-1]
    change = np.array([(r - t).ravel() for t, r in zip(tried, reached, strict=True)]).T
    ends = np.array([r.ravel() for r in reached]).T
    mix = np.linalg.lstsq(np.diff(change), change[:, -1], rcond=1e-10)[0]
    return np.maximum(ends[:, -1] - np.diff(ends) @ mix, 0.0).reshape(reached[-1].shape)


def _unit_columns(h: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(h, axis=0)
    return h / np.where(size > 0, size, 1.0)


def run(v_long: DataFrame, k: int, max_iterations: int = 100, tol: float = 1e-4, seed: int = 8803,
        row_ids: DataFrame | None = None, n_cols: int | None = None, plain_rounds: int = PLAIN_ROUNDS) -> NMFResult:
    """M7: NMF of V = (row_id, col_id, value) with dense col ids 0..n_cols-1.

    Stop rule: the error changes by no more than ``tol`` (absolutely) in a
    round, or ``max_iterations`` passes over V are done. A relative rule would end on
    the first plateau, long before the factors settle. ``errors`` holds the start's
    error and that of each round that lowered it.
    """
    v = v_long.select("row_id", "col_id", F.col("value").cast("double"))
    facts = v.agg(F.count("*").alias("n"), F.max("col_id").alias("last"), F.sum(F.col("value") * F.col("value")).alias("sq")).first()
    n_cols = int(facts["last"]) + 1 if n_cols is None else n_cols
    return factorise(lay_out(v, facts["n"], row_ids), facts["sq"] or 0.0, n_cols, k, max_iterations, tol, seed, plain_rounds)


def factorise(blocks: DataFrame, sq: float, n_cols: int, k: int, max_iterations: int = 100, tol: float = 1e-4, seed: int = 8803,
              plain_rounds: int = PLAIN_ROUNDS) -> NMFResult:
    """``run`` on V as it was laid out, with the sum ``sq`` of its squares."""
    spark = blocks.sparkSession
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    share = spark.sparkContext.broadcast
    start = Weights(k, seed)
    h = init_matrix(np.arange(n_cols), k, seed + H_SALT)
    wtv, wtw = round_products(blocks, start, n_cols)
    errors, it, plain = [_error(sq, h, wtv, wtw)], 0, Weights(k, seed)
    best, settled = plain, False
    while it < max_iterations and not settled:
        while it < max_iterations and len(plain.replayed) < plain_rounds and not settled:
            it += 1
            h = h * wtv / (h @ wtw + mx.EPS)
            plain.replayed.append(share(h))
            wtv, wtw = round_products(blocks, plain, n_cols)
            errors.append(_error(sq, h, wtv, wtw))
            settled = abs(errors[-2] - errors[-1]) <= tol
        best = plain
        if settled or it >= max_iterations:
            break
        used, h_exact, exact_errors, emptied, settled = _exact_rounds(
            blocks, sq, h, errors[-1], k, seed, n_cols, max_iterations - it, tol,
            may_empty=2 * len(plain.replayed) >= max_iterations)
        it += used
        if emptied:
            plain_rounds *= 2
        else:
            errors += exact_errors
            if exact_errors:
                best, h = Weights(k, seed, exact=share(h_exact)), h_exact
            break
    if best.exact is not None:
        for unused in plain.replayed:
            unused.unpersist()
    blocks.unpersist()   # W, read once or twice, comes from the written blocks
    w_df = row_factor(blocks, best)
    h_df = spark.createDataFrame([(i, [float(x) for x in h[i]]) for i in range(n_cols)],
                                 "col_id long, vec array<double>")   # k x features model
    return NMFResult(w=w_df, h=h_df, errors=errors, iterations=it)


def _exact_rounds(blocks: DataFrame, sq: float, h: np.ndarray, error: float, k: int, seed: int, n_cols: int,
                  rounds: int, tol: float, may_empty: bool) -> tuple[int, np.ndarray, list[float], bool, bool]:
    """(rounds used, H, errors, a component was emptied, settled): exact minimisation from H on.

    A round solves W for the H tried and H for that W. Columns of H have length 1, W takes their size."""
    share = blocks.sparkSession.sparkContext.broadcast
    alive = np.linalg.norm(h, axis=0) > 0
    reached = _unit_columns(h)
    attempt, errors, tried, ends = reached, [], [], []
    for used in range(1, rounds + 1):
        shared = share(attempt)
        wtv, wtw = round_products(blocks, Weights(k, seed, exact=shared), n_cols)
        shared.unpersist()
        solved = least_squares(wtv, wtw)
        if not may_empty and (alive & (np.linalg.norm(solved, axis=0) == 0)).any():
            return used, reached, errors, True, False
        now = _error(sq, solved, wtv, wtw)
        if now > error and attempt is not reached:   # the extrapolation went too far
            attempt, tried, ends = reached, [], []
            continue
        tried, ends = [*tried, attempt][-MEMORY:], [*ends, _unit_columns(solved)][-MEMORY:]
        reached, change, error = ends[-1], error - now, now
        errors.append(now)
        if change <= tol:
            return used, reached, errors, False, True
        attempt = extrapolated(tried, ends)
    return rounds, reached, errors, False, False
