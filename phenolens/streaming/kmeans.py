"""Streaming k-means on Structured Streaming.

Model: k centres with weights. For each micro-batch (decay a):

    m_i  = rows of the batch closest to centre i,  S_i = their sum
    c_i' = (c_i * n_i * a + S_i) / (n_i * a + m_i)      n_i' = n_i * a + m_i

(a centre with no rows keeps its position; its weight still decays).

Execution: ``readStream`` -> ``foreachBatch``. Per batch the rows are
assigned with a literal-centre expression (no join), the per-(cluster, dim)
sums are partial aggregates (k * dim numbers reach the driver). A batch with more
than ``max_rows`` rows is taken in parts, dealt by a hash of the rows' key, so what
one update takes is bounded however many files have come in.

After each part the new state is written to a folder of its own and committed by
renaming it to a version; the newest versions stay, older ones are deleted. A
restarted driver resumes from the newest version: what was written but not
committed is done again, what was committed is skipped, so every part is applied
exactly once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolens.operators.clustering import nearest_center
from phenolens.operators.nmf import init_value
from phenolens.session import scratch_path

# FIXED VALUES of the streaming model: k, decay, dimension, start weight, seed.
K = 3
DECAY = 1.0
DIM = 10
START_WEIGHT = 100.0
SEED = 8803

STATE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("center", T.ArrayType(T.DoubleType()), False),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("done", T.IntegerType(), False),
])
#: Versions of the state that stay: the newest, and one more for a reader that has just listed them.
VERSIONS = 2


@dataclass
class KMeansState:
    centers: list[list[float]]
    weights: list[float]
    batch_id: int = -1   # the batch that was last applied, or begun
    done: int = 0        # how many of its parts have been applied


def center_value(cluster: Column, dim: Column, seed: int) -> Column:
    """R1 as an expression: start coordinate in (-1, 1] from arithmetic on (cluster, dim)."""
    return F.lit(2.0) * init_value(cluster * F.lit(1_000_003) + dim, 0, seed) - F.lit(1.0)


def random_centers(spark: SparkSession, k: int = K, dim: int = DIM, weight: float = START_WEIGHT,
                   seed: int = SEED) -> KMeansState:
    """K deterministic pseudo-random centres (k * dim numbers) with a start weight."""
    grid = (spark.range(k).withColumnRenamed("id", "cluster")
            .select("cluster", F.posexplode(F.array_repeat(F.lit(0), dim)).alias("dim", "_z"))
            .select("cluster", "dim", center_value(F.col("cluster"), F.col("dim"), seed).alias("v")))
    rows = grid.collect()
    centers = [[0.0] * dim for _ in range(k)]
    for r in rows:
        centers[r["cluster"]][r["dim"]] = float(r["v"])
    return KMeansState(centers=centers, weights=[float(weight)] * k)


def batch_sums(batch: DataFrame, features_col: str, centers: list[list[float]]) -> DataFrame:
    """Per (cluster, dim): sum of coordinates, and per cluster the row count (dim 0)."""
    assigned = batch.select(nearest_center(F.col(features_col), centers).alias("cluster"),
                            F.posexplode(features_col).alias("dim", "x"))
    return assigned.groupBy("cluster", "dim").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("m"))


def center_update(batch: DataFrame, features_col: str, state: KMeansState, decay: float = DECAY) -> DataFrame:
    """R3 as a DataFrame: (cluster, dim, value, weight) of the updated model.

    Clusters that receive no rows keep their centre (weight decays).
    """
    k, dim = len(state.centers), len(state.centers[0])
    sums = batch_sums(batch, features_col, state.centers)
    grid = (batch.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
            .select("cluster", F.posexplode(F.array_repeat(F.lit(0), dim)).alias("dim", "_z"))
            .drop("_z"))
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in state.centers])
    weights = F.array(*[F.lit(float(w)) for w in state.weights])
    j = grid.join(F.broadcast(sums), ["cluster", "dim"], "left")   # k*dim rows: bounded by the model size
    c = F.element_at(F.element_at(centers, F.col("cluster") + 1), F.col("dim") + 1)
    n = F.element_at(weights, F.col("cluster") + 1) * F.lit(float(decay))
    m = F.coalesce(F.col("m"), F.lit(0)).cast("double")
    s = F.coalesce(F.col("s"), F.lit(0.0))
    value = F.when(m > 0, (c * n + s) / (n + m)).otherwise(c)
    # every dim of a cluster sees the same count, so the weight is the same on each row
    m_cluster = F.max(m).over(Window.partitionBy("cluster"))
    return j.select("cluster", "dim", value.alias("value"), (n + m_cluster).alias("weight"))


def apply_update(batch: DataFrame, features_col: str, state: KMeansState, decay: float,
                 batch_id: int, done: int = 1) -> KMeansState:
    rows = batch_sums(batch, features_col, state.centers).collect()   # <= k * dim rows
    k, dim = len(state.centers), len(state.centers[0])
    sums = [[0.0] * dim for _ in range(k)]
    counts = [0] * k
    for r in rows:
        sums[r["cluster"]][r["dim"]] = float(r["s"])
        if r["dim"] == 0:
            counts[r["cluster"]] = int(r["m"])
    centers, weights = [], []
    for i in range(k):
        n = state.weights[i] * decay
        m = counts[i]
        if m > 0:
            centers.append([(state.centers[i][d] * n + sums[i][d]) / (n + m) for d in range(dim)])
        else:
            centers.append(list(state.centers[i]))
        weights.append(n + m)
    return KMeansState(centers=centers, weights=weights, batch_id=batch_id, done=done)


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a way to name paths on it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions under ``path``, the oldest first."""
    fs, name = _files(spark, path)
    if not fs.exists(name(path)):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(name(path))) if n.startswith("v"))


def write_state(spark: SparkSession, state: KMeansState, path: str) -> str:
    """Write the state to a folder that no reader looks at; returns it."""
    rows = [(state.batch_id, i, [float(x) for x in c], float(w), state.done)
            for i, (c, w) in enumerate(zip(state.centers, state.weights))]
    written = f"{path}/tmp-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.parquet(written)
    return written


def commit_state(spark: SparkSession, state: KMeansState, path: str, written: str) -> None:
    """Make a written state the newest version by renaming it, and delete what is older than the newest versions.

    Also folders that were written and never committed are deleted: only one driver works on a path."""
    fs, name = _files(spark, path)
    version = f"v{state.batch_id + 1:012d}-{state.done:09d}"
    if not fs.rename(name(written), name(f"{path}/{version}")):
        raise OSError(f"{written} can't be renamed to {version}")
    keep = set(versions(spark, path)[-VERSIONS:])
    for status in fs.listStatus(name(path)):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def read_latest_state(spark: SparkSession, path: str) -> KMeansState | None:
    found = versions(spark, path)
    if not found:
        return None
    rows = spark.read.schema(STATE_SCHEMA).parquet(f"{path}/{found[-1]}").orderBy("cluster").collect()   # k rows
    return KMeansState(centers=[list(r["center"]) for r in rows], weights=[r["weight"] for r in rows],
                       batch_id=rows[0]["batch_id"], done=rows[0]["done"])


def run_stream(spark: SparkSession, source_path: str, schema: T.StructType, features_col: str,
               start: KMeansState, decay: float = DECAY, work_path: str | None = None,
               max_rows: int | None = None, key_col: str | None = None) -> KMeansState:
    """Train on the files under ``source_path`` that the stream hasn't seen, as one micro-batch.

    With ``max_rows`` the batch is applied in as few parts as hold that many rows on average; a row's part follows
    from the hash of ``key_col`` (the first column if not given). ``work_path`` (default: a fresh folder under
    the shared checkpoint dir) holds the stream checkpoint and the versions of the state; pass the same
    path again for the next files, or to resume after a failure.
    """
    work = work_path or scratch_path(spark, "streaming-kmeans")
    state_path = f"{work}/state"
    current = read_latest_state(spark, state_path)
    if current is None:
        current = start
        commit_state(spark, current, state_path, write_state(spark, current, state_path))
    holder = {"state": current}
    key = F.col(key_col or schema.names[0])

    def on_batch(df: DataFrame, batch_id: int) -> None:
        state = holder["state"]
        parts = 1
        if max_rows:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            parts = max(1, -(-df.count() // max_rows))
        applied = parts if batch_id < state.batch_id else state.done if batch_id == state.batch_id else 0
        for part in range(applied, parts):   # a replayed batch goes on where it was committed
            own = df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part) if parts > 1 else df
            state = apply_update(own, features_col, state, decay, batch_id, part + 1)
            commit_state(df.sparkSession, state, state_path, write_state(df.sparkSession, state, state_path))
            holder["state"] = state
        if max_rows:
            df.unpersist()

    q = (spark.readStream.schema(schema).parquet(source_path).writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", f"{work}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return holder["state"]


def replay(df: DataFrame, batch: Column, n_batches: int, schema: T.StructType, features_col: str,
           start: KMeansState, decay: float = DECAY) -> KMeansState:
    """Replay a table as a stream of ``n_batches`` micro-batches, numbered by the column ``batch``.

    The rows of a batch, in as many files as their size asks for, are given to the
    stream only after it has taken the batch before: the order, on which the model
    depends, follows from the keys and not from file times."""
    spark = df.sparkSession
    source, work = scratch_path(spark, "stream-source"), scratch_path(spark, "streaming-kmeans")
    state = start
    for number in range(n_batches):
        df.where(batch == number).select(*schema.names).write.mode("append").parquet(source)
        state = run_stream(spark, source, schema, features_col, start, decay, work)
    return state


def assign(df: DataFrame, features_col: str, state: KMeansState) -> DataFrame:
    """Predict with the latest model: adds ``cluster``."""
    return df.withColumn("cluster", nearest_center(F.col(features_col), state.centers))


__all__ = ["KMeansState", "random_centers", "center_update", "apply_update", "run_stream",
           "replay", "assign", "read_latest_state", "versions", "batch_sums"]
