"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder used to cut lineage in iterative operators.

On a cluster the caller owns the session; nothing here overrides settings
that are already present. The only thing we ever *set* on an existing
session is the checkpoint folder, and only when the session has none and
runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "phenolens") -> SparkSession:
    """Session for tests and the bench (``local[cores]``).

    AQE stays on so shuffle partitions are coalesced / skewed joins split at
    run time; the UI is off (no server); time zone pinned to UTC so parsed
    offsets land on the same wall clock everywhere.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PHENOLENS_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` (or an already-set context folder).
    If unset: in local mode create a scratch folder (tests); on a cluster
    refuse, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if re.fullmatch(r"local(\[.*\])?", sc.master) is None:  # local-cluster is a cluster
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) visible to every executor")
        conf = tempfile.mkdtemp(prefix="phenolens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Persist (memory, spilling to disk) and compute once, for a result read by
    several later jobs. Lineage stays (fixed length), so a lost block is
    recomputed; iterative loops use ``cut_lineage`` instead. The caller
    unpersists."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


#: Entries of a partition while there are few partitions, the most partitions of that size, and entries of larger ones.
SMALL_PARTITION, SMALL_PARTITIONS, LARGE_PARTITION = 100_000, 64, 2_000_000


def partitions_for(entries: int) -> int:
    """Partitions for a matrix of so many entries: from the data alone, so that
    what is fitted on them is the same on any number of cores. Partitions stay
    small (short tasks for every core) until there are enough for a few executors, and grow then
    to a bounded size: a pass of an iterative fit pays for each task's start."""
    return max(1, min(-(-entries // SMALL_PARTITION), max(SMALL_PARTITIONS, -(-entries // LARGE_PARTITION))))


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local one).

    The input is persisted first so the checkpoint write (a second job that
    Spark runs after the materialising one) reads the cached blocks instead
    of recomputing the plan; the cache is released once the files exist.
    """
    checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
