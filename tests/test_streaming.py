"""Streaming k-means: update rule, replay idempotence, driver-table run."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolens.session import scratch_path
from phenolens.streaming import kmeans as sk

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])


def points(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], SCHEMA)


def test_zero_weight_decay_one_equals_batch_means(spark):
    # fixed assignment: two well separated groups; start weight 0 -> centre = mean of all rows seen
    rows = [[0, 0], [0, 2], [10, 10], [12, 10], [0, 1], [11, 13]]
    df = points(spark, rows)
    start = sk.KMeansState(centers=[[0.0, 0.0], [10.0, 10.0]], weights=[0.0, 0.0])
    state = sk.replay(df, F.col("id") % 3, 3, SCHEMA, "x", start, decay=1.0)
    a = np.array([r for r in rows if r[0] < 5]).mean(axis=0)
    b = np.array([r for r in rows if r[0] >= 5]).mean(axis=0)
    assert np.allclose(state.centers[0], a) and np.allclose(state.centers[1], b)
    assert state.weights == [3.0, 3.0]


def test_replay_is_idempotent(spark):
    df = points(spark, [[0, 0], [4, 4]])
    src = scratch_path(spark, "source")
    df.write.parquet(src)
    work = scratch_path(spark, "replay")
    start = sk.KMeansState(centers=[[1.0, 1.0], [5.0, 5.0]], weights=[1.0, 1.0])
    s1 = sk.run_stream(spark, src, SCHEMA, "x", start, work_path=work)
    s2 = sk.run_stream(spark, src, SCHEMA, "x", start, work_path=work)   # resumes: nothing new
    assert s1.centers == s2.centers and s1.weights == s2.weights
    stored = sk.read_latest_state(spark, f"{work}/state")
    assert stored.centers == s1.centers


def test_same_model_every_time(spark):
    rng = np.random.default_rng(4)
    df = points(spark, rng.normal(size=(400, 3)).tolist())
    start = sk.random_centers(spark, 3, 3, 1.0, 1)
    seen = []
    for parts, shuffles in ((1, "8"), (7, "32"), (3, "8")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        seen.append(sk.replay(df.repartition(parts), (F.col("id") % 4).cast("int"), 4, SCHEMA, "x", start, 0.9))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for s in seen[1:]:
        assert np.allclose(s.centers, seen[0].centers, atol=1e-12) and s.weights == seen[0].weights


def test_center_update_frame_matches_driver_update(spark):
    df = points(spark, [[0, 0], [0, 2], [9, 9], [-1, 5]])
    st = sk.KMeansState(centers=[[0.0, 1.0], [10.0, 10.0], [100.0, 100.0]], weights=[2.0, 1.0, 5.0])
    frame = {(r["cluster"], r["dim"]): (r["value"], r["weight"])
             for r in sk.center_update(df, "x", st, decay=0.5).collect()}
    new = sk.apply_update(df, "x", st, 0.5, batch_id=0)
    for c in range(3):
        for d in range(2):
            assert abs(frame[(c, d)][0] - new.centers[c][d]) < 1e-12
            assert abs(frame[(c, d)][1] - new.weights[c]) < 1e-12
    assert new.centers[2] == [100.0, 100.0] and new.weights[2] == 2.5   # empty cluster keeps its centre


def test_random_centers_deterministic(spark):
    a = sk.random_centers(spark, 3, 10, 100.0, 8803)
    b = sk.random_centers(spark, 3, 10, 100.0, 8803)
    assert a.centers == b.centers and len(a.centers) == 3 and len(a.centers[0]) == 10
    assert all(-1 <= x <= 1 for c in a.centers for x in c)
    assign = sk.assign(points(spark, [[0] * 10]), "x", a).select("cluster").first()[0]
    assert assign in (0, 1, 2)


def test_killed_between_write_and_commit(spark, monkeypatch):
    """The driver dies after a part's state is written, before it is committed: it goes on with the same part."""
    rng = np.random.default_rng(9)
    df = points(spark, rng.normal(size=(300, 2)).tolist())
    src = scratch_path(spark, "source")
    df.repartition(5).write.parquet(src)
    start = sk.KMeansState(centers=[[1.0, 1.0], [-1.0, -1.0]], weights=[1.0, 1.0])
    whole = sk.run_stream(spark, src, SCHEMA, "x", start, 0.7, scratch_path(spark, "whole"), max_rows=50)
    assert whole.done == 6
    work, real, calls = scratch_path(spark, "killed"), sk.commit_state, []

    def dies(session, state, path, written):
        calls.append(state.done)
        if len(calls) == 4:
            raise RuntimeError("killed")
        real(session, state, path, written)

    monkeypatch.setattr(sk, "commit_state", dies)
    with pytest.raises(Exception, match="killed"):
        sk.run_stream(spark, src, SCHEMA, "x", start, 0.7, work, max_rows=50)
    monkeypatch.setattr(sk, "commit_state", real)
    assert sk.read_latest_state(spark, f"{work}/state").done == 2
    again = sk.run_stream(spark, src, SCHEMA, "x", start, 0.7, work, max_rows=50)
    assert np.allclose(again.centers, whole.centers, atol=1e-12) and again.weights == whole.weights
    assert len(sk.versions(spark, f"{work}/state")) == sk.VERSIONS
    assert len(os.listdir(f"{work.removeprefix('file:')}/state")) == sk.VERSIONS    # nothing uncommitted stays


def test_number_of_state_files_is_bounded(spark):
    df = points(spark, [[i % 7, i % 5] for i in range(60)])
    src, work = scratch_path(spark, "source"), scratch_path(spark, "bounded")
    start, counts = sk.KMeansState(centers=[[1.0, 1.0], [5.0, 5.0]], weights=[1.0, 1.0]), []
    for i in range(4):
        df.where(F.col("id") % 4 == i).write.mode("append").parquet(src)
        state = sk.run_stream(spark, src, SCHEMA, "x", start, work_path=work)
        counts.append(sum(len(f) for _, _, f in os.walk(f"{work.removeprefix('file:')}/state")))
    assert state.batch_id == 3 and sum(state.weights) == 62 and counts[-1] == counts[1]
