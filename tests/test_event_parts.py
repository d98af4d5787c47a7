"""The event log and the feature rows are dealt by their size, with the same rows as ever."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenolens.operators import nmf
from phenolens.operators.summary import event_summary
from phenolens.plans import evaluation as ev
from phenolens.session import partitions_for
from phenolens.sources import starschema as ss

STAMP = dt.datetime(2020, 1, 1)


def write_tables(spark, path, lines):
    """``lines``: order keys of the rows of lineitem; order i belongs to patient i % 7, every second patient has a lab."""
    def keep(rows, schema, name):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    keep([(i, i % 5, i % 3, STAMP) for i in lines],
         "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz", "lineitem")
    keep([(i, i % 7, STAMP) for i in sorted({i for i in lines if i is not None})] + [(None, 1, STAMP), (10_000, None, STAMP)],
         "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", "orders")
    keep([(p, STAMP, "click", float(p)) for p in range(0, 7, 2)] + [(None, STAMP, "view", 1.0)],
         "user_id long, ts timestamp_ntz, event_type string, value double", "events")
    return str(path)


@pytest.mark.parametrize("heavy", [False, True])
def test_event_log_is_dealt_by_its_rows(spark, tmp_path, monkeypatch, heavy):
    lines = [i // 4 for i in range(200)] + [3] * (300 if heavy else 3)
    path = write_tables(spark, tmp_path / "t", lines)
    before = sorted(map(str, event_summary(ss.clinical_event_log(spark, path)).collect()))
    assert ss.event_partitions(spark, path) == 1
    monkeypatch.setattr(ss, "PART_ROWS", 20)
    parts = ss.event_partitions(spark, path)
    assert parts == -(-len(lines) // 20) > spark.sparkContext.defaultParallelism
    log = ss.events_by_patient(spark, path)
    assert sorted(map(str, event_summary(log).collect())) == before
    assert ss._dealt(spark, path) is not heavy and log.count() == 2 * len(lines) + 4


def test_aggregate_after_dealing_needs_no_exchange(spark, tmp_path, monkeypatch):
    path = write_tables(spark, tmp_path / "t", [i // 4 for i in range(200)])
    monkeypatch.setattr(ss, "PART_ROWS", 60)
    plan = event_summary(ss.events_by_patient(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3 and "ENSURE_REQUIREMENTS" not in plan


def test_large_matrices_have_few_partitions():
    """A pass of a fit pays for each task's start: 300 million entries take hundreds of tasks at most."""
    assert partitions_for(0) == 1 and partitions_for(500_000) == 5
    assert partitions_for(50_000_000) == 64 and partitions_for(300_000_000) == 150


def test_a_filled_block_is_multiplied_as_a_matrix():
    rng = np.random.default_rng(5)
    h, w = rng.random((6, 3)), rng.random((4, 3))
    for share in (0.05, 0.9):   # of the entries that are there
        v = rng.random((4, 6)) * (rng.random((4, 6)) < share)
        v[0, 0] = 1.0
        owner, cols = np.nonzero(v)
        block = nmf.Block(np.arange(4), owner, cols, v[owner, cols])
        assert (block.matrix(6) is not None) == (len(owner) >= nmf.DENSE_SHARE * 24)
        assert np.allclose(block.times(h), v @ h) and np.allclose(block.transpose_times(w, 6), v.T @ w)


def test_rows_are_laid_out_whole(spark):
    """Blocks of rows are those of their entries, and the factors follow from them alike."""
    tuples = spark.createDataFrame([(f"p{i}", "dx", f"D{j}", float((i * j) % 5 - 2)) for i in range(20) for j in range(1, 6)
                                    if (i + j) % 3], "patient_id string, domain string, feature string, value double")
    inputs = ev.feature_inputs(tuples)
    assert inputs.n_entries == tuples.count() == inputs.long.count() and inputs.rows.count() == 20
    v, rid = ev.nmf_input(inputs)
    rows = v.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("col_id", "value"))).alias("e")).select(
        "row_id", F.col("e.col_id").alias("ids"), F.col("e.value").alias("vals"))
    one, two = (sorted(tuple(bytes(x) for x in r) for r in b.collect())
                for b in (nmf.lay_out(v, inputs.n_entries), nmf.lay_out_rows(rows, inputs.n_entries)))
    assert one == two
    assert nmf.lay_out_rows(rows, inputs.n_entries, block_entries=3).count() == 20   # of 3 or 4 entries: each its own
    res, _ = ev.nmf_fit(inputs, 2, 12, 0.0)
    plain = nmf.run(v, 2, 12, 0.0, row_ids=rid.select("row_id"), n_cols=inputs.n_features)
    assert np.allclose(res.errors, plain.errors)
    inputs.release()
