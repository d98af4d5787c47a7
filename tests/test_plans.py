"""Physical-plan properties the design relies on (pruning, one join, one shuffle)."""
from phenolens.operators import phenotype as ph
from phenolens.sources import starschema as ss

from conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_log_prunes_columns_and_joins_once(spark):
    plan = _plan(ss.clinical_event_log(spark, SF["0.001"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert plan.count("orders.parquet") == 1           # diagnoses and drugs share ONE lineitem-orders join


def test_labelling_is_one_partial_aggregate_and_one_exchange_on_patient(spark):
    df = ph.label_events(ss.clinical_event_log(spark, SF["0.001"]))
    plan = _plan(df)
    assert "partial_max" in plan and "partial_min" in plan
    assert plan.count("hashpartitioning(patient_id") == 1


def test_report_reads_the_events_once(spark):
    from phenolens.operators import features as fe
    from phenolens.operators.summary import as_events, as_tuples, event_summary
    from phenolens.session import materialize
    from phenolens.sources import candidates as ca
    summary = event_summary(ss.clinical_event_log(spark, SF["0.001"]))
    assert _plan(summary).count("lineitem.parquet") == 1
    summary = materialize(summary)
    tuples = as_tuples(summary)
    filtered = fe.filter_tuples(tuples, ca.derive_candidates_from_tuples(tuples), normalize="lower")
    for df in (ph.label_events(as_events(summary)), tuples, filtered):
        plan = _plan(df)
        assert "InMemoryTableScan" in plan and "BatchEvalPython" not in plan
        top = plan.split("InMemoryRelation")[0]
        assert "lineitem.parquet" not in top
    summary.unpersist()
