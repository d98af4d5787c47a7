"""Staged tables: joined and labelled without an exchange, same rows as from the events."""
from phenolens.operators import features as fe
from phenolens.operators import phenotype as ph
from phenolens.plans import catalog
from phenolens.sources import staged as sd
from phenolens.sources import starschema as ss

from conftest import SF


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_and_labels_need_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = catalog.staged_tables(spark, SF["0.001"])
        joined, labels = _plan(t.diagnostic()), _plan(t.labels())
        assert "SortMergeJoin" in joined and "Exchange" not in joined
        assert "HashAggregate" in labels and "Exchange" not in labels
        assert "Exchange" not in _plan(t.tuples())
        log = ss.clinical_event_log(spark, SF["0.001"])
        for got, want in ((t.labels(), ph.label_events(log)), (t.labels(strict=True), ph.label_events(log, strict=True)),
                          (t.tuples(), fe.event_feature_tuples(log)), (t.diagnostic(), ss.diagnostic(spark, SF["0.001"]))):
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        t.drop()
        assert not spark.catalog.tableExists(t.summary)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_encounter_and_odd_rows(spark):
    enc = spark.createDataFrame([(1, "a", "2020-01-01"), (2, "b", "2020-01-02"), (3, None, "2020-01-03")],
                                "encounter_id long, patient_id string, d string").selectExpr(
        "encounter_id", "patient_id", "to_timestamp(d) AS event_ts")
    dx = spark.createDataFrame([(1, "250.00")] * 500 + [(2, "x"), (2, None), (3, "y"), (9, "z"), (None, "w")],
                               "encounter_id long, code string")
    med = spark.createDataFrame([("a", None)], "patient_id string, medicine string").selectExpr(
        "patient_id", "current_timestamp() AS event_ts", "medicine")
    lab = spark.createDataFrame([], "patient_id string, event_ts timestamp, test_name string, value double")
    t = sd.stage(enc, dx, med, lab, buckets=3)
    assert spark.table(t.encounter_dx).where("encounter_id = 1").count() == 1     # counted, not repeated
    rows = t.diagnostic().groupBy("patient_id", "code").count().collect()
    assert {tuple(r) for r in rows} == {("a", "250.00", 500), ("b", "x", 1)}
    assert {(r["patient_id"], r["value"]) for r in t.tuples().collect()} == {("a", 500.0), ("b", 1.0)}
    assert {r["patient_id"] for r in t.labels().collect()} == {"a", "b"}
    t.drop()
