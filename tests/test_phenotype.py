"""Cohort labelling: rule branches on hand-made rows, golden counts, properties."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenolens.functions import rules
from phenolens.operators import phenotype as ph
from phenolens.sources import starschema as ss

from conftest import SF

D = dt.datetime


def frames(spark, dx_rows, med_rows, lab_rows):
    dx = spark.createDataFrame(dx_rows, "patient_id string, event_ts timestamp, code string")
    med = spark.createDataFrame(med_rows, "patient_id string, event_ts timestamp, medicine string")
    lab = spark.createDataFrame(lab_rows, "patient_id string, event_ts timestamp, test_name string, value double")
    return med, lab, dx


def labels_of(df):
    return {r["patient_id"]: r["label"] for r in df.collect()}


def test_rule_branches(spark):
    t = D(2010, 1, 1)
    dx_rows = [
        ("c1", t, "250.00"),                      # T2DM dx, no T1 drug          -> case (cond 1)
        ("c2", t, "250.02"),                      # T2DM dx, T1 drug, no T2 drug -> case (cond 2)
        ("c3", t, "250.3"),                       # T2 drug strictly first       -> case (cond 3)
        ("x3", t, "250.3"),                       # T1 drug first                -> not case
        ("x4", t, "250.3"),                       # same day                     -> not case (strict)
        ("n1", t, "401.9"),                       # normal glucose, unrelated dx -> control
        ("n2", t, "V77.1"),                       # normal glucose but DM-related -> other
        ("n3", t, "v77.1"),                       # codes are case-sensitive     -> control
        ("t1", t, "250.01"),                      # T1DM code only               -> other
    ]
    med_rows = [
        ("c2", t, "Lantus"),
        ("c3", D(2009, 1, 1), "METFORMIN"), ("c3", D(2011, 1, 1), "insulin nph"),
        ("x3", D(2009, 1, 1), "lantus"), ("x3", D(2011, 1, 1), "metformin"),
        ("x4", t, "lantus"), ("x4", t, "glucatrol "),
        ("m1", t, "aspirin"),                     # only in medication           -> other
    ]
    lab_rows = [
        ("n1", t, "Glucose", 90.0), ("n1", t, "Glucose", 150.0),   # one normal row suffices
        ("n2", t, "Fasting Glucose", 80.0),
        ("n3", t, "glucose, serum", 100.0),
        ("a1", t, "fasting glucose", 110.0),      # abnormal only                -> other
        ("h1", t, "HbA1c", 5.0),                  # not a glucose test           -> other
        ("u1", t, "urine glucose", 999.0),        # unknown glucose test: never abnormal -> control
    ]
    got = labels_of(ph.label_cohort(*frames(spark, dx_rows, med_rows, lab_rows)))
    assert got == {"c1": 1, "c2": 1, "c3": 1, "x3": 3, "x4": 3, "n1": 2, "n2": 3, "n3": 2, "t1": 3,
                   "m1": 3, "a1": 3, "h1": 3, "u1": 2}


def test_abnormal_nan_is_not_abnormal(spark):
    df = spark.createDataFrame([("glucose", float("nan")), ("hba1c", 6.0), ("hba1c", 5.9), ("x", 1e9)],
                               "test_name string, value double")
    got = [r[0] for r in df.select(rules.is_abnormal_lab(F.col("test_name"), F.col("value"))).collect()]
    assert got == [False, True, False, False]


def test_code_lists_fixed_sizes():
    assert len(rules.T1DM_DX) == 20 and len(rules.T2DM_DX) == 18
    assert len(rules.T1DM_MED) == 8 and len(rules.T2DM_MED) == 33 and len(set(rules.T2DM_MED)) == 31
    assert len(rules.DM_RELATED_DX) == 17
    assert all("250." in c for c in rules.T2DM_DX)


@pytest.mark.parametrize("sf,expected", [("0.001", {1: 29, 2: 7, 3: 114}), ("0.01", {1: 352, 2: 82, 3: 1066})])
def test_golden_counts(spark, sf, expected):
    lab = ph.label_events(ss.clinical_event_log(spark, SF[sf]))
    got = {r["label"]: r["n_patients"] for r in ph.label_counts(lab).collect()}
    assert got == expected


def test_three_table_path_equals_event_log_and_partitions(spark):
    d = SF["0.001"]
    a = labels_of(ph.label_events(ss.clinical_event_log(spark, d)))
    b = labels_of(ph.label_cohort(ss.medication(spark, d), ss.lab(spark, d), ss.diagnostic(spark, d)))
    assert a == b
    # every patient of the three tables gets exactly one label
    ids = set()
    for f in (ss.medication(spark, d), ss.lab(spark, d), ss.diagnostic(spark, d)):
        ids |= {r[0] for r in f.select("patient_id").distinct().collect()}
    assert set(a) == ids


def test_shuffle_partitions_do_not_change_labels(spark):
    d = SF["0.001"]
    base = labels_of(ph.label_events(ss.clinical_event_log(spark, d)))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = labels_of(ph.label_events(ss.clinical_event_log(spark, d)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert base == other


def test_rule_parts(spark):
    t = D(2010, 1, 1)
    med, lab, dx = frames(spark, [("p", t, "250.00"), ("q", t, "250.01")],
                          [("p", D(2009, 1, 1), "glipizide"), ("p", D(2010, 1, 1), "Lantus")],
                          [("p", t, "Glucose", 50.0)])
    assert [r[0] for r in ph.t2dm_dx_patients(dx).collect()] == ["p"]
    assert sorted(r[0] for r in ph.dm_related_patients(dx).collect()) == ["p", "q"]
    assert [r[0] for r in ph.t2_med_before_t1_med(med).collect()] == ["p"]
    assert [r[0] for r in ph.normal_glucose_patients(lab).collect()] == ["p"]


def test_labels_from_facts_equal_those_from_flags(spark):
    for sf in ("0.001", "0.01"):
        events = ss.clinical_event_log(spark, SF[sf])
        assert labels_of(ph.label_cohort_by_facts(events)) == labels_of(ph.label_events(events))


def test_strict_excludes_mixed_type_patients(spark):
    t = D(2010, 1, 1)
    med, lab, dx = frames(spark, [("p", t, "250.00"), ("p", t, "250.01"), ("q", t, "250.00")], [], [])
    assert labels_of(ph.label_cohort(med, lab, dx)) == {"p": 1, "q": 1}
    assert labels_of(ph.label_cohort(med, lab, dx, strict=True)) == {"p": 3, "q": 1}


def test_subtract_keys_null_safe_keeps_duplicates(spark):
    from phenolens.operators.joins import intersect_keys, subtract_keys
    left = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "patient_id string")
    right = spark.createDataFrame([(None,), ("b",)], "patient_id string")
    assert sorted(r[0] for r in subtract_keys(left, right, "patient_id").collect()) == ["a", "a"]
    got = sorted((r[0] is None, r[0] or "") for r in intersect_keys(left, right, "patient_id").collect())
    assert got == [(False, "b"), (True, "")]


def test_hot_patient_is_combined_map_side(spark):
    # one patient owns a third of all rows: labels stay right and the plan
    # aggregates partially before the shuffle (no whole group in one task)
    t = D(2010, 1, 1)
    hot = [("hot", t, "250.00")] * 600
    cold = [(f"p{i}", t, "401.9") for i in range(1200)]
    med, lab, dx = frames(spark, hot + cold, [("hot", t, "metformin")], [("p1", t, "Glucose", 80.0)])
    out = ph.label_cohort(med, lab, dx)
    got = labels_of(out)
    assert got["hot"] == 1 and got["p1"] == 2 and got["p2"] == 3 and len(got) == 1201
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_rule_lists_are_those_of_the_definition():
    """The SQL oracles render the same lists, so their length and ends are pinned here."""
    from phenolens.functions import rules
    assert (len(set(rules.T1DM_DX)), len(set(rules.T2DM_DX)), len(set(rules.DM_RELATED_DX))) == (20, 18, 17)
    assert not set(rules.T1DM_DX) & set(rules.T2DM_DX) and not set(rules.T1DM_MED) & set(rules.T2DM_MED)
    assert all(c.startswith("250.") for c in rules.T1DM_DX + rules.T2DM_DX)
    assert {round(t, 1) for t in rules.ABNORMAL_LAB_THRESHOLDS.values()} == {6.0, 110.0}
    assert all(m == m.lower() for m in rules.T1DM_MED + rules.T2DM_MED)
