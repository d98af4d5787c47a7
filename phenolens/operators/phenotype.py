"""Cohort labelling: case (1) / control (2) / other (3) per patient.

The rule-by-rule formulation (distinct, subtract, intersection, a join of
two per-patient minima, a three-way union) needs a dozen shuffles. All of
those sets are properties of ONE patient, so the whole labelling is a single
``groupBy(patient_id)`` with conditional aggregates followed by a CASE:

    has_t2dx  : any dx row with a T2DM code that is not a T1DM code
    has_dm    : any dx row that is diabetes-related
    has_m1/m2 : any T1DM / T2DM drug row;  m1/m2: earliest such date
    normal_gl : any glucose lab row that is not abnormal

    label = 1  if has_t2dx and (not has_m1 or not has_m2 or m2 < m1)
            2  if normal_gl and not has_dm
            3  otherwise (every remaining patient of the three tables)

Every aggregate is algebraic (max/min), so Spark combines map-side: a
patient that owns a third of all rows still contributes one partial row per
input partition, never a whole group in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.functions import rules

EVENT_LOG_COLUMNS = ("patient_id", "domain", "event_ts", "name", "value")


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def event_log(medication: DataFrame | None = None, lab: DataFrame | None = None,
              diagnostic: DataFrame | None = None) -> DataFrame:
    """Union the three typed event tables into one tagged log (no de-dup)."""
    parts = []
    if diagnostic is not None:
        parts.append(diagnostic.select("patient_id", F.lit("dx").alias("domain"), "event_ts",
                                       F.col("code").alias("name"), F.lit(None).cast("double").alias("value")))
    if medication is not None:
        parts.append(medication.select("patient_id", F.lit("med").alias("domain"), "event_ts",
                                       F.col("medicine").alias("name"), F.lit(None).cast("double").alias("value")))
    if lab is not None:
        parts.append(lab.select("patient_id", F.lit("lab").alias("domain"), "event_ts",
                                F.col("test_name").alias("name"), F.col("value").cast("double")))
    if not parts:
        raise ValueError("at least one event table is required")
    return reduce(lambda a, b: a.unionByName(b), parts)


def patient_flags(events: DataFrame, strict: bool = False) -> DataFrame:
    """One row per patient with the rule flags (single shuffle on patient_id).

    ``strict=False`` keeps the published rule: the T1DM exclusion applies per
    diagnosis row (so a patient with both a T1DM and a T2DM code still
    qualifies). ``strict=True`` excludes such a patient altogether.
    """
    dom, name, value, ts = F.col("domain"), F.col("name"), F.col("value"), F.col("event_ts")
    is_dx, is_med, is_lab = dom == "dx", dom == "med", dom == "lab"
    t1_med = is_med & rules.is_t1dm_med(name)
    t2_med = is_med & rules.is_t2dm_med(name)
    t2dx = _flag(is_dx & rules.is_t2dm_dx(name))
    if strict:
        t2dx = F.least(t2dx, F.lit(1) - _flag(is_dx & name.isin(list(dict.fromkeys(rules.T1DM_DX)))))
    return events.groupBy("patient_id").agg(
        t2dx.alias("has_t2dx"),
        _flag(is_dx & rules.is_dm_related_dx(name)).alias("has_dm"),
        _flag(t1_med).alias("has_m1"),
        _flag(t2_med).alias("has_m2"),
        F.min(F.when(t1_med, ts)).alias("m1"),
        F.min(F.when(t2_med, ts)).alias("m2"),
        _flag(is_lab & rules.is_normal_glucose_lab(name, value)).alias("normal_gl"),
    )


def label_expr() -> Column:
    is_case = (F.col("has_t2dx") == 1) & (
        (F.col("has_m1") == 0) | (F.col("has_m2") == 0) | F.coalesce(F.col("m2") < F.col("m1"), F.lit(False)))
    is_control = (F.col("normal_gl") == 1) & (F.col("has_dm") == 0)
    return (F.when(is_case, F.lit(rules.CASE))
            .when(is_control, F.lit(rules.CONTROL))
            .otherwise(F.lit(rules.OTHER)))


def label_events(events: DataFrame, strict: bool = False) -> DataFrame:
    """C1 on a tagged event log -> (patient_id, label int)."""
    return patient_flags(events, strict).select("patient_id", label_expr().cast("int").alias("label"))


def label_cohort(medication: DataFrame, lab: DataFrame, diagnostic: DataFrame, strict: bool = False) -> DataFrame:
    """(patient_id, label) for every patient found in any of the tables."""
    return label_events(event_log(medication, lab, diagnostic), strict)


def label_cohort_by_facts(events: DataFrame) -> DataFrame:
    """C1 from a long table of facts: which rules hold for a patient, as a set of their names.

    Same labels as ``label_events``. The facts are a handful of names per patient,
    collected after they are made distinct, so a set is bounded by the rules."""
    name, dom = F.col("name"), F.col("domain")
    fact = (F.when((dom == "dx") & rules.is_t2dm_dx(name), "diagnosed")
            .when((dom == "med") & rules.is_t1dm_med(name), "drug1"))
    second = (F.when((dom == "dx") & rules.is_dm_related_dx(name), "related")
              .when((dom == "lab") & rules.is_normal_glucose_lab(name, F.col("value")), "normal")
              .when((dom == "med") & rules.is_t2dm_med(name), "drug2"))
    early = (t2_med_before_t1_med(events.where(dom == "med").select("patient_id", "event_ts", name.alias("medicine")))
             .select("patient_id", F.lit("early").alias("fact")))
    seen = events.select("patient_id", F.explode(F.array(fact, second, F.lit("seen"))).alias("fact"))
    facts = seen.unionByName(early).where("fact is not null").distinct().groupBy("patient_id").agg(
        F.collect_set("fact").alias("facts"))

    def holds(f: str) -> Column:
        return F.array_contains("facts", f)

    case = holds("diagnosed") & (~holds("drug1") | ~holds("drug2") | holds("early"))
    return facts.select("patient_id", F.when(case, rules.CASE).when(
        holds("normal") & ~holds("related"), rules.CONTROL).otherwise(rules.OTHER).alias("label"))


def label_counts(labels: DataFrame) -> DataFrame:
    """Patients per label."""
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_patients"))


# --- rule parts, each a small plan of its own (exposed for tests/queries) ---

def t2dm_dx_patients(diagnostic: DataFrame) -> DataFrame:
    """F1 + A8: distinct patients with a T2DM (and not T1DM) code row."""
    return diagnostic.where(rules.is_t2dm_dx(F.col("code"))).select("patient_id").distinct()


def abnormal_labs(lab: DataFrame) -> DataFrame:
    """F5 on every lab row."""
    return lab.select("patient_id", "test_name", "value",
                      rules.is_abnormal_lab(F.col("test_name"), F.col("value")).alias("abnormal"))


def normal_glucose_patients(lab: DataFrame) -> DataFrame:
    """F4 + F6: patients with at least one glucose lab that is not abnormal."""
    return (lab.where(rules.is_normal_glucose_lab(F.col("test_name"), F.col("value")))
            .select("patient_id").distinct())


def dm_related_patients(diagnostic: DataFrame) -> DataFrame:
    """patients with a diabetes-related diagnosis."""
    return diagnostic.where(rules.is_dm_related_dx(F.col("code"))).select("patient_id").distinct()


def first_med_dates(medication: DataFrame) -> DataFrame:
    """Earliest T1DM and T2DM drug date per patient having either."""
    med = F.col("medicine")
    t1, t2 = rules.is_t1dm_med(med), rules.is_t2dm_med(med)
    return (medication.where(t1 | t2).groupBy("patient_id")
            .agg(F.min(F.when(t1, F.col("event_ts"))).alias("first_t1_med_ts"),
                 F.min(F.when(t2, F.col("event_ts"))).alias("first_t2_med_ts")))


def t2_med_before_t1_med(medication: DataFrame) -> DataFrame:
    """J2 + F10: patients whose first T2DM drug is strictly before the first T1DM drug."""
    return (first_med_dates(medication)
            .where(F.col("first_t2_med_ts") < F.col("first_t1_med_ts"))
            .select("patient_id"))


def case_patients(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("label") == rules.CASE).select("patient_id")


def control_patients(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("label") == rules.CONTROL).select("patient_id")


def other_patients(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("label") == rules.OTHER).select("patient_id")
