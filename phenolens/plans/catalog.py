"""Registered queries: (spark, sf_dir) -> DataFrame, plus their SQL oracles.

Every query reads the driver's tables through the star-schema adapter and
runs over whole tables. Floating-point outputs are rounded to
``oracle.ROUND`` decimals on both sides so equal results hash equally.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.functions import rules
from phenolens.operators import features as fe
from phenolens.operators import joins as jo
from phenolens.operators import metrics as me
from phenolens.operators import phenotype as ph
from phenolens.plans import oracle as o
from phenolens.session import materialize, scratch_path
from phenolens.sources import candidates as ca
from phenolens.sources import csv as cs
from phenolens.sources import staged as sd
from phenolens.sources import starschema as ss
from phenolens.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r(col, name: str | None = None):
    c = F.round(F.col(col) if isinstance(col, str) else col, o.ROUND)
    return c.alias(name or (col if isinstance(col, str) else "value"))


# ----------------------------------------------------------------- labelling

def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ph.label_events(ss.clinical_event_log(spark, sf_dir))


@register("cohort_labels", o.labelled("SELECT patient_id, label FROM labels"))
def q_cohort_labels(spark, sf_dir):
    return labels(spark, sf_dir)


@register("cohort_labels_by_sets", o.labelled("SELECT patient_id, label FROM labels"))
def q_cohort_labels_by_sets(spark, sf_dir):
    return ph.label_cohort_by_facts(ss.clinical_event_log(spark, sf_dir))


@register("subtract_keys", "SELECT CAST(o_custkey AS VARCHAR) AS patient_id, COUNT(*) AS n_orders FROM orders "
          "WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY o_custkey")
def q_subtract_keys(spark, sf_dir):
    """Orders of customers without any event: every copy of a key stays or goes."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"))
    users = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("patient_id"))
    return jo.subtract_keys(orders, users, "patient_id").groupBy("patient_id").agg(F.count("*").alias("n_orders"))


@register("intersect_keys", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS patient_id FROM orders "
          "WHERE o_custkey IN (SELECT user_id FROM events)")
def q_intersect_keys(spark, sf_dir):
    """Customers with orders and events, once each."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"))
    users = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("patient_id"))
    return jo.intersect_keys(orders, users, "patient_id")


@register("cohort_labels_strict", o.labelled(
    "SELECT patient_id, CASE WHEN label = 1 AND patient_id IN (SELECT patient_id FROM diagnostic "
    f"WHERE code IN {rules.sql_list(rules.T1DM_DX)}) THEN "
    "(CASE WHEN patient_id IN (SELECT patient_id FROM normal_gl) "
    "AND patient_id NOT IN (SELECT patient_id FROM dm_related) THEN 2 ELSE 3 END) "
    "ELSE label END AS label FROM labels"))
def q_cohort_labels_strict(spark, sf_dir):
    return ph.label_events(ss.clinical_event_log(spark, sf_dir), strict=True)


@register("label_counts", o.labelled(
    "SELECT label, COUNT(*) AS n_patients FROM labels GROUP BY label"))
def q_label_counts(spark, sf_dir):
    return ph.label_counts(labels(spark, sf_dir))


@register("case_patients", o.labelled("SELECT patient_id FROM cases"))
def q_case_patients(spark, sf_dir):
    return ph.case_patients(labels(spark, sf_dir))


@register("control_patients", o.labelled("SELECT patient_id FROM controls"))
def q_control_patients(spark, sf_dir):
    return ph.control_patients(labels(spark, sf_dir))


@register("other_patients", o.labelled("SELECT patient_id FROM others"))
def q_other_patients(spark, sf_dir):
    return ph.other_patients(labels(spark, sf_dir))


# ----------------------------------------------------------------- sources

@register("load_medication", o.base("SELECT patient_id, event_ts, medicine FROM medication"))
def q_load_medication(spark, sf_dir):
    return ss.medication(spark, sf_dir)


@register("load_lab", o.base(f"SELECT patient_id, event_ts, test_name, ROUND(value, {o.ROUND}) AS value FROM lab"))
def q_load_lab(spark, sf_dir):
    return ss.lab(spark, sf_dir).select("patient_id", "event_ts", "test_name", _r("value"))


@register("load_diagnostic", o.base("SELECT patient_id, event_ts, code FROM diagnostic"))
def q_load_diagnostic(spark, sf_dir):
    return ss.diagnostic(spark, sf_dir)


def staged_tables(spark: SparkSession, sf_dir: str) -> sd.Staged:
    """The adapter's tables, staged in the shared folder."""
    encounter = ss.encounters(spark, sf_dir).withColumnRenamed("encounter_ts", "event_ts")
    return sd.stage(encounter, ss.encounter_dx(spark, sf_dir), ss.medication(spark, sf_dir), ss.lab(spark, sf_dir))


@register("staged_diagnostic", o.base("SELECT patient_id, event_ts, code FROM diagnostic"))
def q_staged_diagnostic(spark, sf_dir):
    return staged_tables(spark, sf_dir).diagnostic()


@register("staged_labels", o.labelled("SELECT patient_id, label FROM labels"))
def q_staged_labels(spark, sf_dir):
    return staged_tables(spark, sf_dir).labels()


# The adapter's rows as clinical extracts, with broken copies of some of them: read back by the CSV loaders.

_SECOND = "date_trunc('second', {0})"
_BROKEN = "patient_id LIKE '%7'"   # patients whose rows are written a second time, broken


def write_extracts(spark: SparkSession, sf_dir: str) -> str:
    """Write the four extracts to the shared scratch folder; returns its path.

    The rows of patients whose id ends in 7 appear twice, the second time with a
    date that is none, and in the labs with a value that is none."""
    def stamp(c: str):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    base = scratch_path(spark, "extracts")
    med = ss.medication(spark, sf_dir).select(F.col("patient_id").alias("Member_ID"), stamp("event_ts").alias("Order_Date"),
                                              F.col("medicine").alias("Drug_Name"))
    lab = ss.lab(spark, sf_dir).select(F.col("patient_id").alias("Member_ID"), stamp("event_ts").alias("Date_Resulted"),
                                       F.col("test_name").alias("Result_Name"),
                                       F.col("value").cast("string").alias("Numeric_Result"))
    broken = F.col("Member_ID").endswith("7")
    med = med.unionByName(med.where(broken).withColumn("Order_Date", F.lit("2010-13-45")))
    lab = lab.unionByName(lab.where(broken).withColumn("Numeric_Result", F.lit("1,234")))
    enc = ss.encounters(spark, sf_dir).select(F.col("encounter_id").alias("Encounter_ID"), F.col("patient_id").alias("Member_ID"),
                                              stamp("encounter_ts").alias("Encounter_DateTime"))
    dx = ss.encounter_dx(spark, sf_dir).select(F.col("encounter_id").alias("Encounter_ID"), "code")
    for frame, name in ((med, cs.MEDICATION_FILE), (lab, cs.LAB_FILE), (dx, cs.DX_FILE), (enc, cs.ENCOUNTER_FILE)):
        frame.write.option("header", True).csv(f"{base}/{name}")
    return base


@register("csv_medication", o.base(f"SELECT patient_id, {_SECOND.format('event_ts')} AS event_ts, medicine FROM medication"))
def q_csv_medication(spark, sf_dir):
    t = cs.load_medication(spark, f"{write_extracts(spark, sf_dir)}/{cs.MEDICATION_FILE}")
    return t.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@register("csv_lab", o.base(f"SELECT patient_id, {_SECOND.format('event_ts')} AS event_ts, test_name, "
                            f"ROUND(value, {o.ROUND}) AS value FROM lab"))
def q_csv_lab(spark, sf_dir):
    t = cs.load_lab(spark, f"{write_extracts(spark, sf_dir)}/{cs.LAB_FILE}")
    return t.select("patient_id", F.col("event_ts").cast("timestamp_ntz"), "test_name", _r("value"))


@register("csv_diagnostic", o.base(f"SELECT patient_id, {_SECOND.format('event_ts')} AS event_ts, code FROM diagnostic"))
def q_csv_diagnostic(spark, sf_dir):
    base = write_extracts(spark, sf_dir)
    t = cs.load_diagnostic(spark, f"{base}/{cs.DX_FILE}", f"{base}/{cs.ENCOUNTER_FILE}")
    return t.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@register("csv_rejects", o.base(f"""
SELECT 'medication' AS source, 'date' AS reason, COUNT(*) AS n_rows FROM medication WHERE {_BROKEN} HAVING COUNT(*) > 0
UNION ALL SELECT 'lab', 'value', COUNT(*) FROM lab WHERE {_BROKEN} HAVING COUNT(*) > 0"""))
def q_csv_rejects(spark, sf_dir):
    return cs.rejected_rows(spark, write_extracts(spark, sf_dir))


_STAMP = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"


@register("csv_quarantine", o.base(f"""
SELECT 'medication' AS source, 'date' AS reason, patient_id || ',2010-13-45,' || medicine AS line FROM medication WHERE {_BROKEN}
UNION ALL SELECT 'medication', 'malformed', CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT 'lab', 'value', patient_id || ',' || {_STAMP.format('event_ts')} || ',' || test_name || ',"1,234"'
FROM lab WHERE {_BROKEN}
UNION ALL SELECT 'diagnostic', 'orphan', 'X' || encounter_id || ',' || code FROM edx WHERE encounter_id % 97 = 0"""))
def q_csv_quarantine(spark, sf_dir):
    """Every row that the CSV loaders drop, with its reason: also short lines, and diagnoses without encounter."""
    base = write_extracts(spark, sf_dir)
    short = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Member_ID"))   # one field instead of three
    short.write.mode("append").option("header", True).csv(f"{base}/{cs.MEDICATION_FILE}")
    orphans = ss.encounter_dx(spark, sf_dir).where(F.col("encounter_id") % 97 == 0).select(
        F.concat(F.lit("X"), "encounter_id").alias("Encounter_ID"), "code")
    orphans.write.mode("append").option("header", True).csv(f"{base}/{cs.DX_FILE}")
    return cs.quarantine(spark, base).select("source", "reason", "line")


def _candidate_sql() -> str:
    t12 = rules.sql_list(rules.T1DM_DX + rules.T2DM_DX)
    dmrel = rules.sql_list(rules.DM_RELATED_DX)
    meds = rules.sql_list(rules.T1DM_MED + rules.T2DM_MED)
    labs = rules.sql_list(list(rules.ABNORMAL_LAB_THRESHOLDS))
    return f"""
cand AS (
  SELECT DISTINCT 'dx' AS domain, lower(code) AS name FROM diagnostic
  WHERE code IN {t12} OR code IN {dmrel} OR contains(code, '{rules.DM_CODE_MARKER}')
  UNION
  SELECT DISTINCT 'lab' AS domain, lower(test_name) AS name FROM lab
  WHERE contains(lower(test_name), '{rules.GLUCOSE_MARKER}') OR lower(test_name) IN {labs}
  UNION
  SELECT DISTINCT 'med' AS domain, lower(medicine) AS name FROM medication
  WHERE lower(medicine) IN {meds})"""


def candidate_lists(spark, sf_dir) -> dict[str, DataFrame]:
    return ca.derive_candidate_lists(ss.diagnostic(spark, sf_dir), ss.lab(spark, sf_dir),
                                     ss.medication(spark, sf_dir))


@register("load_candidates", o.with_ctes(o.adapter_ctes(), _candidate_sql(),
                                         body="SELECT domain, name FROM cand"))
def q_load_candidates(spark, sf_dir):
    # derive the lists from the events' names (one join, read once), write them as one-name-per-line
    # text files in the shared scratch folder, and read them back with the S6 loader
    names = materialize(ss.clinical_event_log(spark, sf_dir)
                        .select("domain", F.col("name").alias("feature")).distinct())
    paths = ca.write_candidate_lists(ca.derive_candidates_from_tuples(names), scratch_path(spark, "candidates"))
    names.unpersist()
    frames = [ca.load_candidate_list(spark, p).select(F.lit(dom).alias("domain"), "name")
              for dom, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ----------------------------------------------------------------- rule parts

@register("t2dm_dx_patients", o.labelled("SELECT patient_id FROM t2dx"))
def q_t2dm_dx_patients(spark, sf_dir):
    return ph.t2dm_dx_patients(ss.diagnostic(spark, sf_dir))


@register("abnormal_labs", o.base(
    f"SELECT patient_id, test_name, ROUND(value, {o.ROUND}) AS value, {o.abnormal_sql()} AS abnormal FROM lab"))
def q_abnormal_labs(spark, sf_dir):
    return ph.abnormal_labs(ss.lab(spark, sf_dir)).select("patient_id", "test_name", _r("value"), "abnormal")


@register("normal_glucose_patients", o.labelled("SELECT patient_id FROM normal_gl"))
def q_normal_glucose_patients(spark, sf_dir):
    return ph.normal_glucose_patients(ss.lab(spark, sf_dir))


@register("dm_related_patients", o.labelled("SELECT patient_id FROM dm_related"))
def q_dm_related_patients(spark, sf_dir):
    return ph.dm_related_patients(ss.diagnostic(spark, sf_dir))


@register("first_med_dates", o.labelled(
    "SELECT COALESCE(med1.patient_id, med2.patient_id) AS patient_id, med1.d AS first_t1_med_ts, "
    "med2.d AS first_t2_med_ts FROM med1 FULL OUTER JOIN med2 ON med1.patient_id = med2.patient_id"))
def q_first_med_dates(spark, sf_dir):
    return ph.first_med_dates(ss.medication(spark, sf_dir))


@register("t2_med_before_t1_med", o.labelled("SELECT patient_id FROM before_"))
def q_t2_med_before_t1_med(spark, sf_dir):
    return ph.t2_med_before_t1_med(ss.medication(spark, sf_dir))


# ----------------------------------------------------------------- features

def _count_sql(table: str, col: str, where: str = "") -> str:
    return (f"SELECT patient_id, {col} AS feature, CAST(COUNT(*) AS DOUBLE) AS value "
            f"FROM {table} {where} GROUP BY patient_id, {col}")


def _cand_where(domain: str, col: str) -> str:
    return f"WHERE lower({col}) IN (SELECT name FROM cand WHERE domain = '{domain}')"


@register("dx_feature_counts", o.base(_count_sql("diagnostic", "code")))
def q_dx_feature_counts(spark, sf_dir):
    return fe.diagnostic_feature_counts(ss.diagnostic(spark, sf_dir))


@register("dx_feature_counts_filtered", o.with_ctes(
    o.adapter_ctes(), _candidate_sql(), body=_count_sql("diagnostic", "code", _cand_where("dx", "code"))))
def q_dx_feature_counts_filtered(spark, sf_dir):
    return fe.diagnostic_feature_counts(ss.diagnostic(spark, sf_dir), candidate_lists(spark, sf_dir)["dx"],
                                        normalize="lower")


@register("med_feature_counts", o.base(_count_sql("medication", "medicine")))
def q_med_feature_counts(spark, sf_dir):
    return fe.medication_feature_counts(ss.medication(spark, sf_dir))


@register("med_feature_counts_filtered", o.with_ctes(
    o.adapter_ctes(), _candidate_sql(),
    body=_count_sql("medication", "medicine", _cand_where("med", "medicine"))))
def q_med_feature_counts_filtered(spark, sf_dir):
    return fe.medication_feature_counts(ss.medication(spark, sf_dir), candidate_lists(spark, sf_dir)["med"],
                                        normalize="lower")


def _mean_sql(where: str = "") -> str:
    return (f"SELECT patient_id, test_name AS feature, ROUND(AVG(value), {o.ROUND}) AS value "
            f"FROM lab {where} GROUP BY patient_id, test_name")


@register("lab_feature_means", o.base(_mean_sql()))
def q_lab_feature_means(spark, sf_dir):
    return fe.lab_feature_means(ss.lab(spark, sf_dir)).select("patient_id", "feature", _r("value"))


@register("lab_feature_means_filtered", o.with_ctes(
    o.adapter_ctes(), _candidate_sql(), body=_mean_sql(_cand_where("lab", "test_name"))))
def q_lab_feature_means_filtered(spark, sf_dir):
    return (fe.lab_feature_means(ss.lab(spark, sf_dir), candidate_lists(spark, sf_dir)["lab"],
                                 normalize="lower")
            .select("patient_id", "feature", _r("value")))


def tuples_sql() -> str:
    return f"""
tuples AS (
  SELECT patient_id, 'dx' AS domain, code AS feature, CAST(COUNT(*) AS DOUBLE) AS value
  FROM diagnostic GROUP BY patient_id, code
  UNION ALL
  SELECT patient_id, 'lab' AS domain, test_name AS feature, AVG(value) AS value
  FROM lab GROUP BY patient_id, test_name
  UNION ALL
  SELECT patient_id, 'med' AS domain, medicine AS feature, CAST(COUNT(*) AS DOUBLE) AS value
  FROM medication GROUP BY patient_id, medicine),
dict AS (
  SELECT domain, feature, CAST(ROW_NUMBER() OVER (ORDER BY domain, feature) - 1 AS BIGINT) AS feature_id
  FROM (SELECT DISTINCT domain, feature FROM tuples)),
fm AS (
  SELECT t.patient_id, d.feature_id, SUM(t.value) AS value
  FROM tuples t JOIN dict d ON t.domain = d.domain AND t.feature = d.feature
  GROUP BY t.patient_id, d.feature_id)"""


def feature_tuples(spark, sf_dir) -> DataFrame:
    return fe.event_feature_tuples(ss.events_by_patient(spark, sf_dir))


@register("feature_tuples", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=(
    f"SELECT patient_id, domain, feature, ROUND(value, {o.ROUND}) AS value FROM tuples")))
def q_feature_tuples(spark, sf_dir):
    return feature_tuples(spark, sf_dir).select("patient_id", "domain", "feature", _r("value"))


@register("feature_dictionary", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=(
    "SELECT domain, feature, feature_id FROM dict")))
def q_feature_dictionary(spark, sf_dir):
    return fe.feature_dictionary(feature_tuples(spark, sf_dir))


@register("feature_matrix_long", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=(
    f"SELECT patient_id, feature_id, ROUND(value, {o.ROUND}) AS value FROM fm")))
def q_feature_matrix_long(spark, sf_dir):
    long, _, _ = fe.feature_matrix(feature_tuples(spark, sf_dir))
    return long.select("patient_id", "feature_id", _r("value"))


@register("abs_features", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=(
    f"SELECT patient_id, feature_id, ROUND(ABS(value), {o.ROUND}) AS value FROM fm")))
def q_abs_features(spark, sf_dir):
    long, _, _ = fe.feature_matrix(feature_tuples(spark, sf_dir))
    return fe.abs_features(long).select("patient_id", "feature_id", _r("value"))


@register("feature_vectors", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=f"""
SELECT g.patient_id,
       list(COALESCE(ROUND(m.value, {o.ROUND}), 0.0) ORDER BY g.feature_id) AS features
FROM (SELECT patient_id, unnest(range((SELECT COUNT(*) FROM dict))) AS feature_id
      FROM (SELECT DISTINCT patient_id FROM fm)) g
LEFT JOIN fm m ON m.patient_id = g.patient_id AND m.feature_id = g.feature_id
GROUP BY g.patient_id"""))
def q_feature_vectors(spark, sf_dir):
    long, _, n = fe.feature_matrix(feature_tuples(spark, sf_dir))
    arr = fe.dense_feature_arrays(long, n)
    return arr.select("patient_id", F.transform("features", lambda x: F.round(x, o.ROUND)).alias("features"))


# ----------------------------------------------------------------- evaluation

def embedding_argmax_sql() -> str:
    return ("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cluster, "
            "label FROM embeddings")


def embedding_argmax(spark, sf_dir) -> DataFrame:
    from phenolens.functions.vectors import argmax
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", argmax(F.col("embedding")).alias("cluster"), "label")


@register("argmax_cluster", f"SELECT vec_id, cluster FROM ({embedding_argmax_sql()})")
def q_argmax_cluster(spark, sf_dir):
    return embedding_argmax(spark, sf_dir).select("vec_id", "cluster")


@register("contingency", f"SELECT cluster, label, COUNT(*) AS n FROM ({embedding_argmax_sql()}) GROUP BY cluster, label")
def q_contingency(spark, sf_dir):
    return me.contingency(embedding_argmax(spark, sf_dir))


@register("purity", f"""
SELECT ROUND(CAST(SUM(best) AS DOUBLE) / CAST(SUM(size) AS DOUBLE), {o.ROUND}) AS purity,
       CAST(SUM(size) AS BIGINT) AS n_rows
FROM (SELECT cluster, MAX(n) AS best, SUM(n) AS size
      FROM (SELECT cluster, label, COUNT(*) AS n FROM ({embedding_argmax_sql()}) GROUP BY cluster, label)
      GROUP BY cluster)""")
def q_purity(spark, sf_dir):
    return me.purity(embedding_argmax(spark, sf_dir)).select(_r("purity"), "n_rows")


@register("feature_tuples_filtered", o.with_ctes(o.adapter_ctes(), _candidate_sql(), tuples_sql(), body=f"""
SELECT patient_id, domain, feature, ROUND(value, {o.ROUND}) AS value FROM tuples
WHERE domain = 'lab' OR lower(feature) IN (SELECT name FROM cand WHERE cand.domain = tuples.domain)"""))
def q_feature_tuples_filtered(spark, sf_dir):
    """Lists for diagnoses and drugs alone: labs, which have none, stay whole."""
    tuples = feature_tuples(spark, sf_dir)
    lists = ca.derive_candidates_from_tuples(tuples)
    kept = fe.filter_tuples(tuples, {"dx": lists["dx"], "med": lists["med"]}, normalize="lower")
    return kept.select("patient_id", "domain", "feature", _r("value"))


@register("feature_vectors_sparse", o.with_ctes(o.adapter_ctes(), tuples_sql(), body=f"""
SELECT patient_id, list(feature_id ORDER BY feature_id) AS ids,
       list(ROUND(value, {o.ROUND}) ORDER BY feature_id) AS vals FROM fm GROUP BY patient_id"""))
def q_feature_vectors_sparse(spark, sf_dir):
    """The vectors that scaling and the fits read, before they become ML vectors."""
    long, _, _ = fe.feature_matrix(feature_tuples(spark, sf_dir))
    return fe.sparse_feature_arrays(long).withColumn("vals", F.transform("vals", lambda v: F.round(v, o.ROUND)))
