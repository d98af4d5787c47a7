"""Feature construction: counts, means, candidate lists, dictionary and vectors."""
import datetime as dt
from collections import Counter, defaultdict

import pytest

from phenolens.operators import features as fe

NOW = dt.datetime(2020, 1, 1)
#: One made-up ward: (patient, name, value); names repeat within and across patients.
WARD = [("ann", "k10", 3.0), ("ann", "k10", 5.0), ("ann", "m54", 1.5), ("bob", "k10", 7.0), ("bob", "r05", 2.0),
        ("bob", "r05", 4.0), ("bob", "r05", 9.0), ("cat", "z00", -1.0)]


def dx(spark, rows):
    return spark.createDataFrame([(p, NOW, c) for p, c, _ in rows], "patient_id string, event_ts timestamp, code string")


def med(spark, rows):
    return spark.createDataFrame([(p, NOW, c) for p, c, _ in rows], "patient_id string, event_ts timestamp, medicine string")


def lab(spark, rows):
    return spark.createDataFrame([(p, NOW, n, v) for p, n, v in rows],
                                 "patient_id string, event_ts timestamp, test_name string, value double")


def as_map(df):
    return {(r["patient_id"], r["feature"]): r["value"] for r in df.collect()}


def counted(rows):
    return {k: float(n) for k, n in Counter((p, c) for p, c, _ in rows).items()}


@pytest.mark.parametrize("names", [None, {"r05"}, {"k10", "z00"}, {"absent"}])
def test_counts_and_means_of_listed_names(spark, names):
    rows = [r for r in WARD if names is None or r[1] in names]
    assert as_map(fe.diagnostic_feature_counts(dx(spark, WARD), names)) == counted(rows)
    assert as_map(fe.medication_feature_counts(med(spark, WARD), names)) == counted(rows)
    sums = defaultdict(list)
    for p, n, v in rows:
        sums[p, n].append(v)
    assert as_map(fe.lab_feature_means(lab(spark, WARD), names)) == {k: sum(v) / len(v) for k, v in sums.items()}


def test_candidate_dataframe_and_case_rule(spark):
    # candidate lists are lower-cased; exact match drops mixed-case names unless normalised
    m = med(spark, [("ann", n, 0.0) for n in ("Metformin", "metformin", "Aspirin")])
    cands = spark.createDataFrame([("metformin",)], "name string")
    assert as_map(fe.medication_feature_counts(m, cands)) == {("ann", "metformin"): 1.0}
    got = as_map(fe.medication_feature_counts(m, cands, normalize="lower"))
    assert got == {("ann", "Metformin"): 1.0, ("ann", "metformin"): 1.0}


def tuples(spark, rows):
    return spark.createDataFrame(rows, "patient_id string, feature string, value double")


def vectors(spark, rows):
    t = tuples(spark, rows)
    long, dictionary, n = fe.feature_matrix(t, keys=("feature",))
    return {r["patient_id"]: r["features"] for r in fe.sparse_feature_vectors(long, n).collect()}


def test_vectors_follow_the_alphabet(spark):
    got = vectors(spark, [("ann", "pear", 8.0), ("ann", "fig", 2.5), ("bob", "nut", 4.0), ("bob", "pear", 1.0)])
    assert {p: v.toArray().tolist() for p, v in got.items()} == {"ann": [2.5, 0.0, 8.0], "bob": [0.0, 4.0, 1.0]}
    assert got["ann"].indices.tolist() == [0, 2]


def test_dense_arrays_match_sparse(spark):
    t = tuples(spark, [("p1", "b", 1.0), ("p1", "a", 2.0), ("p2", "c", 3.0)])
    long, _, n = fe.feature_matrix(t, keys=("feature",))
    dense = {r["patient_id"]: r["features"] for r in fe.dense_feature_arrays(long, n).collect()}
    assert dense == {"p1": [2.0, 1.0, 0.0], "p2": [0.0, 0.0, 3.0]}


def test_domain_keeps_families_apart(spark):
    t = spark.createDataFrame([("p1", "dx", "x", 1.0), ("p1", "med", "x", 2.0)],
                              "patient_id string, domain string, feature string, value double")
    long, dictionary, n = fe.feature_matrix(t)
    assert n == 2
    assert sorted(r["value"] for r in long.collect()) == [1.0, 2.0]


def test_dense_index_matches_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from phenolens.operators.indexing import dense_index
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 10007).cast("string").alias("k"))
    got = {r["k"]: r["id"] for r in dense_index(df, ["k"], "id", num_partitions=5).collect()}
    want = {r["k"]: r["rn"] for r in df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("rn"))
            .collect()}
    assert got == want


def test_join_small_fallback_equals_broadcast(spark):
    from phenolens.operators.joins import join_small
    big = spark.range(100).selectExpr("id % 10 AS k", "id")
    small = spark.range(10).selectExpr("id AS k", "id * 2 AS v")
    a = sorted(tuple(r) for r in join_small(big, small, "k").collect())
    b = sorted(tuple(r) for r in join_small(big, small, "k", max_bytes=0).collect())
    assert a == b and len(a) == 100


def test_duplicate_names_across_families_are_summed_without_domain(spark):
    t = spark.createDataFrame([("p1", "dx", "x", 1.0), ("p1", "med", "x", 2.0)],
                              "patient_id string, domain string, feature string, value double")
    long, _, n = fe.feature_matrix(t, keys=("feature",))
    assert n == 1 and [(r["feature_id"], r["value"]) for r in long.collect()] == [(0, 3.0)]


def test_filter_after_aggregation_equals_filter_before(spark):
    from conftest import SF
    from phenolens.sources import candidates as ca
    from phenolens.sources import starschema as ss
    d = SF["0.001"]
    events = ss.clinical_event_log(spark, d)
    tuples = fe.event_feature_tuples(events)
    c1 = ca.derive_candidate_lists(ss.diagnostic(spark, d), ss.lab(spark, d), ss.medication(spark, d))
    c2 = ca.derive_candidates_from_tuples(tuples)
    for dom in ("dx", "lab", "med"):
        assert sorted(r[0] for r in c1[dom].collect()) == sorted(r[0] for r in c2[dom].collect())
    a = fe.event_feature_tuples(events, c1, normalize="lower")
    b = fe.filter_tuples(tuples, c2, normalize="lower")
    key = lambda df: sorted(tuple(r) for r in df.select("patient_id", "domain", "feature", "value").collect())
    assert key(a) == key(b)


def test_domains_without_a_list_stay_whole(spark):
    rows = [("p", "dx", "a", 1.0), ("p", "dx", "b", 1.0), ("p", "lab", "a", 2.0), ("q", "med", "c", 3.0)]
    t = spark.createDataFrame(rows, "patient_id string, domain string, feature string, value double")
    listed = spark.createDataFrame([("a",)], "name string")
    for candidates in ({"dx": ["a"]}, {"dx": listed}, {"dx": ["a"], "lab": None}, {"dx": listed, "lab": ["a"]}):
        kept = sorted(tuple(r) for r in fe.filter_tuples(t, candidates).collect())
        assert kept == [rows[0], rows[2], rows[3]]
    assert fe.filter_tuples(t, {}).count() == 4


def test_no_feature_gives_empty_report_rows(spark):
    from phenolens.plans import evaluation as ev
    t = spark.createDataFrame([], "patient_id string, domain string, feature string, value double")
    labels = spark.createDataFrame([("p", 1)], "patient_id string, label int")
    rows = ev.evaluate(labels, t).collect()
    assert sorted((r["algorithm"], r["purity"], r["n_rows"]) for r in rows) == sorted((a, None, 0) for a in ev.ALGORITHMS)


def test_kmeans_is_the_same_however_rows_arrive(spark):
    from conftest import SF
    from phenolens.plans import evaluation as ev
    from phenolens.sources import starschema as ss
    tuples = fe.event_feature_tuples(ss.clinical_event_log(spark, SF["0.001"]))
    seen = []
    for parts, shuffles in ((2, "8"), (9, "32")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        inputs = ev.prepare(tuples.repartition(parts))
        seen.append({r["patient_id"]: r["cluster"] for r in ev.kmeans_clusters(inputs).collect()})
        inputs.release()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 3


def test_dense_arrays_fill_gaps_and_ends(spark):
    long = spark.createDataFrame([("p", 4, 2.0), ("p", 1, 1.0), ("q", 0, 5.0), ("r", 5, 7.0)],
                                 "patient_id string, feature_id long, value double")
    dense = {r["patient_id"]: r["features"] for r in fe.dense_feature_arrays(long, 6).collect()}
    assert dense == {"p": [0, 1, 0, 0, 2, 0], "q": [5, 0, 0, 0, 0, 0], "r": [0, 0, 0, 0, 0, 7]}


def test_summary_gives_the_labels_and_tuples_of_the_events(spark):
    from datetime import datetime

    from conftest import SF
    from phenolens.operators import phenotype as ph
    from phenolens.operators.summary import as_events, as_tuples, event_summary
    from phenolens.sources import starschema as ss
    nan = float("nan")
    odd = [("x1", "lab", datetime(2020, 1, 1), "Glucose", v) for v in (nan, 500.0)]
    odd += [("x2", "lab", datetime(2020, 1, 1), "Glucose", v) for v in (500.0, 300.0)]
    odd += [("x3", "lab", None, "Glucose", None), ("x4", "dx", None, None, None)]
    log = ss.clinical_event_log(spark, SF["0.001"])
    events = log.unionByName(spark.createDataFrame(odd, log.schema))
    summary = event_summary(events)
    for strict in (False, True):
        a, b = ph.label_events(events, strict), ph.label_events(as_events(summary), strict)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    labels = {r["patient_id"]: r["label"] for r in ph.label_events(as_events(summary)).collect()}
    assert [labels[p] for p in ("x1", "x2", "x3", "x4")] == [2, 3, 2, 3]
    one = as_tuples(summary).where("patient_id = 'x2'").collect()
    assert [(r["domain"], r["feature"], r["value"]) for r in one] == [("lab", "Glucose", 400.0)]
