"""Driver contract and a Spark-vs-DuckDB oracle sample at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from phenolens.sources.tables import TABLES, table_path

from conftest import SF

FAST = ["cohort_labels", "label_counts", "load_medication", "load_lab", "load_diagnostic", "abnormal_labs",
        "first_med_dates", "t2_med_before_t1_med", "feature_tuples", "feature_dictionary", "feature_vectors",
        "contingency", "purity", "matrix_entries", "nmf_step_w", "nmf_error", "nearest_center", "center_update",
        "scaled_features", "dx_feature_counts_filtered", "lab_feature_means_filtered"]


def test_entry(spark):
    got = {r["label"]: r["n_patients"] for r in E.entry(spark).collect()}
    assert got == {1: 29, 2: 7, 3: 114}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF['0.001'], t)}')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SF["0.001"])
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in df.collect())
    b = sorted(repr(tuple(_norm(r[i]) for i in oorder)) for r in res.fetchall())
    assert a == b
