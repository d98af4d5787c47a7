"""Candidate feature lists (S6) and the CSV/text sources around them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.functions import rules

DOMAINS = ("dx", "lab", "med")


def load_candidate_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line -> distinct lower-cased names (column ``name``).

    Lines are lower-cased but not trimmed, as in the source lists.
    """
    return spark.read.text(path).select(F.lower(F.col("value")).alias("name")).distinct()


def derive_candidate_lists(diagnostic: DataFrame, lab: DataFrame, medication: DataFrame) -> dict[str, DataFrame]:
    """Candidate lists built from the data itself: the diabetes-relevant names.

    dx: codes of the T1/T2/related lists or containing '250.'; med: names of
    the T1/T2 drug lists; lab: names containing 'glucose' or having an
    abnormal threshold. Lower-cased and distinct, like a hand-made list file.
    """
    code, med, test = F.col("code"), F.col("medicine"), F.col("test_name")
    dx = diagnostic.where(code.isin(list(dict.fromkeys(rules.T1DM_DX + rules.T2DM_DX)))
                          | rules.is_dm_related_dx(code))
    md = medication.where(rules.is_t1dm_med(med) | rules.is_t2dm_med(med))
    lb = lab.where(rules.is_glucose_lab(test) | F.lower(test).isin(list(rules.ABNORMAL_LAB_THRESHOLDS)))
    return {
        "dx": dx.select(F.lower(code).alias("name")).distinct(),
        "lab": lb.select(F.lower(test).alias("name")).distinct(),
        "med": md.select(F.lower(med).alias("name")).distinct(),
    }


def write_candidate_lists(lists: dict[str, DataFrame], base_path: str) -> dict[str, str]:
    """Write each list as a text folder (one name per line); returns the paths."""
    paths = {}
    for dom, df in lists.items():
        path = f"{base_path.rstrip('/')}/{dom}_filter"
        df.select("name").write.mode("overwrite").text(path)
        paths[dom] = path
    return paths


# FIXED VALUE: which part of a path names its table.
_TABLE_NAME = re.compile(r"(\w+)(\.csv)?$", re.ASCII)


def infer_table_name(path: str) -> str:
    """View name from a path (``data/foo.csv`` -> ``foo``); no match -> the path."""
    m = _TABLE_NAME.search(path)
    return m.group(1) if m else path


def view_name(path: str) -> str:
    """The inferred name as one that a view can have: no other characters than letters,
    digits and underscores, and no leading digit (``2010.csv`` -> ``_2010``)."""
    name = re.sub(r"\W", "_", infer_table_name(path), flags=re.ASCII)
    return name if re.match(r"[A-Za-z_]", name) else f"_{name}"


def derive_candidates_from_tuples(tuples: DataFrame) -> dict[str, DataFrame]:
    """Same lists as ``derive_candidate_lists``, read off feature tuples
    ``(patient_id, domain, feature, value)``: every event name appears as a
    feature of its domain, so no second pass over the events is needed."""
    names = tuples.select("domain", "feature").distinct()
    f = F.col("feature")
    keep = {
        "dx": f.isin(list(dict.fromkeys(rules.T1DM_DX + rules.T2DM_DX))) | rules.is_dm_related_dx(f),
        "lab": rules.is_glucose_lab(f) | F.lower(f).isin(list(rules.ABNORMAL_LAB_THRESHOLDS)),
        "med": rules.is_t1dm_med(f) | rules.is_t2dm_med(f),
    }
    return {dom: names.where((F.col("domain") == dom) & cond).select(F.lower(f).alias("name")).distinct()
            for dom, cond in keep.items()}
