"""Type-2 diabetes phenotype rules as Column expressions.

Everything here is a pure, JVM-side expression (``isin`` compiles to an
``InSet`` lookup, ``when`` to a CASE) so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the published phenotype definition exactly
# (including the trailing space in "glucatrol " and the repeated drug names).
# ---------------------------------------------------------------------------
T1DM_DX = [
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43",
    "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93",
]
T2DM_DX = [
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6",
    "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
]
T1DM_MED = [
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
    "insulin reg", "insulin,ultralente",
]
T2DM_MED = [
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol xl",
    "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl",
    "repaglinide", "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
    "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide",
    "avandia", "actos", "actos", "glipizide",
]
DM_RELATED_DX = [
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648", "648.01",
    "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4",
]
# Lab test name (lower-cased, exact) -> abnormal when value >= threshold.
ABNORMAL_LAB_THRESHOLDS = {
    "hba1c": 6.0,
    "hemoglobin a1c": 6.0,
    "fasting glucose": 110.0,
    "fasting blood glucose": 110.0,
    "fasting plasma glucose": 110.0,
    "glucose": 110.0,
    "glucose, serum": 110.0,
}
DM_CODE_MARKER = "250."      # any diagnosis code containing this is diabetes-related
GLUCOSE_MARKER = "glucose"   # lab names containing this count for the control rule
# ---------------------------------------------------------------------------

CASE, CONTROL, OTHER = 1, 2, 3


def _distinct(values: list[str]) -> list[str]:
    return list(dict.fromkeys(values))


def is_t2dm_dx(code: Column) -> Column:
    """row-level T2DM code that is not a T1DM code (case-sensitive)."""
    return code.isin(_distinct(T2DM_DX)) & ~code.isin(_distinct(T1DM_DX))


def is_t1dm_med(medicine: Column) -> Column:
    """lower-cased exact membership in the T1DM drug list."""
    return F.lower(medicine).isin(_distinct(T1DM_MED))


def is_t2dm_med(medicine: Column) -> Column:
    """lower-cased exact membership in the T2DM drug list."""
    return F.lower(medicine).isin(_distinct(T2DM_MED))


def is_glucose_lab(test_name: Column) -> Column:
    """lab name contains 'glucose' (lower-cased)."""
    return F.lower(test_name).contains(GLUCOSE_MARKER)


def is_abnormal_lab(test_name: Column, value: Column) -> Column:
    """abnormal lab value; unknown test names are never abnormal.

    NaN never compares >= on the JVM, but Spark SQL orders NaN above every
    number, so NaN is excluded explicitly; a NULL value is not abnormal.
    """
    thresholds = F.create_map(*[F.lit(x) for kv in ABNORMAL_LAB_THRESHOLDS.items() for x in kv])
    threshold = F.try_element_at(thresholds, F.lower(test_name))
    return F.coalesce((value >= threshold) & ~F.isnan(value), F.lit(False))


def is_normal_glucose_lab(test_name: Column, value: Column) -> Column:
    """glucose lab row that is not abnormal."""
    return is_glucose_lab(test_name) & ~is_abnormal_lab(test_name, value)


def is_dm_related_dx(code: Column) -> Column:
    """diabetes-related code: listed, or containing '250.' anywhere."""
    return code.isin(_distinct(DM_RELATED_DX)) | code.contains(DM_CODE_MARKER)


def sql_list(values: list[str]) -> str:
    """Render a list as a SQL IN-list literal (used by the SQL oracles)."""
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in _distinct(values)) + ")"
