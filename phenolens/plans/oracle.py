"""DuckDB SQL oracles for the registered queries.

Each oracle restates the query in plain SQL over the driver's views
(``orders``, ``lineitem``, ``events``, ``embeddings``, ...). The labelling
oracle deliberately uses the literal rule-by-rule set formulation
(EXCEPT / INTERSECT / joins of per-patient minima) rather than the single
conditional aggregate the Spark side runs, so the two cross-check each other.
"""

from __future__ import annotations

from phenolens.functions import rules
from phenolens.sources import starschema as ss

ROUND = 6  # decimals used on both sides for floating-point outputs


def _sql_array(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def adapter_ctes() -> str:
    dx_cycle, med_cycle = _sql_array(ss.DX_CODE_CYCLE), _sql_array(ss.MED_CYCLE)
    lab_case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ss.LAB_TEST_NAMES.items())
    return f"""
enc AS (
  SELECT o_orderkey AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id, o_orderdate AS encounter_ts
  FROM orders),
edx AS (
  SELECT l_orderkey AS encounter_id,
         CASE WHEN l_orderkey % {ss.DX_EVERY_NTH_ORDER} = 0
              THEN ({dx_cycle})[CAST(l_partkey % {len(ss.DX_CODE_CYCLE)} AS INTEGER) + 1]
              ELSE 'D' || CAST(l_partkey % {ss.DX_OTHER_CODES} AS VARCHAR) END AS code
  FROM lineitem),
diagnostic AS (
  SELECT patient_id, encounter_ts AS event_ts, code FROM edx JOIN enc USING (encounter_id)
  WHERE patient_id IS NOT NULL AND encounter_ts IS NOT NULL AND code IS NOT NULL),
medication AS (
  SELECT CAST(o_custkey AS VARCHAR) AS patient_id, l_shipdate AS event_ts,
         CASE WHEN o_orderkey % {ss.MED_ORDER_MOD} = {ss.MED_ORDER_REMAINDER}
              THEN ({med_cycle})[CAST(l_suppkey % {len(ss.MED_CYCLE)} AS INTEGER) + 1]
              ELSE 'M' || CAST(l_suppkey % {ss.MED_OTHER_CODES} AS VARCHAR) END AS medicine
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_shipdate IS NOT NULL),
lab AS (
  SELECT CAST(user_id AS VARCHAR) AS patient_id, ts AS event_ts,
         CASE event_type {lab_case} ELSE event_type END AS test_name,
         value * {ss.LAB_VALUE_SCALE} AS value
  FROM events
  WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL
    AND value IS NOT NULL AND NOT isnan(value))"""


def abnormal_sql(name: str = "test_name", value: str = "value") -> str:
    branches = " ".join(f"WHEN '{lab}' THEN {value} >= {thr}"
                        for lab, thr in rules.ABNORMAL_LAB_THRESHOLDS.items())
    return f"COALESCE((CASE lower({name}) {branches} ELSE false END) AND NOT isnan({value}), false)"


def rule_ctes() -> str:
    """The phenotype, rule by rule, as sets (the literal formulation)."""
    t1dx, t2dx = rules.sql_list(rules.T1DM_DX), rules.sql_list(rules.T2DM_DX)
    t1m, t2m = rules.sql_list(rules.T1DM_MED), rules.sql_list(rules.T2DM_MED)
    dmrel = rules.sql_list(rules.DM_RELATED_DX)
    return f"""
t2dx AS (SELECT DISTINCT patient_id FROM diagnostic WHERE code IN {t2dx} AND code NOT IN {t1dx}),
med1 AS (SELECT patient_id, MIN(event_ts) AS d FROM medication WHERE lower(medicine) IN {t1m} GROUP BY patient_id),
med2 AS (SELECT patient_id, MIN(event_ts) AS d FROM medication WHERE lower(medicine) IN {t2m} GROUP BY patient_id),
cond1 AS (SELECT patient_id FROM t2dx EXCEPT SELECT patient_id FROM med1),
cond2 AS ((SELECT patient_id FROM t2dx INTERSECT SELECT patient_id FROM med1) EXCEPT SELECT patient_id FROM med2),
before_ AS (SELECT med2.patient_id FROM med2 JOIN med1 ON med2.patient_id = med1.patient_id WHERE med2.d < med1.d),
cond3 AS (SELECT patient_id FROM t2dx INTERSECT SELECT patient_id FROM before_),
cases AS (SELECT patient_id FROM cond1 UNION SELECT patient_id FROM cond2 UNION SELECT patient_id FROM cond3),
normal_gl AS (SELECT DISTINCT patient_id FROM lab
              WHERE contains(lower(test_name), '{rules.GLUCOSE_MARKER}') AND NOT {abnormal_sql()}),
dm_related AS (SELECT DISTINCT patient_id FROM diagnostic
               WHERE code IN {dmrel} OR contains(code, '{rules.DM_CODE_MARKER}')),
controls AS (SELECT patient_id FROM normal_gl EXCEPT SELECT patient_id FROM dm_related
             EXCEPT SELECT patient_id FROM cases),
all_patients AS (SELECT patient_id FROM medication UNION SELECT patient_id FROM lab
                 UNION SELECT patient_id FROM diagnostic),
others AS (SELECT patient_id FROM all_patients EXCEPT SELECT patient_id FROM cases
           EXCEPT SELECT patient_id FROM controls),
labels AS (SELECT patient_id, 1 AS label FROM cases
           UNION ALL SELECT patient_id, 2 AS label FROM controls
           UNION ALL SELECT patient_id, 3 AS label FROM others)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(b.strip().rstrip(",") for b in blocks) + "\n" + body


def base(body: str) -> str:
    return with_ctes(adapter_ctes(), body=body)


def labelled(body: str) -> str:
    return with_ctes(adapter_ctes(), rule_ctes(), body=body)
