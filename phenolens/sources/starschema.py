"""Adapter: the driver's TPC-H-ish Parquet tables read as clinical events.

    encounter     <- orders    (o_orderkey, o_custkey, o_orderdate)
    encounter_dx  <- lineitem  (l_orderkey, code derived from l_partkey)
    medication    <- lineitem JOIN orders (patient o_custkey, ts l_shipdate,
                     medicine derived from o_orderkey / l_suppkey)
    lab           <- events    (user_id, ts, event_type -> test name, value*10)

Every row of every source table is kept; the derivations are plain column
expressions so the Parquet scans only read the columns named here
(``ReadSchema`` in the plan) and the whole adapter stays in codegen.
Patient ids are strings, as in the clinical data model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.sources.tables import read_table

# ---------------------------------------------------------------------------
# FIXED VALUES of the adapter (must match the SQL oracle exactly).
# ---------------------------------------------------------------------------
DX_CODE_CYCLE = ["250.00", "250.02", "250.01", "250.3", "790.21", "V77.1", "401.9", "272.4"]
DX_EVERY_NTH_ORDER = 16     # orders with o_orderkey % 16 = 0 carry a coded diagnosis
DX_OTHER_CODES = 40         # other orders: 'D' || l_partkey % 40
MED_CYCLE = ["Metformin", "Lantus", "glipizide", "Insulin NPH", "Aspirin", "Lisinopril",
             "Atorvastatin", "Omeprazole"]
MED_ORDER_MOD, MED_ORDER_REMAINDER = 4, 1   # orders with o_orderkey % 4 = 1 use MED_CYCLE
MED_OTHER_CODES = 10        # other orders: 'M' || l_suppkey % 10
LAB_TEST_NAMES = {"click": "Glucose", "view": "Fasting Glucose", "purchase": "HbA1c"}
LAB_VALUE_SCALE = 10.0
# Rows of lineitem that a partition of the event log is dealt, and hash buckets per partition by which keys are found heavy.
PART_ROWS, BUCKETS = 250_000, 16
# ---------------------------------------------------------------------------


def _cycle_pick(values: list[str], key: Column) -> Column:
    n = len(values)
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % n + 1).cast("int"))


def dx_code(orderkey: Column, partkey: Column) -> Column:
    return F.when(orderkey % DX_EVERY_NTH_ORDER == 0, _cycle_pick(DX_CODE_CYCLE, partkey)) \
        .otherwise(F.concat(F.lit("D"), (partkey % DX_OTHER_CODES).cast("string")))


def med_name(orderkey: Column, suppkey: Column) -> Column:
    return F.when(orderkey % MED_ORDER_MOD == MED_ORDER_REMAINDER, _cycle_pick(MED_CYCLE, suppkey)) \
        .otherwise(F.concat(F.lit("M"), (suppkey % MED_OTHER_CODES).cast("string")))


def lab_test_name(event_type: Column) -> Column:
    expr = event_type
    for kind, name in reversed(list(LAB_TEST_NAMES.items())):
        expr = F.when(event_type == F.lit(kind), F.lit(name)).otherwise(expr)
    return expr


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderdate").alias("encounter_ts"))


def encounter_dx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").select(
        F.col("l_orderkey").alias("encounter_id"),
        dx_code(F.col("l_orderkey"), F.col("l_partkey")).alias("code"))


def diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostic events: encounter_dx JOIN encounter on the encounter id."""
    dx = encounter_dx(spark, sf_dir)
    enc = encounters(spark, sf_dir)
    return (dx.join(enc, "encounter_id", "inner")
            .select("patient_id", F.col("encounter_ts").alias("event_ts"), "code")
            .na.drop(subset=["patient_id", "event_ts", "code"]))


def medication(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .select(F.col("o_custkey").cast("string").alias("patient_id"),
                    F.col("l_shipdate").alias("event_ts"),
                    med_name(F.col("o_orderkey"), F.col("l_suppkey")).alias("medicine"))
            .na.drop(subset=["patient_id", "event_ts"]))


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    return (ev.select(F.col("user_id").cast("string").alias("patient_id"),
                      F.col("ts").alias("event_ts"),
                      lab_test_name(F.col("event_type")).alias("test_name"),
                      (F.col("value") * F.lit(LAB_VALUE_SCALE)).alias("value"))
            .na.drop())


def event_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the event log, from its rows alone: the memory of a task stays the same however large the tables are."""
    rows = max(read_table(spark, sf_dir, "lineitem").count(), read_table(spark, sf_dir, "events").count())
    return max(1, -(-rows // PART_ROWS))


def _even(df: DataFrame, key: str, partitions: int) -> bool:
    """Whether no key has more rows than a partition is dealt: the rows of the fullest hash bucket, from one narrow scan."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.pmod(F.xxhash64(key), F.lit(partitions * BUCKETS)).alias("b")).count()
    return (counts.agg(F.max("count")).first()[0] or 0) <= PART_ROWS


def _dealt(spark: SparkSession, sf_dir: str) -> bool:
    """Whether the log is large enough to be dealt by order, and no order too heavy for that."""
    parts = event_partitions(spark, sf_dir)
    return parts > 1 and all(_even(read_table(spark, sf_dir, t), key, parts)
                             for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")))


def clinical_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three event kinds as one tagged log from ONE lineitem-orders join.

    Diagnosis and medication both need lineitem JOIN orders on the order key;
    joining once and emitting two tagged rows per joined line halves the
    shuffle of the biggest table compared with unioning the two frames.
    Both sides are dealt by order into as many partitions as their rows ask for; with a heavy
    order key the join is left to AQE, which cuts skewed partitions.
    Columns: patient_id, domain ('dx' | 'med' | 'lab'), event_ts, name, value.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if _dealt(spark, sf_dir):
        parts = event_partitions(spark, sf_dir)
        li, o = li.repartition(parts, "l_orderkey"), o.repartition(parts, "o_orderkey")
    joined = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    null_value = F.lit(None).cast("double")
    pair = F.array(
        F.struct(F.lit("dx").alias("domain"), F.col("o_orderdate").alias("event_ts"),
                 dx_code(F.col("l_orderkey"), F.col("l_partkey")).alias("name"), null_value.alias("value")),
        F.struct(F.lit("med").alias("domain"), F.col("l_shipdate").alias("event_ts"),
                 med_name(F.col("o_orderkey"), F.col("l_suppkey")).alias("name"), null_value.alias("value")),
    )
    enc = (joined.select(F.col("o_custkey").cast("string").alias("patient_id"), F.inline(pair))
           .where(F.col("patient_id").isNotNull() & F.col("event_ts").isNotNull() & F.col("name").isNotNull()))
    labs = lab(spark, sf_dir).select("patient_id", F.lit("lab").alias("domain"), "event_ts",
                                     F.col("test_name").alias("name"), "value")
    return enc.unionByName(labs)


def events_by_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clinical_event_log`` dealt by patient into as many partitions as its rows ask for, so that what is grouped
    by patient and name needs no exchange, and a task's groups are bounded. Where some patient has very many orders or
    labs the log stays as it is, and aggregates combine its rows before their own exchange."""
    log, parts = clinical_event_log(spark, sf_dir), event_partitions(spark, sf_dir)
    heavy = parts == 1 or not all(_even(read_table(spark, sf_dir, t), key, parts)
                                  for t, key in (("orders", "o_custkey"), ("events", "user_id")))
    return log if heavy else log.repartition(parts, "patient_id")
