"""Clinical CSV sources (S1–S5): header CSVs -> typed event DataFrames.

All CSV columns are read as strings (no schema inference); typing happens
in explicit, ANSI-safe casts: ``try_cast`` for numbers and
``try_to_timestamp`` for dates, so a bad value becomes NULL and the row is
dropped instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolens.operators.joins import join_small
from phenolens.sources.candidates import view_name

# FIXED VALUE: date layout of the clinical extracts (ISO date-time with offset).
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"


def load_csv_as_table(spark: SparkSession, path: str, table_name: str | None = None,
                      columns: list[str] | None = None) -> DataFrame:
    """Read a header CSV with every column as string, register a temp view.

    ``columns`` names the columns to keep, found by their names in the header;
    otherwise all are used. All-string either way (no inference pass over the data).
    """
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    df.createOrReplaceTempView(table_name or view_name(path))
    return df


def parse_ts(col: str):
    return F.try_to_timestamp(F.col(col), F.lit(DATE_FORMAT))


# FIXED VALUES: column names of the clinical extracts.
MEDICATION_COLUMNS = ["Member_ID", "Order_Date", "Drug_Name"]
LAB_COLUMNS = ["Member_ID", "Date_Resulted", "Result_Name", "Numeric_Result"]
DX_COLUMNS = ["Encounter_ID", "code"]
ENCOUNTER_COLUMNS = ["Encounter_ID", "Member_ID", "Encounter_DateTime"]


def _typed_medication(t: DataFrame, *carried: str) -> DataFrame:
    """Typed rows with ``reason``: why a row is rejected, or null. ``carried`` columns go along."""
    return t.select(F.col("Member_ID").alias("patient_id"), parse_ts("Order_Date").alias("event_ts"),
                    F.col("Drug_Name").alias("medicine"), *carried).withColumn(
        "reason", F.when(F.col("patient_id").isNull(), "patient").when(F.col("event_ts").isNull(), "date"))


def _typed_lab(t: DataFrame, *carried: str) -> DataFrame:
    number = F.expr("try_cast(Numeric_Result AS DOUBLE)")
    return t.select(F.col("Member_ID").alias("patient_id"), parse_ts("Date_Resulted").alias("event_ts"),
                    F.col("Result_Name").alias("test_name"), number.alias("value"), *carried).withColumn(
        "reason", F.when(F.col("patient_id").isNull(), "patient").when(F.col("event_ts").isNull(), "date")
        .when(F.col("test_name").isNull(), "name").when(F.col("value").isNull() | F.isnan("value"), "value"))


def _typed_diagnostic(dx: DataFrame, enc: DataFrame, how: str = "inner", *carried: str) -> DataFrame:
    """Diagnoses with their encounters; by a left join also those without one, which are orphans."""
    known = enc.select("Encounter_ID", "Member_ID", "Encounter_DateTime", F.lit(True).alias("_known"))
    return dx.join(known, "Encounter_ID", how).select(
        F.col("Member_ID").alias("patient_id"), parse_ts("Encounter_DateTime").alias("event_ts"), "code", "_known",
        *carried).withColumn(
        "reason", F.when(F.col("_known").isNull(), "orphan").when(F.col("patient_id").isNull(), "patient")
        .when(F.col("event_ts").isNull(), "date").when(F.col("code").isNull(), "name")).drop("_known")


def _accepted(typed: DataFrame) -> DataFrame:
    return typed.where("reason IS NULL").drop("reason")


def load_medication(spark: SparkSession, path: str, table_name: str = "medication_orders") -> DataFrame:
    """S3: (Member_ID, Order_Date, Drug_Name) -> (patient_id, event_ts, medicine).

    Rows whose id or date is missing/unparseable are dropped; ``rejected_rows`` counts them.
    """
    return _accepted(_typed_medication(load_csv_as_table(spark, path, table_name, MEDICATION_COLUMNS)))


def load_lab(spark: SparkSession, path: str, table_name: str = "lab_results") -> DataFrame:
    """(Member_ID, Date_Resulted, Result_Name, Numeric_Result) -> typed lab rows.

    Rows with a null in any read column, or a value that is not a number
    (empty, ``NaN``, ``"1,234"``) are dropped; ``rejected_rows`` counts them.
    """
    return _accepted(_typed_lab(load_csv_as_table(spark, path, table_name, LAB_COLUMNS)))


def load_diagnostic(spark: SparkSession, dx_path: str, encounter_path: str,
                    dx_table: str = "encounter_dx", encounter_table: str = "encounter") -> DataFrame:
    """encounter_dx JOIN encounter on Encounter_ID -> (patient_id, event_ts, code)."""
    return _accepted(_typed_diagnostic(load_csv_as_table(spark, dx_path, dx_table, DX_COLUMNS),
                                       load_csv_as_table(spark, encounter_path, encounter_table, ENCOUNTER_COLUMNS)))


def rejected_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """(source, reason, n_rows): the rows of a folder's extracts that the loaders drop, by the first reason."""
    d = data_dir.rstrip("/")
    typed = {"medication": _typed_medication(load_csv_as_table(spark, f"{d}/{MEDICATION_FILE}", "medication_orders",
                                                               MEDICATION_COLUMNS)),
             "lab": _typed_lab(load_csv_as_table(spark, f"{d}/{LAB_FILE}", "lab_results", LAB_COLUMNS)),
             "diagnostic": _typed_diagnostic(
                 load_csv_as_table(spark, f"{d}/{DX_FILE}", "encounter_dx", DX_COLUMNS),
                 load_csv_as_table(spark, f"{d}/{ENCOUNTER_FILE}", "encounter", ENCOUNTER_COLUMNS), "left")}
    out = None
    for source, frame in typed.items():
        part = frame.where("reason IS NOT NULL").select(F.lit(source).alias("source"), "reason")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("source", "reason").agg(F.count("*").alias("n_rows"))


#: Columns that tell where a row was read: the raw line if it has too few or too many fields, file, place in it.
ORIGIN = ("_line", "_file", "_block", "_order")


def read_with_origin(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a header CSV as strings, with ``ORIGIN``; the header is that of the largest file.

    Every field of a line is parsed, as a line's number of fields tells whether it is malformed."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
          .option("columnNameOfCorruptRecord", "_line").csv(path))
    return df.select(*[F.col(f"`{c}`") for c in columns], "_line", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_order"))


def quarantine(spark: SparkSession, data_dir: str) -> DataFrame:
    """(source, reason, line, file, block, row): every row of a folder's extracts that the loaders drop.

    The reason is ``malformed`` for a line with too few or too many fields, ``orphan`` for a diagnosis whose
    encounter isn't there, and else the column that is missing or can't be read. ``line`` is the raw line if it
    is malformed, or the read columns as CSV; ``row`` counts the lines of the file's block (a block starts at
    byte ``block``) without the header. Nothing is collected: the table can be written and loaded again once mended.
    """
    d = data_dir.rstrip("/")
    files = {"medication": (MEDICATION_FILE, MEDICATION_COLUMNS), "lab": (LAB_FILE, LAB_COLUMNS),
             "diagnostic": (DX_FILE, DX_COLUMNS), "encounter": (ENCOUNTER_FILE, ENCOUNTER_COLUMNS)}
    raw, firsts = {}, {}
    for source, (name, columns) in files.items():
        read = read_with_origin(spark, f"{d}/{name}", columns)
        firsts[source] = read.groupBy("_file", "_block").agg(F.min("_order").alias("_first"))
        text = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]))
        raw[source] = read.withColumn("_text", F.coalesce("_line", text))
    carried = [*ORIGIN, "_text"]
    enc = raw["encounter"]
    rejected = {
        "medication": _typed_medication(raw["medication"], *carried), "lab": _typed_lab(raw["lab"], *carried),
        "diagnostic": _typed_diagnostic(raw["diagnostic"], enc, "left", *carried),
        "encounter": enc.withColumn("reason", F.when(F.col("Encounter_ID").isNull(), "encounter")
                                    .when(F.col("Member_ID").isNull(), "patient")
                                    .when(parse_ts("Encounter_DateTime").isNull(), "date"))}
    out = None
    for source, frame in rejected.items():
        part = join_small(frame.where("reason IS NOT NULL").select("reason", *carried), firsts[source],
                          ["_file", "_block"]).select(
            F.lit(source).alias("source"), F.when(F.col("_line").isNotNull(), "malformed").otherwise(F.col("reason")).alias("reason"),
            F.col("_text").alias("line"), F.col("_file").alias("file"), F.col("_block").alias("block"),
            (F.col("_order") - F.col("_first") + 1).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


# FIXED VALUES: file names of a clinical extract folder.
MEDICATION_FILE = "medication_orders_INPUT.csv"
LAB_FILE = "lab_results_INPUT.csv"
DX_FILE = "encounter_dx_INPUT.csv"
ENCOUNTER_FILE = "encounter_INPUT.csv"
CANDIDATE_FILES = {"med": "med_filter.txt", "lab": "lab_filter.txt", "dx": "icd9_filter.txt"}


def load_clinical_folder(spark: SparkSession, data_dir: str):
    """S3–S5 on a folder holding the four extracts -> (medication, lab, diagnostic)."""
    d = data_dir.rstrip("/")
    return (load_medication(spark, f"{d}/{MEDICATION_FILE}"),
            load_lab(spark, f"{d}/{LAB_FILE}"),
            load_diagnostic(spark, f"{d}/{DX_FILE}", f"{d}/{ENCOUNTER_FILE}"))
