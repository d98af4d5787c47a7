"""End to end from clinical CSV extracts (exported from the sf0.001 adapter tables)."""
from pyspark.sql import functions as F

from phenolens import cli
from phenolens.operators import phenotype as ph
from phenolens.sources import csv as cs
from phenolens.sources import starschema as ss

from conftest import SF

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _write_csv(df, path):
    df.toPandas().to_csv(path, index=False)


def test_report_from_csv_folder(spark, tmp_path):
    d = SF["0.001"]
    enc = ss.encounters(spark, d).select(F.col("encounter_id").cast("string").alias("Encounter_ID"),
                                         F.col("patient_id").alias("Member_ID"),
                                         F.date_format("encounter_ts", ISO).alias("Encounter_DateTime"))
    dx = ss.encounter_dx(spark, d).select(F.col("encounter_id").cast("string").alias("Encounter_ID"), "code")
    med = ss.medication(spark, d).select(F.col("patient_id").alias("Member_ID"),
                                         F.date_format("event_ts", ISO).alias("Order_Date"),
                                         F.col("medicine").alias("Drug_Name"))
    lab = ss.lab(spark, d).select(F.col("patient_id").alias("Member_ID"),
                                  F.date_format("event_ts", ISO).alias("Date_Resulted"),
                                  F.col("test_name").alias("Result_Name"),
                                  F.col("value").cast("string").alias("Numeric_Result"))
    for df, name in [(enc, cs.ENCOUNTER_FILE), (dx, cs.DX_FILE), (med, cs.MEDICATION_FILE), (lab, cs.LAB_FILE)]:
        _write_csv(df, tmp_path / name)
    (tmp_path / "med_filter.txt").write_text("Metformin\nLantus\nglipizide\n")
    (tmp_path / "lab_filter.txt").write_text("glucose\nfasting glucose\nhba1c\n")
    (tmp_path / "icd9_filter.txt").write_text("250.00\n250.02\n250.01\n250.3\n790.21\nv77.1\n")

    m, lb, dg = cs.load_clinical_folder(spark, str(tmp_path))
    counts = {r["label"]: r["n_patients"] for r in ph.label_counts(ph.label_cohort(m, lb, dg)).collect()}
    assert counts == {1: 29, 2: 7, 3: 114}

    rows = cli.report(spark, str(tmp_path)).collect()
    assert len(rows) == 8
    assert all(0 < r["purity"] <= 1 for r in rows)
    assert {r["feature_set"] for r in rows} == {"all", "filtered"}


def test_report_writes_its_table_and_the_rejects(spark, tmp_path, monkeypatch, capsys):
    for name, text in ((cs.MEDICATION_FILE, "Member_ID,Order_Date,Drug_Name\nm,2010-01-01T10:00:00Z,x\nm,bad,y\n"),
                       (cs.LAB_FILE, "Member_ID,Date_Resulted,Result_Name,Numeric_Result\n"),
                       (cs.DX_FILE, "Encounter_ID,code\nlost,250.00\n"),
                       (cs.ENCOUNTER_FILE, "Encounter_ID,Member_ID,Encounter_DateTime\n")):
        (tmp_path / name).write_text(text)
    table = spark.createDataFrame([("all", "nmf", 0.5, 1)], "feature_set string, algorithm string, purity double, n_rows long")
    monkeypatch.setattr(cli, "report", lambda *_: table)
    cli.main(["report", "--data", str(tmp_path), "--out", str(tmp_path / "out"), "--rejects", str(tmp_path / "rejects")])
    assert capsys.readouterr().out == "[All feature] purity of NMF is: 0.50000\n"
    assert spark.read.parquet(str(tmp_path / "out")).collect() == table.collect()
    got = {(r["source"], r["reason"], r["line"]) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert got == {("medication", "date", "m,bad,y"), ("diagnostic", "orphan", "lost,250.00")}
