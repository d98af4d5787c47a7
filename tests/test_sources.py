"""CSV / text sources on small hand-written files (loader edge cases)."""
import datetime as dt

from phenolens.sources import candidates as ca
from phenolens.sources import csv as cs


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_infer_table_name():
    assert ca.infer_table_name("data/foo.csv") == "foo"
    assert ca.infer_table_name("data/foo") == "foo"
    assert ca.infer_table_name("data/foo.txt") == "txt"
    assert ca.infer_table_name("///") == "///"


def test_load_csv_as_table_registers_view(spark, tmp_path):
    p = write(tmp_path, "encounter_INPUT.csv", "Encounter_ID,Member_ID\ne1,m1\n")
    df = cs.load_csv_as_table(spark, p)
    assert dict(df.dtypes) == {"Encounter_ID": "string", "Member_ID": "string"}
    assert spark.table("encounter_INPUT").count() == 1


def test_columns_are_found_by_name(spark, tmp_path):
    p = write(tmp_path, "2010.csv", "b,a,c\n1,2,3\n")
    assert [r.asDict() for r in cs.load_csv_as_table(spark, p, columns=["a", "b"]).collect()] == [{"a": "2", "b": "1"}]
    assert spark.table("_2010").columns == ["a", "b"]


def test_rejected_rows_are_counted_by_reason(spark, tmp_path):
    write(tmp_path, cs.MEDICATION_FILE, "Member_ID,Order_Date,Drug_Name\nm,2010-01-01T10:00:00Z,x\n,bad,y\nm,2010-01-01,z\n")
    write(tmp_path, cs.LAB_FILE, "Member_ID,Date_Resulted,Result_Name,Numeric_Result\nm,2010-01-01T10:00:00Z,n,NaN\n")
    write(tmp_path, cs.DX_FILE, "Encounter_ID,code\ne,\n")
    write(tmp_path, cs.ENCOUNTER_FILE, "Encounter_ID,Member_ID,Encounter_DateTime\ne,m,2010-01-01T10:00:00Z\n")
    got = {(r["source"], r["reason"]): r["n_rows"] for r in cs.rejected_rows(spark, str(tmp_path)).collect()}
    assert got == {("medication", "patient"): 1, ("medication", "date"): 1, ("lab", "value"): 1, ("diagnostic", "name"): 1}


def test_lab_loader_drops_bad_rows(spark, tmp_path):
    p = write(tmp_path, "lab_results_INPUT.csv",
              "Member_ID,Date_Resulted,Result_Name,Numeric_Result\n"
              "m1,2010-01-01T10:00:00Z,Glucose,90\n"          # good
              "m2,2010-01-01T10:00:00-05,Glucose,95.5\n"      # offset date
              "m3,garbage,Glucose,90\n"                       # bad date
              "m4,,Glucose,90\n"                              # empty date
              "m5,2010-01-01T10:00:00Z,Glucose,\n"            # empty number
              "m6,2010-01-01T10:00:00Z,Glucose,NaN\n"         # NaN
              "m7,2010-01-01T10:00:00Z,Glucose,\"1,234\"\n")  # not a number
    got = {r["patient_id"]: (r["event_ts"], r["value"]) for r in cs.load_lab(spark, p).collect()}
    assert set(got) == {"m1", "m2"}
    assert got["m2"][1] == 95.5
    # -05 offset: 10:00 at UTC-5 is 15:00 UTC (session time zone is UTC)
    assert got["m2"][0] - got["m1"][0] == dt.timedelta(hours=5)


def test_medication_loader(spark, tmp_path):
    p = write(tmp_path, "medication_orders_INPUT.csv",
              "Member_ID,Order_Date,Drug_Name\nm1,2010-01-01T10:00:00Z,Metformin\nm2,bad,Lantus\n,2010-01-01T10:00:00Z,X\n")
    rows = cs.load_medication(spark, p).collect()
    assert [(r["patient_id"], r["medicine"]) for r in rows] == [("m1", "Metformin")]


def test_diagnostic_loader_joins_encounters(spark, tmp_path):
    dx = write(tmp_path, "encounter_dx_INPUT.csv", "Encounter_ID,code\ne1,250.00\ne2,401.9\ne9,V77.1\ne1,\n")
    enc = write(tmp_path, "encounter_INPUT.csv",
                "Encounter_ID,Member_ID,Encounter_DateTime\ne1,m1,2010-01-01T10:00:00Z\ne2,m2,2010-01-02T10:00:00Z\n")
    rows = sorted((r["patient_id"], r["code"]) for r in cs.load_diagnostic(spark, dx, enc).collect())
    assert rows == [("m1", "250.00"), ("m2", "401.9")]   # no encounter -> dropped; empty code -> dropped


def test_candidate_list_lowercased_not_trimmed(spark, tmp_path):
    p = write(tmp_path, "med_filter.txt", "Metformin\nmetformin\nGlucatrol \n")
    got = sorted(r["name"] for r in ca.load_candidate_list(spark, p).collect())
    assert got == ["glucatrol ", "metformin"]


def test_quarantine_holds_every_dropped_row(spark, tmp_path):
    write(tmp_path, cs.MEDICATION_FILE, "Member_ID,Order_Date,Drug_Name\nm,2010-01-01T10:00:00Z,x\n,bad,y\nm\nm,2010-01-01,z\n")
    write(tmp_path, cs.LAB_FILE, "Member_ID,Date_Resulted,Result_Name,Numeric_Result\n"
          "m,2010-01-01T10:00:00Z,n,\"1,2\"\nm,2010-01-01T10:00:00Z,n,5\nm,no,n,5,6\n")
    write(tmp_path, cs.DX_FILE, "Encounter_ID,code\ne,\ne,250.00\nlost,250.00\nf,401.9\n")
    write(tmp_path, cs.ENCOUNTER_FILE, "Encounter_ID,Member_ID,Encounter_DateTime\ne,m,2010-01-01T10:00:00Z\nf,,2010-01-01T10:00:00Z\n")
    got = {(r["source"], r["reason"], r["line"], r["row"]): r["file"] for r in cs.quarantine(spark, str(tmp_path)).collect()}
    assert set(got) == {
        ("medication", "patient", ",bad,y", 2), ("medication", "malformed", "m", 3), ("medication", "date", "m,2010-01-01,z", 4),
        ("lab", "value", "m,2010-01-01T10:00:00Z,n,\"1,2\"", 1), ("lab", "malformed", "m,no,n,5,6", 3),
        ("diagnostic", "name", "e,", 1), ("diagnostic", "orphan", "lost,250.00", 3), ("diagnostic", "patient", "f,401.9", 4),
        ("encounter", "patient", "f,,2010-01-01T10:00:00Z", 2)}
    assert all(f.startswith("file:") for f in got.values())
    counts = {(r["source"], r["reason"]): r["n_rows"] for r in cs.rejected_rows(spark, str(tmp_path)).collect()}
    assert counts[("diagnostic", "orphan")] == 1
