"""Cleaned clinical tables, staged once as bucketed tables (storage-partitioned).

Encounters and their diagnosis codes are bucketed by encounter, so the join of the
two (J1) needs no exchange; the events of all three kinds are summarised per
(patient, domain, name) and bucketed by patient, so labelling (C1) and the
features read them without one. What is staged per key is bounded: codes are
counted per encounter, events per patient and name, so a key that holds a third of
all rows makes no large bucket.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.operators.phenotype import label_events
from phenolens.operators.summary import as_events, as_tuples, event_summary
from phenolens.session import partitions_for, scratch_path


@dataclass
class Staged:
    """Names of the staged tables in the session's catalog."""
    spark: SparkSession
    encounter: str       # (encounter_id, patient_id, event_ts), bucketed by encounter_id
    encounter_dx: str    # (encounter_id, code, n), bucketed by encounter_id
    summary: str         # (patient_id, domain, name, n, mean, first_ts, low), bucketed by patient_id

    def diagnostic(self) -> DataFrame:
        """(patient_id, event_ts, code), a row for each diagnosis row; joined bucket by bucket."""
        joined = self.spark.table(self.encounter_dx).join(self.spark.table(self.encounter), "encounter_id")
        return joined.select("patient_id", "event_ts", "code", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
            "patient_id", "event_ts", "code")

    def labels(self, strict: bool = False) -> DataFrame:
        """C1 from the staged events: (patient_id, label)."""
        return label_events(as_events(self.spark.table(self.summary)), strict=strict)

    def tuples(self) -> DataFrame:
        """A1-A6 from the staged events: (patient_id, domain, feature, value)."""
        return as_tuples(self.spark.table(self.summary))

    def drop(self) -> None:
        """Forget the tables; their files stay where they were staged."""
        for name in (self.encounter, self.encounter_dx, self.summary):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """Write ``df`` as a table of ``buckets`` files, one per bucket of ``key`` and sorted by it."""
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(name))


def stage(encounter: DataFrame, encounter_dx: DataFrame, medication: DataFrame, lab: DataFrame,
          path: str | None = None, name: str | None = None, buckets: int | None = None) -> Staged:
    """Stage cleaned tables: encounter (encounter_id, patient_id, event_ts), encounter_dx (encounter_id, code),
    medication (patient_id, event_ts, medicine) and lab (patient_id, event_ts, test_name, value).

    Rows with a null in these columns are left out, as by the loaders. ``path`` (default: a fresh folder under the
    shared checkpoint dir) takes the files; the number of buckets follows from the rows unless given.
    """
    spark = encounter.sparkSession
    base = path or scratch_path(spark, "staged")
    name = name or f"staged_{uuid.uuid4().hex[:12]}"
    encounter = encounter.select("encounter_id", "patient_id", "event_ts").na.drop()
    codes = (encounter_dx.select("encounter_id", "code").na.drop().groupBy("encounter_id", "code")
             .agg(F.count(F.lit(1)).alias("n")))
    n = buckets or partitions_for(encounter.count())
    out = Staged(spark, f"{name}_encounter", f"{name}_encounter_dx", f"{name}_summary")
    write_bucketed(encounter, out.encounter, "encounter_id", n, f"{base}/encounter")
    write_bucketed(codes, out.encounter_dx, "encounter_id", n, f"{base}/encounter_dx")
    nothing = F.lit(None).cast("double")
    events = (out.diagnostic().select("patient_id", F.lit("dx").alias("domain"), "event_ts", F.col("code").alias("name"),
                                      nothing.alias("value"))
              .unionByName(medication.select("patient_id", F.lit("med").alias("domain"), "event_ts",
                                             F.col("medicine").alias("name"), nothing.alias("value")).na.drop(
                  subset=["patient_id", "event_ts", "name"]))
              .unionByName(lab.select("patient_id", F.lit("lab").alias("domain"), "event_ts",
                                      F.col("test_name").alias("name"), "value").na.drop()))
    write_bucketed(event_summary(events), out.summary, "patient_id", n, f"{base}/summary")
    return out
