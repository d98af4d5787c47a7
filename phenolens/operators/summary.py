"""One aggregate of the events that carries both the label rules and the features.

Per (patient, domain, name): how often, the mean value, the first date and the
lowest value. The rules ask whether a patient has some row of a name, the
earliest date of a drug and whether some value stays below a threshold, so they
hold on these rows exactly as on the events; counts and means are the features.
A pass over the events (the join of the two biggest tables) then serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_summary(events: DataFrame) -> DataFrame:
    """(patient_id, domain, name, n, mean, first_ts, low), combined map-side.

    NULL and NaN values are never abnormal, so they count as the lowest."""
    value = F.col("value")
    low = F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)
    return events.groupBy("patient_id", "domain", "name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        F.min("event_ts").alias("first_ts"), F.min(low).alias("low"))


def as_events(summary: DataFrame) -> DataFrame:
    """The summary as an event log that the label rules read (``phenotype.label_events``)."""
    return summary.select("patient_id", "domain", F.col("first_ts").alias("event_ts"), "name",
                          F.col("low").alias("value"))


def as_tuples(summary: DataFrame) -> DataFrame:
    """The summary as feature tuples: counts of diagnoses and drugs, means of labs."""
    return summary.select("patient_id", "domain", F.col("name").alias("feature"),
                          F.when(F.col("domain") == "lab", F.col("mean"))
                          .otherwise(F.col("n").cast("double")).alias("value"))
