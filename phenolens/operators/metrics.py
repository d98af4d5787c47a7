"""Clustering quality: contingency table and purity.

purity = (1/N) * sum over clusters of the largest class count in the cluster.

Two partial aggregations (cluster x label counts, then max per cluster) and
one global sum; whole clusters are never shipped to one task, so a cluster
holding a third of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(assignments: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """A10 part 1: (cluster, label, n) counts."""
    return (assignments.groupBy(F.col(cluster_col).alias("cluster"), F.col(label_col).alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def purity(assignments: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> DataFrame:
    """One row (purity double, n_rows bigint). Empty input -> NULL purity."""
    per_cluster = (contingency(assignments, cluster_col, label_col)
                   .groupBy("cluster").agg(F.max("n").alias("best"), F.sum("n").alias("size")))
    return per_cluster.agg(
        (F.sum("best").cast("double") / F.sum("size").cast("double")).alias("purity"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("n_rows"))


def purity_value(assignments: DataFrame, cluster_col: str = "cluster", label_col: str = "label") -> float | None:
    """Driver-side scalar (one row) for reports and tests."""
    return purity(assignments, cluster_col, label_col).first()["purity"]
