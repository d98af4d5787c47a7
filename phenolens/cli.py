"""Command line: the purity report on a folder of clinical extracts.

    python -m phenolens.cli report --data data/ [--out report.parquet] [--rejects rejects.parquet] [--master local[8]]

The folder holds the four CSV extracts and the three candidate lists
(``sources.csv`` names them). Prints one line per feature set and algorithm
(5 decimals) and optionally writes the report table, and the rows that the loaders
drop with their reasons, as Parquet.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from phenolens.operators import phenotype as ph
from phenolens.operators.summary import event_summary
from phenolens.plans import evaluation as ev
from phenolens.session import materialize
from phenolens.sources import candidates as ca
from phenolens.sources import csv as cs

# FIXED VALUES: names in the printed report.
ALGORITHM_NAMES = {"kmeans": "kMeans", "gmm": "GMM", "streaming_kmeans": "StreamingKMeans", "nmf": "NMF"}
SET_NAMES = {"all": "All feature", "filtered": "Filtered feature"}


def report(spark: SparkSession, data_dir: str):
    # parse the CSVs once: labels and features both come from the summary
    medication, lab, diagnostic = cs.load_clinical_folder(spark, data_dir)
    d = data_dir.rstrip("/")
    candidates = {dom: ca.load_candidate_list(spark, f"{d}/{name}") for dom, name in cs.CANDIDATE_FILES.items()}
    summary = materialize(event_summary(ph.event_log(medication, lab, diagnostic)))
    out = ev.report_from_summary(summary, candidates)
    summary.unpersist()
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="phenolens")
    sub = parser.add_subparsers(dest="command", required=True)
    rep = sub.add_parser("report", help="cohort labels -> features -> clustering purity report")
    rep.add_argument("--data", required=True, help="folder with the clinical CSV extracts and candidate lists")
    rep.add_argument("--out", help="write the report table here as Parquet")
    rep.add_argument("--rejects", help="write every rejected row of the extracts here as Parquet")
    rep.add_argument("--master", help="Spark master (default: from the environment / spark-submit)")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("phenolens-report")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    if args.rejects:
        cs.quarantine(spark, args.data).write.mode("overwrite").parquet(args.rejects)
    table = report(spark, args.data)
    if args.out:
        table.write.mode("overwrite").parquet(args.out)
    for r in table.orderBy("feature_set", "algorithm").collect():
        print(f"[{SET_NAMES[r['feature_set']]}] purity of {ALGORITHM_NAMES[r['algorithm']]} is: {r['purity']:.5f}")


if __name__ == "__main__":
    main()
