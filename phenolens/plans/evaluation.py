"""Clustering evaluation (C3) and the purity report (C4).

    feature tuples -> dictionary + long matrix -> sparse rows
      -> standardise -> PCA(10)   (persisted, reused by 3 algorithms)
      -> k-means | Gaussian mixture | streaming k-means
    |abs(long matrix)| -> NMF (distributed) -> arg-max cluster
    every clustering JOIN labels ON patient_id -> purity

Nothing is paired by position: every row carries ``patient_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenolens.operators import clustering as cl
from phenolens.operators import features as fe
from phenolens.operators import metrics as me
from phenolens.operators import nmf
from phenolens.operators import reduce as rd
from phenolens.operators.indexing import dense_index
from phenolens.operators.phenotype import label_events
from phenolens.operators.summary import as_events, as_tuples
from phenolens.session import materialize, partitions_for
from phenolens.streaming import kmeans as sk

ALGORITHMS = ("kmeans", "gmm", "streaming_kmeans", "nmf")
NMF_K, NMF_MAX_ITERATIONS, NMF_TOL = 3, 100, 1e-4   # FIXED VALUES of the NMF run
STREAM_BATCHES = 4            # micro-batches of the replayed stream, dealt by patient


@dataclass
class ClusteringInputs:
    long: DataFrame          # (patient_id, feature_id, value), from the kept rows
    dictionary: DataFrame    # (domain, feature, feature_id)
    n_features: int
    reduced: DataFrame | None   # (patient_id, pca); None if there is nothing to reduce
    rows: DataFrame          # (patient_id, ids, vals), kept: dealt by patient and sorted
    n_entries: int

    def release(self) -> None:
        for df in (self.rows, self.dictionary, self.reduced):
            if df is not None:
                df.unpersist()


def feature_inputs(tuples: DataFrame) -> ClusteringInputs:
    """The feature matrix alone, which is all that NMF needs: one row of sorted entries per patient, kept in memory.

    Rows are dealt by patient into partitions whose number follows from the
    matrix's entries alone and sorted in them."""
    own = not tuples.is_cached
    entries, dictionary, n = fe.feature_matrix(tuples)
    n_entries = tuples.count()   # each tuple's key is in the dictionary
    rows = materialize(fe.sparse_feature_arrays(entries).repartition(partitions_for(n_entries), "patient_id")
                       .sortWithinPartitions("patient_id"))
    long = rows.select("patient_id", F.explode(F.arrays_zip("ids", "vals")).alias("e")).select(
        "patient_id", F.col("e.ids").alias("feature_id"), F.col("e.vals").alias("value"))
    if own:
        tuples.unpersist()
    return ClusteringInputs(long=long, dictionary=dictionary, n_features=n, reduced=None, rows=rows, n_entries=n_entries)


def prepare(tuples: DataFrame, sparse: bool = True) -> ClusteringInputs:
    """Feature matrix -> standardised -> 10 principal components, keyed by patient_id.

    ``sparse=True`` (default) keeps patient rows sparse end to end and holds
    features x components (``reduce.sparse_pca``); ``sparse=False`` densifies to the
    dictionary width and fits the library's models, as the textbook formulation
    does. Both give the same components up to the sign of each principal axis.

    Rows lie as ``feature_inputs`` dealt them: fits that sample per partition then give
    the same model on any number of cores.
    """
    inputs = feature_inputs(tuples)
    n = inputs.n_features
    if not n:
        return inputs
    if sparse:
        reduced, _ = rd.sparse_pca(inputs.rows, rd.column_stats(inputs.long, inputs.rows.count(), n))
        inputs.reduced = materialize(reduced.select("patient_id", "pca"))
    else:
        rows = materialize(fe.dense_feature_vectors(inputs.long, n).repartition(inputs.rows.rdd.getNumPartitions(), "patient_id")
                           .sortWithinPartitions("patient_id"))
        reduced, _ = rd.principal_components(rd.standardize(rows)[0], n)
        inputs.reduced = materialize(reduced.select("patient_id", "pca"))
        rows.unpersist()
    return inputs


def kmeans_clusters(inputs: ClusteringInputs) -> DataFrame:
    return cl.kmeans_assign(inputs.reduced)


def gmm_clusters(inputs: ClusteringInputs) -> DataFrame:
    return cl.gmm_assign(inputs.reduced)


def streaming_kmeans_clusters(inputs: ClusteringInputs, batches: int = STREAM_BATCHES) -> DataFrame:
    spark = inputs.reduced.sparkSession
    arr = inputs.reduced.select("patient_id", vector_to_array("pca").alias("x"))
    dim = len(arr.first()["x"]) if inputs.n_features else sk.DIM
    batch = F.pmod(F.xxhash64("patient_id"), F.lit(batches)).cast("int")
    schema = T.StructType([T.StructField("patient_id", T.StringType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])
    start = sk.random_centers(spark, k=sk.K, dim=dim, weight=sk.START_WEIGHT, seed=sk.SEED)
    state = sk.replay(arr, batch, batches, schema, "x", start, decay=sk.DECAY)
    return sk.assign(arr, "x", state).select("patient_id", "cluster")


def row_numbers(inputs: ClusteringInputs) -> DataFrame:
    """(patient_id, row_id): the patients numbered in their order."""
    return dense_index(inputs.rows.select("patient_id"), ["patient_id"], "row_id")


def nmf_input(inputs: ClusteringInputs) -> tuple[DataFrame, DataFrame]:
    """V = |features| keyed by dense ids: (row_id, col_id, value) and the id map (patient_id, row_id)."""
    rid = row_numbers(inputs)
    v = (fe.abs_features(inputs.long).join(rid, "patient_id")
         .select("row_id", F.col("feature_id").alias("col_id"), "value"))
    return v, rid


def nmf_fit(inputs: ClusteringInputs, k: int, max_iterations: int, tol: float, seed: int = cl.SEED):
    """(factors, id map): NMF of ``nmf_input``'s V, whose rows stay whole: a row is joined with its number and dealt by it."""
    rid = row_numbers(inputs)
    sq = inputs.long.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0
    rows = inputs.rows.join(rid, "patient_id").select("row_id", "ids", F.transform("vals", lambda x: F.abs(x)).alias("vals"))
    blocks = nmf.lay_out_rows(rows, inputs.n_entries)
    return nmf.factorise(blocks, sq, inputs.n_features, k, max_iterations, tol, seed), rid


def nmf_clusters(inputs: ClusteringInputs, k: int = NMF_K, max_iterations: int = NMF_MAX_ITERATIONS,
                 tol: float = NMF_TOL):
    res, rid = nmf_fit(inputs, k, max_iterations, tol)
    clusters = nmf.assign_clusters(res.w).join(rid, "row_id").select("patient_id", "cluster")
    return clusters, res


def cluster_all(inputs: ClusteringInputs, algorithms=ALGORITHMS) -> dict[str, DataFrame]:
    out = {}
    for alg in algorithms:
        if alg == "kmeans":
            out[alg] = kmeans_clusters(inputs)
        elif alg == "gmm":
            out[alg] = gmm_clusters(inputs)
        elif alg == "streaming_kmeans":
            out[alg] = streaming_kmeans_clusters(inputs)
        elif alg == "nmf":
            out[alg] = nmf_clusters(inputs)[0]
        else:
            raise ValueError(alg)
    return out


def purity_against(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """J3/J4 + A10: join by patient id (inner), then purity."""
    return me.purity(clusters.join(labels, "patient_id", "inner"))


def evaluate(labels: DataFrame, tuples: DataFrame, algorithms=ALGORITHMS) -> DataFrame:
    """(algorithm, purity, n_rows), one row per algorithm.

    Without any feature there is nothing to cluster: NULL purity, 0 rows. The
    rows (one per algorithm) are computed here, so that what the fits keep in
    memory can be released."""
    spark = labels.sparkSession
    inputs = prepare(tuples)
    rows = [(alg, None, 0) for alg in algorithms]
    if inputs.n_features:
        rows = [(alg, *purity_against(clusters, labels).select("purity", "n_rows").first())
                for alg, clusters in cluster_all(inputs, algorithms).items()]
    inputs.release()
    return spark.createDataFrame(rows, "algorithm string, purity double, n_rows long")


def report(labels: DataFrame, all_tuples: DataFrame, filtered_tuples: DataFrame,
           algorithms=ALGORITHMS) -> DataFrame:
    """C4/K2: (feature_set, algorithm, purity, n_rows) for all and for filtered features."""
    labels = materialize(labels)
    a = evaluate(labels, all_tuples, algorithms).select(F.lit("all").alias("feature_set"), "*")
    b = evaluate(labels, filtered_tuples, algorithms).select(F.lit("filtered").alias("feature_set"), "*")
    labels.unpersist()
    return a.unionByName(b).select("feature_set", "algorithm", F.round("purity", 5).alias("purity"), "n_rows")


def report_from_summary(summary: DataFrame, candidates: dict, algorithms=ALGORITHMS) -> DataFrame:
    """The report from one event summary: labels, all features, and those on the candidate lists."""
    tuples = as_tuples(summary)
    return report(label_events(as_events(summary)), tuples, fe.filter_tuples(tuples, candidates, normalize="lower"),
                  algorithms)
