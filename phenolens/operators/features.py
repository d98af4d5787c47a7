"""Feature construction: events -> long (patient, feature, value) -> vectors.

Long form is the primary representation; it is what every downstream
operator (scaling, NMF, purity) consumes and it stays distributed by
patient. Vectors are only assembled at the ML boundary.

Scale notes
- A1–A6 are ``groupBy(patient, name)`` with count/avg: partial aggregation
  map-side, so a hot patient or hot code is combined before the shuffle.
- Candidate lists (F8) are joined as a plain ``left_semi``: AQE broadcasts the
  list if its measured size allows.
- Per-patient vectors are bounded by the dictionary size (one entry per
  (patient, feature) after aggregation), never by the raw event count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.operators.indexing import dense_index
from phenolens.operators.joins import join_small
from phenolens.operators.summary import as_tuples, event_summary
from phenolens.session import materialize

Candidates = DataFrame | list[str] | set[str] | tuple[str, ...] | None


def _key(col: Column, normalize: str | None) -> Column:
    if normalize is None:
        return col
    if normalize == "lower":
        return F.lower(col)
    raise ValueError(f"unknown normalize={normalize!r}")


def filter_candidates(df: DataFrame, name_col: str, candidates: Candidates,
                      normalize: str | None = None) -> DataFrame:
    """F8: keep rows whose ``name_col`` is in the candidate list.

    Exact match by default (candidate lists are lower-cased on load, event
    names are not, so mixed-case names only match with ``normalize='lower'``).
    ``candidates`` is either a short Python collection (``isin`` -> InSet) or
    a one-column DataFrame ``name`` (``left_semi``).
    """
    if candidates is None:
        return df
    key = _key(F.col(name_col), normalize)
    if isinstance(candidates, DataFrame):
        cand = candidates.select(F.col(candidates.columns[0]).alias("_cand")).distinct()
        keyed = df.withColumn("_key", key)
        # no hint and no count, which would derive the list twice: AQE broadcasts it by its measured size
        return keyed.join(cand, keyed["_key"] == cand["_cand"], "left_semi").drop("_key")
    return df.where(key.isin(list(dict.fromkeys(candidates))))


def _count_features(df: DataFrame, name_col: str) -> DataFrame:
    return (df.groupBy("patient_id", F.col(name_col).alias("feature"))
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def diagnostic_feature_counts(diagnostic: DataFrame, candidates: Candidates = None,
                              normalize: str | None = None) -> DataFrame:
    """A1/A2: number of diagnosis rows per (patient, code), as double."""
    return _count_features(filter_candidates(diagnostic, "code", candidates, normalize), "code")


def medication_feature_counts(medication: DataFrame, candidates: Candidates = None,
                              normalize: str | None = None) -> DataFrame:
    """A3/A4: number of medication rows per (patient, medicine), as double."""
    return _count_features(filter_candidates(medication, "medicine", candidates, normalize), "medicine")


def lab_feature_means(lab: DataFrame, candidates: Candidates = None,
                      normalize: str | None = None) -> DataFrame:
    """Mean lab value per (patient, test name)."""
    lab = filter_candidates(lab, "test_name", candidates, normalize)
    return (lab.groupBy("patient_id", F.col("test_name").alias("feature"))
            .agg(F.avg("value").alias("value")))


def feature_tuples(diagnostic: DataFrame, lab: DataFrame, medication: DataFrame,
                   candidates: dict[str, Candidates] | None = None,
                   normalize: str | None = None) -> DataFrame:
    """The three families as one long table, tagged with their ``domain``.

    The domain tag keeps equal names of different families apart (a dx code
    and a drug with the same name would otherwise collide in one vector).
    """
    c = candidates or {}
    parts = [
        diagnostic_feature_counts(diagnostic, c.get("dx"), normalize).withColumn("domain", F.lit("dx")),
        lab_feature_means(lab, c.get("lab"), normalize).withColumn("domain", F.lit("lab")),
        medication_feature_counts(medication, c.get("med"), normalize).withColumn("domain", F.lit("med")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).select("patient_id", "domain", "feature", "value")


def event_feature_tuples(events: DataFrame, candidates: dict[str, Candidates] | None = None,
                         normalize: str | None = None) -> DataFrame:
    """U1 on a tagged event log in ONE aggregation (count for dx/med, mean for lab)."""
    ev = events
    if candidates:
        kept = []
        for dom in ("dx", "lab", "med"):
            part = ev.where(F.col("domain") == dom)
            kept.append(filter_candidates(part, "name", candidates.get(dom), normalize))
        ev = reduce(lambda a, b: a.unionByName(b), kept)
    return as_tuples(event_summary(ev))


def filter_tuples(tuples: DataFrame, candidates: dict[str, Candidates], normalize: str | None = None) -> DataFrame:
    """F8 after aggregation: keep tuples whose (domain, feature) is a candidate.

    Filtering by name commutes with grouping by name, so this equals
    ``event_feature_tuples(events, candidates)`` without a second pass over
    the events. All domains are matched in ONE semi join against a combined
    (domain, name) table (size-checked broadcast), which keeps the input's
    partitioning instead of unioning one filtered copy per domain.
    """
    key = _key(F.col("feature"), normalize)
    listed = [d for d, c in candidates.items() if c is not None]
    unlisted = tuples.where(~F.col("domain").isin(listed)) if listed else tuples   # kept whole, as by the aggregates
    frames = {d: c for d, c in candidates.items() if isinstance(c, DataFrame)}
    lists = {d: c for d, c in candidates.items() if c is not None and not isinstance(c, DataFrame)}
    keep = F.lit(False)
    for dom, names in lists.items():
        keep = keep | ((F.col("domain") == dom) & key.isin(list(dict.fromkeys(names))))
    if not frames:
        return tuples.where(keep | ~F.col("domain").isin(listed)) if listed else tuples
    table = reduce(lambda a, b: a.unionByName(b),
                   [c.select(F.lit(d).alias("_dom"), F.col(c.columns[0]).alias("_cand")) for d, c in frames.items()])
    keyed = tuples.withColumn("_key", key)
    cond = (keyed["domain"] == table["_dom"]) & (keyed["_key"] == table["_cand"])
    matched = keyed.join(table.distinct(), cond, "left_semi").drop("_key")
    if lists:
        matched = matched.unionByName(tuples.where(keep))
    return matched.unionByName(unlisted)


def feature_dictionary(tuples: DataFrame, keys: tuple[str, ...] = ("domain", "feature")) -> DataFrame:
    """Distinct feature keys with alphabetical 0-based ``feature_id``."""
    keys = tuple(k for k in keys if k in tuples.columns)
    names = tuples.select(*keys).distinct()
    return dense_index(names, list(keys), "feature_id")


def indexed_features(tuples: DataFrame, dictionary: DataFrame,
                     keys: tuple[str, ...] = ("domain", "feature"),
                     sum_duplicates: bool | None = None) -> DataFrame:
    """(patient_id, feature_id, value).

    When the dictionary key drops the ``domain`` tag that the tuples carry,
    two families can map to one id; those values are summed (one more
    shuffle). Otherwise tuples that are unique per (patient, key), as the
    feature aggregations produce, map one-to-one and no aggregation runs.
    """
    keys = [k for k in keys if k in tuples.columns and k in dictionary.columns]
    joined = join_small(tuples, dictionary.select(*keys, "feature_id"), keys, "inner")
    if sum_duplicates is None:
        sum_duplicates = "domain" in tuples.columns and "domain" not in keys
    if sum_duplicates:
        return joined.groupBy("patient_id", "feature_id").agg(F.sum("value").alias("value"))
    return joined.select("patient_id", "feature_id", F.col("value").cast("double"))


def feature_matrix(tuples: DataFrame, keys: tuple[str, ...] = ("domain", "feature")):
    """C2 core: returns (long (patient_id, feature_id, value), dictionary, n_features).

    The tuples are read twice (dictionary, then the id join), so they are
    persisted unless the caller has done so; so is the dictionary, which is counted and measured before it
    is broadcast.
    """
    tuples = tuples if tuples.is_cached else materialize(tuples)
    dictionary = materialize(feature_dictionary(tuples, keys))
    n_features = dictionary.count()
    long = indexed_features(tuples, dictionary, keys)
    return long, dictionary, n_features


def dense_feature_arrays(long: DataFrame, n_features: int, value_col: str = "value",
                         out_col: str = "features") -> DataFrame:
    """A9 (dense): one ``array<double>`` of length ``n_features`` per patient.

    A single pass over the patient's sorted entries, JVM-side: each entry puts the
    zeros since the one before it and its value; zeros fill the rest.
    """
    e = F.sort_array(F.collect_list(F.struct("feature_id", F.col(value_col).alias("value"))))
    agg = long.groupBy("patient_id").agg(e.alias("_e"))
    ids = F.concat(F.array(F.lit(-1).cast("long")), F.col("_e.feature_id"))

    def zeros(count: Column) -> Column:
        return F.array_repeat(F.lit(0.0), count.cast("int"))

    filled = F.flatten(F.transform("_e", lambda x, i: F.concat(
        zeros(x["feature_id"] - F.col("_ids")[i] - 1), F.array(x["value"]))))
    tail = zeros(F.lit(n_features - 1) - F.element_at("_ids", -1))
    return agg.withColumn("_ids", ids).select("patient_id", F.concat(filled, tail).alias(out_col))


def dense_feature_vectors(long: DataFrame, n_features: int, out_col: str = "features") -> DataFrame:
    """Dense ML vectors (``array_to_vector`` is JVM-side; no Python UDF)."""
    arr = dense_feature_arrays(long, n_features, out_col="_arr")
    return arr.select("patient_id", array_to_vector("_arr").alias(out_col))


@F.udf(VectorUDT(), useArrow=True)
def _sparse_vector(size, ids, values):
    # per patient, in Arrow batches: called with that patient's sorted ids and values
    return SparseVector(int(size), [int(i) for i in ids], [float(v) for v in values])


def sparse_feature_arrays(long: DataFrame) -> DataFrame:
    """A9 (sparse): each patient's feature ids in order and their values."""
    entries = F.sort_array(F.collect_list(F.struct("feature_id", "value")))
    return long.groupBy("patient_id").agg(entries.alias("_e")).select(
        "patient_id", F.col("_e.feature_id").alias("ids"), F.col("_e.value").alias("vals"))


def sparse_feature_vectors(long: DataFrame, n_features: int, out_col: str = "features") -> DataFrame:
    """``sparse_feature_arrays`` as one ``SparseVector`` per patient, for the ML boundary."""
    return sparse_feature_arrays(long).select(
        "patient_id", _sparse_vector(F.lit(n_features), F.col("ids"), F.col("vals")).alias(out_col))


def abs_features(long: DataFrame) -> DataFrame:
    """Element-wise absolute value (non-negative input for NMF)."""
    return long.withColumn("value", F.abs(F.col("value")))
