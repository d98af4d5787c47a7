"""The shuffle join that spreads heavy keys: same rows, even tasks."""
import statistics

from pyspark.sql import functions as F

from phenolens.operators import features as fe
from phenolens.operators import joins as jo


def test_hot_feature_leaves_even_tasks(spark):
    """A third of all rows share a feature; beyond a broadcast no task gets over twice the median."""
    tuples = spark.range(60_000).select(
        F.col("id").cast("string").alias("patient_id"), F.lit("dx").alias("domain"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 211)).alias("feature"),
        F.lit(1.0).alias("value"))
    dictionary = tuples.select("domain", "feature").distinct().withColumn("feature_id", F.xxhash64("feature"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    limit = jo.BROADCAST_MAX_BYTES
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = jo.join_small(tuples, dictionary, ["domain", "feature"], max_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * statistics.median(sizes)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "CartesianProduct" not in plan
        assert joined.columns == ["domain", "feature", "patient_id", "value", "feature_id"]
        want = tuples.join(dictionary, ["domain", "feature"])
        assert joined.exceptAll(want).count() == want.exceptAll(joined).count() == 0
        plain = fe.indexed_features(tuples, dictionary)
        assert plain.count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert limit == jo.BROADCAST_MAX_BYTES


def test_spread_join_keeps_nulls_and_copies(spark):
    big = spark.createDataFrame([("a", i % 5) for i in range(300)] + [(None, 1)] * 50 + [("b", 1), ("c", 2)],
                                "_number string, _cuts int")
    small = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("d", "w")], "_number string, v string")
    for how in ("inner", "left"):
        got, want = jo.join_spread(big, small, ["_number"], how), big.join(small, "_number", how)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert jo.join_spread(big.limit(0), small, ["_number"]).collect() == []
