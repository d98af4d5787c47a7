import zlib

import numpy as np

from phenolens.llm import quality, queries

from conftest import SF


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op8_quality_classifier"](spark, SF["0.01"]).toPandas()
    docs = queries.documents(spark, SF["0.01"]).toPandas()
    assert sorted(got["doc_id"]) == sorted(docs["doc_id"])
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.7)).all()
    known = got.merge(queries.table(spark, SF["0.01"], "labels").toPandas(), on="doc_id")
    test = known[known["held_out"]]
    assert (test["predicted"] == test["quality"]).mean() > 0.95
    # calibrated: the mean score is near the share of good documents
    assert abs(test["score"].mean() - test["quality"].mean()) < 0.05


def test_nothing_is_learnt_from_held_out_rows_and_other_columns(spark):
    docs, labels = queries.documents(spark, SF["0.01"]), queries.table(spark, SF["0.01"], "labels")
    model = quality.train(docs, labels, dictionary_rows=20, calibration_rows=100)
    flipped = labels.withColumn("quality", quality.F.when(
        quality.held_out(labels["doc_id"]), 1 - labels["quality"]).otherwise(labels["quality"]))
    other = docs.withColumns({"lang": quality.F.lit("xx"), "source": quality.F.lit("yy")})
    again = quality.train(other, flipped, dictionary_rows=20, calibration_rows=100)
    assert again.good == model.good and again.bad == model.bad and np.allclose(again.weights, model.weights)


def test_odd_rows(spark, docs_of):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, 1)], "doc_id long, quality int")
    docs = docs_of([(1, None), (2, ""), (3, "x" * 300000), (None, "a"), (3, "x" * 300000)])
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and {r["score"] for r in rows} == {1.0}
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).collect() == []
    full = queries.documents(spark, SF["0.001"]).select("doc_id", "text").union(docs.select("doc_id", "text"))
    assert quality.accepted(full, queries.table(spark, SF["0.001"], "labels")).columns == ["doc_id", "text"]
    scores = quality.classify(full, queries.table(spark, SF["0.001"], "labels")).collect()
    assert len(scores) == 205 and all(0 <= r["score"] <= 1 for r in scores)


def test_calibrated_to_all_labels_when_both_classes_are_sampled(spark):
    """Texts that say nothing about their quality score the share of good labels, not that of the sample."""
    rng = np.random.default_rng(8)
    words = np.array([f"word{i}" for i in range(500)])
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 60))) for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(4000)], "doc_id long, quality int")
    scores = quality.classify(docs, labels, dictionary_rows=20, calibration_rows=200).toPandas()["score"]
    assert abs(scores.mean() - 0.9) < 0.04 and (scores >= 0.7).mean() > 0.95


def test_accepted_rows_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "good words and more " * 9, "own", "mine") for i in range(6)],
                                 "doc_id long, text string, Score string, score_ string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    got = quality.accepted(docs, labels)
    assert got.columns == docs.columns and {(r[2], r[3]) for r in got.collect()} == {("own", "mine")}
