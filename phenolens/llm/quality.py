"""Quality classifier by compression.

Zstandard dictionaries are built from good and from bad labelled texts. A text
that compresses better with the dictionary of good texts is likelier good; the
difference of the two sizes, normalised by the length of the text, is turned
into a calibrated score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import free_name

#: Labelled rows of each class from which a dictionary is built, and with which the score is calibrated.
DICTIONARY_ROWS, CALIBRATION_ROWS = 1000, 3000
#: Pieces of a sampled text that go into a dictionary (evenly spread over the whole text).
PIECES = 8
#: Bytes compressed at once: short enough for a dictionary to matter in every piece of a long text.
PIECE = 1024
DICTIONARY_BYTES, LEVEL = 64 << 10, 3
THRESHOLD = 0.7
FEATURES = "difference double, good double, plain double, size double"


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    std: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def held_out(doc_id: Column) -> Column:
    """Rows that nothing may be learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _pieces(data: bytes) -> list[bytes]:
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


def _compressor(dictionary: bytes):
    import zstandard
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False)
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=parameters)


def compressed_sizes(texts: pd.Series, good: bytes, bad: bytes) -> pd.DataFrame:
    """Normalised sizes of whole texts: difference between the dictionaries, with the good one, and without any."""
    with_good, with_bad, plain = _compressor(good), _compressor(bad), _compressor(b"")
    rows = []
    for text in texts:
        data = (text or "").encode()
        n = max(1, len(data))
        pieces = _pieces(data)
        g = sum(len(with_good.compress(p)) for p in pieces)
        b = sum(len(with_bad.compress(p)) for p in pieces)
        rows.append(((g - b) / n, g / n, (len(plain.compress(data)) if data else 0) / n, math.log1p(len(data))))
    return pd.DataFrame(rows, columns=[f.split()[0] for f in FEATURES.split(", ")])


def _design(features: np.ndarray) -> np.ndarray:
    """The sizes, their squares, and their products with the difference."""
    return np.concatenate([features, features ** 2, features[:, :1] * features[:, 1:]], axis=1)


def _dictionary(texts: list[str]) -> bytes:
    """Lines that several of the texts share say nothing about their quality and are left out."""
    import zstandard
    split = [text.split("\n") for text in texts]
    shared = Counter(line for lines in split for line in set(lines))
    samples = []
    for lines in split:
        pieces = _pieces("\n".join(line for line in lines if shared[line] == 1).encode())
        step = max(1, math.ceil(len(pieces) / PIECES))
        samples += [p for p in pieces[::step] if p]
    if sum(map(len, samples)) < 16 * DICTIONARY_BYTES:  # too little to choose from: use it as it is
        return b"".join(samples)[-DICTIONARY_BYTES:]
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()


def _fit(features: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps on weighted rows of standardised features, with a small ridge."""
    x = _design(features)
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.c_[np.ones(len(x)), (x - mean) / std]
    w, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (good - p)) - ridge @ w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return mean, std, w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          quality_col: str = "quality", dictionary_rows: int = DICTIONARY_ROWS,
          calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """A model from a bounded sample of labelled rows that aren't held out.

    The sample is the rows with the smallest hashes of their ids, at most
    ``dictionary_rows`` + ``calibration_rows`` a class; their ids are broadcast. The
    driver gets at most PIECES * PIECE bytes of the texts for the dictionaries
    (cut to that in the tasks), and four numbers of those for calibration. These are
    weighted by the counted labels of their class, so that the score is calibrated to
    the share of good labels among all, however few of a class are sampled. Ids with
    contradictory labels are left out. Without both classes the score is constant.
    """
    rows = (labels.select(F.col(id_col).alias("doc_id"), F.col(quality_col).cast("int").alias("quality"))
            .filter("doc_id is not null and quality in (0, 1)").filter(~held_out(F.col("doc_id"))))
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter(
        "quality = most").select("doc_id", "quality")
    chosen = None
    for quality in (0, 1):
        some = (rows.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(dictionary_rows + calibration_rows))
        chosen = some if chosen is None else chosen.unionByName(some)
    ids = [(r["doc_id"], r["quality"]) for r in chosen.collect()]
    total = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    prior = total.get(1, 0) / sum(total.values()) if total else 0.5
    if not 0 < prior < 1:
        return Model(b"", b"", (), (), (), prior)
    spark = docs.sparkSession
    use, seen = [], Counter()
    for doc_id, quality in ids:  # in order of their hashes, alternating between the two uses
        seen[quality] += 1
        first = seen[quality] % 4 == 0 if seen[quality] <= 4 * dictionary_rows else False
        use.append((doc_id, quality, first))
    drawn = Counter(quality for _, quality, first in use if not first)
    use = spark.createDataFrame(use, "doc_id long, quality int, for_dictionary boolean")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(use), "doc_id"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["text"] = [_spread(t) for t in f["text"]]
            yield f[["doc_id", "quality", "text"]]

    sample = (texts.filter("for_dictionary").mapInPandas(cut, "doc_id long, quality int, text string")
              .toPandas().drop_duplicates().sort_values(["doc_id", "text"]))
    good, bad = (_dictionary(sample.loc[sample["quality"] == q, "text"].tolist()) for q in (1, 0))

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.concat([f[["doc_id", "quality"]].reset_index(drop=True), compressed_sizes(f["text"], good, bad)], axis=1)

    known = (texts.filter("not for_dictionary").mapInPandas(sizes, f"doc_id long, quality int, {FEATURES}")
             .toPandas().sort_values(["doc_id", "difference"]))
    if known["quality"].nunique() < 2:
        return Model(b"", b"", (), (), (), prior)
    weight = known["quality"].map({q: total[q] / n for q, n in drawn.items()}).to_numpy()
    mean, std, w = _fit(known[["difference", "good", "plain", "size"]].to_numpy(), known["quality"].to_numpy(),
                        weight / weight.mean())
    return Model(good, bad, tuple(mean), tuple(std), tuple(w), prior)


def _spread(text: str) -> str:
    """At most PIECES * PIECE characters of a sampled text, in whole lines or pieces spread over it."""
    if len(text) <= PIECES * PIECE:
        return text
    step = len(text) // PIECES
    return "\n".join(text[i * step:i * step + PIECE] for i in range(PIECES))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: the probability (0 to 1) that a text is good. A null text counts as empty."""
    if not model.weights:
        return docs.withColumn(out, F.lit(float(model.prior)))
    mean, std, w = (np.array(x) for x in (model.mean, model.std, model.weights))

    @F.pandas_udf("double")
    def compressed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            x = (_design(compressed_sizes(t, model.good, model.bad).to_numpy()) - mean) / std if len(t) else np.zeros((0, len(mean)))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), x] @ w, -30, 30))))

    return docs.withColumn(out, compressed(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, repeated rows and null ids included.

    Every whole text is scored, an empty or null one too; columns other than the id
    and the text are not looked at. Without labels of both classes the score is the
    share of good labels, or 0.5 without any."""
    model = train(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(rows, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns."""
    model = train(docs, labels, id_col, text_col, **options)
    name = free_name(docs, "score")
    return score(docs, model, text_col, name).filter(F.col(name) >= threshold).drop(name)
