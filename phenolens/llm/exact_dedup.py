"""Exact deduplication with a heavy-hitter split (column expressions only).

A mergeable Misra-Gries summary finds the digests that may be frequent. Their
exact sizes and winners (a bounded number) are broadcast, so the rows of large
groups of copies are resolved where they are read; only the rest is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolens.llm.common import shared_table

#: Counters of a summary. A digest with more than rows / COUNTERS copies can't be missed by it.
COUNTERS = 8192
#: At most so many frequent digests are broadcast.
HEAVY = 256


def normalised(text: Column) -> Column:
    """The text that is compared: null counts as empty, nothing else changes."""
    return F.coalesce(text, F.lit(""))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY,
                counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Rows are equal if their texts are (SHA-256 of the UTF-8 bytes); null counts as
    empty. The largest id stays, null ids being smaller than all others; if several
    rows of a group have that id, one of them stays. Other columns are not looked
    at, and an empty table gives an empty one.

    The narrow rows (id and digest) are written once to the shared folder; texts
    are read once. Neither frequent digests nor the rest can put an unbounded
    group into one task: a digest that isn't broadcast has at most about
    rows / ``heavy`` copies of narrow rows.
    """
    text = normalised(F.col(text_col))
    narrow = shared_table(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest")),
                          "exact_dedup")
    fingerprint = F.xxhash64("digest")
    frequent = (narrow.agg(F.expr(f"approx_top_k(xxhash64(digest), {heavy}, {counters})").alias("top"))
                .select(F.explode("top.item").alias("fingerprint")))
    # exact sizes and winners of the candidates; only as many groups as there are candidates come out
    winners = (narrow.withColumn("fingerprint", fingerprint).join(F.broadcast(frequent), "fingerprint", "left_semi")
               .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
               .filter(F.col("group_size") > 1))
    winners = shared_table(winners.orderBy(F.desc("group_size"), "digest").limit(2 * heavy), "exact_dedup_winners")
    marked = narrow.join(F.broadcast(winners.withColumn("is_heavy", F.lit(True))), "digest", "left")
    split = marked.filter("is_heavy")
    heavy_rows = split.withColumn("candidate", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    one = Window.partitionBy("digest").orderBy("doc_id")
    resolved = heavy_rows.filter(~F.col("candidate")).withColumn("kept", F.lit(False)).unionByName(
        heavy_rows.filter("candidate").withColumn("kept", F.row_number().over(one) == 1))
    group = Window.partitionBy("digest")
    rest = (marked.filter("is_heavy is null").select("digest", "doc_id")
            .withColumns({"keep_id": F.max("doc_id").over(group), "group_size": F.count("*").over(group),
                          "kept": F.row_number().over(group.orderBy(F.desc_nulls_last("doc_id"))) == 1}))
    columns = ["doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")]
    return resolved.select(*columns).unionByName(rest.select(*columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one for each different text."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col("keep_id").alias("id"), F.col("text_sha256").alias("digest"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")   # its names can't clash with others
    keyed = docs.select(whole, F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("digest"))
    same = (F.col("d.id").eqNullSafe(F.col("k.id"))) & (F.col("d.digest") == F.col("k.digest"))
    rows = keyed.alias("d").join(kept.alias("k"), same, "left_semi")
    # rows that repeat the one that stays, id and text alike
    one = Window.partitionBy("digest", "id").orderBy("id")
    return rows.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
