"""Line deduplication that returns keep bitmaps, not text (column expressions only).

Line hashes are range-partitioned, sorted within partitions by document and
position, and numbered in that order: the first document of a line keeps it, the
lines of all others become bits of their documents' bitmaps. A line that is frequent
(found by a mergeable summary) is cut into several ranges by document; what its
ranges hold together is counted beside, for at most as many lines as the summary names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolens.llm.common import NULL_ID, ascii_lower, shared_table

# Fixed values of the line key: ASCII space, tab, newline, VT, FF, CR.
STRIPPED = " \t\n\x0b\x0c\r"
#: Bits per bitmap word; 62 keeps every word a positive long.
WORD = 62
#: Counters of the summary of frequent lines, how many it names, and the share of all lines that a range should hold at most.
COUNTERS, FREQUENT, SHARE = 8192, 256, 1 / 512


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    # btrim goes through the whole line, so it is left to the lines that need it
    ends = [f(line, F.lit(c)) for c in STRIPPED for f in (F.startswith, F.endswith)]
    return ascii_lower(F.when(reduce(or_, ends), F.btrim(line, F.lit(STRIPPED))).otherwise(line))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows get the key (id, text hash), so that rows that share an id but not the
    text keep bitmaps of their own; a null id sorts before all others."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                 min_docs: int = 3) -> DataFrame:
    """(id, text_hash, bitmap, n_dropped), one row per document that loses lines.

    ``bitmap`` maps a word number w to the bits of lines WORD*w ... WORD*w+WORD-1;
    a set bit is a line to drop, and words without one are left out, which keeps
    the bitmap of a long document small. A line is dropped if its key has
    ``min_chars`` code points or more, ``min_docs`` different ids hold the key, and
    this id isn't the largest of them.
    """
    rows = _rows(docs, id_col, text_col)
    hashes = F.transform(split_lines(F.col("text")), lambda line: F.when(
        F.char_length(line) >= min_chars, _key_hash(line_key(line), min_chars)))
    # the outer form: for the plain one Spark infers a filter that computes the hashes a second time
    lines = (rows.select("id", "text_hash", F.posexplode_outer(hashes).alias("pos", "h"))
             .filter(F.col("h").isNotNull())
             .select(F.col("h.a").alias("h1"), F.col("h.b").alias("h2"), "id", "text_hash", "pos"))
    # range partitioning samples its input first, and the frequent lines are found before: hash the texts only once
    lines = shared_table(lines, "line_hashes")
    frequent = shared_table(
        lines.agg(F.expr(f"approx_top_k(h1, {FREQUENT}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n"))
        .select(F.explode("top").alias("t"), "n")
        .select(F.col("t.item").alias("h1"), F.ceil(F.col("t.count") / (F.col("n") * F.lit(SHARE))).cast("int").alias("cuts"))
        .filter("cuts > 1"), "frequent_lines")
    dealt = lines.join(F.broadcast(frequent), "h1", "left").withColumn(
        "cut", F.when(F.col("cuts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")))
    ranged = (dealt.repartitionByRange("h1", "h2", "cut")
              .sortWithinPartitions("h1", "h2", "cut", F.desc("id"), "text_hash", "pos"))
    piece = Window.partitionBy("h1", "h2", "cut")
    numbered = ranged.withColumn("number", F.dense_rank().over(piece.orderBy(F.desc("id")))).withColumns(
        {"last_id": F.max("id").over(piece), "n_docs": F.max("number").over(piece)})
    # what the ranges of a cut line hold together; ids lie in one range each
    whole = (lines.join(F.broadcast(frequent), "h1", "left_semi").groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.max("id").alias("whole_last"), F.count("one").alias("whole_docs")))
    whole = F.broadcast(shared_table(whole.filter(F.col("whole_docs") > 1), "frequent_line_docs"))
    dropped = (numbered.join(whole, ["h1", "h2"], "left")
               .filter((F.coalesce("whole_docs", "n_docs") >= min_docs) & (F.col("id") < F.coalesce("whole_last", "last_id")))
               .select("id", "text_hash", F.expr(f"cast(pos div {WORD} as int)").alias("word"),
                       F.expr(f"shiftleft(1L, cast(pos % {WORD} as int))").alias("bits")))
    words = dropped.groupBy("id", "text_hash", "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy("id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bitmap"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))


def _key_hash(key: Column, min_chars: int) -> Column:
    """128 bits as two longs; null for a key that is too short."""
    return F.when(F.char_length(key) >= min_chars, F.struct(
        F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")))


def kept_lines(lines: Column, bitmap: Column) -> Column:
    """The lines whose bit isn't set; all lines if ``bitmap`` is null."""
    words = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / WORD).cast("int")),
                        lambda w: F.coalesce(F.element_at(bitmap, w), F.lit(0).cast("long")))
    return F.when(bitmap.isNull(), lines).otherwise(F.filter(lines, lambda _line, i: F.getbit(
        F.get(words, F.floor(i / WORD).cast("int")), (i % WORD).cast("int")) == 0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text), one row per row of ``docs``.

    A null or empty text is one empty line. The rows of one id count as one
    document when holders are counted, and a null id as the smallest id. Repeated
    rows get equal results. Other columns are not looked at.
    """
    rows = _rows(docs, id_col, text_col)
    lines = split_lines(F.col("text"))
    joined = rows.join(drop_bitmaps(docs, id_col, text_col, min_chars, min_docs), ["id", "text_hash"], "left")
    return joined.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(
            F.array_join(kept_lines(lines, F.col("bitmap")), "\n")).alias("kept_text"))
