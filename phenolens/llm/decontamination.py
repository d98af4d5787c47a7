"""Benchmark decontamination by winnowing (column expressions only).

Of the hashes of a text's k-word grams, the smallest in every window is kept once,
with its position: its fingerprint. A span of ``window`` words that two texts share
has a fingerprint in both, so joining the fingerprints of documents with those of
benchmark items finds every shared span and how the two texts lie on each other
there. Each hit is then extended: the document's words are compared with the
item's along the whole item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import ascii_lower, shared_table

# Fixed value of the word definition: what stands between words after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5
#: Low bits of a placed hash that hold its position; a text has fewer bytes than 2 to this.
POSITION_BITS = 31
#: Fingerprints of the benchmark, and alignments, are broadcast up to this measured size.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """Words of a text, in order; none if it is null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _each(n: Column, f, kind: str = "array<long>") -> Column:
    """[f(0), ..., f(n - 1)], empty if n is 0 or less."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), f)).otherwise(
        F.array().cast(kind))


def word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def _window(array: Column, i: Column, length: int) -> list[Column]:
    """Elements i ... i + length - 1, one by one: slice copies the whole array each time."""
    return [F.get(array, i + j) for j in range(length)]


def placed_hashes(hashes: Column, length: int) -> Column:
    """For each gram of ``length`` words 33 bits of its hash, and below them its position: they sort by hash."""
    return _each(F.size(hashes) - (length - 1), lambda i: F.shiftleft(
        F.xxhash64(*_window(hashes, i, length)), POSITION_BITS).bitwiseOR(i.cast("long")))


def winnow(placed: Column, width: int) -> Column:
    """The smallest of each ``width`` consecutive hashes, each selected one once."""
    return F.array_distinct(_each(F.size(placed) - (width - 1), lambda i: F.least(*_window(placed, i, width))))


def _hash_of(placed: Column) -> Column:
    return F.shiftright(placed, POSITION_BITS)


def _place_of(placed: Column) -> Column:
    return placed.bitwiseAND((1 << POSITION_BITS) - 1)


def fingerprints(rows: DataFrame, length: int, window: int, gram: int, ties: bool = False) -> DataFrame:
    """(carried columns, mark, place) of the texts ``tokens`` for spans of ``length`` words.

    Spans of ``window`` words are winnowed; shorter ones (whole short items) have a gram of their own
    length at every place. With ``ties``, all places of a window's smallest hash are given, not one of them:
    the other text may have selected any."""
    keep = [c for c in rows.columns if c != "tokens"]
    size, width = (length, 1) if length < window or window <= gram else (gram, window - gram + 1)
    # columns of their own, used more than once: within a lambda an inlined expression would be computed for each element
    placed = (rows.withColumn("hashes", word_hashes(F.col("tokens")))
              .withColumn("placed", placed_hashes(F.col("hashes"), size)))
    marks = marks_of = F.col("placed")
    if width > 1 and ties:
        marks = F.array_distinct(F.flatten(_each(F.size("placed") - (width - 1), lambda i: F.filter(
            F.array(*_window(marks_of, i, width)),
            lambda v: _hash_of(v) == _hash_of(F.least(*_window(marks_of, i, width)))), "array<array<long>>")))
    elif width > 1:
        marks = winnow(marks, width)
    # the outer form: for the plain one Spark infers a filter that computes the marks a second time
    found = placed.select(*keep, F.posexplode_outer(marks).alias("_at", "placed"))
    return found.filter(F.col("placed").isNotNull()).select(
        *keep, _hash_of(F.col("placed")).alias("mark"), _place_of(F.col("placed")).alias("place"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Hits (doc_id, start, length, item_id) and documents (doc_id, n_words).

    An item's windows are its runs of ``window`` words, or all its words if it has
    fewer; an item without words has none. Null texts have no words. Rows that
    repeat an id are compared together. Only fingerprints that the benchmark holds
    leave the scan of the documents, as (document, place); words are compared when the hits are
    extended, so a hash collision costs time and adds no hit.
    """
    item_tokens = shared_table(items.select(
        F.col(item_id_col).alias("item_id"), words(F.col(item_text_col)).alias("item_words")).distinct(), "benchmark_words")
    lengths = [r[0] for r in item_tokens.select(F.least(F.size("item_words"), F.lit(window)).alias("n"))
               .filter("n > 0").distinct().collect()]  # at most ``window`` numbers
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = texts.withColumn("text_hash", F.xxhash64("text"))
    near = None
    for length in sorted(lengths) or [window]:
        own = (item_tokens.filter(F.least(F.size("item_words"), F.lit(window)) == length)
               .withColumn("tokens", F.col("item_words")))
        marks = shared_table(fingerprints(own, length, window, gram, ties=True)
                             .withColumnRenamed("place", "item_place"), "benchmark_fingerprints")
        small = F.broadcast(marks) if _bytes(marks) <= BROADCAST_BYTES else marks
        found = (fingerprints(keyed.select("doc_id", "text_hash", words(F.col("text")).alias("tokens")), length, window, gram)
                 .join(small, "mark").select("doc_id", "text_hash", "item_id", "item_words",
                                             (F.col("place") - F.col("item_place")).cast("int").alias("shift")))
        near = found if near is None else near.unionByName(found)
    aligned = shared_table(near.distinct().groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("item_id", "item_words", "shift")).alias("items")), "alignments")
    return extended(keyed, aligned, window), docs.select(
        F.col(id_col).alias("doc_id"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))


def _bytes(marks: DataFrame) -> int:
    """Measured bytes of the benchmark's fingerprints with their items' words."""
    letters = F.aggregate("item_words", F.lit(0), lambda n, w: n + F.octet_length(w) + 24)
    return marks.agg(F.sum(F.lit(64) + letters)).first()[0] or 0


def extended(keyed: DataFrame, aligned: DataFrame, window: int) -> DataFrame:
    """(doc_id, start, length, item_id): the item windows that stand in a document where an item is laid on it.

    ``shift`` is the place in the document of the item's first word; it is negative where the document begins
    within the item. A document's alignments are no more than its fingerprints times an item's equal ones. Documents with
    alignments are few; while these are small by measure they are broadcast, and the texts stay where they are read."""
    size = aligned.agg(F.sum(F.size("items") * 64 + 4 * F.octet_length(F.to_json("items")))).first()[0] or 0
    d, a = keyed.alias("d"), (F.broadcast(aligned) if size <= BROADCAST_BYTES else aligned).alias("a")
    rows = d.join(a, F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("d.text_hash") == F.col("a.text_hash"))).select(
        "d.doc_id", words(F.col("d.text")).alias("tokens"), "a.items")   # used twice below, so split once

    def laid(x: Column) -> Column:
        skipped = F.greatest(-x["shift"], F.lit(0))
        return F.struct(
            x["item_id"].alias("item_id"), (x["shift"] + skipped).alias("first"),
            F.least(F.size(x["item_words"]), F.lit(window)).alias("length"),
            _each(F.least(F.size(x["item_words"]) - skipped, F.size("tokens") - x["shift"] - skipped),
                  lambda j: F.get(F.col("tokens"), x["shift"] + skipped + j), "array<string>").alias("own"),
            F.slice(x["item_words"], skipped + 1, F.size(x["item_words"])).alias("theirs"))

    pairs = rows.select("doc_id", F.explode(F.transform("items", laid)).alias("x")).select("doc_id", "x.*")
    same = pairs.withColumn("same", F.zip_with("own", "theirs", lambda p, q: F.coalesce(p == q, F.lit(False))))
    starts = F.filter(_each(F.size("same") - F.col("length") + 1, lambda i: i.cast("long")), lambda i: F.forall(
        F.slice("same", i.cast("int") + 1, F.col("length")), lambda equal: equal))
    return same.select("doc_id", F.explode(starts).alias("at"), "first", "length", "item_id").select(
        "doc_id", (F.col("first") + F.col("at")).cast("int").alias("start"), "length", "item_id")


def _covered(spans: Column) -> Column:
    """Words covered by spans (start, end) sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0).cast("long"))).alias("n"),
        F.greatest(a["end"], s["end"]).alias("end")), lambda a: a["n"])


def decontaminate(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items``
    holds the ids of the items with such windows as strings, in string order. Rows
    that share an id share their hits. A null id never matches: its row has no hits
    unless all null ids together have some, which it then shares. Empty tables of
    documents or items give no hits.
    """
    hits, rows = contamination(docs, items, **columns)
    hits = shared_table(hits.distinct(), "hits")
    by_start = hits.groupBy("doc_id", F.col("start").cast("long").alias("start")).agg(
        (F.first("start") + F.max("length")).cast("long").alias("end"))
    n_hit = by_start.groupBy("doc_id").agg(
        _covered(F.array_sort(F.collect_list(F.struct("start", "end")))).alias("n_hit"))
    by_item = hits.select("doc_id", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("doc_id").agg(
        F.array_sort(F.collect_list("item_id")).alias("items"))
    found = n_hit.join(by_item, n_hit["doc_id"].eqNullSafe(by_item["doc_id"])).select(n_hit["doc_id"], "n_hit", "items")
    rows, found = rows.alias("r"), found.alias("f")
    return rows.join(found, F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")), "left").select(
        "r.doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any hit, with their columns. Rows share their fate with rows of the same id."""
    hits, _ = contamination(docs, items, id_col, text_col, **options)
    bad = shared_table(hits.select(F.col("doc_id").alias("__id")).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__id"]), "left_anti")
