"""Ranked lexical search over an index in strata of equal length normaliser.

All documents with the same normaliser m form a stratum, cut into blocks of
bounded size. A block holds, for each term, its documents by falling term
frequency. Within a stratum the impact of a posting depends on the frequency
alone, so it is computed once per frequency, and the highest frequency of a term
bounds what the term can add to any document of the stratum. A query visits the
strata in the order of their bounds, in waves, until no unvisited stratum can
reach its k-th best score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolens.llm.common import shared_table, word_bytes
from phenolens.operators.joins import join_small, measured_bytes

TOP = 10
#: Documents and postings of a block of the index, at most (one document may hold more postings).
BLOCK_DOCS, BLOCK_POSTINGS = 1024, 1 << 18
#: Documents before a stratum in a query's order, up to which the first wave visits; each further wave takes WIDER times as many.
FIRST_WAVE, WIDER = 4096, 32
#: Bytes of the terms by which the index may be restricted, and bytes and number of the queries that are searched at once.
VOCABULARY_BYTES, QUERY_BYTES, QUERIES = 32 << 20, 32 << 20, 512
IMPACT = "(1000000000L * {tf}) div (1000L * {tf} + 8L * {m})"


def document_terms(docs: DataFrame, id_col: str, text_col: str, vocabulary: frozenset[bytes] | None) -> DataFrame:
    """(doc, n, terms, tfs): length in terms, and the distinct terms (of the vocabulary) joined by blanks, with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = word_bytes(text.as_py() or b"")
                found = Counter(words)
                if wanted is not None:
                    found = {t: found[t] for t in found.keys() & wanted}
                lengths.append(len(words))
                terms.append(b" ".join(found))
                tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["doc", "n", "terms", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        count, f"doc {kind}, n long, terms string, tfs array<int>")


def _terms(column: str) -> Column:
    return F.split(column, " ")


class Index:
    """The written tables of an index, with its counts.

    blocks: (m, docs, terms, top, runs, run_tf, run_docs, places): documents in the order of their ids, and for
    each term its highest frequency and its number of runs; for each run (equal frequency, falling) the frequency
    and the number of documents; then the places of these documents.
    terms: (term, weight). strata: (m, docs, terms, top), the highest frequencies of a stratum.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: frozenset[bytes] | None = None):
        counted = shared_table(document_terms(docs, id_col, text_col, vocabulary), "document_terms")
        facts = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
        self.documents, self.length = facts["n"], facts["l"] or 0
        self.id_type = counted.schema["doc"].dataType.simpleString()
        held = counted.filter("size(tfs) > 0")
        self.terms = shared_table(
            held.select(F.explode(_terms("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
            .select("term", F.floor(1000 * F.log((2 * F.lit(self.documents) + 2).cast("double") / (2 * F.col("df") + 1)))
                    .cast("long").alias("weight")), "terms")
        rows = held.withColumn("m", F.expr(f"10L + (90L * n * {self.documents}L) div {max(self.length, 1)}L"))
        strata = rows.groupBy("m").agg(F.greatest(
            F.ceil(F.count("*") / F.lit(BLOCK_DOCS)), F.ceil(F.sum(F.size("tfs")) / F.lit(BLOCK_POSTINGS))).alias("cuts"))
        # copies of an id are dealt apart by the partition that reads them, which is the same whenever it is read
        dealt = (join_small(rows, strata, "m")
                 .withColumn("block", F.pmod(F.xxhash64("doc", F.spark_partition_id()), F.col("cuts")))
                 .repartition("m", "block").sortWithinPartitions("m", "block", "doc").select("m", "block", "doc", "terms", "tfs"))
        self.blocks = shared_table(dealt.mapInArrow(
            _blocks, f"m long, docs array<{self.id_type}>, terms string, top array<int>, runs array<int>, "
                     "run_tf array<int>, run_docs array<int>, places array<int>"), "index_blocks")
        highest = self.blocks.select("m", F.explode(F.arrays_zip(_terms("terms").alias("term"), "top")).alias("t"))
        self.strata = shared_table(highest.groupBy("m", F.col("t.term").alias("term")).agg(
            F.max("t.top").alias("top")), "index_strata")
        self.sizes = shared_table(self.blocks.groupBy("m").agg(F.sum(F.size("docs")).alias("docs")), "index_sizes")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks: each ends with its key, or when it is full."""
    key, parts, docs, postings = None, [], 0, 0
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        sizes = batch.column(4).value_lengths().to_pylist()
        start = 0
        for i in range(len(keys)):
            full = docs + i - start >= BLOCK_DOCS or (postings and postings + sizes[i] > BLOCK_POSTINGS)
            if keys[i] != key or full:
                if i > start:
                    parts.append(batch.slice(start, i - start))
                if parts:
                    yield _block(key[0], parts)
                key, parts, docs, postings, start = keys[i], [], 0, 0, i
            postings += sizes[i]
        if start < len(keys):
            parts.append(batch.slice(start))
            docs += len(keys) - start
    if parts:
        yield _block(key[0], parts)


def _block(m: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    ids: dict[bytes, int] = {}
    term = np.array([ids.setdefault(t, len(ids)) for text in rows["terms"].to_pylist() for t in text.split(" ")])
    tfs = rows["tfs"].combine_chunks()
    place = np.repeat(np.arange(len(rows)), tfs.value_lengths().to_numpy(zero_copy_only=False))
    tf = tfs.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((place, -tf, term))
    term, tf, place = term[order], tf[order], place[order]
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])  # of each run
    new_term = np.flatnonzero(np.r_[True, term[first][1:] != term[first][:-1]])
    docs = rows["doc"].combine_chunks()
    one = np.array([0, len(docs)], np.int32)

    def listed(x):
        return pa.array([np.asarray(x, np.int32)], pa.list_(pa.int32()))

    return pa.RecordBatch.from_arrays(
        [pa.array([m], pa.int64()), pa.ListArray.from_arrays(one, docs), pa.array([" ".join(ids)]),
         listed(tf[first][new_term]), listed(np.diff(np.r_[new_term, len(first)])), listed(tf[first]),
         listed(np.diff(np.r_[first, len(tf)])), listed(place)],
        names=["m", "docs", "terms", "top", "runs", "run_tf", "run_docs", "places"])


def _visitor(queries: dict[str, tuple[int, np.ndarray]], k: int, schema: pa.Schema):
    """Task function: the best documents of each block for the queries that visit its stratum."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(batch.schema.get_field_index("docs"))
            rows = batch.drop_columns(["docs"]).to_pylist()
            for at, row in enumerate(rows):
                asked, least = np.array(row["queries"]), np.array(row["least"], np.int64)
                line = np.full(asked.max() + 1, -1)
                line[asked] = np.arange(len(asked))
                count = len(docs[at])
                scores = np.zeros((len(asked), count), np.int64)
                run_tf, places = np.array(row["run_tf"], np.int64), np.array(row["places"])
                frequencies, inverse = np.unique(run_tf, return_inverse=True)
                impact = ((1_000_000_000 * frequencies) // (1000 * frequencies + 8 * row["m"]))[inverse]  # once per tf
                run_docs = np.array(row["run_docs"])
                run_end = np.cumsum(run_docs)
                run = 0
                for term, runs in zip(row["terms"].split(" "), row["runs"], strict=True):
                    if found := queries.get(term):
                        weight, askers = found
                        askers = askers[askers < len(line)]
                        lines = line[askers]
                        lines = lines[lines >= 0]
                        if weight and len(lines):
                            begin = run_end[run] - run_docs[run]
                            added = np.repeat(weight * impact[run:run + runs], run_docs[run:run + runs])
                            scores[lines[:, None], places[begin:run_end[run + runs - 1]]] += added
                    run += runs
                if count > k:
                    least = np.maximum(least, np.partition(scores, count - k, axis=1)[:, count - k])
                hit_line, hit_doc = np.nonzero((scores >= least[:, None]) & (scores > 0))
                if not len(hit_line):
                    continue
                points = scores[hit_line, hit_doc]
                order = np.lexsort((hit_doc, -points, hit_line))  # places follow the ids
                hit_line, hit_doc, points = hit_line[order], hit_doc[order], points[order]
                rank = np.arange(len(order)) - np.searchsorted(hit_line, hit_line)
                hit_line, hit_doc, points = (x[rank < k] for x in (hit_line, hit_doc, points))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[hit_line], pa.int32()), docs[at].values.take(pa.array(hit_doc)),
                     pa.array(points)], schema=schema)

    return visit


def _search(index: Index, queries: DataFrame, items: list, k: int) -> DataFrame:
    """(query, doc, score): the k best of each of a bounded number of queries, (query, term, weight)."""
    spark = queries.sparkSession
    grouped = queries.groupBy("term", "weight").agg(F.sort_array(F.collect_list("query")).alias("q")).collect()
    known = spark.sparkContext.broadcast({r["term"]: (r["weight"], np.array(r["q"])) for r in grouped})
    bounds = shared_table(
        join_small(join_small(index.strata, queries, "term")
                   .groupBy("query", "m").agg(F.sum(F.expr(f"weight * ({IMPACT.format(tf='top', m='m')})")).alias("bound")),
                   index.sizes, "m").filter("bound > 0")
        .withColumn("before", F.coalesce(F.sum("docs").over(
            Window.partitionBy("query").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "bounds")
    furthest = bounds.agg(F.max("before")).first()[0]
    found_type = f"query int, doc {index.id_type}, score long"
    best = spark.createDataFrame([], found_type)
    field = index.blocks.schema["docs"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("query", pa.int32()), ("doc", to_arrow_type(field)), ("score", pa.int64())])

    def visit(batches):
        yield from _visitor(known.value, k, schema)(batches)

    low, high = 0, FIRST_WAVE
    while furthest is not None and low <= furthest:
        reached = best.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(1)).alias("least"))
        open_ = (join_small(bounds.filter((F.col("before") >= low) & (F.col("before") < high)), reached, "query", "left")
                 .withColumn("least", F.coalesce("least", F.lit(1).cast("long"))).filter("bound >= least"))
        visits = open_.groupBy("m").agg(
            F.max("bound").alias("bound"), F.sort_array(F.collect_list(F.struct("query", "least"))).alias("v")).select(
            "m", "bound", F.col("v.query").alias("queries"), F.col("v.least").alias("least"))
        hits = join_small(index.blocks, shared_table(visits, "visits"), "m").drop("bound", "top").mapInArrow(visit, found_type)
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
        best = shared_table(best.unionByName(hits).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                            .drop("rank"), "best")
        low, high = high, high * WIDER
    return best


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of each query with a score above 0.

    Terms are runs of ASCII letters and digits and all other characters beyond
    ASCII, with A-Z lower-cased. Null and empty texts have none: such documents
    count nowhere and such queries find nothing. Every row of ``docs`` is a document, so
    repeated rows are found as often; a null id is an id, before all others among
    equal scores. Rows that repeat a query's id are one query with the terms of all.
    Equal scores go by id; rows of equal score and id are alike. Empty tables return no
    rows; other columns aren't read. The queries are taken in chunks of bounded size, each of
    them against all documents.
    """
    asked = shared_table(document_terms(queries, item_col, item_text_col, None).select(
        F.col("doc").alias("item"), F.explode(_terms("terms")).alias("term")).filter("term != ''").distinct(), "query_terms")
    words = asked.select("term").distinct()
    vocabulary = None
    if measured_bytes(words) <= VOCABULARY_BYTES:
        vocabulary = frozenset(r["term"].encode() for r in words.collect())
    index = Index(docs, id_col, text_col, vocabulary)
    weighted = shared_table(join_small(asked, index.terms, "term"), "weighted_terms")
    count = weighted.select("item").distinct().count()
    chunks = max(-(-measured_bytes(weighted) // QUERY_BYTES), -(-count // QUERIES), 1)
    out = None
    for chunk in range(chunks):
        own = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(chunks)) == chunk) if chunks > 1 else weighted
        items = [r["item"] for r in own.select("item").distinct().orderBy("item").collect()]  # bounded by the chunk
        numbers = own.sparkSession.createDataFrame(
            list(enumerate(items)), f"query int, item {asked.schema['item'].dataType.simpleString()}")
        numbered = shared_table(own.join(F.broadcast(numbers), own["item"].eqNullSafe(numbers["item"])).select(
            "query", "term", "weight"), "chunk_terms")
        found = _search(index, numbered, items, k).join(F.broadcast(numbers), "query")
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return out.select(F.col("item").alias(item_col), F.row_number().over(order).cast("int").alias("rank"),
                      F.col("doc").alias(id_col), "score")
