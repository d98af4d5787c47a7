"""Near-duplicate detection with SetSketch registers.

A document's registers are exponentially spaced, truncated minima of hashes of
its shingles; registers of a union are the element-wise maximum. Bands of
registers find candidates, their likelihood under the joint distribution of two
sketches rules out what is too dissimilar, and full shingle sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolens.llm.common import NULL_ID, connected_components, shared_table

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Registers come in BANDS of ROWS. Two sets of similarity 0.85 share no band with probability 3e-7.
BANDS, ROWS = 32, 6
#: Base, rate and largest value of the registers.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
#: A pair is ruled out if its registers are exp(-EVIDENCE) times as likely as under the least similarity of a link.
EVIDENCE = 16.0
#: Bytes of shingle sets compared in one piece of work; larger groups are compared block by block.
BLOCK_BYTES = 24 << 20

_SEED = np.random.default_rng(20240229)
_FACTORS = _SEED.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_A = _SEED.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _SEED.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND_FACTORS = _SEED.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SALT = _SEED.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, seen: dict[bytes, int] | None = None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    Bytes methods lower-case A-Z alone and split at ASCII white space alone. With
    fewer words than ``width`` the whole sequence is one shingle; without any the
    set is empty. ``seen`` keeps the hashes of words between calls."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    seen = {} if seen is None else seen
    if len(seen) > 500_000:
        seen.clear()
    hashes = np.fromiter((seen[w] if w in seen else seen.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words),
                         np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(width, len(words))):
        total += hashes[k:k + n] * _FACTORS[k % SHINGLE]
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes; 0 for the empty set."""
    if not len(hashes):
        return np.zeros(BANDS * ROWS, np.uint16)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, (1 << 32) - 1, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (x[i:i + 1024, None] * _A + _B).min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    r = regs.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((r * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SALT).view(np.int64)


def _step(x: np.ndarray) -> np.ndarray:
    """Probability that a register of the one set is larger, for ``x`` the share only this set adds."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def _probabilities(n_a, n_b, similarity) -> tuple[np.ndarray, np.ndarray]:
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    return _step(u - v * similarity), _step(v - u * similarity)


def _log_likelihood(larger, smaller, equal, n_a, n_b, similarity):
    p, q = _probabilities(n_a, n_b, similarity)
    p, q = np.maximum(p, 1e-12), np.maximum(q, 1e-12)
    return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))


def joint_similarity(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Maximum-likelihood similarity of two sets of known sizes from their registers."""
    grid = np.linspace(0, min(n_a, n_b) / max(n_a, n_b), 1001)
    larger, smaller = (a > b).sum(), (a < b).sum()
    return float(grid[np.argmax(_log_likelihood(larger, smaller, len(a) - larger - smaller, n_a, n_b, grid))])


def ruled_out(regs: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which of ``others`` can't be links, by size or because their registers are too unlikely."""
    larger, smaller = (regs > others).sum(axis=1), (regs < others).sum(axis=1)
    equal = regs.shape[0] - larger - smaller
    m, similarity = regs.shape[0], percent / 100
    p, q = _probabilities(n, sizes, similarity)
    floor = _log_likelihood(larger, smaller, equal, n, sizes, similarity)
    with np.errstate(divide="ignore", invalid="ignore"):
        best = sum(np.where(k > 0, k * np.log(k / m), 0) for k in (larger, smaller, equal))
    unlikely = (equal < m * (1 - p - q)) & (best - floor > EVIDENCE)
    return unlikely | (100 * np.minimum(n, sizes) < percent * np.maximum(n, sizes))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def links(ids: list[int], block: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, first: int, second: int,
          percent: int = PERCENT) -> list[tuple[int, int]]:
    """Confirmed links that connect what is connected: a spanning forest of at most len(ids) - 1 links.

    Compares every pair of a member of block ``first`` and one of block ``second``
    unless they are connected already or ruled out."""
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes, found = np.array([len(s) for s in sets]), []
    at = {b: np.flatnonzero(block == b) for b in (first, second)}
    for n, i in enumerate(at[first]):
        others = at[second][n + 1:] if first == second else at[second]
        if not len(others):
            continue
        others = others[~ruled_out(regs[i], regs[others], sizes[i], sizes[others], percent)]
        likely = np.argsort(-(regs[others] == regs[i]).sum(axis=1), kind="stable") if len(others) else []
        for j in others[likely] if len(others) else []:
            a, b = root(i), root(j)
            if a != b and linked(sets[i], sets[j], percent):
                parent[a] = b
                found.append((ids[i], ids[j]))
    return found


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        for f in frames:
            rows = []
            for doc, text in zip(f["id"], f["text"], strict=True):
                s = shingles(text, seen, width)
                rows.append((doc, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None,
                             band_keys(registers(s)) if len(s) else None))
            yield pd.DataFrame(rows, columns=["id", "n_shingles", "set_hash", "bands"])

    return _narrow(docs, id_col, text_col).mapInPandas(sketch, "id long, n_shingles long, set_hash binary, bands array<long>")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("text"))


def near_links(docs: DataFrame, representatives: DataFrame, id_col: str, text_col: str, width: int,
               percent: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Confirmed links (a, b) between ``representatives`` (id, n_shingles, bands) that connect what is connected.

    Documents that share a band key are joined to the smallest id of the key, never
    to each other, which gives groups outside of which there is no candidate. Within
    a group, sets are compared in tasks of at most two blocks of ``block_bytes``."""
    keys = representatives.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    edges = keys.join(shared, "key").filter("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    groups = connected_components(edges.distinct(), "near_groups").select(
        F.col("node").alias("id"), F.col("component").alias("group"))
    sized = shared_table(representatives.select("id", "n_shingles").join(groups, "id"), "near_sized")
    n_blocks = sized.groupBy("group").agg(
        F.ceil(F.sum(F.col("n_shingles") * 8 + 1024) / F.lit(block_bytes)).cast("int").alias("n_blocks"))
    members = (sized.join(n_blocks, "group").select("id", "group", "n_blocks").distinct()
               .withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")))
    # one plan at every size: without the hint a small table of members would be broadcast
    texts = _narrow(docs, id_col, text_col).join(members.hint("merge"), "id")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        for f in frames:
            f["shingles"] = [shingles(t, seen, width).tobytes() for t in f["text"]]
            yield f[["group", "n_blocks", "block", "id", "shingles"]]

    work = (texts.mapInPandas(sets, "group long, n_blocks int, block int, id long, shingles binary")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
            .select("group", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
                    "block", "id", "shingles")
            .repartition("group", "first", "second").sortWithinPartitions("group", "first", "second"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(key: tuple, rows: list) -> pd.DataFrame:
            found = []
            if len(rows) > 1:
                held = [np.frombuffer(r[2], np.uint64) for r in rows]
                found = links([r[1] for r in rows], np.array([r[0] for r in rows]), held,
                              np.stack([registers(s) for s in held]), key[1], key[2], percent)
            return pd.DataFrame(found, columns=["a", "b"])

        current, rows = None, []
        for f in frames:
            for group, first, second, *row in f.itertuples(index=False, name=None):
                if (group, first, second) != current:
                    if rows:
                        yield solve(current, rows)
                    current, rows = (group, first, second), []
                rows.append(row)
        if rows:
            yield solve(current, rows)

    return work.mapInPandas(compare, "a long, b long")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Documents are linked if their sets of shingles are similar enough;
    ``component_id`` is the smallest id reachable by links. Texts without words have
    empty sets and are linked with nothing. Rows that share an id are one document,
    linked by the sets of all of them; the null id is the smallest. Other columns are
    not looked at, and an empty table gives an empty one.

    Documents of one set are collapsed to that with the smallest id first, by a
    grouped minimum, so that a large group of copies costs one row per copy.
    """
    sketches = shared_table(_sketches(docs, id_col, text_col, width), "near_sketches")
    classes = shared_table(
        sketches.filter("set_hash is not null").groupBy("set_hash")
        .agg(F.min("id").alias("representative"), F.count("*").alias("copies")).filter("copies > 1")
        .select("set_hash", "representative"), "near_classes")
    representatives = (sketches.filter("set_hash is not null").join(classes, "set_hash", "left")
                       .filter("representative is null or id = representative").select("id", "n_shingles", "bands"))
    found = near_links(docs, representatives, id_col, text_col, width, percent)
    copies = sketches.join(classes, "set_hash").select(F.col("id").alias("a"), F.col("representative").alias("b"))
    # rows of one id may belong to several classes; else copies hang on their representative alone
    several = (sketches.groupBy("id").agg(F.count_distinct("set_hash").alias("sets")).filter("sets > 1").select("id"))
    bridges = copies.join(several, copies["a"] == several["id"], "left_semi")
    components = connected_components(found.unionByName(bridges), "near_components")
    rows = sketches.select("id", "n_shingles", "set_hash").join(classes, "set_hash", "left").withColumn(
        "representative", F.coalesce("representative", "id"))
    joined = rows.join(components, rows["representative"] == components["node"], "left").withColumn(
        "component_id", F.coalesce("component", "representative"))
    return joined.select(_id("id").alias("doc_id"), "n_shingles", _id("component_id").alias("component_id"),
                         (F.col("id") == F.col("component_id")).alias("kept"))


def _id(name: str) -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: those of each group's smallest id."""
    kept = near_dedup(docs, id_col, text_col, **options).filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["__id"]), "left_semi")
