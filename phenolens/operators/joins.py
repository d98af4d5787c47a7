"""Join helpers with an explicit size bound before broadcasting, and a shuffle join that spreads heavy keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if its rows take at most this many bytes (measured, i.e. a
# proven bound); beyond it the join falls back to a shuffle join.
BROADCAST_MAX_BYTES = 64 << 20
# A shuffle join cuts keys so that a partition holds at least this many pieces: it evens out their sizes.
PIECES = 32


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``: 16 a row, 8 a column, and the lengths of strings and arrays."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            size = size + F.lit(8) * F.coalesce(F.size(name), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def join_small(big: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join ``big`` with a side that is *usually* small; both are cheap to read twice.

    Broadcast when its measured size is within ``max_bytes`` (no shuffle of
    ``big``); beyond it an inner or left join on columns goes through ``join_spread``,
    any other is left to Catalyst/AQE.
    """
    if measured_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    if isinstance(on, Column) or how not in ("inner", "left"):
        return big.join(small, on, how)
    return join_spread(big, small, [on] if isinstance(on, str) else on, how)


def heavy_keys(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """(key columns k0, k1, ..., cuts): keys with more rows than one of ``PIECES`` pieces of a partition, and
    into how many such pieces they go. There are fewer of them than pieces, whatever the table's size."""
    counts = df.groupBy(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    piece = max(1, total // (partitions * PIECES))
    found = counts.where(F.col("n") > piece).withColumn("cuts", F.ceil(F.col("n") / F.lit(piece)).cast("int")).drop("n")
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def join_spread(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Shuffle join of ``big`` with a side unique on ``keys``, in which no key makes a large partition.

    The rows of a heavy key are dealt over several numbers by a hash of the whole row; only the heavy
    keys' rows of ``small`` are repeated, once per number. All rows stay, NULL keys match nothing
    (and are dealt out likewise in a left join). ``big`` is read once more, for the counts by key.
    """
    partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(big, keys, partitions))
    number, cuts = "_number", "_cuts"
    while {number, cuts} & {*big.columns, *small.columns}:
        number, cuts = number + "_", cuts + "_"

    def cut(df: DataFrame) -> DataFrame:
        known = heavy.withColumnRenamed("cuts", cuts)
        match = [df[f"`{k}`"].eqNullSafe(known[f"k{i}"]) for i, k in enumerate(keys)]
        return df.join(known, reduce(lambda a, b: a & b, match), "left").select(
            df["*"], F.coalesce(known[cuts], F.lit(1)).alias(cuts))

    row = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    dealt = cut(big).withColumn(number, F.pmod(row, F.col(cuts)).cast("int")).drop(cuts)
    copies = cut(small).withColumn(number, F.explode(F.sequence(F.lit(0), F.col(cuts) - 1))).drop(cuts)
    return dealt.join(copies, [*keys, number], how).drop(number)


def subtract_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (every copy removed).

    NULL keys compare equal (as RDD set operations do), so a NULL-key row is
    removed when ``right`` has one. Left duplicates are kept, unlike
    ``exceptAll``, which removes one copy per match.
    """
    r = right.select(F.col(key).alias("_k")).distinct()
    return left.join(r, left[key].eqNullSafe(r["_k"]), "left_anti")


def intersect_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that also occur in ``right`` (null-safe)."""
    r = right.select(F.col(key).alias("_k")).distinct()
    return left.select(key).distinct().join(r, F.col(key).eqNullSafe(r["_k"]), "left_semi")
