"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolens.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stands in for a null id inside an operator: it sorts before every other id.
NULL_ID = -(1 << 63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` is used where it does the same
    (text of one-byte characters only), because ``translate`` goes character by
    character through a dictionary."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


#: Bytes of UTF-8 to words: A-Z lower-cased, all ASCII but letters and digits made blanks.
WORD_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def word_bytes(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text: runs of ASCII letters (lower-cased), digits and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split()


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as it takes to be no column of ``df`` (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: later jobs read files that outlive any executor instead of
    computing ``df`` again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int, bytes_per_row: int) -> DataFrame:
    """Mark ``df`` for broadcasting if its counted rows stay within ``max_bytes``.

    Beyond that the join is left to Catalyst, which shuffles it. ``df`` should be
    cheap to read (a written table): it is counted here and read again by the join."""
    return F.broadcast(df) if df.count() * bytes_per_row <= max_bytes else df


def connected_components(edges: DataFrame, name: str = "components", a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges``.

    Alternates large-star and small-star steps on the edge list (each a grouped
    minimum and one join), writing every round to the shared folder. It ends when
    a round changes nothing; each edge then joins a node to its component's
    smallest node. Only two sums per round reach the driver. Nodes need an order;
    edges whose ends are equal or null carry no information and are left out."""
    cur = shared_table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), name)
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.join(low, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # after the large star every edge still runs from the larger node u to the smaller v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter(F.col("u") != F.col("v")).distinct())
        cur = shared_table(small, name)
        new = _state(cur)
        if new == state:
            break
        state = new
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    """Count and an order-free digest of an edge list (bit_xor and a bounded sum of hashes)."""
    h = F.xxhash64("u", "v")
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"),
                  F.sum(F.shiftrightunsigned(h, 33)).alias("s")).first()
    return r["n"], r["x"], r["s"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
