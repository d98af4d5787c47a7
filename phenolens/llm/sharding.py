"""Jump consistent hashing of stable keys to shards (column expressions only).

Lamping and Veach's function needs no ring table: the shard of a key follows
from the key and the number of shards alone, and with one more shard a key
either stays or moves into the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the multiplier of the published function's generator.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH, _MASK32 = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32, (1 << 32) - 1
#: Groups per shard in which positions are counted; bounds the table of offsets.
SLOT_GROUPS = 1024


def _next_state(k: Column) -> Column:
    """k * MULTIPLIER + 1 modulo 2^64. Products of halves and quarters stay below
    2^63, so nothing overflows where ANSI mode would raise an error."""
    mask16, mask32 = F.lit(0xFFFF).cast("long"), F.lit(_MASK32)
    low = k.bitwiseAND(mask32)
    l0, l1 = low.bitwiseAND(mask16), F.shiftrightunsigned(low, 16) * F.lit(_LOW)
    h0 = F.shiftrightunsigned(k, 32).bitwiseAND(mask16)
    h1 = F.shiftrightunsigned(k, 48) * F.lit(_LOW)
    bottom = l0 * F.lit(_LOW) + F.shiftleft(l1.bitwiseAND(mask16), 16) + F.lit(1).cast("long")
    top = (F.shiftrightunsigned(bottom, 32) + F.shiftrightunsigned(l1, 16) + low * F.lit(_HIGH)
           + h0 * F.lit(_LOW) + F.shiftleft(h1.bitwiseAND(mask16), 16))
    return F.shiftleft(top.bitwiseAND(mask32), 32).bitwiseOR(bottom.bitwiseAND(mask32))


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard (int, 0 to ``n_shards`` - 1) of a long ``key``; a null key counts as 0."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    if n_shards == 1:
        return F.lit(0)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def jump(state: Column, _i: Column) -> Column:
        target = F.floor((state["shard"] + F.lit(1)).cast("double")
                         * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(state["k"], 33) + F.lit(1)).cast("double")))
        return F.when(target < n_shards, F.struct(_next_state(state["k"]).alias("k"), target.alias("shard"))
                      ).otherwise(state)

    start = F.struct(_next_state(key).alias("k"), F.lit(0).cast("long").alias("shard"))
    # every jump moves on by one shard at least
    return F.aggregate(F.sequence(F.lit(1), F.lit(n_shards - 1)), start, jump,
                       lambda s: s["shard"].cast("int"))


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                    slot_groups: int = SLOT_GROUPS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    An integer id is the key itself; any other id is hashed to a long first. ``size``
    is the UTF-8 length plus 1 (a null text has none and counts as empty),
    ``grown_shard`` the shard with one more shard. A null id counts as key 0.
    ``slot`` numbers the rows of a shard from 0 without gaps, by slot group, id,
    checksum and size; rows equal in all of these take their slots in any order.
    An empty table gives an empty table; other columns are not looked at.

    Two passes: ids alone give the counts of ``n_shards * slot_groups`` groups,
    whose running sums (at most that many rows) are broadcast; then one shuffle
    of the narrow rows by group, never by shard, numbers them.
    """
    kind = docs.schema[id_col].dataType.typeName()
    key = F.col("doc_id") if kind in ("long", "integer", "short", "byte") else F.xxhash64("doc_id")
    group = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(slot_groups)).cast("int")
    ids = docs.select(F.col(id_col).alias("doc_id"))
    offsets = (ids.select(jump_hash(key, n_shards).alias("shard"), group.alias("slot_group"))
               .groupBy("shard", "slot_group").agg(F.count("*").alias("n"))
               .select("shard", "slot_group", (F.sum("n").over(
                   Window.partitionBy("shard").orderBy("slot_group")) - F.col("n")).alias("first_slot")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
            .withColumns({"shard": jump_hash(key, n_shards), "slot_group": group}))
    within = Window.partitionBy("shard", "slot_group").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("within", F.row_number().over(within))
            .join(F.broadcast(offsets), ["shard", "slot_group"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first_slot") + F.col("within") - 1).alias("slot"),
                    jump_hash(key, n_shards + 1).alias("grown_shard")))
