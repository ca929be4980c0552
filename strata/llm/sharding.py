"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table (an offset and a step,
both hashed from its name, give a permutation). The shards take turns, each claiming its next
free slot, until the table is full, so shares differ by one slot at most and adding or losing a
shard moves little else. The table has ``slots`` entries whatever the data's size; it is
broadcast, and placing a document is one hash and one look-up.

Defined cases: a null id is placed by its text, a null text counting as empty; repeated rows go
to one shard; an empty table gives no rows; further columns are carried along.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

SHARDS = 32
SLOTS = 3203  # prime, about 100 slots a shard: shares within one per cent
HEX_DIGITS = 14  # of an MD5, so that the number stays within 56 bits


def hashed(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX_DIGITS], 16)


def lookup_table(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard that owns each slot."""
    if not 0 < shards <= slots or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime and not less than the number of shards")
    offset = [hashed(f"offset-{s}") % slots for s in range(shards)]
    step = [hashed(f"step-{s}") % (slots - 1) + 1 for s in range(shards)]
    owner, turn, reached = [-1] * slots, 0, [0] * shards
    for turn in range(slots):
        s = turn % shards
        while owner[slot := (offset[s] + reached[s] * step[s]) % slots] >= 0:
            reached[s] += 1
        owner[slot] = s
    return owner


def slot_of(slots: int = SLOTS) -> Column:
    """Slot of a document: MD5 of its id (of its text where there is no id) modulo the slots."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), text_or_empty()))
    digits = F.substring(F.md5(key.cast("binary")), 1, HEX_DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``slot, shard``: the look-up table, ``slots`` rows."""
    owners = ",".join(map(str, lookup_table(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")).select(
        "slot", F.col("shard").cast("int").alias("shard"))


def place(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (columns of those names are replaced)."""
    keyed = docs.drop("slot", "shard").withColumn("slot", slot_of(slots))
    return keyed.join(F.broadcast(table_frame(docs.sparkSession, shards, slots)), "slot").select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> None:
    """Write one folder per shard; the rebalance splits a shard that is larger than the
    advisory size over several tasks and files."""
    place(docs, shards, slots).drop("slot").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
