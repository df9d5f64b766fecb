"""Limits on a large scan that go to every task, and whose size does not grow with the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots that keys are hashed to.
SLOTS = 1 << 20
#: Slots per broadcast row: the bits of a long.
WORD = 64


def slot(keys: Sequence[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def used_slots(wanted: DataFrame, keys: Sequence[str], *, slots: int = SLOTS) -> DataFrame:
    """The slots that the keys of `wanted` fall into, as bits: `slots` / `WORD` rows at most.

    Words are combined before they shuffle, so no task sends more rows than that either.
    """
    return (
        wanted.select(slot(keys, slots).alias("_used"))
        .groupBy(F.floor(F.col("_used") / WORD).cast("int").alias("_word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, _used % {WORD})")).alias("_bits"))
    )


def among(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], *, slots: int = SLOTS) -> DataFrame:
    """`rows` without most of those whose key `wanted` lacks, and with all whose key it has.

    A Bloom filter of one hash: the slots that wanted keys fall into are broadcast, one bit
    each, whatever the number of keys, and rows of other slots are dropped where they are read.
    The driver, which collects what is broadcast, gets a row of `WORD` slots and not one of each.
    Of n wanted keys the share n / slots of the other rows passes; with far more keys than slots
    nothing is dropped. A join or a condition has to decide on the rest.
    """
    used = F.broadcast(used_slots(wanted, keys, slots=slots))
    marked = rows.withColumn("_slot", slot(keys, slots))
    held = F.expr(f"getbit(_bits, _slot % {WORD}) = 1")
    same_word = F.floor(F.col("_slot") / WORD).cast("int") == F.col("_word")
    return marked.join(used, same_word & held, "left_semi").drop("_slot")
