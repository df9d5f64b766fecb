"""Joins that a hot key cannot pile onto one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slices a key's rows are spread over.
SALTS = 16


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    *,
    spread: Column,
    salts: int = SALTS,
) -> DataFrame:
    """`rows` joined to a `lookup` that holds each key once.

    Rows are spread over `salts` slices by a hash of `spread`, and every lookup row is
    repeated per slice. A key with a third of all rows then meets its lookup row in
    `salts` tasks. The output is not partitioned by the keys, so a grouping on them
    that follows combines before it shuffles, and adaptive execution is free to split
    a slice that is still too large.

    The lookup should be narrow: it travels `salts` times.
    """
    slices = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", slices)
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
