"""Joins of rows with a small side, whose size is checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_checked(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = 20_000, salts: int = 32) -> DataFrame:
    """Join a table with one row per key to rows of which one key may hold a large share.

    Broadcast if a count proves that the side has at most max_rows rows; else both are salted: the rows by their
    place in the partition, the side by a copy for each salt. With one salt no copies are made, for rows that stay together afterwards
    anyway. The join is a merge then, as Spark would judge the copies by the size of the side's files and might broadcast them.
    """
    if side.limit(max_rows + 1).count() <= max_rows:
        return rows.join(F.broadcast(side), list(keys), how)
    if salts == 1:
        return rows.join(side.hint("merge"), list(keys), how)
    spread = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies.hint("merge"), [*keys, "__salt"], how).drop("__salt")
