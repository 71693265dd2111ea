"""Joining many rows with a table of unique keys without a hot task and without an unchecked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.runtime import materialise

#: Rows of a narrow table (keys and a few numbers) that are broadcast; some 20 MB.
BROADCAST_ROWS = 200_000
HEAVY_KEYS = 1_000


def lookup_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join on keys; `weight` is the table's column with the number of rows each key has.

    The table is counted first. Up to broadcast_rows it is broadcast. Beyond, only its HEAVY_KEYS heaviest keys are, so
    that their rows stay where they are, and the rest is joined by a shuffle. Null keys match nothing.
    """
    keys = list(keys)
    table = materialise(table, "lookup")
    if table.count() <= broadcast_rows:
        return rows.join(F.broadcast(table), keys)
    heavy = materialise(table.orderBy(F.desc(weight), *keys).limit(HEAVY_KEYS), "heavy")
    light = table.join(F.broadcast(heavy.select(keys)), keys, "left_anti")
    hot = rows.join(F.broadcast(heavy), keys)
    cold = rows.join(F.broadcast(heavy.select(keys)), keys, "left_anti").join(light, keys)
    return hot.unionByName(cold)


def left_counts(rows: DataFrame, table: DataFrame, key: str, weight: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join with a narrow table unique on key, whose `weight` is the number of rows the key has. The table is counted
    first; up to broadcast_rows it is broadcast, beyond see left_lookup."""
    table = materialise(table, "lookup")
    if table.count() <= broadcast_rows:
        return rows.join(F.broadcast(table), key, "left")
    return left_lookup(rows, table, key, materialise(table.orderBy(F.desc(weight), key).limit(HEAVY_KEYS).select(key), "heavy"))


def heavy_keys(rows: DataFrame, key: str, most: int = HEAVY_KEYS) -> DataFrame:
    """The keys with most rows, at most so many; null is none."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return materialise(counts.orderBy(F.desc("n"), key).limit(most).select(key), "heavy")


def left_lookup(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Left join with a table unique on key. Rows of heavy keys (as from heavy_keys) and rows without key stay where they
    are: for those only the heavy keys' part of the table, bounded as they are, is broadcast."""
    marked = heavy.withColumn("_heavy", F.lit(True))
    split = rows.join(F.broadcast(marked), key, "left")
    few = table.join(F.broadcast(heavy), key, "left_semi")
    hot = split.where(F.col("_heavy") | F.col(key).isNull()).join(F.broadcast(few), key, "left")
    cold = split.where(F.col("_heavy").isNull() & F.col(key).isNotNull()).join(table, key, "left")
    return hot.unionByName(cold).drop("_heavy")
