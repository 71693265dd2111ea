"""Per-key results where a few keys hold most rows: exact offset chunking.

Rows are sorted inside each input partition, so rows of one key are contiguous there. Counting keys per input partition
and summing the counts before each partition numbers every row of a key from 0 without a sort of the whole key. A chunk
is a run of `chunk_rows` numbers of one key; every chunk is one aggregation group of bounded size whatever the key, and
the chunks' states are merged in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.runtime import materialise


@dataclass(frozen=True)
class Chunking:
    """chunk_rows: rows of a key that one group handles. ordered: number each key's rows in the order asked for over
    all partitions (range partitioning first), not only within each input partition."""

    chunk_rows: int = 65_536
    ordered: bool = False


def number_rows(df: DataFrame, key: str, order: Sequence[Column] = (), settings: Chunking = Chunking()) -> DataFrame:
    """df with `number` (0, 1, ... within the key) and `chunk`. Null is a key of its own; an empty table stays empty.

    Columns of df named number or chunk are replaced, and names starting with `_oc_` are the operator's own.
    """
    df = df.withColumns({"_oc_key": F.col(key), "_oc_null": F.col(key).isNull()})
    if settings.ordered:
        df = df.repartitionByRange(F.col("_oc_null"), F.col("_oc_key"), *order)
    ordered = (
        df.sortWithinPartitions("_oc_null", "_oc_key", *order)
        .withColumn("_oc_id", F.monotonically_increasing_id())
        .withColumns({"_oc_part": F.shiftright("_oc_id", 33), "_oc_at": F.col("_oc_id").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("_oc_id")
    )
    # written once: counts and numbers must come from the same partitions
    fixed = materialise(ordered, "chunks")
    counts = fixed.groupBy("_oc_null", "_oc_key", "_oc_part").agg(F.count(F.lit(1)).alias("_oc_n"), F.min("_oc_at").alias("_oc_first"))
    before = Window.partitionBy("_oc_null", "_oc_key").orderBy("_oc_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_oc_base", F.coalesce(F.sum("_oc_n").over(before), F.lit(0)) - F.col("_oc_first")).select(
        F.col("_oc_null").alias("_oc_null2"), F.col("_oc_key").alias("_oc_key2"), F.col("_oc_part").alias("_oc_part2"), "_oc_base"
    )
    # one row per key and partition; a partition's rows of a key are at most a partition, so the join has no hot group
    on = (F.col("_oc_part") == F.col("_oc_part2")) & F.col("_oc_key").eqNullSafe(F.col("_oc_key2")) & (F.col("_oc_null") == F.col("_oc_null2"))
    numbered = fixed.join(starts, on, "inner").withColumn("number", F.col("_oc_at") + F.col("_oc_base"))
    return numbered.withColumn("chunk", F.floor(F.col("number") / settings.chunk_rows)).drop(*[c for c in numbered.columns if c.startswith("_oc_")])


def key_counts(df: DataFrame, key: str, settings: Chunking = Chunking()) -> DataFrame:
    """Rows per key (`key_value`, `n_rows`, `n_chunks`), each merged from the counts of its chunks."""
    rows = number_rows(df.select(F.col(key).alias("key_value")), "key_value", settings=settings)
    states = rows.groupBy("key_value", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return states.groupBy("key_value").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_chunks"))


def dominant_keys(df: DataFrame, key: str, share: float = 0.05, settings: Chunking = Chunking()) -> DataFrame:
    """Keys with more than `share` of all rows; rows whose key is null count as rows and null as a key."""
    counts = key_counts(df, key, settings)
    total = counts.agg(F.sum("n_rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("n_rows") > F.col("total") * share).select("key_value", "n_rows", "n_chunks")


def gap_profile(df: DataFrame, key: str, time: str, tie: str, measure: Column, settings: Chunking = Chunking(ordered=True)) -> DataFrame:
    """Per key: rows, first and last time, longest gap between neighbours in time, sum of a measure.

    Gaps inside a chunk come from a window over that chunk alone; the gap between two chunks from the boundary states
    (last time of one, first of the next). Rows without time count as rows but have no part in gaps.
    """
    rows = df.select(F.col(key).alias("key_value"), F.col(time).alias("at"), F.col(tie).alias("tie"), measure.alias("measure"))
    rows = number_rows(rows, "key_value", [F.col("at").asc_nulls_first(), F.col("tie").asc()], settings)
    within = Window.partitionBy("key_value", "chunk").orderBy("number")
    states = (
        rows.withColumn("gap", F.col("at") - F.lag("at").over(within))
        .groupBy("key_value", "chunk")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"),
            F.max("gap").alias("gap"), F.sum("measure").alias("measure"),
        )
    )
    chunks = Window.partitionBy("key_value").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    seam = F.col("first_at") - F.max("last_at").over(chunks)
    return (
        states.withColumn("gap", F.greatest("gap", seam))
        .groupBy("key_value")
        .agg(
            F.sum("n").alias("n_rows"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
            F.max("gap").alias("longest_gap"), F.sum("measure").alias("measure"),
        )
    )
