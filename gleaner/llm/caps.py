"""Capping records per dominant contributor, the better records kept.

Records get one ordered number for their quality (best first). Per contributor a histogram over bins of that number is
counted (mergeable, so it is combined before the shuffle); the bin in which the cap is met is the cutoff. Records in
better bins stay and in worse bins go without being ranked. The cutoff bin is refined once by the exact quality, and
only records of the one quality at the border are ranked, by their tie breaker.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import handle_key, strip
from gleaner.operators.lookup import lookup_join
from gleaner.runtime import fingerprint, materialise

CONFIDENCE_ORDER = ("high", "medium", "low")
_TIME_BITS = 40


@dataclass(frozen=True)
class CapSettings:
    """cap: records that stay per group, or share: the part of all counted records that one group may have (at least one
    record). bin_bits: a bin spans 2**bin_bits seconds of one confidence."""

    cap: int | None = 8
    share: float | None = None
    bin_bits: int = 22


def confidence_rank(c: Column) -> Column:
    """0 high, 1 medium, 2 low, however written; 3 for anything else or missing."""
    word = F.lower(strip(c))
    rank = F.lit(3)
    for i, name in reversed(list(enumerate(CONFIDENCE_ORDER))):
        rank = F.when(word == name, i).otherwise(rank)
    return rank


def quality_number(rank: Column, at: Column) -> Column:
    """Lower is better: rank first, then the later time; a missing time comes last within its rank."""
    latest = (1 << (_TIME_BITS - 1)) - 1
    age = F.least(F.greatest(F.lit(latest) - at, F.lit(0)), F.lit((1 << _TIME_BITS) - 2))
    return F.shiftleft(rank.cast("bigint"), _TIME_BITS) + F.when(at.isNull(), (1 << _TIME_BITS) - 1).otherwise(age)


def _first_bin_over(counts: DataFrame, keys: Sequence[str], bin_col: str, limit: Column) -> DataFrame:
    """Of each group with more than limit records: the bin in which the limit is met (or would be passed), the records
    before it, and those of the group."""
    upto = Window.partitionBy(*keys).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    return (
        counts.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
        .where((F.col("total") > limit) & (F.col("upto") >= limit) & (F.col("upto") - F.col("n") < limit))
        .select(*keys, F.col(bin_col).alias("cut"), (F.col("upto") - F.col("n")).alias("before"), "total")
    )


def cutoffs(records: DataFrame, keys: Sequence[str], settings: CapSettings = CapSettings()) -> DataFrame:
    """Per group over the cap: cut_quality and cut_tie of the last record that stays, and total, its records.

    records: keys, `quality` bigint (lower is better) and `tie` bigint (lower is better, unique). Groups up to the cap
    have no row.
    """
    keys = list(keys)
    limit = settings.cap
    if settings.share is not None:
        limit = max(1, int(records.count() * settings.share))
    if limit is None or limit < 1:
        raise ValueError("a cap or share of at least one record is needed")
    bound = F.lit(limit)
    binned = records.withColumn("bin", F.shiftright("quality", settings.bin_bits))
    coarse = _first_bin_over(binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")), keys, "bin", bound)
    coarse = materialise(coarse, "cutoff")
    border = lookup_join(binned, coarse, keys, "total").where(F.col("bin") == F.col("cut"))
    fine_upto = Window.partitionBy(*keys).orderBy("quality").rowsBetween(Window.unboundedPreceding, 0)
    fine = (
        border.groupBy(*keys, "quality", "before", "total").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.col("before") + F.sum("n").over(fine_upto))
        .where((F.col("upto") >= bound) & (F.col("upto") - F.col("n") < bound))
        .select(*keys, F.col("quality").alias("cut_quality"), (bound - F.col("upto") + F.col("n")).alias("places"), "total")
    )
    fine = materialise(fine, "cutoff")
    ties = lookup_join(border.drop("before", "total"), fine, keys, "total").where(F.col("quality") == F.col("cut_quality"))
    # the limit on the rank goes below the shuffle, so that a task never gets more than `limit` rows of a group per sender
    ranked = ties.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("tie"))).where(F.col("rank") <= limit)
    return (
        ranked.where(F.col("rank") <= F.col("places"))
        .groupBy(*keys, "cut_quality", "total")
        .agg(F.max("tie").alias("cut_tie"))
    )


def beyond_cap(records: DataFrame, keys: Sequence[str], settings: CapSettings = CapSettings()) -> DataFrame:
    """The records (all their columns) beyond the cap of their group. Names starting with `_cap_` are the operator's own."""
    cuts = cutoffs(records.select(*keys, "quality", "tie"), keys, settings)
    cuts = cuts.select(*keys, F.col("cut_quality").alias("_cap_q"), F.col("cut_tie").alias("_cap_t"), F.col("total").alias("_cap_n"))
    joined = lookup_join(records, cuts, keys, "_cap_n")
    worse = (F.col("quality") > F.col("_cap_q")) | ((F.col("quality") == F.col("_cap_q")) & (F.col("tie") > F.col("_cap_t")))
    return joined.where(worse).select(records.columns)


def claim_records(claims: DataFrame) -> DataFrame:
    """Claims that count: the lowest claim_row of those equal in source_key, store, category and claim (null equals
    null), with a store and a named author. Columns contributor, store, quality, tie (claim_row)."""
    marked = claims.select(
        *[c.alias(f"f{i}") for i, c in enumerate(fingerprint("source_key", "store", "category", "claim"))],
        handle_key(F.col("author")).alias("contributor"), "store",
        quality_number(confidence_rank(F.col("confidence")), F.col("created_utc")).alias("quality"), F.col("claim_row").alias("tie"),
    )
    first = marked.groupBy("f0", "f1").agg(F.min("tie").alias("tie"))
    counted = marked.where(F.col("contributor").isNotNull() & (F.col("store") != "") & F.col("tie").isNotNull()).drop("f0", "f1")
    return counted.join(first.select("tie"), "tie", "left_semi").select("contributor", "store", "quality", "tie")


def claims_beyond_cap(claims: DataFrame, settings: CapSettings = CapSettings()) -> DataFrame:
    """claim_row of the claims beyond the best `cap` of an author about one store. An empty table gives none; claims
    without author, store, confidence or time are treated as said at claim_records and quality_number."""
    records = materialise(claim_records(claims), "records")
    return beyond_cap(records, ["contributor", "store"], settings).select(F.col("tie").alias("claim_row"))
