"""Extracted claims held against labelled cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIPLE = ["case", "store", "category", "sentiment"]
FLAGS = ("price_signal", "confidence", "transient", "comparator_store")


def expected_claims(gold: DataFrame) -> DataFrame:
    return gold.select(F.col("id").alias("case"), F.posexplode("expected").alias("ord", "c")).select("case", "ord", "c.*")


def _triples(claims: DataFrame) -> DataFrame:
    """One row per triple; of repeated ones the last's flags."""
    flags = F.struct(*[F.col(f) for f in FLAGS if f in claims.columns])
    return claims.groupBy(*TRIPLE).agg(F.max_by(flags, "ord").alias("flags"))


def compare(cases: DataFrame, expected: DataFrame, got: DataFrame) -> DataFrame:
    """case, matched, missed, spurious, flag_misses for each case, errors included as missed. cases: case."""
    e, g = _triples(expected).withColumnRenamed("flags", "ef").withColumn("in_e", F.lit(True)), _triples(got).withColumnRenamed("flags", "gf").withColumn("in_g", F.lit(True))
    both = e.join(g, TRIPLE, "full")
    matched = F.col("in_e") & F.col("in_g")
    counts = both.groupBy("case").agg(
        F.count_if(matched).alias("matched"), F.count_if(F.col("in_g").isNull()).alias("missed"), F.count_if(F.col("in_e").isNull()).alias("spurious"),
        F.count_if(matched & ~F.col("ef").eqNullSafe(F.col("gf"))).alias("flag_misses"),
    )
    return cases.join(counts, "case", "left").fillna(0, ["matched", "missed", "spurious", "flag_misses"])


def score(results: DataFrame) -> DataFrame:
    """One row: precision (null if nothing was emitted), recall (1 if nothing was expected), f1, exact_match, silence
    (of cases without expectation, those with nothing emitted; null without such cases), flag_accuracy."""
    s = results.agg(
        F.sum("matched").alias("tp"), F.sum("missed").alias("fn"), F.sum("spurious").alias("fp"), F.sum("flag_misses").alias("flags"), F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("missed") == 0) & (F.col("spurious") == 0)).alias("exact"), F.count_if(F.col("matched") + F.col("missed") == 0).alias("silent"),
        F.count_if((F.col("matched") + F.col("missed") == 0) & (F.col("spurious") == 0)).alias("kept_silent"),
    )
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(1.0))
    return s.select(
        F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"),
        F.round(F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)), 4).alias("f1"), F.round(F.try_divide("exact", "n"), 4).alias("exact_match"),
        F.round(F.try_divide("kept_silent", "silent"), 4).alias("silence"), F.round(F.try_divide(F.col("tp") - F.col("flags"), F.col("tp")), 4).alias("flag_accuracy"),
    )
