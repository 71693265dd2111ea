"""Weights, scales and distances as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings

SECONDS_PER_YEAR = 365.25 * 24 * 3600


def lookup(c: Column, table: dict[str, float], default: float | None) -> Column:
    """A small fixed table as an expression (no join)."""
    out = F.lit(default).cast("double")
    for key, value in table.items():
        out = F.when(c == key, F.lit(float(value))).otherwise(out)
    return out


def recency_weight(created: Column, now: int, half_life: Column | float) -> Column:
    """0.5 ** (age / half-life); 1 for the future."""
    years = F.greatest((F.lit(now) - created) / F.lit(SECONDS_PER_YEAR), F.lit(0.0))
    return F.pow(F.lit(0.5), years / half_life)


def half_life(category: Column, s: Settings) -> Column:
    return lookup(category, s.half_lives, s.default_half_life)


def vote_weight(score: Column) -> Column:
    return F.when(score.isNull(), 1.0).when(score < 0, 0.5).otherwise(F.least(1.0 + F.log1p(score.cast("double")) / 5.0, F.lit(2.0)))


def confidence_weight(confidence: Column, s: Settings) -> Column:
    return lookup(F.coalesce(confidence, F.lit("")), vocab.CONFIDENCE_WEIGHT, s.default_confidence)


def claim_weight(s: Settings) -> Column:
    """Of a row with created_utc, category, confidence, score."""
    decay = recency_weight(F.col("created_utc"), s.now, half_life(F.col("category"), s))
    return decay * confidence_weight(F.col("confidence"), s) * vote_weight(F.col("score"))


def shrunk(score: Column, weight: Column, s: Settings) -> Column:
    """Weighted mean pulled toward 0; 0 without weight."""
    return F.when(weight == 0, 0.0).otherwise(score / (weight + s.shrinkage))


def price_level(score: Column, weight: Column, s: Settings) -> Column:
    return F.when(weight != 0, score / (weight + s.shrinkage))


def price_label(score: Column, weight: Column, s: Settings) -> Column:
    level = price_level(score, weight, s)
    return F.when(level.isNull() | (weight < s.min_price_weight), None).when(level < -s.label_band, "cheap").when(level > s.label_band, "expensive").otherwise("fair")


def star_scale(stars: Column) -> Column:
    """1..5 onto -1..+1."""
    return (stars - 3.0) / 2.0


def month(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM")


def metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2.0))
    return F.lit(2 * 6_371_000.0) * F.asin(F.sqrt(a))


def cell_value(sentiment: Column, level: Column, preference: float) -> Column:
    """One number for quality and price; preference 0 is cheapest, 1 is best. Without price only quality's part counts."""
    return F.when(level.isNull(), F.lit(preference) * sentiment).otherwise(F.lit(preference) * sentiment + F.lit(1 - preference) * -level)
