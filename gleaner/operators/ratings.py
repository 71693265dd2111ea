"""Numeric ratings: cleaning, decayed summaries per store and per place, and matching of listings with map pins."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.runtime import materialise

#: Open edges from which the matching ends by going through them in one task; some 20 MB.
FEW_EDGES = 200_000


def usable_reviews(reviews: DataFrame) -> DataFrame:
    """Rows with a rating of 1 to 5 and a time, the latter in milliseconds whatever unit it came in; only what ratings need."""
    t = F.col("time")
    ms = (
        F.when(t >= 100_000_000_000_000, F.floor(t / 1000))
        .when(t < 100_000_000_000, t * 1000)
        .otherwise(t)
        .cast("bigint")
    )
    kept = reviews.where(F.col("rating").between(1.0, 5.0) & t.isNotNull())
    return kept.select("store", "gmap_id", "rating", ms.alias("time"), F.coalesce("text_len", F.lit(0)).alias("text_len"))


def summarise(reviews: DataFrame, keys: Sequence[str], s: Settings = Settings(), half_life: float | None = None, digits: int = 4) -> DataFrame:
    """Per group: count, means (plain, decayed, of long reviews) and their -1..+1 forms, effective count, months.

    The median month is that of the upper median time. Months keep the order of times, so it is read from counts per
    month instead of from a sorted list of all times; a group of any size costs as many rows as it has months.
    """
    keys = list(keys)
    rows = reviews
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    w = scoring.recency_weight(F.floor(F.col("time") / 1000), s.now, half_life or s.default_half_life)
    monthly = (
        rows.withColumns({"w": w, "month": scoring.month(F.floor(F.col("time") / 1000)), "long": F.col("text_len") >= s.review_chars})
        .groupBy(*keys, "month")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), F.sum("w").alias("n_eff"), F.sum(F.col("w") * F.col("rating")).alias("w_stars"),
            F.count_if("long").alias("n_long"), F.sum(F.when(F.col("long"), F.col("rating"))).alias("long_stars"),
        )
    )
    by_month = Window.partitionBy(*keys).orderBy("month") if keys else Window.orderBy("month")
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    upto = F.sum("n").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
    middle = F.floor(F.sum("n").over(whole) / 2)
    marked = monthly.withColumn("is_median", (upto > middle) & (upto - F.col("n") <= middle))
    sums = marked.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n", "stars", "n_eff", "w_stars", "n_long", "long_stars")],
        F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.max(F.when(F.col("is_median"), F.col("month"))).alias("median_month"),
    )
    mean, recent = F.col("stars") / F.col("n"), F.coalesce(F.try_divide(F.col("w_stars"), F.col("n_eff")), F.col("stars") / F.col("n"))
    long = F.try_divide(F.col("long_stars"), F.col("n_long").cast("double"))
    return sums.select(
        *keys, "n", F.round(mean, digits).alias("mean"), F.round(scoring.star_scale(mean), digits).alias("norm"), F.round("n_eff", digits).alias("n_eff"),
        F.round(recent, digits).alias("mean_recent"), F.round(scoring.star_scale(recent), digits).alias("norm_recent"), "n_long",
        F.round(long, digits).alias("mean_long"), F.round(scoring.star_scale(long), digits).alias("norm_long"), (F.col("n") < s.min_ratings).alias("thin"),
        "first_month", "last_month", "median_month",
    )


def pins(places: DataFrame) -> DataFrame:
    """One row per map element: of repeated ones the last seen; without usable coordinates none."""
    last = Window.partitionBy("osm").orderBy(F.desc("place_id"))
    ok = F.col("osm").isNotNull() & F.col("store").isNotNull() & F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & ~((F.col("lat") == 0) & (F.col("lon") == 0))
    return places.where(ok).withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn")


def nearby(listings: DataFrame, places: DataFrame, s: Settings = Settings()) -> DataFrame:
    """gmap_id, osm, metres of listings and pins of one store within match_metres.

    Both sides get the cell of a grid a little wider than the limit; listings (the smaller side) are put into the nine
    cells around theirs. The join is by store and cell, so no store's listings meet all its pins.
    """
    step = s.match_metres / 111_000.0 * 1.05
    # a degree of longitude is shorter: the widest latitude present sets the width, so that no neighbour is missed
    widest = places.agg(F.max(F.abs("lat")).alias("a")).unionByName(listings.agg(F.max(F.abs("latitude")).alias("a"))).agg(F.max("a")).first()[0] or 0.0
    wide = step / max(math.cos(math.radians(min(widest, 89.0))), 0.01)
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    left = (
        listings.where("latitude is not null and longitude is not null and gmap_id is not null and store is not null")
        .select("gmap_id", "store", "latitude", "longitude", around.alias("dy"))
        .select("*", around.alias("dx"))
        .select("gmap_id", "store", "latitude", "longitude", (F.floor(F.col("latitude") / step) + F.col("dy")).alias("gy"), (F.floor(F.col("longitude") / wide) + F.col("dx")).alias("gx"))
    )
    right = places.select("osm", "store", "lat", "lon", F.floor(F.col("lat") / step).alias("gy"), F.floor(F.col("lon") / wide).alias("gx"))
    away = scoring.metres(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    return left.join(right, ["store", "gy", "gx"]).select("store", "gmap_id", "osm", away.alias("metres")).where(F.col("metres") <= s.match_metres)


def match_one_to_one(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Greedy matching by distance: in order of (metres, gmap_id, osm) an edge is taken if both its ends are free.

    While more than `few` edges are open they are decided in rounds: an edge that is the first at both its ends is taken,
    and all edges at its ends go; each round takes at least one. The rest is gone through in order by one task. The order
    is total, so this gives what going through the sorted list would.
    """
    first = F.struct(F.col("metres"), F.col("gmap_id"), F.col("osm"))
    left = materialise(edges.select("store", "gmap_id", "osm", "metres"), "edges")
    taken = None
    while left.count() > few:
        marked = left.withColumn("o", first)
        a = marked.groupBy("gmap_id").agg(F.min("o").alias("a"))
        b = marked.groupBy("osm").agg(F.min("o").alias("b"))
        won = materialise(marked.join(a, "gmap_id").join(b, "osm").where((F.col("o") == F.col("a")) & (F.col("o") == F.col("b"))).select(left.columns), "edges")
        taken = won if taken is None else taken.unionByName(won)
        left = materialise(left.join(won.select("gmap_id"), "gmap_id", "left_anti").join(won.select("osm"), "osm", "left_anti").select(left.columns), "edges")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, there = set(), set()
        for batch in batches:
            free = []
            for g, o in zip(batch["gmap_id"], batch["osm"], strict=True):
                free.append(g not in here and o not in there)
                if free[-1]:
                    here.add(g)
                    there.add(o)
            yield batch[free]

    rest = left.repartition(1).sortWithinPartitions("metres", "gmap_id", "osm").mapInPandas(decide, left.schema)
    rest = materialise(rest, "edges")
    return rest if taken is None else taken.unionByName(rest)


def pooled(ratings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several places' ratings as one: counts add up, means are weighted by the effective count."""
    eff = F.coalesce("n_eff", "n")
    sums = ratings.where(F.col("norm").isNotNull() & (F.col("n") > 0)).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum(eff).alias("n_eff"), F.sum(F.coalesce("norm_recent", "norm") * eff).alias("total")
    )
    whole = F.when(F.col("n_eff") == 0, 1.0).otherwise(F.col("n_eff"))
    return sums.select(*keys, "n", whole.alias("n_eff"), (F.col("total") / whole).alias("norm_recent"))


def counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def in_area(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """box: south, west, north, east, both ends included."""
    return lat.between(box[0], box[2]) & lon.between(box[1], box[3])
