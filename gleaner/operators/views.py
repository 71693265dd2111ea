"""What a reader's page shows of verdicts: a basket's stores and notes, map pins and lists, cross-checks, store details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.config import Settings

SORTS = ("covered", "quality", "evidence")
POPULATIONS = ("norm", "norm_recent", "norm_long")
COLOURS = ("claims", "ratings", "merged")


def _placed(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with place, from 1. For tables of one row per store or pin list entry, small as those are."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def _first(rows: DataFrame, keys: list[str], most: int, *order: Column) -> DataFrame:
    """The first `most` rows of each group with their place; the limit goes below the shuffle."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= most)


def basket_size(basket: DataFrame) -> DataFrame:
    """items, units: of an empty basket 0 and 0."""
    return basket.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("qty"), F.lit(0)).alias("units"))


def unmatched(basket: DataFrame, resolved: DataFrame) -> DataFrame:
    """The basket's terms that nothing was found for."""
    return basket.join(resolved.select("term").distinct(), "term", "left_anti").select("term")


def ordered_stores(ranked: DataFrame, totals: DataFrame, sort: str = "covered", min_weight: float = 0.0, hide_thin: bool = False, s: Settings = Settings()) -> DataFrame:
    """Ranked stores (store, covered, avg, wins, weak) with place: by units covered and then average, by the store's own
    sentiment, or by its evidence; ties by store. totals: store, n, w, s. Stores without totals have none of either."""
    if sort not in SORTS:
        raise ValueError(f"sort is one of {SORTS}")
    rows = ranked.join(totals.select("store", "n", "w", "s"), "store", "left").fillna(0, ["n", "w", "s"])
    rows = rows.where(F.col("w") >= min_weight)
    if hide_thin:
        rows = rows.where(F.col("w") >= s.min_weight)
    order = {"covered": [F.desc("covered"), F.desc("avg")], "quality": [F.desc("s")], "evidence": [F.desc("w")]}[sort]
    return _placed(rows, *order, F.col("store"))


def second_stop(ordered: DataFrame, close: float = 0.08) -> DataFrame:
    """best, second, gap, note: whether a second stop pays. weak: the best store has weak terms; close: the averages differ by
    less than `close`; no: neither; alone: there is no second. Without any store no row."""
    two = ordered.where("place <= 2").agg(
        F.max(F.when(F.col("place") == 1, F.col("store"))).alias("best"), F.max(F.when(F.col("place") == 2, F.col("store"))).alias("second"),
        F.max(F.when(F.col("place") == 1, F.col("avg"))).alias("a"), F.max(F.when(F.col("place") == 2, F.col("avg"))).alias("b"), F.max(F.when(F.col("place") == 1, F.col("weak"))).alias("weak"),
    )
    gap = F.round(F.col("a") - F.col("b"), 4)
    note = F.when(F.col("second").isNull(), "alone").when(F.col("weak") != "", "weak").when(gap < close, "close").otherwise("no")
    return two.where("best is not null").select("best", "second", gap.alias("gap"), note.alias("note"))


def suggestions(keywords: DataFrame, basket: DataFrame, pool: int = 40, step: int = 5, most: int = 7) -> DataFrame:
    """word, place: of the keywords (word, ord) not in the basket the first `pool` in order, of these every step-th."""
    rest = keywords.join(basket.select(F.col("term").alias("word")), "word", "left_anti").orderBy("ord").limit(pool)
    numbered = rest.withColumn("i", F.row_number().over(Window.orderBy("ord")) - 1).where(F.col("i") % step == 0)
    return _placed(numbered, F.col("i")).where(F.col("place") <= most).select("word", "place")


def map_pins(
    pins: DataFrame, totals: DataFrame, *, scores: DataFrame | None = None, ratings: DataFrame | None = None, merged_stores: DataFrame | None = None, merged_branches: DataFrame | None = None,
    store: str | None = None, with_branch: bool = False, colour: str = "claims",
) -> DataFrame:
    """osm, s: the pins shown, with the number that colours each.

    pins: osm, store, branch. scores (osm, s): of a category; pins without are left out. colour "claims" shows these, or
    the store's total; "ratings" a pin's own rating (ratings: osm, norm, thin) and no pin without one or with a thin one;
    "merged" the branch's combined value, or for pins without branch the store's, and no pin without.
    """
    if colour not in COLOURS:
        raise ValueError(f"colour is one of {COLOURS}")
    rows = pins.select("osm", "store", "branch")
    if store is not None:
        rows = rows.where(F.col("store") == store)
    if with_branch:
        rows = rows.where(F.col("branch").isNotNull())
    if scores is not None:
        rows = rows.join(scores.where(F.col("s").isNotNull()).select("osm", F.col("s").alias("_score")), "osm")
    if colour == "ratings":
        return rows.join(ratings.where(~F.col("thin")).select("osm", "norm"), "osm").select("osm", F.col("norm").alias("s"))
    if colour == "merged":
        b = merged_branches.select("store", "branch", F.col("v").alias("_b"))
        c = merged_stores.select("store", F.col("v").alias("_c"))
        value = F.when(F.col("branch").isNotNull(), F.col("_b")).otherwise(F.col("_c"))
        return rows.join(b, ["store", "branch"], "left").join(F.broadcast(c), "store", "left").select("osm", value.alias("s")).where("s is not null")
    if scores is not None:
        return rows.select("osm", F.col("_score").alias("s"))
    return rows.join(totals.select("store", "s"), "store", "left").select("osm", "s")


def map_list(pins: DataFrame, order: list[str], most: int = 14) -> DataFrame:
    """store, branch, place: the different (store, branch) in the order of their first pin, at most so many."""
    place = F.struct(*order)
    first = pins.groupBy("store", "branch").agg(F.min(place).alias("o")).orderBy("o").limit(most)
    return _placed(first, F.col("o")).select("store", "branch", "place")


def cross_rows(totals: DataFrame, ratings: DataFrame, population: str = "norm") -> DataFrame:
    """store, first, second, gap, stars, place: both sources' numbers for one population of ratings (all, decayed, long
    ones), the widest gap first. Stores with thin ratings, or without a number in the population, are left out."""
    if population not in POPULATIONS:
        raise ValueError(f"population is one of {POPULATIONS}")
    stars = {"norm": F.col("mean"), "norm_recent": F.col("mean_recent"), "norm_long": F.coalesce("mean_long", "mean")}[population]
    rows = ratings.where(~F.col("thin") & F.col(population).isNotNull()).select("store", F.col(population).alias("second"), stars.alias("stars"))
    out = totals.select("store", F.col("s").alias("first")).join(rows, "store").withColumn("gap", F.round(F.col("second") - F.col("first"), 4))
    return _placed(out, F.desc("gap"), F.col("store"))


def detail_categories(cells: DataFrame, most: int = 8) -> DataFrame:
    return _first(cells, ["store"], most, F.desc("w"), F.col("category"))


def detail_items(items: DataFrame, most: int = 6) -> DataFrame:
    return _first(items, ["store"], most, F.desc("w"), F.col("name"))


def store_cards(totals: DataFrame, branches: DataFrame) -> DataFrame:
    """store, n, w, s, n_branches, place: the stores with most evidence first. branches: store, branch."""
    count = branches.select("store", "branch").distinct().groupBy("store").agg(F.count(F.lit(1)).alias("n_branches"))
    rows = totals.select("store", "n", "w", "s").join(count, "store", "left").fillna(0, ["n_branches"])
    return _placed(rows, F.desc("w"), F.col("store"))


def combined_bars(merged: DataFrame) -> DataFrame:
    """store, first, second, combined (each as a part of a bar from 0 to 1) and by how many percent the first counts."""
    bar = lambda c: F.round((F.col(c) + 1) / 2, 5)
    return merged.where("r is not null and g is not null").select("store", bar("r").alias("first"), bar("g").alias("second"), bar("v").alias("combined"), F.round(F.col("share") * 100).cast("int").alias("percent"))


def raw_evidence(totals: DataFrame, s: Settings = Settings()) -> DataFrame:
    """totals with score and valenced filled where an older table lacks them (null): taken back from the published
    sentiment and the weighted evidence, sentiment * (weight + shrinkage). Without weight there is no score."""
    old = F.col("score").isNull() | F.col("valenced").isNull()
    weight = F.when(old, F.coalesce("weighted_evidence", F.lit(0.0))).otherwise(F.col("valenced"))
    score = F.when(weight > 0, F.when(old, F.col("sentiment") * (weight + s.shrinkage)).otherwise(F.col("score")))
    return totals.withColumns({"score": score, "valenced": weight})
