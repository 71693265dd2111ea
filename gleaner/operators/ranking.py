"""Answers from published cells: baskets, comparisons, search, maps and habits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.functions.text import fold_key
from gleaner.runtime import materialise

MAX_TERMS = 40
#: Terms that are broadcast at once.
BASKET_TERMS = 10_000


def keyword_table(spark) -> DataFrame:
    """word, category"""
    rows = [(w, c) for c, words in vocab.LIST_WORDS.items() for w in words]
    return spark.createDataFrame(rows, "word string, category string")


def ordered_keywords(spark) -> DataFrame:
    """word, ord: each keyword once, in declared order."""
    words = dict.fromkeys(w for words in vocab.LIST_WORDS.values() for w in words)
    return spark.createDataFrame(list(zip(words, range(len(words)))), "word string, ord int")


def parse_list(text) -> object:
    """The distinct terms of a shopping list, the first 40, in order."""
    parts = F.transform(F.split(text, r"[\n,;]+"), lambda x: F.lower(F.trim(x)))
    return F.slice(F.array_distinct(F.filter(parts, lambda x: x != "")), 1, MAX_TERMS)


def resolve(basket: DataFrame, items: DataFrame, cells: DataFrame, keywords: DataFrame) -> DataFrame:
    """term, qty, kind (item, category), store, label, w, s, pl: each term's evidence per store.

    An item whose name equals, contains or is contained in the term answers first (in this order, then the heavier, then
    by name); a term without any item is answered by its category's cells; others are unmatched and absent. The basket
    may have any length: up to BASKET_TERMS terms it is broadcast, a longer one in blocks of so many.
    """
    n = basket.count()
    if n > BASKET_TERMS:
        blocks = -(-n // BASKET_TERMS)
        block = materialise(basket.withColumn("_b", F.pmod(F.xxhash64("term"), F.lit(blocks))), "basket")
        parts = [resolve(block.where(F.col("_b") == i).drop("_b"), items, cells, keywords) for i in range(blocks)]
        return reduce(DataFrame.unionByName, parts)
    hit = F.contains(F.col("name"), F.col("term")) | F.contains(F.col("term"), F.col("name"))
    rank = F.when(F.col("name") == F.col("term"), 2).when(F.contains(F.col("name"), F.col("term")), 1).otherwise(0)
    best = Window.partitionBy("term", "store").orderBy(F.desc("rank"), F.desc("w"), "name")
    by_item = (
        items.join(F.broadcast(basket), hit).withColumn("rank", rank).withColumn("rn", F.row_number().over(best)).where("rn = 1")
        .select("term", "qty", F.lit("item").alias("kind"), "store", F.col("name").alias("label"), "w", "s", "pl")
    )
    rest = basket.join(by_item.select("term").distinct(), "term", "left_anti")
    named = rest.join(keywords, F.col("term") == F.col("word"))
    by_category = named.join(cells, "category").select("term", "qty", F.lit("category").alias("kind"), "store", F.col("category").alias("label"), "w", "s", "pl")
    return by_item.unionByName(by_category)


def rank_stores(resolved: DataFrame, preference: float, s: Settings = Settings()) -> DataFrame:
    """Stores by units covered, then by average value: covered, avg, wins (terms where it is best), weak terms."""
    valued = resolved.where(F.col("w") >= s.min_cell_weight).withColumn("v", scoring.cell_value(F.col("s"), F.col("pl"), preference))
    first = Window.partitionBy("term").orderBy(F.desc("v"), "store")
    marked = valued.withColumn("best", F.row_number().over(first) == 1)
    return (
        marked.groupBy("store")
        .agg(
            F.sum(F.col("v") * F.col("qty")).alias("score"), F.sum("qty").alias("covered"),
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("best"), F.col("term")))), ",").alias("wins"),
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("v") < -s.label_band, F.col("term")))), ",").alias("weak"),
        )
        .select("store", "covered", F.round(F.col("score") / F.col("covered"), 4).alias("avg"), "wins", "weak")
    )


def best_store(resolved: DataFrame, preference: float, s: Settings = Settings()) -> DataFrame:
    valued = resolved.where(F.col("w") >= s.min_cell_weight).withColumn("v", scoring.cell_value(F.col("s"), F.col("pl"), preference))
    first = Window.partitionBy("term").orderBy(F.desc("v"), "store")
    return valued.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("term", "store", F.round("v", 6).alias("v"))


def compare(totals: DataFrame, cells: DataFrame, category: str | None, min_weight: float, hide_thin: bool, s: Settings = Settings()) -> DataFrame:
    """store, price, quality, sentiment, n, w: of one category, or overall with price and quality from their own cells."""
    rows = totals.withColumn("thin", F.col("w") < s.min_weight)
    if hide_thin:
        rows = rows.where("not thin")
    if category:
        c = cells.where(F.col("category") == category).select("store", F.col("pl").alias("price"), F.col("s").alias("quality"), F.col("s").alias("sentiment"), "n", "w")
        out = rows.select("store").join(c, "store")
    else:
        p = cells.where(F.col("category") == "price_overall").select("store", F.col("pl").alias("price"))
        q = cells.where(F.col("category") == "quality_overall").select("store", F.col("s").alias("quality"))
        out = rows.select("store", F.col("s").alias("sentiment"), "n", "w").join(p, "store", "left").join(q, "store", "left")
    return out.where(F.col("w") >= min_weight).select("store", "price", "quality", "sentiment", "n", "w")


def ordered_comparison(rows: DataFrame, key: str, descending: bool) -> DataFrame:
    """Missing values last either way, ties by store; prices are shown, and so ordered, as -price."""
    value = -F.col("price") if key == "price" else F.col(key)
    return rows.orderBy(value.desc_nulls_last() if descending else value.asc_nulls_last(), "store")


def search_items(items: DataFrame, text: str, store: str | None = None, most: int = 250) -> DataFrame:
    found = items.where(F.contains(fold_key(F.col("name")), fold_key(F.lit(text))))
    if store:
        found = found.where(F.col("store") == store)
    return found.orderBy(F.desc("w"), "store", "name").limit(most)


def place_scores(pins: DataFrame, branch_cells: DataFrame, chain_cells: DataFrame, category: str) -> DataFrame:
    """osm, s, label of each pin (osm, store, branch): its branch's cell, else its chain's, saying which."""
    b = branch_cells.where(F.col("category") == category).select("store", "branch", F.col("s").alias("sb"))
    c = chain_cells.where(F.col("category") == category).select("store", F.col("s").alias("sc"))
    rows = pins.join(b, ["store", "branch"], "left").join(c, "store", "left")
    label = F.when(F.col("sb").isNotNull(), category).when(F.col("sc").isNotNull(), f"{category}, chain-wide").otherwise("")
    return rows.select("osm", F.coalesce("sb", "sc").alias("s"), label.alias("label"))


def habits(purchases: DataFrame, now: int, s: Settings = Settings()) -> DataFrame:
    """name, seen, units, last, weight: purchases (name, qty, at in epoch seconds) with a short half-life."""
    age = F.greatest(F.lit(0.0), (F.lit(now) - F.col("at")) / 86400.0)
    return purchases.groupBy("name").agg(
        F.count(F.lit(1)).alias("seen"), F.sum("qty").alias("units"), F.max("at").alias("last"),
        F.sum(F.col("qty") * F.pow(F.lit(0.5), age / s.habit_half_life_days)).alias("weight"),
    )


def basket_from(habit_rows: DataFrame, most: int = 12, s: Settings = Settings()) -> DataFrame:
    kept = habit_rows.where(F.col("weight") >= s.habit_floor).orderBy(F.desc("weight"), "name").limit(most)
    return kept.select("name", F.greatest(F.lit(1), F.least(F.lit(5), F.round("weight").cast("int"))).alias("qty"))
