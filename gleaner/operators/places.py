"""Places: which chain a name means, tidy pins from map elements, and pins linked to the branches that claims name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import vocab


def store_hits(text: Column, gated: bool = True) -> Column:
    """The stores whose pattern the (lower case) text meets, in their declared order. A pattern is tried only where its
    literal stands, unless gated is false."""
    hit = {name: (text.contains(vocab.STORE_LITERALS[name]) if gated else F.lit(True)) & text.rlike(f"(?U){p}") for name, p in vocab.STORE_PATTERNS.items()}
    return F.array_compact(F.array(*[F.when(met, F.lit(name)) for name, met in hit.items()]))


def match_store(name: Column) -> Column:
    """The one store a listing's name means; null for none or several. Names need no context."""
    hits = store_hits(F.translate(F.lower(name), "’ʼ", "''"))
    return F.when(F.size(hits) == 1, hits[0])


def is_food_shop(primary: Column) -> Column:
    return primary.isin(*vocab.SHOP_CATEGORIES) | primary.rlike(vocab.SHOP_SUFFIX)


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: F.length(x) > 2))


def places_from_elements(elements: DataFrame) -> DataFrame:
    """Map elements (type, id, lat, lon, center, tags, ord) to places; of an element given twice the last by ord."""
    name = F.trim(F.coalesce(F.col("tags")["name"], F.lit("")))
    number, street = (F.trim(F.coalesce(F.col("tags")[k], F.lit(""))) for k in ("addr:housenumber", "addr:street"))
    rows = elements.select(
        F.concat_ws("/", "type", "id").alias("osm"), match_store(name).alias("store"), name.alias("name"),
        F.concat_ws(" ", F.nullif(number, F.lit("")), F.nullif(street, F.lit(""))).alias("address"),
        F.trim(F.coalesce(F.col("tags")["addr:city"], F.lit(""))).alias("city"),
        F.round(F.coalesce("center.lat", "lat"), 6).alias("lat"), F.round(F.coalesce("center.lon", "lon"), 6).alias("lon"), "ord",
    ).where((F.col("name") != "") & F.col("store").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    last = Window.partitionBy("osm").orderBy(F.desc("ord"))
    return rows.withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn", "ord")


def attach_branches(places: DataFrame, branches: DataFrame) -> DataFrame:
    """osm and the branch of its store whose words all stand in its town, or in town and street for a branch that is not
    itself named like a town. The longest name wins, then the first in alphabetical order.

    places: osm, store, city, address. branches: store, branch. Each branch is looked up by its rarest word among the
    places, so a pin meets only the branches that share that word with it.
    """
    at = places.select("osm", "store", tokens(F.coalesce("city", F.lit(""))).alias("town"), tokens(F.concat_ws(" ", "city", "address")).alias("hay"))
    seen = at.select(F.explode("hay").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    towns = at.select(F.explode("town").alias("word")).distinct().withColumn("is_town", F.lit(True))
    words = branches.select("store", "branch", tokens(F.col("branch")).alias("wanted")).where(F.size("wanted") > 0)
    each = words.select("store", "branch", "wanted", F.explode("wanted").alias("word")).join(seen, "word", "left").join(towns, "word", "left")
    anchored = each.groupBy("store", "branch", "wanted").agg(
        F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), F.col("word"))).alias("word"), F.min(F.coalesce("is_town", F.lit(False))).alias("town_name")
    )
    met = at.select("osm", "store", "town", "hay", F.explode("hay").alias("word")).join(anchored, ["store", "word"])
    inside = F.when(F.col("town_name"), F.size(F.array_except("wanted", "town"))).otherwise(F.size(F.array_except("wanted", "hay"))) == 0
    best = Window.partitionBy("osm").orderBy(F.length("branch").desc(), "branch")
    return met.where(inside).withColumn("rn", F.row_number().over(best)).where("rn = 1").select("osm", "store", "branch")
