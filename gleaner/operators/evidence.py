"""Claims to verdicts: dedup, reciprocal comparisons, independence caps, weighted cells and their roll-ups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.functions.text import UNSAFE, fold_key, strip
from gleaner.operators.lookup import left_counts
from gleaner.runtime import fingerprint, materialise

#: Open rows from which independence_caps ends by going through them in one task; some 50 MB.
FEW_ROWS = 200_000


def branch_key(location: Column, store: Column) -> Column:
    """A branch name without its noise variants; '' where it is no place (a category, or the store itself)."""
    key = fold_key(F.coalesce(location, F.lit("")))
    cut = key
    for p in vocab.BRANCH_CUTS:
        cut = F.regexp_replace(cut, p, "")
    cut = F.trim(cut)
    parts = F.transform(F.split(cut, ","), lambda p: F.regexp_replace(F.trim(p), vocab.STREET_SUFFIX, ""))
    return F.when(key.isin(*vocab.CATEGORIES) | (key == fold_key(store)), "").otherwise(F.array_join(parts, ", "))


def is_branch(name: Column) -> Column:
    return ~F.lower(F.trim(name)).rlike(vocab.REGION)


def valid_claims(claims: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Rows with all required fields and a plausible time; the four free-text fields scrubbed, null there made ''."""
    required = ("store", "category", "claim", "sentiment", "confidence", "source_key", "permalink", "created_utc")
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    ok = ok & F.col("created_utc").between(s.min_timestamp, s.now + int(scoring.SECONDS_PER_YEAR))
    clean = {f: F.regexp_replace(F.coalesce(F.col(f), F.lit("")), UNSAFE, "") for f in ("claim", "location", "item", "comparator_store")}
    return claims.where(ok).withColumns(clean | {"transient": F.coalesce(F.col("transient"), F.lit(False))})


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows with the lowest `order` (unique) of each combination of keys; null equals null.

    Only fingerprints of the keys and the order are shuffled and combined before; the rows are then picked by order, so
    a combination that a third of all rows share makes no hot task.
    """
    marks = df.select(*[c.alias(f"_f{i}") for i, c in enumerate(fingerprint(*keys))], order)
    first = marks.groupBy("_f0", "_f1").agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi")


def dedupe(claims: DataFrame) -> DataFrame:
    return first_of(claims, ["source_key", "store", "category", "claim"], "claim_row")


def mark_reciprocal(claims: DataFrame) -> DataFrame:
    """reciprocal: the comparator is itself judged in the same document. A semi-join against the documents' stores."""
    judged = claims.select("source_key", F.col("store").alias("comparator_store"), F.lit(True).alias("_judged")).distinct()
    return claims.join(judged, ["source_key", "comparator_store"], "left").withColumn("reciprocal", F.col("_judged").isNotNull() & (F.col("comparator_store") != "")).drop("_judged")


def independence_caps(claims: DataFrame, s: Settings = Settings(), few: int = FEW_ROWS) -> DataFrame:
    """At most per_document claims of a document about a store, and per_author_cell of a named author in a cell.

    In order of confidence, time (latest first), source_key, claim, claim_row, a claim stays unless one of its two quotas
    is used up; a claim that goes uses neither. Decided in rounds over the open claims. Groups that have no more open
    claims than quota left bind nobody; a claim bound by neither group stays at once. Of the others those stay that are,
    in every group that binds them, among the best so many open ones as the quota has left; claims of a used-up quota go.
    Only these best ones are ranked, so a group that holds a third of all rows is cut before the shuffle. Each round
    settles at least the best open claim; what is left once at most `few` claims are open is gone through in order, by one
    task. Extra columns stay; an empty table gives none.
    """
    named = ~F.coalesce(F.col("author"), F.lit("")).isin(*vocab.ANONYMOUS_AUTHORS)
    quotas = {"_doc": s.per_document, "_cell": s.per_author_cell}
    # the whole claims are written once, and read again by column
    whole = materialise(claims.withColumns({"_doc": F.xxhash64("source_key", "store"), "_cell": F.when(named, F.xxhash64(F.lit(7), "author", "store", "category"))}), "claims")
    open_rows = whole.select(
        "claim_row", (-scoring.confidence_weight(F.col("confidence"), s)).alias("_c"), (-F.col("created_utc")).alias("_t"), F.col("source_key").alias("_k"), F.col("claim").alias("_x"), "_doc", "_cell",
        F.lit(s.per_document).alias("_doc_left"), F.lit(s.per_author_cell).alias("_cell_left"),
    )
    order = ["_c", "_t", "_k", "_x", "claim_row"]
    left = {g: f"{g}_left" for g in quotas}
    names = open_rows.columns
    kept: list[DataFrame] = []
    while True:
        # bound: the open claims of groups with more of them than quota left; null where a group binds nobody
        state = open_rows
        for g in quotas:
            bound = open_rows.where(F.col(g).isNotNull()).groupBy(g).agg(F.count(F.lit(1)).alias(f"{g}_n"), F.first(left[g]).alias("_l")).where(F.col(f"{g}_n") > F.col("_l")).drop("_l")
            state = left_counts(state, bound, g, f"{g}_n")
        state = materialise(state, "caps")
        free = state.where(" and ".join(f"{g}_n is null" for g in quotas)).select("claim_row")
        kept.append(free)
        tied = state.where(" or ".join(f"{g}_n is not null" for g in quotas))
        n = tied.count()
        if n <= few:
            kept.append(_in_order(tied, order, list(quotas)))
            break
        heads = None
        for g, quota in quotas.items():
            best = Window.partitionBy(g).orderBy(*order)
            head = tied.where(F.col(f"{g}_n").isNotNull()).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= quota).where(F.col("_n") <= F.col(left[g]))
            head = head.select("claim_row").unionByName(tied.where(F.col(f"{g}_n").isNull()).select("claim_row"))
            heads = head if heads is None else heads.join(head, "claim_row", "left_semi")
        stays = materialise(tied.join(heads, "claim_row", "left_semi").select("claim_row", *quotas), "stays")
        kept.append(stays.select("claim_row"))
        rest = tied.join(stays.select("claim_row"), "claim_row", "left_anti").select(names)
        for g in quotas:
            bound = tied.where(F.col(f"{g}_n").isNotNull()).groupBy(g).agg(F.max(f"{g}_n").alias("_w"))
            used = stays.where(F.col(g).isNotNull()).groupBy(g).agg(F.count(F.lit(1)).alias("_used")).join(bound, g)
            rest = left_counts(rest, used, g, "_w").withColumn(left[g], (F.col(left[g]) - F.coalesce("_used", F.lit(0))).cast("int")).drop("_used", "_w")
        # a used-up quota was filled by claims that come before every open claim of its group
        open_rows = materialise(rest.where(" and ".join(f"{left[g]} > 0" for g in quotas)), "caps")
    rows = kept[0]
    for part in kept[1:]:
        rows = rows.unionByName(part)
    return whole.drop("_doc", "_cell").join(rows, "claim_row", "left_semi")


def _in_order(tied: DataFrame, order: list[str], groups: list[str]) -> DataFrame:
    """claim_row of the claims that stay, gone through in order by one task; for few rows only."""
    quota = [f"{g}_left" for g in groups]

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        used: dict[tuple[int, int], int] = {}
        for batch in batches:
            stay = []
            columns = [batch[c].tolist() for c in ("claim_row", *groups, *quota)]
            for row, *rest in zip(*columns, strict=True):
                keys = [(i, k) for i, k in enumerate(rest[: len(groups)]) if k is not None]
                if all(used.get(k, 0) < rest[len(groups) + k[0]] for k in keys):
                    stay.append(row)
                    for k in keys:
                        used[k] = used.get(k, 0) + 1
            yield pd.DataFrame({"claim_row": stay}, dtype="int64")

    # as text, for a column of numbers with nulls would come as floating point
    rows = tied.select(*order, *[F.col(g).cast("string").alias(g) for g in groups], *quota)
    one = rows.repartition(1).sortWithinPartitions(*order).select("claim_row", *groups, *quota)
    return materialise(one.mapInPandas(decide, "claim_row bigint"), "caps")


def prepare(claims: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Everything before counting: dedup, durable claims only, reciprocals marked, caps."""
    durable = dedupe(claims).where(~F.col("transient"))
    return independence_caps(mark_reciprocal(durable), s)


def weigh(prepared: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Prepared claims with weight w, branch key and item key."""
    half = F.when(F.col("reciprocal"), 0.5).otherwise(1.0)
    return prepared.withColumns(
        {
            "w": scoring.claim_weight(s) * half,
            "branch": branch_key(F.col("location"), F.col("store")),
            "item_key": fold_key(F.col("item")),
        }
    )


def measures() -> list[Column]:
    """The sums every cell has; all merge, so partial aggregation does most of the work."""
    w = F.col("w")
    sent = scoring.lookup(F.col("sentiment"), vocab.SENTIMENT_SCORE, None)
    price = scoring.lookup(F.col("price_signal"), vocab.PRICE_SCORE, None)
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(w).alias("weight"),
        F.sum(F.coalesce(w * sent, F.lit(0.0))).alias("score"),
        F.sum(F.when(sent.isNotNull(), w).otherwise(0.0)).alias("valenced"),
        F.sum(F.coalesce(w * price, F.lit(0.0))).alias("price_score"),
        F.sum(F.when(price.isNotNull(), w).otherwise(0.0)).alias("price_weight"),
        *[F.count_if(F.col("price_signal") == p).alias(f"n_{p}") for p in vocab.PRICE_SCORE],
    ]


MERGE = ("n", "weight", "score", "valenced", "price_score", "price_weight", *[f"n_{p}" for p in vocab.PRICE_SCORE])


def merged() -> list[Column]:
    return [F.sum(c).alias(c) for c in MERGE]


def branch_cells(weighed: DataFrame) -> DataFrame:
    return weighed.groupBy("store", "branch", "category").agg(*measures())


def item_cells(weighed: DataFrame) -> DataFrame:
    return weighed.where(F.col("item_key") != "").groupBy("store", "item_key").agg(*measures())


def chain_cells(cells: DataFrame) -> DataFrame:
    """Branch cells folded by (store, category); merges partial sums, claims aren't read again."""
    return cells.groupBy("store", "category").agg(*merged())


def above_floor(cells: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Cells of any kind with enough evidence to be shown."""
    return cells.where(F.col("weight") >= s.min_weight)


def store_totals(chains: DataFrame) -> DataFrame:
    return chains.where(~F.col("category").isin(*vocab.NON_SHOPPING)).groupBy("store").agg(*merged())


def branch_totals(cells: DataFrame) -> DataFrame:
    kept = cells.where((F.col("branch") != "") & ~F.col("category").isin(*vocab.NON_SHOPPING))
    return kept.groupBy("store", "branch").agg(*merged())


def view(cells: DataFrame, s: Settings = Settings(), digits: int = 4) -> DataFrame:
    """Cells as published: sentiment, price level (only with a label) and label next to the raw sums, rounded."""
    label = scoring.price_label(F.col("price_score"), F.col("price_weight"), s)
    keys = [c for c in cells.columns if c not in MERGE]
    return cells.select(
        *keys, F.col("n").alias("n_claims"), F.round("weight", digits).alias("weighted_evidence"),
        F.round(scoring.shrunk(F.col("score"), F.col("valenced"), s), digits).alias("sentiment"), F.round("score", digits).alias("score"),
        F.round("valenced", digits).alias("valenced_weight"),
        F.round(F.when(label.isNotNull(), scoring.price_level(F.col("price_score"), F.col("price_weight"), s)), digits).alias("price_level"),
        label.alias("price_signal"), *[F.col(f"n_{p}") for p in vocab.PRICE_SCORE],
    )


def headline_half_life(chains: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One half-life that keeps as much weight at the horizon as the mixture of categories does."""
    kept = F.pow(F.lit(0.5), F.lit(s.horizon_years) / scoring.half_life(F.col("category"), s))
    sums = chains.where(~F.col("category").isin(*vocab.NON_SHOPPING)).agg(F.sum("weight").alias("total"), F.sum(F.col("weight") * kept).alias("retained"))
    part = F.try_divide("retained", "total")
    fits = (F.col("total") > 0) & (part > 0) & (part < 1)
    return sums.select(F.when(fits, -s.horizon_years * math.log(2.0) / F.ln(part)).otherwise(s.default_half_life).alias("half_life"))


def modal_labels(weighed: DataFrame, key: str, label: str) -> DataFrame:
    """The most common spelling of each (store, key); of equally common ones that of the lowest claim_row."""
    spelt = weighed.where(F.col(key) != "").groupBy("store", key, strip(F.col(label)).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.min("claim_row").alias("first"))
    best = Window.partitionBy("store", key).orderBy(F.desc("n"), "first")
    return spelt.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("store", key, "label")


def top_evidence(weighed: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n heaviest claims of each group, ties by claim_row. The limit goes below the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("w"), "claim_row")
    return weighed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
