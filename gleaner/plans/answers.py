"""Queries that rank, compare and search, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.functions.text import fold_key
from gleaner.operators import evidence as ev
from gleaner.operators import places as pl
from gleaner.operators import ranking as rk
from gleaner.operators import ratings as rt
from gleaner.operators.selection import rank_first
from gleaner.plans import evidence as base
from gleaner.plans import ratings as rated
from gleaner.runtime import load, materialise

S = Settings()
BASKET = [("eggs", 2), ("milk", 1), ("olive oil", 1), ("salmon", 3), ("sourdough", 1), ("cod", 1), ("unicorn steaks", 1)]
PREFERENCE = 0.6
#: The end of the test tables' orders.
NOW = 996_624_000


def _basket(spark) -> DataFrame:
    return spark.createDataFrame(BASKET, "term string, qty int")


def slim(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells as a reader's page needs them: n, w, s, p, pl."""
    v = ev.view(cells, S)
    return v.select(*keys, F.col("n_claims").alias("n"), F.col("weighted_evidence").alias("w"), F.col("sentiment").alias("s"), F.col("price_signal").alias("p"), F.col("price_level").alias("pl"))


def _tables(spark, sf_dir):
    weighed = materialise(base._weighed(spark, sf_dir).select("claim_row", "store", "branch", "category", "item_key", "sentiment", "price_signal", "w"), "weighed")
    cells = ev.branch_cells(weighed)
    return weighed, cells, ev.chain_cells(cells)


def _resolved(spark, sf_dir) -> DataFrame:
    weighed, _, chains = _tables(spark, sf_dir)
    items = slim(ev.item_cells(weighed), "store", "item_key").withColumnRenamed("item_key", "name")
    return rk.resolve(_basket(spark), items, slim(chains, "store", "category"), rk.keyword_table(spark))


def join_keywords(spark, sf_dir):
    return rk.keyword_table(spark)


def join_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).select("term", "kind", "store", "label", "w")


def win_best_store(spark, sf_dir):
    return rk.best_store(_resolved(spark, sf_dir), PREFERENCE, S)


def agg_basket_rank(spark, sf_dir):
    return rk.rank_stores(_resolved(spark, sf_dir), PREFERENCE, S)


def flt_compare(spark, sf_dir):
    _, _, chains = _tables(spark, sf_dir)
    totals = slim(ev.store_totals(chains), "store").select("store", "n", "w", "s")
    return rk.compare(totals, slim(chains, "store", "category"), None, 1.0, True, S)


def flt_compare_category(spark, sf_dir):
    _, _, chains = _tables(spark, sf_dir)
    totals = slim(ev.store_totals(chains), "store").select("store", "n", "w", "s")
    return rk.compare(totals, slim(chains, "store", "category"), "produce", 0.0, False, S)


def top_compare(spark, sf_dir):
    return rk.ordered_comparison(flt_compare(spark, sf_dir), "price", True).limit(5).select("store", "price")


def top_items(spark, sf_dir):
    weighed, _, _ = _tables(spark, sf_dir)
    items = slim(ev.item_cells(weighed), "store", "item_key").withColumnRenamed("item_key", "name")
    return rk.search_items(items, "Rice").select("store", "name", "w")


def top_categories(spark, sf_dir):
    _, _, chains = _tables(spark, sf_dir)
    return rank_first(slim(chains, "store", "category"), ["store"], F.desc("w"), F.col("category")).select("store", "category", "w")


def join_place_score(spark, sf_dir):
    _, cells, chains = _tables(spark, sf_dir)
    pins = rt.pins(load(spark, sf_dir, "places"))
    linked = pl.attach_branches(pins, rated._branch_names(spark, sf_dir)).select("osm", "branch")
    b, c = slim(cells, "store", "branch", "category"), slim(chains, "store", "category")
    return rk.place_scores(pins.select("osm", "store").join(linked, "osm", "left"), b, c, "produce")


def agg_habits(spark, sf_dir):
    return _habits(spark, sf_dir).select("name", "seen", F.round("units", 4).alias("units"), "last", F.round("weight", 4).alias("weight"))


def _habits(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.unix_timestamp("o_orderdate").alias("at"))
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("qty"))
    parts = load(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rk.habits(bought.select("name", "qty", "at"), NOW, S)


def top_habit_basket(spark, sf_dir):
    return rk.basket_from(_habits(spark, sf_dir), 12, S)


def mth_cell_value(spark, sf_dir):
    _, _, chains = _tables(spark, sf_dir)
    c = slim(chains, "store", "category")
    return c.select("store", "category", F.round(scoring.cell_value(F.col("s"), F.col("pl"), 0.25), 6).alias("v"))


def agg_tally(spark, sf_dir):
    weighed, cells, chains = _tables(spark, sf_dir)
    rows = weighed.agg(F.count(F.lit(1)).alias("n_claims"), F.countDistinct("store").alias("n_stores"))
    items = weighed.where("item_key <> ''").select("store", "item_key").distinct().agg(F.count(F.lit(1)).alias("n_items"))
    branches = cells.where("branch <> ''").select("store", "branch").distinct().agg(F.count(F.lit(1)).alias("n_branches"))
    return rows.crossJoin(items).crossJoin(branches)


def jsn_cells(spark, sf_dir):
    """Cells as compact JSON; absent measures have no key."""
    _, _, chains = _tables(spark, sf_dir)
    c = slim(chains, "store", "category")
    return c.select("store", "category", F.to_json(F.struct("n", F.col("p").alias("p"))).alias("cell"))


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("join", "win", "agg", "flt", "top", "mth", "jsn") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}


def _slim(keys: str, source: str) -> str:
    return f"(SELECT {keys}, n_claims AS n, weighted_evidence AS w, sentiment AS s, price_signal AS p, price_level AS pl FROM ({base.cell_view(keys, source)}))"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CH = f"ch AS {_slim('store, category', base.CHAIN_CELLS)}"
_BC = f"bc AS {_slim('store, branch, category', base.BRANCH_CELLS)}"
_IT = "it AS " + _slim("store, item_key", f"(SELECT store, item_key, {base.CELL} FROM weighed WHERE item_key <> '' GROUP BY ALL)").replace("(SELECT store, item_key, n_claims", "(SELECT store, item_key AS name, n_claims", 1)
_TO = f"tt AS {_slim('store', base.TOTALS)}"
_KEYWORDS = "SELECT * FROM (VALUES " + ", ".join(f"({_q(w)}, '{c}')" for c, words in vocab.LIST_WORDS.items() for w in words) + ") AS k(word, category)"
_BASKET = "basket AS (SELECT * FROM (VALUES " + ", ".join(f"({_q(t)}, {q})" for t, q in BASKET) + ") AS b(term, qty))"
_RESOLVED = f"""{_BASKET}, by_item AS (SELECT term, qty, 'item' AS kind, store, name AS label, w, s, pl FROM (SELECT *, row_number() OVER (PARTITION BY term, store ORDER BY
        CASE WHEN name = term THEN 2 WHEN contains(name, term) THEN 1 ELSE 0 END DESC, w DESC, name) AS rn FROM it JOIN basket ON contains(name, term) OR contains(term, name)) WHERE rn = 1),
    resolved AS (SELECT * FROM by_item UNION ALL SELECT term, qty, 'category', store, ch.category, w, s, pl FROM basket JOIN ({_KEYWORDS}) k ON word = term JOIN ch ON ch.category = k.category
        WHERE term NOT IN (SELECT term FROM by_item)),
    valued AS (SELECT *, {PREFERENCE} * s + CASE WHEN pl IS NULL THEN 0 ELSE {1 - PREFERENCE} * -pl END AS v FROM resolved WHERE w >= 1.0),
    marked AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY v DESC, store) = 1 AS best FROM valued)"""
_COMPARE = """(SELECT tt.store, p.pl AS price, q.s AS quality, tt.s AS sentiment, tt.n, tt.w FROM tt LEFT JOIN ch p ON p.store = tt.store AND p.category = 'price_overall'
    LEFT JOIN ch q ON q.store = tt.store AND q.category = 'quality_overall' WHERE tt.w >= 1.0)"""
_HABITS = f"""(SELECT p_name AS name, count(*) AS seen, sum(l_quantity) AS units, max(tm) AS last, sum(l_quantity * pow(0.5::DOUBLE, greatest(0.0::DOUBLE, ({NOW} - tm) / 86400.0::DOUBLE) / 56.0::DOUBLE)) AS weight
    FROM lineitem JOIN (SELECT o_orderkey, cast(epoch(o_orderdate) AS BIGINT) AS tm FROM orders) ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_name)"""

ORACLES = {
    "join_keywords": _KEYWORDS,
    "join_resolve": base.BASE + f", {_CH}, {_IT}, {_RESOLVED} SELECT term, kind, store, label, w FROM resolved",
    "win_best_store": base.BASE + f", {_CH}, {_IT}, {_RESOLVED} SELECT term, store, round(v, 6) AS v FROM marked WHERE best",
    "agg_basket_rank": base.BASE + f""", {_CH}, {_IT}, {_RESOLVED} SELECT store, cast(sum(qty) AS BIGINT) AS covered, round(sum(v * qty) / sum(qty), 4) AS avg,
        coalesce(string_agg(term, ',' ORDER BY term) FILTER (best), '') AS wins, coalesce(string_agg(term, ',' ORDER BY term) FILTER (v < -0.15), '') AS weak FROM marked GROUP BY store""",
    "flt_compare": base.BASE + f", {_CH}, {_TO} SELECT * FROM {_COMPARE}",
    "flt_compare_category": base.BASE + f", {_CH}, {_TO} SELECT tt.store, ch.pl AS price, ch.s AS quality, ch.s AS sentiment, ch.n, ch.w FROM tt JOIN ch ON ch.store = tt.store AND ch.category = 'produce'",
    "top_compare": base.BASE + f", {_CH}, {_TO} SELECT store, price FROM {_COMPARE} ORDER BY -price DESC NULLS LAST, store LIMIT 5",
    "top_items": base.BASE + f", {_IT} SELECT store, name, w FROM it WHERE contains(name, 'rice') ORDER BY w DESC, store, name LIMIT 250",
    "top_categories": base.BASE + f", {_CH} SELECT store, category, w FROM (SELECT *, row_number() OVER (PARTITION BY store ORDER BY w DESC, category) AS rn FROM ch) WHERE rn = 1",
    "join_place_score": base.BASE + f""", {_CH}, {_BC}, {rated._PINS}, {rated._BRANCHES}, {rated._ATTACHED} SELECT p.osm, coalesce(bc.s, ch.s) AS s,
        CASE WHEN bc.s IS NOT NULL THEN 'produce' WHEN ch.s IS NOT NULL THEN 'produce, chain-wide' ELSE '' END AS label FROM pins p LEFT JOIN attached a ON a.osm = p.osm
        LEFT JOIN bc ON bc.store = p.store AND bc.branch = a.branch AND bc.category = 'produce' LEFT JOIN ch ON ch.store = p.store AND ch.category = 'produce'""",
    "agg_habits": f"SELECT name, seen, round(units, 4) AS units, last, round(weight, 4) AS weight FROM {_HABITS}",
    "top_habit_basket": f"SELECT name, cast(greatest(1, least(5, round(weight))) AS INTEGER) AS qty FROM {_HABITS} WHERE weight >= 0.35 ORDER BY weight DESC, name LIMIT 12",
    "mth_cell_value": base.BASE + f", {_CH} SELECT store, category, round(0.25 * s + CASE WHEN pl IS NULL THEN 0 ELSE 0.75 * -pl END, 6) AS v FROM ch",
    "agg_tally": base.BASE + " SELECT count(*) AS n_claims, count(DISTINCT store) AS n_stores, count(DISTINCT (store, item_key)) FILTER (item_key <> '') AS n_items, count(DISTINCT (store, branch)) FILTER (branch <> '') AS n_branches FROM weighed",
    "jsn_cells": base.BASE + f", {_CH} SELECT store, category, '{{\"n\":' || n || CASE WHEN p IS NULL THEN '' ELSE ',\"p\":\"' || p || '\"' END || '}}' AS cell FROM ch",
}
