"""Queries from claims to verdicts, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.functions.text import UNSAFE, fold_key
from gleaner.operators import evidence as ev
from gleaner.runtime import load

S = Settings()


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.valid_claims(load(spark, sf_dir, "claims"), S)


def _weighed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.weigh(ev.prepare(_claims(spark, sf_dir), S), S)


def _weighed_where(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    return ev.weigh(ev.prepare(_claims(spark, sf_dir).where(condition), S), S)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.branch_cells(_weighed(spark, sf_dir))


def val_claim_rows(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_row", "claim", "location")


def str_scrub(spark, sf_dir):
    return load(spark, sf_dir, "claims").select("claim_row", F.regexp_replace("claim", UNSAFE, "").alias("claim"))


def str_normalise(spark, sf_dir):
    return load(spark, sf_dir, "claims").where("item is not null").select("claim_row", fold_key(F.col("item")).alias("item_key"))


def str_branch_key(spark, sf_dir):
    rows = load(spark, sf_dir, "claims").where("location is not null and store is not null")
    return rows.select("claim_row", ev.branch_key(F.col("location"), F.col("store")).alias("branch"))


def mth_recency(spark, sf_dir):
    w = scoring.recency_weight(F.col("created_utc"), S.now, scoring.half_life(F.col("category"), S))
    return load(spark, sf_dir, "claims").select("claim_row", F.round(w, 6).alias("decay"))


def mth_vote(spark, sf_dir):
    return load(spark, sf_dir, "claims").select("claim_row", F.round(scoring.vote_weight(F.col("score")), 6).alias("vote"))


def mth_claim_weight(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_row", F.round(scoring.claim_weight(S), 6).alias("w"))


def mth_month(spark, sf_dir):
    return load(spark, sf_dir, "claims").groupBy(scoring.month(F.col("created_utc")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


def set_claim_dedup(spark, sf_dir):
    return ev.dedupe(_claims(spark, sf_dir)).select("claim_row")


def flt_durable(spark, sf_dir):
    return ev.dedupe(_claims(spark, sf_dir)).where("not transient").groupBy("store").agg(F.count(F.lit(1)).alias("n"))


def join_reciprocal(spark, sf_dir):
    rows = ev.mark_reciprocal(ev.dedupe(_claims(spark, sf_dir)).where("not transient"))
    return rows.where("reciprocal").select("claim_row")


def win_caps(spark, sf_dir):
    return ev.prepare(_claims(spark, sf_dir), S).select("claim_row", "reciprocal")


def agg_branch_cell(spark, sf_dir):
    return ev.view(_cells(spark, sf_dir), S)


def agg_chain_cell(spark, sf_dir):
    return ev.view(ev.chain_cells(_cells(spark, sf_dir)), S)


def agg_item_cell(spark, sf_dir):
    return ev.view(ev.item_cells(_weighed(spark, sf_dir)), S)


def flt_item_floor(spark, sf_dir):
    cells = ev.view(ev.item_cells(_weighed(spark, sf_dir)), S, digits=2)
    return cells.where(F.col("weighted_evidence") >= S.min_item_weight).select("store", "item_key", "n_claims", "weighted_evidence")


def flt_evidence_floor(spark, sf_dir):
    cells = ev.chain_cells(_cells(spark, sf_dir)).where(F.col("weight") >= S.min_weight)
    return cells.select("store", "category", "n")


def agg_store_totals(spark, sf_dir):
    return ev.view(ev.store_totals(ev.chain_cells(_cells(spark, sf_dir))), S)


def agg_branch_totals(spark, sf_dir):
    return ev.view(ev.branch_totals(_cells(spark, sf_dir)), S)


def agg_headline_half_life(spark, sf_dir):
    return ev.headline_half_life(ev.chain_cells(_cells(spark, sf_dir)), S).select(F.round("half_life", 4).alias("half_life"))


def agg_branch_label(spark, sf_dir):
    return ev.modal_labels(_weighed(spark, sf_dir), "branch", "location")


def agg_item_label(spark, sf_dir):
    return ev.modal_labels(_weighed(spark, sf_dir), "item_key", "item")


def win_top_evidence(spark, sf_dir):
    return ev.top_evidence(_weighed(spark, sf_dir), ["store", "category"], 5).select("store", "category", "place", "claim_row")


def flt_region(spark, sf_dir):
    names = load(spark, sf_dir, "claims").where("location is not null and store is not null").select(ev.branch_key(F.col("location"), F.col("store")).alias("branch"))
    return names.distinct().select("branch", ev.is_branch(F.col("branch")).alias("is_branch"))


def agg_categories(spark, sf_dir):
    return _claims(spark, sf_dir).select("category").distinct()


def top_store_totals(spark, sf_dir):
    totals = ev.view(ev.store_totals(ev.chain_cells(_cells(spark, sf_dir))), S)
    return totals.orderBy(F.desc("weighted_evidence"), "store").limit(10).select("store", "n_claims", "weighted_evidence")


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("val", "str", "mth", "set", "flt", "join", "win", "agg", "top") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

# --- SQL. Written against the tables, not derived from the plans above. ---
_SP = r"[\s\v\x{A0}]+"
_CATS = ", ".join(f"'{c}'" for c in vocab.CATEGORIES)


def _norm(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{_SP}', ' ', 'g'))"



_UNSAFE = r"[\x{00}-\x{1F}\x{7F}-\x{9F}\x{AD}\x{61C}\x{180E}\x{200B}-\x{200F}\x{2028}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FEFF}\x{FFF9}-\x{FFFB}]"
_SUFFIX = vocab.STREET_SUFFIX


def _branch(loc: str, store: str) -> str:
    key = _norm(loc)
    cut = rf"trim(regexp_replace(regexp_replace(regexp_replace({key}, '^the\s+', ''), '\s+(one|store|location)$', ''), ',?\s*(ma|mass|massachusetts)$', ''))"
    parts = f"array_to_string(list_transform(string_split({cut}, ','), lambda p: regexp_replace(trim(p), '{_SUFFIX}', '')), ', ')"
    return f"CASE WHEN {key} IN ({_CATS}) OR {key} = {_norm(store)} THEN '' ELSE {parts} END"


_HALF = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.HALF_LIFE_YEARS.items()) + " ELSE 4.0 END"
_CONF = "CASE confidence WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.6 WHEN 'low' THEN 0.3 ELSE 0.6 END::DOUBLE"
_DECAY = f"pow(0.5::DOUBLE, greatest((1770000000 - created_utc) / 31557600.0::DOUBLE, 0.0::DOUBLE) / ({_HALF})::DOUBLE)"
_VOTE = "CASE WHEN score IS NULL THEN 1.0 WHEN score < 0 THEN 0.5 ELSE least(1.0 + ln(1.0::DOUBLE + score) / 5.0::DOUBLE, 2.0) END::DOUBLE"

_VALID = rf"""valid AS (SELECT claim_row, store, category, sentiment, coalesce(price_signal, 'none') AS price_signal, confidence, coalesce(transient, false) AS transient, source_key, permalink,
    coalesce(author, '') AS author, created_utc, score, regexp_replace(claim, '{_UNSAFE}', '', 'g') AS claim, regexp_replace(coalesce(location, ''), '{_UNSAFE}', '', 'g') AS location,
    regexp_replace(coalesce(item, ''), '{_UNSAFE}', '', 'g') AS item, regexp_replace(coalesce(comparator_store, ''), '{_UNSAFE}', '', 'g') AS comparator_store FROM claims
    WHERE store IS NOT NULL AND category IS NOT NULL AND claim IS NOT NULL AND sentiment IS NOT NULL AND confidence IS NOT NULL AND source_key IS NOT NULL AND permalink IS NOT NULL
    AND created_utc BETWEEN 1100000000 AND 1770000000 + 31557600)"""
_DEDUP = "dedup AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY source_key, store, category, claim ORDER BY claim_row) AS rn FROM valid) WHERE rn = 1)"
_DURABLE = "durable AS (SELECT * FROM dedup WHERE NOT transient)"
_RECIP = """recip AS (SELECT d.*, d.comparator_store <> '' AND EXISTS (SELECT 1 FROM durable o WHERE o.source_key = d.source_key AND o.store = d.comparator_store) AS reciprocal FROM durable d)"""
_CAPS = f"""listed AS (SELECT store, list({{r: claim_row, doc: source_key, author: author, named: author NOT IN ('', '[deleted]', '[removed]'), cat: category}}
        ORDER BY {_CONF} DESC, created_utc DESC, source_key, claim, claim_row) AS l FROM recip GROUP BY store),
    kept AS (SELECT unnest(list_reduce(list_transform(l, lambda e: [e]), lambda acc, e: CASE
        WHEN len(list_filter(acc, lambda a: a.doc = e[1].doc)) >= 3 OR (e[1].named AND len(list_filter(acc, lambda a: a.author = e[1].author AND a.cat = e[1].cat)) >= 2)
        THEN acc ELSE list_concat(acc, e) END)) AS k FROM listed),
    prepared AS (SELECT recip.* FROM recip JOIN kept ON recip.claim_row = kept.k.r)"""
_WEIGHED = f"""weighed AS (SELECT *, {_DECAY} * {_CONF} * {_VOTE} * CASE WHEN reciprocal THEN 0.5 ELSE 1.0 END::DOUBLE AS w, {_branch('location', 'store')} AS branch,
    {_norm('item')} AS item_key, CASE sentiment WHEN 'positive' THEN 1.0 WHEN 'negative' THEN -1.0 END::DOUBLE AS sent,
    CASE price_signal WHEN 'cheap' THEN -1.0 WHEN 'fair' THEN 0.0 WHEN 'expensive' THEN 1.0 END::DOUBLE AS pr FROM prepared)"""
BASE = "WITH " + ",\n".join([_VALID, _DEDUP, _DURABLE, _RECIP, _CAPS, _WEIGHED])
CELL = """count(*) AS n, sum(w) AS weight, sum(coalesce(w * sent, 0)) AS score, sum(CASE WHEN sent IS NOT NULL THEN w ELSE 0 END) AS valenced, sum(coalesce(w * pr, 0)) AS price_score,
    sum(CASE WHEN pr IS NOT NULL THEN w ELSE 0 END) AS price_weight, count(*) FILTER (price_signal = 'cheap') AS n_cheap, count(*) FILTER (price_signal = 'fair') AS n_fair,
    count(*) FILTER (price_signal = 'expensive') AS n_expensive"""


def cell_view(keys: str, source: str, digits: int = 4) -> str:
    return f"""SELECT {keys}, n AS n_claims, round(weight, {digits}) AS weighted_evidence, round(CASE WHEN valenced = 0 THEN 0 ELSE score / (valenced + 2) END, {digits}) AS sentiment,
        round(score, {digits}) AS score, round(valenced, {digits}) AS valenced_weight, CASE WHEN price_weight >= 1 THEN round(price_score / (price_weight + 2), {digits}) END AS price_level,
        CASE WHEN price_weight < 1 THEN NULL WHEN price_score / (price_weight + 2) < -0.15 THEN 'cheap' WHEN price_score / (price_weight + 2) > 0.15 THEN 'expensive' ELSE 'fair' END AS price_signal,
        n_cheap, n_fair, n_expensive FROM {source}"""


_SHOP = "category NOT IN ('labor_ethics', 'store_lifecycle')"
BRANCH_CELLS = f"(SELECT store, branch, category, {CELL} FROM weighed GROUP BY ALL)"
CHAIN_CELLS = f"(SELECT store, category, {CELL} FROM weighed GROUP BY ALL)"
TOTALS = f"(SELECT store, {CELL} FROM weighed WHERE {_SHOP} GROUP BY ALL)"
BRANCH_TOTALS = f"(SELECT store, branch, {CELL} FROM weighed WHERE branch <> '' AND {_SHOP} GROUP BY ALL)"
_NOLABEL = "SELECT store, {k}, label FROM (SELECT store, {k}, regexp_replace({c}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g') AS label, row_number() OVER (PARTITION BY store, {k} ORDER BY count(*) DESC, min(claim_row)) AS rn FROM weighed WHERE {k} <> '' GROUP BY 1, 2, 3) WHERE rn = 1"

ORACLES = {
    "val_claim_rows": f"WITH {_VALID} SELECT claim_row, claim, location FROM valid",
    "str_scrub": f"SELECT claim_row, regexp_replace(claim, '{_UNSAFE}', '', 'g') AS claim FROM claims",
    "str_normalise": f"SELECT claim_row, {_norm('item')} AS item_key FROM claims WHERE item IS NOT NULL",
    "str_branch_key": f"SELECT claim_row, {_branch('location', 'store')} AS branch FROM claims WHERE location IS NOT NULL AND store IS NOT NULL",
    "mth_recency": f"SELECT claim_row, round({_DECAY}, 6) AS decay FROM claims",
    "mth_vote": f"SELECT claim_row, round({_VOTE}, 6) AS vote FROM claims",
    "mth_claim_weight": f"WITH {_VALID} SELECT claim_row, round({_DECAY} * {_CONF} * {_VOTE}, 6) AS w FROM valid",
    "mth_month": "SELECT strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS n FROM claims GROUP BY 1",
    "set_claim_dedup": f"WITH {_VALID}, {_DEDUP} SELECT claim_row FROM dedup",
    "flt_durable": f"WITH {_VALID}, {_DEDUP}, {_DURABLE} SELECT store, count(*) AS n FROM durable GROUP BY store",
    "join_reciprocal": f"WITH {_VALID}, {_DEDUP}, {_DURABLE}, {_RECIP} SELECT claim_row FROM recip WHERE reciprocal",
    "win_caps": f"WITH {_VALID}, {_DEDUP}, {_DURABLE}, {_RECIP}, {_CAPS} SELECT claim_row, reciprocal FROM prepared",
    "agg_branch_cell": BASE + cell_view("store, branch, category", BRANCH_CELLS),
    "agg_chain_cell": BASE + cell_view("store, category", CHAIN_CELLS),
    "agg_item_cell": BASE + cell_view("store, item_key", f"(SELECT store, item_key, {CELL} FROM weighed WHERE item_key <> '' GROUP BY ALL)"),
    "flt_item_floor": BASE + "SELECT store, item_key, count(*) AS n_claims, round(sum(w), 2) AS weighted_evidence FROM weighed WHERE item_key <> '' GROUP BY ALL HAVING round(sum(w), 2) >= 1.0",
    "flt_evidence_floor": BASE + "SELECT store, category, count(*) AS n FROM weighed GROUP BY ALL HAVING sum(w) >= 0.3",
    "agg_store_totals": BASE + cell_view("store", TOTALS),
    "agg_branch_totals": BASE + cell_view("store, branch", BRANCH_TOTALS),
    "agg_headline_half_life": BASE + f"SELECT round(-5.0 * ln(2) / ln(sum(weight * pow(0.5, 5.0 / ({_HALF}))) / sum(weight)), 4) AS half_life FROM {CHAIN_CELLS} WHERE {_SHOP}",
    "agg_branch_label": BASE + _NOLABEL.format(k="branch", c="location"),
    "agg_item_label": BASE + _NOLABEL.format(k="item_key", c="item"),
    "win_top_evidence": BASE + "SELECT store, category, cast(place AS INTEGER) AS place, claim_row FROM (SELECT *, row_number() OVER (PARTITION BY store, category ORDER BY w DESC, claim_row) AS place FROM weighed) WHERE place <= 5",
    "flt_region": rf"SELECT branch, NOT regexp_matches(trim(branch), '{vocab.REGION}') AS is_branch FROM (SELECT DISTINCT {_branch('location', 'store')} AS branch FROM claims WHERE location IS NOT NULL AND store IS NOT NULL)",
    "agg_categories": f"WITH {_VALID} SELECT DISTINCT category FROM valid",
    "top_store_totals": BASE + f"SELECT store, n AS n_claims, round(weight, 4) AS weighted_evidence FROM {TOTALS} ORDER BY round(weight, 4) DESC, store LIMIT 10",
}
