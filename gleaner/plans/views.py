"""Queries of what a reader's page shows, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.operators import calibration as cal
from gleaner.operators import evidence as ev
from gleaner.operators import places as pl
from gleaner.operators import publish as pb
from gleaner.operators import ranking as rk
from gleaner.operators import ratings as rt
from gleaner.operators import selection as sel
from gleaner.operators import validation as val
from gleaner.operators import views as vw
from gleaner.plans import answers as an
from gleaner.plans import evidence as base
from gleaner.plans import ratings as rated
from gleaner.plans import texts
from gleaner.runtime import load, materialise, scratch_path

S = Settings()


def _page(spark, sf_dir):
    """(resolved basket, totals, chain cells, branch cells, items), slim."""
    weighed, cells, chains = an._tables(spark, sf_dir)
    items = materialise(an.slim(ev.item_cells(weighed), "store", "item_key").withColumnRenamed("item_key", "name"), "items")
    chain, totals = materialise(an.slim(chains, "store", "category"), "chains"), materialise(an.slim(ev.store_totals(chains), "store"), "totals")
    return rk.resolve(an._basket(spark), items, chain, rk.keyword_table(spark)), totals, chain, cells, items


def agg_basket_size(spark, sf_dir):
    return vw.basket_size(an._basket(spark))


def flt_unmatched(spark, sf_dir):
    return vw.unmatched(an._basket(spark), _page(spark, sf_dir)[0])


def _ordered(spark, sf_dir, sort):
    resolved, totals, *_ = _page(spark, sf_dir)
    return vw.ordered_stores(rk.rank_stores(resolved, an.PREFERENCE, S), totals, sort, 1.0, True, S)


def top_basket_covered(spark, sf_dir):
    return _ordered(spark, sf_dir, "covered").select("place", "store", "covered", "avg")


def top_basket_quality(spark, sf_dir):
    return _ordered(spark, sf_dir, "quality").select("place", "store", "s")


def top_basket_evidence(spark, sf_dir):
    return _ordered(spark, sf_dir, "evidence").select("place", "store", "w")


def agg_second_stop(spark, sf_dir):
    return vw.second_stop(materialise(_ordered(spark, sf_dir, "covered"), "ordered"))


def top_suggestions(spark, sf_dir):
    return vw.suggestions(rk.ordered_keywords(spark), an._basket(spark))


def _pins(spark, sf_dir) -> DataFrame:
    pins = rt.pins(load(spark, sf_dir, "places"))
    linked = pl.attach_branches(pins, rated._branch_names(spark, sf_dir)).select("osm", "branch")
    return materialise(pins.select("osm", "store", "city", "address").join(linked, "osm", "left"), "pins")


def _pin_ratings(spark, sf_dir) -> DataFrame:
    summary = rt.summarise(rated._reviews(spark, sf_dir), ["gmap_id"], S).select("gmap_id", "norm", "thin")
    return rt.match_one_to_one(rated._edges(spark, sf_dir)).join(summary, "gmap_id").select("osm", "norm", "thin")


def set_map_list(spark, sf_dir):
    pins = _pins(spark, sf_dir).withColumns({c: F.coalesce(c, F.lit("")) for c in ("city", "address")})
    return vw.map_list(pins, ["store", "city", "address", "osm"])


def flt_map_claims(spark, sf_dir):
    """Pins with a branch, coloured by their category's cell."""
    _, totals, chain, cells, _ = _page(spark, sf_dir)
    pins = _pins(spark, sf_dir)
    scores = rk.place_scores(pins, an.slim(cells, "store", "branch", "category"), chain, "produce")
    return vw.map_pins(pins, totals, scores=scores, with_branch=True)


def flt_map_store(spark, sf_dir):
    _, totals, *_ = _page(spark, sf_dir)
    return vw.map_pins(_pins(spark, sf_dir), totals, store="Star Market")


def flt_map_ratings(spark, sf_dir):
    pins = _pins(spark, sf_dir)
    return vw.map_pins(pins, pins, ratings=_pin_ratings(spark, sf_dir), colour="ratings")


def flt_map_merged(spark, sf_dir):
    pins = _pins(spark, sf_dir)
    return vw.map_pins(pins, pins, merged_stores=rated.ml_combine_store(spark, sf_dir), merged_branches=rated.ml_combine_branch(spark, sf_dir), colour="merged")


def _cross(spark, sf_dir, population):
    totals = an.slim(ev.store_totals(an._tables(spark, sf_dir)[2]), "store")
    return vw.cross_rows(totals, rt.summarise(rated._reviews(spark, sf_dir), ["store"], S), population)


def top_cross_all(spark, sf_dir):
    return _cross(spark, sf_dir, "norm")


def top_cross_recent(spark, sf_dir):
    return _cross(spark, sf_dir, "norm_recent")


def top_cross_long(spark, sf_dir):
    return _cross(spark, sf_dir, "norm_long")


def top_detail_categories(spark, sf_dir):
    return vw.detail_categories(_page(spark, sf_dir)[2]).select("store", "category", "w", "place")


def top_detail_items(spark, sf_dir):
    return vw.detail_items(_page(spark, sf_dir)[4]).select("store", "name", "w", "place")


def top_store_cards(spark, sf_dir):
    _, totals, _, cells, _ = _page(spark, sf_dir)
    return vw.store_cards(totals, cells.where("branch <> ''"))


def agg_combined_bars(spark, sf_dir):
    return vw.combined_bars(rated.ml_combine_store(spark, sf_dir))


def agg_evidence_dates(spark, sf_dir):
    rows = base._weighed(spark, sf_dir)
    day = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd")
    return rows.agg(day(F.min("created_utc")).alias("first_date"), day(F.max("created_utc")).alias("last_date"), F.count(F.lit(1)).alias("n"))


def agg_selection_counts(spark, sf_dir):
    return sel.selection_counts(texts._docs(spark, sf_dir), ["delivery_id"], S)


def agg_selected_subreddits(spark, sf_dir):
    docs = texts._docs(spark, sf_dir)
    return rt.counted(sel.select_candidates(docs, ["delivery_id"], S), "subreddit")


def jsn_stale_totals(spark, sf_dir):
    """Totals of an older table, without score and valenced weight, taken back from what was published."""
    v = ev.view(ev.store_totals(an._tables(spark, sf_dir)[2]), S)
    old = v.withColumns({"score": F.lit(None).cast("double"), "valenced": F.lit(None).cast("double")})
    return vw.raw_evidence(old, S).select("store", F.round("score", 3).alias("score"), F.round("valenced", 4).alias("valenced"))


def _claim_merge(spark, sf_dir):
    """(calibration, first's and second's branch cells) of the two sources of claims."""
    valid = ev.valid_claims(load(spark, sf_dir, "claims"), S)
    first, second = (materialise(ev.branch_cells(ev.weigh(ev.prepare(valid.where(c), S), S)), "cells") for c in ("coalesce(gmap_id, '') = ''", "coalesce(gmap_id, '') <> ''"))
    fit = materialise(cal.claim_calibration(ev.store_totals(ev.chain_cells(first)), ev.store_totals(ev.chain_cells(second)), S), "calibration")
    return fit, first, second


def agg_review_claims(spark, sf_dir):
    """How many claims of the second source its store totals count."""
    second = base._weighed_where(spark, sf_dir, "coalesce(gmap_id, '') <> ''")
    return ev.store_totals(ev.chain_cells(ev.branch_cells(second))).agg(F.sum("n").alias("n_review_claims"))


def ml_combine_claim_store(spark, sf_dir):
    fit, first, second = _claim_merge(spark, sf_dir)
    t1, t2 = (ev.store_totals(ev.chain_cells(c)) for c in (first, second))
    return cal.combine_claims(t1, t2, ["store"], fit, S)


def ml_combine_claim_branch(spark, sf_dir):
    """Branch by category: the first source's branches; in these the second's categories too. The line is the stores'."""
    fit, first, second = _claim_merge(spark, sf_dir)
    named = first.select("store", "branch").distinct()
    return cal.combine_claims(first, second.join(named, ["store", "branch"], "left_semi"), ["store", "branch", "category"], fit, S)


def _document(spark, sf_dir):
    weighed = base._weighed(spark, sf_dir).where(val.is_public_link(F.col("permalink")))
    return materialise(pb.verdict_sections(materialise(weighed, "weighed"), S), "sections")


def jsn_document(spark, sf_dir):
    """A document written, read again and counted: entries by section, and the keys below them."""
    head = {"generated_at": "2026-02-02", "method": {"shrinkage": S.shrinkage}, "places": [], "keywords": {r["word"]: r["category"] for r in rk.keyword_table(spark).collect()}}
    path = scratch_path(spark, "document")
    pb.write_sections(spark, _document(spark, sf_dir), head, path)
    stores, cells = dict.fromkeys(pb.DEPTH, 0), dict.fromkeys(pb.DEPTH, 0)
    for names, _ in pb.read_entries(spark, path):
        if names[0] in pb.DEPTH:
            stores[names[0]] += len(names) == 2
            cells[names[0]] += len(names) == pb.DEPTH[names[0]] + 1
    rows = [(name, stores[name], cells[name]) for name in pb.DEPTH]
    return spark.createDataFrame(rows, "section string, stores bigint, cells bigint")


def jsn_item_cells(spark, sf_dir):
    """The items' entries as they stand in the document."""
    rows = _document(spark, sf_dir).where("section = 'items'")
    return rows.select(F.col("path")[0].alias("store"), F.col("path")[1].alias("item"), F.get_json_object("body", "$.n").cast("bigint").alias("n"), F.get_json_object("body", "$.p").alias("p"), F.get_json_object("body", "$.e[0].u").alias("first_link"))


def flt_branch_floor(spark, sf_dir):
    return ev.above_floor(base._cells(spark, sf_dir), S).select("store", "branch", "category", "n")


def jsn_payload(spark, sf_dir):
    """The sections of the published document that hold a row per store."""
    weighed, cells, chains = an._tables(spark, sf_dir)
    return pb.totals_section(ev.view(ev.store_totals(chains), S), S)


_PREFIXES = ("agg", "flt", "top", "set", "jsn", "ml")
_NAMES = [n for n in list(globals()) if n.split("_")[0] in _PREFIXES and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

# --- SQL ---
_ANSWER = an.base.BASE + f", {an._CH}, {an._IT}, {an._TO}, {an._RESOLVED}"
_RANKED = f"""{_ANSWER}, ranked AS (SELECT store, cast(sum(qty) AS BIGINT) AS covered, round(sum(v * qty) / sum(qty), 4) AS avg,
    coalesce(string_agg(term, ',' ORDER BY term) FILTER (v < -0.15), '') AS weak FROM marked GROUP BY store),
    shown AS (SELECT ranked.*, tt.s, tt.w FROM ranked JOIN tt USING (store) WHERE tt.w >= 1.0 AND tt.w >= 0.3)"""
_PLACED = "SELECT cast(row_number() OVER (ORDER BY {o}, store) AS INTEGER) AS place, {c} FROM shown"
_KW = "kw AS (SELECT word, min(ord) AS ord FROM (SELECT unnest([" + ", ".join(an._q(w) for ws in vocab.LIST_WORDS.values() for w in ws) + "]) AS word, unnest(range(" + str(sum(map(len, vocab.LIST_WORDS.values()))) + ")) AS ord) GROUP BY word)"
_MAP = f"{rated._PINS}, {rated._BRANCHES}, {rated._ATTACHED}, mp AS (SELECT p.osm, p.store, a.branch, coalesce(p.city, '') AS city, coalesce(p.address, '') AS address FROM pins p LEFT JOIN attached a ON a.osm = p.osm)"
_CROSS = """SELECT store, tt.s AS first, {p} AS second, {m} AS stars, round({p} - tt.s, 4) AS gap,
    cast(row_number() OVER (ORDER BY round({p} - tt.s, 4) DESC, store) AS INTEGER) AS place FROM tt JOIN st USING (store) WHERE NOT thin AND {p} IS NOT NULL"""
_DETAIL = "SELECT store, {k}, w, cast(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY store ORDER BY w DESC, {k}) AS place FROM {f}) WHERE place <= {n}"
_MERGED = {k: rated.ORACLES[f"ml_combine_{k}"] for k in ("store", "branch")}


def _side_cells(where: str, tag: str) -> str:
    return rated._side(where, tag).replace(base.CHAIN_CELLS, base.BRANCH_CELLS)


_TWO_CELLS = "WITH " + _side_cells("coalesce(gmap_id, '') = ''", "b1") + ", " + _side_cells("coalesce(gmap_id, '') <> ''", "b2")
_TOTAL = "SELECT store, sum(n) AS n, sum(score) AS score, sum(valenced) AS valenced FROM {c} WHERE category NOT IN ('labor_ethics', 'store_lifecycle') GROUP BY store"
_CLAIM_FIT = f"""{_TWO_CELLS}, u1 AS ({_TOTAL.format(c='b1')}), u2 AS ({_TOTAL.format(c='b2')}), prs AS (SELECT u1.store AS id, u2.score / u2.valenced AS x, u1.score / u1.valenced AS y, u1.valenced AS w
    FROM u1 JOIN u2 USING (store) WHERE u1.n >= 30 AND u2.n >= 30 AND u1.valenced > 0 AND u2.valenced > 0), {rated._FIT}"""
_CLAIM_SIDES = (
    "CASE WHEN w1 > 0 THEN sc1 / w1 END", "1 / greatest(w1, 1e-9)", f"CASE WHEN w2 > 0 THEN {rated._APPLY.format(x='(sc2 / w2)')} END", "slope * slope / greatest(w2, 1e-9) + residual_sd * residual_sd",
)
_BOTH_BRANCHES = """(SELECT coalesce(a.store, b.store) AS store, coalesce(a.branch, b.branch) AS branch, coalesce(a.category, b.category) AS category, a.score AS sc1, a.valenced AS w1, b.score AS sc2, b.valenced AS w2, fit.*
    FROM b1 a FULL JOIN (SELECT * FROM b2 WHERE (store, branch) IN (SELECT (store, branch) FROM b1)) b ON a.store = b.store AND a.branch = b.branch AND a.category = b.category, fit)"""

_PUBLIC = base.BASE + ", pub AS (SELECT * FROM weighed WHERE regexp_matches(permalink, '^/r/[A-Za-z0-9_]+/'))"
_CELLS_OF = "SELECT '{s}' AS section, count(DISTINCT store) AS stores, count(*) AS cells FROM (SELECT {k} FROM pub WHERE {c} GROUP BY ALL HAVING {h})"
_REGION = f"regexp_matches(trim(branch), '{vocab.REGION}')"

ORACLES = {
    "jsn_document": _PUBLIC + " " + " UNION ALL ".join([
        _CELLS_OF.format(s="stores", k="store, category", c="true", h="sum(w) >= 0.3"),
        _CELLS_OF.format(s="branches", k="store, branch, category", c=f"branch <> '' AND NOT {_REGION}", h="sum(w) >= 0.3"),
        _CELLS_OF.format(s="regions", k="store, branch, category", c=f"branch <> '' AND {_REGION}", h="sum(w) >= 0.3"),
        _CELLS_OF.format(s="items", k="store, item_key", c="item_key <> ''", h="round(sum(w), 2) >= 1.0"),
        _CELLS_OF.format(s="totals", k="store", c="category NOT IN ('labor_ethics', 'store_lifecycle')", h="true"),
    ]),
    "jsn_item_cells": _PUBLIC + """ SELECT store, item_key AS item, count(*) AS n, CASE WHEN sum(CASE WHEN pr IS NOT NULL THEN w ELSE 0 END) >= 1 THEN
            CASE WHEN sum(coalesce(w * pr, 0)) / (sum(CASE WHEN pr IS NOT NULL THEN w ELSE 0 END) + 2) < -0.15 THEN 'cheap' WHEN sum(coalesce(w * pr, 0)) / (sum(CASE WHEN pr IS NOT NULL THEN w ELSE 0 END) + 2) > 0.15 THEN 'expensive' ELSE 'fair' END END AS p,
        list_extract(list(permalink ORDER BY w DESC, claim_row), 1) AS first_link FROM pub WHERE item_key <> '' GROUP BY store, item_key HAVING round(sum(w), 2) >= 1.0""",
    "flt_branch_floor": base.BASE + "SELECT store, branch, category, count(*) AS n FROM weighed GROUP BY ALL HAVING sum(w) >= 0.3",
    "agg_basket_size": f"SELECT cast({len(an.BASKET)} AS BIGINT) AS items, sum(qty) AS units FROM (VALUES " + ", ".join(f"({q})" for _, q in an.BASKET) + ") AS b(qty)",
    "flt_unmatched": _ANSWER + " SELECT term FROM basket WHERE term NOT IN (SELECT term FROM resolved)",
    "top_basket_covered": f"{_RANKED} {_PLACED.format(o='covered DESC, avg DESC', c='store, covered, avg')}",
    "top_basket_quality": f"{_RANKED} {_PLACED.format(o='s DESC', c='store, s')}",
    "top_basket_evidence": f"{_RANKED} {_PLACED.format(o='w DESC', c='store, w')}",
    "agg_second_stop": f"""{_RANKED}, o AS (SELECT *, row_number() OVER (ORDER BY covered DESC, avg DESC, store) AS place FROM shown)
        SELECT a.store AS best, b.store AS second, round(a.avg - b.avg, 4) AS gap, CASE WHEN b.store IS NULL THEN 'alone' WHEN a.weak <> '' THEN 'weak' WHEN round(a.avg - b.avg, 4) < 0.08 THEN 'close' ELSE 'no' END AS note
        FROM (SELECT * FROM o WHERE place = 1) a LEFT JOIN (SELECT * FROM o WHERE place = 2) b ON true""",
    "top_suggestions": f"""WITH {_KW}, {an._BASKET}, r AS (SELECT word, row_number() OVER (ORDER BY ord) - 1 AS i FROM kw WHERE word NOT IN (SELECT term FROM basket)),
        f AS (SELECT word, row_number() OVER (ORDER BY i) AS place FROM r WHERE i < 40 AND i % 5 = 0) SELECT word, cast(place AS INTEGER) AS place FROM f WHERE place <= 7""",
    "set_map_list": f"""WITH {_MAP}, f AS (SELECT store, branch, min({{a: store, b: city, c: address, d: osm}}) AS o FROM mp GROUP BY store, branch)
        SELECT store, branch, cast(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (ORDER BY o) AS place FROM f) WHERE place <= 14""",
    "flt_map_claims": base.BASE + f""", {an._CH}, {an._BC}, {_MAP} SELECT mp.osm, coalesce(bc.s, ch.s) AS s FROM mp LEFT JOIN bc ON bc.store = mp.store AND bc.branch = mp.branch AND bc.category = 'produce'
        LEFT JOIN ch ON ch.store = mp.store AND ch.category = 'produce' WHERE mp.branch IS NOT NULL AND coalesce(bc.s, ch.s) IS NOT NULL""",
    "flt_map_store": base.BASE + f", {an._TO}, {_MAP} SELECT mp.osm, tt.s FROM mp LEFT JOIN tt USING (store) WHERE mp.store = 'Star Market'",
    "flt_map_ratings": f"WITH {_MAP}, {rated._EDGES}, {rated._LINKED}, {rated._REVIEWS} SELECT mp.osm, r.norm AS s FROM mp JOIN linked USING (osm) JOIN {rated._rating('gmap_id')} r USING (gmap_id) WHERE NOT r.thin",
    "flt_map_merged": f"""WITH {_MAP}, ms AS ({_MERGED['store']}), mb AS ({_MERGED['branch']}) SELECT osm, s FROM (SELECT mp.osm, CASE WHEN mp.branch IS NOT NULL THEN mb.v ELSE ms.v END AS s FROM mp
        LEFT JOIN mb ON mb.store = mp.store AND mb.branch = mp.branch LEFT JOIN ms ON ms.store = mp.store) WHERE s IS NOT NULL""",
    "top_cross_all": base.BASE + f", {an._TO}, {rated._REVIEWS}, {rated._ST} " + _CROSS.format(p="norm", m="mean"),
    "top_cross_recent": base.BASE + f", {an._TO}, {rated._REVIEWS}, {rated._ST} " + _CROSS.format(p="norm_recent", m="mean_recent"),
    "top_cross_long": base.BASE + f", {an._TO}, {rated._REVIEWS}, {rated._ST} " + _CROSS.format(p="norm_long", m="coalesce(mean_long, mean)"),
    "top_detail_categories": base.BASE + f", {an._CH} " + _DETAIL.format(k="category", f="ch", n=8),
    "top_detail_items": base.BASE + f", {an._IT} " + _DETAIL.format(k="name", f="it", n=6),
    "top_store_cards": base.BASE + f""", {an._TO} SELECT store, n, w, s, coalesce(nb, 0) AS n_branches, cast(row_number() OVER (ORDER BY w DESC, store) AS INTEGER) AS place
        FROM tt LEFT JOIN (SELECT store, count(DISTINCT branch) AS nb FROM weighed WHERE branch <> '' GROUP BY store) USING (store)""",
    "agg_combined_bars": f"SELECT store, round((r + 1) / 2, 5) AS first, round((g + 1) / 2, 5) AS second, round((v + 1) / 2, 5) AS combined, cast(round(share * 100) AS INTEGER) AS percent FROM ({_MERGED['store']}) WHERE r IS NOT NULL AND g IS NOT NULL",
    "agg_evidence_dates": base.BASE + " SELECT strftime(to_timestamp(min(created_utc)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS first_date, strftime(to_timestamp(max(created_utc)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS last_date, count(*) AS n FROM weighed",
    "agg_selection_counts": f"WITH {texts._DOCS}, {texts._QUALIFIED} SELECT (SELECT count(*) FROM docs) AS scanned, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS duplicates FROM qualified",
    "agg_selected_subreddits": f"""WITH {texts._DOCS}, {texts._QUALIFIED}, firsts AS ({texts._FIRST.format(t='text', f='qualified')})
        SELECT subreddit, count(*) AS n FROM docs WHERE delivery_id IN (SELECT delivery_id FROM firsts) GROUP BY subreddit""",
    "jsn_stale_totals": base.BASE + f", t AS ({base.cell_view('store', base.TOTALS)}) SELECT store, round(CASE WHEN weighted_evidence > 0 THEN sentiment * (weighted_evidence + 2) END, 3) AS score, weighted_evidence AS valenced FROM t",
    "agg_review_claims": f"{_TWO_CELLS} SELECT cast(sum(n) AS BIGINT) AS n_review_claims FROM b2 WHERE category NOT IN ('labor_ethics', 'store_lifecycle')",
    "ml_combine_claim_store": f"{_CLAIM_FIT} " + rated._combine("store", "(SELECT coalesce(u1.store, u2.store) AS store, u1.score AS sc1, u1.valenced AS w1, u2.score AS sc2, u2.valenced AS w2, fit.* FROM u1 FULL JOIN u2 ON u1.store = u2.store, fit)", *_CLAIM_SIDES),
    "ml_combine_claim_branch": f"{_CLAIM_FIT} " + rated._combine("store, branch, category", _BOTH_BRANCHES, *_CLAIM_SIDES),
    "jsn_payload": base.BASE + f""", t AS ({base.cell_view('store', base.TOTALS)}) SELECT store, n_claims AS n, round(weighted_evidence, 1) AS w, round(sentiment, 3) AS s, weighted_evidence < 0.3 AS thin FROM t""",
}
