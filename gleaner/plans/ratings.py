"""Queries over ratings, places and the two sources' combination, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import scoring
from gleaner.operators import calibration as cal
from gleaner.operators import evidence as ev
from gleaner.operators import places as pl
from gleaner.operators import ratings as rt
from gleaner.plans import evidence as base
from gleaner.runtime import load, materialise

S = Settings()
BOX = (12.1, -41.6, 12.5, -41.1)
#: The test tables' listings and pins are scattered; a wider limit than the default gives matches to compare.
GEO = Settings(match_metres=3000.0)


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.usable_reviews(load(spark, sf_dir, "reviews"))


def src_reviews(spark, sf_dir):
    return _reviews(spark, sf_dir).groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rating")).alias("stars"), F.max("time").alias("last_ms"))


def agg_rating_store(spark, sf_dir):
    return rt.summarise(_reviews(spark, sf_dir), ["store"], S)


def agg_rating_place(spark, sf_dir):
    return rt.summarise(_reviews(spark, sf_dir), ["gmap_id"], S)


def agg_rating_block(spark, sf_dir):
    block = rt.summarise(_reviews(spark, sf_dir), [], S)
    places = _reviews(spark, sf_dir).agg(F.countDistinct("gmap_id").alias("n_locations"))
    return block.select("n", "first_month", "last_month", "median_month").crossJoin(places)


def mth_star_scale(spark, sf_dir):
    return _reviews(spark, sf_dir).select("rating").distinct().select("rating", F.round(scoring.star_scale(F.col("rating")), 3).alias("norm"))


def _edges(spark, sf_dir):
    return rt.nearby(load(spark, sf_dir, "businesses"), rt.pins(load(spark, sf_dir, "places")), GEO)


def join_geo(spark, sf_dir):
    return _edges(spark, sf_dir).select("gmap_id", "osm", F.round("metres", 2).alias("metres"))


def join_one_to_one(spark, sf_dir):
    return rt.match_one_to_one(_edges(spark, sf_dir)).select("gmap_id", "osm")


def join_map_rating(spark, sf_dir):
    rated = rt.summarise(_reviews(spark, sf_dir), ["gmap_id"], S).select("gmap_id", "n", "norm")
    return rt.match_one_to_one(_edges(spark, sf_dir)).join(rated, "gmap_id").select("osm", "n", "norm")


def win_last_pin(spark, sf_dir):
    return rt.pins(load(spark, sf_dir, "places")).select("osm", "place_id")


def str_match_store(spark, sf_dir):
    return load(spark, sf_dir, "businesses").select("gmap_id", pl.match_store(F.col("name")).alias("matched"))


def flt_food_shop(spark, sf_dir):
    rows = load(spark, sf_dir, "businesses").where(rt.in_area(F.col("latitude"), F.col("longitude"), BOX))
    return rows.where(pl.match_store(F.col("name")).isNotNull() & pl.is_food_shop(F.try_element_at("category", F.lit(1)))).select("gmap_id")


def agg_places_by_store(spark, sf_dir):
    return rt.counted(load(spark, sf_dir, "places").where("store is not null"), "store")


def top_places(spark, sf_dir):
    pins = rt.pins(load(spark, sf_dir, "places"))
    return pins.orderBy("store", "city", "address", "osm").limit(50).select("osm", "store")


def _branch_names(spark, sf_dir):
    names = load(spark, sf_dir, "claims").where("location is not null and store is not null")
    return names.select("store", ev.branch_key(F.col("location"), F.col("store")).alias("branch")).where("branch <> ''").distinct()


def join_branch(spark, sf_dir):
    return pl.attach_branches(rt.pins(load(spark, sf_dir, "places")), _branch_names(spark, sf_dir)).select("osm", "branch")


def _pins_with_rating(spark, sf_dir):
    """store, branch, and the rating of each linked pin."""
    pins = rt.pins(load(spark, sf_dir, "places"))
    linked = rt.match_one_to_one(_edges(spark, sf_dir)).select("gmap_id", "osm")
    rated = rt.summarise(_reviews(spark, sf_dir), ["gmap_id"], S)
    return pl.attach_branches(pins, _branch_names(spark, sf_dir)).join(linked, "osm").join(rated, "gmap_id")


def agg_pooled_branch(spark, sf_dir):
    out = rt.pooled(_pins_with_rating(spark, sf_dir), ["store", "branch"])
    return out.select("store", "branch", "n", F.round("n_eff", 4).alias("n_eff"), F.round("norm_recent", 4).alias("norm_recent"))


def _totals(spark, sf_dir):
    return materialise(ev.store_totals(ev.chain_cells(ev.branch_cells(base._weighed(spark, sf_dir)))), "totals")


def _pairs(totals: DataFrame, stores: DataFrame) -> DataFrame:
    """id, x (ratings), y (claims), w for the stores that both sources know well enough."""
    y = F.when(F.col("valenced") > 0, F.col("score") / F.col("valenced")).otherwise(scoring.shrunk(F.col("score"), F.col("valenced"), S))
    return totals.select("store", "score", "valenced").join(stores.where(~F.col("thin")), "store").select(F.col("store").alias("id"), F.col("norm_recent").alias("x"), y.alias("y"), F.col("valenced").alias("w"))


def ml_line(spark, sf_dir):
    line = cal.fit_line(_pairs(_totals(spark, sf_dir), rt.summarise(_reviews(spark, sf_dir), ["store"], S)))
    return line.select(F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"), "n")


def ml_leave_one_out(spark, sf_dir):
    out = cal.leave_one_out(materialise(_pairs(_totals(spark, sf_dir), rt.summarise(_reviews(spark, sf_dir), ["store"], S)), "pairs"))
    return out.select("id", F.round("error", 4).alias("error"))


def _calibration(spark, sf_dir, totals, stores):
    return materialise(cal.calibrate(materialise(_pairs(totals, stores), "pairs")), "calibration")


def ml_calibration(spark, sf_dir):
    out = _calibration(spark, sf_dir, _totals(spark, sf_dir), rt.summarise(_reviews(spark, sf_dir), ["store"], S))
    return out.select("n_stores", *[F.round(c, 4).alias(c) for c in ("intercept", "slope", "residual_sd", "r2")])


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows: score, valenced, n, n_eff, norm_recent (null where absent) and the calibration's columns."""
    weighed = F.col("valenced") > 0
    rated = F.coalesce(F.coalesce("n_eff", "n") >= S.min_ratings, F.lit(False))
    return cal.combine(
        rows, keys,
        F.when(weighed, F.col("score") / F.col("valenced")), F.when(weighed, cal.first_variance(F.col("valenced"))),
        F.when(rated, cal.apply_line(F.col("norm_recent"))), F.when(rated, cal.star_variance(F.coalesce("n_eff", "n"))), S,
    )


def ml_combine_store(spark, sf_dir):
    totals, stores = _totals(spark, sf_dir), rt.summarise(_reviews(spark, sf_dir), ["store"], S)
    fit = _calibration(spark, sf_dir, totals, stores)
    rows = totals.select("store", "score", "valenced").join(stores.select("store", "n", "n_eff", "norm_recent"), "store", "left").crossJoin(F.broadcast(fit))
    return _combined(rows, ["store"])


def ml_combine_branch(spark, sf_dir):
    """Branch totals and pooled pins, full outer; the residual is measured again at branches where there are enough."""
    weighed = base._weighed(spark, sf_dir)
    cells = materialise(ev.branch_cells(weighed), "cells")
    totals, branches = ev.store_totals(ev.chain_cells(cells)), ev.branch_totals(cells).select("store", "branch", "score", "valenced")
    fit = _calibration(spark, sf_dir, totals, rt.summarise(_reviews(spark, sf_dir), ["store"], S))
    pool = materialise(rt.pooled(_pins_with_rating(spark, sf_dir), ["store", "branch"]), "pool")
    at = pool.join(branches.where("valenced > 0"), ["store", "branch"]).crossJoin(F.broadcast(fit))
    error = F.col("score") / F.col("valenced") - cal.apply_line(F.col("norm_recent"))
    measured = at.agg(F.count(F.lit(1)).alias("k"), F.sum("valenced").alias("sw"), F.sum(F.col("valenced") * error**2).alias("se2"))
    enough = (F.col("k") >= S.branch_points) & (F.col("sw") > 0)
    refit = fit.crossJoin(F.broadcast(measured)).withColumn("residual_sd", F.when(enough, F.greatest(F.sqrt(F.try_divide("se2", "sw")), F.col("residual_sd"))).otherwise(F.col("residual_sd")))
    rows = branches.join(pool, ["store", "branch"], "full").crossJoin(F.broadcast(refit.select("intercept", "slope", "residual_sd")))
    return _combined(rows.withColumn("valenced", F.coalesce("valenced", F.lit(0.0))), ["store", "branch"])


def _review_cells(spark, sf_dir):
    """The second source's claims: those with a place; the first's: the others."""
    valid = ev.valid_claims(load(spark, sf_dir, "claims"), S)
    both = [ev.branch_cells(ev.weigh(ev.prepare(valid.where(cond), S), S)) for cond in ("coalesce(gmap_id, '') = ''", "coalesce(gmap_id, '') <> ''")]
    return [materialise(ev.chain_cells(c), "cells") for c in both]


def ml_combine_category(spark, sf_dir):
    """Two claim-based sources, full outer by (store, category), calibrated at store level."""
    first, second = _review_cells(spark, sf_dir)
    fit = materialise(cal.claim_calibration(ev.store_totals(first), ev.store_totals(second), S), "calibration")
    return cal.combine_claims(first, second, ["store", "category"], fit, S)


def join_cross_gap(spark, sf_dir):
    """Per store both sources' numbers and their gap; thin ratings left out."""
    totals, stores = _totals(spark, sf_dir), rt.summarise(_reviews(spark, sf_dir), ["store"], S)
    sentiment = scoring.shrunk(F.col("score"), F.col("valenced"), S)
    rows = totals.select("store", sentiment.alias("s")).join(stores.where("not thin"), "store")
    return rows.select("store", F.round("s", 4).alias("first"), F.col("norm").alias("second"), F.round(F.col("norm") - F.col("s"), 4).alias("gap"))


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("src", "agg", "mth", "join", "win", "str", "flt", "top", "ml") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

# --- SQL ---
_REVIEWS = """rev AS (SELECT store, gmap_id, rating, CASE WHEN time >= 100000000000000 THEN time // 1000 WHEN time < 100000000000 THEN time * 1000 ELSE time END AS time,
    coalesce(text_len, 0) AS text_len FROM reviews WHERE rating BETWEEN 1 AND 5 AND time IS NOT NULL)"""
_WEIGHT = "pow(0.5::DOUBLE, greatest((1770000000 - time // 1000) / 31557600.0::DOUBLE, 0.0::DOUBLE) / 4.0::DOUBLE)"
_MONTH = "strftime(to_timestamp(time // 1000) AT TIME ZONE 'UTC', '%Y-%m')"


def _rating(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    where = f"WHERE {keys} IS NOT NULL" if keys else ""
    return f"""(SELECT {k}n, round(m, 4) AS mean, round((m - 3) / 2, 4) AS norm, round(ne, 4) AS n_eff, round(mr, 4) AS mean_recent, round((mr - 3) / 2, 4) AS norm_recent, n_long,
        round(ml, 4) AS mean_long, round((ml - 3) / 2, 4) AS norm_long, n < 20 AS thin, first_month, last_month, median_month FROM
        (SELECT {k}count(*) AS n, sum(rating) / count(*) AS m, sum(w) AS ne, sum(w * rating) / sum(w) AS mr, count(*) FILTER (text_len >= 120) AS n_long,
            sum(rating) FILTER (text_len >= 120) / nullif(count(*) FILTER (text_len >= 120), 0) AS ml, min(mon) AS first_month, max(mon) AS last_month,
            list_extract(list(mon ORDER BY time), count(*) // 2 + 1) AS median_month
         FROM (SELECT *, {_WEIGHT} AS w, {_MONTH} AS mon FROM rev) {where} GROUP BY ALL))"""


_PINS = """pins AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY osm ORDER BY place_id DESC) AS rn FROM places WHERE osm IS NOT NULL AND store IS NOT NULL
    AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)) WHERE rn = 1)"""
_METRES = "2 * 6371000.0 * asin(sqrt(pow(sin(radians(p.lat - b.latitude) / 2), 2) + cos(radians(b.latitude)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - b.longitude) / 2), 2)))"
_EDGES = f"edges AS (SELECT * FROM (SELECT b.store, gmap_id, osm, {_METRES} AS metres FROM businesses b JOIN pins p ON p.store = b.store) WHERE metres <= 3000)"
_LINKED = """linked AS (SELECT k.g AS gmap_id, k.o AS osm FROM (SELECT unnest(list_reduce(list_transform(list({g: gmap_id, o: osm} ORDER BY metres, gmap_id, osm), lambda e: [e]),
    lambda acc, e: CASE WHEN len(list_filter(acc, lambda a: a.g = e[1].g OR a.o = e[1].o)) > 0 THEN acc ELSE list_concat(acc, e) END)) AS k FROM edges GROUP BY store))"""
_BRANCHES = f"branches AS (SELECT DISTINCT store, branch FROM (SELECT store, {base._branch('location', 'store')} AS branch FROM claims WHERE location IS NOT NULL AND store IS NOT NULL) WHERE branch <> '')"
_TOK = "list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda x: length(x) > 2))"
_ATTACHED = f"""pt AS (SELECT osm, store, {_TOK.format(x="coalesce(city, '')")} AS town, {_TOK.format(x="concat_ws(' ', city, address)")} AS hay FROM pins),
    towns AS (SELECT list_distinct(flatten(list(town))) AS t FROM pt), bt AS (SELECT store, branch, {_TOK.format(x='branch')} AS wanted FROM branches),
    attached AS (SELECT osm, store, branch FROM (SELECT pt.osm, pt.store, branch, row_number() OVER (PARTITION BY osm ORDER BY length(branch) DESC, branch) AS rn
        FROM pt JOIN bt ON pt.store = bt.store, towns WHERE len(wanted) > 0 AND CASE WHEN list_has_all(towns.t, wanted) THEN list_has_all(town, wanted) ELSE list_has_all(hay, wanted) END) WHERE rn = 1)"""
_POOL = f"""pool AS (SELECT store, branch, sum(n) AS n, CASE WHEN sum(n_eff) = 0 THEN 1 ELSE sum(n_eff) END AS n_eff, sum(norm_recent * n_eff) / CASE WHEN sum(n_eff) = 0 THEN 1 ELSE sum(n_eff) END AS norm_recent
    FROM attached JOIN linked USING (osm) JOIN {_rating('gmap_id')} r USING (gmap_id) GROUP BY ALL)"""
# the one pattern with a look-ahead, which the SQL engine lacks, is taken apart
_HITS = "list_filter([" + ", ".join(
    (f"CASE WHEN regexp_matches(nm, '\\bbj''?s\\b') AND NOT regexp_matches(nm, '\\bbj''?s\\b\\s*(restaurant|brewhouse)') THEN 'BJ''s' END" if name == "BJ's"
     else f"CASE WHEN regexp_matches(nm, '{p.replace(chr(39), chr(39) * 2)}') THEN '{name.replace(chr(39), chr(39) * 2)}' END")
    for name, p in vocab.STORE_PATTERNS.items()
) + "], lambda x: x IS NOT NULL)"
_NAMED = f"named AS (SELECT *, {_HITS} AS hits FROM (SELECT *, replace(replace(lower(name), '’', ''''), 'ʼ', '''') AS nm FROM businesses))"
_T = "tot AS " + base.TOTALS
_BT = "btot AS " + base.BRANCH_TOTALS
_ST = f"st AS {_rating('store')}"
_PAIRS = """prs AS (SELECT store AS id, norm_recent AS x, CASE WHEN valenced > 0 THEN score / valenced ELSE 0.0 END AS y, valenced AS w FROM tot JOIN st USING (store) WHERE NOT thin)"""


def _line(source: str, keys: str = "") -> str:
    k, g = (f"{keys}, ", f"USING ({keys})") if keys else ("", "ON true")
    return f"""(SELECT {k}CASE WHEN sw <= 0 THEN 0.0 ELSE my - slope * mx END AS intercept, slope, n FROM (SELECT {k}n, sw, mx, my, CASE WHEN sw <= 0 OR sxx = 0 THEN 0.0 ELSE sxy / sxx END AS slope
        FROM (SELECT {k}n, sw, mx, my, sum(w * (x - mx) * (x - mx)) AS sxx, sum(w * (x - mx) * (y - my)) AS sxy FROM {source} JOIN
            (SELECT {k}count(*) AS n, sum(w) AS sw, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM {source} GROUP BY ALL) m {g} GROUP BY ALL)))"""


_FIT = f"""line AS {_line('prs')}, rest AS (SELECT a.id AS out, b.x, b.y, b.w FROM prs a JOIN prs b ON a.id <> b.id), ok AS (SELECT out FROM rest GROUP BY out HAVING sum(w) > 0 AND max(x) <> min(x)),
    loo AS (SELECT p.id, w, y - (f.intercept + f.slope * x) AS error FROM prs p JOIN {_line('rest', 'out')} f ON f.out = p.id JOIN ok ON ok.out = p.id),
    fit AS (SELECT intercept, slope, (SELECT sqrt(sum(w * error * error) / sum(w)) FROM loo) AS residual_sd, n AS n_stores,
        (SELECT 1 - sum(w * pow(y - (line.intercept + line.slope * x), 2)) / sum(w * pow(y - wm, 2)) FROM prs, (SELECT sum(w * y) / sum(w) AS wm FROM prs)) AS r2 FROM line)"""
_CLAIMS_STARS = base.BASE + f", {_REVIEWS}, {_T}, {_ST}, {_PAIRS}, {_FIT}"


def _combine(keys: str, source: str, v1: str, var1: str, v2: str, var2: str) -> str:
    return f"""SELECT {keys}, round((coalesce(v1 * p1, 0) + coalesce(v2 * p2, 0)) / (p1 + p2) * (p1 + p2) / (p1 + p2 + 2), 4) AS v, round(sqrt(1 / (p1 + p2 + 2)), 4) AS se,
        round(p1 / (p1 + p2), 4) AS share, round(coalesce(v2 - v1, 0.0), 4) + 0.0 AS gap, coalesce(abs(v2 - v1) > 2.0 * sqrt(s1 + s2), false) AS conflict, round(v1, 4) AS r, round(v2, 4) AS g
        FROM (SELECT *, CASE WHEN v1 IS NULL THEN 0.0 ELSE 1 / s1 END AS p1, CASE WHEN v2 IS NULL THEN 0.0 ELSE 1 / s2 END AS p2
            FROM (SELECT *, {v1} AS v1, {var1} AS s1, {v2} AS v2, {var2} AS s2 FROM {source})) WHERE v1 IS NOT NULL OR v2 IS NOT NULL"""


_APPLY = "greatest(-1.0, least(1.0, intercept + slope * {x}))"
_STARS = (
    "CASE WHEN valenced > 0 THEN score / valenced END", "1 / greatest(valenced, 1e-9)", f"CASE WHEN n_eff >= 20 THEN {_APPLY.format(x='norm_recent')} END",
    "pow(slope * 0.6 / sqrt(greatest(n_eff, 1.0)), 2) + residual_sd * residual_sd",
)


def _side(where: str, tag: str) -> str:
    """The claims pipeline again, for the part of the claims that `where` keeps."""
    text = base.BASE.removeprefix("WITH ").replace("FROM claims\n    WHERE store IS NOT NULL", f"FROM claims\n    WHERE {where} AND store IS NOT NULL")
    return f"{tag} AS (WITH {text} SELECT * FROM {base.CHAIN_CELLS})"


_TWO = "WITH " + _side("coalesce(gmap_id, '') = ''", "c1") + ", " + _side("coalesce(gmap_id, '') <> ''", "c2")
_SUM = "SELECT store, sum(n) AS n, sum(score) AS score, sum(valenced) AS valenced FROM {c} WHERE category NOT IN ('labor_ethics', 'store_lifecycle') GROUP BY store HAVING sum(valenced) > 0"
_CATEGORY = f"""{_TWO}, prs AS (SELECT a.store AS id, b.score / b.valenced AS x, a.score / a.valenced AS y, a.valenced AS w FROM ({_SUM.format(c='c1')}) a JOIN ({_SUM.format(c='c2')}) b USING (store) WHERE a.n >= 30 AND b.n >= 30), {_FIT}
    """ + _combine(
    "store, category",
    "(SELECT coalesce(c1.store, c2.store) AS store, coalesce(c1.category, c2.category) AS category, c1.score AS sc1, c1.valenced AS w1, c2.score AS sc2, c2.valenced AS w2, fit.* FROM c1 FULL JOIN c2 ON c1.store = c2.store AND c1.category = c2.category, fit)",
    "CASE WHEN w1 > 0 THEN sc1 / w1 END", "1 / greatest(w1, 1e-9)", f"CASE WHEN w2 > 0 THEN {_APPLY.format(x='(sc2 / w2)')} END", "slope * slope / greatest(w2, 1e-9) + residual_sd * residual_sd",
)
_REFIT = f"""meas AS (SELECT count(*) AS k, sum(valenced) AS sw, sum(valenced * pow(score / valenced - {_APPLY.format(x='norm_recent')}, 2)) AS se2 FROM pool JOIN btot USING (store, branch), fit WHERE valenced > 0),
    refit AS (SELECT intercept, slope, CASE WHEN k >= 10 AND sw > 0 THEN greatest(sqrt(se2 / sw), residual_sd) ELSE residual_sd END AS residual_sd FROM fit, meas)"""

ORACLES = {
    "src_reviews": f"WITH {_REVIEWS} SELECT store, count(*) AS n, sum(rating) AS stars, max(time) AS last_ms FROM rev GROUP BY store",
    "agg_rating_store": f"WITH {_REVIEWS} SELECT * FROM {_rating('store')}",
    "agg_rating_place": f"WITH {_REVIEWS} SELECT * FROM {_rating('gmap_id')}",
    "agg_rating_block": f"WITH {_REVIEWS} SELECT n, first_month, last_month, median_month, (SELECT count(DISTINCT gmap_id) FROM rev) AS n_locations FROM {_rating('')}",
    "mth_star_scale": f"WITH {_REVIEWS} SELECT DISTINCT rating, round((rating - 3) / 2, 3) AS norm FROM rev",
    "join_geo": f"WITH {_PINS}, {_EDGES} SELECT gmap_id, osm, round(metres, 2) AS metres FROM edges",
    "join_one_to_one": f"WITH {_PINS}, {_EDGES}, {_LINKED} SELECT gmap_id, osm FROM linked",
    "join_map_rating": f"WITH {_PINS}, {_EDGES}, {_LINKED}, {_REVIEWS} SELECT osm, n, norm FROM linked JOIN {_rating('gmap_id')} r USING (gmap_id)",
    "win_last_pin": f"WITH {_PINS} SELECT osm, place_id FROM pins",
    "str_match_store": f"WITH {_NAMED} SELECT gmap_id, CASE WHEN len(hits) = 1 THEN hits[1] END AS matched FROM named",
    "flt_food_shop": f"""WITH {_NAMED} SELECT gmap_id FROM named WHERE len(hits) = 1 AND latitude BETWEEN {BOX[0]} AND {BOX[2]} AND longitude BETWEEN {BOX[1]} AND {BOX[3]}
        AND (category[1] IN ({', '.join("'" + c.replace("'", "''") + "'" for c in vocab.SHOP_CATEGORIES)}) OR regexp_matches(category[1], '{vocab.SHOP_SUFFIX}'))""",
    "agg_places_by_store": "SELECT store, count(*) AS n FROM places WHERE store IS NOT NULL GROUP BY store",
    "top_places": f"WITH {_PINS} SELECT osm, store FROM pins ORDER BY store, city NULLS FIRST, address NULLS FIRST, osm LIMIT 50",
    "join_branch": f"WITH {_PINS}, {_BRANCHES}, {_ATTACHED} SELECT osm, branch FROM attached",
    "agg_pooled_branch": f"WITH {_PINS}, {_EDGES}, {_LINKED}, {_REVIEWS}, {_BRANCHES}, {_ATTACHED}, {_POOL} SELECT store, branch, cast(n AS BIGINT) AS n, round(n_eff, 4) AS n_eff, round(norm_recent, 4) AS norm_recent FROM pool",
    "ml_line": _CLAIMS_STARS + " SELECT round(intercept, 4) AS intercept, round(slope, 4) AS slope, n FROM line",
    "ml_leave_one_out": _CLAIMS_STARS + " SELECT id, round(error, 4) AS error FROM loo",
    "ml_calibration": _CLAIMS_STARS + " SELECT n_stores, round(intercept, 4) AS intercept, round(slope, 4) AS slope, round(residual_sd, 4) AS residual_sd, round(r2, 4) AS r2 FROM fit",
    "ml_combine_store": _CLAIMS_STARS + _combine("store", "(SELECT store, score, valenced, st.n_eff, norm_recent, fit.* FROM tot LEFT JOIN st USING (store), fit)", *_STARS),
    "ml_combine_branch": _CLAIMS_STARS + f", {_PINS}, {_EDGES}, {_LINKED}, {_BRANCHES}, {_ATTACHED}, {_POOL}, {_BT}, {_REFIT}" + _combine("store, branch", "(SELECT coalesce(b.store, p.store) AS store, coalesce(b.branch, p.branch) AS branch, score, coalesce(valenced, 0) AS valenced, n_eff, norm_recent, refit.* FROM btot b FULL JOIN pool p ON b.store = p.store AND b.branch = p.branch, refit)", *_STARS),
    "ml_combine_category": _CATEGORY,
    "join_cross_gap": _CLAIMS_STARS + " SELECT store, round(CASE WHEN valenced = 0 THEN 0 ELSE score / (valenced + 2) END, 4) AS first, norm AS second, round(norm - CASE WHEN valenced = 0 THEN 0 ELSE score / (valenced + 2) END, 4) AS gap FROM tot JOIN st USING (store) WHERE NOT thin",
}
