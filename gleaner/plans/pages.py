"""Queries that assemble what is published, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.operators import evidence as ev
from gleaner.operators import publish as pb
from gleaner.operators import ratings as rt
from gleaner.operators import selection as sel
from gleaner.operators.places import attach_branches
from gleaner.plans import evidence as base
from gleaner.plans import ratings as rated
from gleaner.runtime import load, materialise

S = Settings()


def jsn_slim_cells(spark, sf_dir):
    cells = pb.slim_cells(ev.chain_cells(ev.branch_cells(base._weighed(spark, sf_dir))), ["store", "category"], S)
    return cells.select("store", "category", "n", "p", F.size(F.map_keys(F.coalesce("pd", F.create_map().cast("map<string,bigint>")))).alias("signals"))


def jsn_quotes(spark, sf_dir):
    q = pb.quotes(base._weighed(spark, sf_dir), ["store", "category"], 3)
    return q.select("store", "category", F.size("e").alias("n"), F.array_join(F.transform("e", lambda x: x["d"]), ",").alias("months"), F.array_join(F.transform("e", lambda x: F.coalesce(x["t"], F.lit(""))), "|").alias("texts"))


def jsn_store_documents(spark, sf_dir):
    weighed = materialise(base._weighed(spark, sf_dir), "weighed")
    docs = pb.store_documents(pb.slim_cells(ev.chain_cells(ev.branch_cells(weighed)), ["store", "category"], S), pb.quotes(weighed, ["store", "category"], 3))
    return docs.select("store", F.size(F.map_keys(F.from_json("body", "map<string,struct<n:bigint>>"))).alias("categories"))


def flt_published_places(spark, sf_dir):
    stores = ev.valid_claims(load(spark, sf_dir, "claims"), S)
    return pb.published_places(rt.pins(load(spark, sf_dir, "places")), stores).select("osm")


def _placed(spark, sf_dir):
    """Second-source claims put where their document is a review of: its place's branch, by name composition."""
    claims = load(spark, sf_dir, "claims").where("coalesce(gmap_id, '') <> '' and source_id is not null")
    shops = load(spark, sf_dir, "businesses").select(F.col("gmap_id").alias("place"), F.col("store").alias("reviewed"))
    documents = claims.groupBy("source_id").agg(F.min("gmap_id").alias("place")).join(shops, "place")
    linked = rt.match_one_to_one(rated._edges(spark, sf_dir)).select("gmap_id", "osm")
    names = attach_branches(rt.pins(load(spark, sf_dir, "places")), rated._branch_names(spark, sf_dir))
    branches = linked.join(names, "osm").select(F.col("gmap_id").alias("place"), "branch")
    return sel.attach_place(claims, documents, branches)


def join_placed_claims(spark, sf_dir):
    return _placed(spark, sf_dir).select("claim_row", "location", "gmap_id", "foreign")


def agg_placement(spark, sf_dir):
    return pb.placement(_placed(spark, sf_dir))


def agg_mean_gap(spark, sf_dir):
    return rated.join_cross_gap(spark, sf_dir).agg(F.round(F.avg("gap"), 3).alias("mean_gap"), F.count(F.lit(1)).alias("n"))


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("jsn", "flt", "join", "agg") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

_TOP = "tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, category ORDER BY w DESC, claim_row) AS place FROM weighed) WHERE place <= 3)"
_PLACED = f"""{rated._PINS}, {rated._EDGES}, {rated._LINKED}, {rated._BRANCHES}, {rated._ATTACHED}, rc AS (SELECT * FROM claims WHERE coalesce(gmap_id, '') <> '' AND source_id IS NOT NULL),
    dc AS (SELECT source_id, min(rc.gmap_id) AS place FROM rc GROUP BY source_id), dr AS (SELECT source_id, place, b.store AS reviewed FROM dc JOIN businesses b ON b.gmap_id = place),
    placed AS (SELECT rc.claim_row, rc.store IS DISTINCT FROM dr.reviewed AS "foreign", CASE WHEN rc.store IS DISTINCT FROM dr.reviewed THEN '' ELSE coalesce(a.branch, '') END AS location,
        CASE WHEN rc.store IS DISTINCT FROM dr.reviewed THEN '' ELSE coalesce(dr.place, '') END AS gmap_id
        FROM rc LEFT JOIN dr USING (source_id) LEFT JOIN linked l ON l.gmap_id = dr.place LEFT JOIN attached a ON a.osm = l.osm)"""

ORACLES = {
    "jsn_slim_cells": base.BASE + f" SELECT store, category, n_claims AS n, price_signal AS p, cast((n_cheap > 0)::INT + (n_fair > 0)::INT + (n_expensive > 0)::INT AS INTEGER) AS signals FROM ({base.cell_view('store, category', base.CHAIN_CELLS)})",
    "jsn_quotes": base.BASE + f", {_TOP} SELECT store, category, cast(count(*) AS INTEGER) AS n, string_agg(strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m'), ',' ORDER BY place) AS months, string_agg(claim, '|' ORDER BY place) AS texts FROM tp GROUP BY ALL",
    "jsn_store_documents": base.BASE + " SELECT store, cast(count(DISTINCT category) AS INTEGER) AS categories FROM weighed GROUP BY store",
    "flt_published_places": f"WITH {rated._PINS}, {base._VALID} SELECT osm FROM pins WHERE store IN (SELECT store FROM valid)",
    "join_placed_claims": f"WITH {_PLACED} SELECT claim_row, location, gmap_id, \"foreign\" FROM placed",
    "agg_placement": f"WITH {_PLACED} SELECT count(*) AS n, count(*) FILTER (NOT \"foreign\" AND location <> '') AS placed, count(*) FILTER (\"foreign\") AS \"foreign\", round(count(*) FILTER (NOT \"foreign\" AND location <> '') / count(*), 4) AS part FROM placed",
    "agg_mean_gap": f"SELECT round(avg(gap), 3) AS mean_gap, count(*) AS n FROM ({rated.ORACLES['join_cross_gap']})",
}
