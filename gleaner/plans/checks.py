"""Queries that validate, resume, evaluate and assert, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import sql as functions
from gleaner.operators import evaluation as evl
from gleaner.operators import extraction as ex
from gleaner.operators import validation as val
from gleaner.plans.texts import _docs
from gleaner.operators.selection import document_key
from gleaner.runtime import load, scratch_path
from gleaner.sources import jsonl, windows

S = Settings()
EXPECTED = [("a", 0, "Aldi", "produce", "positive", "cheap"), ("a", 1, "Aldi", "dairy", "negative", "none"), ("b", 0, "Costco", "meat", "positive", "fair")]
GOT = [("a", 0, "Aldi", "produce", "positive", "cheap"), ("b", 0, "Costco", "meat", "positive", "none"), ("c", 0, "Target", "bakery", "mixed", "none"), ("a", 1, "Aldi", "frozen", "neutral", "none")]


def val_json_claims(spark, sf_dir):
    """Claims as JSON lines, some of them broken on the way, held against the row rules."""
    rows = load(spark, sf_dir, "claims")
    text = F.to_json(F.struct("store", "category", "claim", "sentiment", "confidence", "source_key", "permalink", "created_utc", "score", "transient", "location", "author"), {"ignoreNullFields": "false"})
    broken = (
        F.when(F.col("claim_row") % 11 == 1, F.regexp_replace(text, r'"created_utc":(\d+)', '"created_utc":"$1"'))
        .when(F.col("claim_row") % 11 == 2, F.regexp_replace(text, r'"transient":(true|false|null)', '"transient":1'))
        .when(F.col("claim_row") % 11 == 3, F.substring(text, 1, 40))
        .otherwise(text)
    )
    return rows.select("claim_row", val.claim_ok(F.try_parse_json(broken), S).alias("ok"))


def val_json_candidates(spark, sf_dir):
    rows = load(spark, sf_dir, "candidates")
    fields = ("id", "subreddit", "kind", "created_utc", "score", "author", "parent_body", "permalink", "stores", "text", "truncated")
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    broken = F.when(F.col("delivery_id") % 13 == 1, F.regexp_replace(text, r'"stores":\[[^\]]*\]', '"stores":"none"')).otherwise(text)
    return rows.select("delivery_id", val.candidate_ok(F.try_parse_json(broken)).alias("ok"))


def val_public_links(spark, sf_dir):
    return load(spark, sf_dir, "claims").groupBy(val.is_public_link(F.col("permalink")).alias("public")).agg(F.count(F.lit(1)).alias("n"))


def val_unfit(spark, sf_dir):
    return val.unfit_rows(load(spark, sf_dir, "places").select("lat", "lon"))


def src_month_windows(spark, sf_dir):
    return windows.month_windows(spark, 1_230_768_000, 1_770_000_000)


def join_missing_windows(spark, sf_dir):
    months = load(spark, sf_dir, "claims").select(F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM").alias("label"))
    return windows.missing_windows(windows.month_windows(spark, 1_230_768_000, 1_770_000_000), months, ["label"]).select("label")


def agg_coverage(spark, sf_dir):
    fetched = load(spark, sf_dir, "candidates").where("id is not null").select("kind", "id")
    reported = load(spark, sf_dir, "candidates").groupBy("kind").agg(F.count(F.lit(1)).alias("reported"))
    return windows.coverage(fetched, reported, ["kind"])


def join_pending(spark, sf_dir):
    """Documents that no claim came from yet."""
    docs = _docs(spark, sf_dir).where("id is not null")
    done = load(spark, sf_dir, "claims").select(F.col("source_key").alias("key")).distinct()
    return ex.pending(docs, done).select("delivery_id")


def top_sample(spark, sf_dir):
    docs = _docs(spark, sf_dir).where("id is not null").withColumn("key", document_key(F.col("kind"), F.col("subreddit"), F.col("id")))
    return ex.sample(docs.dropDuplicates(["key"]), 50, seed=3).select("key")


def _by_delivery(spark, sf_dir):
    """Deliveries as documents of their own, however often a message came."""
    rows = load(spark, sf_dir, "candidates").where("text is not null and id is not null and stores is not null")
    return rows.select(F.col("delivery_id").cast("string").alias("id"), "kind", "subreddit", "text", "parent_body", "stores", "permalink", "author", "created_utc", "score")


def udf_extract(spark, sf_dir):
    docs = _by_delivery(spark, sf_dir)
    claims = ex.claims_of(ex.extract(docs, ex.WordProvider()), docs)
    return claims.groupBy("store", "category", "sentiment", "price_signal", "confidence").agg(F.count(F.lit(1)).alias("n"))


def _as_lines(df, spark, tag):
    """df written to the shared folder as JSON lines, as the readers get them; returns the folder."""
    path = scratch_path(spark, tag)
    df.write.option("ignoreNullFields", "false").json(path)
    return path


def src_json_claims(spark, sf_dir):
    """Claims through files of JSON lines and the reader that checks them."""
    rows = load(spark, sf_dir, "claims").select(*[c.split()[0] for c in jsonl.CLAIM.split(", ")])
    claims, _ = jsonl.read_claims(spark, _as_lines(rows, spark, "claims"), S)
    return claims.groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.min("created_utc").alias("first"))


def src_json_dropped(spark, sf_dir):
    rows = load(spark, sf_dir, "claims").select(*[c.split()[0] for c in jsonl.CLAIM.split(", ")])
    return jsonl.read_claims(spark, _as_lines(rows, spark, "claims"), S)[1]


def src_json_candidates(spark, sf_dir):
    rows = load(spark, sf_dir, "candidates").select(*[c.split()[0] for c in jsonl.CANDIDATE.split(", ")])
    kept, _ = jsonl.read_candidates(spark, _as_lines(rows, spark, "candidates"))
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("stores")).alias("stores"))


def src_json_reviews(spark, sf_dir):
    rows = jsonl.read_reviews(spark, _as_lines(load(spark, sf_dir, "reviews"), spark, "reviews"))
    return rows.groupBy("store").agg(F.count(F.lit(1)).alias("n"), F.sum("text_len").alias("chars"))


def src_review_texts(spark, sf_dir):
    rows = jsonl.read_review_texts(spark, _as_lines(load(spark, sf_dir, "reviews"), spark, "reviews"))
    return rows.groupBy("gmap_id").agg(F.count(F.lit(1)).alias("n"), F.count("text").alias("texts"), F.count_distinct("user_id").alias("writers"))


def src_receipt_history(spark, sf_dir):
    """Orders as kept receipts, one JSON list for each customer; some are no lists, some receipts have no lines."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.unix_timestamp("o_orderdate").alias("at"))
    line = F.struct(F.concat(F.lit("part "), F.col("l_partkey")).alias("name"), F.col("l_quantity").cast("int").alias("qty"), F.col("l_extendedprice").cast("double").alias("price"))
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    receipts = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    receipt = F.struct("at", F.lit("Aldi").alias("store"), F.when(F.col("o_orderkey") % 7 != 0, F.col("lines")).alias("lines"))
    texts = receipts.groupBy("o_custkey").agg(F.to_json(F.collect_list(receipt)).alias("t")).select(F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit('{"x":'), F.col("t"), F.lit("}"))).otherwise(F.col("t")).alias("t"))
    return jsonl.read_history(texts, "t").groupBy("name").agg(F.sum("qty").alias("units"), F.count(F.lit(1)).alias("n"))


def agg_usage(spark, sf_dir):
    used = ex.extract(_by_delivery(spark, sf_dir), ex.WordProvider())
    return used.agg(F.sum("tokens_out").alias("tokens_out"), ex.cache_hit_rate().alias("cache_hit_rate"), F.round(ex.cost((0.0, 15.0, 0.3, 3.75)), 6).alias("cost"))


def agg_gold(spark, sf_dir):
    schema = "case string, ord int, store string, category string, sentiment string, price_signal string"
    cases = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "case string")
    return evl.score(evl.compare(cases, spark.createDataFrame(EXPECTED, schema), spark.createDataFrame(GOT, schema)))


def udf_sql_functions(spark, sf_dir):
    functions.register(spark)
    load(spark, sf_dir, "reviews").createOrReplaceTempView("gleaner_reviews")
    return spark.sql("SELECT store, count(*) AS n, round(avg(star_scale(rating)), 4) AS norm FROM gleaner_reviews WHERE rating BETWEEN 1 AND 5 GROUP BY store")


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("val", "src", "join", "agg", "top", "udf") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

_VALUES = lambda rows: "(VALUES " + ", ".join(str(r) for r in rows) + ") AS x(c, ord, store, category, sentiment, price_signal)"
_list = lambda words: "[" + ", ".join("'" + w + "'" for w in sorted(words)) + "]"
_CLAIM_OK = "transient IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in val.CLAIM_TEXT) + " AND created_utc BETWEEN 1100000000 AND 1801557600"
_WS = r"[\s\v\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_FIELDS = ("store", "category", "claim", "sentiment", "confidence", "source_key", "permalink", "created_utc")

ORACLES = {
    "val_json_claims": "SELECT claim_row, claim_row % 11 NOT IN (1, 2, 3) AND transient IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in _FIELDS) + " AND created_utc BETWEEN 1100000000 AND 1801557600 AS ok FROM claims",
    "val_json_candidates": "SELECT delivery_id, delivery_id % 13 <> 1 AND stores IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in ("created_utc", *val.CANDIDATE_TEXT)) + " AS ok FROM candidates",
    "val_public_links": "SELECT coalesce(regexp_matches(permalink, '^/r/[A-Za-z0-9_]+/'), false) AS public, count(*) AS n FROM claims GROUP BY 1",
    "val_unfit": "SELECT count(*) FILTER (isnan(lat) OR isinf(lat) OR isnan(lon) OR isinf(lon)) AS n_unfit FROM places",
    "src_month_windows": "SELECT strftime(m, '%Y-%m') AS label, cast(epoch(m) AS BIGINT) AS first, cast(epoch(m + INTERVAL 1 MONTH) AS BIGINT) - 1 AS last FROM (SELECT unnest(generate_series(TIMESTAMP '2009-01-01', TIMESTAMP '2026-02-01', INTERVAL 1 MONTH)) AS m)",
    "join_missing_windows": "SELECT strftime(m, '%Y-%m') AS label FROM (SELECT unnest(generate_series(TIMESTAMP '2009-01-01', TIMESTAMP '2026-02-01', INTERVAL 1 MONTH)) AS m) WHERE strftime(m, '%Y-%m') NOT IN (SELECT strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m') FROM claims)",
    "agg_coverage": "SELECT kind, count(id) AS fetched, count(id) - count(DISTINCT id) AS duplicates, count(*) AS reported, round(count(id) / count(*), 4) AS covered, count(id) / count(*) >= 0.95 AS enough FROM candidates GROUP BY kind",
    "join_pending": "SELECT delivery_id FROM candidates WHERE text IS NOT NULL AND id IS NOT NULL AND substr(kind, 1, 1) || '_' || subreddit || '_' || id NOT IN (SELECT source_key FROM claims WHERE source_key IS NOT NULL)",
    "top_sample": "SELECT key FROM (SELECT DISTINCT substr(kind, 1, 1) || '_' || subreddit || '_' || id AS key FROM candidates WHERE text IS NOT NULL AND id IS NOT NULL AND kind IS NOT NULL AND subreddit IS NOT NULL) ORDER BY sha256(key || ':3'), key LIMIT 50",
    "udf_extract": f"""WITH d AS (SELECT unnest(stores) AS store, regexp_extract_all(lower(text), '[a-z]+') AS w FROM candidates WHERE text IS NOT NULL AND id IS NOT NULL AND stores IS NOT NULL),
        s AS (SELECT store, w, len(list_filter(w, lambda x: list_contains({_list(ex.WordProvider.good)}, x))) - len(list_filter(w, lambda x: list_contains({_list(ex.WordProvider.bad)}, x))) AS score FROM d)
        SELECT store, CASE {" ".join(f"WHEN list_has_any(w, {_list(ws)}) THEN '{c}'" for c, ws in vocab.LIST_WORDS.items())} ELSE 'quality_overall' END AS category,
            CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment,
            CASE WHEN list_contains(w, 'cheap') THEN 'cheap' WHEN list_has_any(w, ['expensive', 'overpriced']) THEN 'expensive' ELSE 'none' END AS price_signal,
            CASE WHEN abs(score) > 1 THEN 'high' WHEN score <> 0 THEN 'medium' ELSE 'low' END AS confidence, count(*) AS n FROM s GROUP BY ALL""",
    "src_json_claims": f"SELECT store, count(*) AS n, min(created_utc) AS first FROM claims WHERE {_CLAIM_OK} GROUP BY store",
    "src_json_dropped": f"SELECT count(*) FILTER (NOT ({_CLAIM_OK})) AS n_dropped FROM claims",
    "src_json_candidates": "SELECT kind, count(*) AS n, cast(sum(len(stores)) AS BIGINT) AS stores FROM candidates WHERE stores IS NOT NULL AND " + " AND ".join(f"{f} IS NOT NULL" for f in ("created_utc", "truncated", *val.CANDIDATE_TEXT)) + " GROUP BY kind",
    "src_json_reviews": rf"SELECT store, count(*) AS n, cast(sum(length(regexp_replace(coalesce(text, ''), '^{_WS}+|{_WS}+$', '', 'g'))) AS BIGINT) AS chars FROM reviews WHERE rating IS NOT NULL AND time IS NOT NULL GROUP BY store",
    "src_review_texts": "SELECT gmap_id, count(*) AS n, count(text) AS texts, count(DISTINCT user_id) AS writers FROM reviews WHERE gmap_id IS NOT NULL GROUP BY gmap_id",
    "src_receipt_history": "SELECT 'part ' || l_partkey AS name, cast(sum(cast(l_quantity AS INTEGER)) AS BIGINT) AS units, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 7 <> 0 AND o_custkey % 5 <> 0 GROUP BY 1",
    "agg_usage": "SELECT cast(sum(20 * len(stores)) AS BIGINT) AS tokens_out, 0.0::DOUBLE AS cache_hit_rate, round(sum(20 * len(stores)) * 15.0 / 1e6, 6)::DOUBLE AS cost FROM candidates WHERE text IS NOT NULL AND id IS NOT NULL AND stores IS NOT NULL",
    "agg_gold": f"""WITH e AS (SELECT * FROM {_VALUES(EXPECTED)}), g AS (SELECT * FROM {_VALUES(GOT)}),
        b AS (SELECT coalesce(e.c, g.c) AS c, e.c IS NOT NULL AS ie, g.c IS NOT NULL AS ig, e.price_signal IS NOT DISTINCT FROM g.price_signal AS same FROM e FULL JOIN g USING (c, store, category, sentiment)),
        k AS (SELECT x.c, count(*) FILTER (ie AND ig) AS m, count(*) FILTER (ie AND NOT ig) AS mi, count(*) FILTER (ig AND NOT ie) AS sp, count(*) FILTER (ie AND ig AND NOT same) AS fl
            FROM (VALUES ('a'), ('b'), ('c'), ('d')) AS x(c) LEFT JOIN b ON b.c = x.c GROUP BY x.c),
        s AS (SELECT sum(m) AS tp, sum(mi) AS fn, sum(sp) AS fp, sum(fl) AS fl, count(*) AS n, count(*) FILTER (mi = 0 AND sp = 0) AS ex, count(*) FILTER (m + mi = 0) AS si, count(*) FILTER (m + mi = 0 AND sp = 0) AS ks FROM k)
        SELECT round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, round(ex / n, 4) AS exact_match, round(ks / si, 4) AS silence, round((tp - fl) / tp, 4) AS flag_accuracy FROM s""",
    "udf_sql_functions": "SELECT store, count(*) AS n, round(avg((rating - 3) / 2), 4) AS norm FROM reviews WHERE rating BETWEEN 1 AND 5 GROUP BY store",
}
