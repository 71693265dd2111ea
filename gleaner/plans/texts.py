"""Queries that select documents and read receipts, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions import receipts as rc
from gleaner.functions.text import worked_out
from gleaner.operators import places as pl
from gleaner.operators import selection as sel
from gleaner.runtime import load, spread

S = Settings()
TERMS = [w for words in vocab.LIST_WORDS.values() for w in words]


def _docs(spark, sf_dir) -> DataFrame:
    """Deliveries as raw documents; their own list of stores and their excerpt mark are made anew."""
    rows = load(spark, sf_dir, "candidates")
    return rows.where("text is not null").select("delivery_id", "id", "kind", "subreddit", "author", "parent_body", "text")


def flt_bot(spark, sf_dir):
    return load(spark, sf_dir, "candidates").where(~sel.is_bot(F.col("author"))).select("delivery_id")


def flt_evaluative(spark, sf_dir):
    return _docs(spark, sf_dir).select("delivery_id", sel.is_evaluative(F.col("text")).alias("judges"))


def flt_context(spark, sf_dir):
    return _docs(spark, sf_dir).select("delivery_id", sel.in_context(F.lower("text")).alias("in_context"))


def flt_may_mention(spark, sf_dir):
    rows = _docs(spark, sf_dir).where(~sel.may_mention(F.lower("text")))
    return rows.select(F.count(F.lit(1)).alias("n_without"), F.count_if(F.size(pl.store_hits(F.lower("text"), gated=False)) > 0).alias("n_missed"))


def str_matched_stores(spark, sf_dir):
    return _docs(spark, sf_dir).select("delivery_id", F.array_join(sel.matched_stores(F.col("text")), "|").alias("stores"))


def win_first_mention(spark, sf_dir):
    return _docs(spark, sf_dir).select("delivery_id", sel.first_mention(F.col("text"), sel.matched_stores(F.col("text"))).cast("bigint").alias("at"))


def str_excerpt(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").where("text is not null").withColumn("stores", sel.matched_stores(F.col("text")))
    body, cut = sel.excerpt(F.col("text"), F.col("stores"), S)
    return rows.where(F.size("stores") > 0).select("doc_id", F.md5(F.encode(body, "UTF-8")).alias("digest"), cut.alias("truncated"))


def str_document_key(spark, sf_dir):
    rows = load(spark, sf_dir, "candidates").where("id is not null")
    return rows.select("delivery_id", sel.document_key(F.col("kind"), F.col("subreddit"), F.col("id")).alias("key"))


def str_fence(spark, sf_dir):
    return _docs(spark, sf_dir).select("delivery_id", sel.fence(F.col("parent_body"), F.col("text")).alias("fence"))


def flt_qualify(spark, sf_dir):
    out = sel.qualify(_docs(spark, sf_dir), S)
    return out.select("delivery_id", F.array_join("stores", "|").alias("stores"), "truncated", F.length("parent_body").cast("bigint").alias("parent_chars"))


def set_text_dedup(spark, sf_dir):
    return sel.first_texts(_docs(spark, sf_dir), ["delivery_id"]).select("delivery_id")


def sel_candidates(spark, sf_dir):
    return sel.select_candidates(_docs(spark, sf_dir), ["delivery_id"], S).select("delivery_id")


def agg_selection_report(spark, sf_dir):
    return sel.store_report(sel.select_candidates(_docs(spark, sf_dir), ["delivery_id"], S))


def agg_census(spark, sf_dir):
    return sel.census(_docs(spark, sf_dir))


def agg_subreddits(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("subreddit").agg(F.count(F.lit(1)).alias("n"))


def join_review_candidates(spark, sf_dir):
    stores = load(spark, sf_dir, "businesses").where("store is not null")
    reviews = load(spark, sf_dir, "reviews").where("time is not null")
    return sel.review_candidates(reviews, stores, S).select("id", "created_utc", F.array_join("stores", "|").alias("stores"), F.length("text").cast("bigint").alias("chars"), "truncated")


def set_one_shape(spark, sf_dir):
    posts = load(spark, sf_dir, "candidates").where("text is not null").select("kind", "text")
    reviews = load(spark, sf_dir, "reviews").where("text is not null").select(F.lit("review").alias("kind"), "text")
    return posts.unionByName(reviews).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars"))


def agg_line_provenance(spark, sf_dir):
    return load(spark, sf_dir, "documents").where(F.trim(F.coalesce("text", F.lit(""))) != "").agg(F.count(F.lit(1)).alias("n"))


def agg_duplicate_ids(spark, sf_dir):
    rows = load(spark, sf_dir, "candidates").where("id is not null")
    return rows.groupBy("subreddit", "kind").agg((F.count("id") - F.countDistinct("id")).alias("duplicates"))


def _lines(spark, sf_dir) -> DataFrame:
    rows = spread(load(spark, sf_dir, "documents").select("doc_id", "text")).where("text is not null").select("doc_id", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
    return rows.withColumn("line", F.trim("line")).where(F.length("line") >= 3)


def rcp_noise(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("doc_id").agg(F.count_if(rc.is_noise(F.col("line"))).alias("noise"), F.count(F.lit(1)).alias("n"))


def rcp_price(spark, sf_dir):
    rows = worked_out(_lines(spark, sf_dir), price=rc.price(F.col("line"))).where("price is not null")
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "price", rc.quantity(F.col("line")).alias("qty"))


def rcp_expand(spark, sf_dir):
    rows = _lines(spark, sf_dir).where(rc.price(F.col("line")).isNotNull() & ~rc.is_noise(F.col("line")))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), rc.expand(F.col("line")).alias("item"))


def rcp_lines(spark, sf_dir):
    """Lines that count as bought: no noise, something left of them, and a price or a word of the list."""
    rows = worked_out(_lines(spark, sf_dir).where(~rc.is_noise(F.col("line"))), item=rc.expand(F.col("line")), price=rc.price(F.col("line")))
    kept = worked_out(rows, match=rc.match_term(F.col("item"), TERMS)).where((F.col("item") != "") & (F.col("price").isNotNull() | F.col("match").isNotNull()))
    return kept.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "match", "price")


def rcp_store(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").where("text is not null")
    return rows.select("doc_id", rc.detect_store(F.col("text"), list(vocab.STORE_PATTERNS)).alias("store"))


_NAMES = [n for n in list(globals()) if n.split("_")[0] in ("flt", "str", "win", "set", "sel", "agg", "join", "rcp") and callable(globals()[n])]
QUERIES = {n: globals()[n] for n in _NAMES}

# --- SQL. The SQL engine's \b and \s know ASCII only, so they are written out. ---
_S = r"\s\v\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_B0, _B1 = r"(?:^|[^\p{L}\p{N}\p{M}_])", r"(?:$|[^\p{L}\p{N}\p{M}_])"


def _sql(pattern: str) -> str:
    p = pattern.replace(r"[\s-]", "<CLASS>").replace(r"\s", f"[{_S}]").replace("<CLASS>", f"[{_S}-]")
    parts = p.split(r"\b")
    out = parts[0]
    for i, part in enumerate(parts[1:]):
        out += (_B0 if i % 2 == 0 else _B1) + part
    return out.replace("'", "''")


def _has(pattern: str, x: str) -> str:
    return f"regexp_matches({x}, '{_sql(pattern)}')"


def _store_test(name: str, x: str) -> str:
    if name == "BJ's":
        return f"({_has(chr(92) + 'b' + 'bj' + chr(39) + '?s' + chr(92) + 'b', x)} AND NOT regexp_matches({x}, 'bj''?s[{_S}]*(restaurant|brewhouse)'))"
    return _has(vocab.STORE_PATTERNS[name], x)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _hits(x: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_store_test(n, x)} THEN {_q(n)} END" for n in vocab.STORE_PATTERNS) + "], lambda x: x IS NOT NULL)"


def _gated(hits: str, x: str) -> str:
    return f"CASE WHEN {_has(vocab.CONTEXT, x)} THEN {hits} ELSE list_filter({hits}, lambda s: s NOT IN ('Target', 'Haymarket')) END"


_JUDGES = _has(vocab.EVALUATIVE, "lower(text)")
_DOCS = "docs AS (SELECT delivery_id, id, kind, subreddit, author, coalesce(parent_body, '') AS parent_body, text, lower(text) AS low FROM candidates WHERE text IS NOT NULL)"
_BOTS = "(" + ", ".join(map(_q, vocab.BOT_AUTHORS)) + ")"
_AT = "least(" + ", ".join(
    f"CASE WHEN list_contains(own, {_q(n)}) AND {_store_test(n, 'low')} THEN length(regexp_extract(low, '(?s)^(.*?)(?:{_sql(p.replace('(?!' + chr(92) + 's*(?:restaurant|brewhouse))', ''))})', 1)) + CASE WHEN {str(p.startswith(chr(92) + 'b')).lower()} AND NOT regexp_matches(low, '^{_sql(p.split(chr(92) + 'b')[1] if p.startswith(chr(92) + 'b') else p)}') THEN 1 ELSE 0 END END"
    for n, p in vocab.STORE_PATTERNS.items()
) + ")"
_OWN = f"own AS (SELECT *, {_gated('hits', 'low')} AS own FROM (SELECT *, {_hits('low')} AS hits FROM docs))"
_QUALIFIED = f"""kept AS (SELECT * FROM docs WHERE coalesce(author, '') NOT IN {_BOTS} AND length(text) >= 40 AND {_JUDGES}),
    named AS (SELECT *, {_gated('hits', 'low')} AS own FROM (SELECT *, {_hits('low')} AS hits FROM kept)),
    parent AS (SELECT *, CASE WHEN len(own) = 0 AND parent_body <> '' AND {_has(vocab.CONTEXT, 'low')} THEN {_gated('phits', 'lower(parent_body)')} ELSE [] END AS inherited
        FROM (SELECT *, {_hits('lower(parent_body)')} AS phits FROM named)),
    qualified AS (SELECT delivery_id, text, array_to_string(CASE WHEN len(own) > 0 THEN own ELSE inherited END, '|') AS stores, length(text) > 6000 AS truncated,
        CASE WHEN len(own) > 0 THEN 0 ELSE least(length(parent_body), 1500) END AS parent_chars FROM parent WHERE len(own) > 0 OR len(inherited) = 1)"""
_FIRST = "SELECT delivery_id FROM (SELECT delivery_id, row_number() OVER (PARTITION BY {t} ORDER BY delivery_id) AS rn FROM {f}) WHERE rn = 1"
_LINES = "lines AS (SELECT doc_id, pos, trim(line) AS line FROM (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\\r?\\n') AS l FROM documents WHERE text IS NOT NULL)) WHERE length(trim(line)) >= 3)"
_NOISE = "(" + " OR ".join(f"regexp_matches(lower(line), {_q(p)})" for p in vocab.RECEIPT_NOISE) + ")"
_PRICE = f"try_cast(replace(regexp_replace(regexp_extract(line, {_q(vocab.RECEIPT_PRICE)}, 1), '[$\\s]', '', 'g'), ',', '.') AS DOUBLE)"
_WORDMAP = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in vocab.RECEIPT_WORDS.items()) + "}"
_STRIPPED = f"regexp_replace(line, {_q(vocab.RECEIPT_PRICE)}, '', 'g')"
for _p in (vocab.RECEIPT_WEIGHED, vocab.RECEIPT_SIZES, vocab.RECEIPT_CODES):
    _STRIPPED = f"regexp_replace({_STRIPPED}, {_q(_p)}, ' ', 'g')"
_SKIP = "[" + ", ".join(map(_q, [*vocab.RECEIPT_BRANDS, *vocab.RECEIPT_UNITS, ""])) + "]"
_WORDS = f"flatten(list_transform(list_filter(list_transform(list_filter(list_transform(regexp_split_to_array({_STRIPPED}, '[^A-Za-z]+'), lambda w: lower(w)), lambda w: NOT list_contains({_SKIP}, w)), lambda w: coalesce({_WORDMAP}[w], w)), lambda w: length(w) >= 2), lambda w: string_split(w, ' ')))"
_ITEM = f"(SELECT array_to_string(list_filter(ws, lambda w, i: i = 1 OR ws[i - 1] <> w), ' ') FROM (SELECT {_WORDS} AS ws))"
_TERMS = "[" + ", ".join(map(_q, TERMS)) + "]"
_FLAT = "regexp_replace(lower(substr(text, 1, 400)), '[^a-z]', '', 'g')"
_DETECT = "CASE " + " ".join(
    f"WHEN contains({_FLAT}, '{''.join(ch for ch in n.lower() if 'a' <= ch <= 'z')}') THEN {_q(n)}"
    for n in sorted((n for n in vocab.STORE_PATTERNS if sum('a' <= ch <= 'z' for ch in n.lower()) > 3), key=lambda n: -len(n))
) + " END"

ORACLES = {
    "flt_bot": f"SELECT delivery_id FROM candidates WHERE coalesce(author, '') NOT IN {_BOTS}",
    "flt_evaluative": f"SELECT delivery_id, {_JUDGES} AS judges FROM candidates WHERE text IS NOT NULL",
    "flt_context": f"SELECT delivery_id, {_has(vocab.CONTEXT, 'lower(text)')} AS in_context FROM candidates WHERE text IS NOT NULL",
    "flt_may_mention": f"WITH {_DOCS} SELECT count(*) AS n_without, count(*) FILTER (len(hits) > 0) AS n_missed FROM (SELECT *, {_hits('low')} AS hits FROM docs) WHERE NOT (" + " OR ".join(f"contains(low, '{x}')" for x in vocab.STORE_LITERALS.values()) + ")",
    "str_matched_stores": f"WITH {_DOCS}, {_OWN} SELECT delivery_id, array_to_string(own, '|') AS stores FROM own",
    "win_first_mention": f"WITH {_DOCS}, {_OWN} SELECT delivery_id, cast(coalesce({_AT}, 0) AS BIGINT) AS at FROM own",
    "str_excerpt": f"""WITH d AS (SELECT doc_id, text, lower(text) AS low, substr(text, 1, 6000) AS head, lower(substr(text, 1, 6000)) AS hlow FROM documents WHERE text IS NOT NULL),
        o AS (SELECT *, {_gated('hits', 'low')} AS own, {_gated('hh', 'hlow')} AS hown FROM (SELECT *, {_hits('low')} AS hits, {_hits('hlow')} AS hh FROM d)),
        a AS (SELECT *, coalesce({_AT}, 0) AS pos FROM o WHERE len(own) > 0)
        SELECT doc_id, md5(CASE WHEN length(text) <= 6000 THEN text WHEN len(hown) > 0 THEN head ELSE substr(text, cast(greatest(0, pos - 1500) + 1 AS BIGINT), 6000) END) AS digest,
            length(text) > 6000 AS truncated FROM a""",
    "str_document_key": "SELECT delivery_id, substr(kind, 1, 1) || '_' || subreddit || '_' || id AS key FROM candidates WHERE id IS NOT NULL",
    "str_fence": "SELECT delivery_id, 'DOC-' || upper(substr(sha256(coalesce(parent_body, '') || chr(0) || text), 1, 16)) AS fence FROM candidates WHERE text IS NOT NULL",
    "flt_qualify": f"WITH {_DOCS}, {_QUALIFIED} SELECT delivery_id, stores, truncated, cast(parent_chars AS BIGINT) AS parent_chars FROM qualified",
    "set_text_dedup": f"WITH {_DOCS} " + _FIRST.format(t="text", f="docs"),
    "sel_candidates": f"WITH {_DOCS}, {_QUALIFIED} " + _FIRST.format(t="text", f="qualified"),
    "agg_selection_report": f"WITH {_DOCS}, {_QUALIFIED}, firsts AS ({_FIRST.format(t='text', f='qualified')}) SELECT store, count(*) AS n FROM (SELECT unnest(string_split(stores, '|')) AS store FROM qualified WHERE delivery_id IN (SELECT delivery_id FROM firsts)) GROUP BY store",
    "agg_census": f"WITH {_DOCS} SELECT store, count(*) AS mentions, count(*) FILTER (judges) AS evaluative, round(count(*) FILTER (judges) / count(*), 4) AS part FROM (SELECT unnest({_hits('low')}) AS store, {_JUDGES} AS judges FROM docs WHERE length(text) >= 10) GROUP BY store",
    "agg_subreddits": "SELECT subreddit, count(*) AS n FROM candidates WHERE text IS NOT NULL GROUP BY subreddit",
    "join_review_candidates": f"""SELECT substr(sha256(coalesce(gmap_id, 'None') || '|' || coalesce(user_id, 'None') || '|' || coalesce(cast(time AS VARCHAR), 'None')), 1, 16) AS id, time // 1000 AS created_utc,
        b.store AS stores, least(length(t), 6000) AS chars, length(t) > 6000 AS truncated FROM (SELECT *, regexp_replace(text, '^[{_S}]+|[{_S}]+$', '', 'g') AS t FROM reviews WHERE time IS NOT NULL) r
        JOIN businesses b USING (gmap_id) WHERE b.store IS NOT NULL AND length(t) >= 120""",
    "set_one_shape": "SELECT kind, count(*) AS n, cast(sum(length(text)) AS BIGINT) AS chars FROM (SELECT kind, text FROM candidates UNION ALL SELECT 'review', text FROM reviews) WHERE text IS NOT NULL GROUP BY kind",
    "agg_line_provenance": "SELECT count(*) AS n FROM documents WHERE trim(coalesce(text, '')) <> ''",
    "agg_duplicate_ids": "SELECT subreddit, kind, count(id) - count(DISTINCT id) AS duplicates FROM candidates WHERE id IS NOT NULL GROUP BY ALL",
    "rcp_noise": f"WITH {_LINES} SELECT doc_id, count(*) FILTER ({_NOISE}) AS noise, count(*) AS n FROM lines GROUP BY doc_id",
    "rcp_price": f"WITH {_LINES} SELECT doc_id, pos, price, qty FROM (SELECT *, {_PRICE} AS price, cast(least(20, coalesce(try_cast(nullif(regexp_extract(line, {_q(vocab.RECEIPT_QUANTITY)}, 1), '') AS INTEGER), 1)) AS INTEGER) AS qty FROM lines) WHERE price IS NOT NULL",
    "rcp_expand": f"WITH {_LINES} SELECT doc_id, pos, {_ITEM} AS item FROM lines WHERE {_PRICE} IS NOT NULL AND NOT {_NOISE}",
    "rcp_lines": f"""WITH {_LINES}, items AS (SELECT *, {_ITEM} AS item, {_PRICE} AS price FROM lines WHERE NOT {_NOISE}),
        met AS (SELECT *, list_filter({_TERMS}, lambda w: contains(item, w)) AS ts FROM items WHERE item <> ''),
        best AS (SELECT *, list_filter(ts, lambda w: length(w) = list_max(list_transform(ts, lambda v: length(v))))[1] AS match FROM met)
        SELECT doc_id, pos, match, price FROM best WHERE price IS NOT NULL OR match IS NOT NULL""",
    "rcp_store": f"SELECT doc_id, {_DETECT} AS store FROM documents WHERE text IS NOT NULL",
}
