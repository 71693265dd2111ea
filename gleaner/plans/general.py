"""Queries of the general data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import epoch_seconds
from gleaner.operators.chunked import dominant_keys, gap_profile, key_counts
from gleaner.runtime import load
from gleaner.streaming.once import once, redeliveries


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redeliveries(spark, f"{sf_dir}/candidates.parquet")


def p1_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, f"{sf_dir}/candidates.parquet").select("delivery_id", "kind", "id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        dominant_keys(load(spark, sf_dir, table), column).select(F.lit(f"{table}.{column}").alias("src"), "key_value")
        for table, column in (("claims", "store"), ("candidates", "subreddit"))
    ]
    return parts[0].unionByName(parts[1])


def p5_store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_counts(load(spark, sf_dir, "claims"), "store").select("key_value", "n_rows")


def p5_subreddit_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "candidates").withColumn("at", epoch_seconds(F.col("created_utc")))
    return gap_profile(rows, "subreddit", "at", "delivery_id", F.coalesce(F.col("score"), F.lit(0)))


QUERIES = {
    "p1_found": p1_found,
    "p1_messages": p1_messages,
    "p5_found": p5_found,
    "p5_store_rows": p5_store_rows,
    "p5_subreddit_gaps": p5_subreddit_gaps,
}

_MESSAGE = r"regexp_replace(lower(regexp_replace(id, '^\s+|\s+$', '', 'g')), '^t[0-9]_', '')"
_FIRST = f"SELECT delivery_id, kind, id, row_number() OVER (PARTITION BY kind, {_MESSAGE} ORDER BY delivery_id) AS rn FROM candidates WHERE {_MESSAGE} <> ''"

ORACLES = {
    "p1_found": f"SELECT delivery_id FROM ({_FIRST}) WHERE rn > 1",
    "p1_messages": f"SELECT delivery_id, kind, id FROM ({_FIRST}) WHERE rn = 1 UNION ALL SELECT delivery_id, kind, id FROM candidates WHERE coalesce({_MESSAGE}, '') = ''",
    "p5_found": """SELECT 'claims.store' AS src, store AS key_value FROM claims GROUP BY store HAVING count(*) > 0.05 * (SELECT count(*) FROM claims)
        UNION ALL SELECT 'candidates.subreddit', subreddit FROM candidates GROUP BY subreddit HAVING count(*) > 0.05 * (SELECT count(*) FROM candidates)""",
    "p5_store_rows": "SELECT store AS key_value, cast(count(*) AS bigint) AS n_rows FROM claims GROUP BY store",
    "p5_subreddit_gaps": """WITH c AS (SELECT subreddit, coalesce(score, 0) AS score, CASE WHEN abs(created_utc) >= 100000000000000 THEN created_utc // 1000000
            WHEN abs(created_utc) >= 100000000000 THEN created_utc // 1000 ELSE created_utc END AS t FROM candidates),
        g AS (SELECT *, t - lag(t) OVER (PARTITION BY subreddit ORDER BY t) AS gap FROM c)
        SELECT subreddit AS key_value, cast(count(*) AS bigint) AS n_rows, cast(min(t) AS bigint) AS first_at, cast(max(t) AS bigint) AS last_at,
            cast(max(gap) AS bigint) AS longest_gap, cast(sum(score) AS bigint) AS measure FROM g GROUP BY subreddit""",
}
