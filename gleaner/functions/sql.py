"""The scalar functions under names that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

# the body of each is an expression, so a query that calls it is optimized as if it were written out
FUNCTIONS = {
    "recency_weight(created BIGINT, now_s BIGINT, half_life DOUBLE)": ("DOUBLE", "pow(0.5D, greatest((now_s - created) / 31557600.0D, 0.0D) / half_life)"),
    "vote_weight(votes BIGINT)": ("DOUBLE", "CASE WHEN votes IS NULL THEN 1.0D WHEN votes < 0 THEN 0.5D ELSE least(1.0D + ln(1.0D + votes) / 5.0D, 2.0D) END"),
    "star_scale(stars DOUBLE)": ("DOUBLE", "(stars - 3.0D) / 2.0D"),
    "shrunk(total DOUBLE, weight DOUBLE)": ("DOUBLE", "CASE WHEN weight = 0 THEN 0.0D ELSE total / (weight + 2.0D) END"),
    "metres(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)": (
        "DOUBLE",
        "12742000.0D * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))",
    ),
}


def register(spark: SparkSession) -> None:
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
