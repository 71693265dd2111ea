"""Strict checks of untyped rows, and assertions before anything is published.

Types are read from VARIANT values, never by casting: a number given as text, or a boolean given as a number, is wrong.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.config import Settings
from gleaner.functions.scoring import SECONDS_PER_YEAR

CANDIDATE_TEXT = ("id", "subreddit", "kind", "author", "parent_body", "permalink", "text")
CLAIM_TEXT = ("store", "category", "claim", "sentiment", "confidence", "source_key", "permalink")
CLAIM_OPTIONAL = ("location", "item", "comparator_store", "author")


def kind_of(v: Column, field: str) -> Column:
    """STRING, BIGINT, DOUBLE, BOOLEAN, VOID (a null given as such), ARRAY<...>, ...; null where the field is absent."""
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _all(conditions: Iterable[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, conditions), F.lit(False))


def _text(v: Column, field: str) -> Column:
    return kind_of(v, field) == "STRING"


def _whole_or_null(v: Column, field: str) -> Column:
    kind = kind_of(v, field)
    return kind.isNull() | kind.isin("VOID", "BIGINT")


def candidate_ok(v: Column) -> Column:
    """All eleven fields there; time whole; stores a list of texts; score whole or null; seven texts."""
    stores = kind_of(v, "stores")
    return _all(
        [is_object(v), kind_of(v, "created_utc") == "BIGINT", stores.isin("ARRAY<STRING>", "ARRAY<VOID>"), kind_of(v, "score").isin("VOID", "BIGINT"),
         kind_of(v, "truncated").isNotNull(), *[_text(v, f) for f in CANDIDATE_TEXT]]
    )


def claim_ok(v: Column, s: Settings = Settings()) -> Column:
    """Required texts; a whole time within bounds; score whole, null or absent; transient absent or boolean; optional
    texts absent, null or text."""
    at = F.try_variant_get(v, "$.created_utc", "bigint")
    flag = kind_of(v, "transient")
    optional = [kind_of(v, f).isNull() | kind_of(v, f).isin("STRING", "VOID") for f in CLAIM_OPTIONAL]
    bounds = at.between(s.min_timestamp, s.now + int(SECONDS_PER_YEAR))
    return _all(
        [is_object(v), kind_of(v, "created_utc") == "BIGINT", bounds, _whole_or_null(v, "score"), flag.isNull() | (flag == "BOOLEAN"), *optional,
         *[_text(v, f) for f in CLAIM_TEXT]]
    )


def split_valid(rows: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, one row with n_dropped): rows that failed or did not parse are counted, not lost silently."""
    marked = rows.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return marked.where("_ok").drop("_ok"), marked.agg(F.count_if(~F.col("_ok")).alias("n_dropped"))


def field_names(schema: T.DataType) -> set[str]:
    """Every field name at any depth."""
    if isinstance(schema, T.StructType):
        return {f.name for f in schema.fields}.union(*[field_names(f.dataType) for f in schema.fields] or [set()])
    if isinstance(schema, T.ArrayType):
        return field_names(schema.elementType)
    if isinstance(schema, T.MapType):
        return field_names(schema.keyType) | field_names(schema.valueType)
    return set()


def assert_no_fields(df: DataFrame, banned: Iterable[str], what: str) -> None:
    found = field_names(df.schema) & set(banned)
    if found:
        raise ValueError(f"{what} must not hold {sorted(found)}")


def is_public_link(link: Column) -> Column:
    return F.coalesce(link.rlike(r"^/r/[A-Za-z0-9_]+/"), F.lit(False))


def unfit_rows(df: DataFrame, links: str | None = None) -> DataFrame:
    """One row with n_unfit: rows with a not-a-number or infinite double, or a link that isn't public."""
    bad = F.lit(False)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            bad = bad | F.coalesce(F.isnan(f.name) | (F.abs(f.name) == float("inf")), F.lit(False))
    if links:
        bad = bad | ~is_public_link(F.col(links))
    return df.agg(F.count_if(bad).alias("n_unfit"))


def assert_publishable(df: DataFrame, links: str | None = None) -> None:
    n = unfit_rows(df, links).first()[0]
    if n:
        raise ValueError(f"{n} rows are not fit to publish")
