"""String functions as columns. White space means Unicode white space throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import vocab

UNSAFE = "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in vocab.UNSAFE_RANGES) + "]"
ANONYMOUS = ("", "[deleted]", "[removed]")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that later steps use but don't work out again: a generator stands between, through which the
    optimizer moves no expression."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.withColumn("_made", F.explode(F.array(made))).select("*", "_made.*").drop("_made")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; ends are cut."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fold_key(c: Column) -> Column:
    """Comparison key: squeezed, lower case, sharp and long s folded."""
    return F.replace(F.lower(F.translate(squeeze(c), "ſẞ", "sß")), F.lit("ß"), F.lit("ss"))


def message_key(c: Column) -> Column:
    """A message identifier however written: ends cut, lower case, without a t1_/t3_ type prefix; blank is null."""
    key = F.regexp_replace(F.lower(strip(c)), r"^t[0-9]_", "")
    return F.when(key != "", key)


def handle_key(c: Column) -> Column:
    """An author's handle however written ("/u/Name ", "NAME"); null for anonymous or missing."""
    key = F.regexp_replace(F.lower(strip(c)), r"^(/?u/|@)", "")
    return F.when(~key.isin(*ANONYMOUS), key)


def epoch_seconds(c: Column) -> Column:
    """Seconds from a value in seconds, milli- or microseconds, told apart by size."""
    return (
        F.when(F.abs(c) >= 100_000_000_000_000, F.floor(c / 1_000_000))
        .when(F.abs(c) >= 100_000_000_000, F.floor(c / 1000))
        .otherwise(c)
        .cast("bigint")
    )
