"""Month windows, and a paged source that has one partition for each of them."""

from __future__ import annotations

import datetime as dt
import importlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 100


def month_windows(spark: SparkSession, start: int, end: int) -> DataFrame:
    """label, first, last (epoch seconds, both inside) of each month that meets [start, end]."""
    bounds = spark.range(1).select(F.timestamp_seconds(F.lit(start)).alias("a"), F.timestamp_seconds(F.lit(end)).alias("b"))
    month = F.explode(F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))).alias("m")
    return bounds.select(month).select(
        F.date_format("m", "yyyy-MM").alias("label"), F.unix_timestamp(F.col("m").cast("timestamp")).alias("first"),
        (F.unix_timestamp(F.add_months("m", 1).cast("timestamp")) - 1).alias("last"),
    )


def missing_windows(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")


def coverage(fetched: DataFrame, reported: DataFrame, keys: list[str], least: float = 0.95) -> DataFrame:
    """Per key: fetched, duplicates, reported, covered and whether that is enough. fetched: keys and id."""
    got = fetched.groupBy(*keys).agg(F.count(F.lit(1)).alias("fetched"), (F.count("id") - F.countDistinct("id")).alias("duplicates"))
    share = F.coalesce(F.try_divide("fetched", "reported"), F.lit(1.0))
    return reported.join(got, keys, "left").select(
        *keys, F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"), "reported", F.round(share, 4).alias("covered"), (share >= least).alias("enough")
    )


def gap_counts(rows: DataFrame) -> DataFrame:
    """window, gaps: the times in each window of the paged source that were stepped past, so that rows may be missing."""
    return rows.groupBy("window").agg(F.countDistinct(F.when(F.col("gap"), F.col("created_utc"))).alias("gaps"))


class MonthPartition(InputPartition):
    def __init__(self, label: str, first: int, last: int) -> None:
        self.label, self.first, self.last = label, first, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        module, name = options["client"].rsplit(":", 1)
        self.fetch: Callable[[int, int], list[dict]] = getattr(importlib.import_module(module), name)
        self.start, self.end = int(options["start"]), int(options["end"])

    def partitions(self) -> list[MonthPartition]:
        out, day = [], dt.datetime.fromtimestamp(self.start, dt.UTC).replace(day=1, hour=0, minute=0, second=0, microsecond=0)
        while day.timestamp() <= self.end:
            after = (day + dt.timedelta(days=32)).replace(day=1)
            out.append(MonthPartition(day.strftime("%Y-%m"), int(day.timestamp()), int(after.timestamp()) - 1))
            day = after
        return out

    def read(self, partition: MonthPartition) -> Iterator[tuple]:
        """Pages by time: up to 100 rows after the cursor. The cursor goes to the page's last time less one, so rows of
        that time come again and are known by id; a page of one single time is stepped past, and its rows are marked
        as a gap, for there may be more of that time."""
        after, seen = partition.first - 1, set()
        while True:
            page = [r for r in self.fetch(after, PAGE) if r["created_utc"] <= partition.last]
            fresh = [r for r in page if r["id"] not in seen]
            gap = len(page) == PAGE and page[0]["created_utc"] == page[-1]["created_utc"]
            for r in fresh:
                seen.add(r["id"])
                yield (r["id"], int(r["created_utc"]), r.get("body"), partition.label, gap)
            if len(page) < PAGE:
                return
            after = page[-1]["created_utc"] - 1 if fresh and page[-1]["created_utc"] > page[0]["created_utc"] else page[-1]["created_utc"]


class PagedSource(DataSource):
    """format("paged") with options client ("module:function" taking (after, limit), oldest first), start, end."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string, created_utc bigint, body string, window string, gap boolean"

    def reader(self, schema) -> PagedReader:  # noqa: ANN001
        return PagedReader(self.options)
