"""Documents to claims through a pluggable provider: resumable, with retries, a breaker and a cost ceiling.

A provider turns one document into claims; the one shipped works offline from word lists. Documents go to it in pandas
batches on the executors. Each chunk's claims are written before its keys enter the ledger, so a run that dies repeats a
chunk at most, and the repeats fall to the claims' dedup.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.operators.selection import document_key
from gleaner.runtime import materialise
from gleaner.sources.jsonl import exists

CLAIMS = "array<struct<store:string,location:string,category:string,item:string,claim:string,sentiment:string,price_signal:string,confidence:string,comparator_store:string,transient:boolean>>"
RESULT = "key string, status string, payload string, tokens_in bigint, tokens_out bigint, cache_read bigint, cache_write bigint"
_CONTROL = r"[\x{00}-\x{08}\x{0B}-\x{1F}\x{7F}-\x{9F}]"


#: The values each closed field may have, and the fields of a claim; text fields may hold anything.
CLOSED = {
    "store": (*vocab.STORE_PATTERNS, "other"), "category": vocab.CATEGORIES, "sentiment": ("positive", "negative", "mixed", "neutral"), "price_signal": ("cheap", "expensive", "fair", "none"),
    "confidence": ("high", "medium", "low"), "comparator_store": (*vocab.STORE_PATTERNS, "other", ""),
}
CLAIM_FIELDS = ("store", "location", "category", "item", "claim", "sentiment", "price_signal", "confidence", "comparator_store", "transient")
USED = ("tokens_in", "tokens_out", "cache_read", "cache_write")


class TransientError(RuntimeError):
    """Worth another try."""


class AnsweredError(RuntimeError):
    """An answer came, and was paid for, but holds no claims that can be used. used: the tokens it cost."""

    def __init__(self, message: str, used: dict[str, int] | None = None) -> None:
        super().__init__(message)
        self.used = used or {}


def checked(claims: object, used: dict[str, int]) -> list[dict]:
    """The claims if they are a list of objects with exactly a claim's fields, of their types and allowed values."""
    if not isinstance(claims, list):
        raise AnsweredError("claims must be a list", used)
    for c in claims:
        if not isinstance(c, dict) or set(c) != set(CLAIM_FIELDS):
            raise AnsweredError("a claim has exactly the fields " + ", ".join(CLAIM_FIELDS), used)
        for name, value in c.items():
            if not isinstance(value, bool if name == "transient" else str):
                raise AnsweredError(f"{name} has the wrong type", used)
            if name in CLOSED and value not in CLOSED[name]:
                raise AnsweredError(f"{name} must not be {value!r}", used)
    return claims


class Provider(Protocol):
    """(claims, tokens used) of one document. None for claims means that the provider declined: no claims, no error. It
    raises TransientError where another try may help, and AnsweredError for an answer that was paid for but is of no use."""

    def __call__(self, text: str, parent: str, stores: list[str]) -> tuple[list[dict], dict[str, int]]: ...


class WordProvider:
    """Deterministic and offline: one claim for each store named, its sentiment and category read from word lists."""

    good = frozenset("fresh great best love solid excellent reliable cheap favorite spotless amazing awesome".split())
    bad = frozenset("stale rotten moldy worst terrible awful sad wilted overpriced bruised dirty expensive mediocre".split())

    def __call__(self, text: str, parent: str, stores: list[str]) -> tuple[list[dict], dict[str, int]]:
        words = re.findall(r"[a-z]+", text.lower())
        score = sum(w in self.good for w in words) - sum(w in self.bad for w in words)
        category = next((c for c, ws in vocab.LIST_WORDS.items() if set(ws) & set(words)), "quality_overall")
        claims = [
            {"store": s, "location": "", "category": category, "item": "", "claim": text[:120], "sentiment": "positive" if score > 0 else "negative" if score < 0 else "neutral",
             "price_signal": "cheap" if "cheap" in words else "expensive" if {"expensive", "overpriced"} & set(words) else "none", "confidence": "high" if abs(score) > 1 else "medium" if score else "low",
             "comparator_store": "", "transient": False}
            for s in stores
        ]
        return claims, {"tokens_in": len(words), "tokens_out": 20 * len(claims), "cache_read": 0, "cache_write": 0}


@dataclass(frozen=True)
class Retry:
    attempts: int = 6
    base: float = 2.0
    cap: float = 60.0
    sleep: Callable[[float], None] = time.sleep
    jitter: Callable[[], float] = random.random

    def delay(self, attempt: int) -> float:
        return min(self.base * 2**attempt, self.cap)


@dataclass(frozen=True)
class Limits:
    """chunk: documents between commits. failures: in a row, in the order of the keys, that stop the run. cost: ceiling, with
    prices per million tokens (in, out, cache read, cache write). The run looks at both after each chunk."""

    chunk: int = 1_000
    failures: int = 50
    cost: float | None = None
    prices: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)


def call_with_retries(provider: Provider, text: str, parent: str, stores: list[str], retry: Retry) -> tuple[list[dict], dict[str, int]]:
    for attempt in range(retry.attempts):
        try:
            return provider(text, parent, stores)
        except TransientError:
            if attempt == retry.attempts - 1:
                raise
            retry.sleep(retry.delay(attempt) + retry.jitter())
    raise AssertionError


def extract(documents: DataFrame, provider: Provider, retry: Retry = Retry()) -> DataFrame:
    """key, status (ok, refusal or error), payload (claims as JSON, or the error) and the tokens used, for each document;
    what was paid for counts whatever came of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    claims, used = call_with_retries(provider, r.text, r.parent_body or "", list(r.stores), retry)
                    status, payload = ("refusal", "[]") if claims is None else ("ok", json.dumps(checked(claims, used)))
                except Exception as e:  # noqa: BLE001
                    used = getattr(e, "used", {})
                    status, payload = "error", str(e)[:500]
                rows.append((r.key, status, payload, *[used.get(k, 0) for k in USED]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")], dtype=object)

    keyed = documents.select(document_key(F.col("kind"), F.col("subreddit"), F.col("id")).alias("key"), "text", "parent_body", "stores")
    return keyed.mapInPandas(run, RESULT)


def claims_of(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Claims with where they come from: eight fields of their document; free text without control characters."""
    source = documents.select(
        document_key(F.col("kind"), F.col("subreddit"), F.col("id")).alias("key"), F.col("id").alias("source_id"), "subreddit", "kind", "permalink", "author", "created_utc", "score"
    )
    rows = results.where("status = 'ok'").select("key", F.explode(F.coalesce(F.from_json("payload", CLAIMS), F.array().cast(CLAIMS))).alias("c")).select("key", "c.*")
    clean = {f: F.regexp_replace(f, _CONTROL, "") for f in ("claim", "item", "location")}
    return rows.join(source, "key").withColumns(clean).withColumnRenamed("key", "source_key")


def pending(documents: DataFrame, done: DataFrame) -> DataFrame:
    return documents.join(done, document_key(F.col("kind"), F.col("subreddit"), F.col("id")) == done["key"], "left_anti")


def sample(documents: DataFrame, n: int | None, seed: int = 0) -> DataFrame:
    """A fixed sample without replacement: all for None, none for n <= 0. The order is by a hash of the document's key."""
    if n is None:
        return documents
    key = document_key(F.col("kind"), F.col("subreddit"), F.col("id"))
    return documents.orderBy(F.sha2(F.concat_ws(":", key, F.lit(str(seed))), 256), key).limit(max(n, 0))


def cost(prices: tuple[float, float, float, float]) -> Column:
    return (F.sum("tokens_in") * prices[0] + F.sum("tokens_out") * prices[1] + F.sum("cache_read") * prices[2] + F.sum("cache_write") * prices[3]) / 1e6


def cache_hit_rate() -> Column:
    return F.coalesce(F.try_divide(F.sum("cache_read"), F.sum("cache_read") + F.sum("tokens_in")), F.lit(0.0))


@dataclass
class RunReport:
    done: int = 0
    failed: int = 0
    claims: int = 0
    spent: float = 0.0
    stopped: str = ""
    chunks: list[int] = field(default_factory=list)


def failures_in_a_row(results: DataFrame, before: int) -> tuple[int, int]:
    """(longest run, run at the end) of failures in the order of the keys, `before` of them having come before the first. At
    most a chunk's keys are looked at."""
    order = Window.orderBy("key")
    marked = results.select("key", (F.col("status") == "error").alias("bad"))
    runs = marked.withColumn("run", F.sum(F.when(F.col("bad"), 0).otherwise(1)).over(order)).groupBy("run").agg(F.count_if("bad").alias("n"))
    row = runs.agg(F.max(F.col("n") + F.when(F.col("run") == 0, before).otherwise(0)).alias("most"), F.max_by("n", "run").alias("end"), F.max("run").alias("last")).first()
    if row["most"] is None:
        return before, before
    return row["most"], row["end"] + (before if row["last"] == 0 else 0)


def run_extraction(
    documents: DataFrame, folder: str, provider: Provider, retry: Retry = Retry(), limits: Limits = Limits(), stop: Callable[[], bool] = lambda: False,
    progress: Callable[[int, int, RunReport, float], None] = lambda i, total, report, seconds: None,
) -> RunReport:
    """Extract what the ledger in folder doesn't have. Chunks are cut by hash of the key, so any number of documents is
    spread evenly; claims are written before the ledger's keys. A document the provider declines is done, without claims.
    progress is called after each chunk with the documents so far, all of them, the report and the seconds gone by."""
    began = time.monotonic()
    spark = documents.sparkSession
    report = RunReport()
    key = document_key(F.col("kind"), F.col("subreddit"), F.col("id"))
    todo = materialise(pending(documents, read_ledger(spark, folder)), "todo")
    total = todo.count()
    chunks = max(1, -(-total // limits.chunk))
    in_a_row = 0
    for i in range(chunks):
        if stop():
            report.stopped = "asked to stop"
            break
        part = todo.where(F.pmod(F.xxhash64(key), F.lit(chunks)) == i)
        results = materialise(extract(part, provider, retry), "results")
        claims = claims_of(results, part)
        claims.write.mode("append").json(f"{folder}/claims")
        results.where("status = 'error'").select("key", F.col("payload").alias("error")).write.mode("append").json(f"{folder}/failed")
        results.where("status in ('ok', 'refusal')").select("key").write.mode("append").text(f"{folder}/done")
        facts = results.agg(F.count_if(F.col("status") != "error").alias("ok"), F.count_if(F.col("status") == "error").alias("bad"), cost(limits.prices).alias("cost")).first()
        report.done += facts["ok"]
        report.failed += facts["bad"]
        report.spent += facts["cost"] or 0.0
        report.chunks.append(facts["ok"] + facts["bad"])
        most, in_a_row = failures_in_a_row(results, in_a_row)
        progress(report.done + report.failed, total, report, time.monotonic() - began)
        if most >= limits.failures:
            report.stopped = "too many failures in a row"
            break
        if limits.cost is not None and report.spent >= limits.cost:
            report.stopped = "cost ceiling"
            break
    if exists(spark, f"{folder}/claims"):
        report.claims = spark.read.text(f"{folder}/claims").count()
    return report


def progress_lines(every: int = 100, say: Callable[[str], None] = print) -> Callable[[int, int, RunReport, float], None]:
    """A progress callback: a line for each further `every` documents, and one at the end."""
    told = [0]

    def report(i: int, total: int, run: RunReport, seconds: float) -> None:
        if i // every == told[0] and i != total:
            return
        told[0] = i // every
        rate = i / seconds if seconds > 0 else 0.0
        say(f"{i}/{total} done, {run.failed} failed, {rate:.1f} a second, {(total - i) / rate / 60 if rate else 0:.0f} min left")

    return report


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    if not exists(spark, f"{folder}/done"):
        return spark.createDataFrame([], "key string")
    return spark.read.text(f"{folder}/done").select(F.col("value").alias("key")).distinct()


def projected_cost(used: dict[str, float], documents: int, total: int, prices: tuple[float, float, float, float]) -> float | None:
    """Cost of all from a part: all but cache writes grow with the documents; none without documents."""
    if documents <= 0:
        return None
    scale = total / documents
    linear = used["tokens_in"] * prices[0] + used["tokens_out"] * prices[1] + used["cache_read"] * prices[2]
    return (linear * scale + used["cache_write"] * prices[3]) / 1e6
