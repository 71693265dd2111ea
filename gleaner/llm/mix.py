"""Mixing sources to target weights.

Each document has a hash of its id. Tokens are summed by source and the leading bits of the hash; from these sums follow
how many whole copies of a source its budget takes and up to which bits one more copy goes. Only the one range of bits at
the border is summed again, by the next bits, until it holds one document. A document's copies then follow from its own
hash and its source's threshold, by a filter: nothing is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.tokens import Tokenizer, with_token_count
from gleaner.runtime import materialise

MAX_SOURCES = 10_000


@dataclass(frozen=True)
class MixSettings:
    """total_tokens: of the mix; without it, the most at which every source present reaches its share. level_bits: of
    the hash that one histogram resolves; levels: their number. seed: of the hash."""

    total_tokens: int | None = None
    level_bits: int = 12
    levels: int = 5
    seed: int = 17


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    max_repeats: int
    tokens: int
    documents: int


@dataclass(frozen=True)
class Quota:
    """copies of every document, and one more of those whose hash is below threshold."""

    source: str
    copies: int
    threshold: int


def shares_of(targets: list[Target]) -> dict[str, float]:
    """Shares over the sources that have tokens and may be used; the others' shares are spread over these in proportion."""
    present = {t.source: t.share for t in targets if t.tokens > 0 and t.max_repeats > 0 and t.share > 0}
    total = sum(present.values())
    return {s: x / total for s, x in present.items()} if total else {}


def total_within(targets: list[Target], wanted: int | None) -> float:
    share = shares_of(targets)
    most = min((t.max_repeats * t.tokens / share[t.source] for t in targets if t.source in share), default=0.0)
    return most if wanted is None else float(wanted)


def measured(documents: DataFrame, tokenizer: Tokenizer, settings: MixSettings) -> DataFrame:
    """doc_id, source, n_tokens, h: the hash, of level_bits * levels bits."""
    sized = with_token_count(documents.select("doc_id", "source", "text"), tokenizer=tokenizer)
    bits = settings.level_bits * settings.levels
    return materialise(sized.select("doc_id", "source", "n_tokens", F.shiftrightunsigned(F.xxhash64(F.lit(settings.seed), "doc_id"), 64 - bits).alias("h")), "tokens")


def quotas(rows: DataFrame, targets: list[Target], settings: MixSettings) -> list[Quota]:
    """Whole copies and threshold of each source."""
    share, total = shares_of(targets), total_within(targets, settings.total_tokens)
    out: list[Quota] = []
    open_: dict[str, tuple[int, int, float]] = {}
    for t in targets:
        if t.source not in share:
            out.append(Quota(t.source, 0, 0))
            continue
        budget = min(share[t.source] * total, float(t.max_repeats * t.tokens))
        copies = min(int(budget / t.tokens + 1e-9), t.max_repeats)
        rest = budget - copies * t.tokens
        if copies >= t.max_repeats or rest < 0.5:
            out.append(Quota(t.source, copies, 0))
        else:
            open_[t.source] = (copies, 0, rest)  # copies, bits so far, tokens still to take
    spark = rows.sparkSession
    for level in range(settings.levels):
        if not open_:
            break
        shift = settings.level_bits * (settings.levels - 1 - level)
        border = F.broadcast(spark.createDataFrame([(s, prefix, rest) for s, (_, prefix, rest) in open_.items()], "source string, prefix bigint, rest double"))
        sums = (
            rows.join(border, "source").where(F.shiftright("h", shift + settings.level_bits) == F.col("prefix"))
            .groupBy("source", "rest", F.shiftright("h", shift).alias("bucket"))
            .agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
        )
        # running sums over at most 2 ** level_bits buckets of a source; one row for each source comes to the driver
        upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket"))
        over = sums.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        first = over.groupBy("source").agg(F.min_by(F.struct("bucket", "tokens", "n", "upto"), "bucket").alias("b"))
        found = {r["source"]: r["b"] for r in first.collect()}
        for source, (copies, prefix, rest) in list(open_.items()):
            at = found.get(source)
            if at is None:
                cut, alone = (prefix + 1) << settings.level_bits, True
            else:
                cut, alone, rest = at["bucket"], at["n"] == 1, rest - (at["upto"] - at["tokens"])
                # the document at the border is taken where that comes nearer to the budget
                if alone and at["tokens"] - rest < rest:
                    cut += 1
            if alone or level == settings.levels - 1:
                out.append(Quota(source, copies, cut << shift))
                del open_[source]
            else:
                open_[source] = (copies, cut, rest)
    return out


def mix(documents: DataFrame, targets: DataFrame, tokenizer: Tokenizer = Tokenizer(), settings: MixSettings = MixSettings()) -> tuple[DataFrame, DataFrame]:
    """(mix, report). mix: doc_id, source, n_tokens, copies, for documents with a copy at least. report: source,
    target_share, max_repeats, available_tokens, mixed_tokens, actual_share, for every source of either table.

    Without total_tokens the mix is the largest that gives each source present its target share exactly (but for a part
    of a document). Shares of sources without documents are spread over the others in proportion, and reported as 0;
    documents of sources without target, or with a null source, are left out and reported. Empty documents have no tokens
    and come along with their hash. A target given twice counts once, with the larger share.
    """
    rows = measured(documents, tokenizer, settings)
    have = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    want = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats"))
    known = want.where("source is not null").join(have, "source", "left").limit(MAX_SOURCES + 1).collect()
    if len(known) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    listed = [Target(r["source"], r["share"] or 0.0, r["repeats"] or 0, r["tokens"] or 0, r["n"] or 0) for r in known]
    spark = documents.sparkSession
    quota = quotas(rows, listed, settings)
    table = F.broadcast(spark.createDataFrame([(q.source, q.copies, q.threshold) for q in quota], "source string, whole int, threshold bigint"))
    mixed = (
        rows.join(table, "source").withColumn("copies", F.col("whole") + (F.col("h") < F.col("threshold")).cast("int"))
        .where("copies > 0").select("doc_id", "source", "n_tokens", "copies")
    )
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"))
    total = got.agg(F.sum("mixed_tokens").alias("total"))
    report = (
        have.join(want, have["source"].eqNullSafe(want["source"]), "full")
        .select(F.coalesce(have["source"], want["source"]).alias("source"), "share", "repeats", "tokens")
        .join(got, "source", "left").crossJoin(F.broadcast(total))
        .select(
            "source", F.coalesce("share", F.lit(0.0)).alias("target_share"), F.coalesce("repeats", F.lit(0)).alias("max_repeats"),
            F.coalesce("tokens", F.lit(0)).alias("available_tokens"), F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.round(F.coalesce(F.try_divide("mixed_tokens", "total"), F.lit(0.0)), 6).alias("actual_share"),
        )
    )
    return mixed, report
