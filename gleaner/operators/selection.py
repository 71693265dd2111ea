"""Which documents are worth reading: authors, length, judgement, entities in context, parents, excerpts, repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import vocab
from gleaner.config import Settings
from gleaner.functions.text import let, strip
from gleaner.operators.places import store_hits
from gleaner.runtime import materialise, spread


def lowered(c: Column) -> Column:
    """Lower case of the same length: the one letter that would become two is left alone."""
    return F.lower(F.replace(c, F.lit("İ"), F.lit("_")))


def unicode_aware(pattern: str) -> str:
    return f"(?U){pattern}"


def may_mention(low: Column) -> Column:
    """Cheap substrings before the patterns; never false where a pattern matches."""
    out = F.lit(False)
    for literal in vocab.STORE_LITERALS.values():
        out = out | low.contains(literal)
    return out


def in_context(low: Column) -> Column:
    return low.rlike(unicode_aware(vocab.CONTEXT))


def matched_stores(text: Column) -> Column:
    """Stores the text names, in declared order; names that are ordinary words too count in context only."""
    gated = F.array(*map(F.lit, vocab.CONTEXT_GATED))
    none = F.array().cast("array<string>")

    def of(low: Column) -> Column:
        hits = F.when(may_mention(low), store_hits(low)).otherwise(none)
        return let(hits, lambda h: F.when(F.size(h) == 0, h).when(in_context(low), h).otherwise(F.array_except(h, gated)))

    return let(F.lower(text), of)


def is_evaluative(text: Column) -> Column:
    return F.lower(text).rlike(unicode_aware(vocab.EVALUATIVE))


def is_bot(author: Column) -> Column:
    return F.coalesce(author, F.lit("")).isin(*vocab.BOT_AUTHORS)


def document_text(body: Column, title: Column, selftext: Column) -> Column:
    """A comment's body (even an empty one), or a post's title and text."""
    post = F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(selftext, F.lit("")))
    return F.coalesce(body, strip(post))


def permalink(kind: Column, subreddit: Column, id_: Column, link: Column, existing: Column) -> Column:
    post = F.when(F.coalesce(existing, F.lit("")) != "", existing).otherwise(F.concat(F.lit("/r/"), subreddit, F.lit("/comments/"), id_, F.lit("/")))
    thread = F.replace(F.coalesce(link, F.lit("")), F.lit("t3_"), F.lit(""))
    return F.when(kind == "posts", post).otherwise(F.concat(F.lit("/r/"), subreddit, F.lit("/comments/"), thread, F.lit("/_/"), id_, F.lit("/")))


def document_key(kind: Column, subreddit: Column, id_: Column) -> Column:
    return F.concat(F.substring(kind, 1, 1), F.lit("_"), subreddit, F.lit("_"), id_)


def fence(parent: Column, text: Column) -> Column:
    """A marker derived from the content, so that the content cannot hold it."""
    return F.concat(F.lit("DOC-"), F.upper(F.substring(F.sha2(F.concat(F.coalesce(parent, F.lit("")), F.lit("\0"), text), 256), 1, 16)))


def first_mention(text: Column, stores: Column) -> Column:
    """Offset in characters of the earliest mention of any of the stores; 0 without one."""

    def of(low: Column) -> Column:
        starts = [
            F.when(F.array_contains(stores, name) & low.rlike(unicode_aware(p)), F.length(F.regexp_extract(low, rf"(?Us)^(.*?)(?:{p})", 1)))
            for name, p in vocab.STORE_PATTERNS.items()
        ]
        return F.coalesce(F.array_min(F.array(*starts)), F.lit(0))

    return let(lowered(text), of)


def excerpt(text: Column, stores: Column, s: Settings = Settings()) -> tuple[Column, Column]:
    """(excerpt, truncated): the text up to max_chars; its head if that still names a store, else a window around the
    first mention."""
    head = F.substring(text, 1, s.max_chars)
    start = F.greatest(F.lit(0), first_mention(text, stores) - s.max_chars // 4)
    window = F.substring(text, start + 1, F.lit(s.max_chars))
    long = F.length(text) > s.max_chars
    return F.when(~long, text).when(F.size(matched_stores(head)) > 0, head).otherwise(window), long


def resolve_parents(raw: DataFrame) -> DataFrame:
    """raw with parent_body: the body of the comment that a reply answers, within its shard ('' without). Of comments
    with one id the last by ord counts. raw: shard, ord, id, parent_id, body."""
    bodies = raw.where(F.col("id").isNotNull() & (F.coalesce("body", F.lit("")) != "")).groupBy("shard", "id").agg(F.max_by("body", "ord").alias("parent_body"))
    parents = bodies.withColumnRenamed("id", "_parent")
    key = F.when(F.col("parent_id").startswith("t1_"), F.substring(F.col("parent_id"), 4, 1_000))
    return raw.withColumn("_parent", key).join(parents, ["shard", "_parent"], "left").drop("_parent").withColumn("parent_body", F.coalesce("parent_body", F.lit("")))


def qualify(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Documents that qualify, with stores, text (an excerpt), truncated and parent_body as a reader gets them.

    docs: author, text, parent_body and any others. Cheap tests come first. A document that names no store inherits its
    parent's, if that names exactly one and the document itself has context; only then the parent's text stays.
    """
    kept = spread(docs).where(~is_bot(F.col("author"))).where(F.length("text") >= s.min_chars).where(is_evaluative(F.col("text")))
    text, parent = F.col("text"), F.coalesce(F.col("parent_body"), F.lit(""))
    none = F.array().cast("array<string>")

    def answer(stores: Column, inherits: bool) -> Column:
        body, cut = excerpt(text, stores, s)

        def seen(b: Column) -> Column:
            visible = stores if inherits else F.when(cut, matched_stores(b)).otherwise(stores)
            out = F.struct(visible.alias("stores"), b.alias("text"), cut.alias("truncated"), (F.substring(parent, 1, s.parent_chars) if inherits else F.lit("")).alias("parent_body"))
            return F.when(F.size(visible) > 0, out)

        return let(body, seen)

    def judged(own: Column) -> Column:
        inherited = F.when((parent != "") & in_context(F.lower(text)), matched_stores(parent)).otherwise(none)
        return F.when(F.size(own) > 0, answer(own, False)).otherwise(let(inherited, lambda i: F.when(F.size(i) == 1, answer(i, True))))

    # exploded, not filtered: a filter would be pushed below and work everything out once more
    found = kept.withColumn("_q", F.explode(F.filter(F.array(let(matched_stores(text), judged)), lambda q: q.isNotNull())))
    return found.drop("text", "parent_body", "stores", "truncated").select("*", "_q.*").drop("_q")


def first_texts(docs: DataFrame, order: list[str]) -> DataFrame:
    """Of documents with the same text the first in order. The lowest order of each text's digest is combined before the
    shuffle; texts themselves are not moved."""
    place = F.struct(*order)
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    first = docs.select(digest.alias("_d"), place.alias("_o")).groupBy("_d").agg(F.min("_o").alias("_o")).select("_o.*")
    return docs.join(first, order, "left_semi")


def select_candidates(docs: DataFrame, order: list[str], s: Settings = Settings(), limit: int | None = None) -> DataFrame:
    """Qualified documents without repeated texts; with a limit the first so many in order."""
    out = first_texts(materialise(qualify(docs, s), "qualified"), order)
    return out if limit is None else out.orderBy(*order).limit(limit)


def selection_counts(docs: DataFrame, order: list[str], s: Settings = Settings()) -> DataFrame:
    """scanned, kept, duplicates: documents looked at, those selected, and qualified ones whose text came before."""
    qualified = materialise(qualify(docs, s), "qualified")
    counts = qualified.agg(F.count(F.lit(1)).alias("qualified"))
    kept = first_texts(qualified, order).agg(F.count(F.lit(1)).alias("kept"))
    scanned = docs.agg(F.count(F.lit(1)).alias("scanned"))
    return scanned.crossJoin(kept).crossJoin(counts).select("scanned", "kept", (F.col("qualified") - F.col("kept")).alias("duplicates"))


def store_report(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.explode("stores").alias("store")).groupBy("store").agg(F.count(F.lit(1)).alias("n"))


def census(docs: DataFrame) -> DataFrame:
    """Per store: documents that name it (ungated) and the part of them that judges."""
    low = F.lower("text")
    rows = spread(docs.select("text")).where(F.length("text") >= 10).select(F.explode(store_hits(low)).alias("store"), is_evaluative(F.col("text")).alias("judges"))
    counts = rows.groupBy("store").agg(F.count(F.lit(1)).alias("mentions"), F.count_if("judges").alias("evaluative"))
    return counts.withColumn("part", F.round(F.col("evaluative") / F.col("mentions"), 4))


def review_candidates(reviews: DataFrame, stores: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Substantive reviews of known places in a candidate's shape. stores: gmap_id, store (one row each, a short list)."""
    text = strip(F.coalesce("text", F.lit("")))
    material = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("gmap_id", "user_id", "time")])
    named = stores.select("gmap_id", F.col("store").alias("_store"))
    rows = reviews.where(F.length(text) >= s.review_chars).withColumn("_text", text).join(named, "gmap_id")
    return rows.select(
        F.substring(F.sha2(material, 256), 1, 16).alias("id"), F.lit("review").alias("kind"), F.expr("time div 1000").alias("created_utc"), F.array("_store").alias("stores"),
        F.substring("_text", 1, s.max_chars).alias("text"), (F.length("_text") > s.max_chars).alias("truncated"), "gmap_id",
    )


def attach_place(claims: DataFrame, documents: DataFrame, branches: DataFrame) -> DataFrame:
    """claims with the branch and place their document is a review of; a claim about another store gets '' for both and
    is marked foreign. documents: source_id, place, reviewed. branches: place, branch."""
    rows = claims.drop("location", "gmap_id").join(documents, "source_id", "left").join(branches, "place", "left")
    foreign = ~F.col("store").eqNullSafe(F.col("reviewed"))
    return rows.withColumns(
        {
            "location": F.when(foreign, "").otherwise(F.coalesce("branch", F.lit(""))),
            "gmap_id": F.when(foreign, "").otherwise(F.coalesce("place", F.lit(""))),
            "foreign": foreign,
        }
    ).drop("place", "reviewed", "branch")


def rank_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")
