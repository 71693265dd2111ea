"""Queries of the operators in this package, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.canon import map_to_list
from gleaner.llm.caps import claims_beyond_cap
from gleaner.llm.lookalike import look_classes, looks_of, rewriter_of, same_look_pairs, with_consistent_form
from gleaner.llm.mix import mix
from gleaner.llm.pack import fill_report, pack_documents
from gleaner.llm.pii import found_types, redacted
from gleaner.llm.spam import spam_pages
from gleaner.runtime import load, materialise


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_beyond_cap(load(spark, sf_dir, "claims"))


_LOOKS = (("candidates", "delivery_id", "text"), ("places", "place_id", "name"))


def _looks(spark: SparkSession, sf_dir: str, table: str, key: str, column: str):
    df = load(spark, sf_dir, table)
    return looks_of(df, key, column, rewriter_of(df, column))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = [same_look_pairs(_looks(spark, sf_dir, *of)).select(F.lit(of[0]).alias("src"), "key_a", "key_b") for of in _LOOKS]
    return a.unionByName(b)


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = [look_classes(_looks(spark, sf_dir, *of)).select(F.lit(of[0]).alias("src"), "key", "look", "strings", "rows") for of in _LOOKS]
    return a.unionByName(b)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = (("claims", "location", "claim_row", "branch,city"), ("places", "city", "place_id", "city"), ("places", "address", "place_id", "street"))
    values = None
    for table, column, key, kinds in fields:
        part = load(spark, sf_dir, table).select(F.lit(f"{table}.{column}").alias("src"), F.col(key).alias("row_id"), F.col(column).alias("value"), F.lit(kinds).alias("kinds"))
        values = part if values is None else values.unionByName(part)
    return map_to_list(values, load(spark, sf_dir, "place_ref"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_types(load(spark, sf_dir, "candidates"), load(spark, sf_dir, "name_list"), "delivery_id", ["text", "parent_body"])


def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "candidates").select("delivery_id", "text", "parent_body")
    return redacted(rows, load(spark, sf_dir, "name_list"), ["text", "parent_body"])


def p4_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = load(spark, sf_dir, "places").select("place_id", "name")
    return with_consistent_form(places, "name", "form", rewriter_of(places, "name"))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "pack_sizes"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p7_packed(spark, sf_dir), load(spark, sf_dir, "pack_sizes"))


def p8_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_pages(load(spark, sf_dir, "documents"))


#: Addresses and numbers as plain as can be; what else counts is beyond SQL.
PLAIN_EMAIL = r"(^|[ (<:])[a-z0-9]+([._][a-z0-9]+)*@[a-z0-9]+([.-][a-z0-9]+)*\.[a-z]{2,8}($|[ )>,;?!\n])"
PLAIN_NUMBER = r"(^|[ (:])[1-57-9][0-9][1-9]-[0-9][1-9]-[0-9]{3}[1-9]($|[ ),;?!\n])"


def p2_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is found in texts that hold a plainly written address or number: at least its type."""
    rows = load(spark, sf_dir, "candidates")
    a, b = [rows.where(F.col("text").rlike(pattern)).select("delivery_id", F.lit(kind).alias("pii_type")) for kind, pattern in (("email", PLAIN_EMAIL), ("identity_number", PLAIN_NUMBER))]
    found = p2_found(spark, sf_dir).where("field = 'text'").select("delivery_id", "pii_type")
    return found.join(a.unionByName(b), ["delivery_id", "pii_type"], "left_semi")


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each pack: documents, parts of them that a container holds twice or not at all, containers above the capacity, and
    documents in several containers that would fit in one."""
    packed, packs = materialise(p7_packed(spark, sf_dir), "packed"), load(spark, sf_dir, "pack_sizes")
    sizes = packed.groupBy("pack_name", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("parts"), F.count_distinct("part").alias("different"), F.count_if(F.col("container").isNull() & (F.col("n_tokens") > 0)).alias("lost"))
    by_doc = sizes.join(F.broadcast(packs), "pack_name").groupBy("pack_name").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if((F.col("parts") != F.col("different")) | (F.col("lost") > 0)).alias("wrong"),
        F.count_if((F.col("parts") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("split"),
    )
    full = packed.where("container is not null").groupBy("pack_name", "container").agg(F.sum("n_tokens").alias("n")).join(F.broadcast(packs), "pack_name")
    over = full.groupBy("pack_name").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("overfull"))
    return by_doc.join(over, "pack_name").select("pack_name", "documents", "wrong", "overfull", "split")


def p8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source that has documents and a target: whether no document is used more often than allowed, and whether its
    tokens are its target share (of the targets present) but for a document of each source, which are not divided."""
    mixed, report = mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))
    most = mixed.groupBy("source").agg(F.max("copies").alias("most"), F.max("n_tokens").alias("longest"))
    rows = report.where("target_share > 0 and max_repeats > 0 and available_tokens > 0").join(F.broadcast(most), "source")
    whole = rows.agg(F.sum("target_share").alias("whole"), F.sum("mixed_tokens").alias("total"), F.sum("longest").alias("slack"))
    off = F.abs(F.col("mixed_tokens") - F.col("total") * F.col("target_share") / F.col("whole"))
    return rows.crossJoin(F.broadcast(whole)).select("source", (F.col("most") <= F.col("max_repeats")).alias("within_repeats"), (off <= F.col("slack")).alias("on_target"))


QUERIES = {
    "p2_found": p2_found,
    "p2_redacted": p2_redacted,
    "p2_plain": p2_plain,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_classes": p4_classes,
    "p4_consistent": p4_consistent,
    "p6_found": p6_found,
    "p7_packed": p7_packed,
    "p7_fill": p7_fill,
    "p7_kept": p7_kept,
    "p8_mixed": p8_mixed,
    "p8_shares": p8_shares,
    "p8_kept": p8_kept,
    "p9_found": p9_found,
}

ORACLES = {
    "p2_plain": f"""SELECT delivery_id, 'email' AS pii_type FROM candidates WHERE regexp_matches(text, '{PLAIN_EMAIL}')
        UNION ALL SELECT delivery_id, 'identity_number' FROM candidates WHERE regexp_matches(text, '{PLAIN_NUMBER}')""",
    "p7_kept": "SELECT pack_name, (SELECT count(*) FROM documents) AS documents, cast(0 AS BIGINT) AS wrong, cast(0 AS BIGINT) AS overfull, cast(0 AS BIGINT) AS split FROM pack_sizes",
    "p8_kept": "SELECT source, true AS within_repeats, true AS on_target FROM mix_targets WHERE target_share > 0 AND max_repeats > 0 AND source IN (SELECT source FROM documents WHERE length(text) > 0)",
    "p3_found": r"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY source_key, store, category, claim ORDER BY claim_row) AS copy FROM claims),
        c AS (SELECT *, regexp_replace(lower(regexp_replace(author, '^\s+|\s+$', '', 'g')), '^(/?u/|@)', '') AS handle,
            lower(regexp_replace(confidence, '^\s+|\s+$', '', 'g')) AS conf FROM d WHERE copy = 1 AND store <> ''),
        r AS (SELECT claim_row, row_number() OVER (PARTITION BY handle, store ORDER BY CASE conf WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END,
            created_utc DESC NULLS LAST, claim_row) AS rank FROM c WHERE handle IS NOT NULL AND handle NOT IN ('', '[deleted]', '[removed]'))
        SELECT claim_row FROM r WHERE rank > 8""",
}
