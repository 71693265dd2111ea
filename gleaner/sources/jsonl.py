"""Line-delimited JSON: scans with a count of what did not parse, shards with fields from their path, ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.functions.text import strip
from gleaner.operators import validation as val

RAW = "id string, created_utc bigint, author string, parent_id string, score bigint, body string, title string, selftext string, permalink string, link_id string"
CANDIDATE = (
    "id string, subreddit string, kind string, created_utc bigint, score bigint, author string, parent_body string, permalink string, stores array<string>,"
    " text string, truncated boolean"
)
CLAIM = (
    "store string, location string, category string, item string, claim string, sentiment string, price_signal string, confidence string, comparator_store string,"
    " transient boolean, source_id string, source_key string, subreddit string, kind string, permalink string, author string, created_utc bigint, score bigint, gmap_id string"
)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, v: each line that isn't blank, and it parsed (null where it does not). Gzip is read as it is."""
    return spark.read.text(path).where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))


def read_valid(spark: SparkSession, path: str, schema: str, ok) -> tuple[DataFrame, DataFrame]:
    """(rows, one row with n_dropped) of the lines whose value passes ok."""
    good, dropped = val.split_valid(read_lines(spark, path), ok(F.col("v")))
    return good.select(F.from_json("value", schema).alias("r")).select("r.*"), dropped


def read_candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_valid(spark, path, CANDIDATE, val.candidate_ok)


def read_claims(spark: SparkSession, path: str, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Claims in file order: claim_row numbers the lines (file by file), as first ones win later on."""
    lines = read_lines(spark, path).withColumn("claim_row", F.monotonically_increasing_id())
    good, dropped = val.split_valid(lines, val.claim_ok(F.col("v"), s))
    return good.select("claim_row", F.from_json("value", CLAIM).alias("r")).select("claim_row", "r.*"), dropped


def read_shards(spark: SparkSession, root: str, subreddits: list[str] | None = None) -> DataFrame:
    """Raw documents of root/<kind>/<subreddit>/<window>.ndjson.gz with kind, subreddit, window, shard and ord (place in
    the shard); lines that don't parse are left out. Only the paths of wanted subreddits are listed and opened; one
    that has no shard is an error."""
    paths = [f"{root}/*/{x}/*.ndjson.gz" for x in subreddits] if subreddits else [f"{root}/*/*/*.ndjson.gz"]
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"no shards at {', '.join(missing)}")
    rows = spark.read.text(paths).select("value", F.input_file_name().alias("shard"), F.monotonically_increasing_id().alias("ord"))
    part = lambda i: F.regexp_extract("shard", r"([^/]+)/([^/]+)/([^/]+)\.ndjson\.gz$", i)
    parsed = rows.where(F.try_parse_json("value").isNotNull()).withColumn("r", F.from_json("value", RAW)).where(F.col("r").isNotNull())
    return parsed.select("r.*", part(1).alias("kind"), part(2).alias("subreddit"), part(3).alias("window"), "shard", "ord")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Labelled cases; a line that does not parse is fatal, ids that start with # are parked."""
    schema = "id string, why string, text string, parent_body string, stores array<string>, expected array<struct<store:string,category:string,sentiment:string,price_signal:string,confidence:string,transient:boolean,comparator_store:string>>"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).where(~F.col("id").startswith("#"))


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """The keys of a ledger; without one there are none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "key string")
    return spark.read.text(path).select(F.trim("value").alias("key")).where("key <> ''").distinct()


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of a map extract (one JSON document), in their order."""
    schema = "elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("elements").alias("ord", "e")).select("ord", "e.*")


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Ratings with the length of their text in place of it; without rating or time none."""
    schema = "store string, gmap_id string, rating double, time bigint, text string"
    rows = spark.read.schema(schema).json(path).where("rating is not null and time is not null")
    return rows.select("store", "gmap_id", "rating", "time", F.length(strip(F.coalesce("text", F.lit("")))).alias("text_len"))


def read_review_texts(spark: SparkSession, path: str) -> DataFrame:
    """Reviews with their text and writer, of all ratings; lines that don't parse, and those without a place, are left out."""
    return spark.read.schema("store string, gmap_id string, rating double, time bigint, user_id string, text string").json(path).where("gmap_id is not null")


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row: a JSON document (verdicts, places, a cross-check) that is one file. Null fields where the document lacks them;
    an error where it does not parse."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_history(texts: DataFrame, column: str) -> DataFrame:
    """at, store, name, qty, price: the lines of kept receipts, each row of the column being one JSON list of receipts. What is
    no list has none, nor have receipts without a list of lines."""
    receipt = "array<struct<at:bigint,store:string,lines:array<struct<name:string,qty:int,price:double>>>>"
    kept = texts.where(F.schema_of_variant(F.try_parse_json(column)).startswith("ARRAY")).select(F.explode(F.from_json(column, receipt)).alias("r")).where("r.lines is not null")
    return kept.select("r.at", "r.store", F.explode("r.lines").alias("l")).select("at", "store", "l.name", "l.qty", "l.price")


def optional(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A parquet table, or an empty one where there is none."""
    if path and exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)
