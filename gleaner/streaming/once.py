"""Messages delivered more than once: exactly one copy of each.

A streaming query keeps, per message, the lowest delivery seen so far in a keyed state store; a delivery is accepted when
it is that lowest one, and is a redelivery otherwise. State of messages whose event time has fallen behind the watermark
expires. Deliveries of such messages are late: these, and only these, are looked up in the log of accepted messages,
of which only the years of the late rows are read. Log, state and source offsets are committed by micro-batch: a replayed
micro-batch starts from the state before it and writes its own folder of the log again, so output and state stay in step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions.text import epoch_seconds, message_key
from gleaner.runtime import file_system, read_text, scratch_path, write_text

#: shelf: the year of the event time of an accepted message; AGAIN holds the redeliveries.
LOG_SCHEMA = "scope string, message string, delivery bigint, batch int, shelf int"
AGAIN = -1_000_000


@dataclass(frozen=True)
class OnceSettings:
    """delay: how far event time may lag behind the latest before state expires. window: granularity of expiry.
    files_per_batch: files of the source that one micro-batch reads. slices: where above 0, the table's deliveries are
    first laid out as so many files in their order of arrival, whatever files the table has."""

    delay: str = "30 days"
    window: str = "1 day"
    files_per_batch: int = 256
    slices: int = 0


#: A table read as it arrived, in several micro-batches.
ARRIVALS = OnceSettings(files_per_batch=1, slices=4)


@dataclass
class Progress:
    """What the micro-batches did: number, late rows, shelves of the log that were read."""

    batches: list[tuple[int, int, list[int]]] = field(default_factory=list)
    #: Called after a micro-batch's folder of the log is complete and before it is committed (tests stop it there).
    logged: Callable[[int], None] = lambda number: None


def _narrow(df: DataFrame, scope: Column, identifier: Column, event: Column, order: Column) -> DataFrame:
    return df.select(
        scope.alias("scope"),
        message_key(identifier).alias("message"),
        F.timestamp_seconds(F.coalesce(epoch_seconds(event), F.lit(0))).alias("event_at"),
        order.cast("bigint").alias("delivery"),
    ).where(F.col("message").isNotNull() & F.col("delivery").isNotNull())


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def accept_once(
    stream: DataFrame,
    log_path: str,
    checkpoint: str,
    *,
    scope: str = "kind",
    identifier: str = "id",
    event: str = "created_utc",
    order: str = "delivery_id",
    settings: OnceSettings = OnceSettings(),
    progress: Progress | None = None,
):
    """Start the query over a stream of deliveries; it ends when all that is there has been read.

    The log receives every delivery with a message identifier: on the shelf of its year where it is the lowest of its
    message so far, as a redelivery otherwise. Deliveries without identifier are not messages and are not logged. A null
    event time counts as the epoch. Extra columns are not read.
    """
    spark = stream.sparkSession
    done = progress or Progress()
    source = _narrow(stream, F.col(scope), F.col(identifier), F.col(event), F.col(order)).withWatermark("event_at", settings.delay)
    span = F.window("event_at", settings.window)
    lowest = (
        source.groupBy("scope", "message", span.alias("span"))
        .agg(F.min("delivery").alias("delivery"))
        .select("scope", "message", F.col("span.start").alias("event_at"), F.col("span.end").alias("until"), "delivery", F.lit(True).alias("decided"))
    )
    # both what the state says and the deliveries themselves
    lanes = lowest.unionByName(source.select("scope", "message", "event_at", span["end"].alias("until"), "delivery", F.lit(False).alias("decided")))
    delay = _seconds(settings.delay)
    clock: dict[int, int | None] = {}

    def write(batch: DataFrame, number: int) -> None:
        horizon = clock[number - 1] if number - 1 in clock else _logged_clock(spark, log_path, number)
        late = F.lit(False) if horizon is None else F.unix_timestamp("until") <= horizon - delay
        watch = Observation()
        marked = batch.withColumns({"late": late, "shelf": F.year("event_at")}).observe(
            watch, F.max(F.unix_timestamp("event_at")).alias("latest"), F.count_if(F.col("late") & ~F.col("decided")).alias("late"),
            F.collect_set(F.when(F.col("late"), F.col("shelf"))).alias("shelves"),
        )
        staged = marked.select("scope", "message", "delivery", "decided", "shelf", "late")
        stage = f"{log_path}_stage/batch={number}"
        staged.write.mode("overwrite").parquet(stage)
        rows = spark.read.schema(staged.schema).parquet(stage)
        seen = watch.get
        shelves = sorted(seen.get("shelves") or [])
        decided = rows.where("decided and not late").select("delivery")
        if seen.get("late"):
            decided = decided.unionByName(_looked_up(spark, rows.where("late and not decided"), log_path, number, shelves))
        # a delivery stays if it is one of the decided ones; both sides are unique, so no key is hot
        out = rows.where("not decided").join(decided.distinct().withColumn("stays", F.lit(True)), "delivery", "left")
        shelved = out.select("scope", "message", "delivery", F.when(F.col("stays"), F.col("shelf")).otherwise(AGAIN).alias("shelf"))
        shelved.write.partitionBy("shelf").mode("overwrite").parquet(f"{log_path}/batch={number}")
        # the latest event time of this and all earlier micro-batches
        clock[number] = max((t for t in (seen.get("latest"), horizon) if t is not None), default=None)
        write_text(spark, f"{log_path}_clock/{number}", "" if clock[number] is None else str(clock[number]))
        _delete(spark, stage)
        done.batches.append((number, seen.get("late") or 0, shelves))
        done.logged(number)

    return (
        lanes.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _looked_up(spark: SparkSession, late: DataFrame, log_path: str, number: int, shelves: list[int]) -> DataFrame:
    """delivery of the late messages that the log does not know, or knows only with a higher delivery. A copy of a message
    has its event time, so only the shelves of the late rows are read."""
    lowest = late.groupBy("scope", "message").agg(F.min("delivery").alias("delivery"))
    if number == 0 or not _exists(spark, log_path):
        return lowest.select("delivery")
    known = _log(spark, log_path).where((F.col("batch") < number) & F.col("shelf").isin(shelves))
    known = known.groupBy("scope", "message").agg(F.min("delivery").alias("before"))
    met = lowest.alias("l").join(known.alias("k"), F.col("l.scope").eqNullSafe(F.col("k.scope")) & (F.col("l.message") == F.col("k.message")), "left")
    return met.where("before is null or delivery < before").select("delivery")


def _logged_clock(spark: SparkSession, log_path: str, number: int) -> int | None:
    """After a restart: the latest event time up to the micro-batch before this one."""
    if number == 0:
        return None
    text = read_text(spark, f"{log_path}_clock/{number - 1}")
    return int(text) if text else None


def _log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("basePath", log_path).parquet(log_path)


def _ranked(spark: SparkSession, log_path: str) -> DataFrame:
    """The accepted rows of the log, with their place among those of their message: a message has one, and a further one
    only where a lower delivery came later or its copies have different event times."""
    rows = _log(spark, log_path).where(F.col("shelf") != AGAIN)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("scope", "message").orderBy("delivery")))


def accepted(spark: SparkSession, log_path: str) -> DataFrame:
    """scope, message, kept: the accepted messages of the log with the lowest delivery of each."""
    return _ranked(spark, log_path).where("place = 1").select("scope", "message", F.col("delivery").alias("kept"))


def redelivered(spark: SparkSession, log_path: str) -> DataFrame:
    """delivery of every redelivery: those found as such, and those accepted before a lower one came."""
    again = _log(spark, log_path).where(F.col("shelf") == AGAIN).select("delivery")
    return again.unionByName(_ranked(spark, log_path).where("place > 1").select("delivery"))


def run_once(spark: SparkSession, path: str, settings: OnceSettings = OnceSettings(), progress: Progress | None = None, base: str | None = None, **columns: str) -> str | None:
    """Run the query over the parquet table at path to its end; returns the path of the log, None where nothing came.
    base: the folder of log and checkpoint; with one that a query was stopped in, it goes on from there."""
    # a session of its own: the state store's provider is a session setting
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    schema = spark.read.parquet(path).schema
    base = base or scratch_path(spark, "once")
    if settings.slices:
        needed = {"scope": "kind", "identifier": "id", "event": "created_utc", "order": "delivery_id"} | columns
        table = spark.read.parquet(path).select(*dict.fromkeys(needed.values()))
        if not _exists(spark, f"{base}/arrivals/_SUCCESS"):
            _lay_out(table.where(F.col(needed["order"]).isNotNull()), needed["order"], settings.slices, f"{base}/arrivals")
        schema, path = table.schema, f"{base}/arrivals"
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", settings.files_per_batch).parquet(_stream_path(spark, path))
    query = accept_once(stream, f"{base}/log", f"{base}/state", settings=settings, progress=progress, **columns)
    query.awaitTermination()
    return f"{base}/log" if _exists(spark, f"{base}/log") else None


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _lay_out(table: DataFrame, order: str, slices: int, path: str) -> None:
    """Write the table as up to so many files, by ranges of order; their ages rise with it, as a stream reads by age."""
    spark = table.sparkSession
    table.repartitionByRange(slices, order).write.option("maxRecordsPerFile", 0).parquet(path)
    fs, folder = file_system(spark, path)
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    last = max((fs.getFileStatus(p).getModificationTime() for p in files), default=0)
    for i, p in enumerate(files):
        fs.setTimes(p, last - 1000 * (len(files) - 1 - i), -1)


def _stream_path(spark: SparkSession, path: str) -> str:
    """A stream reads folders or patterns; a table that is one file is given as a pattern which only that file meets."""
    fs, p = file_system(spark, path)
    return path if fs.getFileStatus(p).isDirectory() else f"{path[:-1]}[{path[-1]}]"


def deliver_once(spark: SparkSession, path: str, settings: OnceSettings = OnceSettings(), **columns: str) -> DataFrame:
    """scope, message, kept: the delivery that stays of each message in the parquet table at path."""
    log = run_once(spark, path, settings, **columns)
    return accepted(spark, log) if log else spark.createDataFrame([], "scope string, message string, kept bigint")


def redeliveries(spark: SparkSession, path: str, settings: OnceSettings = ARRIVALS) -> DataFrame:
    """delivery_id of every delivery but the lowest of its message; rows without identifier (null or blank) are none.

    They are read from the query's own output. Rows of equal delivery_id count as one delivery. An empty table gives none;
    other columns are not looked at.
    """
    log = run_once(spark, path, settings)
    if log is None:
        return spark.createDataFrame([], "delivery_id bigint")
    return redelivered(spark, log).select(F.col("delivery").alias("delivery_id"))


def once(spark: SparkSession, path: str, settings: OnceSettings = ARRIVALS) -> DataFrame:
    """The table, all its columns, with exactly one row per message; rows without identifier or delivery_id all stay."""
    kept = deliver_once(spark, path, settings).select(F.col("kept").alias("delivery_id"))
    rows = spark.read.parquet(path)
    nameless = message_key(F.col("id")).isNull() | F.col("delivery_id").isNull()
    return rows.where(~nameless).join(kept, "delivery_id", "left_semi").unionByName(rows.where(nameless))
