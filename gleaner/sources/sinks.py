"""Writing: nothing good is replaced by nothing, or by half of something."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.validation import assert_publishable
from gleaner.sources.jsonl import exists


class EmptyResultError(RuntimeError):
    pass


def _move(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{target}.old-{uuid.uuid4().hex[:8]}"
    had = fs.exists(path(target))
    if had and not fs.rename(path(target), path(old)):
        raise OSError(f"could not move {target} away")
    try:
        moved = fs.rename(path(source), path(target))
    except Exception:
        moved = False
    if not moved:
        if had:
            fs.rename(path(old), path(target))
        raise OSError(f"could not move {source} to {target}")
    fs.delete(path(old), True)


class LockedError(RuntimeError):
    pass


@contextmanager
def single_writer(spark: SparkSession, folder: str, name: str = "_lock") -> Iterator[None]:
    """Only one run may write to the folder: its lock file is made as one step, and goes with the run. A lock that a dead
    run has left is for a person to delete."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    try:
        fs.create(p, False).close()
    except Py4JJavaError as e:
        raise LockedError(f"another run writes to {folder}; if none does, delete {name} there") from e
    try:
        yield
    finally:
        fs.delete(p, False)


def publish(df: DataFrame, path: str, *, fmt: str = "parquet", allow_empty: bool = False, links: str | None = None, check: bool = False) -> None:
    """Write beside, look at what was written, then swap. An empty result leaves the old one in place and is an error."""
    spark = df.sparkSession
    staged = f"{path}.part-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).option("ignoreNullFields", "false").save(staged)
    written = spark.read.schema(df.schema).format(fmt).load(staged)
    try:
        if not allow_empty and written.isEmpty():
            raise EmptyResultError(f"nothing to publish at {path}")
        if check:
            assert_publishable(written, links)
        _move(spark, staged, path)
    finally:
        if exists(spark, staged):
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def publish_window(df: DataFrame, path: str, key: str) -> None:
    """Replace only the partitions of `key` that df has; a month still open is so written again until it closes."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def corpus_tag(path: str) -> str:
    """A short tag that keeps the ledgers of corpora apart."""
    return hashlib.sha256(path.encode()).hexdigest()[:6]


def manifest(spark: SparkSession, path: str, **facts: object) -> None:
    """One row of run facts."""
    spark.createDataFrame([{k: str(v) for k, v in facts.items()}]).coalesce(1).write.mode("overwrite").json(path)


def keep_last(df: DataFrame, order: str, most: int = 60) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(most)
