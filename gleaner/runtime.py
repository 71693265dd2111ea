"""Session, table and shared-folder helpers used by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_dirs: dict[str, str] = {}


def session(app: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for (UTC, AQE, skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="gleaner-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/gleaner/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{_scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_whole(spark: SparkSession, path: str, pieces: Iterable[str | tuple[str, int]]) -> int:
    """A file, whole or not at all, of texts and of the first so many bytes of other files, which the JVM copies; returns its bytes."""
    fs, p = file_system(spark, path)
    _, part = file_system(spark, f"{path}.part")
    out = fs.create(part, True)
    try:
        for piece in pieces:
            if isinstance(piece, str):
                out.write(bytearray(piece.encode()))
                continue
            other, at = file_system(spark, piece[0])
            stream = other.open(at)
            try:
                copied = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, piece[1])
            finally:
                stream.close()
            if copied != piece[1]:
                raise OSError(f"{piece[0]} ends after {copied} of {piece[1]} bytes")
        n = out.getPos()
    finally:
        out.close()
    fs.delete(p, False)
    fs.rename(part, p)
    return n


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    write_whole(spark, path, [text])


def read_pieces(spark: SparkSession, path: str, n: int = 1 << 20) -> Iterator[bytes]:
    """A file of any size, up to n bytes at a time."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        while piece := bytes(stream.readNBytes(n)):
            yield piece
    finally:
        stream.close()


def last_line(spark: SparkSession, path: str, tail: int = 1 << 16) -> list[tuple[str, int]]:
    """The last line of a file and where it begins; nothing of an empty file."""
    fs, p = file_system(spark, path)
    length = fs.getFileStatus(p).getLen()
    if not length:
        return []
    stream = fs.open(p)
    try:
        while True:
            begin = max(0, length - tail)
            stream.seek(begin)
            text = bytes(stream.readNBytes(length - begin)).rstrip(b"\n")
            at = text.rfind(b"\n") + 1
            if at or not begin:
                return [(text[at:].decode(), begin + at)]
            tail *= 4
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def release(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder; results not yet written are lost with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage through a table in the shared folder, so that a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where it comes in fewer partitions than there are (a table of one small file). For costly work on
    texts; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fingerprint(*cols: Column | str) -> list[Column]:
    """128 bits over columns as two longs; null and empty stay different."""
    parts: list[Column] = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        parts += [c, c.isNull()]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(0x5DEECE66D), *parts)]
