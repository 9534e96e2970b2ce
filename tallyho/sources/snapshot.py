"""Snapshot sources: JSON rows, JSON arrays or Parquet tables, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import METRIC, METRIC_JSON
from ..sinks.snapshot import current_path
from .json_array import json_objects


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _resolve(spark: SparkSession, path: str) -> str | None:
    """A versioned snapshot location resolves through its pointer; a plain
    file or directory is read as it is; a missing one gives None."""
    cur = current_path(spark, path) if _exists(spark, path) else None
    if cur:
        return cur
    return path if _exists(spark, path) else None


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METRIC)


def _starts_with_array(spark: SparkSession, path: str) -> bool:
    """Whether the first file below ``path`` that is not empty starts with a bracket."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [p] if fs.getFileStatus(p).isFile() else sorted(
        (st.getPath() for st in fs.listStatus(p) if st.isFile() and st.getLen() and st.getPath().getName()[0] not in "._"),
        key=lambda q: q.getName())
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    for f in files[:1]:
        stream, codec = fs.open(f), codecs.getCodec(f)
        try:
            stream = codec.createInputStream(stream) if codec else stream
            c = stream.read()
            while c in (9, 10, 13, 32, 0xEF, 0xBB, 0xBF):
                c = stream.read()
            return c == 91
        finally:
            stream.close()
    return False


def read_snapshot_json(spark: SparkSession, path: str, layout: str = "auto", with_at: bool = False) -> DataFrame:
    """Read a JSON snapshot: an object a line (``lines``), or arrays (``array``: on one line,
    what a single-node dump writes, or over many; read in byte ranges). Missing or empty
    ⇒ empty state. ``auto`` looks at the first file's first character.

    ``with_at`` adds each row's place, ascending in file order: (file, byte range, row)."""
    p = _resolve(spark, path)
    if p is None:
        empty = empty_state(spark)
        return empty.withColumn("at", F.lit(None).cast("struct<path:string,block:bigint,n:bigint>")) if with_at else empty
    if layout == "array" or layout == "auto" and _starts_with_array(spark, p):
        rows = json_objects(spark, p).select(F.from_json("json", METRIC_JSON).alias("_m"), F.struct("path", "block", "n").alias("at"))
        df = rows.select("_m.*", "at")
    else:
        df = spark.read.schema(METRIC_JSON).json(p)
        if with_at:
            df = df.select("*", F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("n")).alias("at"))
    return df.select("id", F.col("type").alias("mtype"), "delta", "value",
                     F.coalesce(F.col("hash"), F.lit("")).alias("hash"), *(["at"] if with_at else []))


def read_snapshot_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a persisted Parquet snapshot; a null hash reads as ''."""
    p = _resolve(spark, path)
    if p is None:
        return empty_state(spark)
    df = spark.read.schema(METRIC).parquet(p)
    return df.select("id", "mtype", "delta", "value", F.coalesce(F.col("hash"), F.lit("")).alias("hash"))
