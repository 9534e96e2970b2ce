"""Snapshot sinks: JSON rows and Parquet tables, committed as new versions.

Layout of a snapshot location::

    <base>/v=<number>-<token>/part-*     one directory per version
    <base>/_versions/<number>            its commit: names the directory and how
                                         far each stream has got

A write goes to a fresh directory (Spark's output commit makes it appear
whole). Its commit has the number after the one that the write started from
and is created only if no file of that number exists, so of two writers that
start from the same version one commits and the other fails with
``CommitConflict``: no update is lost silently. The current version is the
greatest number. A commit is never replaced, so a driver or executor lost at
any point leaves either the old or the new version current. ``keep`` removes
all but the last versions after a commit, so a location does not grow.

Needs a file system with an atomic create-if-absent (HDFS, local files).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_versions"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version this write started from."""


@dataclass(frozen=True)
class Commit:
    """A committed version: its number, its directory, and the last epoch of each stream in it."""

    number: int
    path: str
    epochs: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file through the cluster file system (None if missing)."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return line.strip() if line else None


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; False if there is one already. The text is written
    beside it and given the name by a rename that does not replace."""
    fs, p, jvm = _fs(spark, path)
    if fs.exists(p):
        return False
    part = jvm.org.apache.hadoop.fs.Path(f"{p.getParent().toString()}/.{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        # FileContext.rename fails if the target exists
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(),
                                                            spark.sparkContext._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(part), fs.makeQualified(p), spark.sparkContext._gateway.new_array(
                jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as e:  # py4j wraps the Java error
        if "already exists" in str(e) or "FileAlreadyExists" in str(e) or fs.exists(p):
            fs.delete(part, False)
            return False
        raise


def numbers(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the commits that are kept, ascending."""
    fs, _, jvm = _fs(spark, base)
    d = jvm.org.apache.hadoop.fs.Path(f"{base}/{COMMITS}")
    if not fs.exists(d):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(d)]
    return sorted(int(n) for n in names if n.isdigit())


def read_commit(spark: SparkSession, base: str, number: int | None = None) -> Commit | None:
    """The current version of a location (or that of a number), or None."""
    if number is None:
        kept = numbers(spark, base)
        if not kept:
            return None
        number = kept[-1]
    text = read_text(spark, f"{base}/{COMMITS}/{number:020d}")
    if text is None:
        return None
    d = json.loads(text)
    return Commit(number, f"{base}/{d['dir']}", d.get("epochs", {}))


def start_version(spark: SparkSession, base: str) -> tuple[Commit | None, str]:
    """(the version that a write starts from, the fresh directory that it writes to)."""
    at = read_commit(spark, base)
    return at, f"{base}/v={(at.number if at else 0) + 1:020d}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, base: str, start: Commit | None, path: str, epochs: dict | None = None,
           keep: int | None = None) -> Commit:
    """Make ``path`` the current version, if ``start`` still is it."""
    number = (start.number if start else 0) + 1
    fs, _, jvm = _fs(spark, base)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{base}/{COMMITS}"))
    epochs = {**(start.epochs if start else {}), **(epochs or {})}
    text = json.dumps({"dir": path.rsplit("/", 1)[1], "epochs": epochs})
    latest = numbers(spark, base)
    if (latest and latest[-1] >= number) or not write_text(spark, f"{base}/{COMMITS}/{number:020d}", text):
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)
        raise CommitConflict(f"version {number} of {base} was committed by another writer")
    if keep is not None:
        for old in numbers(spark, base)[:-max(1, keep)]:
            c = read_commit(spark, base, old)
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{COMMITS}/{old:020d}"), False)
            if c is not None:
                fs.delete(jvm.org.apache.hadoop.fs.Path(c.path), True)
    return Commit(number, path, epochs)


def current_path(spark: SparkSession, base: str) -> str | None:
    c = read_commit(spark, base)
    return c.path if c else None


def metric_json_columns(df: DataFrame) -> DataFrame:
    """State rows in wire form: ``id,type,delta,value,hash``; an empty hash
    becomes null so the writer omits it, like the other empty fields."""
    return df.select(
        "id", F.col("mtype").alias("type"), "delta", "value",
        F.when(F.col("hash") != "", F.col("hash")).alias("hash"))


def _refuse_non_finite(df: DataFrame) -> DataFrame:
    # JSON has no NaN/Inf: the whole dump fails rather than writing them
    bad = F.isnan("value") | (F.abs(F.col("value")) == F.lit(float("inf")))
    return df.filter(F.when(F.coalesce(bad, F.lit(False)),
                            F.raise_error(F.concat(F.lit("non-finite gauge in snapshot: "), F.col("id"))))
                      .otherwise(F.lit(True)))


_LATEST = object()


def _write(spark: SparkSession, base: str, start, keep: int | None, write) -> str:
    now, path = start_version(spark, base)
    write(path)
    commit(spark, base, now if start is _LATEST else start, path, keep=keep)
    return path


def write_snapshot_json(state: DataFrame, base: str, start=_LATEST, compression: str | None = None,
                        keep: int | None = None) -> str:
    """Replace the snapshot (all keys) with ``state``; returns the version's path.

    ``start`` is the version (``read_commit``) that ``state`` was computed from;
    without it the one that is current now. ``keep`` versions stay (default all)."""
    w = metric_json_columns(_refuse_non_finite(state)).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    return _write(state.sparkSession, base, start, keep, w.json)


#: Parquet Bloom filters on the id, as large as the ids of a row group need.
BLOOM = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def write_table_version(state: DataFrame, path: str) -> None:
    """Parquet layout of a state version: one directory per kind, rows sorted
    by id inside each file (a local sort, no shuffle), so a point lookup
    reads one kind and skips row groups by their id min/max and Bloom filter."""
    (state.sortWithinPartitions("mtype", "id")
     .write.mode("overwrite").options(**BLOOM).partitionBy("mtype").parquet(path))


def write_snapshot_table(state: DataFrame, base: str, start=_LATEST, keep: int | None = None) -> str:
    """Persist the state as a Parquet version (see ``write_snapshot_json``)."""
    rows = state.select("id", "mtype", "delta", "value", "hash")
    return _write(state.sparkSession, base, start, keep, lambda path: write_table_version(rows, path))


def compressible(content_type: str) -> str:
    """SQL: whether a response of this type is compressed (JSON and HTML only)."""
    return f"({content_type} LIKE '%application/json%' OR {content_type} LIKE '%text/html%')"


def signed_payloads(bodies: DataFrame, key: str, body: str = "body", content_type: str = "content_type",
                    accepts: str | None = None) -> DataFrame:
    """Bodies as they are sent: compressed where their type allows it (and ``accepts``,
    a column, names gzip), then signed over the bytes that are sent. Replaces
    ``body`` by ``payload`` and adds ``content_encoding`` and ``signature``."""
    from ..functions.codec import gzip_compress
    from ..functions.signing import sign_sql
    from ..operators.common import materialize

    zipped = compressible(f"coalesce({content_type}, '')") + (f" AND contains(coalesce({accepts}, ''), 'gzip')" if accepts else "")
    keep = [f"`{c}`" for c in bodies.columns if c != body]
    d = bodies.selectExpr(*keep, f"CAST({body} AS BINARY) AS _plain", f"{zipped} AS _z")
    d = materialize(d.withColumn("_gz", gzip_compress(F.expr("CASE WHEN _z THEN CAST(_plain AS STRING) END"))))
    d = d.selectExpr(*keep, "CASE WHEN _z THEN _gz ELSE _plain END AS payload", "CASE WHEN _z THEN 'gzip' ELSE '' END AS content_encoding")
    return d.selectExpr("*", f"{sign_sql('payload', key)} AS signature")
