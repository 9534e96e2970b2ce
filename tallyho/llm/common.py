"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

#: Bytes of one Arrow batch sent to a Python worker: long texts make small batches.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes (not only the rows) of an Arrow batch, unless the session
    already has a tighter bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key))
    except Exception:  # the setting holds a unit, or this build lacks it
        now = 1 << 40
    if now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: evaluated once, lineage
    cut, safe when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables written by ``saved`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.saved_path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def worker_state(key: str, make: Callable[[], object]):
    """A value kept for the life of a Python worker process, across tasks."""
    mod = sys.modules.setdefault("tallyho_worker_state", types.ModuleType("tallyho_worker_state"))
    if not hasattr(mod, key):
        setattr(mod, key, make())
    return getattr(mod, key)


class Memo(dict):
    """Remembered results of ``make(key)``, at most about twice ``most`` of them: the
    older half is dropped at once, and what is used again moves to the newer one."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the documents kept out of all training: crc32(doc_id as text) mod 5 = 0.
    A null id is not held out and is never trained on."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def rank_in_order(df: DataFrame, group: Iterable[str], bucket: str, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: the row's 0-based rank in its group, by ``bucket`` then ``order``.

    No group passes through one task: rows are numbered within their bucket,
    and each bucket starts where the counts of the buckets before it end. Only
    those counts (one row a bucket) are summed along a group.
    """
    keys = [*group, bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (df.withColumn("_within", within).join(starts, keys)
            .withColumn(out, (F.col("_start") + F.col("_within") - 1).cast("long"))
            .drop("_start", "_within"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long ids).

    Alternating large-star and small-star rounds (each a min per node and a
    join), each written to the shared folder. Ends when a round changes
    nothing; every node then points at the least id of its component. A hub
    is only ever aggregated or joined on, never gathered into a list.
    """
    def mark(df):
        r = df.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    cur = saved(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "cc")
    seen = mark(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = cur.union(cur.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = (both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct())
        large = saved(large, "cc")
        free(cur)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
                 .union(least.selectExpr("u", "m AS v")).distinct())
        cur = saved(small, "cc")
        free(large)
        now = mark(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node")).distinct()
    return cur.selectExpr("u AS node", "v AS component").union(roots.selectExpr("node", "node AS component"))
