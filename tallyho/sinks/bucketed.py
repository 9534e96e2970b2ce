"""State versions in buckets of the key: joins on the key move the other side only.

A version is written in Spark's own bucketed layout (hash of id and kind, sorted
within a bucket) and read as a table of the session's catalog, which is what
tells the planner of the layout. Lookups and merges then read each bucket where
it is and shuffle only the requests or the new rows into as many partitions. The
versions are committed like all others (``sinks.snapshot``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from . import snapshot as sk

KEYS = ("id", "mtype")
COLUMNS = "id STRING, mtype STRING, delta BIGINT, value DOUBLE, hash STRING"
BUCKETS = "_buckets"


def _name(path: str) -> str:
    return f"tallyho_state_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def write_bucketed(state: DataFrame, base: str, buckets: int, start=sk._LATEST, keep: int | None = None) -> str:
    """Replace the snapshot with ``state``, in ``buckets`` buckets; returns the version's path.
    Choose as many as a shuffle has partitions: joins then need no more of either."""
    spark = state.sparkSession

    def write(path: str) -> None:
        name = _name(path) + "_new"
        (state.select("id", "mtype", "delta", "value", "hash").write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
         .options(**sk.BLOOM).option("path", path).mode("overwrite").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")  # its files stay: the version is theirs
        sk.write_text(spark, f"{path}/{BUCKETS}", str(buckets))

    return sk._write(spark, base, start, keep, write)


def read_bucketed(spark: SparkSession, base: str) -> DataFrame:
    """The current version as a bucketed table."""
    at = sk.read_commit(spark, base)
    buckets = sk.read_text(spark, f"{at.path}/{BUCKETS}") if at else None
    if buckets is None:
        raise ValueError(f"{base} has no version in buckets")
    name, path = _name(at.path), at.path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY ({', '.join(KEYS)}) "
              f"SORTED BY ({', '.join(KEYS)}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)
