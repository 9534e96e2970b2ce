"""Sharding by proportional stratified interleaving (DataFrame operations only).

Rows of each source (stratum) are put in a seeded random order. The row of
rank r (from 1) among the n of its source stands at (2r - 1) / 2n, so every
source is spread evenly over (0, 1). All rows in the order of that place, cut
into runs of equal count, give shards that each match the mixture of sources
to within one or two rows a source. The law is ``rows``: counts differ by one
at most.

Ranks come from counts per bucket (``rank_in_order``), so a source that holds
a third of all rows is spread over as many buckets as any. The texts are only
read for their size and checksum and never shuffled.

Defined cases: null sources form one stratum; a null text has size 16 and the
checksum of no bytes; a null id is ordered as the text ``null``; repeated
rows are rows like others (which of two equal rows comes first can't be
seen); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rank_in_order, table

N_SHARDS = 40
SEED = "shard-order-1"
#: Rows of one bucket of the order, on average, at most.
BUCKET_ROWS = 50_000


def interleave(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
               n_shards: int = N_SHARDS, seed: str = SEED) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, source) for every row."""
    n = docs.count()
    digits = 2  # hex digits of a bucket's name: 256 buckets a source, more for more rows
    while n > BUCKET_ROWS * 16 ** digits:
        digits += 1
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s:"), F.col(source).cast("string"))).alias("_stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary")).alias("_h"))
    rows = rows.withColumn("_bucket", F.substring("_h", 1, digits))
    tie = [F.col("_h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranked = rank_in_order(rows, ["_stratum"], "_bucket", tie, "_r")
    sizes = rows.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_ns"))
    placed = (ranked.join(sizes, "_stratum")
              .withColumn("_place", (2 * F.col("_r") + 1) / (2 * F.col("_ns")).cast("double"))
              .withColumn("_bucket", F.floor(F.col("_place") * 16 ** digits)))
    order = [F.col("_place"), F.col("_stratum"), *tie]
    at = rank_in_order(placed.withColumn("_all", F.lit(0)), ["_all"], "_bucket", order, "_at")
    shard = F.expr(f"_at * {n_shards} div {max(n, 1)}")
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        (F.col("_at") - F.expr(f"(({shard_of('_at', n_shards, n)}) * {max(n, 1)} + {n_shards - 1}) div {n_shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("_stratum").alias("stratum"))


def shard_of(at: str, n_shards: int, n: int) -> str:
    return f"{at} * {n_shards} div {max(n, 1)}"


def query(spark, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents")).drop("stratum")
