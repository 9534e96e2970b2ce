"""What became of the requests of a stream: counts per micro-batch, refused bodies kept.

Counts are Spark's observed metrics: they ride along with the rows that the stream
passes on, and come out with each micro-batch's progress. The refused requests go,
with their code, to files of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import (BAD_CONTENT_TYPE, BAD_GZIP, BAD_SIGNATURE, EMPTY_NAME, EMPTY_VALUE, PARSE_ERROR, UNKNOWN_TYPE)

#: Codes that a batch request may be refused with.
CODES = (BAD_SIGNATURE, BAD_GZIP, BAD_CONTENT_TYPE, PARSE_ERROR, EMPTY_NAME, UNKNOWN_TYPE, EMPTY_VALUE)
OUTCOMES, ADMITTED = "outcomes", "admitted"


def observed(decoded: DataFrame, code: str = "code", name: str = OUTCOMES) -> DataFrame:
    """The same rows, one a request; the number admitted and refused by code is observed."""
    return decoded.observe(name, F.count_if(F.col(code).isNull()).alias(ADMITTED),
                           *(F.count_if(F.col(code) == c).alias(c) for c in CODES))


def outcome_counts(query, name: str = OUTCOMES) -> dict[str, int]:
    """Requests by outcome over the micro-batches that the query still tells of
    (``spark.sql.streaming.numRecentProgressUpdates``)."""
    total = dict.fromkeys((ADMITTED, *CODES), 0)
    for p in query.recentProgress:
        row = p.observedMetrics.get(name)
        for k, v in (row.asDict() if row is not None else {}).items():
            total[k] += v
    return total


def start_refused_stream(decoded: DataFrame, path: str, checkpoint: str, code: str = "code", trigger: dict | None = None):
    """Keep every refused request (all its columns and its code) as Parquet below ``path``, by code,
    and observe the counts. Returns the ``StreamingQuery``."""
    w = (observed(decoded, code).where(F.col(code).isNotNull()).writeStream.format("parquet").partitionBy(code)
         .option("path", path).option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()
