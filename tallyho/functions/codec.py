"""gzip for payload columns (Arrow-batched pandas UDFs).

Spark reads and writes ``.gz`` files natively; these are only for bodies held
in a BINARY column. A body that is not valid gzip decodes to null.
"""

from __future__ import annotations

import gzip
import sys as _sys

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of
from .elements import Broken, inflate

# The UDFs below travel to the Python workers by value (with the module's
# helpers), so executors need only numpy/pandas, not this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


#: Bytes of an inflated body, at most: it is held in one row. Larger ones are read
#: element by element (``sources.large_bodies``).
MOST = 512 << 20


def _gunzip_one(b, most):
    if b is None:
        return None
    out = bytearray()
    try:
        for piece in inflate(bytes(b)):
            out += piece
            if len(out) > most:
                raise ValueError(f"a body of {len(b)} bytes inflates beyond {most} bytes: decode it as a large body")
    except Broken:
        return None
    return bytes(out)


def _gunzip_udf(most):
    @F.pandas_udf(T.BinaryType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: _gunzip_one(b, most))

    return run


@F.pandas_udf(T.BinaryType())
def _gzip_udf(s: pd.Series) -> pd.Series:
    # mtime=0: the same body always compresses to the same bytes
    return s.map(lambda b: None if b is None else gzip.compress(bytes(b), mtime=0))


def gunzip(c, most: int = MOST) -> Column:
    """Content of gzip bodies (members are joined); null where a body is not valid gzip. It is
    inflated piece by piece, and one beyond ``most`` bytes fails the job with its size
    before it can fill a worker: it is never taken for a broken one."""
    return _gunzip_udf(most)(col_of(c))


def gzip_compress(c) -> Column:
    return _gzip_udf(col_of(c).cast("binary"))
