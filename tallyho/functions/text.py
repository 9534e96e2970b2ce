"""Text forms of metric values and report lines."""

from __future__ import annotations

import math
import sys as _sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of

# The UDFs below travel to the Python workers by value (with the module's
# helpers), so executors need only numpy/pandas, not this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])


def _plain(x: float) -> str:
    # shortest round-trip digits in positional notation (never an exponent);
    # special values spelled as Go prints them
    if math.isnan(x):
        return "NaN"
    if math.isinf(x):
        return "+Inf" if x > 0 else "-Inf"
    return np.format_float_positional(x, unique=True, trim="-")


@F.pandas_udf(T.StringType())
def _format_gauge_udf(s: pd.Series) -> pd.Series:
    # Arrow hands SQL nulls over as NaN; the caller masks them with when()
    return s.astype("float64").map(_plain)


def format_gauge(c) -> Column:
    """DOUBLE → shortest plain decimal text, e.g. 100.0 → '100', 1e21 → '1000…0'.

    Arrow-batched; meant for the output edge (state-sized tables), not for
    per-update use.
    """
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(_format_gauge_udf(c))


def html_escape_sql(x: str) -> str:
    """SQL text of ``html_escape`` for the expression ``x``."""
    for ch, ent in HTML_ESCAPES:
        q = ch.replace("'", "\\'")
        x = f"replace({x}, '{q}', '{ent}')"
    return x


def metric_line(name, value) -> Column:
    """``name:\\tvalue``"""
    return F.concat(col_of(name), F.lit(":\t"), F.coalesce(col_of(value), F.lit("")))


# The five characters escaped in HTML text, and their entities.
HTML_ESCAPES = (("&", "&amp;"), ("'", "&#39;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"))


def html_escape(c) -> Column:
    if isinstance(c, str):
        return F.expr(html_escape_sql(c))
    out = col_of(c)
    for ch, ent in HTML_ESCAPES:  # '&' first, so entities are not escaped twice
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out
