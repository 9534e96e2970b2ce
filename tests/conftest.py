import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyho.schema import UPDATE  # noqa: E402
from tallyho.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4)
    yield s


@pytest.fixture
def updates(spark):
    """Build an update table: rows of (seq, id, mtype, delta, value[, hash, batch_id, pos])."""
    def make(rows):
        full = []
        for r in rows:
            r = dict(r)
            full.append((r["seq"], r.get("batch_id"), r.get("pos"), r.get("id"), r.get("mtype"),
                         r.get("delta"), r.get("value"), r.get("hash", "")))
        return spark.createDataFrame(full, UPDATE)
    return make


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
