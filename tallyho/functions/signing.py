"""HMAC-SHA256 signatures as native column expressions.

HMAC(key, m) = H((K ^ opad) || H((K ^ ipad) || m)) with K the key padded to
the 64-byte block (or hashed first when longer). The two padded keys are
constants of the job, so the expression is two ``sha2`` calls over
``concat`` of binaries: no Python per row.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

_BLOCK = 64


def _pads(key: str) -> tuple[str, str]:
    k = key.encode("utf-8")
    if len(k) > _BLOCK:
        k = hashlib.sha256(k).digest()
    k = k.ljust(_BLOCK, b"\0")
    ipad = bytes(b ^ 0x36 for b in k)
    opad = bytes(b ^ 0x5C for b in k)
    return ipad.hex(), opad.hex()


def _binary(c) -> Column:
    c = col_of(c)
    return c.cast("binary")


def sign_sql(body: str, key: str) -> str:
    """SQL: lower-case hex HMAC-SHA256 of the expression ``body``."""
    ipad, opad = _pads(key)
    inner = f"unhex(sha2(concat(unhex('{ipad}'), CAST({body} AS BINARY)), 256))"
    return f"sha2(concat(unhex('{opad}'), {inner}), 256)"


def verify_sql(body: str, key: str, sig: str) -> str:
    """SQL: 'skipped' (no key, or no signature sent), 'ok' or 'bad'."""
    if not key:
        return "'skipped'"
    return (f"CASE WHEN {sig} IS NULL OR {sig} = '' THEN 'skipped' "
            f"WHEN {sig} RLIKE '^([0-9a-fA-F]{{2}})*$' AND lower({sig}) = {sign_sql(body, key)} THEN 'ok' "
            "ELSE 'bad' END")


def sign(body, key: str) -> Column:
    """Lower-case hex HMAC-SHA256 of ``body`` (binary or UTF-8 text)."""
    if isinstance(body, str):
        return F.expr(sign_sql(body, key))
    ipad, opad = _pads(key)
    inner = F.unhex(F.sha2(F.concat(F.unhex(F.lit(ipad)), _binary(body)), 256))
    return F.sha2(F.concat(F.unhex(F.lit(opad)), inner), 256)


def verify(body, key: str, signature) -> Column:
    """'skipped' (no key, or no signature sent), 'ok' or 'bad'.

    The signature is compared as bytes: upper-case hex passes, odd-length or
    non-hex text fails."""
    if isinstance(body, str) and isinstance(signature, str):
        return F.expr(verify_sql(body, key, signature))
    sig = col_of(signature)
    if not key:
        return F.lit("skipped")
    return (F.when(sig.isNull() | (sig == ""), F.lit("skipped"))
             .when(sig.rlike("^([0-9a-fA-F]{2})*$") & (F.lower(sig) == sign(body, key)), F.lit("ok"))
             .otherwise(F.lit("bad")))


def hmac_sql(body_sql: str, key: str) -> str:
    """The same HMAC as DuckDB SQL (for oracles)."""
    ipad, opad = _pads(key)
    return (f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || CAST({body_sql} AS BLOB))))")
