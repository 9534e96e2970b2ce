"""Number parsing and two's-complement (wrap-around) int64 sums.

Counters add as signed 64-bit integers that wrap on overflow. Spark's ANSI
``sum`` raises instead, and a decimal sum is slow and can itself overflow at
cluster scale. We split every delta into four 16-bit limbs, sum each limb as
a plain long (exact for up to 2^47 rows per group), then propagate carries
and drop everything above bit 63. Everything stays in long arithmetic, so
aggregates stay in codegen'd ``HashAggregate`` and windows stay cheap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of, sql_str

LIMBS = 4
_MASK = 0xFFFF

# The limb arithmetic is generated as SQL text: one expression is one call
# into the JVM, however large, while composing it from Column objects costs a
# round trip per operator. Inputs are SQL expressions (a column name is one).


def limb_sql(x: str, i: int) -> str:
    """Limb ``i`` of the BIGINT expression ``x``: three unsigned 16-bit
    limbs and a signed top limb."""
    if i == LIMBS - 1:
        return f"shiftright({x}, {16 * i})"
    return f"(({x}) & {_MASK})" if i == 0 else f"(shiftright({x}, {16 * i}) & {_MASK})"


def combine_sql(parts: list[str]) -> str:
    """Limb sums → the int64 sum modulo 2^64 (carry propagation, then the
    16-bit pieces shifted into place; bit operations never overflow)."""
    carry = None
    out = []
    for i, p in enumerate(parts):
        t = f"({p})" if carry is None else f"(({p}) + {carry})"
        out.append(f"({t} & {_MASK})")
        carry = f"shiftright({t}, 16)"
    return " | ".join([out[0]] + [f"shiftleft({o}, {16 * i})" for i, o in enumerate(out) if i > 0])


def _text(c) -> str:
    if not isinstance(c, str):
        raise TypeError("limb helpers take SQL text (a column name or expression)")
    return c


def limbs(c) -> list[Column]:
    """Four limbs of a BIGINT: three unsigned 16-bit ones and a signed top."""
    x = _text(c)
    return [F.expr(limb_sql(x, i)) for i in range(LIMBS)]


def combine_limbs(parts: list[str]) -> Column:
    """Limb sums (SQL texts) → the int64 sum modulo 2^64, as a signed BIGINT."""
    return F.expr(combine_sql([_text(p) for p in parts]))


def wrap_sum_aggs(c, prefix: str) -> list[Column]:
    """Aggregate expressions (one per limb) for a wrapping sum of ``c``."""
    x = _text(c)
    return [F.expr(f"sum({limb_sql(x, i)}) AS {prefix}_l{i}") for i in range(LIMBS)]


def wrap_sum_result(prefix: str) -> Column:
    return combine_limbs([f"{prefix}_l{i}" for i in range(LIMBS)])


def wrap_add_sql(a: str, b: str) -> str:
    """SQL: a + b with int64 wrap-around; null only if both are null."""
    res = combine_sql([f"{limb_sql(f'coalesce({a}, 0)', i)} + {limb_sql(f'coalesce({b}, 0)', i)}"
                       for i in range(LIMBS)])
    return f"CASE WHEN ({a}) IS NULL AND ({b}) IS NULL THEN CAST(NULL AS BIGINT) ELSE {res} END"


def wrap_add(a, b) -> Column:
    return F.expr(wrap_add_sql(_text(a), _text(b)))


# Strict text parsers. Go's ParseInt(s, 10, 64) / ParseFloat(s, 64) reject
# blanks, suffixes and out-of-range numbers; Spark's casts are laxer, so a
# regex guards the cast and infinite results of a numeric form are refused.
# ``\\z`` is the end of the text: ``$`` would also match before a final line break.
COUNTER_TEXT = r"^[+-]?[0-9]+\z"
GAUGE_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
GAUGE_SPECIAL = r"^([+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?)|[nN][aA][nN])\z"


def counter_sql(x: str) -> str:
    """SQL: text → BIGINT, or null when it is not a base-10 int64."""
    return f"CASE WHEN ({x}) RLIKE {sql_str(COUNTER_TEXT)} THEN try_cast({x} AS BIGINT) END"


def gauge_sql(x: str) -> str:
    """SQL: text → DOUBLE, or null when Go's ParseFloat would refuse it."""
    num = f"try_cast({x} AS DOUBLE)"
    low = f"lower({x})"
    return (f"CASE WHEN ({x}) RLIKE {sql_str(GAUGE_TEXT)} AND NOT isnan({num}) AND abs({num}) != double('infinity') "
            f"THEN {num} "
            f"WHEN ({x}) RLIKE {sql_str(GAUGE_SPECIAL)} THEN "
            f"CASE WHEN {low} RLIKE '^[+]?inf(inity)?' THEN double('infinity') "
            f"WHEN {low} RLIKE '^-inf(inity)?' THEN double('-infinity') ELSE double('NaN') END END")


def parse_counter(c) -> Column:
    """Text → BIGINT, or null when it is not a base-10 int64."""
    return F.expr(counter_sql(_text(c)))


def parse_gauge(c) -> Column:
    """Text → DOUBLE, or null when Go's ParseFloat would refuse it."""
    return F.expr(gauge_sql(_text(c)))


def format_counter(c) -> Column:
    return col_of(c).cast("string")
