"""IEEE arithmetic and NULL-aware extrema as Spark SQL expressions.

Spark 4 runs with ANSI mode on, where ``x / 0`` raises, and with it off or
``try_divide`` it gives NULL. The reports filter on ``<> Infinity`` and NaN,
so division by zero must give IEEE results: +-Infinity or NaN.

Each helper has a ``*_sql`` form that returns SQL text over column names or
SQL snippets, and a Column form that parses it once with ``F.expr``. Building
a CASE chain from ``F.when``/``F.lit`` calls costs several JVM round trips per
node; one parsed expression costs one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = "CAST('Infinity' AS DOUBLE)"


def dbl(x: float) -> str:
    """A double literal in Spark SQL."""
    x = float(x)
    if math.isinf(x):
        return INF if x > 0 else f"-{INF}"
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    return f"{x!r}D"


def text(s: str) -> str:
    """A string literal in Spark SQL."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def as_double(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ieee_div_sql(a: str, b: str) -> str:
    """a / b on doubles; b = 0 gives a * Infinity: +-Infinity, or NaN for 0 and NaN.

    The division sits in the ELSE branch, which is evaluated only when b <> 0,
    so ANSI mode never sees a zero divisor.
    """
    a, b = as_double(a), as_double(b)
    return f"(CASE WHEN {b} = 0.0D THEN {a} * {INF} ELSE {a} / {b} END)"


def ieee_div(a: str, b: str) -> Column:
    return F.expr(ieee_div_sql(a, b))


def _extremum_sql(fn: str, cols, nulls: str) -> str:
    cs = [as_double(c) for c in cols]
    out = f"{fn}({', '.join(cs)})"
    if nulls == "propagate":
        any_null = " OR ".join(f"{c} IS NULL" for c in cs)
        out = f"(CASE WHEN {any_null} THEN CAST(NULL AS DOUBLE) ELSE {out} END)"
    return out


def least_sql(*cols: str, nulls: str = "propagate") -> str:
    """least(); with ``nulls="propagate"`` any NULL input gives NULL."""
    return _extremum_sql("least", cols, nulls)


def greatest_sql(*cols: str, nulls: str = "propagate") -> str:
    """greatest(); with ``nulls="propagate"`` any NULL input gives NULL."""
    return _extremum_sql("greatest", cols, nulls)


def least_of(*cols: str, nulls: str = "propagate") -> Column:
    return F.expr(least_sql(*cols, nulls=nulls))


def greatest_of(*cols: str, nulls: str = "propagate") -> Column:
    return F.expr(greatest_sql(*cols, nulls=nulls))


def is_finite_value_sql(c: str) -> str:
    """Self-equality in IEEE terms: not NULL and not NaN."""
    return f"({c} IS NOT NULL AND NOT isnan({c}))"


def is_finite_value(c: str) -> Column:
    return F.expr(is_finite_value_sql(c))


def not_pos_infinity_sql(c: str) -> str:
    """``c <> 'Infinity'``: NULL and +Infinity fail, -Infinity and NaN pass."""
    return f"({c} <> {INF})"


def not_pos_infinity(c: str) -> Column:
    return F.expr(not_pos_infinity_sql(c))


def stable_round_sql(c: str, digits: int = 6) -> str:
    """Round away from exact decimal ties so sums taken in another order agree.

    Double sums differ in the last bits with summation order, and the data
    has exact ties at the rounding digit; a small offset moves values off the
    tie. NaN and +-Infinity pass through unchanged.
    """
    c = as_double(c)
    return f"(CASE WHEN isnan({c}) OR abs({c}) = {INF} THEN {c} ELSE round({c} + 1e-8D, {int(digits)}) END)"


def stable_round(c: str, digits: int = 6) -> Column:
    return F.expr(stable_round_sql(c, digits))
