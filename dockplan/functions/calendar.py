"""Business-day arithmetic as pure Column expressions (Monday-Friday, no holidays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def busday_sub(date_col, n_col) -> Column:
    """Date ``n`` business days before ``date``; a weekend start is an error.

    For a weekday w (Monday = 0) going back n >= 0 business days crosses one
    weekend for every five days counted beyond w, so the calendar distance is
    n + 2 * floor((n - w + 4) / 5).
    """
    d, n = _c(date_col), _c(n_col).cast("int")
    w = F.weekday(d)
    back = n + F.lit(2) * F.floor((n - w + F.lit(4)) / F.lit(5)).cast("int")
    return (
        F.when(d.isNull() | n.isNull(), F.lit(None).cast("date"))
        .when(w >= 5, F.raise_error(F.concat(F.lit("busday_sub: not a business day: "), d.cast("string"))).cast("date"))
        .when(n < 0, busday_add(d, -n))
        .otherwise(F.date_sub(d, back))
    )


def busday_add(date_col, n_col) -> Column:
    """Date ``n`` business days after ``date`` (n >= 0); a weekend start is an error."""
    d, n = _c(date_col), _c(n_col).cast("int")
    w = F.weekday(d)
    fwd = n + F.lit(2) * F.floor((n + w) / F.lit(5)).cast("int")
    return (
        F.when(d.isNull() | n.isNull(), F.lit(None).cast("date"))
        .when(w >= 5, F.raise_error(F.concat(F.lit("busday_add: not a business day: "), d.cast("string"))).cast("date"))
        .otherwise(F.date_add(d, fwd))
    )


def receive_day_date(week_start, day_index) -> Column:
    """Date of receiving day ``day_index`` (1-based): consecutive business days."""
    return busday_add(F.to_date(_c(week_start)), _c(day_index) - F.lit(1))
