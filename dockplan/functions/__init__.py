"""Column-level helpers: IEEE arithmetic, business days, distributed order."""

from dockplan.functions.calendar import busday_add, busday_sub, receive_day_date
from dockplan.functions.numeric import (
    greatest_of,
    ieee_div,
    is_finite_value,
    least_of,
    not_pos_infinity,
    stable_round,
)
from dockplan.functions.ordering import ordered_index, running_total

__all__ = [
    "busday_add",
    "busday_sub",
    "receive_day_date",
    "greatest_of",
    "ieee_div",
    "is_finite_value",
    "least_of",
    "not_pos_infinity",
    "stable_round",
    "ordered_index",
    "running_total",
]
