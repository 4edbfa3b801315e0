"""Binning and percentage expressions used by the summary tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col_of

# Depth classes (km). BETWEEN bounds are inclusive and the first match wins.
DEPTH_BINS = (
    ("lt", 50, "<50 km"),
    ("between", (50, 100), "50-100 km"),
    ("between", (100, 200), "100-200 km"),
    ("between", (200, 300), "200-300 km"),
    ("between", (300, 500), "300-500 km"),
    ("ge", 500, ">=500 km"),
)

# Magnitude classes, same rules.
MAGNITUDE_BINS = (
    ("lt", 3, "<3"),
    ("between", (3, 4), "3-4"),
    ("between", (4, 5), "4-5"),
    ("between", (5, 6), "5-6"),
    ("between", (6, 7), "6-7"),
    ("ge", 7, ">=7"),
)

UNKNOWN = "Unknown"


def bin_label(c: Column | str, bins, otherwise: str = UNKNOWN) -> Column:
    """CASE chain over ``bins``; nulls (and anything unmatched) get ``otherwise``."""
    x = col_of(c)
    expr = None
    for op, bound, label in bins:
        if op == "lt":
            cond = x < bound
        elif op == "ge":
            cond = x >= bound
        elif op == "between":
            cond = x.between(bound[0], bound[1])
        else:
            raise ValueError(f"unknown bin operator {op!r}")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def percent_exact(count: Column | str, total: Column | str) -> Column:
    """``ROUND(100.0 * count / total, 2)`` in exact decimal arithmetic (HALF_UP)."""
    share = F.lit(100).cast("decimal(3,0)") * col_of(count).cast("decimal(20,0)") \
        / col_of(total).cast("decimal(20,0)")
    return F.round(share, 2).cast("decimal(5,2)")


def percent_of_double(count: Column | str, total: Column | str) -> Column:
    """``ROUND(((count / total) * 100)::numeric, 2)`` for double counts.

    The double is taken to a decimal with 13 fraction digits before rounding, which stands
    for the database's 15-significant-digit float->numeric conversion on values <= 100.
    """
    ratio = (col_of(count).cast("double") / col_of(total).cast("double")) * 100
    return F.round(ratio.cast("decimal(20,13)"), 2).cast("decimal(5,2)")
