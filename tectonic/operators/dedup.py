"""Deterministic key deduplication as an aggregate (map-side combinable)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def first_by_order(df: DataFrame, keys: Sequence[str],
                   order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the smallest by ``order`` (ascending, nulls last), remaining
    columns breaking ties, so the choice is total and repeatable.

    Implemented as ``groupBy(keys).agg(min(struct))`` rather than a ``row_number`` window:
    the aggregate combines map-side, so a key carrying a third of all rows is reduced to one
    row per input partition before the shuffle instead of being sorted in one task.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordered = list(order or []) + [c for c in others if c not in (order or [])]
    fields = ", ".join(f"'n{i}', isnull(`{c}`), 'v{i}', `{c}`" for i, c in enumerate(ordered))
    picked = df.groupBy(*keys).agg(F.expr(f"min(named_struct({fields}))").alias("_pick"))
    unpack = {c: f"_pick.v{i}" for i, c in enumerate(ordered)}
    return picked.selectExpr(*[f"`{c}`" if c in keys else f"{unpack[c]} AS `{c}`"
                               for c in df.columns])
