"""Load metrics gathered while a write runs (``observe``: no extra counting job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observed(df: DataFrame, name: str = "load", **extra: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count (plus any ``extra`` aggregate expressions) to ``df``'s next action."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("records")] + [e.alias(k) for k, e in extra.items()]
    return df.observe(obs, *exprs), obs
