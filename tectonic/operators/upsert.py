"""Keyed upsert and full refresh as DataFrame plans (no MERGE, no table format needed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def align_to(target_schema, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Source projected to the declared ``columns`` and shaped like the target: target
    columns outside the list are null, types follow the target."""
    cols = set(columns)
    unknown = cols - set(target_schema.fieldNames())
    if unknown:
        raise ValueError(f"columns not in the target table: {sorted(unknown)}")
    return source.select(*[
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target_schema.fields])


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Delete target rows whose keys equal a source row's keys, then insert every source row.

    Keys compare with ``=``: a target row with a null key never matches and survives.
    Duplicates inside the source are all inserted (run a key-uniqueness check first where
    the table has a primary key). The delete is a ``left_anti`` join — shuffled on the keys,
    or broadcast when the planner measures the source as small; AQE splits a skewed key.
    """
    columns = list(columns or source.columns)
    staged = source.select(*columns)
    # only the distinct source keys decide the delete; de-duplicating them first (a partial
    # aggregate) keeps a key repeated across many source rows from landing in one task
    survivors = target.join(staged.select(*keys).distinct(), on=list(keys), how="left_anti")
    return survivors.unionByName(align_to(target.schema, staged, columns))


def full_refresh(target: DataFrame, source: DataFrame,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Truncate and insert: the result holds the source rows only, in the target's shape."""
    return align_to(target.schema, source, list(columns or source.columns))
