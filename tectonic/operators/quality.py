"""Data-quality checks for the declared table constraints (keys, NOT NULL, lengths, FKs).

Each check is one aggregation or one join; none collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (null keys included)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def _long(df: DataFrame, values: Mapping[str, F.Column], extra: Mapping[str, object] | None,
          value_name: str) -> DataFrame:
    """One pass computing every check, unpivoted to one row per column."""
    names = list(values)
    wide = df.agg(*[v.alias(n) for n, v in values.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    out = wide.select(F.expr(f"stack({len(names)}, {pairs}) as (column_name, {value_name})"))
    if extra:
        limit = F.create_map(*[x for n, v in extra.items() for x in (F.lit(n), F.lit(v))])
        out = out.withColumn("max_length", limit[F.col("column_name")])
    return out


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, violations)``: nulls in columns declared NOT NULL."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, None, "violations")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """``(column_name, violations, max_length)``: values longer than VARCHAR(n)."""
    return _long(df, {c: F.count_if(F.length(c) > n) for c, n in limits.items()}, limits,
                 "violations")


def fk_orphans(child: DataFrame, parent: DataFrame, key: str,
               parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent row (a null key is allowed)."""
    parent_keys = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(parent_keys, key, "left_anti")


def fk_set_null(child: DataFrame, parent: DataFrame, key: str,
                parent_key: str | None = None) -> DataFrame:
    """``ON DELETE SET NULL`` after a parent reload: orphaned keys become null."""
    parent_keys = parent.select(F.col(parent_key or key).alias("_pk")).distinct()
    joined = child.join(parent_keys, child[key] == parent_keys["_pk"], "left")
    return joined.select(*[F.when(F.col("_pk").isNotNull(), child[key]).alias(key) if c == key
                           else child[c] for c in child.columns])
