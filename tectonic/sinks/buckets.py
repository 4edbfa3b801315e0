"""Keyed upsert that rewrites only the buckets its keys fall in.

A bucketed dataset is a Parquet directory partitioned by a hash of the key columns; the name of the
partition column holds the number of buckets (``key_bucket_of_64``), so the layout tells itself.
An upsert stages its source once (a written table), reads the buckets that occur in it, and replaces
just those by a dynamic partition overwrite, which Spark writes beside the data and moves in when
all tasks are done. Other buckets' files stay as they are.

If the run dies while buckets are moved in, some hold the new rows and some the old ones; the same
upsert run again completes it, since deleting the source's keys and inserting its rows twice is the
same as once. Rows with a null key have a bucket as well; a null key matches nothing, as in
``upsert_by_key``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.upsert import upsert_by_key
from ..session import scratch_path
from . import paths
from .metrics import observed

_NAME = "key_bucket_of_"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, name: str, mode: str) -> int:
    out, obs = observed(df.hint("rebalance", name))  # a bucket goes to one task, a large one to several
    out.write.option("partitionOverwriteMode", "dynamic").mode(mode).partitionBy(name).parquet(path)
    return obs.get["records"]


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> dict:
    """Write ``df`` as a bucketed dataset (the path must not exist)."""
    name = f"{_NAME}{buckets}"
    records = _write(df.withColumn(name, bucket_of(keys, buckets)), path, name, "error")
    return {"path": path, "type": "parquet", "records": records}


def _bucket_column(columns: Sequence[str]) -> tuple[str, int]:
    for c in columns:
        if found := re.fullmatch(rf"{_NAME}(\d+)", c):
            return c, int(found[1])
    raise ValueError("not a bucketed dataset")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(_bucket_column(df.columns)[0])


def upsert_buckets(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                   columns: Sequence[str] | None = None) -> dict:
    """Delete the rows whose keys equal a source row's, insert every source row; only the buckets of
    the source's keys are read and rewritten. ``records`` are the rows written to them."""
    target = spark.read.parquet(path)
    name, buckets = _bucket_column(target.columns)
    columns = list(columns or source.columns)
    stage = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    source.select(*columns).withColumn(name, bucket_of(keys, buckets)).write.parquet(stage)
    try:
        staged = spark.read.parquet(stage)
        touched = [r[0] for r in staged.select(name).distinct().collect()]  # as many as buckets at most
        if not touched:
            return {"path": path, "type": "parquet", "records": 0, "buckets": 0}
        # the literal list prunes the scan to these buckets' files
        own = target.where(F.col(name).isin(touched)).drop(name)
        rows = upsert_by_key(own, staged, keys, columns).withColumn(name, bucket_of(keys, buckets))
        records = _write(rows, path, name, "overwrite")
    finally:
        paths.delete(spark, stage)
    return {"path": path, "type": "parquet", "records": records, "buckets": len(touched)}
