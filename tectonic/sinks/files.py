"""Parquet / JSON / text / binary sinks addressed by dataset key."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import paths
from .metrics import observed


@contextmanager
def _target_size(spark: SparkSession, file_bytes: int | None):
    """The size that AQE aims at when it deals out partitions, for the writes inside."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    if file_bytes:
        spark.conf.set(key, str(file_bytes))
    try:
        yield
    finally:
        if file_bytes:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_parquet(df: DataFrame, path: str, file_bytes: int | None = None, partition_by: tuple[str, ...] = (),
                  max_files: int | None = None, max_records: int | None = None, sort_by: tuple = ()) -> dict:
    """Overwrite ``path`` with ``df`` as Parquet; returns ``{path, type, records}``.

    Files are written in parallel, one or more per task. With ``file_bytes`` the rows are dealt out
    anew just before the write, so that files hold at most about that much (as measured in the
    shuffle; Parquet usually packs it smaller): large partitions are split, small ones are joined
    as long as every core has one. ``max_files`` deals small tables out to so many tasks instead.
    Either way the stage that computes the rows keeps its own tasks. ``max_records`` bounds a file's
    rows; ``sort_by`` orders the rows of each file.
    """
    out, obs = observed(df)
    if max_files:
        out = out.repartition(max_files)
    elif file_bytes:
        out = out.hint("rebalance", *partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    with _target_size(df.sparkSession, file_bytes):
        writer.parquet(path)
    return {"path": path, "type": "parquet", "records": obs.get["records"]}


def write_dataset(df: DataFrame, root: str, layer: str, schema: str, table: str,
                  file_bytes: int | None = None, max_files: int | None = None, sort_by: tuple = ()) -> dict:
    """Write under ``root/layer/schema/<table>.parquet`` (the dataset key convention)."""
    return write_parquet(df, paths.join(root, paths.dataset_key(layer, schema, table, "parquet")),
                         file_bytes, max_files=max_files, sort_by=sort_by)


def _require_suffix(path: str, suffix: str) -> None:
    if not path.rstrip("/").endswith(suffix):
        raise ValueError(f"the path must end in {suffix}, from which readers tell the format")


def write_json_records(df: DataFrame, path: str) -> dict:
    """Rows as JSON lines (dicts / lists of records), under a ``.jsonl`` path."""
    _require_suffix(path, ".jsonl")
    out, obs = observed(df)
    out.write.mode("overwrite").json(path)
    return {"path": path, "type": "json", "records": obs.get["records"]}


def write_text_document(spark: SparkSession, text: str, path: str) -> dict:
    """One small text document (for example a GeoJSON file) as a single-file text dataset."""
    df = spark.createDataFrame([(text,)], "value string")
    df.coalesce(1).write.mode("overwrite").text(path)
    return {"path": path, "type": "json", "records": 1}


def write_json_document(spark: SparkSession, obj, path: str) -> dict:
    """A small dict / list as one JSON document (UTF-8, indented), like a configuration or
    boundary file; larger data goes through :func:`write_json_records`."""
    return write_text_document(spark, json.dumps(obj, ensure_ascii=False, indent=2), path)


def write_binary(df: DataFrame, path: str, path_col: str = "path",
                 content_col: str = "content") -> dict:
    """Binary objects as ``(path string, content binary)`` rows in Parquet, under a ``.blobs``
    path."""
    _require_suffix(path, ".blobs")
    rows = df.select(F.col(path_col).cast("string").alias("path"),
                     F.col(content_col).cast("binary").alias("content"))
    return write_parquet(rows, path) | {"type": "binary"}
