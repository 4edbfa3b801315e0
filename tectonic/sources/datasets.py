"""Datasets addressed by key: Parquet, JSON documents, JSON lines and binary objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks import paths

# The file suffixes a dataset key may resolve to, and their reader.
# ``json`` is one document per file, ``jsonl`` one record per line; ``bin`` and ``dat`` are raw
# objects, ``blobs`` is a table of objects as the binary sink writes it.
READERS = {"parquet": "parquet", "json": "json", "jsonl": "json", "bin": "binaryFile",
           "dat": "binaryFile", "blobs": "parquet"}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Binary objects as ``(path, modificationTime, length, content)``."""
    return spark.read.format("binaryFile").load(path)


def resolve_dataset(spark: SparkSession, root: str, layer: str, schema: str,
                    table: str) -> tuple[str, str]:
    """Find the stored object for a key; its suffix decides the format.

    Raises FileNotFoundError when nothing is stored under the key and TypeError for an
    unsupported suffix.
    """
    key = paths.dataset_key(layer, schema, table)
    directory, stem = key.rsplit("/", 1)
    names = [n for n in paths.list_names(spark, paths.join(root, directory))
             if n.startswith(stem + ".")]
    if not names:
        raise FileNotFoundError(f"No object found for {key}")
    name = names[0]
    suffix = name.rsplit(".", 1)[-1]
    if suffix not in READERS:
        raise TypeError(f"Unsupported file type: {suffix}")
    return paths.join(root, f"{directory}/{name}"), suffix


def read_dataset(spark: SparkSession, root: str, layer: str, schema: str,
                 table: str) -> DataFrame:
    """Read the object stored under ``root/layer/schema/table``: Parquet as a table, JSON as
    multi-line documents, ``jsonl`` as records, ``bin``/``dat`` as binary rows and ``blobs`` as
    ``(path, content)`` rows. Every sink's output is read back by its suffix."""
    path, suffix = resolve_dataset(spark, root, layer, schema, table)
    if suffix == "json":
        return spark.read.option("multiLine", True).json(path)
    return spark.read.format(READERS[suffix]).load(path)
