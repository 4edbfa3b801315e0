"""Dataset keys and Hadoop-filesystem helpers (work on HDFS, object stores and local)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def dataset_key(layer: str, schema: str, table: str, suffix: str | None = None) -> str:
    """``layer/schema/<table without the layer_ prefix>[.suffix]``."""
    key = "/".join([layer, schema, table.replace(f"{layer}_", "", 1)])
    return f"{key}.{suffix}" if suffix else key


def join(root: str, key: str) -> str:
    return root.rstrip("/") + "/" + key.lstrip("/")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, directory: str) -> list[str]:
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def staging_path(path: str) -> str:
    """A sibling path for a staged write (unique per run, so concurrent runs never clash)."""
    return f"{path.rstrip('/')}._staging_{uuid.uuid4().hex}"


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Replace ``target`` by the fully written ``staged`` directory.

    Rename is atomic on HDFS; on object stores it is a copy, so readers may briefly see the
    old or no table — acceptable for batch layers that are rebuilt as a whole.
    """
    fs, t = _fs(spark, target)
    _, s = _fs(spark, staged)
    backup = None
    if fs.exists(t):
        backup = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_path(target))
        if not fs.rename(t, backup):
            raise IOError(f"could not move {target} aside")
    if not fs.rename(s, t):
        if backup is not None:
            fs.rename(backup, t)
        raise IOError(f"could not move {staged} to {target}")
    if backup is not None:
        fs.delete(backup, True)
