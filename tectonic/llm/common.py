"""Shared pieces of the training-data operators: shipping the package to Python workers,
written intermediate tables on shared storage, connected components, digests."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tectonic
from tectonic.session import scratch_path

# Arrow batches handed to Python: whole texts are large, so a batch holds few rows.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


# Shuffle files of a finished query go at once: its result is a written table or on its way out.
SHUFFLE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, no shuffle files of finished queries, and the package's modules on every Python worker's path (as
    ``spark-submit --py-files`` would; Spark's file server hands the archive out)."""
    for key, value in (ARROW_CONF | SHUFFLE_CONF).items():
        spark.conf.set(key, value)
    sc = spark.sparkContext
    if getattr(sc, "_tectonic_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tectonic.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tectonic-py-"), "tectonic_py.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tectonic", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._tectonic_shipped = True


_OPENED: list[Workspace] = []


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Delete, on leaving, the intermediate tables of every operator called inside: for a caller
    that has written the operators' results by then (they are lazy and read these tables)."""
    first = len(_OPENED)
    try:
        yield
    finally:
        for work in _OPENED[first:]:
            work.close()
        del _OPENED[first:]


class Workspace:
    """Intermediate tables of one operator run, written below the shared checkpoint folder.

    A written table cuts the lineage: a lost executor costs its unfinished tasks only. The tables
    stay until ``close``, or the end of the ``temporary_tables`` block they were written in."""

    def __init__(self, spark: SparkSession):
        prepare(spark)
        _OPENED.append(self)
        self.spark = spark
        self.root = scratch_path(spark, f"llm-{uuid.uuid4().hex}")
        self._n = 0

    def save(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._saved_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that no later step reads."""
        for table in tables:
            self._delete(table._saved_path)

    def close(self) -> None:
        """Delete all tables of this run."""
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (a, b): the smallest id that it
    reaches. Alternating large-star and small-star contraction; every step is a join and an
    aggregate that combines map-side, and each round's edges are a written table."""
    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large_star(e):
        around = both(e)
        least = around.groupBy("a").agg(F.min("b").alias("m")) \
            .select("a", F.least("a", "m").alias("m"))
        return around.join(least, "a").where("b > a") \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small_star(e):
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        joined = e.join(least, "a")
        return joined.select("a", F.col("m").alias("b")).union(
            joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()

    def mark(e):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    current = work.save(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(current)
    while seen[0]:
        following = work.save(small_star(large_star(current)))
        work.drop(current)
        current, before, seen = following, seen, mark(following)
        if seen == before:
            break
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def crc_mod(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
