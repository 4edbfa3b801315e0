"""Catalog tables: database, DDL, model materialization, views, staged upsert/refresh."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.constraints import BROKEN, Constraints, ddl, with_broken_rules
from ..operators.quality import pk_violations
from ..operators.upsert import full_refresh, upsert_by_key
from ..schemas import DIM_CONSTRAINTS, DIM_PROVINCE, FACT_CONSTRAINTS, FACT_EVENT
from ..session import scratch_path
from . import paths
from .metrics import observed


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_tables(spark: SparkSession, database: str) -> None:
    """Province dimension and event fact with their declared types and NOT NULLs, created only
    when missing. Spark rejects a longer VARCHAR on every insert; :func:`load_checked` sorts rows
    out before one."""
    ensure_database(spark, database)
    for name, schema, constraints in (("dim_province", DIM_PROVINCE, DIM_CONSTRAINTS),
                                      ("fact_earthquake_event", FACT_EVENT, FACT_CONSTRAINTS)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.{name} ({ddl(schema, constraints)}) USING parquet")


def load_checked(df: DataFrame, table: str, constraints: Constraints, quarantine: str,
                 overwrite: bool = False) -> dict:
    """Insert the rows of ``df`` that keep every rule into ``table`` and the others, with the names
    of the rules they break, into the table ``quarantine`` (made when missing).

    The rows are judged once, on their way into a stage that both inserts read. A key that occurs
    twice among the sound rows, or in the table already (unless it is overwritten), rejects the
    whole load before either table is touched, as a primary key would.
    """
    spark = df.sparkSession
    shape = spark.table(table).schema.fieldNames()
    stage = scratch_path(spark, f"checked-{uuid.uuid4().hex}")
    out, obs = observed(with_broken_rules(df.select(*shape), constraints), "checked",
                        quarantined=F.count_if(F.size(BROKEN) > 0))
    out.write.parquet(stage)
    try:
        staged = spark.read.parquet(stage)
        sound = staged.where(F.size(BROKEN) == 0).select(*shape)
        keys = sound.select(*constraints.key)
        if not overwrite:
            old = spark.table(table).select(*constraints.key).join(keys.distinct(), list(constraints.key), "left_semi")
            keys = keys.unionByName(old)
        if twice := pk_violations(keys, constraints.key).head(3):
            raise ValueError(f"{table}: keys that occur more than once: {[tuple(r)[:-1] for r in twice]}")
        broken = staged.where(F.size(BROKEN) > 0)
        broken.write.mode("append").saveAsTable(quarantine)
        sound.write.insertInto(table, overwrite=overwrite)
    finally:
        paths.delete(spark, stage)
    seen = obs.get
    return {"path": table, "type": "table", "records": seen["records"] - seen["quarantined"],
            "quarantined": seen["quarantined"]}


def materialize(df: DataFrame, table: str) -> dict:
    """Build a model as a managed table (replaces the previous contents)."""
    out, obs = observed(df)
    out.write.mode("overwrite").saveAsTable(table)
    return {"path": table, "type": "table", "records": obs.get["records"]}


def materialize_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> dict:
    """Write a table bucketed and sorted by ``key``: later joins and aggregations on the key
    (for example the streaming ingest's lookup of stored event ids) read it without a
    shuffle of this side."""
    out, obs = observed(df)
    (out.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
     .saveAsTable(table))
    return {"path": table, "type": "table", "records": obs.get["records"]}


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Pass-through model: a temporary view over ``df``."""
    df.createOrReplaceTempView(name)
    return df


def _replace_table(spark: SparkSession, table: str, new_rows: DataFrame) -> dict:
    """Stage ``new_rows`` (which may read ``table``) in a uniquely named table shaped like
    ``table``, then overwrite ``table`` from the stage and drop it. The stage cuts the lineage,
    so the target is never overwritten by a plan that is still reading it, and takes the
    target's types, so a value that doesn't fit fails before the target is touched. If the
    overwrite itself fails, the stage with all rows is kept and named in the error."""
    stage = f"{table}__staging_{uuid.uuid4().hex[:12]}"
    out, obs = observed(new_rows)
    spark.sql(f"CREATE TABLE {stage} LIKE {table}")
    try:
        out.write.insertInto(stage)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise
    try:
        spark.table(stage).write.insertInto(table, overwrite=True)
    except Exception as failed:
        failed.add_note(f"{table} may be incomplete; all its new rows are in {stage}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    return {"path": table, "type": "table", "records": obs.get["records"]}


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
                 columns: Sequence[str] | None = None) -> dict:
    """Keyed upsert into a catalog table (delete matching keys, insert all source rows)."""
    return _replace_table(spark, table, upsert_by_key(spark.table(table), source, keys, columns))


def refresh_table(spark: SparkSession, table: str, source: DataFrame,
                  columns: Sequence[str] | None = None) -> dict:
    """Full refresh (truncate + insert) of a catalog table."""
    return _replace_table(spark, table, full_refresh(spark.table(table), source, columns))


def upsert_path(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                columns: Sequence[str] | None = None) -> dict:
    """Keyed upsert into a Parquet directory: write the new version beside it, then swap."""
    if paths.exists(spark, path):
        new_rows = upsert_by_key(spark.read.parquet(path), source, keys, columns)
    else:
        new_rows = source.select(*(columns or source.columns))
    staged = paths.staging_path(path)
    out, obs = observed(new_rows)
    out.write.mode("overwrite").parquet(staged)
    paths.swap_in(spark, staged, path)
    return {"path": path, "type": "parquet", "records": obs.get["records"]}
