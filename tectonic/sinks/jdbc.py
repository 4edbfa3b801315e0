"""JDBC sink: staged write, keyed upsert and full refresh inside the database."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import scratch_path
from ..sources.jdbc import read_table
from . import paths
from .metrics import observed

DEFAULT_BATCH_SIZE = 100_000


def write_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                mode: str = "overwrite", columns: Sequence[str] | None = None,
                batch_size: int = DEFAULT_BATCH_SIZE, truncate: bool = False) -> dict:
    """Write the declared ``columns`` of ``df``; each task inserts in ``batch_size`` batches."""
    out = df.select(*columns) if columns else df
    out, obs = observed(out)
    (out.write.format("jdbc").mode(mode)
     .option("url", url).option("dbtable", table)
     .option("batchsize", batch_size).option("truncate", str(truncate).lower())
     .options(**(properties or {})).save())
    return {"path": table, "type": "jdbc", "records": obs.get["records"]}


def in_transaction(spark: SparkSession, url: str, properties: dict | None,
                   statements: Sequence[str]) -> list[int]:
    """Run SQL statements on one connection and commit them together; a failure of any of them
    rolls all back. Returns each statement's row count."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k not in ("driver",):
            props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        try:
            counts = [conn.createStatement().executeUpdate(sql) for sql in statements]
            conn.commit()
            return counts
        except Exception:
            conn.rollback()
            raise
    finally:
        conn.close()


def drop_table(spark: SparkSession, url: str, table: str, properties: dict | None) -> None:
    """Drop a staging table through the JDBC driver manager."""
    in_transaction(spark, url, properties, [f"DROP TABLE {table}"])


# Columns of a stage besides the staged ones: the task and row a row comes from, and its arrival.
TASK, ROW, ARRIVAL = "stage_task", "stage_row", "stage_arrival"


def _numbered(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(TASK, IntegerType()), StructField(ROW, LongType())])


def _merge(spark: SparkSession, url: str, table: str, source: DataFrame,
           columns: Sequence[str] | None, properties: dict | None, keys: Sequence[str] | None) -> dict:
    """Stage the source rows only, in a table shaped like the target's declared columns; then
    delete (the rows of the staged keys, or all) and insert from the stage in one transaction.
    Spark reads the target's schema but none of its rows. The target is unchanged after any
    failure, so the stage is dropped either way.

    A task of the staging write commits its rows by itself; if it is lost after that and run again,
    they are in the stage twice. So every staged row carries the number of its task and its own
    number there, taken from a written copy of the source (a task run again then writes the same
    rows), and the database numbers the rows as they arrive: of equal (task, row) the first counts.

    ``staged`` are the rows inserted, ``deleted`` those deleted, ``records`` the staged rows and,
    after an upsert, the target rows that stay, as the database counts them.
    """
    quote = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    names = {c.lower(): c for c in read_table(spark, url, table, properties).columns}
    wanted = list(columns or source.columns)
    unknown = [c for c in [*wanted, *(keys or [])] if c.lower() not in names]
    if unknown:
        raise ValueError(f"columns not in the target table: {unknown}")
    listed = ", ".join(quote(names[c.lower()]) for c in wanted)
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    task, row, seq = (quote(c) for c in (TASK, ROW, ARRIVAL))
    in_transaction(spark, url, properties, [
        f"CREATE TABLE {stage} AS SELECT {listed} FROM {table} WITH NO DATA",
        f"ALTER TABLE {stage} ADD COLUMN {task} INTEGER", f"ALTER TABLE {stage} ADD COLUMN {row} BIGINT",
        f"ALTER TABLE {stage} ADD COLUMN {seq} BIGINT GENERATED ALWAYS AS IDENTITY"])
    once = f"{seq} IN (SELECT MIN({seq}) FROM {stage} GROUP BY {task}, {row})"
    copy = scratch_path(spark, f"jdbc-{uuid.uuid4().hex}")
    try:
        staged = source.select(*[F.col(c).alias(names[c.lower()]) for c in wanted])
        staged.withColumns({TASK: F.spark_partition_id(), ROW: F.monotonically_increasing_id()}).write.parquet(copy)
        metrics = write_table(spark.read.schema(_numbered(staged.schema)).parquet(copy), url, stage, properties,
                              mode="append")
        where = ""
        if keys:
            same = " AND ".join(f"{stage}.{quote(names[k.lower()])} = {table}.{quote(names[k.lower()])}"
                                for k in keys)
            where = f" WHERE EXISTS (SELECT 1 FROM {stage} WHERE {same})"
        deleted, inserted = in_transaction(spark, url, properties, [
            f"DELETE FROM {table}{where}",
            f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage} WHERE {once}"])
    finally:
        drop_table(spark, url, stage, properties)
        paths.delete(spark, copy)
    rows = read_table(spark, url, f"(SELECT COUNT(*) AS n FROM {table}) counted", properties).first()[0]
    return metrics | {"path": table, "records": int(rows), "staged": inserted, "deleted": deleted}


def upsert(spark: SparkSession, url: str, table: str, source: DataFrame, keys: Sequence[str],
           columns: Sequence[str] | None = None, properties: dict | None = None) -> dict:
    """Delete the target rows whose keys equal a source row's, then insert every source row; one
    database transaction. Columns outside ``columns`` get the table's default."""
    if not keys:
        raise ValueError("an upsert needs key columns")
    return _merge(spark, url, table, source, columns, properties, keys)


def refresh(spark: SparkSession, url: str, table: str, source: DataFrame,
            columns: Sequence[str] | None = None, properties: dict | None = None) -> dict:
    """Replace all rows of a JDBC table by the source's, in one database transaction."""
    return _merge(spark, url, table, source, columns, properties, None)
