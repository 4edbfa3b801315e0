"""Row numbers over a whole table or within groups, without a window that puts a group in one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

# Columns that the written, ordered table has besides those of its rows.
PART, PLACE = "_part", "_place"


def written_in_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` dealt out by ranges of ``order`` and sorted within each, written below the shared
    checkpoint folder with the number of the range (``_part``) and the row's place in it
    (``_place``, from 0). Writing fixes both: ranges follow from a sample of the rows, so a second
    evaluation might cut elsewhere."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = scratch_path(df.sparkSession, f"ordered-{uuid.uuid4().hex}")
    numbered = ordered.withColumn(PART, F.spark_partition_id()).withColumn(PLACE, place)
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def rows_before(written: DataFrame) -> DataFrame:
    """``(_part, _before)``: how many rows the ranges before each hold. One row per range, so the
    only window without a key in this package runs over as many rows as there are ranges."""
    sizes = written.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(PART, F.coalesce(before, F.lit(0)).alias("_before"))


def with_rank(df: DataFrame, order: Sequence[Column | str], name: str = "row_rank") -> DataFrame:
    """``df`` plus the 1-based number of each row in ``order``.

    Rows are dealt out by ranges of the order, so a task sorts its range only; a row's number is
    its place in the range plus the rows of the ranges before. Rows that tie in ``order`` are
    numbered in an arbitrary (but, once written, fixed) sequence; name a total order where that
    matters.
    """
    written = written_in_order(df, order)
    ranked = written.join(F.broadcast(rows_before(written)), PART)
    return ranked.select(*df.columns, (F.col("_before") + F.col(PLACE) + 1).alias(name))
