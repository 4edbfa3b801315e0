"""Reject ledger: why lines, features and geometries do not become events and provinces.

Each row gets the first reason that applies, or none. Reasons are counted while the rows are
written (``observed_reasons``: the counts ride along, no extra pass) or as a table (``ledger``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.geometry import geometry_head, head_polygons, wkt_polygons
from ..functions.parse import event_timestamp, packed_coordinate
from ..functions.text import is_blank
from ..operators.events import LATITUDE_WIDTH, LONGITUDE_WIDTH
from ..operators.slicing import CATALOGUE_RECORD_LENGTH, slice_fixed_width
from ..sinks.metrics import observed

LINE_REASONS = ("blank", "short", "coordinate shape", "coordinate value", "event time")
FEATURE_REASONS = ("geometry type", "coordinates")
WKT_REASONS = ("wkt",)


def _first_of(*cases: tuple[Column, str]) -> Column:
    """The name of the first case that is true (null counts as false)."""
    expr = F
    for condition, name in cases:
        expr = expr.when(condition, F.lit(name))
    return expr


def line_reasons(lines: DataFrame, line_col: str = "raw_line", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, the line, its sliced fields and ``reason``: why a raw line gives no complete event. It
    is blank, shorter than a record, its coordinate fields have another width than the filter of
    the typing step asks for, a coordinate is not a number, or the time cannot be read."""
    sliced = slice_fixed_width(lines, line_col, keep=(*keep, line_col))
    shaped = (F.length("latitude_raw") == LATITUDE_WIDTH) & (F.length("longitude_raw") == LONGITUDE_WIDTH)
    blank, short, shape, value, time = LINE_REASONS
    return sliced.withColumn("reason", _first_of(
        (is_blank(line_col), blank), (F.length(line_col) < CATALOGUE_RECORD_LENGTH, short),
        (~F.coalesce(shaped, F.lit(False)), shape),
        (packed_coordinate("latitude_raw", 2).isNull() | packed_coordinate("longitude_raw", 3).isNull(), value),
        (event_timestamp("event_time_raw").isNull(), time)))


def feature_reasons(features: DataFrame, geometry_col: str = "geometry_json") -> DataFrame:
    """``features`` plus ``reason``: another geometry type than (Multi)Polygon, or coordinates that
    are not nested lists of numbers."""
    kind, coordinates = FEATURE_REASONS
    parsed = features.withColumn("_head", geometry_head(geometry_col)) \
        .withColumn("_polygons", head_polygons("_head"))
    missing = F.exists("_polygons", lambda p: p.isNull() | F.exists(p, lambda r: r.isNull() | F.exists(
        r, lambda c: c.isNull() | (F.size(c) < 2) | F.exists(c, lambda x: x.isNull()))))
    return parsed.withColumn("reason", _first_of(
        (~F.coalesce(F.col("_head.type").isin("Polygon", "MultiPolygon"), F.lit(False)), kind),
        (F.col("_polygons").isNull() | F.coalesce(missing, F.lit(True)), coordinates))).drop("_head", "_polygons")


def wkt_reason(wkt_col: str) -> Column:
    """Why a text is no polygon geometry."""
    return _first_of((wkt_polygons(wkt_col).isNull(), WKT_REASONS[0]))


def reason_counts(reason: Column, reasons: tuple[str, ...]) -> dict[str, Column]:
    """One count per reason, named ``rejected_<reason>``."""
    return {f"rejected_{r.replace(' ', '_')}": F.count_if(reason == r) for r in reasons}


def observed_reasons(df: DataFrame, name: str, reason: Column, reasons: tuple[str, ...],
                     **extra: Column) -> tuple[DataFrame, Observation]:
    """Attach a row count and the counts by reason to ``df``'s next action."""
    return observed(df, name, **reason_counts(reason, reasons), **extra)


def ledger(df: DataFrame, source: str, reason: Column | str) -> DataFrame:
    """``(source, reason, rejected)``: one row per reason that occurs. Rows without a reason fall out by
    their count: a filter on the reason would be pushed below and work it out a second time."""
    why = F.col(reason) if isinstance(reason, str) else reason
    return df.select(why.alias("reason")).groupBy("reason").agg(F.count("reason").alias("rejected")) \
        .where("rejected > 0").select(F.lit(source).alias("source"), "reason", "rejected")
