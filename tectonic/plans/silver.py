"""Silver: typed events, the province dimension and the keyed event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geometry import geometry_head, head_polygons, polygons_to_wkt
from ..functions.keys import event_key
from ..operators.dedup import first_by_order
from ..operators.events import type_events
from ..operators.spatial import (DEFAULT_BANDS_PER_DEGREE, DEFAULT_BROADCAST_BYTES,
                                 cell_index_from_wkt, tag_points)
from ..schemas import FACT_COLUMNS

typed_events = type_events


def dim_province(features: DataFrame) -> DataFrame:
    """Features -> ``(province_id, province_name, geometry WKT)``, one row per id.

    Duplicate ids keep the smallest (name, geometry) so reruns agree.
    """
    return first_by_order(province_shapes(features), ["province_id"],
                          ["province_name", "geometry"])


def province_shapes(features: DataFrame) -> DataFrame:
    """Features -> ``(province_id, province_name, geometry WKT)`` (no dedup)."""
    heads = features.select("province_id", "province_name",
                            geometry_head("geometry_json").alias("_g"))
    parsed = heads.select("province_id", "province_name", head_polygons("_g").alias("polygons"),
                          F.col("_g.type").alias("geometry_type"))
    return parsed.select("province_id", "province_name",
                         polygons_to_wkt("polygons", "geometry_type").alias("geometry"))


def keyed_events(events: DataFrame) -> DataFrame:
    return events.withColumn("event_id", event_key("event_time", "latitude", "longitude", "depth"))


def fact_projection(keyed: DataFrame) -> DataFrame:
    """The fact columns except the province (renames depth -> depth_km, text -> raw_place)."""
    return keyed.select(
        "event_id", "event_time", "station_count", "latitude", "longitude",
        F.col("depth").alias("depth_km"), "magnitude_1", "magnitude_type_1", "magnitude_2",
        "magnitude_type_2", F.col("region_text").alias("raw_place"), "shindo_value")


def tag_provinces(events: DataFrame, dim: DataFrame,
                  bands_per_degree: int | None = DEFAULT_BANDS_PER_DEGREE,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Every event with each province that covers its point (left join; null = offshore)."""
    index = cell_index_from_wkt(dim, "province_id", "geometry", bands_per_degree)
    return tag_points(events, index, "longitude", "latitude", broadcast_bytes)


def fact_events(events: DataFrame, dim: DataFrame,
                bands_per_degree: int | None = DEFAULT_BANDS_PER_DEGREE,
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Typed events -> one row per event key, tagged with the smallest covering province.

    Plan: key -> dedup (the only shuffle, on event_id, combined map-side) -> broadcast cell
    join -> collapse border points per event_id, which reuses the event_id partitioning and
    adds no exchange. All located copies of a key share the point, hence the province set. The
    key skips nulls, so a copy without a coordinate can share the key of a located one; the
    order puts non-null coordinates first, so the located copy is kept and gets its province.
    """
    unique = first_by_order(fact_projection(keyed_events(events)), ["event_id"],
                            ["latitude", "longitude"])
    tagged = tag_provinces(unique, dim, bands_per_degree, broadcast_bytes)
    others = [c for c in unique.columns if c != "event_id"]
    fact = tagged.groupBy("event_id").agg(
        F.min("province_id").alias("province_id"),
        *[F.any_value(c).alias(c) for c in others])
    return fact.select(*FACT_COLUMNS)
