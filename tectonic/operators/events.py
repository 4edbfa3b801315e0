"""Sliced catalogue fields -> typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.parse import (depth_km, event_timestamp, legacy_int, magnitude,
                               packed_coordinate, shindo_class)
from ..schemas import EVENT_COLUMNS, SLICED_COLUMNS

LATITUDE_WIDTH = 6
LONGITUDE_WIDTH = 7


def name_sliced(sliced: DataFrame) -> DataFrame:
    """Attach the event column names to the 15 sliced fields, by position."""
    return sliced.withColumnsRenamed(dict(zip(SLICED_COLUMNS, EVENT_COLUMNS)))


def type_events(sliced: DataFrame) -> DataFrame:
    """Filter on coordinate shape, then type every field (16 columns, nothing dropped).

    The filter tests text length only: a 6-character non-numeric latitude survives as a
    null coordinate. Other columns of ``sliced`` (for example a line id) pass through.
    """
    named = name_sliced(sliced)
    shaped = named.filter((F.length("latitude") == LATITUDE_WIDTH)
                          & (F.length("longitude") == LONGITUDE_WIDTH))
    return shaped.withColumns({
        "event_time": event_timestamp("event_time"),
        "station_count": legacy_int("station_count"),
        "depth": depth_km("depth"),
        "latitude": packed_coordinate("latitude", 2),
        "longitude": packed_coordinate("longitude", 3),
        "magnitude_1": magnitude("magnitude_1"),
        "magnitude_2": magnitude("magnitude_2"),
        "shindo_value": shindo_class("shindo"),
    })
