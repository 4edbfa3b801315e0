"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col_of


def event_key(event_time: Column | str, latitude: Column | str, longitude: Column | str,
              depth: Column | str) -> Column:
    """SHA-256 hex of ``time_lat_lon_depth`` rendered as strings (nulls are skipped)."""
    parts = [col_of(c).cast("string") for c in (event_time, latitude, longitude, depth)]
    return F.sha2(F.concat_ws("_", *parts), 256)
