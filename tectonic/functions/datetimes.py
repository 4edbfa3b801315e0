"""Datetime coercion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .text import col_of

DEFAULT_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_datetime(c: Column | str, fmt: str = DEFAULT_DATETIME_FORMAT) -> Column:
    """Text -> timestamp without zone in one stated format; anything else -> null."""
    return F.try_to_timestamp(col_of(c), F.lit(fmt)).cast("timestamp_ntz")


def coerce_datetimes(df: DataFrame, columns: Sequence[str],
                     fmt: str = DEFAULT_DATETIME_FORMAT) -> DataFrame:
    """Replace the named columns (when present) by their parsed timestamps."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_datetime(c, fmt) for c in present})
