"""Typed parsing: coordinates, time, casts, depth, magnitude, intensity class, keys, bins."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tectonic.functions.bins import DEPTH_BINS, MAGNITUDE_BINS, bin_label
from tectonic.functions.keys import event_key
from tectonic.functions.parse import (depth_km, event_timestamp, legacy_int, magnitude,
                                      packed_coordinate, shindo_class)
from tectonic.operators.events import type_events
from tectonic.schemas import SLICED_COLUMNS


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_coordinates(spark):
    lat = one_col(spark, ["354230"], lambda c: packed_coordinate(c, 2))[0]
    assert lat == pytest.approx(35 + 42 / 60 + 30 / 100 / 3600)
    assert one_col(spark, ["1394500"], lambda c: packed_coordinate(c, 3)) == [139.75]
    assert one_col(spark, ["35x230"], lambda c: packed_coordinate(c, 2)) == [None]


def test_coordinate_filter_drops_bad_shapes(spark):
    rows = []
    for lat in ["354230", "3542", None]:
        r = dict.fromkeys(SLICED_COLUMNS)
        r.update(latitude_raw=lat, longitude_raw="1394500", depth_raw="", magnitude_raw_1="")
        rows.append(tuple(r[c] for c in SLICED_COLUMNS))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SLICED_COLUMNS))
    out = type_events(df).collect()
    assert len(out) == 1 and out[0]["latitude"] == pytest.approx(35.700083333)
    assert len(out[0]) == 16 and out[0]["depth"] is None and out[0]["magnitude_1"] is None


def test_event_time(spark):
    got = one_col(spark, ["2000010112345678", "2000010112346078", "2000 10112345678",
                          "200001011234", None], event_timestamp)
    assert got == [dt.datetime(2000, 1, 1, 12, 34, 56), None, None, None, None]


def test_station_count(spark):
    assert one_col(spark, [" 12", "", "x", "12.7", ".5", "-3", None], legacy_int) == \
        [12, None, None, 12, 0, -3, None]


def test_depth_and_magnitude(spark):
    got = one_col(spark, ["10", "01234567", "01234", "", "99999999"], depth_km)
    assert got[:4] == [10.0, 1234567 / 100000, 1234 / 100000, None]
    import struct
    f32 = struct.unpack("f", struct.pack("f", 99999999.0))[0]
    assert got[4] == f32 / 100000          # float rounding kept before scaling
    assert one_col(spark, ["45", "-3", "A0", ""], magnitude) == [4.5, -0.3, None, None]


def test_shindo_classes(spark):
    values = ["12K", "5K", "99K", "55K", "56K", "65K", "66K", "K", "", None, "-5K", "09K"]
    assert one_col(spark, values, shindo_class) == \
        ["1", "0", "7", "5-", "5+", "6-", "6+", None, None, None, "0", "0"]


def test_event_key_skips_nulls(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1, 12, 34, 56), 35.5, 139.75, None)],
                               "t timestamp_ntz, lat double, lon double, d double")
    got = df.select(event_key("t", "lat", "lon", "d")).first()[0]
    assert got == hashlib.sha256(b"2000-01-01 12:34:56_35.5_139.75").hexdigest()


def test_bins(spark):
    mags = one_col(spark, [2.9, 3.0, 4.0, 7.0, 7.1, None, math.nan],
                   lambda c: bin_label(c, MAGNITUDE_BINS), "double")
    assert mags == ["<3", "3-4", "3-4", "6-7", ">=7", "Unknown", ">=7"]
    depths = one_col(spark, [49.9, 100.0, 500.0, 500.1, None],
                     lambda c: bin_label(c, DEPTH_BINS), "double")
    assert depths == ["<50 km", "50-100 km", "300-500 km", ">=500 km", "Unknown"]
