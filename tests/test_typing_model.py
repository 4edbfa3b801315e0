"""Typed events from random lines vs a plain-Python model of the catalogue typing."""

import datetime as dt

import numpy as np
from hypothesis import given, settings, strategies as st

from tectonic.operators.events import type_events
from tectonic.operators.slicing import slice_fixed_width

from test_text_and_slicing import python_slice


def f32(s):
    if s is None or s == "":
        return None
    try:
        return float(np.float32(float(s)))
    except ValueError:
        return None


def model(line):
    f = python_slice(line)
    (rt, t, stations, lat, latd, lon, lond, depth, m1, mt1, m2, mt2, lead, text, shindo) = f
    if lat is None or lon is None or len(lat) != 6 or len(lon) != 7:
        return None

    def coord(s, d):
        parts = [f32(s[:d]), f32(s[d:d + 2]), f32(s[d + 2:d + 4])]
        if None in parts:
            return None
        return parts[0] + parts[1] / 60 + parts[2] / 100 / 3600

    try:
        ts = dt.datetime.strptime(t[:14], "%Y%m%d%H%M%S") if t and len(t) >= 14 and t[:14].isdigit() else None
    except ValueError:
        ts = None
    try:
        n = int(float(stations)) if stations and stations.replace(".", "", 1).isdigit() else None
    except ValueError:
        n = None
    d = f32(depth)
    if d is not None and len(depth) > 3:
        d = d / 100000
    code = None
    if shindo:
        try:
            code = int(shindo[:2]) if len(shindo) > 2 else int(shindo[0])
        except ValueError:
            code = None
    cls = None
    if code is not None:
        for bound, label in ((10, "0"), (20, "1"), (30, "2"), (40, "3"), (50, "4"),
                             (56, "5-"), (60, "5+"), (66, "6-"), (70, "6+")):
            if code < bound:
                cls = label
                break
        else:
            cls = "7"
    mag = lambda s: None if f32(s) is None else f32(s) / 10
    return (rt, ts, n, coord(lat, 2), latd, coord(lon, 3), lond, d, mag(m1), mt1, mag(m2), mt2,
            lead, text, shindo, cls)


digits = st.text("0123456789", min_size=1, max_size=1)
noisy = st.text("0123456789 ", min_size=1, max_size=1)


@st.composite
def lines(draw):
    def run(n, alphabet=noisy):
        return "".join(draw(alphabet) for _ in range(n))
    ts = draw(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2030, 1, 1))).strftime("%Y%m%d%H%M%S")
    ts = ts + run(2, digits) if draw(st.booleans()) else run(16)
    body = ("J" + ts + " " + run(3) + " " + run(6, digits if draw(st.booleans()) else noisy)
            + " 012 " + run(7, digits) + " 034" + run(8) + run(2) + draw(st.sampled_from("V ")) + run(2)
            + draw(st.sampled_from("D ")) + run(6) + "REGION".ljust(29)
            + draw(st.sampled_from(["   ", " 5K", "12K", "K  ", "56K", "-5K"])))
    return body


@settings(max_examples=25, deadline=None)
@given(st.lists(lines(), min_size=1, max_size=10))
def test_typed_matches_model(spark, batch):
    assert all(len(x) == 96 for x in batch)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(batch)], "line_id long, raw_line string")
    got = {r["line_id"]: tuple(r)[1:] for r in type_events(slice_fixed_width(df, keep=("line_id",))).collect()}
    expected = {i: model(x) for i, x in enumerate(batch) if model(x) is not None}
    assert got == expected
