"""Slicing and cleaning, checked against a plain-Python model of the record layout."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tectonic.functions.text import PY_WHITESPACE, digits_only, rstrip, strip
from tectonic.operators.slicing import CATALOGUE_LAYOUT, slice_fixed_width
from tectonic.plans.bronze import nonblank_lines
from tectonic.schemas import SLICED_COLUMNS


def python_slice(line):
    """Independent model of the layout: Python slicing and str methods."""
    if len(line) < 96:
        return (None,) * 15
    s = lambda a, b: line[a:b].strip() or None
    lead = s(58, 64)
    if lead:
        lead = "".join(ch for ch in lead if ch.isdecimal())
    rest = line[44:58]
    return (line[0], s(1, 17), s(18, 21), s(22, 28), s(29, 32), s(33, 40), s(41, 44),
            rest[:8].strip(), rest[8:10].strip(), rest[10].strip() or None,
            rest[11:13].strip() or None, rest[13].strip() or None,
            lead, line[64:93].rstrip() or None, s(93, 96))


def sliced_rows(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line_id long, raw_line string")
    out = slice_fixed_width(df, keep=("line_id",)).orderBy("line_id").collect()
    return [tuple(r[c] for c in SLICED_COLUMNS) for r in out]


def test_layout_covers_96_chars():
    assert [f.name for f in CATALOGUE_LAYOUT] == list(SLICED_COLUMNS)
    assert max(f.end for f in CATALOGUE_LAYOUT) == 96


def test_blank_line_filter(spark):
    df = spark.createDataFrame([("aa",), ("",), ("  ",), ("bb",), ("\t　",)], "raw_line string")
    assert [r[0] for r in nonblank_lines(df).collect()] == ["aa", "bb"]


def test_short_and_long_lines(spark):
    base = "J" + "2000010112345678" + " " * 79
    assert len(base) == 96
    rows = sliced_rows(spark, [base[:80], base + "X" * 24])
    assert rows[0] == (None,) * 15
    assert rows[1][1] == "2000010112345678"
    assert rows[1] == python_slice(base + "X" * 24)


def test_region_lead_digits(spark):
    line = list(" " * 96)
    line[58:64] = list(" 1 07 ")
    other = list(" " * 96)
    other[58:64] = list("  -   ")
    rows = sliced_rows(spark, ["".join(line), "".join(other)])
    assert rows[0][12] == "107"
    assert rows[1][12] == ""


def test_blank_magnitudes(spark):
    line = "J" + "1" * 95
    line = line[:52] + "  " + line[54:55] + "  " + line[57:]
    row = sliced_rows(spark, [line])[0]
    assert row[8] == ""      # magnitude_raw_1: blank stays ''
    assert row[10] is None   # magnitude_raw_2: blank -> null


_chars = st.sampled_from(list("J0123456789 -AKVD.x") + list(PY_WHITESPACE[:6]) + ["　", "東"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(_chars, min_size=90, max_size=110), min_size=1, max_size=8))
def test_slice_matches_python_model(spark, lines):
    assert sliced_rows(spark, lines) == [python_slice(x) for x in lines]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(_chars, max_size=12), min_size=1, max_size=10))
def test_strip_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(strip("s"), rstrip("s"), digits_only("s")).collect()
    assert [tuple(r) for r in got] == [
        (v.strip(), v.rstrip(), "".join(c for c in v if c.isdecimal())) for v in values]


def test_record_type_kept_raw(spark):
    row = sliced_rows(spark, [" " + "0" * 95])[0]
    assert row[0] == " "
    df = spark.createDataFrame([("x",)], "raw_line string")
    assert slice_fixed_width(df).select(F.col("record_type")).first()[0] is None
