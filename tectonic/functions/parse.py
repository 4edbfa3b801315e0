"""Typed parsing of catalogue fields.

Every cast from raw text is a ``try_*`` form: the session runs with ANSI on, and a preceding
filter does not protect a later strict cast because Catalyst may reorder evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col_of

EVENT_TIME_FORMAT = "yyyyMMddHHmmss"


def float32(c: Column | str) -> Column:
    """Parse as a 32-bit float (bad text -> null) and widen to double.

    The float step is kept on purpose: values are rounded to float precision before any
    arithmetic, exactly as the catalogue's original typing did.
    """
    return col_of(c).try_cast("float").cast("double")


def legacy_int(c: Column | str) -> Column:
    """String -> int with the non-ANSI rules: an optional fractional part is truncated.

    ``'12'`` -> 12, ``'12.7'`` -> 12, ``'.5'`` -> 0, ``'x'`` / ``''`` -> null.
    """
    s = F.btrim(col_of(c))
    whole = F.regexp_extract(s, r"^[+-]?([0-9]*)", 1)
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    number = F.concat(sign, F.when(whole == "", F.lit("0")).otherwise(whole))
    fractional = F.when(s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]*)$"), number.try_cast("int"))
    # plain integers (the common case) skip the regular expressions
    return F.coalesce(s.try_cast("int"), fractional)


def packed_coordinate(c: Column | str, degree_digits: int) -> Column:
    """Packed ``DDMMhh`` / ``DDDMMhh`` text -> decimal degrees.

    ``deg + min/60 + hh/100/3600`` with each part parsed as float; the last term divides
    hundredths of a minute as if they were arc-seconds, as the catalogue typing always has.
    """
    s = col_of(c)
    deg = float32(F.substring(s, 1, degree_digits))
    minutes = float32(F.substring(s, degree_digits + 1, 2))
    hundredths = float32(F.substring(s, degree_digits + 3, 2))
    return deg + minutes / 60 + hundredths / 100 / 3600


def event_timestamp(c: Column | str) -> Column:
    """First 14 characters as ``yyyyMMddHHmmss`` -> timestamp without zone; bad -> null."""
    text = F.substring(col_of(c), 1, 14)
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)).cast("timestamp_ntz")


def depth_km(c: Column | str) -> Column:
    """Depth text: more than 3 characters means an implied 5-decimal fixed point."""
    s = col_of(c)
    return F.when(F.length(s) > 3, float32(s) / 100000).otherwise(float32(s))


def magnitude(c: Column | str) -> Column:
    """Two-character magnitude in tenths (``'45'`` -> 4.5, ``'-3'`` -> -0.3)."""
    return float32(c) / 10


# Upper bounds (exclusive) of the two-digit intensity code and their class.
SHINDO_CLASSES = (
    (10, "0"), (20, "1"), (30, "2"), (40, "3"), (50, "4"),
    (56, "5-"), (60, "5+"), (66, "6-"), (70, "6+"),
)
SHINDO_TOP_CLASS = "7"


def shindo_code(c: Column | str) -> Column:
    """Numeric part of the intensity code: 2 leading digits if longer than 2, else 1."""
    s = col_of(c)
    lead = F.when(F.length(s) > 2, F.substring(s, 1, 2)).otherwise(F.substring(s, 1, 1))
    return lead.try_cast("int")


def shindo_class(c: Column | str) -> Column:
    """Intensity code -> JMA seismic intensity class; bad, empty or null -> null."""
    code = shindo_code(c)
    expr = None
    for bound, label in SHINDO_CLASSES:
        expr = (F.when(code < bound, F.lit(label)) if expr is None
                else expr.when(code < bound, F.lit(label)))
    return expr.when(code.isNotNull(), F.lit(SHINDO_TOP_CLASS))
