"""Spec-driven fixed-width record slicing (one ``substring`` per field, no UDF)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import PY_WHITESPACE, plain_spacing

KEEP = "keep"                # as sliced (a blank stays a blank)
STRIP = "strip"              # strip; '' stays ''
STRIP_NULL = "strip_null"    # strip; '' -> null
RSTRIP_NULL = "rstrip_null"  # right strip only; '' -> null
DIGITS = "digits"            # strip; '' -> null; otherwise digits only (may become '')



@dataclass(frozen=True)
class FieldSpec:
    name: str
    start: int   # 0-based, inclusive
    end: int     # exclusive
    clean: str = STRIP_NULL


# The 96-character catalogue record layout (0-based start, exclusive end).
CATALOGUE_RECORD_LENGTH = 96
CATALOGUE_LAYOUT = (
    FieldSpec("record_type", 0, 1, KEEP),
    FieldSpec("event_time_raw", 1, 17, STRIP_NULL),
    FieldSpec("station_count_raw", 18, 21, STRIP_NULL),
    FieldSpec("latitude_raw", 22, 28, STRIP_NULL),
    FieldSpec("lat_dev_raw", 29, 32, STRIP_NULL),
    FieldSpec("longitude_raw", 33, 40, STRIP_NULL),
    FieldSpec("lon_dev_raw", 41, 44, STRIP_NULL),
    FieldSpec("depth_raw", 44, 52, STRIP),
    FieldSpec("magnitude_raw_1", 52, 54, STRIP),
    FieldSpec("magnitude_type_raw_1", 54, 55, STRIP_NULL),
    FieldSpec("magnitude_raw_2", 55, 57, STRIP_NULL),
    FieldSpec("magnitude_type_raw_2", 57, 58, STRIP_NULL),
    FieldSpec("region_lead_raw", 58, 64, DIGITS),
    FieldSpec("region_text_raw", 64, 93, RSTRIP_NULL),
    FieldSpec("shindo_raw", 93, 96, STRIP_NULL),
)


def _ws_literal() -> str:
    return "'" + "".join(f"\\u{ord(ch):04x}" for ch in PY_WHITESPACE) + "'"


def _strip_sql(s: str, plain: str | None, trailing_only: bool) -> str:
    side = "TRAILING" if trailing_only else "BOTH"
    full = f"TRIM({side} {_ws_literal()} FROM {s})"
    if plain is None:
        return full
    fast = f"TRIM({side} FROM {s})"
    return f"CASE WHEN {plain} THEN {fast} ELSE {full} END"


def _field_sql(line: str, f: FieldSpec, min_length: int, plain: str | None) -> str:
    s = f"substring({line}, {f.start + 1}, {f.end - f.start})"
    if f.clean == KEEP:
        v = s
    elif f.clean == STRIP:
        v = _strip_sql(s, plain, False)
    elif f.clean == STRIP_NULL:
        v = f"nullif({_strip_sql(s, plain, False)}, '')"
    elif f.clean == RSTRIP_NULL:
        v = f"nullif({_strip_sql(s, plain, True)}, '')"
    elif f.clean == DIGITS:
        v = f"regexp_replace(nullif({_strip_sql(s, plain, False)}, ''), '[^\\\\p{{Nd}}]', '')"
    else:
        raise ValueError(f"unknown cleaning rule {f.clean!r}")
    return f"CASE WHEN length({line}) >= {min_length} THEN {v} END"


def slice_columns(line: str = "raw_line", layout=CATALOGUE_LAYOUT,
                  min_length: int = CATALOGUE_RECORD_LENGTH,
                  plain: str | None = None) -> list[Column]:
    """One column per field. Lines shorter than ``min_length`` give all-null fields (the row
    is kept); longer lines are accepted and only the laid-out positions are read.
    ``plain`` names the per-line :func:`plain_spacing` flag column (fast trims when true).
    Each field is one SQL expression built from the spec (cheap to construct)."""
    ln = f"`{line}`"
    pl = f"`{plain}`" if plain else None
    return [F.expr(_field_sql(ln, f, min_length, pl)).alias(f.name) for f in layout]


def _trimmed_sql(line: str, f: FieldSpec, min_length: int, plain: str) -> str:
    s = f"substring({line}, {f.start + 1}, {f.end - f.start})"
    if f.clean != KEEP:
        s = _strip_sql(s, plain, trailing_only=f.clean == RSTRIP_NULL)
    return f"CASE WHEN length({line}) >= {min_length} THEN {s} END"


def _finish_sql(col: str, f: FieldSpec) -> str:
    if f.clean in (STRIP_NULL, RSTRIP_NULL):
        return f"nullif({col}, '')"
    if f.clean == DIGITS:
        return f"regexp_replace(nullif({col}, ''), '[^\\\\p{{Nd}}]', '')"
    return col


def slice_fixed_width(df: DataFrame, line_col: str = "raw_line", layout=CATALOGUE_LAYOUT,
                      min_length: int = CATALOGUE_RECORD_LENGTH,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Narrow transformation: raw line -> sliced string fields (plus pass-through ``keep``).

    Three projections, which Catalyst keeps apart because each result is read more than
    once: the per-line whitespace flag, the cut-and-trimmed fields, then the empty-to-null
    and digit rules (``nullif(x, '')`` reads ``x`` twice; on a separate projection the trim
    runs once per field — about 30% less slicing time).
    """
    ln = f"`{line_col}`"
    flagged = df.select(*keep, line_col, plain_spacing(line_col).alias("_plain"))
    trimmed = flagged.select(*keep, *[
        F.expr(_trimmed_sql(ln, f, min_length, "`_plain`")).alias(f"_f{i}")
        for i, f in enumerate(layout)])
    return trimmed.select(*keep, *[F.expr(_finish_sql(f"`_f{i}`", f)).alias(f.name)
                                   for i, f in enumerate(layout)])
