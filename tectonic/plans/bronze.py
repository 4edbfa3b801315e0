"""Bronze: raw lines -> non-blank lines -> sliced string records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_blank
from ..operators.slicing import CATALOGUE_RECORD_LENGTH, slice_columns, slice_fixed_width


def nonblank_lines(lines: DataFrame, line_col: str = "raw_line") -> DataFrame:
    """Drop lines that hold nothing but whitespace."""
    return lines.filter(~is_blank(line_col))


def sliced_records(lines: DataFrame, line_col: str = "raw_line",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Fixed-width slice into the 15 catalogue fields (all strings, nothing converted)."""
    return slice_fixed_width(lines, line_col, keep=keep)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Concatenate record batches by position (UNION ALL)."""
    out = batches[0]
    for b in batches[1:]:
        out = out.union(b)
    return out


def ingest_metrics(lines: DataFrame, line_col: str = "raw_line",
                   file_col: str | None = "filename") -> DataFrame:
    """One-row load report for raw lines, in one aggregation pass: files, lines, blank lines,
    records, short records (sliced to all-null) and records that pass the coordinate-shape
    filter of the typing step."""
    blank = is_blank(line_col)
    fields = slice_columns(line_col)
    lat, lon = fields[3], fields[5]
    typed_ok = ~blank & (F.length(lat) == 6) & (F.length(lon) == 7)
    metrics = []
    if file_col:
        metrics.append(F.count_distinct(file_col).alias("num_files"))
    metrics += [
        F.count(F.lit(1)).alias("num_lines"),
        F.count_if(blank).alias("blank_lines"),
        F.count_if(~blank).alias("records"),
        F.count_if(~blank & (F.length(line_col) < CATALOGUE_RECORD_LENGTH)).alias("short_lines"),
        F.count_if(typed_ok).alias("typed_records"),
    ]
    return lines.agg(*metrics)
