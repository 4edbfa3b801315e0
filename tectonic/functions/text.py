"""String cleaning expressions (substring, strip, blank->null, digit filter)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip()/str.isspace() treat as whitespace.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(c: Column | str, start: int, end: int) -> Column:
    """Python-style slice ``s[start:end]`` (0-based, end exclusive) as a substring."""
    return F.substring(col_of(c), start + 1, end - start)


# The whitespace characters below U+0080 other than the space (a regex class).
ASCII_OTHER_WHITESPACE = r"[\x{9}-\x{d}\x{1c}-\x{1f}]"


def plain_spacing(c: Column | str) -> Column:
    """True when the text is pure ASCII and its only whitespace is U+0020. For such text the
    space-only trims equal Python's strip exactly, and they are several times cheaper than
    trimming a character set. Compute once per line and pass it to :func:`strip`."""
    text = col_of(c)
    return (F.octet_length(text) == F.length(text)) & ~text.rlike(ASCII_OTHER_WHITESPACE)


def strip(c: Column | str, plain: Column | None = None) -> Column:
    """Remove leading and trailing whitespace (Python ``str.strip`` character set); with
    ``plain`` (see :func:`plain_spacing`) true, the space-only trim is used."""
    full = F.btrim(col_of(c), F.lit(PY_WHITESPACE))
    return full if plain is None else F.when(plain, F.trim(col_of(c))).otherwise(full)


def rstrip(c: Column | str, plain: Column | None = None) -> Column:
    """Remove trailing whitespace (Python ``str.rstrip``); ``plain`` as for :func:`strip`."""
    full = F.rtrim(col_of(c), F.lit(PY_WHITESPACE))
    return full if plain is None else F.when(plain, F.rtrim(col_of(c))).otherwise(full)


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True when nothing but whitespace is left (null counts as blank)."""
    return F.coalesce(strip(c) == F.lit(""), F.lit(True))


def digits_only(c: Column | str) -> Column:
    """Keep decimal digits only (may yield an empty string)."""
    return F.regexp_replace(col_of(c), r"[^\p{Nd}]", "")
