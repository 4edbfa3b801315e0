"""Polygon geometry as plain columns: ``array<array<array<array<double>>>>``.

A geometry is a list of polygons, each a list of rings (outer ring first, then holes), each
a list of ``[x, y]`` points (x = longitude). A Polygon is stored as a one-element list and
its type kept beside it so it can be written back as ``POLYGON``. Everything here is built
from Spark SQL functions (JSON parsing, regex, higher-order array functions) — no UDF and
no spatial library.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import MULTIPOLYGON, POLYGON
from .text import col_of

POLYGON_TYPE = "Polygon"
MULTIPOLYGON_TYPE = "MultiPolygon"


def _sql(c: Column | str) -> str:
    """Only plain column names are accepted where SQL text is assembled."""
    if not isinstance(c, str):
        raise TypeError("geometry helpers take column names")
    return f"`{c}`"


def _xy_only_sql(polys: str) -> str:
    """Drop any third ordinate: keep ``[x, y]`` of every point."""
    return (f"transform({polys}, poly -> transform(poly, ring -> "
            f"transform(ring, p -> slice(p, 1, 2))))")


def geojson_type(geometry_json: Column | str) -> Column:
    return F.get_json_object(col_of(geometry_json), "$.type")


GEOMETRY_HEAD = "struct<type:string,coordinates:string>"


def geometry_head(geometry_json: Column | str) -> Column:
    """GeoJSON geometry text -> ``struct<type, coordinates>`` with the coordinates kept as raw
    JSON text; parse once, then read the coordinates by type with :func:`head_polygons`."""
    return F.from_json(col_of(geometry_json), GEOMETRY_HEAD)


def head_polygons(head: str) -> Column:
    """Polygon list from a parsed geometry head (column name); other types -> null."""
    h = _sql(head)
    polys = (f"CASE WHEN {h}.type = '{MULTIPOLYGON_TYPE}' "
             f"THEN from_json({h}.coordinates, '{MULTIPOLYGON.simpleString()}') "
             f"WHEN {h}.type = '{POLYGON_TYPE}' "
             f"THEN array(from_json({h}.coordinates, '{POLYGON.simpleString()}')) END")
    return F.expr(_xy_only_sql(polys))


def geojson_polygons(geometry_json: str) -> Column:
    """GeoJSON geometry text -> polygon list; types other than (Multi)Polygon -> null."""
    g = _sql(geometry_json)
    head = f"from_json({g}, '{GEOMETRY_HEAD}')"
    polys = (f"CASE WHEN {head}.type = '{MULTIPOLYGON_TYPE}' "
             f"THEN from_json({head}.coordinates, '{MULTIPOLYGON.simpleString()}') "
             f"WHEN {head}.type = '{POLYGON_TYPE}' "
             f"THEN array(from_json({head}.coordinates, '{POLYGON.simpleString()}')) END")
    return F.expr(_xy_only_sql(polys))


def _ordinate_sql(x: str) -> str:
    """Shortest plain decimal text of a double. Java prints [1e-3, 1e7) in plain notation
    ("139.0", "35.5"), so only a trailing ".0" needs dropping; other magnitudes (E-notation)
    go through an exact decimal rendering with trailing zeros removed."""
    plain = f"cast({x} AS string)"
    exact = f"regexp_replace(cast(try_cast({x} AS decimal(38,20)) AS string), '\\\\.?0+$', '')"
    return (f"CASE WHEN {x} = 0 THEN '0' "
            f"WHEN abs({x}) >= 0.001D AND abs({x}) < 10000000D THEN "
            f"CASE WHEN endswith({plain}, '.0') THEN substring({plain}, 1, length({plain}) - 2) "
            f"ELSE {plain} END "
            f"ELSE {exact} END")


def ordinate_text(x: Column | str) -> Column:
    """Shortest plain decimal text of a coordinate: 139.0 -> '139', 1e-4 -> '0.0001'."""
    return F.expr(_ordinate_sql(_sql(x)))


def _polygon_sql(poly: str) -> str:
    point = f"concat({_ordinate_sql('pt[0]')}, ' ', {_ordinate_sql('pt[1]')})"
    ring = f"concat('(', array_join(transform(ring, pt -> {point}), ', '), ')')"
    return f"concat('(', array_join(transform({poly}, ring -> {ring}), ', '), ')')"


def polygons_to_wkt(polys: str, geometry_type: str) -> Column:
    """Polygon list -> WKT, ``POLYGON (...)`` or ``MULTIPOLYGON ((...))`` by ``geometry_type``."""
    p, t = _sql(polys), _sql(geometry_type)
    multi = (f"concat('MULTIPOLYGON (', "
             f"array_join(transform({p}, poly -> {_polygon_sql('poly')}), ', '), ')')")
    single = f"concat('POLYGON ', {_polygon_sql(f'{p}[0]')})"
    return F.expr(f"CASE WHEN {t} = '{POLYGON_TYPE}' THEN {single} "
                  f"WHEN {p} IS NOT NULL THEN {multi} END")


# A coordinate token: anything up to the next space, comma or parenthesis.
_TOKEN = r"[^\s,()]+"


def wkt_type(wkt: Column | str) -> Column:
    kind = F.upper(F.regexp_extract(col_of(wkt), r"^\s*([A-Za-z]+)", 1))
    return (F.when(kind == "MULTIPOLYGON", F.lit(MULTIPOLYGON_TYPE))
            .when(kind == "POLYGON", F.lit(POLYGON_TYPE)))


def wkt_polygons(wkt: Column | str) -> Column:
    """WKT (Multi)Polygon -> polygon list, by rewriting the text into JSON arrays. ``Z``, ``M`` and
    ``ZM`` shapes keep x and y; ``EMPTY`` is a list without polygons; numbers may be written as
    ``.5``, ``5.`` or ``+5``. Anything that is no polygon gives null."""
    w = col_of(wkt)
    body = F.regexp_replace(w, r"(?i)^\s*(?:MULTI)?POLYGON(?:\s*(?:ZM|Z|M)(?=[\s(]))?\s*", "")
    digits = F.regexp_replace(body, r"(?<![^\s(,])\+?(-?)\.(?=\d)", "$10.")
    digits = F.regexp_replace(F.regexp_replace(digits, r"(?<![^\s(,])\+(?=\d)", ""), r"(?<=\d)\.(?=[\s,)eE])", ".0")
    pairs = F.regexp_replace(digits, rf"({_TOKEN})\s+({_TOKEN})(?:\s+{_TOKEN})*", "[$1,$2]")
    as_json = F.translate(F.regexp_replace(pairs, r"\s+", ""), "()", "[]")
    kind = wkt_type(w)
    polygons = (F.when(kind == MULTIPOLYGON_TYPE, F.from_json(as_json, MULTIPOLYGON))
                .when(kind == POLYGON_TYPE, F.array(F.from_json(as_json, POLYGON))))
    empty = F.when(kind.isNotNull(), F.from_json(F.lit("[]"), MULTIPOLYGON))
    # one element, so that the parsed list is named and parsed once
    whole = F.transform(F.array(polygons), lambda ps: F.when(~F.exists(ps, _unread_polygon), ps))[0]
    return F.when(F.upper(F.trim(body)) == "EMPTY", empty).otherwise(whole)


def _unread_polygon(polygon: Column) -> Column:
    """Some ring, point or ordinate of the polygon is null (could not be read)."""
    return polygon.isNull() | F.exists(polygon, lambda r: r.isNull() | F.exists(
        r, lambda c: c.isNull() | F.exists(c, lambda x: x.isNull())))
