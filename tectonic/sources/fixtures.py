"""Deterministic test carriers derived from the driver tables.

``seed_lines`` turns every row of ``events`` into one 96-character catalogue line with
planted edge cases (short lines, 4-digit latitudes, blank and malformed depths and
magnitudes, 2- and 3-character intensity codes). The SQL text is written so that it runs
unchanged in Spark SQL and in DuckDB, which lets an independent engine check our results.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Integer arithmetic only; runs unchanged in Spark SQL and DuckDB. Lines are 96 characters,
# one in 97 is cut to 80.
SEED_LINE_SQL = """substr(concat(
 'J',
 cast(1998 + event_id % 24 as string), lpad(cast(1 + event_id % 12 as string),2,'0'), lpad(cast(1 + event_id % 28 as string),2,'0'),
 lpad(cast(event_id % 24 as string),2,'0'), lpad(cast(event_id % 60 as string),2,'0'), lpad(cast((event_id * 7) % 60 as string),2,'0'), lpad(cast(event_id % 100 as string),2,'0'),
 ' ', lpad(cast(event_id % 500 as string),3,' '),
 ' ', lpad(cast(24 + (event_id * 7) % 22 as string),2,'0'), lpad(cast((event_id * 13) % 60 as string),2,'0'),
 case when event_id % 29 = 0 then '  ' else lpad(cast((event_id * 37) % 100 as string),2,'0') end,
 ' ', '012',
 ' ', lpad(cast(122 + (event_id * 11) % 24 as string),3,'0'), lpad(cast((event_id * 17) % 60 as string),2,'0'), lpad(cast((event_id * 41) % 100 as string),2,'0'),
 ' ', '034',
 case when event_id % 3 = 0 then rpad(concat(' ', lpad(cast((event_id * 19) % 700 as string),3,' ')),8,' ')
      when event_id % 31 = 0 then '        '
      else lpad(cast((event_id * 104729) % 70000000 as string),8,'0') end,
 case when event_id % 23 = 0 then '  ' when event_id % 37 = 0 then 'A0' when event_id % 41 = 0 then '-3'
      else lpad(cast((event_id * 3) % 90 as string),2,'0') end,
 'V',
 case when event_id % 4 = 0 then '   ' else concat(lpad(cast((event_id * 5) % 80 as string),2,'0'),'D') end,
 ' 1', lpad(cast(event_id % 300 as string),3,'0'), ' ',
 rpad(concat('REGION ', cast(user_id % 50 as string)),29,' '),
 case when event_id % 5 = 0 then '   ' when event_id % 5 = 1 then concat(' ', cast(event_id % 10 as string), 'K')
      else concat(lpad(cast((event_id * 7) % 100 as string),2,'0'),'K') end),
 1, case when event_id % 97 = 0 then 80 else 96 end)"""

# `{events}` is a view name (DuckDB).
SEED_LINES_SQL = f"select event_id as line_id, {SEED_LINE_SQL} as raw_line from {{events}}"

BLANK_SQL = ("case when line_id % 13 = 0 then '   ' when line_id % 17 = 0 then '' "
             "else raw_line end")


# Seed lines with faults that the typing has to survive: a month 13, a 30th of February, letters in
# coordinates of the right width, tabs, no-break spaces, signs and fractions around station counts,
# letters in depth and magnitude. Runs unchanged in Spark SQL and DuckDB.
ROUGH_SQL = """case when length(raw_line) < 96 then raw_line
 when line_id % 19 = 0 then concat(substr(raw_line, 1, 5), '13', substr(raw_line, 8))
 when line_id % 43 = 0 then concat(substr(raw_line, 1, 5), '0230', substr(raw_line, 10))
 when line_id % 47 = 0 then concat(substr(raw_line, 1, 22), '3x4512', substr(raw_line, 29))
 when line_id % 53 = 0 then concat(substr(raw_line, 1, 22), 'N. Lat', ' 012 ', 'E. Long', substr(raw_line, 41))
 when line_id % 59 = 0 then concat(substr(raw_line, 1, 18), chr(9), '7 ', substr(raw_line, 22))
 when line_id % 61 = 0 then concat(substr(raw_line, 1, 18), chr(160), '9', chr(160), substr(raw_line, 22))
 when line_id % 67 = 0 then concat(substr(raw_line, 1, 18), '1.5', substr(raw_line, 22))
 when line_id % 71 = 0 then concat(substr(raw_line, 1, 18), '+7 ', substr(raw_line, 22))
 when line_id % 73 = 0 then concat(substr(raw_line, 1, 18), 'x1 ', substr(raw_line, 22))
 when line_id % 79 = 0 then concat(substr(raw_line, 1, 44), ' ab cde ', substr(raw_line, 53))
 when line_id % 83 = 0 then concat(substr(raw_line, 1, 52), chr(9), '5', substr(raw_line, 55))
 else raw_line end"""


def rough_lines(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Seed lines with planted faults (``ROUGH_SQL``), emitted by a generator as well."""
    row = F.struct("line_id", F.expr(ROUGH_SQL).alias("raw_line"))
    return seed_lines(spark, events).select(F.inline(F.array(row)))


def seed_lines(spark: SparkSession, events: DataFrame) -> DataFrame:
    """``(line_id, raw_line)``, one catalogue line per event row.

    The lines are emitted by a generator (``inline``): Catalyst does not push filters on
    generated columns below it, so later per-line predicates are evaluated on the produced
    line instead of re-deriving the line inside the scan (the synthetic stand-in for a text
    file scan, where such a pushed predicate would be cheap).
    """
    row = F.struct(F.col("event_id").alias("line_id"), F.expr(SEED_LINE_SQL).alias("raw_line"))
    return events.select(F.inline(F.array(row)))


def blanked_lines(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Seed lines with some replaced by empty or all-space lines."""
    return seed_lines(spark, events).select("line_id", F.expr(BLANK_SQL).alias("raw_line"))


# Test provinces (rings as [x, y], closed). They cover a hole, a shared
# border, a multi-part shape, oblique edges, Polygon mixed with MultiPolygon, two ids with
# the same name, and a duplicated id.
PROVINCE_FEATURES = (
    ("JPN.1_1", "Alpha", "MultiPolygon",
     [[[[124, 26], [134, 26], [134, 32], [124, 32], [124, 26]],
       [[126, 28], [128, 28], [128, 30], [126, 30], [126, 28]]]]),
    ("JPN.2_1", "Beta", "MultiPolygon",
     [[[[134, 26], [140, 26], [140, 32], [134, 32], [134, 26]]],
      [[[142, 27], [143, 27], [143, 28], [142, 28], [142, 27]]]]),
    ("JPN.3_1", "Gamma", "Polygon",
     [[[132, 33], [142, 33], [137, 43], [132, 33]]]),
    ("JPN.4_1", "Delta", "MultiPolygon",
     [[[[141, 36], [145, 36], [145, 45], [141, 45], [141, 36]]]]),
    ("JPN.5_1", "Beta", "Polygon",
     [[[123, 40], [127, 40], [127, 44], [123, 44], [123, 40]]]),
    ("JPN.1_1", "Alpha copy", "MultiPolygon",
     [[[[124, 26], [134, 26], [134, 32], [124, 32], [124, 26]],
       [[126, 28], [128, 28], [128, 30], [126, 30], [126, 28]]]]),
)


def province_geojson() -> str:
    """The fixture provinces as one GeoJSON FeatureCollection document."""
    features = [{"type": "Feature",
                 "properties": {"GID_1": gid, "NAME_1": name},
                 "geometry": {"type": gtype, "coordinates": coords}}
                for gid, name, gtype, coords in PROVINCE_FEATURES]
    return json.dumps({"type": "FeatureCollection", "features": features})


# Half width (degrees) of the square cell drawn around every event for the geometry queries.
CELL_HALF_WIDTH = 0.005


def event_cell_features(events: DataFrame, half: float = CELL_HALF_WIDTH) -> DataFrame:
    """One GeoJSON feature ``(line_id, value)`` per typed event: a square cell around the
    event, id ``EV.<region_lead>`` and name ``region_text`` (ids repeat across events, so the
    dimension dedup has work to do). Records without a second magnitude type become
    MultiPolygons, the rest Polygons, so both geometry types occur."""
    x, y = F.col("longitude"), F.col("latitude")
    ring = F.array(*[F.array(x + dx, y + dy) for dx, dy in
                     ((-half, -half), (half, -half), (half, half), (-half, half), (-half, -half))])
    coords = F.to_json(F.array(ring))
    multi = F.col("magnitude_type_2").isNull()
    geometry = F.concat(
        F.lit('{"type": "'), F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")),
        F.lit('", "coordinates": '),
        F.when(multi, F.concat(F.lit("["), coords, F.lit("]"))).otherwise(coords), F.lit("}"))
    props = F.to_json(F.struct(F.concat(F.lit("EV."), F.col("region_lead")).alias("GID_1"),
                               F.col("region_text").alias("NAME_1")))
    feature = F.concat(F.lit('{"type": "Feature", "properties": '), props, F.lit(', "geometry": '), geometry, F.lit("}"))
    # a null array gives no row; a filter on the coordinates would be pushed down to the lines and type them twice
    located = F.when(x.isNotNull() & y.isNotNull(), F.array(feature))
    return events.select("line_id", F.explode(located).alias("value"))


def _collection(features: Column) -> Column:
    return F.concat(F.lit('{"type": "FeatureCollection", "features": ['), features, F.lit("]}"))


def event_cell_documents(events: DataFrame, half: float = CELL_HALF_WIDTH) -> DataFrame:
    """One GeoJSON FeatureCollection document per typed event, holding its cell; a carrier that lets the
    GeoJSON / WKT operators run over data that grows with ``events``. Output ``(line_id, value)``."""
    return event_cell_features(events, half).select("line_id", _collection(F.col("value")).alias("value"))


# Features of one large document (some 25 MB of text).
COLLECTION_FEATURES = 100_000


def cell_collections(events: DataFrame, features: int = COLLECTION_FEATURES) -> DataFrame:
    """``value``: large FeatureCollections, each with the cells of ``features`` successive line ids."""
    return event_cell_features(events).groupBy(F.floor(F.col("line_id") / features).alias("document")) \
        .agg(_collection(F.array_join(F.collect_list("value"), ", ")).alias("value")).select("value")


def faulty_cell_documents(events: DataFrame) -> DataFrame:
    """Cell documents of which some hold a geometry type that is no polygon, some a text among the
    coordinates, some an id above ten characters and some no name."""
    return event_cell_documents(events).select("line_id", F.expr(r"""case
 when line_id % 11 = 0 then regexp_replace(value, '"(Multi)?Polygon"', '"Point"')
 when line_id % 13 = 0 then replace(value, '"coordinates": [', '"coordinates": ["x", ')
 when line_id % 17 = 0 then replace(value, '"GID_1":"EV.', '"GID_1":"EV.LONG-')
 when line_id % 23 = 0 then regexp_replace(value, '"NAME_1":"[^"]*"', '"NAME_1":null')
 else value end""").alias("value"))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Seed rows of a one-row-group file, dealt out over ``spark.sql.shuffle.partitions`` tasks so
    that the lines derived from them use every core. The number is given, because AQE would merge
    these few bytes of ids into one partition and derive all lines in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


# Triangles around [0.1, 0.9]; their corners and the points on their sides are written with the
# same double arithmetic in Spark and DuckDB, so both engines see the same doubles.
TRIANGLES = 60
TRIANGLE_SQL = """select g, (100 + (g * 37) % 800) / cast(1000 as double) as ux, (100 + (g * 71) % 800) / cast(1000 as double) as uy,
 (100 + (g * 113 + 400) % 800) / cast(1000 as double) as vx, (100 + (g * 59 + 150) % 800) / cast(1000 as double) as vy,
 (100 + (g * 29 + 650) % 800) / cast(1000 as double) as wx, (100 + (g * 97 + 300) % 800) / cast(1000 as double) as wy
from (select event_id % 60 as g from {events} group by event_id % 60) ids"""


def triangles(events: DataFrame) -> DataFrame:
    """``(shape_id, polygons)``: one triangle per remainder of the events' ids."""
    corners = events.sparkSession.sql(TRIANGLE_SQL.format(events="{events}"), events=events)
    ring = F.array(*[F.array(f"{c}x", f"{c}y") for c in "uvwu"])
    return corners.select(F.col("g").alias("shape_id"), F.array(F.array(ring)).alias("polygons"))


# A point for every event on a side of its triangle, as near as doubles come to it.
SIDE_POINT_SQL = """select e.event_id, ux + (e.event_id % 17) / cast(16 as double) * (vx - ux) as x, uy + (e.event_id % 17) / cast(16 as double) * (vy - uy) as y
from {events} e join ({triangles}) t on e.event_id % 60 = t.g"""


def side_points(events: DataFrame) -> DataFrame:
    sql = SIDE_POINT_SQL.format(events="{events}", triangles=TRIANGLE_SQL.format(events="{events}"))
    return events.sparkSession.sql(sql, events=events)
