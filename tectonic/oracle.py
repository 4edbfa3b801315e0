"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes its answer from the driver tables with plain SQL — substr/trim
slicing, CASE typing, brute-force edge parity over an explicit edge list, row_number
dedup — so it shares no plan with the Spark implementation. Used by the correctness gate.
"""

from __future__ import annotations

from .functions.text import PY_WHITESPACE
from .sources.fixtures import (BLANK_SQL, PROVINCE_FEATURES, ROUGH_SQL, SEED_LINES_SQL, SIDE_POINT_SQL,
                               TRIANGLE_SQL)

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"

SEED = SEED_LINES_SQL.format(events="events")


def _slice(col: str, start: int, length: int) -> str:
    return f"substr({col}, {start}, {length})"


def sliced_sql(seed: str = SEED) -> str:
    ok = "length(raw_line) >= 96"

    def f(start, length, how):
        s = _slice("raw_line", start, length)
        if how == "keep":
            e = s
        elif how == "strip":
            e = f"trim({s}, {WS})"
        elif how == "strip_null":
            e = f"nullif(trim({s}, {WS}), '')"
        elif how == "rstrip_null":
            e = f"nullif(rtrim({s}, {WS}), '')"
        elif how == "digits":
            e = f"regexp_replace(nullif(trim({s}, {WS}), ''), '[^\\p{{Nd}}]', '', 'g')"
        return f"CASE WHEN {ok} THEN {e} END"

    return f"""
SELECT line_id,
  {f(1, 1, 'keep')} AS record_type,
  {f(2, 16, 'strip_null')} AS event_time_raw,
  {f(19, 3, 'strip_null')} AS station_count_raw,
  {f(23, 6, 'strip_null')} AS latitude_raw,
  {f(30, 3, 'strip_null')} AS lat_dev_raw,
  {f(34, 7, 'strip_null')} AS longitude_raw,
  {f(42, 3, 'strip_null')} AS lon_dev_raw,
  {f(45, 8, 'strip')} AS depth_raw,
  {f(53, 2, 'strip')} AS magnitude_raw_1,
  {f(55, 1, 'strip_null')} AS magnitude_type_raw_1,
  {f(56, 2, 'strip_null')} AS magnitude_raw_2,
  {f(58, 1, 'strip_null')} AS magnitude_type_raw_2,
  {f(59, 6, 'digits')} AS region_lead_raw,
  {f(65, 29, 'rstrip_null')} AS region_text_raw,
  {f(94, 3, 'strip_null')} AS shindo_raw
FROM ({seed}) seed"""


def _f32(e: str) -> str:
    return f"CAST(TRY_CAST({e} AS FLOAT) AS DOUBLE)"


def _coord(c: str, deg: int) -> str:
    return (f"{_f32(f'substr({c}, 1, {deg})')} + {_f32(f'substr({c}, {deg + 1}, 2)')} / 60"
            f" + {_f32(f'substr({c}, {deg + 3}, 2)')} / 100 / 3600")


def typed_sql(seed: str = SEED) -> str:
    t14 = "substr(event_time_raw, 1, 14)"
    st = "trim(station_count_raw)"
    code = ("TRY_CAST(CASE WHEN length(shindo_raw) > 2 THEN substr(shindo_raw, 1, 2) "
            "ELSE substr(shindo_raw, 1, 1) END AS INTEGER)")
    return f"""
SELECT line_id, record_type,
  CASE WHEN regexp_full_match({t14}, '[0-9]{{14}}')
       THEN CAST(try_strptime({t14}, '%Y%m%d%H%M%S') AS TIMESTAMP) END AS event_time,
  CASE WHEN regexp_full_match({st}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]*)')
       THEN CAST(trunc(coalesce(TRY_CAST({st} AS DOUBLE), 0)) AS INTEGER) END AS station_count,
  {_coord('latitude_raw', 2)} AS latitude,
  lat_dev_raw AS lat_dev,
  {_coord('longitude_raw', 3)} AS longitude,
  lon_dev_raw AS lon_dev,
  CASE WHEN length(depth_raw) > 3 THEN {_f32('depth_raw')} / 100000 ELSE {_f32('depth_raw')} END AS depth,
  {_f32('magnitude_raw_1')} / 10 AS magnitude_1,
  magnitude_type_raw_1 AS magnitude_type_1,
  {_f32('magnitude_raw_2')} / 10 AS magnitude_2,
  magnitude_type_raw_2 AS magnitude_type_2,
  region_lead_raw AS region_lead,
  region_text_raw AS region_text,
  shindo_raw AS shindo,
  CASE WHEN code < 10 THEN '0' WHEN code < 20 THEN '1' WHEN code < 30 THEN '2'
       WHEN code < 40 THEN '3' WHEN code < 50 THEN '4' WHEN code < 56 THEN '5-'
       WHEN code < 60 THEN '5+' WHEN code < 66 THEN '6-' WHEN code < 70 THEN '6+'
       WHEN code IS NOT NULL THEN '7' END AS shindo_value
FROM (SELECT *, {code} AS code FROM ({sliced_sql(seed)}) s
      WHERE length(latitude_raw) = 6 AND length(longitude_raw) = 7) t"""


KEY = ("sha256(concat_ws('_', CAST(event_time AS VARCHAR), CAST(latitude AS VARCHAR), "
       "CAST(longitude AS VARCHAR), CAST(depth AS VARCHAR)))")


def keyed_sql(seed: str = SEED) -> str:
    return f"SELECT *, {KEY} AS event_id FROM ({typed_sql(seed)}) k"


def _dedup_provinces():
    best = {}
    for gid, name, gtype, coords in PROVINCE_FEATURES:
        if gid not in best or name < best[gid][0]:
            best[gid] = (name, gtype, coords)
    return best


def edges_values() -> str:
    rows = []
    for gid, (name, gtype, coords) in sorted(_dedup_provinces().items()):
        polys = coords if gtype == "MultiPolygon" else [coords]
        for poly in polys:
            for ring in poly:
                for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
                    rows.append(f"('{gid}', {float(x1)}::DOUBLE, {float(y1)}::DOUBLE, "
                                f"{float(x2)}::DOUBLE, {float(y2)}::DOUBLE)")
    return "VALUES " + ", ".join(rows)


def dim_values() -> str:
    rows = [f"('{gid}', '{name}')" for gid, (name, _, _) in sorted(_dedup_provinces().items())]
    return "(VALUES " + ", ".join(rows) + ") AS d(province_id, province_name)"


def tagged_sql(seed: str = SEED) -> str:
    """Brute force: every event against every edge, parity per (event, province)."""
    on_edge = ("((e.x2 - e.x1) * (k.latitude - e.y1) - (e.y2 - e.y1) * (k.longitude - e.x1) = 0"
               " AND k.longitude BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)"
               " AND k.latitude BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")
    crosses = ("((e.y1 > k.latitude) <> (e.y2 > k.latitude) AND k.longitude < "
               "(e.x2 - e.x1) * (k.latitude - e.y1) / (e.y2 - e.y1) + e.x1)")
    return f"""
SELECT k.*, h.province_id FROM keyed k
LEFT JOIN (
  SELECT k.line_id, e.province_id,
         bool_or({on_edge}) AS on_b,
         sum(CASE WHEN {crosses} THEN 1 ELSE 0 END) AS n_cross
  FROM (SELECT DISTINCT line_id, latitude, longitude FROM keyed) k CROSS JOIN edges e
  GROUP BY k.line_id, e.province_id) h
ON h.line_id = k.line_id AND (h.on_b OR h.n_cross % 2 = 1)"""


FACT_ORDER = ("province_id", "event_time", "station_count", "latitude", "longitude", "depth_km",
              "magnitude_1", "magnitude_type_1", "magnitude_2", "magnitude_type_2", "raw_place",
              "shindo_value")


def with_fact(body: str, seed: str = SEED) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in FACT_ORDER)
    return f"""
WITH keyed AS ({keyed_sql(seed)}),
edges(province_id, x1, y1, x2, y2) AS ({edges_values()}),
tagged AS ({tagged_sql(seed)}),
fact_rows AS (
  SELECT event_id, event_time, station_count, latitude, longitude, depth AS depth_km,
         magnitude_1, magnitude_type_1, magnitude_2, magnitude_type_2, province_id,
         region_text AS raw_place, shindo_value FROM tagged),
fact AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {order}) AS rn
    FROM fact_rows) WHERE rn = 1),
dim AS (SELECT * FROM {dim_values()})
{body}"""


DOUBLED_SEED = f"SELECT * FROM ({SEED}) a UNION ALL SELECT * FROM ({SEED}) b"


def _pct_exact(c: str, t: str) -> str:
    # round-half-up of 100*c/t at 2 decimals in integer arithmetic
    return f"CAST(CAST((20000 * {c} + {t}) // (2 * {t}) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(5,2))"


def _pct_double(c: str, t: str) -> str:
    return f"CAST(round(CAST(({c} / {t}) * 100 AS DECIMAL(20,13)), 2) AS DECIMAL(5,2))"


def _share(label_expr: str, label: str, count: str, pct: str) -> str:
    return with_fact(f"""
, counts AS (SELECT {label_expr} AS {label}, CAST(count(*) AS DOUBLE) AS {count}
             FROM fact GROUP BY 1),
total AS (SELECT sum({count}) AS t FROM counts)
SELECT {label}, {count}, {_pct_double(count, 't')} AS {pct}
FROM counts, total ORDER BY {label} NULLS LAST""")


DEPTH_CASE = """CASE WHEN depth_km < 50 THEN '<50 km'
  WHEN depth_km BETWEEN 50 AND 100 THEN '50-100 km'
  WHEN depth_km BETWEEN 100 AND 200 THEN '100-200 km'
  WHEN depth_km BETWEEN 200 AND 300 THEN '200-300 km'
  WHEN depth_km BETWEEN 300 AND 500 THEN '300-500 km'
  WHEN depth_km >= 500 THEN '>=500 km' ELSE 'Unknown' END"""

MAG_CASE = """CASE WHEN magnitude_1 < 3 THEN '<3'
  WHEN magnitude_1 BETWEEN 3 AND 4 THEN '3-4'
  WHEN magnitude_1 BETWEEN 4 AND 5 THEN '4-5'
  WHEN magnitude_1 BETWEEN 5 AND 6 THEN '5-6'
  WHEN magnitude_1 BETWEEN 6 AND 7 THEN '6-7'
  WHEN magnitude_1 >= 7 THEN '>=7' ELSE 'Unknown' END"""


def _pivot_cols() -> str:
    return ",\n  ".join(
        f'CAST(sum(CASE WHEN event_year = {y} THEN 1 ELSE 0 END) AS BIGINT) AS "{y}"'
        for y in range(2000, 2020))


SLICED_COLS = ("record_type, event_time_raw, station_count_raw, latitude_raw, lat_dev_raw, "
               "longitude_raw, lon_dev_raw, depth_raw, magnitude_raw_1, magnitude_type_raw_1, "
               "magnitude_raw_2, magnitude_type_raw_2, region_lead_raw, region_text_raw, "
               "shindo_raw")


def all_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_lines_nonblank"] = f"""
SELECT line_id, raw_line FROM (SELECT line_id, {BLANK_SQL} AS raw_line FROM ({SEED}) s) b
WHERE trim(raw_line, {WS}) <> ''"""
    q["fixed_width_slice"] = sliced_sql()
    q["typed_events"] = typed_sql()
    q["shindo_class"] = f"SELECT line_id, shindo, shindo_value FROM ({typed_sql()}) t"
    q["event_key"] = f"SELECT line_id, event_id FROM ({keyed_sql()}) k"
    q["union_batches"] = f"""
SELECT line_id, {SLICED_COLS} FROM ({sliced_sql()}) a
UNION ALL SELECT line_id, {SLICED_COLS} FROM ({sliced_sql()}) b"""
    q["sample_rows"] = f"""
SELECT * FROM ({keyed_sql()}) k
ORDER BY event_id, line_id LIMIT 5"""
    q["province_tag"] = with_fact("SELECT line_id, event_id, province_id FROM tagged")
    q["fact_events"] = with_fact("SELECT * FROM fact", DOUBLED_SEED)
    q["quakes_by_year"] = with_fact("""
SELECT CAST(year(event_time) AS INTEGER) AS event_year, count(*) AS total_quakes
FROM fact GROUP BY 1 ORDER BY 1 NULLS LAST""")
    q["quakes_by_month"] = with_fact(f"""
, monthly AS (SELECT CAST(month(event_time) AS INTEGER) AS event_month,
                     count(*) AS earthquake_count FROM fact GROUP BY 1),
total AS (SELECT sum(earthquake_count) AS t FROM monthly)
SELECT event_month, earthquake_count, {_pct_exact('earthquake_count', 't')} AS percentage
FROM monthly, total ORDER BY event_month NULLS LAST""")
    q["depth_distribution"] = _share(DEPTH_CASE, "depth_range", "depth_count", "percentage")
    q["magnitude_distribution"] = _share(MAG_CASE, "magnitude_range", "mag_count", "percentage")
    q["shindo_proportion"] = _share("shindo_value", "shindo_value", "shindo_count",
                                    "shindo_percentage")
    q["quakes_by_province"] = with_fact("""
SELECT coalesce(d.province_name, 'Offshore') AS province_name, count(*) AS earthquake_count
FROM fact f LEFT JOIN dim d ON f.province_id = d.province_id
GROUP BY 1 ORDER BY 2 DESC, 1""")
    q["province_year_pivot"] = with_fact(f"""
, src AS (SELECT coalesce(d.province_name, 'Offshore') AS province_name,
                 CAST(year(f.event_time) AS INTEGER) AS event_year
          FROM fact f LEFT JOIN dim d ON f.province_id = d.province_id)
SELECT province_name,
  {_pivot_cols()}
FROM src GROUP BY province_name ORDER BY province_name""")
    q.update(extra_sql())
    q.update(geometry_sql())
    q["border_points"] = border_sql()
    q.update(fault_sql())
    q.update(stored_sql())
    return q


def border_sql() -> str:
    """Every point against every triangle in whole numbers: doubles from 1/16 to 1 are multiples of
    2**-56, so differences and their products are exact in 128 bits."""
    triangles = TRIANGLE_SQL.format(events="events")
    points = SIDE_POINT_SQL.format(events="events", triangles=triangles)

    def whole(names):
        return ", ".join(f"CAST({n} * 72057594037927936 AS HUGEINT) AS {n}" for n in names)
    return f"""
WITH corners AS (SELECT g, {whole(("ux", "uy", "vx", "vy", "wx", "wy"))} FROM ({triangles}) t),
edges AS (
  SELECT g, ux AS x1, uy AS y1, vx AS x2, vy AS y2 FROM corners
  UNION ALL SELECT g, vx, vy, wx, wy FROM corners UNION ALL SELECT g, wx, wy, ux, uy FROM corners),
points AS (SELECT event_id, {whole(("x", "y"))} FROM ({points}) p),
sides AS (
  SELECT event_id, x, y, g, x1, y1, x2, y2, (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) AS side
  FROM points CROSS JOIN edges),
found AS (
  SELECT event_id, g FROM sides GROUP BY event_id, g
  HAVING bool_or(side = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2))
    OR count(*) FILTER (WHERE (y1 > y) <> (y2 > y) AND (side > 0) = (y2 > y1)) % 2 = 1)
SELECT p.event_id, f.g AS shape_id FROM points p LEFT JOIN found f USING (event_id)"""


def _num(e: str) -> str:
    # shortest decimal text of a double, '139.0' -> '139'
    return f"regexp_replace(CAST({e} AS VARCHAR), '\\.0$', '')"


def _pt(x: str, y: str) -> str:
    return f"{_num(x)} || ' ' || {_num(y)}"


def geometry_sql() -> dict[str, str]:
    from .sources.fixtures import CELL_HALF_WIDTH as h
    ring = " || ', ' || ".join(_pt(x, y) for x, y in
                               (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))
    cells = f"""
WITH cells AS (
  SELECT line_id, 'EV.' || region_lead AS province_id, region_text AS province_name,
         CASE WHEN magnitude_type_2 IS NULL THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
         longitude + (-{h})::DOUBLE AS x0, longitude + {h}::DOUBLE AS x1,
         latitude + (-{h})::DOUBLE AS y0, latitude + {h}::DOUBLE AS y1
  FROM ({typed_sql()}) t WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
shapes AS (
  SELECT *, CASE WHEN geometry_type = 'Polygon' THEN 'POLYGON ((' || {ring} || '))'
                 ELSE 'MULTIPOLYGON (((' || {ring} || ')))' END AS geometry
  FROM cells)
"""
    q = {}
    q["geo_features"] = cells + "SELECT province_id, province_name, geometry_type FROM shapes"
    q["geo_wkt"] = cells + "SELECT province_id, province_name, geometry FROM shapes"
    q["geo_wkt_roundtrip"] = cells + \
        "SELECT province_id, geometry, geometry AS geometry_again FROM shapes"
    q["geo_edges"] = cells + """
SELECT province_id, x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2 FROM shapes
UNION ALL SELECT province_id, x1, y0, x1, y1 FROM shapes
UNION ALL SELECT province_id, x1, y1, x0, y1 FROM shapes
UNION ALL SELECT province_id, x0, y1, x0, y0 FROM shapes"""
    q["dim_province"] = cells + """
SELECT province_id, province_name, geometry FROM (
  SELECT *, row_number() OVER (PARTITION BY province_id
                               ORDER BY province_name, geometry) AS rn FROM shapes)
WHERE rn = 1"""
    return q


BALANCE_SRC = """src AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal - o.largest_order AS c_acctbal
  FROM customer c JOIN (SELECT o_custkey, max(o_totalprice) AS largest_order
                        FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
  WHERE c.c_acctbal < 0)"""


def extra_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["upsert_by_key"] = f"""
WITH {BALANCE_SRC}
SELECT * FROM customer t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.c_custkey = t.c_custkey)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM src"""
    q["full_refresh"] = f"""
WITH {BALANCE_SRC}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM src"""
    q["coerce_datetime"] = """
SELECT o_orderkey, o_orderdate_text,
       CAST(try_strptime(o_orderdate_text, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS o_orderdate
FROM (SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%d/%m/%Y')
                  ELSE CAST(o_orderdate AS VARCHAR) END AS o_orderdate_text
      FROM orders) o"""
    nb = f"trim(raw_line, {WS}) <> ''"
    lat = f"length(nullif(trim(substr(raw_line, 23, 6), {WS}), '')) = 6"
    lon = f"length(nullif(trim(substr(raw_line, 34, 7), {WS}), '')) = 7"
    q["load_metrics"] = f"""
SELECT count(*) AS num_lines,
       count(*) FILTER (WHERE NOT ({nb})) AS blank_lines,
       count(*) FILTER (WHERE {nb}) AS records,
       count(*) FILTER (WHERE {nb} AND length(raw_line) < 96) AS short_lines,
       count(*) FILTER (WHERE {nb} AND length(raw_line) >= 96 AND {lat} AND {lon}) AS typed_records
FROM (SELECT line_id, {BLANK_SQL} AS raw_line FROM ({SEED}) s) raw"""
    q["pk_violations"] = f"""
SELECT event_id, count(*) AS row_count FROM ({keyed_sql(DOUBLED_SEED)}) k
GROUP BY event_id HAVING count(*) > 1"""
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM fact"
        for c in ("event_id", "event_time", "latitude", "longitude"))
    q["null_violations"] = with_fact(nulls)
    lengths = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE length({c}) > {n}) AS violations, "
        f"CAST({n} AS INTEGER) AS max_length FROM fact"
        for c, n in (("event_id", 64), ("magnitude_type_1", 10), ("province_id", 10)))
    q["length_violations"] = with_fact(lengths)
    q["fk_orphans"] = with_fact("""
SELECT event_id, province_id FROM fact
WHERE province_id IS NOT NULL
  AND province_id NOT IN (SELECT province_id FROM dim WHERE province_name <> 'Delta')""")
    q["fk_set_null"] = with_fact("""
SELECT f.* REPLACE (CASE WHEN d.province_id IS NOT NULL THEN f.province_id END AS province_id)
FROM fact f LEFT JOIN (SELECT DISTINCT province_id FROM dim WHERE province_name <> 'Delta') d
  ON f.province_id = d.province_id""")
    return q


ROUGH = f"SELECT line_id, {ROUGH_SQL} AS raw_line FROM ({SEED}) rough_seed"


def fault_sql() -> dict[str, str]:
    """Hard lines, broken rules and rejects."""
    q = {"rough_events": typed_sql(ROUGH)}
    rows = f"WITH rows AS (SELECT event_id, event_time, latitude, longitude FROM ({keyed_sql(ROUGH)}) k)"
    required = ("event_id", "event_time", "latitude", "longitude")
    q["fact_null_violations"] = rows + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM rows" for c in required)
    listed = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c} NOT NULL' END" for c in required)
    q["fact_broken_rules"] = rows + f"""
SELECT * FROM (SELECT *, concat_ws(', ', {listed}) AS broken_rules FROM rows) WHERE broken_rules <> ''"""
    cells = geometry_sql()["geo_features"]
    cells = cells[:cells.rindex("SELECT province_id")].rstrip() + """,
faulty AS (
  SELECT CASE WHEN line_id % 11 = 0 OR line_id % 13 = 0 OR line_id % 17 <> 0 THEN province_id
              ELSE replace(province_id, 'EV.', 'EV.LONG-') END AS province_id,
    CASE WHEN line_id % 11 = 0 OR line_id % 13 = 0 OR line_id % 17 = 0 OR line_id % 23 <> 0 THEN province_name
      END AS province_name,
    CASE WHEN line_id % 11 = 0 OR line_id % 13 = 0 THEN NULL ELSE geometry END AS geometry,
    CASE WHEN line_id % 11 = 0 THEN 'geometry type' WHEN line_id % 13 = 0 THEN 'coordinates' END AS reason
  FROM shapes)"""
    names = ("province_id", "province_name", "geometry")
    q["dim_rule_violations"] = cells + " UNION ALL ".join([
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations, "
        "CAST(NULL AS INTEGER) AS max_length FROM faulty" for c in names] + [
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE length({c}) > {n}) AS violations, {n} AS max_length FROM faulty"
        for c, n in (("province_id", 10), ("province_name", 255))])
    rules = ", ".join([f"CASE WHEN {c} IS NULL THEN '{c} NOT NULL' END" for c in names]
                      + ["CASE WHEN length(province_id) > 10 THEN 'province_id VARCHAR(10)' END"])
    q["dim_quarantine"] = cells + f"""
SELECT province_id, province_name, geometry, concat_ws(', ', {rules}) AS broken_rules FROM (
  SELECT *, row_number() OVER (PARTITION BY province_id
                               ORDER BY province_name NULLS LAST, geometry NULLS LAST) AS rn FROM faulty)
WHERE rn = 1"""
    nb = f"trim(raw_line, {WS}) <> ''"
    lat, lon = (f"nullif(trim(substr(raw_line, {a}, {n}), {WS}), '')" for a, n in ((23, 6), (34, 7)))
    t14 = f"substr(nullif(trim(substr(raw_line, 2, 16), {WS}), ''), 1, 14)"
    q["reject_ledger"] = cells + f""",
raw AS (SELECT {BLANK_SQL} AS raw_line FROM ({ROUGH}) r),
reasons AS (
  SELECT 'lines' AS source, CASE WHEN NOT ({nb}) THEN 'blank' WHEN length(raw_line) < 96 THEN 'short'
    WHEN NOT coalesce(length({lat}) = 6 AND length({lon}) = 7, false) THEN 'coordinate shape'
    WHEN ({_coord(lat, 2)}) IS NULL OR ({_coord(lon, 3)}) IS NULL THEN 'coordinate value'
    WHEN NOT coalesce(regexp_full_match({t14}, '[0-9]{{14}}'), false) OR try_strptime({t14}, '%Y%m%d%H%M%S') IS NULL
      THEN 'event time' END AS reason FROM raw
  UNION ALL SELECT 'features', reason FROM faulty
  UNION ALL SELECT 'geometries', CASE WHEN province_id LIKE '%7' THEN 'wkt' END FROM shapes)
SELECT source, reason, count(*) AS rejected FROM reasons WHERE reason IS NOT NULL GROUP BY source, reason"""
    return q


def stored_sql() -> dict[str, str]:
    """Ordered models, pivots and data written and read back."""
    q = {}
    models = [("gold_total_quakes_by_year", "year(event_time)", "label NULLS LAST"),
              ("gold_earthquake_by_month", "month(event_time)", "label NULLS LAST"),
              ("gold_earthquake_depth_distribution", DEPTH_CASE, "label NULLS LAST"),
              ("gold_earthquake_by_province", "coalesce(province_name, 'Offshore')", "n DESC, label"),
              ("gold_quake_shindo_proportion", "shindo_value", "label NULLS LAST")]
    q["gold_ranks"] = with_fact(" UNION ALL ".join(f"""
SELECT '{name}' AS model, row_number() OVER (ORDER BY {order}) AS row_rank, CAST(label AS VARCHAR) AS label FROM (
  SELECT {label} AS label, count(*) AS n FROM fact LEFT JOIN dim USING (province_id) GROUP BY 1)"""
                                                   for name, label, order in models))
    q["event_ranks"] = f"""
SELECT line_id, magnitude_1, row_number() OVER (ORDER BY magnitude_1 DESC NULLS LAST, line_id) AS row_rank
FROM ({typed_sql()}) t"""
    classes = ("0", "1", "2", "3", "4", "5-", "5+", "6-", "6+", "7")
    cases = [("n", "sum", "1", "ELSE 0"), ("stations", "sum", "station_count", "ELSE 0"),
             ("most", "max", "station_count", ""), ("counted", "count", "station_count", "")]
    listed = ", ".join(f"CAST({agg}(CASE WHEN shindo_value = '{c}' THEN {then} {other} END) AS BIGINT) AS \"{prefix}_{c}\""
                       for prefix, agg, then, other in cases for c in classes)
    q["region_class_pivots"] = f"SELECT region_text, {listed} FROM ({typed_sql()}) t GROUP BY region_text"
    q["split_boundaries"] = geometry_sql()["geo_wkt"]
    q["upsert_buckets"] = extra_sql()["upsert_by_key"]
    q["stored_lines"] = f"SELECT {BLANK_SQL} AS raw_line FROM ({SEED}) s"
    q["stored_objects"] = " UNION ALL ".join(
        f"SELECT '{name}' AS stored_as, line_id, raw_line FROM ({SEED}) s" for name in ("bronze_lines", "records", "objects"))
    return q
