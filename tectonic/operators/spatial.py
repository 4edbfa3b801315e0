"""Point-in-polygon tagging as an equi-join on grid cells (no spatial library, no cross join).

The plane is cut into cells, bands of latitude by columns of longitude. For every shape the index
holds the cells its boundary touches, each with the edges in it, and the cells wholly inside it,
without edges. A point joins its own cell's rows on the cell's numbers; cells outside a shape have
no row. Each row knows whether the cell's centre is inside the shape. A point is inside if its way
to the centre, along its latitude and then along the centre's longitude, crosses the cell's edges
an even number of times (centre inside) or an odd number (centre outside); a point on an edge is
inside. This is ``ST_Intersects(polygon, point)``: the boundary counts, the interior of a hole does
not, null and NaN coordinates never match. Sides are exact (``functions.orientation``); where the
way or the centre meets a vertex or runs along an edge, it counts as moved by an infinitesimal
amount, north and (still less) east.

Bands grow finer with the number of edges, so a cell of an ordinary boundary holds a few edges
however detailed the file is. Where very many edges share a cell (a finely drawn border along a
parallel), the cell is cut into strips of longitude until a strip holds about STRIP_EDGES; points
look up the strips of their cell in a table of just those cells. So no edge list grows with the
boundary file.

The index grows with the boundary, not with the points. Its size is bounded from measured lengths
and counts before it is broadcast; above the limit the same equi-keys give a shuffled join, where
AQE splits a hot cell and points without a cell get spread keys that match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.geometry import wkt_polygons
from ..functions.orientation import orientation_sql

# Bands per degree of latitude when fixed by the caller; by default chosen from the boundary so
# that a band of a shape holds about TARGET_EDGES_PER_BAND edges while copies of edges that span
# several cells stay in proportion to the edges.
DEFAULT_BANDS_PER_DEGREE = None
TARGET_EDGES_PER_BAND = 4
MIN_PER_DEGREE, MAX_PER_DEGREE = 1, 1_000_000
# A cell with more edges is cut into strips of about STRIP_EDGES each.
HEAVY_CELL, STRIP_EDGES = 64, 16
# Upper bound on the in-memory size of the index to broadcast it.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
_BYTES_PER_EDGE = 56
_BYTES_PER_ROW = 112
_NOWHERE = 1 << 40  # no band has such a number
_SPREAD = 4096


def cell_of(value: Column, per_degree: int) -> Column:
    """Number of a coordinate's band or column; the same expression for points and edges."""
    return F.floor(value * F.lit(float(per_degree)))


def _closed(ring: Column) -> Column:
    n = F.size(ring)
    return F.when(ring[0] == F.element_at(ring, n), ring) \
        .otherwise(F.concat(ring, F.array(ring[0])))


def _each(df: DataFrame, keep: list[str], array_col, alias: str) -> DataFrame:
    """One row per non-null element. ``explode_outer`` plus a filter on the generated column,
    because a plain ``explode`` lets Catalyst infer ``size(array) > 0`` and push it below the
    projection that builds the array, evaluating that (parsing) expression twice."""
    return (df.select(*keep, F.explode_outer(array_col).alias(alias))
            .where(F.col(alias).isNotNull()))


def polygon_edges(shapes: DataFrame, id_col: str = "province_id",
                  polygons_col: str = "polygons") -> DataFrame:
    """(id, polygon list) -> one row per edge ``(id, x1, y1, x2, y2)`` over all rings."""
    polys = _each(shapes, [id_col], polygons_col, "_poly")
    rings = (_each(polys, [id_col], "_poly", "_ring")
             .where(F.size("_ring") >= 2)
             .select(id_col, _closed(F.col("_ring")).alias("_ring")))
    pairs = F.expr("zip_with(slice(_ring, 1, size(_ring) - 1), slice(_ring, 2, size(_ring) - 1), "
                   "(a, b) -> named_struct('x1', a[0], 'y1', a[1], 'x2', b[0], 'y2', b[1]))")
    edges = _each(rings, [id_col], pairs, "_edge")
    return edges.select(id_col, "_edge.x1", "_edge.y1", "_edge.x2", "_edge.y2")



EDGE = ["x1", "y1", "x2", "y2"]


def _x_at(y: Column) -> Column:
    """Longitude of the edge at a latitude, kept within the edge's own (rounded)."""
    run = F.col("x1") + (y - F.col("y1")) * ((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    return F.least(F.greatest(run, F.least("x1", "x2")), F.greatest("x1", "x2"))


def _edge_bands(edges: DataFrame, id_col: str, rows: int) -> DataFrame:
    """One row per edge and band it touches, with a range of longitude that holds its part there
    (lo, hi) and the longitude where it crosses the band's middle (null if it does not)."""
    bands = edges.select(id_col, *EDGE, F.explode(F.sequence(
        cell_of(F.least("y1", "y2"), rows), cell_of(F.greatest("y1", "y2"), rows))).alias("band"))
    flat = F.col("y1") == F.col("y2")
    south = F.greatest(F.least("y1", "y2"), F.col("band") / F.lit(float(rows)))
    north = F.least(F.greatest("y1", "y2"), (F.col("band") + 1) / F.lit(float(rows)))
    margin = F.lit(1e-9) * (1 + F.abs(F.col("x1")) + F.abs(F.col("x2")))  # far above the rounding
    low = F.greatest(F.least(_x_at(south), _x_at(north)) - margin, F.least("x1", "x2"))
    high = F.least(F.greatest(_x_at(south), _x_at(north)) + margin, F.greatest("x1", "x2"))
    middle = (F.col("band") + 0.5) / F.lit(float(rows))
    return bands.select(
        id_col, *EDGE, "band",
        F.when(flat, F.least("x1", "x2")).otherwise(low).alias("lo"),
        F.when(flat, F.greatest("x1", "x2")).otherwise(high).alias("hi"),
        F.when((F.col("y1") > middle) != (F.col("y2") > middle), _x_at(middle)).alias("cross"))


def _strip_of(x: Column, columns: int, strips: Column) -> Column:
    """Strip of a longitude within its column (cut into ``strips`` equal ones)."""
    wide = x * F.lit(float(columns))
    return F.least(F.floor((wide - F.floor(wide)) * strips), strips - 1).cast("long")


def _place(column: str, strip: str) -> Column:
    """Strips in the order of longitude."""
    return F.struct(F.col(column).alias("c"), F.col(strip).alias("s"))


def _strips(df: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """``df`` (band, column) with the number of strips of each cell."""
    if heavy is None:
        return df.withColumn("strips", F.lit(1).cast("long"))
    return df.join(heavy, ["band", "column"], "left").withColumn("strips", F.coalesce("strips", F.lit(1)).cast("long"))


def _crossing_right() -> str:
    """Number of the cell's middle crossings that lie east of its centre."""
    side = orientation_sql("e.x1", "e.y1", "e.x2", "e.y2", "mid_x", "mid_y")
    east = (f"CASE WHEN (o > 0D OR (o = 0D AND (e.x2 > e.x1 OR (e.x2 = e.x1 AND e.y1 > e.y2)))) = (e.y2 > e.y1) "
            "THEN 1 ELSE 0 END")
    return (f"aggregate(filter(edges, e -> e.mid), 0, (n, e) -> n + transform(array({side}), o -> {east})[0])")


def cell_rows(edges: DataFrame, id_col: str, rows: int, columns: int, heavy: DataFrame | None = None) -> DataFrame:
    """The index: ``(id, band, column, strip, mid_x, mid_y, inside, edges)`` for every strip (cells
    that are not cut have the strip 0) that a shape's boundary touches or that lies inside it."""
    touched = _strips(_edge_bands(edges, id_col, rows).select("*", F.explode(F.sequence(
        cell_of(F.col("lo"), columns), cell_of(F.col("hi"), columns))).alias("column")), heavy)
    west, east = F.col("column") / F.lit(float(columns)), (F.col("column") + 1) / F.lit(float(columns))
    first = F.when(F.col("lo") <= west, 0).otherwise(_strip_of(F.col("lo"), columns, F.col("strips")))
    last = F.when(F.col("hi") >= east, F.col("strips") - 1).otherwise(_strip_of(F.col("hi"), columns, F.col("strips")))
    mid = (cell_of(F.col("cross"), columns) == F.col("column")) \
        & (_strip_of(F.col("cross"), columns, F.col("strips")) == F.col("strip"))
    # a margin may end in the strip beside: take that one too
    pieces = touched.select("*", F.explode(F.sequence(
        F.greatest(first - 1, F.lit(0)).cast("long"), F.least(last + 1, F.col("strips") - 1).cast("long"))).alias("strip"))
    cells = pieces.withColumn("mid", F.coalesce(mid, F.lit(False))).groupBy(id_col, "band", "column", "strip", "strips").agg(
        F.collect_list(F.struct(*EDGE, "mid")).alias("edges"), F.count_if("mid").alias("crossed"))
    row = Window.partitionBy(id_col, "band").orderBy("column", "strip")
    beyond = F.coalesce(F.sum("crossed").over(row.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    ordered = cells.select("*", beyond.alias("beyond"), F.lead(_place("column", "strip")).over(row).alias("following"))
    centred = ordered.select(
        id_col, "band", "column", "strip", "edges", "beyond",
        ((F.col("column") + (F.col("strip") + 0.5) / F.col("strips")) / F.lit(float(columns))).alias("mid_x"),
        ((F.col("band") + 0.5) / F.lit(float(rows))).alias("mid_y"))
    border = centred.select(
        id_col, "band", "column", "strip", "mid_x", "mid_y",
        (F.pmod(F.col("beyond") + F.expr(_crossing_right()), F.lit(2)) == 1).alias("inside"), "edges")
    # between two touched cells of a band nothing crosses: all inside or all outside
    gaps = _strips(ordered.where((F.col("beyond") % 2 == 1) & F.col("following").isNotNull()).select(
        id_col, "band", F.col("column").alias("from_c"), F.col("strip").alias("from_s"), "following",
        F.explode(F.sequence("column", "following.c")).alias("column")), heavy)
    filled = gaps.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)).alias("strip")).where(
        (_place("column", "strip") > _place("from_c", "from_s")) & (_place("column", "strip") < F.col("following")))
    inner = filled.select(id_col, "band", "column", "strip", F.lit(0.0).alias("mid_x"), F.lit(0.0).alias("mid_y"),
                          F.lit(True).alias("inside"), F.lit(None).cast(cells.schema["edges"].dataType).alias("edges"))
    return border.unionByName(inner)


def covers_sql(x: str, y: str) -> str:
    """SQL predicate over an index row (_edges, _inside, _mid_x, _mid_y): the point of that cell is
    inside the shape or on its boundary."""
    box = f"{x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    along = (f"((e.y1 > {y}) != (e.y2 > {y}) AND greatest({x}, _mid_x) >= least(e.x1, e.x2)"
             f" AND least({x}, _mid_x) <= greatest(e.x1, e.x2))")
    up = (f"((e.x1 > _mid_x) != (e.x2 > _mid_x) AND greatest({y}, _mid_y) >= least(e.y1, e.y2)"
          f" AND least({y}, _mid_y) <= greatest(e.y1, e.y2))")
    points = ", ".join(f"named_struct('x', {a}, 'y', {b})" for a, b in ((x, y), ("_mid_x", y), ("_mid_x", "_mid_y")))
    sides = f"transform(array({points}), p -> {orientation_sql('e.x1', 'e.y1', 'e.x2', 'e.y2', 'p.x', 'p.y')})"

    def left(i: int) -> str:
        return f"(o[{i}] > 0D OR (o[{i}] = 0D AND (e.x2 > e.x1 OR (e.x2 = e.x1 AND e.y1 > e.y2))))"
    step = (f"CASE WHEN {box} AND o[0] = 0D THEN -1 ELSE (s + CASE WHEN {along} AND {left(0)} != {left(1)} THEN 1 ELSE 0 END"
            f" + CASE WHEN {up} AND {left(1)} != {left(2)} THEN 1 ELSE 0 END) % 2 END")
    crossings = (f"aggregate(_edges, CASE WHEN _inside THEN 1 ELSE 0 END, (s, e) -> CASE WHEN s < 0 THEN s "
                 f"WHEN ({box}) OR {along} OR {up} THEN transform(array({sides}), o -> {step})[0] ELSE s END)")
    return f"(CASE WHEN _edges IS NULL THEN _inside ELSE {crossings} != 0 END)"


@dataclass
class CellIndex:
    """Cells of a set of shapes, with a bound on their size from measured counts and lengths."""
    table: DataFrame
    heavy: DataFrame | None
    id_col: str
    bands_per_degree: int
    columns_per_degree: int
    max_rows: int
    max_edges: int

    @property
    def estimated_bytes(self) -> int:
        return self.max_edges * _BYTES_PER_EDGE + self.max_rows * _BYTES_PER_ROW


def choose_per_degree(n_edges: int, height: float, run: float, area: float,
                      target: int = TARGET_EDGES_PER_BAND) -> tuple[int, int]:
    """(bands, columns) per degree: bands so that a shape's band holds about ``target`` edges, yet
    copies of edges (``run``, their summed extent, times the bands) stay below their number;
    columns so that all cells (``area`` of the shapes' boxes) stay in proportion to the edges."""
    bands = MIN_PER_DEGREE
    if n_edges and height > 0:
        wanted = min(n_edges / (height * target), n_edges / run if run > 0 else MAX_PER_DEGREE)
        bands = int(min(MAX_PER_DEGREE, max(MIN_PER_DEGREE, round(wanted))))
    columns = round(4 * n_edges / (area * bands)) if area > 0 else MIN_PER_DEGREE
    return bands, int(min(bands, max(MIN_PER_DEGREE, columns)))


def build_cell_index(shapes: DataFrame, id_col: str = "province_id", polygons_col: str = "polygons",
                     bands_per_degree: int | None = DEFAULT_BANDS_PER_DEGREE,
                     heavy_cell: int = HEAVY_CELL) -> CellIndex:
    """Index the shapes. One small job over the boundary measures its edges and boxes; from these
    follow the resolution (unless given) and the bound on the index: an edge of extents dx, dy
    touches at most dy * bands + dx * columns + 3 cells, a box has (h * bands + 2)(w * columns + 2)
    cells. Only a boundary with more than ``heavy_cell`` edges can have cells to be cut; these are
    counted by a second job."""
    edges = polygon_edges(shapes, id_col, polygons_col)
    low, high = F.least, F.greatest
    per_shape = edges.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(F.col("y2") - F.col("y1"))).alias("dy"), F.sum(F.abs(F.col("x2") - F.col("x1"))).alias("dx"),
        (F.max(high("y1", "y2")) - F.min(low("y1", "y2"))).alias("h"),
        (F.max(high("x1", "x2")) - F.min(low("x1", "x2"))).alias("w"))
    st = per_shape.agg(F.count(F.lit(1)).alias("shapes"), *[F.coalesce(F.sum(e), F.lit(0.0)).alias(name) for name, e in (
        ("n", F.col("n").cast("double")), ("dy", F.col("dy")), ("dx", F.col("dx")), ("h", F.col("h")), ("w", F.col("w")),
        ("area", F.col("h") * F.col("w")))]).first()
    n = int(st["n"])
    bands, columns = choose_per_degree(n, st["h"], st["dy"] + st["dx"], st["area"])
    if bands_per_degree:  # given: square cells
        bands = columns = bands_per_degree
    box_cells = int(st["area"] * bands * columns + 2 * (st["h"] * bands + st["w"] * columns) + 4 * st["shapes"]) + 1
    copies = int(st["dy"] * bands + st["dx"] * columns) + 3 * n
    heavy = None
    if n > heavy_cell:
        crowded = _edge_bands(edges, id_col, bands).select("band", F.explode(F.sequence(
            cell_of(F.col("lo"), columns), cell_of(F.col("hi"), columns))).alias("column")) \
            .groupBy("band", "column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_cell) \
            .select("band", "column", F.ceil(F.col("n") / STRIP_EDGES).alias("strips"), "n")
        cut = crowded.agg(F.count(F.lit(1)).alias("cells"), F.sum("strips").alias("strips"),
                          F.sum(F.col("n") * F.col("strips")).alias("copies")).first()
        if cut["cells"]:
            heavy = crowded.drop("n")
            # every shape may have all strips of a cut cell; an edge may touch all of its cell's
            box_cells += int(cut["strips"]) * int(st["shapes"])
            copies += int(cut["copies"])
    return CellIndex(cell_rows(edges, id_col, bands, columns, heavy), heavy, id_col, bands, columns, box_cells, copies)


def cell_index_from_wkt(dim: DataFrame, id_col: str = "province_id", wkt_col: str = "geometry",
                        bands_per_degree: int | None = DEFAULT_BANDS_PER_DEGREE) -> CellIndex:
    shapes = dim.select(id_col, wkt_polygons(wkt_col).alias("polygons"))
    return build_cell_index(shapes, id_col, "polygons", bands_per_degree)


def tag_points(points: DataFrame, index: CellIndex, x_col: str = "longitude",
               y_col: str = "latitude", broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
               ) -> DataFrame:
    """Left join every point to each shape that covers it (``id_col`` null when none).

    A point on a shared border gets one row per shape. The point side is never shuffled when the
    index is broadcast, so an upstream partitioning of ``points`` is kept; else points without a
    cell are spread over _SPREAD keys that no cell has.
    """
    fits = index.estimated_bytes <= broadcast_bytes
    idx = index.table.select(*[F.col(c).alias(f"_{c}") for c in ("band", "column", "strip", "mid_x", "mid_y", "inside", "edges")],
                             F.col(index.id_col).alias("_shape_id"))
    x, y = F.col(f"`{x_col}`"), F.col(f"`{y_col}`")
    placed = ~(x.isNull() | y.isNull() | F.isnan(x) | F.isnan(y))
    band = cell_of(y, index.bands_per_degree)
    apart = F.lit(None).cast("long")
    if not fits:
        apart = _NOWHERE + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in points.columns]), F.lit(_SPREAD))
    pts = points.withColumns({
        "_at_band": F.when(placed, band).otherwise(apart),
        "_at_column": F.when(placed, cell_of(x, index.columns_per_degree)).otherwise(0)})
    if index.heavy is None:
        pts = pts.withColumn("_at_strip", F.lit(0).cast("long"))
    else:
        cut = index.heavy.select(F.col("band").alias("_at_band"), F.col("column").alias("_at_column"),
                                 F.col("strips").alias("_strips"))
        pts = pts.join(F.broadcast(cut) if fits else cut, ["_at_band", "_at_column"], "left") \
            .withColumn("_at_strip", F.when(F.col("_strips").isNull(), 0).otherwise(
                _strip_of(x, index.columns_per_degree, F.col("_strips"))))
    cond = ((F.col("_at_band") == F.col("_band")) & (F.col("_at_column") == F.col("_column"))
            & (F.col("_at_strip") == F.col("_strip")) & F.expr(covers_sql(f"`{x_col}`", f"`{y_col}`")))
    return (pts.join(F.broadcast(idx) if fits else idx, cond, "left")
            .select(*[F.col(f"`{c}`") for c in points.columns], F.col("_shape_id").alias(index.id_col)))
