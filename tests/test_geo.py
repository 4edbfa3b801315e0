"""GeoJSON/WKT handling and the point-in-polygon join over cells."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tectonic.functions.geometry import (geojson_polygons, geojson_type, ordinate_text,
                                         polygons_to_wkt, wkt_polygons, wkt_type)
from tectonic.operators.spatial import build_cell_index, cell_index_from_wkt, tag_points
from tectonic.plans.silver import dim_province, tag_provinces
from tectonic.sources.fixtures import PROVINCE_FEATURES, province_geojson
from tectonic.sources.geojson import features_from_text, read_features


@pytest.fixture(scope="module")
def dim(spark):
    docs = spark.createDataFrame([(province_geojson(),)], "value string")
    return dim_province(features_from_text(docs)).cache()


def test_dim_dedup_and_wkt(dim):
    rows = {r["province_id"]: r for r in dim.collect()}
    assert sorted(rows) == ["JPN.1_1", "JPN.2_1", "JPN.3_1", "JPN.4_1", "JPN.5_1"]
    assert rows["JPN.1_1"]["province_name"] == "Alpha"
    assert rows["JPN.1_1"]["geometry"] == (
        "MULTIPOLYGON (((124 26, 134 26, 134 32, 124 32, 124 26), "
        "(126 28, 128 28, 128 30, 126 30, 126 28)))")
    assert rows["JPN.3_1"]["geometry"] == "POLYGON ((132 33, 142 33, 137 43, 132 33))"


def test_read_geojson_file(spark, tmp_dir):
    path = f"{tmp_dir}/provinces.json"
    with open(path, "w") as f:
        f.write(json.dumps(json.loads(province_geojson()), indent=2))
    feats = read_features(spark, path)
    assert feats.count() == len(PROVINCE_FEATURES)
    assert set(r[0] for r in feats.select(geojson_type("geometry_json")).collect()) == \
        {"Polygon", "MultiPolygon"}


def test_wkt_round_trip(spark):
    wkts = ["POLYGON ((132 33, 142 33, 137 43, 132 33))",
            "MULTIPOLYGON (((124 26, 134 26, 134 32, 124 32, 124 26), "
            "(126 28, 128 28, 128 30, 126 30, 126 28)), ((1.5 2.25, 3 4, 5 6, 1.5 2.25)))",
            "POLYGON ((-0.0001 0.5, 139.1234567 35.70008333333333, 1 1, -0.0001 0.5))"]
    df = spark.createDataFrame([(w,) for w in wkts], "w string")
    parsed = df.select(wkt_polygons("w").alias("p"), wkt_type("w").alias("t"))
    back = parsed.select(polygons_to_wkt("p", "t")).collect()
    assert [r[0] for r in back] == wkts


def test_ordinate_text(spark):
    df = spark.createDataFrame([(139.0,), (0.0001,), (139.1234567,), (-35.5,), (1e-7,)], "x double")
    assert [r[0] for r in df.select(ordinate_text("x")).collect()] == \
        ["139", "0.0001", "139.1234567", "-35.5", "0.0000001"]


def test_geojson_polygon_wrapped(spark):
    g = json.dumps({"type": "Polygon", "coordinates": [[[0, 0, 5], [1, 0, 5], [0, 1, 5], [0, 0, 5]]]})
    df = spark.createDataFrame([(g,), ('{"type": "Point", "coordinates": [1, 2]}',)], "g string")
    got = [r[0] for r in df.select(geojson_polygons("g")).collect()]
    assert got[0] == [[[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]]]
    assert got[1] is None


CASES = [  # (lon, lat) -> expected provinces (before dedup)
    ((127.0, 29.0), set()),                  # inside the hole
    ((126.0, 29.0), {"JPN.1_1"}),            # on the hole's edge
    ((134.0, 29.0), {"JPN.1_1", "JPN.2_1"}),  # shared border
    ((125.0, 27.0), {"JPN.1_1"}),
    ((134.0, 32.0), {"JPN.1_1", "JPN.2_1"}),  # shared corner
    ((142.5, 27.5), {"JPN.2_1"}),            # second part
    ((137.0, 38.0), {"JPN.3_1"}),            # oblique triangle
    ((141.5, 37.0), {"JPN.4_1"}),            # right of the oblique edge (x=140 at y=37)
    ((140.0, 37.0), {"JPN.3_1"}),            # exactly on the oblique edge
    ((150.0, 30.0), set()),
    ((None, 29.0), set()),
]


def test_point_cases(spark, dim):
    pts = spark.createDataFrame([(i, x, y) for i, ((x, y), _) in enumerate(CASES)],
                                "pid int, longitude double, latitude double")
    got = {}
    for r in tag_provinces(pts, dim).collect():
        got.setdefault(r["pid"], set())
        if r["province_id"]:
            got[r["pid"]].add(r["province_id"])
    assert got == {i: exp for i, (_, exp) in enumerate(CASES)}


def brute_force(x, y):
    """Independent even-odd + on-boundary test in Python."""
    out = set()
    seen = set()
    for gid, _, gtype, coords in PROVINCE_FEATURES:
        if gid in seen:
            continue
        seen.add(gid)
        polys = coords if gtype == "MultiPolygon" else [coords]
        inside = False
        on = False
        for poly in polys:
            for ring in poly:
                for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
                    if ((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0
                            and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)):
                        on = True
                    if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                        inside = not inside
        if inside or on:
            out.add(gid)
    return out


@pytest.mark.parametrize("bands", [1, 10, 37])
def test_cell_join_equals_brute_force(spark, dim, bands):
    rnd = random.Random(bands)
    pts = [(i, round(rnd.uniform(120, 147), rnd.choice([0, 1, 3])),
            round(rnd.uniform(24, 47), rnd.choice([0, 1, 3]))) for i in range(1500)]
    df = spark.createDataFrame(pts, "pid int, longitude double, latitude double")
    got = {}
    for r in tag_provinces(df, dim, bands_per_degree=bands).collect():
        got.setdefault(r["pid"], set())
        if r["province_id"]:
            got[r["pid"]].add(r["province_id"])
    assert got == {i: brute_force(x, y) for i, x, y in pts}


def test_join_plan_is_broadcast_equi_join(spark, dim):
    pts = spark.range(100).select(F.col("id").alias("pid"),
                                  (F.col("id") % 30 + 120).cast("double").alias("longitude"),
                                  (F.col("id") % 20 + 25).cast("double").alias("latitude"))
    plan = tag_provinces(pts, dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_over_limit_falls_back_to_shuffled_join(spark, dim):
    from tectonic.operators.spatial import cell_index_from_wkt
    index = cell_index_from_wkt(dim)
    pts = spark.createDataFrame([(1, 125.0, 27.0)], "pid int, longitude double, latitude double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = tag_points(pts, index, broadcast_bytes=0)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
        assert [r["province_id"] for r in df.collect()] == ["JPN.1_1"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_auto_resolution_on_detailed_boundary(spark):
    """A finely drawn shape gets finer bands; the result still equals brute force."""
    import math
    from tectonic.operators.spatial import build_cell_index, choose_per_degree
    n = 4000
    ring = [[round(140 + 2 * math.cos(2 * math.pi * k / n) + 0.05 * math.sin(37 * k), 6),
             round(35 + 2 * math.sin(2 * math.pi * k / n), 6)] for k in range(n)]
    ring.append(ring[0])
    shapes = spark.createDataFrame([("C", [[ring]])],
                                   "province_id string, polygons array<array<array<array<double>>>>")
    index = build_cell_index(shapes)
    assert 1 < index.bands_per_degree <= 1000 and 1 <= index.columns_per_degree <= index.bands_per_degree
    assert choose_per_degree(25, 35.0, 60.0, 300.0) == (1, 1)   # coarse fixture: one band per degree
    rows, edges = index.table.agg(F.count("*"), F.sum(F.size(F.coalesce("edges", F.array())))).first()
    assert rows <= index.max_rows and edges <= index.max_edges
    rnd = random.Random(7)
    pts = [(i, rnd.uniform(137.5, 142.5), rnd.uniform(32.5, 37.5)) for i in range(1000)]
    df = spark.createDataFrame(pts, "pid int, longitude double, latitude double")
    got = {r["pid"] for r in tag_points(df, index).collect() if r["province_id"]}

    def inside(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd
    assert got == {i for i, x, y in pts if inside(x, y)}


def test_hot_band_on_shuffled_path_is_split(spark, dim):
    """Index forced off broadcast, a third of the points in one band: AQE marks the band
    join as a skew join (the hot band is split across tasks) and results stay exact."""
    from tectonic.operators.spatial import cell_index_from_wkt
    idx = cell_index_from_wkt(dim)
    pts = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(27.5))
        .otherwise(24 + (F.col("id") % 200) / 10.0).alias("latitude"),
        (120 + (F.col("id") % 300) / 10.0).alias("longitude"))
    expected = sorted(map(tuple, tag_points(pts, idx).collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = tag_points(pts, idx, broadcast_bytes=0)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in plan
    assert sorted(map(tuple, rows)) == expected


def exact_cover(rings, x, y):
    """Inside or on the boundary, in rational arithmetic on the doubles themselves."""
    from fractions import Fraction as Q
    x, y, inside = Q(x), Q(y), False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
            x1, y1, x2, y2 = Q(x1), Q(y1), Q(x2), Q(y2)
            side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (side > 0) == (y2 > y1):
                inside = not inside
    return inside


def covered(spark, shapes, pts, **options):
    from tectonic.operators.spatial import build_cell_index
    df = spark.createDataFrame([(name, [rings]) for name, rings in shapes],
                               "province_id string, polygons array<array<array<array<double>>>>")
    index = build_cell_index(df, **options)
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid int, longitude double, latitude double")
    return index, {(r["pid"], r["province_id"]) for r in tag_points(points, index).collect() if r["province_id"]}


def test_sides_are_exact(spark):
    """Points within a rounding error of oblique borders, on vertices and along edges."""
    rnd = random.Random(11)
    shapes = [("T", [[[0.0, 0.0], [0.9, 0.3], [0.0, 0.6], [0.0, 0.0]]])]
    pts = [(0.39, 0.13), (0.33, 0.11), (0.9, 0.3), (0.0, 0.3), (0.45, 0.15), (0.45, 0.45)]
    for k in range(40):
        a, b, c = ([round(rnd.uniform(0.1, 2.9), 2), round(rnd.uniform(0.1, 2.9), 2)] for _ in range(3))
        shapes.append((f"S{k}", [[a, b, c, a]]))
        for t in (0, 0.1, 1 / 3, 0.5, 0.7, 1):
            x, y = a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])
            pts += [(x, y), (x + 2e-16 * rnd.randint(-2, 2), y + 2e-16 * rnd.randint(-2, 2))]
    for bands in (None, 1, 3, 20):
        _, got = covered(spark, shapes, pts, bands_per_degree=bands)
        assert got == {(i, name) for name, rings in shapes for i, (x, y) in enumerate(pts) if exact_cover(rings, x, y)}


def test_orientation_sign(spark):
    from fractions import Fraction as Q
    from tectonic.functions.orientation import orientation_sql
    rnd = random.Random(12)
    rows = []
    for _ in range(600):
        x1, y1, x2, y2 = (rnd.choice([0.0, 0.1, 1e-30, 141.3, rnd.uniform(-180, 180)]) for _ in range(4))
        t = rnd.choice([0.0, 0.5, 1 / 3, rnd.random()])
        rows.append((x1, y1, x2, y2, x1 + t * (x2 - x1), y1 + t * (y2 - y1)))
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, x double, y double")
    for r in df.select("*", F.expr(orientation_sql("x1", "y1", "x2", "y2", "x", "y")).alias("o")).collect():
        x1, y1, x2, y2, x, y = map(Q, tuple(r)[:6])
        exact = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        assert (r["o"] > 0) - (r["o"] < 0) == (exact > 0) - (exact < 0)


def test_crowded_cells_are_cut(spark):
    """A border finely drawn along a parallel: no row holds more than a few strips' edges."""
    n = 3000
    north = [[130 + 4 * k / n, 35 + (0.0004 if k % 2 else 0.0)] for k in range(n + 1)]
    shapes = [("N", [north + [[134.0, 38.0], [130.0, 38.0], north[0]]]),
              ("box", [[[129.0, 34.0], [135.0, 34.0], [135.0, 39.0], [129.0, 39.0], [129.0, 34.0]]])]
    rnd = random.Random(13)
    pts = [(rnd.uniform(128.5, 135.5), rnd.choice([rnd.uniform(33.5, 39.5), 35 + rnd.uniform(-1e-4, 6e-4), 35.0]))
           for _ in range(300)] + [tuple(p) for p in north[::150]]
    index, got = covered(spark, shapes, pts, bands_per_degree=2)
    assert got == {(i, name) for name, rings in shapes for i, (x, y) in enumerate(pts) if exact_cover(rings, x, y)}
    assert index.heavy is not None
    rows, most, edges = index.table.agg(F.count("*"), F.max(F.size(F.coalesce("edges", F.array()))),
                                        F.sum(F.size(F.coalesce("edges", F.array())))).first()
    assert most <= 80 and rows <= index.max_rows and edges <= index.max_edges


def test_points_without_coordinates_are_spread(spark, dim):
    """A third of the points without a latitude: on the shuffled path no partition gets them all."""
    idx = cell_index_from_wkt(dim)
    pts = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, 24 + (F.col("id") % 200) / 10.0).alias("latitude"),
                                   (120 + (F.col("id") % 300) / 10.0).alias("longitude"))
    expected = sorted(map(tuple, tag_points(pts, idx).collect()), key=repr)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = tag_points(pts, idx, broadcast_bytes=0)
        assert sorted(map(tuple, out.collect()), key=repr) == expected
        nulls = out.where("latitude is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 2 * 2000 / 8
