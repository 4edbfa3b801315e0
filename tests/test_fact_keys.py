"""Event keys skip nulls, so a copy without a coordinate can share the key of a located one."""

from datetime import datetime

from tectonic.plans import silver
from tectonic.queries import dim

COLUMNS = ("event_time timestamp, station_count int, latitude double, longitude double, depth double, "
           "magnitude_1 double, magnitude_type_1 string, magnitude_2 double, magnitude_type_2 string, "
           "region_text string, shindo_value string")


def test_located_copy_of_a_key_is_kept(spark):
    at = datetime(2001, 2, 3, 4, 5, 6)
    rest = (None, None, None, None, "R", None)
    rows = [(at, 1, 27.0, None, 125.0, *rest), (at, 9, 27.0, 125.0, None, *rest)]
    for order in (rows, rows[::-1]):
        fact = silver.fact_events(spark.createDataFrame(order, COLUMNS), dim(spark)).collect()
        assert [(r.longitude, r.depth_km, r.province_id) for r in fact] == [(125.0, None, "JPN.1_1")]
