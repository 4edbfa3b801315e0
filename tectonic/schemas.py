"""Canonical schemas of the pipeline's tables."""

from pyspark.sql import types as T

from .operators.constraints import Constraints

# The 15 sliced catalogue fields, in record order.
SLICED_COLUMNS = (
    "record_type", "event_time_raw", "station_count_raw", "latitude_raw", "lat_dev_raw",
    "longitude_raw", "lon_dev_raw", "depth_raw", "magnitude_raw_1", "magnitude_type_raw_1",
    "magnitude_raw_2", "magnitude_type_raw_2", "region_lead_raw", "region_text_raw", "shindo_raw",
)

# The typed event columns the sliced fields are renamed to, by position.
EVENT_COLUMNS = (
    "record_type", "event_time", "station_count", "latitude", "lat_dev", "longitude", "lon_dev",
    "depth", "magnitude_1", "magnitude_type_1", "magnitude_2", "magnitude_type_2",
    "region_lead", "region_text", "shindo",
)

DIM_PROVINCE = T.StructType([
    T.StructField("province_id", T.StringType()),
    T.StructField("province_name", T.StringType()),
    T.StructField("geometry", T.StringType()),
])

FACT_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("station_count", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("depth_km", T.DoubleType()),
    T.StructField("magnitude_1", T.DoubleType()),
    T.StructField("magnitude_type_1", T.StringType()),
    T.StructField("magnitude_2", T.DoubleType()),
    T.StructField("magnitude_type_2", T.StringType()),
    T.StructField("province_id", T.StringType()),
    T.StructField("raw_place", T.StringType()),
    T.StructField("shindo_value", T.StringType()),
])

# Declared constraints of the two warehouse tables.
DIM_CONSTRAINTS = Constraints(key=("province_id",), not_null=("province_name", "geometry"),
                              lengths={"province_id": 10, "province_name": 255})
FACT_CONSTRAINTS = Constraints(key=("event_id",), not_null=("event_time", "latitude", "longitude"),
                               lengths={"event_id": 64, "magnitude_type_1": 10, "magnitude_type_2": 10, "province_id": 10})

FACT_COLUMNS = tuple(f.name for f in FACT_EVENT.fields)

# GeoJSON FeatureCollection read with an explicit schema: `geometry` stays raw JSON text, so
# files mixing Polygon and MultiPolygon do not break coordinate inference.
GEOJSON = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("GID_1", T.StringType()),
            T.StructField("NAME_1", T.StringType()),
        ])),
        T.StructField("geometry", T.StringType()),
    ]))),
])

# polygon -> ring -> point -> [x, y]
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
POLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
