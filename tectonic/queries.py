"""The registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Inputs are the driver tables; the catalogue lines are derived from ``events`` (one line
per row, see ``sources.fixtures``), so every query's work grows with the data.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.datetimes import coerce_datetimes
from .operators.quality import (fk_orphans, fk_set_null, length_violations, null_violations,
                                pk_violations)
from .operators.constraints import BROKEN, with_broken_rules
from .operators.dedup import first_by_order
from .operators.ordering import with_rank
from .operators.upsert import full_refresh, upsert_by_key
from .functions.geometry import geometry_head, head_polygons, polygons_to_wkt, wkt_polygons, wkt_type
from .operators.spatial import build_cell_index, polygon_edges, tag_points
from .plans import bronze, gold, ledger, silver
from .schemas import DIM_CONSTRAINTS, DIM_PROVINCE, FACT_CONSTRAINTS
from .session import scratch_path
from .sinks import buckets, files, tables
from .sources.datasets import read_dataset
from .sources.fixtures import (BLANK_SQL, blanked_lines, cell_collections, dealt, event_cell_documents, faulty_cell_documents,
                               province_geojson, rough_lines, seed_lines, side_points, triangles)
from .sources.geojson import features_from_text, split_features
from .sources.tables import table
from .sources.text import read_raw_lines


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_lines(spark, events(spark, sf_dir))


def sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.sliced_records(lines(spark, sf_dir), keep=("line_id",))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed_events(sliced(spark, sf_dir))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.keyed_events(typed(spark, sf_dir))


def dim(spark: SparkSession) -> DataFrame:
    """The fixture provinces as one GeoJSON document (a literal, so repeated uses in one
    query are the same plan and share their exchanges)."""
    docs = spark.range(1).select(F.lit(province_geojson()).alias("value"))
    return silver.dim_province(features_from_text(docs))


def fact(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    parts = [sliced(spark, sf_dir) for _ in range(copies)]
    typed_rows = silver.typed_events(bronze.union_batches(*parts))
    return silver.fact_events(typed_rows, dim(spark))


def q_raw_lines_nonblank(spark, sf_dir):
    return bronze.nonblank_lines(blanked_lines(spark, events(spark, sf_dir)))


def q_fixed_width_slice(spark, sf_dir):
    return sliced(spark, sf_dir)


def q_typed_events(spark, sf_dir):
    return typed(spark, sf_dir)


def q_shindo_class(spark, sf_dir):
    return typed(spark, sf_dir).select("line_id", "shindo", "shindo_value")


def q_event_key(spark, sf_dir):
    return keyed(spark, sf_dir).select("line_id", "event_id")


def q_union_batches(spark, sf_dir):
    return bronze.union_batches(sliced(spark, sf_dir), sliced(spark, sf_dir))


def q_sample_rows(spark, sf_dir):
    return keyed(spark, sf_dir).orderBy("event_id", "line_id").limit(5)


def q_province_tag(spark, sf_dir):
    tagged = silver.tag_provinces(keyed(spark, sf_dir), dim(spark))
    return tagged.select("line_id", "event_id", "province_id")


def q_fact_events(spark, sf_dir):
    # two copies of every line: the fact must come out one row per event key
    return fact(spark, sf_dir, copies=2)


def _gold(model, spark, sf_dir):
    return model(fact(spark, sf_dir))


def _gold_dim(model, spark, sf_dir):
    return model(fact(spark, sf_dir), dim(spark))


QUERIES = {
    "raw_lines_nonblank": q_raw_lines_nonblank,
    "fixed_width_slice": q_fixed_width_slice,
    "typed_events": q_typed_events,
    "shindo_class": q_shindo_class,
    "event_key": q_event_key,
    "union_batches": q_union_batches,
    "sample_rows": q_sample_rows,
    "province_tag": q_province_tag,
    "fact_events": q_fact_events,
    "quakes_by_year": partial(_gold, gold.quakes_by_year),
    "quakes_by_month": partial(_gold, gold.quakes_by_month),
    "depth_distribution": partial(_gold, gold.depth_distribution),
    "magnitude_distribution": partial(_gold, gold.magnitude_distribution),
    "shindo_proportion": partial(_gold, gold.shindo_proportion),
    "quakes_by_province": partial(_gold_dim, gold.quakes_by_province),
    "province_year_pivot": partial(_gold_dim, gold.province_year_pivot),
}


# --- sinks, coercion, metrics and data quality over the driver tables -------------------

UPSERT_KEYS = ("c_custkey",)
UPSERT_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def balance_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged source for the customer upsert: overdrawn customers with orders, charged their
    largest order (declared columns only, so ``c_mktsegment`` is not carried)."""
    customer = table(spark, sf_dir, "customer")
    largest = table(spark, sf_dir, "orders").groupBy("o_custkey") \
        .agg(F.max("o_totalprice").alias("largest_order"))
    return (customer.join(largest, customer["c_custkey"] == largest["o_custkey"])
            .filter(F.col("c_acctbal") < 0)
            .select("c_custkey", "c_name", "c_nationkey",
                    (F.col("c_acctbal") - F.col("largest_order")).alias("c_acctbal")))


def q_upsert_by_key(spark, sf_dir):
    return upsert_by_key(table(spark, sf_dir, "customer"), balance_updates(spark, sf_dir),
                         UPSERT_KEYS, UPSERT_COLUMNS)


def q_full_refresh(spark, sf_dir):
    return full_refresh(table(spark, sf_dir, "customer"), balance_updates(spark, sf_dir),
                        UPSERT_COLUMNS)


# Orders of the lowest priority carry their date in another layout, which the one stated
# format rejects (-> null).
DATE_TEXT_SQL = ("case when o_orderpriority = '5-LOW' then date_format(o_orderdate, 'dd/MM/yyyy') "
                 "else cast(o_orderdate as string) end")


def q_coerce_datetime(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(DATE_TEXT_SQL).alias("o_orderdate_text"))
    return coerce_datetimes(orders.withColumn("o_orderdate", F.col("o_orderdate_text")),
                            ["o_orderdate"])


def q_load_metrics(spark, sf_dir):
    """Lines read, blank lines dropped, short lines (all-null records), typed records —
    one aggregation pass over the raw lines."""
    raw = blanked_lines(spark, events(spark, sf_dir))
    return bronze.ingest_metrics(raw, file_col=None)


def raw_fact_rows(spark, sf_dir):
    """Fact rows before deduplication, over two copies of every line."""
    both = bronze.union_batches(sliced(spark, sf_dir), sliced(spark, sf_dir))
    return silver.fact_projection(silver.keyed_events(silver.typed_events(both)))


# Declared constraints of the warehouse tables.
FACT_NOT_NULL = ("event_id", "event_time", "latitude", "longitude")
FACT_LENGTHS = {"event_id": 64, "magnitude_type_1": 10, "province_id": 10}


def reloaded_dim(spark):
    """The dimension after a reload that lost one province (its facts become orphans)."""
    return dim(spark).filter(F.col("province_name") != "Delta")


def q_pk_violations(spark, sf_dir):
    return pk_violations(raw_fact_rows(spark, sf_dir), ["event_id"])


def q_null_violations(spark, sf_dir):
    return null_violations(fact(spark, sf_dir), FACT_NOT_NULL)


def q_length_violations(spark, sf_dir):
    return length_violations(fact(spark, sf_dir), FACT_LENGTHS)


def q_fk_orphans(spark, sf_dir):
    return fk_orphans(fact(spark, sf_dir), reloaded_dim(spark), "province_id") \
        .select("event_id", "province_id")


def q_fk_set_null(spark, sf_dir):
    return fk_set_null(fact(spark, sf_dir), reloaded_dim(spark), "province_id")


QUERIES.update({
    "upsert_by_key": q_upsert_by_key,
    "full_refresh": q_full_refresh,
    "coerce_datetime": q_coerce_datetime,
    "load_metrics": q_load_metrics,
    "pk_violations": q_pk_violations,
    "null_violations": q_null_violations,
    "length_violations": q_length_violations,
    "fk_orphans": q_fk_orphans,
    "fk_set_null": q_fk_set_null,
})


# --- geometry operators over per-event cells (GeoJSON -> features -> WKT -> edges) ------

def cell_features(spark, sf_dir):
    docs = event_cell_documents(typed(spark, sf_dir))
    return features_from_text(docs.select("value"))


def q_geo_features(spark, sf_dir):
    """Features parsed from GeoJSON text: id, name and geometry type."""
    feats = cell_features(spark, sf_dir)
    return feats.select("province_id", "province_name",
                        F.get_json_object("geometry_json", "$.type").alias("geometry_type"))


def q_geo_wkt(spark, sf_dir):
    """Each feature's geometry as WKT."""
    return silver.province_shapes(cell_features(spark, sf_dir))


def q_geo_wkt_roundtrip(spark, sf_dir):
    """WKT -> polygon arrays -> WKT again (must reproduce the text)."""
    shapes = silver.province_shapes(cell_features(spark, sf_dir))
    parsed = shapes.select("province_id", "geometry",
                           wkt_polygons("geometry").alias("_p"), wkt_type("geometry").alias("_t"))
    return parsed.select("province_id", "geometry",
                         polygons_to_wkt("_p", "_t").alias("geometry_again"))


def q_geo_edges(spark, sf_dir):
    """Edges of every ring of every cell."""
    heads = cell_features(spark, sf_dir).select("province_id", geometry_head("geometry_json").alias("_g"))
    return polygon_edges(heads.select("province_id", head_polygons("_g").alias("polygons")))


def q_dim_province(spark, sf_dir):
    """Dimension build: one row per id, smallest (name, geometry) kept."""
    return silver.dim_province(cell_features(spark, sf_dir))


QUERIES.update({
    "geo_features": q_geo_features,
    "geo_wkt": q_geo_wkt,
    "geo_wkt_roundtrip": q_geo_wkt_roundtrip,
    "geo_edges": q_geo_edges,
    "dim_province": q_dim_province,
})


def q_border_points(spark, sf_dir):
    """Points within a rounding error of oblique borders, tagged with every triangle they touch."""
    ids = events(spark, sf_dir).select("event_id")
    index = build_cell_index(triangles(ids), "shape_id", bands_per_degree=64)
    return tag_points(side_points(ids), index, "x", "y").select("event_id", "shape_id")


QUERIES["border_points"] = q_border_points


# --- faults: hard lines, broken rules, rejects -------------------------------------------

def q_rough_events(spark, sf_dir):
    """Typed events of lines with planted faults."""
    return silver.typed_events(bronze.sliced_records(rough_lines(spark, events(spark, sf_dir)), keep=("line_id",)))


def rough_fact_rows(spark, sf_dir):
    """Fact rows of the hard lines, before deduplication."""
    return silver.fact_projection(silver.keyed_events(q_rough_events(spark, sf_dir)))


def faulty_dim_rows(spark, sf_dir):
    docs = faulty_cell_documents(typed(spark, sf_dir))
    return silver.province_shapes(features_from_text(docs.select("value")))


def q_fact_null_violations(spark, sf_dir):
    """NOT NULL columns of the fact over the hard lines (times and coordinates that cannot be read)."""
    return null_violations(rough_fact_rows(spark, sf_dir), FACT_CONSTRAINTS.required)


def q_dim_rule_violations(spark, sf_dir):
    """The dimension's NOT NULL and VARCHAR(n) rules over faulty features."""
    rows = faulty_dim_rows(spark, sf_dir)
    nulls = null_violations(rows, DIM_CONSTRAINTS.required).withColumn("max_length", F.lit(None).cast("int"))
    return nulls.unionByName(length_violations(rows, DIM_CONSTRAINTS.lengths))


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_dim_quarantine(spark, sf_dir):
    """The dimension, one row per id, loaded into its table by its declared rules: the table's rows
    and those that were sorted out, with the rules they break."""
    database = f"checked_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_fresh(spark, database)}'")
    tables.create_tables(spark, database)
    rows = first_by_order(faulty_dim_rows(spark, sf_dir), ["province_id"], ["province_name", "geometry"])
    tables.load_checked(rows, f"{database}.dim_province", DIM_CONSTRAINTS, f"{database}.quarantine")
    kept = spark.table(f"{database}.dim_province").select("*", F.lit("").alias(BROKEN))
    out = spark.table(f"{database}.quarantine")
    return out.select(*DIM_PROVINCE.fieldNames(), F.array_join(BROKEN, ", ").alias(BROKEN)).unionByName(kept)


def q_fact_broken_rules(spark, sf_dir):
    """Every fact row of the hard lines that breaks a declared rule, with the rules."""
    rows = rough_fact_rows(spark, sf_dir).withColumn("province_id", F.lit(None).cast("string"))
    return with_broken_rules(rows, FACT_CONSTRAINTS).where(F.size(BROKEN) > 0).select(
        "event_id", "event_time", "latitude", "longitude", F.array_join(BROKEN, ", ").alias(BROKEN))


def q_reject_ledger(spark, sf_dir):
    """Rejected lines, features and WKT texts by reason."""
    raw = rough_lines(spark, events(spark, sf_dir)).select("line_id", F.expr(BLANK_SQL).alias("raw_line"))
    lines_ledger = ledger.ledger(ledger.line_reasons(raw), "lines", "reason")
    docs = faulty_cell_documents(typed(spark, sf_dir))
    features = ledger.feature_reasons(features_from_text(docs.select("value")))
    shapes = silver.province_shapes(cell_features(spark, sf_dir)).select(F.expr(
        "case when endswith(province_id, '7') then replace(geometry, '((', '((north ') else geometry end").alias("wkt"))
    return lines_ledger.unionByName(ledger.ledger(features, "features", "reason")) \
        .unionByName(ledger.ledger(shapes, "geometries", ledger.wkt_reason("wkt")))


# --- ordered models, pivots, written data ------------------------------------------------

RANKED_MODELS = ("gold_total_quakes_by_year", "gold_earthquake_by_month", "gold_earthquake_depth_distribution",
                 "gold_earthquake_by_province", "gold_quake_shindo_proportion")


def q_gold_ranks(spark, sf_dir):
    """The place of every row of five ordered models, by their label."""
    path = _fresh(spark, "counts")
    gold.summary_counts(fact(spark, sf_dir)).write.parquet(path)
    models = gold.models_from_counts(spark.read.parquet(path), dim(spark))
    out = None
    for name in RANKED_MODELS:
        ranked = with_rank(models[name], gold.model_order(name)).select(
            F.lit(name).alias("model"), "row_rank", F.col(models[name].columns[0]).cast("string").alias("label"))
        out = ranked if out is None else out.unionByName(ranked)
    return out


def q_event_ranks(spark, sf_dir):
    """The place of every typed event by magnitude (largest first, nulls last), then line."""
    rows = typed(spark, sf_dir).select("line_id", "magnitude_1")
    return with_rank(rows, [F.desc_nulls_last("magnitude_1"), F.asc("line_id")])


# The intensity classes pivoted into columns.
PIVOT_CLASSES = ("0", "1", "2", "3", "4", "5-", "5+", "6-", "6+", "7")
PIVOTS = (("n", "sum", 1, 0), ("stations", "sum", "station_count", 0), ("most", "max", "station_count", None),
          ("counted", "count", "station_count", None))


def q_region_class_pivots(spark, sf_dir):
    """Events and their station counts (sum, greatest, number of known ones) by intensity class for
    every region: four pivots, each with its own aggregate and value."""
    rows = typed(spark, sf_dir).select("region_text", "shindo_value", "station_count")
    out = None
    for prefix, agg, then, other in PIVOTS:
        wide = gold.pivot(rows, "region_text", "shindo_value", PIVOT_CLASSES, agg, then, other)
        named = wide.select("region_text", *[F.col(f"`{c}`").cast("long").alias(f"{prefix}_{c}") for c in PIVOT_CLASSES])
        out = named if out is None else out.join(named, "region_text")
    return out


def q_upsert_buckets(spark, sf_dir):
    """The customer table written in buckets, then upserted bucket by bucket and read back."""
    path = _fresh(spark, "customer")
    buckets.write_buckets(table(spark, sf_dir, "customer"), path, UPSERT_KEYS, 16)
    buckets.upsert_buckets(spark, path, balance_updates(spark, sf_dir), UPSERT_KEYS, UPSERT_COLUMNS)
    return buckets.read_buckets(spark, path)


def q_stored_lines(spark, sf_dir):
    """Catalogue lines written as text files and read back by the directory scan."""
    path = _fresh(spark, "lines")
    blanked_lines(spark, events(spark, sf_dir)).select("raw_line").write.text(path)
    return read_raw_lines(spark, path).select("raw_line")


def q_stored_objects(spark, sf_dir):
    """The same rows stored as Parquet, JSON lines and binary objects, each read back by its key."""
    root = _fresh(spark, "objects")
    rows = lines(spark, sf_dir)
    files.write_dataset(rows, root, "bronze", "quake", "bronze_lines", file_bytes=1 << 20)
    files.write_json_records(rows, f"{root}/bronze/quake/records.jsonl")
    files.write_binary(rows, f"{root}/bronze/quake/objects.blobs", "line_id", "raw_line")
    stored = {name: read_dataset(spark, root, "bronze", "quake", name) for name in ("bronze_lines", "records", "objects")}
    stored["objects"] = stored["objects"].select(F.col("path").cast("long").alias("line_id"),
                                                 F.col("content").cast("string").alias("raw_line"))
    parts = [df.select(F.lit(name).alias("stored_as"), "line_id", "raw_line") for name, df in stored.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_split_boundaries(spark, sf_dir):
    """Shapes of large FeatureCollections stored as files, each cut and parsed by many tasks."""
    path = _fresh(spark, "boundaries")
    cell_collections(typed(spark, sf_dir)).write.text(path)
    return silver.province_shapes(split_features(spark, path))


QUERIES.update({
    "split_boundaries": q_split_boundaries,
    "rough_events": q_rough_events,
    "fact_null_violations": q_fact_null_violations,
    "dim_rule_violations": q_dim_rule_violations,
    "dim_quarantine": q_dim_quarantine,
    "fact_broken_rules": q_fact_broken_rules,
    "reject_ledger": q_reject_ledger,
    "gold_ranks": q_gold_ranks,
    "event_ranks": q_event_ranks,
    "region_class_pivots": q_region_class_pivots,
    "upsert_buckets": q_upsert_buckets,
    "stored_lines": q_stored_lines,
    "stored_objects": q_stored_objects,
})
