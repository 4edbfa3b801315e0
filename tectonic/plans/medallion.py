"""End-to-end run: raw catalogue files + boundary file -> silver tables -> gold tables.

    from tectonic.plans.medallion import run_pipeline
    report = run_pipeline(spark, "s3://bucket/raw/", "s3://bucket/geo/provinces.json",
                          "s3://bucket/warehouse")

Every layer is written once (Parquet under ``layer/schema/table``) and the next layer reads
what was written, so a lost executor late in the run never recomputes the whole chain and
each gold model scans the stored fact instead of re-deriving it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from ..schemas import SLICED_COLUMNS
from ..sinks import paths
from ..sinks.files import write_dataset
from ..sinks.tables import materialize_bucketed
from ..sources.geojson import split_features
from ..sources.text import read_raw_lines
from . import bronze, gold, silver
from .ledger import FEATURE_REASONS, LINE_REASONS, feature_reasons, line_reasons, observed_reasons

# The gold models and the per-model function computing each directly from the fact (the
# end-to-end run derives them all from one summary instead; results are the same).
GOLD_MODELS = {
    "gold_total_quakes_by_year": (gold.quakes_by_year, False),
    "gold_earthquake_by_month": (gold.quakes_by_month, False),
    "gold_earthquake_depth_distribution": (gold.depth_distribution, False),
    "gold_earthquake_magnitude_distribution": (gold.magnitude_distribution, False),
    "gold_quake_shindo_proportion": (gold.shindo_proportion, False),
    "gold_earthquake_by_province": (gold.quakes_by_province, True),
    "gold_earthquake_by_province_year": (gold.province_year_pivot, True),
}


def run_pipeline(spark: SparkSession, raw_dir: str, geojson_path: str, root: str,
                 write_bronze: bool = False, fact_table: str | None = None,
                 fact_buckets: int = 64) -> dict:
    """Run every layer; returns the load report (paths, record counts, ingest metrics).

    With ``fact_table`` the fact is stored as a catalog table bucketed by ``event_id``
    (``fact_buckets`` buckets) instead of a Parquet path, which is the layout the streaming
    ingest appends to.
    """
    report: dict = {}
    raw = read_raw_lines(spark, raw_dir)
    # metrics and rejects ride along with the first write that scans the lines (no extra pass)
    lines, line_obs = observed_reasons(line_reasons(raw, keep=("filename",)), "raw_lines", F.col("reason"), LINE_REASONS,
                                       num_files=F.size(F.collect_set(F.xxhash64("filename"))))
    records = bronze.nonblank_lines(lines).select(*SLICED_COLUMNS)
    if write_bronze:
        report["bronze_raw_sliced"] = write_dataset(records, root, "bronze", "quake",
                                                    "bronze_raw_sliced")

    events = silver.typed_events(records)
    report["silver_quake_event"] = write_dataset(events, root, "silver", "quake",
                                                 "silver_quake_event")
    seen = line_obs.get
    # files that hold a line, counted by the scan itself (8 bytes a file reach the driver)
    report["ingest"] = {"num_files": seen["num_files"], "num_lines": seen["records"],
                        "blank_lines": seen["rejected_blank"],
                        "records": seen["records"] - seen["rejected_blank"],
                        "short_lines": seen["rejected_short"],
                        "typed_records": report["silver_quake_event"]["records"]}
    report["rejected_lines"] = {r: seen[f"rejected_{r.replace(' ', '_')}"] for r in LINE_REASONS}
    features = feature_reasons(split_features(spark, geojson_path))
    features, feature_obs = observed_reasons(features, "features", F.col("reason"), FEATURE_REASONS)
    dim = silver.dim_province(features.drop("reason"))
    report["silver_dim_japan_province"] = write_dataset(dim, root, "silver", "quake",
                                                        "silver_dim_japan_province")

    seen = feature_obs.get
    report["rejected_features"] = {r: seen[f"rejected_{r.replace(' ', '_')}"] for r in FEATURE_REASONS}
    stored_events = spark.read.parquet(report["silver_quake_event"]["path"])
    stored_dim = spark.read.parquet(report["silver_dim_japan_province"]["path"])
    fact = silver.fact_events(stored_events, stored_dim)
    if fact_table:
        report["silver_fact_earthquake_event"] = materialize_bucketed(
            fact, fact_table, "event_id", fact_buckets)
        stored_fact = spark.table(fact_table)
    else:
        report["silver_fact_earthquake_event"] = write_dataset(
            fact, root, "silver", "fact", "silver_fact_earthquake_event")
        stored_fact = spark.read.parquet(report["silver_fact_earthquake_event"]["path"])
    # one scan of the fact feeds all seven models: a small count summary is written first and
    # every model is a roll-up of the stored summary
    report["gold_summary_counts"] = write_dataset(gold.summary_counts(stored_fact), root, "gold",
                                                  "quake", "gold_summary_counts")
    counts = spark.read.parquet(report["gold_summary_counts"]["path"])
    for table, df in gold.models_from_counts(counts, stored_dim).items():
        report[table] = write_dataset(df, root, "gold", "quake", table, max_files=1,
                                      sort_by=gold.model_order(table))
    return report


def gold_path(root: str, table: str) -> str:
    return paths.join(root, paths.dataset_key("gold", "quake", table, "parquet"))


def main(argv: list[str] | None = None) -> None:
    import argparse
    import json

    from ..session import build_session

    parser = argparse.ArgumentParser(description="Run every pipeline layer.")
    parser.add_argument("raw_dir")
    parser.add_argument("geojson")
    parser.add_argument("root")
    parser.add_argument("--write-bronze", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session()
    report = run_pipeline(spark, args.raw_dir, args.geojson, args.root, args.write_bronze)
    print(json.dumps(report, default=str))


if __name__ == "__main__":
    main()
