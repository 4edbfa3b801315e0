"""Sources, sinks and streaming ingest (all local; JDBC uses embedded in-memory Derby)."""

import os

import pytest
from pyspark.sql import functions as F

from tectonic.plans import bronze
from tectonic.sinks import files, paths, tables
from tectonic.sinks import jdbc as jdbc_sink
from tectonic.sources import datasets, text
from tectonic.sources.jdbc import read_table
from tectonic.sources.fixtures import province_geojson
from tectonic.streaming.ingest import start_fact_ingest
from tectonic.queries import dim as fixture_dim, lines as fixture_lines

from conftest import SF001


def test_text_directory_scan(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.txt"), "w", newline="") as f:
        f.write("one  \r\ntwo\rthree\n\n   \n")
    with open(os.path.join(tmp_dir, "b.txt"), "w") as f:
        f.write("four\n")
    os.mkdir(os.path.join(tmp_dir, "sub"))
    with open(os.path.join(tmp_dir, "sub", "nested.txt"), "w") as f:
        f.write("nested line\n")                      # not read: the scan is not recursive
    df = text.read_raw_lines(spark, tmp_dir)
    got = sorted((r.filename, r.raw_line) for r in bronze.nonblank_lines(df).collect())
    assert got == [("a.txt", "one  "), ("a.txt", "three"), ("a.txt", "two"), ("b.txt", "four")]
    m = bronze.ingest_metrics(df).first().asDict()
    assert m == {"num_files": 2, "num_lines": 6, "blank_lines": 2, "records": 4,
                 "short_lines": 4, "typed_records": 0}


def test_whole_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "geo.json")
    with open(path, "w") as f:
        f.write(province_geojson())
    rows = text.read_whole_text(spark, path).collect()
    assert len(rows) == 1 and rows[0].value == province_geojson()


def test_parquet_sink_and_dataset_resolution(spark, tmp_dir):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    m = files.write_dataset(df, tmp_dir, "bronze", "quake", "bronze_raw_text")
    assert m["records"] == 10 and m["path"].endswith("bronze/quake/raw_text.parquet")
    assert datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "bronze_raw_text").count() == 10
    files.write_text_document(spark, province_geojson(), paths.join(tmp_dir, "bronze/quake/raw_geo.json"))
    geo = datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "bronze_raw_geo")
    assert geo.select(F.size("features")).first()[0] == 6
    with pytest.raises(FileNotFoundError):
        datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "missing")
    os.makedirs(os.path.join(tmp_dir, "bronze/quake/odd.xyz"))
    with pytest.raises(TypeError):
        datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "odd")


def test_binary_and_json_sinks(spark, tmp_dir):
    blobs = spark.createDataFrame([("k1", bytearray(b"\x00\x01")), ("k2", bytearray(b"zz"))],
                                  "path string, content binary")
    m = files.write_binary(blobs, os.path.join(tmp_dir, "blobs.blobs"))
    assert m["records"] == 2 and m["type"] == "binary"
    with open(os.path.join(tmp_dir, "raw.dat"), "wb") as f:
        f.write(b"\x05\x06")
    assert datasets.read_binary(spark, os.path.join(tmp_dir, "raw.dat")).first().content == b"\x05\x06"
    doc = {"name": "Ōsaka", "ids": [1, 2]}
    files.write_json_document(spark, doc, os.path.join(tmp_dir, "doc.json"))
    back = spark.read.option("multiLine", True).json(os.path.join(tmp_dir, "doc.json")).first()
    assert back["name"] == "Ōsaka" and list(back["ids"]) == [1, 2]
    m = files.write_json_records(spark.range(3), os.path.join(tmp_dir, "recs.jsonl"))
    assert m["records"] == 3 and spark.read.json(os.path.join(tmp_dir, "recs.jsonl")).count() == 3


def test_upsert_path_swaps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    src1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.upsert_path(spark, path, src1, ["k"])
    src2 = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    m = tables.upsert_path(spark, path, src2, ["k"])
    assert m["records"] == 3
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert [n for n in os.listdir(tmp_dir) if "_staging_" in n] == []


def test_catalog_tables(spark):
    tables.create_tables(spark, "silver_t")
    cols = spark.table("silver_t.fact_earthquake_event").columns
    assert cols[0] == "event_id" and len(cols) == 13
    dim = fixture_dim(spark)
    tables.refresh_table(spark, "silver_t.dim_province", dim)
    assert spark.table("silver_t.dim_province").count() == 5
    upd = spark.createDataFrame([("JPN.9_1", "Nu", "POLYGON ((0 0, 1 0, 0 1, 0 0))")],
                                "province_id string, province_name string, geometry string")
    tables.upsert_table(spark, "silver_t.dim_province", upd, ["province_id"])
    assert spark.table("silver_t.dim_province").count() == 6
    tables.as_view(spark.table("silver_t.dim_province"), "v_dim")
    assert spark.sql("select count(*) from v_dim").first()[0] == 6
    m = tables.materialize(spark.table("v_dim").groupBy().count(), "silver_t.gold_n")
    assert m["records"] == 1 and spark.table("silver_t.gold_n").first()[0] == 6


def test_jdbc_round_trip_upsert_refresh(spark):
    url = "jdbc:derby:memory:tectonic;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    target = spark.createDataFrame([(1, "old1"), (2, "old2")], "k int, v string")
    jdbc_sink.write_table(target, url, "DIMT", props)
    source = spark.createDataFrame([(2, "new2"), (3, "new3")], "k int, v string")
    m = jdbc_sink.upsert(spark, url, "DIMT", source, ["k"], None, props)
    assert m["records"] == 3
    got = sorted(map(tuple, read_table(spark, url, "DIMT", props).collect()))
    assert got == [(1, "old1"), (2, "new2"), (3, "new3")]
    jdbc_sink.refresh(spark, url, "DIMT", source, None, props)
    got = sorted(map(tuple, read_table(spark, url, "DIMT", props, "K", 0, 10, 2).collect()))
    assert got == [(2, "new2"), (3, "new3")]


def test_streaming_ingest_appends_only_new_keys(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").collect()]
    with open(os.path.join(landing, "part1.txt"), "w") as f:
        f.write("\n".join(lines[:300]) + "\n\n")
    dim = fixture_dim(spark)
    fact_path = os.path.join(tmp_dir, "fact")
    ckpt = os.path.join(tmp_dir, "ckpt")
    start_fact_ingest(spark, landing, dim, fact_path, ckpt).awaitTermination(120)
    n1 = spark.read.parquet(fact_path).count()
    with open(os.path.join(landing, "part2.txt"), "w") as f:
        f.write("\n".join(lines[200:500]) + "\n")   # overlaps the first file
    start_fact_ingest(spark, landing, dim, fact_path, ckpt).awaitTermination(120)
    fact = spark.read.parquet(fact_path)
    ids = [r.event_id for r in fact.select("event_id").collect()]
    assert len(ids) == len(set(ids)) and len(ids) > n1
    from tectonic.plans import silver
    from tectonic.operators.slicing import slice_fixed_width
    batch = spark.createDataFrame([(x,) for x in lines[:500]], "raw_line string")
    expected = silver.fact_events(silver.typed_events(slice_fixed_width(
        bronze.nonblank_lines(batch))), dim)
    assert sorted(ids) == sorted(r.event_id for r in expected.select("event_id").collect())


def test_medallion_run_matches_queries(spark, tmp_dir):
    """Files on disk -> all layers written; gold tables equal the registered queries."""
    from tectonic.plans.medallion import GOLD_MODELS, gold_path, run_pipeline
    from tectonic.queries import QUERIES
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").collect()]
    half = len(lines) // 2
    for name, chunk in (("2019.txt", lines[:half]), ("2020.txt", lines[half:]),
                        ("dup.txt", lines[:50])):
        with open(os.path.join(raw, name), "w") as f:
            f.write("\n".join(chunk) + "\n\n")
    geo = os.path.join(tmp_dir, "geo.json")
    with open(geo, "w") as f:
        f.write(province_geojson())
    report = run_pipeline(spark, raw, geo, os.path.join(tmp_dir, "wh"))
    assert report["ingest"]["num_files"] == 3
    from tectonic.sources.text import read_raw_lines
    assert report["ingest"] == bronze.ingest_metrics(read_raw_lines(spark, raw)).first().asDict()
    assert report["silver_dim_japan_province"]["records"] == 5
    names = {"gold_total_quakes_by_year": "quakes_by_year",
             "gold_earthquake_by_month": "quakes_by_month",
             "gold_earthquake_depth_distribution": "depth_distribution",
             "gold_earthquake_magnitude_distribution": "magnitude_distribution",
             "gold_quake_shindo_proportion": "shindo_proportion",
             "gold_earthquake_by_province": "quakes_by_province",
             "gold_earthquake_by_province_year": "province_year_pivot"}
    assert set(names) == set(GOLD_MODELS)
    for table, query in names.items():
        stored = spark.read.parquet(gold_path(os.path.join(tmp_dir, "wh"), table))
        expected = QUERIES[query](spark, SF001)
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, expected.collect())), table


def test_streaming_into_bucketed_fact_table(spark, tmp_dir):
    """Initial load into a fact table bucketed by event_id, then streamed files: only
    unseen keys are appended, and the key lookup shuffles the batch side only."""
    from tectonic.plans.medallion import run_pipeline
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").collect()]
    raw, landing = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "landing")
    os.makedirs(raw)
    os.makedirs(landing)
    with open(os.path.join(raw, "first.txt"), "w") as f:
        f.write("\n".join(lines[:300]) + "\n")
    with open(os.path.join(landing, "more.txt"), "w") as f:
        f.write("\n".join(lines[200:500]) + "\n")
    geo = os.path.join(tmp_dir, "geo.json")
    with open(geo, "w") as f:
        f.write(province_geojson())
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_t")
    run_pipeline(spark, raw, geo, os.path.join(tmp_dir, "wh"), fact_table="stream_t.fact",
                 fact_buckets=4)
    n0 = spark.table("stream_t.fact").count()
    start_fact_ingest(spark, landing, fixture_dim(spark), fact_table="stream_t.fact",
                      checkpoint=os.path.join(tmp_dir, "ckpt")).awaitTermination(120)
    spark.catalog.refreshTable("stream_t.fact")
    ids = [r.event_id for r in spark.table("stream_t.fact").select("event_id").collect()]
    assert len(ids) == len(set(ids)) > n0
    from tectonic.plans import silver
    from tectonic.operators.slicing import slice_fixed_width
    batch = spark.createDataFrame([(x,) for x in lines[:500]], "raw_line string")
    expected = silver.fact_events(silver.typed_events(slice_fixed_width(batch)), fixture_dim(spark))
    assert sorted(ids) == sorted(r.event_id for r in expected.select("event_id").collect())

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = spark.createDataFrame([("x",)], "event_id string")
        plan = small.join(spark.table("stream_t.fact").select("event_id"), "event_id",
                          "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_write_and_bronze_output(spark, tmp_dir):
    df = spark.range(20).select((F.col("id") % 3).alias("part"), F.col("id"))
    m = files.write_parquet(df, os.path.join(tmp_dir, "p"), partition_by=("part",))
    assert m["records"] == 20
    assert sorted(n for n in os.listdir(os.path.join(tmp_dir, "p")) if n.startswith("part=")) == \
        ["part=0", "part=1", "part=2"]
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).where("part = 2").count() == 6

    from tectonic.plans.medallion import run_pipeline
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").limit(50).collect()]
    with open(os.path.join(raw, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    geo = os.path.join(tmp_dir, "geo.json")
    with open(geo, "w") as f:
        f.write(province_geojson())
    report = run_pipeline(spark, raw, geo, os.path.join(tmp_dir, "wh"), write_bronze=True)
    assert report["bronze_raw_sliced"]["records"] == 50
    assert report["ingest"]["num_lines"] == 50


def test_streaming_default_checkpoint(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").limit(40).collect()]
    with open(os.path.join(landing, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.sparkContext.setCheckpointDir(os.path.join(tmp_dir, "shared"))
    q = start_fact_ingest(spark, landing, fixture_dim(spark), os.path.join(tmp_dir, "fact"))
    q.awaitTermination(120)
    assert q.exception() is None
    assert spark.read.parquet(os.path.join(tmp_dir, "fact")).count() > 0
    assert os.path.isdir(os.path.join(tmp_dir, "shared"))


def test_gzip_catalogue_is_redistributed(spark, tmp_dir):
    import gzip
    lines = [r.raw_line for r in fixture_lines(spark, SF001).orderBy("line_id").collect()]
    with gzip.open(os.path.join(tmp_dir, "big.txt.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")
    df = text.read_raw_lines(spark, tmp_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan
    assert sorted(r.raw_line for r in df.collect()) == sorted(lines)
    assert text.read_raw_lines(spark, tmp_dir, spread_unsplittable=False).rdd.getNumPartitions() == 1


def test_every_sink_reads_back_by_key(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bronze/quake")
    files.write_json_records(spark.range(1000), os.path.join(root, "records.jsonl"))
    assert datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "records").count() == 1000
    blobs = spark.createDataFrame([("k1", bytearray(b"\x00\x01")), ("k2", bytearray(b"zz"))],
                                  "path string, content binary")
    files.write_binary(blobs, os.path.join(root, "objects.blobs"))
    back = datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "objects").collect()
    assert sorted((r.path, bytes(r.content)) for r in back) == [("k1", b"\x00\x01"), ("k2", b"zz")]
    files.write_dataset(spark.range(7), tmp_dir, "bronze", "quake", "table")
    assert datasets.read_dataset(spark, tmp_dir, "bronze", "quake", "table").count() == 7
    with pytest.raises(ValueError):
        files.write_json_records(spark.range(3), os.path.join(root, "records.json"))
    with pytest.raises(ValueError):
        files.write_binary(blobs, os.path.join(root, "objects.bin"))


def test_failed_upsert_leaves_the_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keepdb")
    spark.sql("DROP TABLE IF EXISTS keepdb.t")
    spark.sql("CREATE TABLE keepdb.t (k INT, v VARCHAR(3)) USING parquet")
    spark.sql("INSERT INTO keepdb.t VALUES (1, 'a'), (2, 'b'), (3, 'c')")
    for change in (lambda src: tables.upsert_table(spark, "keepdb.t", src, ["k"]),
                   lambda src: tables.refresh_table(spark, "keepdb.t", src)):
        with pytest.raises(Exception):
            change(spark.createDataFrame([(2, "too long")], "k int, v string"))
        assert sorted(map(tuple, spark.table("keepdb.t").collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert [r.tableName for r in spark.sql("SHOW TABLES IN keepdb").collect() if not r.isTemporary] == ["t"]
    tables.upsert_table(spark, "keepdb.t", spark.createDataFrame([(2, "B"), (4, "d")], "k int, v string"), ["k"])
    assert sorted(map(tuple, spark.table("keepdb.t").collect())) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_raw_lines_beside_partition_style_folder(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "year=2019"))
    for name in ("a.txt", "b c.txt", "year=2019/d.txt"):
        with open(os.path.join(tmp_dir, name), "w") as out:
            out.write(name + "\n")
    got = text.read_raw_lines(spark, tmp_dir)
    assert sorted(r.raw_line for r in got.collect()) == ["a.txt", "b c.txt"]
