"""Declared constraints, the reject ledger, partial upserts, file sizes, ranks, pivots, even JDBC ranges."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tectonic.operators.constraints import BROKEN, Constraints, ddl, with_broken_rules
from tectonic.operators.ordering import with_rank
from tectonic.plans import gold, ledger
from tectonic.schemas import DIM_CONSTRAINTS, DIM_PROVINCE, FACT_CONSTRAINTS, FACT_EVENT
from tectonic.queries import QUERIES
from tectonic.sinks import buckets, files, jdbc, tables
from tectonic.sources.jdbc import even_ranges, read_table


def names(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_upsert_rewrites_only_its_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    target = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit("x").alias("w")) \
        .unionByName(spark.createDataFrame([(None, "null key", "x")], "k long, v string, w string"))
    buckets.write_buckets(target, path, ["k"], 32)
    before = names(path)
    source = spark.createDataFrame([(i * 7, f"new{i}") for i in range(10)] + [(9000, "more"), (9000, "more"), (None, "n")],
                                   "k long, v string")
    done = buckets.upsert_buckets(spark, path, source, ["k"])
    after = names(path)
    moved = {f.split("/")[0] for f in before - after}
    touched = {f"key_bucket_of_32={r[0]}" for r in source.select(buckets.bucket_of(["k"], 32)).distinct().collect()}
    assert moved <= touched and {f.split("/")[0] for f in after - before} == touched and len(touched) == done["buckets"] < 32
    got = sorted(map(tuple, buckets.read_buckets(spark, path).collect()), key=repr)
    new = {i * 7 for i in range(10)}
    expected = [(i, f"v{i}", "x") for i in range(5000) if i not in new] + [(i * 7, f"new{i}", None) for i in range(10)]
    expected += [(9000, "more", None)] * 2 + [(None, "null key", "x"), (None, "n", None)]
    assert got == sorted(expected, key=repr)
    again = buckets.upsert_buckets(spark, path, source.where("k is not null"), ["k"])
    assert again["records"] <= done["records"] and buckets.read_buckets(spark, path).count() == len(expected)
    assert buckets.upsert_buckets(spark, path, source.limit(0), ["k"])["buckets"] == 0


def test_upsert_reads_only_its_buckets(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    buckets.write_buckets(spark.range(100).withColumnRenamed("id", "k"), path, ["k"], 8)
    plans = []
    monkeypatch.setattr(buckets, "_write", lambda df, *rest: plans.append(df._jdf.queryExecution().executedPlan().toString()) or 0)
    buckets.upsert_buckets(spark, path, spark.range(1).withColumnRenamed("id", "k"), ["k"])
    assert "PartitionFilters: [isnotnull(key_bucket_of_8" in plans[0]


def test_ddl_carries_the_constraints(spark):
    assert ddl(DIM_PROVINCE, DIM_CONSTRAINTS) == \
        "`province_id` VARCHAR(10) NOT NULL, `province_name` VARCHAR(255) NOT NULL, `geometry` string NOT NULL"
    assert "`event_time` timestamp_ntz NOT NULL" in ddl(FACT_EVENT, FACT_CONSTRAINTS)


@pytest.fixture
def database(spark, request):
    name = f"checked_{abs(hash(request.node.name))}"
    tables.create_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_broken_rows_go_to_quarantine(spark, database):
    table, out = f"{database}.dim_province", f"{database}.dim_quarantine"
    rows = [("A", "Alpha", "POINT"), ("B", None, "x"), (None, "n", None), ("TOO-LONG-ID", "L", "x"), ("C", "n" * 256, "x")]
    df = spark.createDataFrame(rows, DIM_PROVINCE.simpleString()[7:-1].replace(":", " "))
    done = tables.load_checked(df, table, DIM_CONSTRAINTS, out)
    assert (done["records"], done["quarantined"]) == (1, 4)
    assert [tuple(r) for r in spark.table(table).collect()] == [rows[0]]
    assert {r["province_id"]: r["broken_rules"] for r in spark.table(out).collect()} == {
        "B": ["province_name NOT NULL"], None: ["province_id NOT NULL", "geometry NOT NULL"],
        "TOO-LONG-ID": ["province_id VARCHAR(10)"], "C": ["province_name VARCHAR(255)"]}
    with pytest.raises(ValueError, match="more than once"):  # the key is in the table already
        tables.load_checked(df.where("province_id = 'A'"), table, DIM_CONSTRAINTS, out)
    assert spark.table(table).count() == 1 and spark.table(out).count() == 4
    tables.load_checked(df.where("province_id = 'A'"), table, DIM_CONSTRAINTS, out, overwrite=True)
    assert spark.table(table).count() == 1
    with pytest.raises(Exception):  # Spark itself refuses a longer VARCHAR
        spark.sql(f"INSERT INTO {table} VALUES ('TOO-LONG-ID', 'n', 'g')")


def test_ledger_reasons(spark):
    good = "J2011031114461812 099 380620 012 1425160 034 240     90V   " + " " * 60
    rows = [(1, "  \t"), (2, "short"), (3, " " * 30 + "x" * 66), (4, good[:22] + "3x0620" + good[28:]),
            (5, good[:1] + "20111311144618" + good[15:]), (6, good), (7, None)]
    got = {r["line_id"]: r["reason"] for r in ledger.line_reasons(
        spark.createDataFrame(rows, "line_id int, raw_line string"), keep=("line_id",)).collect()}
    assert got == {1: "blank", 2: "short", 3: "coordinate shape", 4: "coordinate value", 5: "event time", 6: None, 7: "blank"}
    shapes = [("p", '{"type":"Polygon","coordinates":[[[1,2],[3,4],[1,2]]]}'), ("q", '{"type":"Point","coordinates":[1,2]}'),
              ("r", '{"type":"Polygon","coordinates":[["x",[3,4]]]}'), ("s", None), ("t", '{"type":"MultiPolygon","coordinates":[[[[1]]]]}')]
    got = {r["id"]: r["reason"] for r in ledger.feature_reasons(
        spark.createDataFrame(shapes, "id string, geometry_json string")).collect()}
    assert got == {"p": None, "q": "geometry type", "r": "coordinates", "s": "geometry type", "t": "coordinates"}


def test_wkt_forms(spark):
    from tectonic.functions.geometry import wkt_polygons
    ring = [[0.5, -0.25], [5.0, 1.0], [3.0, 100.0], [0.5, -0.25]]
    forms = {"POLYGON Z ((.5 -.25 1, 5. +1 2, 3 1e2 3, .5 -.25 1))": [[ring]], "polygon zm((.5 -.25 1 9,5 1 2 9,3 100 3 9,.5 -.25 1 9))": [[ring]],
             "POLYGON EMPTY": [], "MULTIPOLYGON EMPTY": [], "POINT (1 2)": None, "POLYGON ((north 1, 2 3))": None, None: None,
             "MULTIPOLYGON M (((.5 -.25 0, 5 1 0, 3 100 0, .5 -.25 0)))": [[ring]]}
    df = spark.createDataFrame([(w,) for w in forms], "w string")
    assert {r["w"]: r["p"] for r in df.select("w", wkt_polygons("w").alias("p")).collect()} == forms


def test_ranks_without_a_single_task(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 2, 2, 2, 3])) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(7)
    got = with_rank(df, [F.asc_nulls_last("v"), F.desc("id")])
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, -r[0]))
    assert [(r["id"], r["v"]) for r in got.orderBy("row_rank").collect()] == order
    assert sorted(r["row_rank"] for r in got.collect()) == list(range(1, 4001))
    assert with_rank(df.limit(0), ["id"]).count() == 0


def test_pivot_aggregates(spark):
    df = spark.createDataFrame([("a", "x", 5), ("a", "x", -7), ("a", "y", 3), ("b", None, 1), (None, "y", 4)], "k string, c string, v int")
    def by(agg, *rest):
        return {r["k"]: (r["x"], r["y"]) for r in gold.pivot(df, "k", "c", ["x", "y"], agg, *rest).collect()}
    assert by("sum") == {"a": (2, 1), "b": (0, 0), None: (0, 1)}
    assert by("sum", "v") == {"a": (-2, 3), "b": (0, 0), None: (0, 4)}
    assert by("max", "v", None) == {"a": (5, 3), "b": (None, None), None: (None, 4)}
    assert by("min", "v") == {"a": (-7, 0), "b": (0, 0), None: (0, 4)}
    assert by("count", "v", None) == {"a": (2, 1), "b": (0, 0), None: (0, 1)}


def test_files_follow_bytes_and_the_stage_above_keeps_its_tasks(spark, tmp_dir):
    df = spark.range(0, 400_000, 1, 12).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    seen = df.select(F.spark_partition_id().alias("task"), "h")
    size = 4 << 20
    files.write_parquet(seen, f"{tmp_dir}/sized", file_bytes=size)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/sized/*.parquet")]
    assert len(sizes) > 3 and max(sizes) <= 2 * size and sorted(sizes)[1] >= size / 4
    assert spark.read.parquet(f"{tmp_dir}/sized").select("task").distinct().count() == 12
    files.write_parquet(seen, f"{tmp_dir}/one", max_files=1, sort_by=("h",))
    assert len(glob.glob(f"{tmp_dir}/one/*.parquet")) == 1
    assert spark.read.parquet(f"{tmp_dir}/one").select("task").distinct().count() == 12
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) != str(size)
    files.write_parquet(seen, f"{tmp_dir}/bounded", max_files=1, max_records=100_000)
    assert len(glob.glob(f"{tmp_dir}/bounded/*.parquet")) == 4


URL = "jdbc:derby:memory:ranges;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_skewed_keys_are_read_evenly(spark):
    keys = [None] * 40 + [1] * 30 + list(range(500)) + [10**9 + i * i for i in range(200)] + [-5]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int")
    jdbc.write_table(df, URL, "SKEWED", PROPS)
    read = read_table(spark, URL, "SKEWED", PROPS, "k", num_partitions=6)
    parts = read.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sorted(map(tuple, read.collect()), key=repr) == sorted([(k, i) for i, k in enumerate(keys)], key=repr)
    assert 7 <= len(parts) <= 14 and max(r["count"] for r in parts) <= 2 * len(keys) / 6
    with pytest.raises(ValueError):
        read_table(spark, URL, "SKEWED", PROPS, "k")
    jdbc.write_table(df.limit(0), URL, "NOTHING", PROPS)
    assert read_table(spark, URL, "NOTHING", PROPS, "K", num_partitions=3).count() == 0


def test_even_ranges_cover_everything():
    values = sorted([2**62 - i for i in range(50)] + [-(2**62)] + [7] * 100)
    def count(ranges):
        return [sum(a <= v <= b for v in values) for a, b in ranges]
    ranges = even_ranges(values[0], values[-1], len(values), 5, count)
    assert ranges[0][0] == values[0] and ranges[-1][1] == values[-1]
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(count(ranges)) == 100 and len(ranges) <= 10


def test_a_task_that_commits_twice_stages_its_rows_once(spark, monkeypatch):
    jdbc.write_table(spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), URL, "RETRIED", PROPS)
    write = jdbc.write_table

    def twice(df, url, table, *rest, **options):
        done = write(df, url, table, *rest, **options)
        write(df.where(f"{jdbc.TASK} = 0"), url, table, *rest, **options)  # task 0 runs again after its commit
        return done
    monkeypatch.setattr(jdbc, "write_table", twice)
    source = spark.createDataFrame([(2, "new"), (3, "new"), (3, "new"), (4, "new")], "k int, v string").repartition(2)
    done = jdbc.upsert(spark, URL, "RETRIED", source, ["k"], properties=PROPS)
    assert sorted(map(tuple, read_table(spark, URL, "RETRIED", PROPS).collect())) == \
        [(1, "old"), (2, "new"), (3, "new"), (3, "new"), (4, "new")]
    assert done["staged"] == 4


# --- checks that do not repeat the work they check -----------------------------------------

def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_broken_rules_does_not_repeat_the_checked_columns(spark):
    rows = spark.range(20).select(F.when(F.col("id") % 4 > 0, F.sha2(F.col("id").cast("string"), 256)).alias("key"),
                                  F.when(F.col("id") % 5 > 0, F.lit("n")).alias("name"))
    rules = Constraints(key=["key"], not_null=["name"], lengths={"key": 64, "name": 3})
    broken = with_broken_rules(rows, rules).where(F.size(BROKEN) > 0)
    assert _optimized(broken).count("sha2(") == 1
    assert sorted(map(tuple, (r[BROKEN] for r in broken.collect()))) == \
        [("key NOT NULL",)] * 4 + [("key NOT NULL", "name NOT NULL")] + [("name NOT NULL",)] * 3
    query = _optimized(QUERIES["fact_broken_rules"](spark, SF001))
    assert query.count("gettimestamp(") == 1 and query.count("x1 ") == 1  # a time and a planted fault


def test_the_ledger_works_a_reason_out_once(spark):
    rows = spark.range(30).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")
    why = F.when(F.length(F.sha2("h", 224)) < 0, "never").when(F.col("id") % 3 == 0, "third")
    got = ledger.ledger(rows, "rows", why)
    assert [tuple(r) for r in got.collect()] == [("rows", "third", 10)]
    assert _optimized(got).count("224)") == 1
    plan = _optimized(QUERIES["reject_ledger"](spark, SF001))
    assert plan.count("gettimestamp(") == 1  # lines are the only part that reads times
