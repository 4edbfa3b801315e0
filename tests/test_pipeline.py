"""Fact building, gold models, upsert/refresh and data-quality checks."""

import datetime as dt

import pytest

from tectonic.operators.dedup import first_by_order
from tectonic.operators.quality import (fk_orphans, fk_set_null, length_violations,
                                        null_violations, pk_violations)
from tectonic.operators.upsert import full_refresh, upsert_by_key
from tectonic.plans import gold
from tectonic.queries import QUERIES, fact as fixture_fact
from tectonic.schemas import FACT_COLUMNS

from conftest import SF001


def test_fact_dedup_and_border(spark):
    fact = fixture_fact(spark, SF001, copies=2)
    rows = fact.collect()
    assert list(fact.columns) == list(FACT_COLUMNS)
    assert len(rows) == len({r["event_id"] for r in rows})
    once = fixture_fact(spark, SF001, copies=1)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, rows))


def test_fact_plan_single_event_shuffle(spark):
    plan = fixture_fact(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan


def test_first_by_order_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "a", 3), ("j", None, 4)],
                               "key string, p string, v int")
    got = {r["key"]: (r["p"], r["v"]) for r in first_by_order(df, ["key"], ["p"]).collect()}
    assert got == {"k": ("a", 3), "j": (None, 4)}


def _fact_rows(spark, rows):
    schema = ("event_id string, event_time timestamp_ntz, province_id string, "
              "magnitude_1 double, depth_km double, shindo_value string")
    return spark.createDataFrame(rows, schema)


def test_pivot_out_of_range_years_and_order(spark):
    d = dt.datetime
    fact = _fact_rows(spark, [("a", d(2021, 1, 1), "P1", 1.0, 1.0, "1"),
                              ("b", d(2005, 1, 1), "P2", 1.0, 1.0, "1"),
                              ("c", None, None, None, None, None)])
    dim = spark.createDataFrame([("P1", "Only2021"), ("P2", "Mid")], "province_id string, province_name string")
    rows = {r["province_name"]: r for r in gold.province_year_pivot(fact, dim).collect()}
    assert [rows["Only2021"][str(y)] for y in range(2000, 2020)] == [0] * 20
    assert rows["Mid"]["2005"] == 1
    years = [r["event_year"] for r in gold.quakes_by_year(fact).collect()]
    assert years == [2005, 2021, None]


def test_shares_sum_to_100(spark):
    fact = fixture_fact(spark, SF001)
    for model, col in [(gold.depth_distribution, "percentage"),
                       (gold.magnitude_distribution, "percentage"),
                       (gold.shindo_proportion, "shindo_percentage"),
                       (gold.quakes_by_month, "percentage")]:
        rows = model(fact).collect()
        assert abs(float(sum(r[col] for r in rows)) - 100) <= 0.01 * len(rows)


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "old1", "x"), (2, "old2", "y"), (None, "oldnull", "z")],
                                   "k int, v string, w string")
    source = spark.createDataFrame([(2, "new2"), (3, "new3")], "k int, v string")
    got = sorted(upsert_by_key(target, source, ["k"], ["k", "v"]).collect(),
                 key=lambda r: (r.k is None, r.k))
    assert [tuple(r) for r in got] == [(1, "old1", "x"), (2, "new2", None), (3, "new3", None),
                                       (None, "oldnull", "z")]
    once = upsert_by_key(target, source, ["k"], ["k", "v"])
    twice = upsert_by_key(once, source, ["k"], ["k", "v"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert [tuple(r) for r in full_refresh(target, source, ["k", "v"]).orderBy("k").collect()] == \
        [(2, "new2", None), (3, "new3", None)]
    with pytest.raises(ValueError):
        upsert_by_key(target, source.withColumn("extra", source.v), ["k"], ["k", "extra"])


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None, "P1"), ("a", "x" * 12, "P9"), ("b", "ok", None)],
                               "id string, name string, fk string")
    assert [tuple(r) for r in pk_violations(df, ["id"]).collect()] == [("a", 2)]
    nulls = {r[0]: r[1] for r in null_violations(df, ["id", "name", "fk"]).collect()}
    assert nulls == {"id": 0, "name": 1, "fk": 1}
    lengths = {r[0]: (r[1], r[2]) for r in length_violations(df, {"name": 10}).collect()}
    assert lengths == {"name": (1, 10)}
    parent = spark.createDataFrame([("P1",)], "fk string")
    assert [r["fk"] for r in fk_orphans(df, parent, "fk").collect()] == ["P9"]
    fixed = {r["name"]: r["fk"] for r in fk_set_null(df, parent, "fk").collect()}
    assert fixed == {None: "P1", "x" * 12: None, "ok": None}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_runs(spark, name):
    df = QUERIES[name](spark, SF001)
    assert df.count() >= 0
    assert len(df.columns) == len(set(df.columns))


def test_group_counts_sum_to_fact_rows(spark):
    from tectonic.queries import dim as fixture_dim
    fact = fixture_fact(spark, SF001)
    n = fact.count()
    d = fixture_dim(spark)
    assert sum(r["total_quakes"] for r in gold.quakes_by_year(fact).collect()) == n
    assert sum(r["earthquake_count"] for r in gold.quakes_by_month(fact).collect()) == n
    assert sum(r["earthquake_count"] for r in gold.quakes_by_province(fact, d).collect()) == n
    assert sum(r["depth_count"] for r in gold.depth_distribution(fact).collect()) == n
    assert sum(r["mag_count"] for r in gold.magnitude_distribution(fact).collect()) == n
    assert sum(r["shindo_count"] for r in gold.shindo_proportion(fact).collect()) == n
    pivot = gold.province_year_pivot(fact, d).collect()
    in_range = fact.filter("year(event_time) BETWEEN 2000 AND 2019").count()
    assert sum(r[str(y)] for r in pivot for y in range(2000, 2020)) == in_range


def test_models_from_one_summary_equal_direct_models(spark):
    from tectonic.plans.medallion import GOLD_MODELS
    from tectonic.queries import dim as fixture_dim
    fact = fixture_fact(spark, SF001)
    d = fixture_dim(spark)
    rolled = gold.models_from_counts(gold.summary_counts(fact), d)
    assert set(rolled) == set(GOLD_MODELS)
    for table, (model, needs_dim) in GOLD_MODELS.items():
        direct = model(fact, d) if needs_dim else model(fact)
        assert rolled[table].columns == direct.columns, table
        assert [tuple(r) for r in rolled[table].collect()] == [tuple(r) for r in direct.collect()], table


def test_upsert_source_with_hot_key(spark):
    from pyspark.sql import functions as F
    target = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v"))
    source = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 1000).cast("int").alias("k"),
        F.lit("new").alias("v"))
    out = upsert_by_key(target, source, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan          # source keys de-duplicated before the join
    rows = out.collect()
    assert len(rows) == 99 + 3000                   # key 7 replaced; every source row inserted
    assert sum(1 for r in rows if r.k == 7 and r.v == "new") == 1000
