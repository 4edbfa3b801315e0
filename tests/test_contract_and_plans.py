"""Driver contract and physical-plan properties of every registered query."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tectonic.operators.dedup import first_by_order
from tectonic.queries import QUERIES

from conftest import SF001


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["province_name", "earthquake_count"]


def test_every_query_has_oracle_sql():
    from tectonic import oracle
    from tectonic.queries import QUERIES
    assert set(QUERIES) == set(oracle.all_sql())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.queries()) >= 25


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["quakes_by_year"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_hot_key_is_combined_map_side(spark):
    """A key holding a third of all rows: dedup is a partial aggregate before the shuffle,
    and the result keeps exactly one row per key."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 7).alias("v"), F.col("id").alias("w")).repartition(8)
    out = first_by_order(df, ["k"], ["v", "w"])
    plan = _plan(out)
    assert "partial_min" in plan
    rows = {r["k"]: (r["v"], r["w"]) for r in out.collect()}
    assert len(rows) == 1 + n - n // 3
    assert rows["hot"] == (0, 0)



def test_checkpoint_dir_uses_the_session_folder(spark, tmp_dir):
    from tectonic.session import checkpoint_dir, scratch_path
    spark.sparkContext.setCheckpointDir(tmp_dir)
    folder = checkpoint_dir(spark)
    assert folder.startswith("file:" + tmp_dir) or folder.startswith(tmp_dir)
    assert scratch_path(spark, "x").startswith(folder)
