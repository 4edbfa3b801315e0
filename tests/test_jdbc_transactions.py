"""Keyed upsert and refresh inside the database (embedded Derby, in memory)."""

import pytest

from tectonic.sinks import jdbc
from tectonic.sources.jdbc import read_table

URL = "jdbc:derby:memory:transactions;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def rows(spark, table):
    return sorted(map(tuple, read_table(spark, URL, table, PROPS).collect()))


def tables(spark):
    names = read_table(spark, URL, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t", PROPS)
    return {r[0] for r in names.collect()}


@pytest.fixture()
def target(spark, request):
    name = "T_" + request.node.name.upper()[:40]
    read_table(spark, URL, "SYS.SYSTABLES", PROPS).schema  # loads the driver
    jdbc.in_transaction(spark, URL, PROPS, [
        f'CREATE TABLE {name} ("k" INT NOT NULL PRIMARY KEY, "v" VARCHAR(5), "kept" VARCHAR(5))',
        f"INSERT INTO {name} VALUES (1, 'one', 'a'), (2, 'two', 'b')"])
    return name


def test_upsert_touches_only_staged_keys(spark, target):
    source = spark.createDataFrame([(2, "new"), (3, "three")], "k int, v string")
    done = jdbc.upsert(spark, URL, target, source, ["k"], ["k", "v"], PROPS)
    assert rows(spark, target) == [(1, "one", "a"), (2, "new", None), (3, "three", None)]
    assert (done["staged"], done["deleted"], done["records"]) == (2, 1, 3)
    assert not [t for t in tables(spark) if "_STAGE_" in t]


def test_failed_insert_rolls_the_delete_back(spark, target):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception):
        jdbc.upsert(spark, URL, target, twice, ["k"], None, PROPS)
    with pytest.raises(Exception):
        jdbc.refresh(spark, URL, target, twice, None, PROPS)
    assert rows(spark, target) == [(1, "one", "a"), (2, "two", "b")]
    assert not [t for t in tables(spark) if "_STAGE_" in t]


def test_values_the_target_cannot_hold_fail_in_the_stage(spark, target):
    long = spark.createDataFrame([(2, "too long a value")], "k int, v string")
    with pytest.raises(Exception):
        jdbc.upsert(spark, URL, target, long, ["k"], None, PROPS)
    assert rows(spark, target) == [(1, "one", "a"), (2, "two", "b")]


def test_refresh_and_empty_sources(spark, target):
    empty = spark.createDataFrame([], "k int, v string")
    jdbc.upsert(spark, URL, target, empty, ["k"], None, PROPS)
    assert len(rows(spark, target)) == 2
    jdbc.refresh(spark, URL, target, spark.createDataFrame([(7, "q")], "k int, v string"), None, PROPS)
    assert rows(spark, target) == [(7, "q", None)]
    assert jdbc.refresh(spark, URL, target, empty, None, PROPS)["records"] == 0
    with pytest.raises(ValueError):
        jdbc.upsert(spark, URL, target, empty.withColumnRenamed("v", "other"), ["k"], None, PROPS)
