"""Features cut out of byte ranges of large FeatureCollections."""

import json
import random

import pytest

from tectonic.sources import geojson
from tectonic.sources.geojson import read_features, split_features


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "97")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def rows(df):
    """Rows with the geometry parsed: the two readers differ in the blanks of its text."""
    return sorted(((r[0], r[1], r[2] and json.loads(r[2])) for r in df.collect()), key=repr)


def feature(gid, name, size=3, **more):
    ring = [[i / 7, -i / 3] for i in range(size)]
    return {"type": "Feature", "properties": {"GID_1": gid, "NAME_1": name, **more},
            "geometry": {"type": "Polygon", "coordinates": [ring]}}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("indent", [None, 1])
def test_awkward_strings_and_members(spark, tmp_path, small_splits, indent):
    doc = {"name": 'a}b{"features": [ {', "crs": {"type": "name", "properties": {"name": "x}"}},
           "other": [{"GID_1": "no"}, {"properties": {"GID_1": "no"}}], "bbox": [1, 2],
           "features": [None, feature("A", 'quote " and } and \\'), feature("B", "{{{[["), None,
                        feature("C", "\\\\}\"", 200), feature("C", "\\\\}\"", 200), feature(None, ""), {}, feature("É", "日本}")],
           "after": [{"properties": {"GID_1": "no"}}]}
    path = write(tmp_path / "d.json", json.dumps(doc, indent=indent, ensure_ascii=False))
    got = rows(split_features(spark, path))
    assert got == rows(read_features(spark, path)) and len(got) == 7


def test_random_documents(spark, tmp_path, small_splits):
    rng = random.Random(5)
    alphabet = ['{', '}', '"', '\\', '[', ']', ',', ':', 'a', ' ', 'features', '\n', 'é', 'null']
    for i in range(6):
        word = lambda: "".join(rng.choices(alphabet, k=rng.randrange(12)))
        some = [feature(word(), word(), rng.randrange(1, 30), extra={word(): word(), "d": {"e": {}}}) for _ in range(40)]
        doc = {word() + "1": word(), "features": some, word() + "2": {"a": word()}}
        write(tmp_path / f"{i}.json", json.dumps(doc, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5))
    split = split_features(spark, str(tmp_path))
    assert rows(split) == rows(read_features(spark, str(tmp_path))) and split.count() == 240


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = write(tmp_path / "one.json", json.dumps({"features": [feature(str(i), "n") for i in range(50)]}))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
    assert split_features(spark, path).count() == 50


def test_empty_and_several_documents(spark, tmp_path, small_splits):
    assert rows(split_features(spark, write(tmp_path / "e.json", ""))) == []
    assert rows(split_features(spark, write(tmp_path / "n.json", '{"features": []}'))) == []
    one = json.dumps({"features": [feature("A", "a")]})
    other = json.dumps({"things": [feature("X", "x")], "b": 1})
    path = write(tmp_path / "s.json", f"{one}\n{other}\n{one}\n")
    assert [r[0] for r in rows(split_features(spark, path))] == ["A", "A"]


def test_a_broken_feature_spoils_only_itself(spark, tmp_path, small_splits):
    good = json.dumps(feature("A", "a"))
    path = write(tmp_path / "b.json", f'{{"features": [{good}, {{"properties": oops}}, {good}]}}')
    got = rows(split_features(spark, path))
    assert [r[0] for r in got].count("A") == 2 and len(got) <= 3


def test_ranges_are_bounded_within_a_split(spark, tmp_path, monkeypatch):
    """Windows run over a few records each, also where one split holds the whole file."""
    monkeypatch.setattr(geojson, "_RANGE_BITS", 2)
    doc = {"name": 'a}"{', "features": [feature(f"{{{i}}}\"", "}" * (i % 3), 2 + i % 5) for i in range(60)] + [None], "after": [{}]}
    path = write(tmp_path / "d.json", json.dumps(doc))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() == 1
    pieces = geojson._pieces(spark, path)
    largest = pieces.groupBy(*geojson._RANGE).count().agg({"count": "max"}).first()[0]
    assert largest <= 4 < pieces.count() / 20
    got = rows(split_features(spark, path))
    assert got == rows(read_features(spark, path)) and len(got) == 60
