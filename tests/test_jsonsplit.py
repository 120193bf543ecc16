"""One large document read by many tasks, against Python's own parser."""

import json
import random

import pytest

from zonecast.sources import geojson, jsonfeed
from zonecast.sources.jsonsplit import array_elements

ODD = ['plain', 'a]b', '],[', '"', '\\', '\\"]', ']}', '[[1,2],{"data":[[3]]}]', 'é[漢', '\n]\t', '', '{"features":[{', '\\\\']


def cell(pick):
    return pick.choice([None, 1, -2.5, True, pick.choice(ODD), pick.choice(ODD), [1, [2, pick.choice(ODD)]], {"k": [pick.choice(ODD)], "o": {}}, []])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(seed, n):
    pick = random.Random(seed)
    return [[cell(pick) for _ in range(pick.randint(1, 9))] for _ in range(n)]


def found(df):
    return sorted((json.dumps(json.loads(r.element)) for r in df.collect()))


@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_are_split_and_whole(spark, tmp_path, small_splits, indent):
    docs = [records(s, n) for s, n in ((1, 400), (2, 1), (3, 60))]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=i == 0))
    df = array_elements(spark, str(tmp_path))
    assert found(df) == sorted(json.dumps(r) for d in docs for r in d)
    assert spark.read.text(str(tmp_path / "0.json"), lineSep="]").rdd.getNumPartitions() > 5


@pytest.mark.parametrize("indent", [None, 2])
def test_envelopes_with_decoys(spark, tmp_path, small_splits, indent):
    rows = records(4, 300)
    decoy = {"data": [[9, 9]], "note": '"data":[[7]]', "list": [[1], [2]]}
    docs = [{"meta": decoy, "rows": [[0]], "data": rows, "after": [[5], {"data": [[6]]}]}, {"data": [], "x": [[1]]}, {"meta": 1},
            {"data": [None, 3, [1], "s"]}, {"a": "\\", "data": [["x]"]]}]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=indent))
    assert found(array_elements(spark, str(tmp_path), key="data")) == sorted(json.dumps(r) for r in [*rows, [1], ["x]"]])
    assert jsonfeed.read_json_envelope(spark, str(tmp_path)).count() == 302


def test_an_element_longer_than_its_splits(spark, tmp_path, small_splits):
    rows = [["s" * 9000, "]" * 5000], [1], [[["deep"] * 900]]]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    assert found(array_elements(spark, str(tmp_path))) == sorted(map(json.dumps, rows))


@pytest.mark.parametrize("indent", [None, 1])
def test_feature_collections(spark, tmp_path, small_splits, indent):
    pick = random.Random(5)
    ring = lambda: [[pick.uniform(-75, -73), pick.uniform(40, 41)] for _ in range(30)]
    feats = [{"type": "Feature", "properties": {"GEOCODE": str(i), "GEONAME": pick.choice(ODD), "BOROUGH": "{}", "more": {"x": [{}]}},
              "geometry": {"type": "MultiPolygon", "coordinates": [[ring()], [ring(), ring()]]}} for i in range(60)]
    doc = {"type": "FeatureCollection", "crs": {"properties": {"features": [{"type": "no"}]}}, "features": feats, "tail": [{"type": "Feature"}]}
    (tmp_path / "z.json").write_text(json.dumps(doc, indent=indent))
    got = {r.GEOCODE: r for r in geojson.read_geojson(spark, str(tmp_path), collection=True).collect()}
    assert len(got) == 60
    for f in feats:
        r = got[f["properties"]["GEOCODE"]]
        assert r.GEONAME == f["properties"]["GEONAME"] and r.COORDINATES == f["geometry"]["coordinates"]


def test_no_document_and_broken_ones(spark, tmp_path):
    for i, text in enumerate(("", "   ", "[", "[[1,2],[3", "null", "{}", "[]", "[[]]")):
        (tmp_path / f"{i}.json").write_text(text)
    assert found(array_elements(spark, str(tmp_path))) == ["[1, 2]", "[3]", "[]"]


def test_the_documents_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": records(6, 50)}))
    df = array_elements(spark, str(tmp_path / "a.json"), key="data")
    assert df.inputFiles() and not any("a.json" in f for f in df.inputFiles())
    assert found(df) == sorted(map(json.dumps, records(6, 50)))
