import json

import pytest
from pyspark.sql import functions as F

from gridpulse.sources.geojson import pieces, read_features, read_lookup

SQUARE = {"type": "Polygon", "coordinates": [[[9.0, 45.3], [9.002, 45.3], [9.002, 45.302], [9.0, 45.3]]]}


def feature(k, **more):
    return {"type": "Feature", "id": k, "properties": {"cellId": k + 1, **more}, "geometry": SQUARE}


DOCUMENTS = {
    "plain": {"type": "FeatureCollection", "features": [feature(k) for k in range(40)]},
    "type last": {"features": [feature(k) for k in range(5)], "type": "FeatureCollection"},
    "crs": {"crs": {"type": "name", "properties": {"name": "urn:x"}}, "type": "FeatureCollection", "bbox": [1, 2],
            "features": [feature(k, nested={"a": [{"b": 1}, {}]}) for k in range(5)], "other": [{"type": "x"}], "more": {"y": [{"z": {}}]}},
    "odd strings": {"type": "FeatureCollection", "name": 'a } { ] [ "quoted\\" }', "features": [
        feature(k, text='}{[]"\\}\\"{ "type":"Feature" }', other="a\nb}") for k in range(9)]},
    "keys in another order": {"type": "FeatureCollection", "features": [
        {"geometry": {"coordinates": [[[1.5, 2]]], "type": "Polygon"}, "properties": {"x": {"y": {}}, "cellId": str(k)}, "type": "Feature"} for k in range(4)]},
    "nulls": {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": None, "geometry": SQUARE}, {"type": "Feature", "properties": {"cellId": 3}, "geometry": None}]},
    "none": {"type": "FeatureCollection", "features": []},
    "other type": {"type": "Thing", "features": [feature(1)]},
}


def expected(document):
    out = []
    for f in document["features"]:
        cell = (f["properties"] or {}).get("cellId")
        geometry = None if f["geometry"] is None else json.dumps(f["geometry"], separators=(",", ":"))
        out.append((document["type"], None if cell is None else str(cell), geometry))
    return sorted(out, key=str)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("split_bytes", ["128m", "700"])
def test_features_of_documents_in_splits(spark, tmp_path, split_bytes, indent):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        for name, document in DOCUMENTS.items():
            (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=False))
        read = lambda path: sorted(((r.document_type, r.cell_id, r.geometry) for r in read_features(spark, str(path)).collect()), key=str)
        assert read(tmp_path) == sorted((f for d in DOCUMENTS.values() for f in expected(d)), key=str)
        if split_bytes == "700":
            assert pieces(spark, str(tmp_path / "plain.json")).select("split").distinct().count() > 5
            assert read(tmp_path / "crs.json") == expected(DOCUMENTS["crs"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lookup_takes_usable_cells(spark, tmp_path):
    (tmp_path / "cells.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature(0), feature(1) | {"properties": {"cellId": "x"}}, feature(2) | {"geometry": None}]}))
    found = read_lookup(spark, str(tmp_path))
    assert [(r.grid_id, json.loads(r.geometry)) for r in found.collect()] == [(1, SQUARE)]
    assert found.where(F.col("geometry").isNull()).count() == 0
