"""Layer files, with a few features of every kind."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from cairnfield.operators import checks
from cairnfield.sources import layers


@pytest.fixture(scope="module")
def layer(spark):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    shapes = [("Point", [1.5, 2.5]), ("MultiPoint", [[1, 2], [3, 4]]), ("LineString", [[0, 0], [1, 1]]), ("MultiLineString", [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]), ("Polygon", [square, square]), ("MultiPolygon", [[square], [square]])]
    features = [{"type": "Feature", "properties": {"Name": f"n{i}" if i else None, "OBJECTID": 1}, "geometry": {"type": k, "coordinates": c}} for i, (k, c) in enumerate(shapes)]
    folder = tempfile.mkdtemp(prefix="spark-layer-", dir="/tmp")
    with open(f"{folder}/a.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "name": "a", "features": features}, f, indent=1)
    with open(f"{folder}/b.jsonl", "w") as f:
        f.write("\n".join(map(json.dumps, features)))
    return folder


def test_scan_and_vertices(spark, layer):
    for df in (layers.read_layer(spark, f"{layer}/a.geojson", "a"), layers.read_feature_lines(spark, f"{layer}/b.jsonl", "a")):
        assert df.count() == 6
        v = layers.vertices(df, ["pos"]).groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part", "ring").alias("r")).orderBy("pos").collect()
        assert [(r["n"], r["r"]) for r in v] == [(1, 1), (2, 2), (2, 1), (4, 2), (8, 2), (8, 2)]


def test_declared_and_volatile(spark, layer):
    df = layers.read_layer(spark, f"{layer}/a.geojson", "a")
    kept = df.withColumn("props", layers.without_volatile(F.col("props")))
    assert {k for r in kept.collect() for k in r["props"]} == {"Name"}
    assert [r["Name"] for r in layers.declared(kept, ["Name"]).orderBy("pos").collect()][:2] == [None, "n1"]
    with pytest.raises(ValueError):
        layers.declared(kept, ["Name", "Lost"])


def test_canonical_file_is_stable(spark, layer):
    df = spark.createDataFrame([(3, "c"), (1, None), (2, "b")], "id long, name string")
    texts = []
    for k, d in enumerate((df, df.orderBy(F.desc("id")).repartition(3))):
        layers.write_canonical(d, f"{layer}/out{k}", ["id"])
        texts.append([r["value"] for r in spark.read.text(f"{layer}/out{k}").collect()])
    assert sorted(texts[0]) == sorted(texts[1]) and '{"id":1,"name":null}' in texts[0]


def test_layer_folders_and_lookup(spark, layer):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id long, layer string")
    layers.write_layers(df, f"{layer}/split", "layer", ["id"])
    assert spark.read.parquet(f"{layer}/split").where("layer = 'x'").count() == 2
    with open(f"{layer}/l.json", "w") as f:
        json.dump({"u": {"name": "A"}, "v": {"name": None}}, f)
    assert sorted((r["key"], r["value"]["name"]) for r in layers.lookup(spark, f"{layer}/l.json", "struct<name:string>").collect()) == [("u", "A"), ("v", None)]


def test_shape_of(spark):
    ask = lambda *k: spark.range(1).select(layers.shape_of(F.array(*[F.lit(x) for x in k]) if k else F.array().cast("array<string>"))).first()[0]
    assert (ask("Point", "Polygon"), ask("Point"), ask()) == (1, 0, None)


def test_vertices_of_collections(spark, tmp_path):
    import json

    inner = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [5, 6]}, {"type": "LineString", "coordinates": [[7, 8], [9, 10]]}]}
    shape = {"type": "GeometryCollection", "geometries": [{"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, inner]}
    features = [{"type": "Feature", "properties": {"Name": "a"}, "geometry": shape}, {"type": "Feature", "properties": {"Name": "b"}, "geometry": {"type": "Point", "coordinates": [0, 0]}}]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "name": "c", "features": features}))
    v = layers.vertices(layers.read_layer(spark, str(tmp_path / "c.geojson"), "c"), ["pos"]).orderBy("pos", "part", "seq").collect()
    assert [tuple(r) for r in v] == [(0, 0, 0, 0, 1.0, 2.0), (0, 1, 0, 0, 3.0, 4.0), (0, 2, 0, 0, 5.0, 6.0), (0, 3, 0, 0, 7.0, 8.0), (0, 3, 0, 1, 9.0, 10.0), (1, 0, 0, 0, 0.0, 0.0)]


def test_swapped_positions(spark):
    rows = spark.createDataFrame([(1, [-93.0, 44.5, 300.0]), (2, [1.0, 2.0]), (3, None)], "id int, at array<double>")
    got = {r["id"]: r["swapped"] for r in rows.select("id", layers.swapped(F.col("at")).alias("swapped")).collect()}
    assert got[1] == [44.5, -93.0] and got[2] == [2.0, 1.0]  # a height isn't kept


def test_geometry_that_a_change_shows(spark):
    rows = spark.createDataFrame([(1, "moved", "after", "before"), (2, None, "after", "before"), (3, None, None, "before"), (4, None, None, None)], "id int, moved string, after string, before string")
    shown = layers.moved_geometry(F.col("moved"), F.col("after"), F.col("before"))
    assert [r["shown"] for r in rows.orderBy("id").select(shown.alias("shown")).collect()] == ["moved", "after", "before", None]


def test_titles_of_the_first_source(spark):
    rows = spark.createDataFrame([("a", "Second", 2), ("a", "First", 1), ("b", "Only", 7), (None, "Of none", 3)], "slug string, title string, pos int")
    assert {r["slug"]: r["title"] for r in layers.titles(rows).collect()} == {"a": "First", "b": "Only", None: "Of none"}
    assert layers.titles(rows.where("pos > 9")).count() == 0


def test_categories_are_compared_as_sets(spark):
    wanted = {"hall": ["building", "art"], "lot": ["parking"]}
    rows = [("order", "hall", ["art", "building"]), ("repeat", "hall", ["building", "art", "art"]), ("less", "hall", ["art"]), ("more", "lot", ["parking", "art"]), ("none", "lot", None), ("empty", "lot", []), ("unknown kind", "tree", ["art"]), ("bare", "tree", None)]
    found = checks.equal_categories(spark.createDataFrame(rows, "id string, kind string, categories array<string>"), wanted)
    assert sorted(r["key"] for r in found.collect()) == ["empty", "less", "more", "none", "unknown kind"]
