"""Anchors of all kinds, their checks, and shapes in canonical form."""

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from cairnfield.functions.shapes import SHAPE, canonical_json, nested, rounded_shape, shape_hash
from cairnfield.operators import measures, places
from cairnfield.sources import layers

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)]
SMALL = [(10.0, 10.0), (11.0, 10.0), (11.0, 11.0), (10.0, 11.0), (10.0, 10.0)]
FLAT = [(20.0, 5.0), (22.0, 5.0), (20.0, 5.0)]
VERTEX = "id long, kind string, part int, ring int, seq int, x double, y double"


def vertices(spark, shapes):
    """shapes: (id, kind, parts of rings)."""
    return spark.createDataFrame([(i, k, p, r, s, x, y) for i, k, parts in shapes for p, rings in enumerate(parts) for r, ring in enumerate(rings) for s, (x, y) in enumerate(ring)], VERTEX)


def anchors(spark, shapes):
    return {r["id"]: (r["x"], r["y"]) for r in measures.anchors(vertices(spark, shapes)).collect()}


def test_anchor_of_each_kind(spark):
    line = [(0.0, 0.0), (1.0, 0.0), (2.0, 5.0), (3.0, 0.0)]
    got = anchors(spark, [(1, "point", [[[(7.0, 8.0)]], [[(9.0, 9.0)]]]), (2, "line", [[line]]), (3, "line", [[line[:2]], [[(9.0, 9.0), (8.0, 8.0), (7.0, 7.0)]]]), (4, "area", [[SMALL], [SQUARE]]), (5, "area", [[SMALL]]), (6, "area", [[FLAT]]), (7, "line", [[[(1.0, 1.0)]]])])
    # a line's vertex n // 2, over all its parts; an area's largest part; one without an area its mean
    assert got[1] == (7.0, 8.0) and got[2] == (2.0, 5.0) and got[3] == (9.0, 9.0) and got[4] == (2.0, 2.0) and got[5] == (10.5, 10.5) and got[6] == (21.0, 5.0) and got[7] == (1.0, 1.0)


def test_anchor_beside_a_hole_and_of_equal_parts(spark):
    twin = [(x + 100, y) for x, y in SQUARE]
    got = anchors(spark, [(1, "area", [[SQUARE, HOLE]]), (2, "area", [[SQUARE], [twin]])])
    assert got[1][1] == 2.0 and got[1][0] in (0.5, 3.5) and got[2] == (2.0, 2.0)


def test_anchor_faults(spark):
    line = [(0.0, 45.0), (0.001, 45.0)]
    shapes = [(1, "area", [[SQUARE, HOLE], [SMALL]]), (2, "line", [[line]]), (3, "line", [[line], [line]]), (4, "point", [[[(0.0, 0.0)]]]), (5, "area", [[SQUARE]]), (5, "line", [[line]]), (6, "line", [[[(1.0, 1.0)]]])]
    found = spark.createDataFrame([(1, 10.5, 10.5), (2, 0.00100000001, 45.0), (3, 0.0005, 45.0), (4, 5.0, 5.0), (5, 9.0, 9.0), (6, 1.0, 1.0)], "id long, x double, y double")
    metres = round(6371008.8 * 2 * math.asin(math.cos(math.radians(45)) * math.sin(math.radians(0.0005))))
    stated = spark.createDataFrame([(1, None), (2, metres), (3, metres), (4, 3), (5, metres), (6, None)], "id long, length int")
    got = {tuple(r) for r in measures.anchor_faults(found, vertices(spark, shapes), stated).collect()}
    # 3 has two parts, so twice the length; the ends of a line are its vertices, its middle isn't; 5 is judged by its area
    assert got == {("not on its line", "3"), ("outside its area", "5"), ("not its line's length", "3"), ("not its line's length", "4")}
    inside_hole = spark.createDataFrame([(1, 2.0, 2.0)], found.schema)
    assert {tuple(r) for r in measures.anchor_faults(inside_hole, vertices(spark, shapes), stated.limit(0)).collect()} == {("outside its area", "1")}


def test_canonical_shapes(spark):
    draw = random.Random(1)
    rings = {(p, r): [(draw.uniform(-180, 180), draw.uniform(-90, 90)) for _ in range(draw.randrange(1, 6))] for p in range(3) for r in range(2)}
    rows = [("a", p, r, s, x, y) for (p, r), ring in rings.items() for s, (x, y) in enumerate(ring)]
    draw.shuffle(rows)
    df = nested(spark.createDataFrame(rows, "id string, part int, ring int, seq int, x double, y double"), ["id"], F.lit("MultiPolygon"))
    assert df.schema["shape"].dataType.simpleString() == SHAPE
    row = df.select("shape", rounded_shape(F.col("shape")).alias("r"), canonical_json(F.col("shape")).alias("j"), shape_hash(F.col("shape")).alias("h"), shape_hash(rounded_shape(F.col("shape"))).alias("again")).first()
    parts = [[[(round(p["x"], 7), round(p["y"], 7)) for p in ring] for ring in part] for part in row["shape"]["parts"]]
    assert [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in row["r"]["parts"]] == parts
    want = json.dumps({"kind": "MultiPolygon", "parts": [[[[round(x * 1e7), round(y * 1e7)] for x, y in ring] for ring in part] for part in parts]}, separators=(",", ":"), sort_keys=True)
    assert row["j"] == want and row["h"] == row["again"] == hashlib.sha256(want.encode()).hexdigest()
    assert spark.range(1).select(canonical_json(F.lit(None).cast(SHAPE)).alias("j")).first()["j"] is None


def test_canonical_order_and_lines_by_value(spark):
    shape = lambda x: {"kind": "LineString", "parts": [[[{"x": x, "y": 1.0}, {"x": 2.0, "y": 2.0}]]]}
    rows = [(1, " straße", shape(0.0)), (2, "STRASSE\t", shape(5.0)), (3, None, shape(1.0)), (4, " ", shape(3.0)), (5, "Alley", shape(0.0)), (6, None, None)]
    df = spark.createDataFrame(rows, f"id int, name string, shape {SHAPE}")
    order = [r["id"] for r in places.in_canonical_order(df).orderBy("rank").collect()]
    hashes = {r["id"]: r["h"] for r in df.select("id", shape_hash(F.col("shape")).alias("h")).collect()}
    blank = sorted([3, 4, 6], key=lambda i: hashes[i] or "")
    assert order == [*blank, 5, *sorted([1, 2], key=lambda i: hashes[i])]
    assert order == [r["id"] for r in places.in_canonical_order(df.repartition(3)).orderBy("rank").collect()]
    drawn = spark.createDataFrame([(99, shape(1e-10))], f"id int, shape {SHAPE}")
    assert sorted(r["id"] for r in places.lines_not_drawn(df, drawn).collect()) == [2, 3, 4, 6]


@pytest.mark.parametrize(("kinds", "at"), [(["Point", "Polygon", "LineString"], 1), (["Point"], 0), ([], None)])
def test_shape_of_a_place(spark, kinds, at):
    assert spark.createDataFrame([(kinds,)], "k array<string>").select(layers.shape_of(F.col("k")).alias("a")).first()["a"] == at


def test_small_helpers(spark):
    df = spark.createDataFrame([("m", None, "c"), (None, "a", "c"), (None, None, "c")], "moved string, after string, before string")
    assert [r[0] for r in df.select(layers.moved_geometry(F.col("moved"), F.col("after"), F.col("before"))).collect()] == ["m", "a", "c"]
    assert spark.range(1).select(layers.swapped(F.array(F.lit(1.0), F.lit(2.0))).alias("s")).first()["s"] == [2.0, 1.0]
    sources = spark.createDataFrame([("x", "Second", 2), ("x", "First", 1), ("y", "Only", 3)], "slug string, title string, pos int")
    assert {tuple(r) for r in layers.titles(sources).collect()} == {("x", "First"), ("y", "Only")}
