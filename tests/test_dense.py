"""Searches among many shapes in one place: how much meets, and that what is found stays the same."""

import math
import random

from pyspark.sql import functions as F

from cairnfield.operators import grid, measures


def _dense(spark, n):
    draw = random.Random(5)
    return spark.createDataFrame([(i, draw.uniform(10, 10.01), draw.uniform(45, 45.01)) for i in range(n)], "id long, x double, y double")


def test_nearest_point_begins_near_where_targets_lie_dense(spark, monkeypatch):
    """a point met all targets within a kilometre."""
    reaches = []
    real = grid.box_cells
    monkeypatch.setattr(grid, "box_cells", lambda boxes, reach: reaches.append(reach) or real(boxes, reach))
    targets, points = _dense(spark, 2000), _dense(spark, 50).withColumn("x", F.col("x") + 1e-5)
    got = {r["id"]: (r["target"], r["m"]) for r in grid.nearest_point(points, targets, 1000.0).collect()}
    assert reaches[0] < 100
    t = targets.collect()
    for p in points.collect():
        m, target = min((math.hypot((q["x"] - p["x"]) * math.cos(math.radians(p["y"])) * 111320, (q["y"] - p["y"]) * 110540), q["id"]) for q in t)
        assert got[p["id"]][0] == target and abs(got[p["id"]][1] - m) < 1e-9


def test_nearest_other_of_copies_in_one_place(spark):
    """copies of a place met one another all."""
    rows = [(i, 10.0, 45.0) for i in range(50)] + [(60, 10.0, 45.001), (61, 10.5, 45.0), (61, 10.6, 45.0)]
    v = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r["id"]: r["m"] for r in grid.nearest_other(v, 2000.0).collect()}
    assert {got[i] for i in range(50)} == {0.0} and abs(got[60] - 110.54) < 1e-6 and len(got) == 52 and got[61] > 39000
    assert grid.nearest_other(v.where("id = 61"), 2000.0).count() == 0


def test_snap_to_lines_meets_pieces_of_long_segments(spark):
    """a segment filled the cells of its whole box, so points far from it met it."""
    segments = spark.createDataFrame([(10.0, 45.0 + i * 1e-2, 10.1, 45.1 + i * 1e-2) for i in range(20)], "x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 10.09, 45.01), (2, 10.05, 45.06)], "id long, x double, y double")
    assert grid.near_segments(points, segments, 30.0).count() < 10
    far = {r["id"]: r["m"] for r in grid.snap_to_lines(points, segments, 30.0).collect()}
    want = {p["id"]: min(r["m"] for r in points.where(F.col("id") == p["id"]).crossJoin(segments).select(grid.to_segment(*[F.col(c) for c in ("x", "y", "x0", "y0", "x1", "y1")]).alias("m")).collect()) for p in points.collect()}
    assert all(abs(far[k] - want[k]) < 1e-6 for k in want)


def test_near_pairs_are_not_broadcast(spark):
    """What explodes into cells looks small to the planner."""
    plan = grid.near_points(_dense(spark, 50), 150.0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_near_boxes_meet_once(spark):
    """pairs met twice and were shuffled again to be told apart."""
    draw = random.Random(7)
    rows = [(i, x, y, x + draw.choice([1e-4, 3e-3, 0.02]), y + draw.choice([1e-4, 3e-3, 0.02])) for i in range(120) for x, y in [(draw.uniform(10, 10.1), draw.uniform(45, 45.1))]]
    boxes = spark.createDataFrame(rows, "id long, min_x double, min_y double, max_x double, max_y double")
    for gap in (0.0, 0.002):
        pairs = grid.near_boxes(boxes, gap, gap, 200.0)
        assert "HashAggregate" not in pairs._jdf.queryExecution().executedPlan().toString()
        want = sorted((p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and max(p[1] - q[3], q[1] - p[3], p[2] - q[4], q[2] - p[4]) <= gap)
        assert sorted(tuple(r) for r in pairs.collect()) == want


def test_rename_pairs_are_not_broadcast(spark):
    """candidates, which grow in the join, were sent to the driver."""
    from cairnfield.operators.diff import paired_renames

    rows = _dense(spark, 40).withColumn("kind", F.lit("k"))
    got = paired_renames(rows, rows.withColumn("id", F.col("id") + 100), 400.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and got.count() == 40


def test_lines_of_dense_trails_are_tied_as_by_all_pairs(spark):
    """all vertices and segments of a trail within reach met."""
    from cairnfield.operators import graph
    from cairnfield.operators.graph import components

    draw = random.Random(11)
    rows = []
    for line in range(80):
        x, y = (10 + draw.uniform(0, 0.004), 45 + draw.uniform(0, 0.004)) if line < 40 else (10 + draw.uniform(0, 0.1), 45 + draw.uniform(0, 0.1))
        # every seventh has one vertex, and so no segment
        rows += [(line % 2, line, i, x + i * 0.004, y + draw.uniform(0, 0.002)) for i in range(1 if line % 7 == 0 else 4)]
    v = spark.createDataFrame(rows, "trail int, line int, seq int, x double, y double")
    sides = measures.segments(v, ["trail", "line"])
    far = v.select("trail", F.col("line").alias("a"), "x", "y").join(sides.withColumnRenamed("line", "b"), "trail").where("a <> b")
    near = far.where(grid.to_segment(*[F.col(c) for c in ("x", "y", "x0", "y0", "x1", "y1")]) <= 400.0).select("a", "b").distinct()
    root = {r["node"]: r["root"] for r in components(near).collect()}
    want = {}
    for line in range(80):
        want.setdefault(root.get(line, line), set()).add(line)
    got = {}
    for r in graph.linked_lines(v, 400.0).collect():
        got.setdefault(tuple(r["label"]), set()).add(r["id"]["line"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 8
