"""Shapes of all kinds and sizes: against plain Python, across the 180th meridian, and an area of very many vertices."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from cairnfield.operators import grid

draw = random.Random(12)


def inside(ring, x, y):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
        if (ay > y) != (by > y) and ax + (y - ay) / (by - ay) * (bx - ax) > x:
            odd = not odd
    return odd


def metres(p, q):
    return math.hypot((q[0] - p[0]) * 111320.0 * math.cos(math.radians(p[1])), (q[1] - p[1]) * 110540.0)


def to_side(p, a, b):
    s = 111320.0 * math.cos(math.radians(p[1]))
    ux, uy, vx, vy = (a[0] - p[0]) * s, (a[1] - p[1]) * 110540.0, (b[0] - p[0]) * s, (b[1] - p[1]) * 110540.0
    dx, dy = vx - ux, vy - uy
    long = dx * dx + dy * dy
    t = 0.0 if not long else max(0.0, min(1.0, -(ux * dx + uy * dy) / long))
    return math.hypot(ux + t * dx, uy + t * dy)


def star(n, cx, cy, radius, jag=0.6):
    ring = [(cx + radius * (1 - jag * draw.random()) * math.cos(2 * math.pi * i / n), cy + radius * (1 - jag * draw.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*ring, ring[0]]


def comb(teeth, cx, cy, size):
    """A ring whose edges are nearly all as high as itself."""
    ring = [(cx, cy)]
    for i in range(teeth):
        w = size / teeth
        ring += [(cx + i * w, cy + size), (cx + (i + 0.5) * w, cy + size), (cx + (i + 0.5) * w, cy + size * 0.1), (cx + (i + 1) * w, cy + size * 0.1)]
    return [*ring, (cx + size, cy), (cx, cy)]


def edges_of(rings):
    """rings: {(fid, ring): vertices}."""
    return [(f, r, *a, *b) for (f, r), v in rings.items() for a, b in zip(v, v[1:], strict=False)]


AREA = "fid long, ring int, x0 double, y0 double, x1 double, y1 double"
POINT = "id long, x double, y double"


def test_contained_in_rings_of_all_sizes(spark):
    rings = {(1, 0): star(900, 10.0, 50.0, 0.4), (1, 1): star(200, 10.0, 50.0, 0.1, 0.2), (2, 0): star(7, 10.2, 50.1, 0.3), (3, 0): comb(150, 9.7, 49.8, 0.5), (4, 0): [(9.5, 49.5), (10.5, 49.5), (10.5, 50.5), (9.5, 50.5), (9.5, 49.5)], (4, 1): star(65, 9.9, 49.9, 0.2)}
    points = [(i, 10.0 + draw.uniform(-0.6, 0.6), 50.0 + draw.uniform(-0.6, 0.6)) for i in range(3000)] + [(5000 + i, 10.0, 50.0 + i * 1e-9) for i in range(200)]
    got = {tuple(r) for r in grid.contained(spark.createDataFrame(points, POINT), spark.createDataFrame(edges_of(rings), AREA), 500.0).collect()}
    want = {(i, f) for i, x, y in points for f in (1, 2, 3, 4) if inside(rings[f, 0], x, y) and not any(inside(v, x, y) for (g, r), v in rings.items() if g == f and r)}
    assert got == want and len(want) > 2000


def test_an_area_of_a_million_vertices(spark):
    """Points meet the edges of their own cell: no join is on the area alone."""
    n = 1_000_000
    turn = 2 * math.pi / n
    at = lambda i: (F.lit(10.0) + (0.3 + 0.1 * F.sin(i * turn * 5000)) * F.cos(i * turn), F.lit(50.0) + (0.3 + 0.1 * F.sin(i * turn * 5000)) * F.sin(i * turn))
    i = F.col("id")
    a, b = at(i), at((i + 1) % n)
    edges = spark.range(n).select(F.lit(1).cast("long").alias("fid"), F.lit(0).alias("ring"), a[0].alias("x0"), a[1].alias("y0"), b[0].alias("x1"), b[1].alias("y1"))
    points = spark.range(100_000).select("id", (F.lit(9.55) + (i * 7919 % 100_003) / 100_003 * 0.9).alias("x"), (F.lit(49.55) + (i * 104_729 % 99_991) / 99_991 * 0.9).alias("y"))
    began = time.time()
    got = {r["id"] for r in grid.contained(points, edges, 500.0).collect()}
    assert time.time() - began < 120
    # away from the rim, where the jags run between 0.2 and 0.4
    for r in points.where("id % 20 = 0").collect():
        d = math.hypot(r["x"] - 10.0, r["y"] - 50.0)
        assert d <= 0.4 if r["id"] in got else d >= 0.2
        phi = math.atan2(r["y"] - 50.0, r["x"] - 10.0)
        rim = 0.3 + 0.1 * math.sin(phi * 5000)
        if abs(d - rim) > 1e-3:
            assert (r["id"] in got) == (d < rim)


def test_nearest_of_each_kind_is_found_however_far(spark):
    places = [(i, draw.uniform(-5, 5), draw.uniform(40, 50)) for i in range(30)]
    lines = {i: [(draw.uniform(-5, 5), draw.uniform(40, 50)) for _ in range(3)] for i in range(8)}
    rings = {(1, 0): star(90, 0.0, 45.0, 1.0), (1, 1): star(9, 0.0, 45.0, 0.3), (2, 0): star(5, 3.0, 47.0, 0.4)}
    targets = [(i, draw.uniform(-5, 5), draw.uniform(40, 50)) for i in range(5)] + [(9, 0.0, 45.0)]
    sides = grid.sides_of(spark.createDataFrame(targets, POINT), spark.createDataFrame([(i, *a, *b) for i, v in lines.items() for a, b in zip(v, v[1:], strict=False)], "id long, x0 double, y0 double, x1 double, y1 double"), spark.createDataFrame(edges_of(rings), AREA).withColumnRenamed("fid", "id"))
    got = {(r["id"], r["kind"]): (r["sid"], r["m"]) for r in grid.nearest_shapes(spark.createDataFrame(places, POINT), sides, ["point", "line", "area", "other"], 1000.0).collect()}
    assert len(got) == 4 * len(places)
    for i, x, y in places:
        p = (x, y)
        best = {"point": min((metres(p, t[1:]), t[0]) for t in targets), "line": min((to_side(p, a, b), k) for k, v in lines.items() for a, b in zip(v, v[1:], strict=False))}
        area = [(0.0, f) for f in (1, 2) if inside(rings[f, 0], x, y) and not any(inside(v, x, y) for (g, r), v in rings.items() if g == f and r)] + [(to_side(p, a, b), f) for (f, _), v in rings.items() for a, b in zip(v, v[1:], strict=False)]
        best["area"] = min(area)
        for kind, (m, sid) in best.items():
            assert got[i, kind][0] == sid and got[i, kind][1] == pytest.approx(m, abs=1e-6)
        assert got[i, "other"] == (None, math.inf)


def test_touching_by_vertex_to_line_and_inside(spark):
    step = 0.0001  # about 7.9 m east, 11 m north
    lines = [(1, 0.0, 45.0, 100 * step, 45.0), (2, 50 * step, 45.0 + 0.4 * step, 50 * step, 45.0 + 20 * step), (3, 0.0, 45.0 + 2 * step, 100 * step, 45.0 + 2 * step)]
    ring = {(7, 0): [(60 * step, 45.0 + 5 * step), (90 * step, 45.0 + 5 * step), (90 * step, 45.0 + 30 * step), (60 * step, 45.0 + 30 * step), (60 * step, 45.0 + 5 * step)]}
    sides = grid.sides_of(spark.createDataFrame([(4, 70 * step, 45.0 + 15 * step), (5, 50.3 * step, 45.0 + 10 * step)], POINT), spark.createDataFrame(lines, "id long, x0 double, y0 double, x1 double, y1 double"), spark.createDataFrame(edges_of(ring), AREA).withColumnRenamed("fid", "id"))
    got = sorted((tuple(r["a"]), tuple(r["b"])) for r in grid.touching_shapes(sides, 5.0).collect())
    # 2 ends beside the middle of 1; 3 crosses 2 between vertices, which does not touch; 5 lies beside 2; 4 is inside 7
    assert got == [(("area", 7), ("point", 4)), (("line", 1), ("line", 2)), (("line", 2), ("point", 5))]


def test_pairs_across_the_180th_meridian_and_at_the_poles(spark):
    rows = [(1, 179.9999, 10.0), (2, -179.9999, 10.0), (3, 179.99995, 10.0), (4, 0.0, 10.0), (5, -180.0, 10.0), (6, 30.0, 89.9999), (7, 31.0, 89.9999), (8, -150.0, 89.9999), (9, 180.0, -45.0), (10, -180.0, -45.0)]
    points = spark.createDataFrame(rows, POINT)
    wrapped = lambda d: (d + 180.0) % 360.0 - 180.0
    near = lambda a, b: metres((0.0, a[2]), (wrapped(b[1] - a[1]), b[2]))
    got = {(r["a"], r["b"]): r["m"] for r in grid.near_points(points, 50.0).collect()}
    want = {(a[0], b[0]): near(a, b) for a in rows for b in rows if a[0] < b[0] and near(a, b) <= 50.0}
    assert set(got) == set(want) and (1, 2) in got and (9, 10) in got and (6, 7) in got
    assert all(got[k] == pytest.approx(m, abs=1e-6) for k, m in want.items())
    line = spark.createDataFrame([(-179.9998, 9.9, -179.9998, 10.1)], "x0 double, y0 double, x1 double, y1 double")
    at = grid.snap_to_lines(points.where("id = 1"), line, 10.0).first()
    assert at["x"] == pytest.approx(-179.9998) and at["m"] == pytest.approx(0.0003 * 111320 * math.cos(math.radians(10)), abs=0.01)
    area = spark.createDataFrame(edges_of({(1, 0): [(179.5, 9.5), (180.5, 9.5), (180.5, 10.5), (179.5, 10.5), (179.5, 9.5)]}), AREA)
    assert sorted(r["id"] for r in grid.contained(points, area, 500.0).collect()) == [1, 2, 3, 5]
    assert {(r["id"], r["target"]) for r in grid.nearest_point(points.where("id = 1"), points.where("id in (2, 4)").select("id", "x", "y"), 5.0).collect()} == {(1, 2)}


def test_boxes_of_very_different_sizes(spark):
    boxes = []
    for i in range(300):
        x, y, s = draw.uniform(-1, 1), draw.uniform(44, 46), draw.choice([0.0, 0.0005, 0.01, 0.3, 1.5])
        boxes.append((i, x, y, x + s * draw.random(), y + s * draw.random()))
    got = sorted(tuple(r) for r in grid.near_boxes(spark.createDataFrame(boxes, "id long, min_x double, min_y double, max_x double, max_y double"), 0.002, 0.001, 100.0).collect())
    gap = lambda a, b, lo, hi: max(a[lo] - b[hi], b[lo] - a[hi], 0.0)
    assert got == sorted((a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and gap(a, b, 1, 3) <= 0.002 and gap(a, b, 2, 4) <= 0.001)
