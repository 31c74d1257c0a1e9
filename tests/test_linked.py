"""Points tied by cells against all their pairs."""

import random

from cairnfield.operators import conflate, grid
from cairnfield.operators.graph import components


def test_linked_points_as_all_pairs(spark):
    draw = random.Random(3)
    rows = [(i, draw.uniform(10, 10.02), draw.uniform(45, 45.02)) for i in range(150)]
    # a dense place, a pole, both sides of the 180th meridian, an id in two places
    rows += [(1000 + i, 11 + draw.uniform(0, 0.002), 45 + draw.uniform(0, 0.002)) for i in range(60)]
    rows += [(2000 + i, draw.uniform(-180, 180), 89.99 + draw.uniform(0, 0.01)) for i in range(30)]
    rows += [(3000, 179.9999, 5.0), (3001, -179.9999, 5.0), (1005, 12.0, 45.0), (4000, 12.0005, 45.0), (5000, 13.0, 45.0), (5000, 14.0, 45.0)]
    pts = spark.createDataFrame(rows, "id long, x double, y double")
    got = sorted(tuple(r) for r in grid.linked_points(pts, 200.0).select("node", "root").collect())
    want = sorted(tuple(r) for r in components(grid.near_points(pts, 200.0)).select("node", "root").collect())
    assert got == want and len({r for _, r in got}) > 5 and (4000, 1000) in got


def test_pieces_of_dense_names_join_as_one_by_one(spark, monkeypatch):
    """all corners met all areas of all names within reach."""
    draw = random.Random(13)
    rows, corners = [], {}
    for fid in draw.sample(range(1000), 120):
        x, y = 10 + draw.uniform(0, 0.03), 45 + draw.uniform(0, 0.02) + draw.choice([0, 0, 0.05])
        c = [(x, y), (x + 0.001, y), (x + 0.001, y + 0.001), (x, y + 0.001), (x, y)]
        corners[fid] = c
        rows += [(fid, [None, "lot", "field"][fid % 3], 0, i, *at) for i, at in enumerate(c)]
    v = spark.createDataFrame(rows, "id long, name string, ring int, seq int, x double, y double")
    points = v.selectExpr("struct(id, seq) as id", "x", "y").where("id.seq < 4")
    sides = spark.createDataFrame([(f, 0, *a, *b) for f, c in corners.items() for a, b in zip(c, c[1:])], "fid long, ring int, x0 double, y0 double, x1 double, y1 double")
    near = {(r["fid"], r["id"]["id"]) for r in grid.within_polygons(points, sides, 500.0).collect()}
    want = {}
    for fid in sorted(corners):
        own = [want[a] for a in want if a % 3 == fid % 3 and want[a] == min(k for k in corners if k % 3 == fid % 3) and (a, fid) in near]
        want[fid] = own[0] if own else fid
    asked, real = [], grid.within_polygons
    monkeypatch.setattr(grid, "within_polygons", lambda p, *rest: asked.append(p.count()) or real(p, *rest))
    got = {r["id"]: r["root"] for r in conflate.merged_pieces(v, 500.0).collect()}
    assert got == want and 3 < len(set(want.values())) < 100
    assert sum(asked) < 4 * len(corners)
