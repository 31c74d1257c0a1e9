"""Areas looked up whole against the general way, edge by edge."""

import random

from pyspark.sql import functions as F

from cairnfield.operators import grid, places


def _square(fid, ring, x, y, w):
    c = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    return [(fid, ring, *a, *b) for a, b in zip(c, c[1:])]


def test_whole_areas_meet_once_and_as_edge_by_edge(spark):
    draw = random.Random(7)
    rows = []
    for fid in range(40):
        x, y, w = draw.uniform(10, 10.05), draw.choice([0.0, 45.0, -60.0]) + draw.uniform(0, 0.03), draw.choice([0.0005, 0.004, 0.02])
        rows += _square(fid, 0, x, y, w)
        if fid % 3 == 0:
            rows += _square(fid, 1, x + w / 4, y + w / 4, w / 2)
        if fid % 6 == 0:
            rows += _square(fid, 2, x + w / 8, y + w / 8, w / 16)
    # near the 180th meridian and the pole areas go the general way, as do those of many edges
    rows += _square(100, 0, 179.999, 1.0, 0.0009) + _square(101, 0, 20.0, 89.5, 0.1)
    segs = spark.createDataFrame(rows, "fid int, ring int, x0 double, y0 double, x1 double, y1 double")
    pts = [(i, draw.uniform(9.99, 10.08), draw.choice([0.0, 45.0, -60.0]) + draw.uniform(-0.01, 0.06)) for i in range(400)]
    pts += [(1000, -179.9995, 1.0004), (1001, 179.9995, 1.0004), (1002, 20.05, 89.55), (1003, rows[0][2], rows[0][3]), (1004, None, 1.0)]
    points = spark.createDataFrame(pts, "id int, x double, y double")
    got = sorted(tuple(r) for r in grid.within_polygons(points, segs, 300.0).select("id", "fid", "m").collect())
    want = sorted(tuple(r) for r in grid._near_parts(points, segs, 300.0).select("id", "fid", "m").collect())
    assert got == want and len(got) > 200 and any(m == 0 for _, _, m in got)


def test_pairs_are_not_shuffled(spark):
    """What meets is done where it meets: no grouping of the pairs edge by edge."""
    segs = spark.createDataFrame(_square(1, 0, 10.0, 45.0, 0.004), "fid int, ring int, x0 double, y0 double, x1 double, y1 double")
    points = spark.range(50).select("id", (F.lit(10.0) + F.col("id") / 5000).alias("x"), F.lit(45.002).alias("y"))
    df = grid.within_polygons(points, segs, 400.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate(keys=[id" not in plan
    assert df.count() > 0


def test_points_meet_the_area_they_name_alone(spark, monkeypatch):
    """to tell if its own area is near, a point met all areas within reach."""
    draw = random.Random(9)
    rows = [r for fid in range(20) for r in _square(fid, 0, draw.uniform(10, 10.01), 45 + draw.uniform(0, 0.01), 0.004)]
    # one that is not looked up whole
    rows += _square(100, 0, 179.999, 1.0, 0.0009)
    segs = spark.createDataFrame(rows, "fid int, ring int, x0 double, y0 double, x1 double, y1 double")
    pts = [(i, draw.uniform(9.99, 10.02), 45 + draw.uniform(-0.01, 0.02), i % 25) for i in range(200)] + [(1000, -179.9995, 1.0004, 100), (1001, 179.9995, 1.0004, 3)]
    points = spark.createDataFrame(pts, "id int, x double, y double, fid int")
    named = {(p[0], p[3]) for p in pts}
    want = sorted(tuple(r) for r in grid.within_polygons(points.drop("fid"), segs, 300.0).select("id", "fid", "m").collect() if (r["id"], r["fid"]) in named)
    met = []
    real = grid._measured
    monkeypatch.setattr(grid, "_measured", lambda found, reach: met.append(found.count()) or real(found, reach))
    assert sorted(tuple(r) for r in grid.within_own(points, segs, 300.0).select("id", "fid", "m").collect()) == want and len(want) > 10
    assert met == [sum(p[3] < 20 for p in pts)]


def test_edges_are_not_interpreted(spark):
    """A pair's edges were arrays, which Spark interprets."""
    segs = spark.createDataFrame(_square(1, 0, 10.0, 45.0, 0.004) + _square(1, 1, 10.001, 45.001, 0.001), "fid int, ring int, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 10.0005, 45.0005), (2, 10.0015, 45.0015)], "id int, x double, y double")
    df = grid.within_polygons(points, segs, 400.0)
    assert "transform(" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: r["m"] for r in df.collect()}
    assert got[1] == 0 and 30 < got[2] < 60


def test_preferred_areas_without_all_pairs(spark, monkeypatch):
    """a point met all areas within reach, whatever their names."""
    draw = random.Random(15)
    rows = [r for fid in range(60) for r in _square(fid, 0, draw.uniform(10, 10.006), 45 + draw.uniform(0, 0.006), 0.0004)]
    # one that is not looked up whole
    rows += _square(100, 0, 179.999, 1.0, 0.0009)
    names = {fid: [None, "Oak", "Oak Hall", "Elm"][fid % 4] for fid in range(60)} | {100: "Oak"}
    segs = spark.createDataFrame(rows, "fid int, ring int, x0 double, y0 double, x1 double, y1 double")
    areas = spark.createDataFrame(list(names.items()), "fid int, name string")
    labels = [None, "(New) Oak hall, west", "Elmwood", "Birch", "oak"]
    pts = [(i, draw.uniform(9.998, 10.008), 45 + draw.uniform(-0.002, 0.008), labels[i % 5]) for i in range(100)] + [(1000, -179.9995, 1.0004, "Oak 7")]
    points = spark.createDataFrame(pts, "id int, x double, y double, label string")
    slug = lambda t: "".join(c for c in t.lower().removeprefix("(new)") if c.isalnum())
    label = {p[0]: p[3] for p in pts}
    want = {}
    for r in grid.within_polygons(points.select("id", "x", "y"), segs, 300.0).collect():
        fit = label[r["id"]] is not None and names[r["fid"]] is not None and slug(label[r["id"]]).startswith(slug(names[r["fid"]]))
        want[r["id"]] = min(want.get(r["id"], (2,)), (0 if fit else 1, r["m"], r["fid"]))
    asked, real = [], grid.within_polygons
    monkeypatch.setattr(grid, "within_polygons", lambda p, s, reach, same=(): asked.append((reach, same)) or real(p, s, reach, same))
    got = {r["id"]: r["parent"] for r in places.preferred_within(points, segs, areas, 300.0).collect()}
    assert got == {k: v[2] for k, v in want.items()} and {v[0] for v in want.values()} == {0, 1}
    # names are part of the join, and the nearest are looked for in less than the reach
    assert asked[0] == (300.0, ("key",)) and asked[1][0] < 300.0
