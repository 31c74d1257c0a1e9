"""Measures on small shapes with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cairnfield.functions import geo
from cairnfield.functions.markup import plain_text
from cairnfield.functions.scalars import blank_to_null, casefolded, hyphenated, plural, slug, split_once, templated
from cairnfield.operators import checks, conflate, diff, graph, grid, measures, places


def ring(fid, ring_no, points):
    return [(fid, ring_no, i, float(x), float(y)) for i, (x, y) in enumerate(points)]


@pytest.fixture(scope="module")
def hollow(spark):
    """A square of 0.001 degrees with a centred hole of a fifth of its width."""
    x, y, s = -93.18, 44.46, 0.001
    outer = [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    a, b = 0.4 * s, 0.6 * s
    hole = [(x + a, y + a), (x + b, y + a), (x + b, y + b), (x + a, y + b), (x + a, y + a)]
    v = spark.createDataFrame(ring(1, 0, outer) + ring(1, 1, hole), "id long, ring int, seq int, x double, y double")
    return measures.segments(v, ["id", "ring"]).withColumnRenamed("id", "fid").select("fid", "ring", "x0", "y0", "x1", "y1"), v


def test_distance_to_hollow_square(spark, hollow):
    s, x, y = 0.001, -93.18, 44.46
    pts = {1: (x + 0.2 * s, y + 0.2 * s), 2: (x + 0.5 * s, y + s + 0.0001), 3: (x + s + 0.0001, y + s + 0.0001), 4: (x + 0.5 * s, y + 0.5 * s)}
    p = spark.createDataFrame([(k, *v) for k, v in pts.items()], "id long, x double, y double")
    m = {r["id"]: r["m"] for r in grid.within_polygons(p, hollow[0], 50.0).collect()}
    assert m[1] == 0
    assert m[2] == pytest.approx(11.05, abs=0.05)
    assert m[3] == pytest.approx(math.hypot(11.054, 0.0001 * math.cos(math.radians(44.4611)) * 111320), abs=0.05)
    assert m[4] > 7  # in the hole, so at its edge


def test_area_of_ring(hollow):
    a = {r["ring"]: r["area"] for r in measures.ring_areas(hollow[1], ["id", "ring"]).collect()}
    assert a[0] == pytest.approx(1e-6) and a[1] == pytest.approx(4e-8)


def test_length(spark):
    v = spark.createDataFrame([(1, i, -93.0, 44.0 + 0.001 * i) for i in range(3)], "id long, seq int, x double, y double")
    assert measures.lengths(v, ["id"]).first()["metres"] == pytest.approx(222.4, abs=0.05)


def test_off_runs_of_moved_line(spark):
    line = lambda dy: [(1, i, -93.0 + 0.00001 * i, 44.0 + dy) for i in range(0, 11)]
    schema = "id long, seq int, x double, y double"
    before, after = spark.createDataFrame(line(0.0), schema), spark.createDataFrame(line(0.00012), schema)
    runs = measures.off_runs(after, measures.segments(before, ["id"]).drop("seq"), ["id"], 3.0).collect()
    assert len(runs) == 1 and runs[0]["metres"] == pytest.approx(8, abs=0.3)


def test_simplify_keeps_corner(spark):
    pts = [(0.0, 0.0), (1.0, 0.001), (2.0, 0.0), (2.0, 1.0), (2.0, 2.0)]
    v = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate(pts)], "id long, seq int, x double, y double")
    assert sorted(r["seq"] for r in measures.simplified(v, ["id"], 0.01).collect()) == [0, 2, 4]


def test_components_on_random_edges(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in nodes}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_renames_like_one_by_one(spark):
    draw = random.Random(5)
    old = [(i, "k", -93 + draw.random() / 1000, 44 + draw.random() / 1000) for i in range(25)]
    new = [(100 + i, "k", -93 + draw.random() / 1000, 44 + draw.random() / 1000) for i in range(20)]
    m = lambda p, q: math.hypot((q[2] - p[2]) * math.cos(math.radians(p[3])) * geo.LON_M, (q[3] - p[3]) * geo.LAT_M)
    free, want = list(new), set()
    for p in old:
        near = min(((m(p, q), q[0], q) for q in free), default=None)
        if near and near[0] <= 25:
            want.add((p[0], near[1]))
            free.remove(near[2])
    schema = "id long, kind string, x double, y double"
    got = {(r["old"], r["new"]) for r in diff.paired_renames(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), 25.0).collect()}
    assert got == want


def test_pieces_join_in_order(spark):
    square = lambda fid, x: [(fid, "lot", *r[1:]) for r in ring(fid, 0, [(x, 44.0), (x + 0.0001, 44.0), (x + 0.0001, 44.0001), (x, 44.0001), (x, 44.0)])]
    # 2 is far from 1 when its turn comes; 3 reaches 1; 4 reaches 3
    rows = square(1, -93.0) + square(2, -92.998) + square(3, -92.9995) + square(4, -92.999)
    got = {r["id"]: r["root"] for r in conflate.merged_pieces(spark.createDataFrame(rows, "id long, name string, ring int, seq int, x double, y double"), 50.0).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1}


def test_scalars(spark):
    c = lambda v: F.lit(v).cast("string")
    a, b = split_once(c("Hall - East - 2"), " - ")
    row = spark.range(1).select(slug(c("(Old) Main Hall!")).alias("s"), a.alias("a"), b.alias("b"), templated("Rack", c(None)).alias("t"), templated("Rack", c("Hall"), c("east")).alias("u"), plural(c("entry")).alias("p"), plain_text(c("<p>A&amp;B<br>c</p>")).alias("x")).first()
    assert tuple(row) == ("mainhall", "Hall", "East - 2", "Rack", "Rack, Hall (east)", "entries", "A&B c")


def test_ids_are_numbered(spark):
    rows = spark.createDataFrame([(1, "Lot A"), (2, "lot a"), (3, "Porter")], "pos long, name string")
    got = [r["id"] for r in conflate.assign_ids(rows, "lot", F.col("name")).orderBy("pos").collect()]
    assert got == ["lota-1", "lota-2", "lotporter"]


def test_patch_null_overwrites(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id long, x string, y string")
    patches = spark.createDataFrame([(1, "x", "new", 1), (1, "x", None, 2), (2, "y", "z", 1)], "id long, field string, value string, pos long")
    assert sorted(map(tuple, conflate.patched(rows, patches, ["x", "y"]).collect())) == [(1, None, "b"), (2, "c", "z")]


def test_unknown_version_is_an_error(spark):
    with pytest.raises(ValueError):
        conflate.read_version(spark.createDataFrame([("v1", 1)], "snapshot_id string, id long"), "v2")


def test_word_runs():
    assert diff.word_runs("a red barn", "a blue barn") == [("same", "a"), ("removed", "red"), ("added", "blue"), ("same", "barn")]


def test_areas_far_apart_and_ranks_in_ranges(spark):
    from cairnfield.operators.ranks import ranked
    from cairnfield.plans.networks import _apart

    far = spark.createDataFrame([(1, -93.0, 44.0), (1, -93.0, 44.1), (2, -93.0, 46.0), (3, -93.0, 46.01)], "id long, x double, y double")
    got = {r["id"]: round(r["m"]) for r in _apart(far).collect()}
    assert got == {1: 210026, 2: 1105, 3: 1105}
    rows = spark.range(5_000).selectExpr("id", "hash(id) AS h")
    df = ranked(rows, ["h", "id"])
    want = {i: k for k, (_, i) in enumerate(sorted((r["h"], r["id"]) for r in rows.collect()), 1)}
    assert {r["id"]: r["rank"] for r in df.collect()} == want


def test_text_like_python(spark):
    import html
    import re

    odd = ["  a\u00a0", "\x1c \t\n", "Stra\u00dfe (Alt)", "(Agnes) Larson Hall", "\ufb01ne K\u212a \u0130x \u0149", "Admissions  Parking!", "", "a&eacute;&#8217;&notin;&amp;lt; &#x41; &bogus; &copy", "<p>one</p><p>two<BR/>three</li> <b>x</b>", "<p> </p>"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, t string").select("i", blank_to_null(F.col("t")).alias("b"), casefolded(F.col("t")).alias("c"), slug(F.col("t")).alias("s"), hyphenated(F.col("t")).alias("h"), plain_text(F.col("t")).alias("p")).collect()
    for r in got:
        t = odd[r["i"]]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>|</p>|</li>", " ", t))
        assert r["b"] == (t.strip() or None)
        assert r["c"] == t.casefold()
        assert r["s"] == re.sub(r"[^a-z0-9]+", "", re.sub(r"^\s*\([^)]*\)\s*", "", t).casefold())
        assert r["h"] == re.sub(r"[^a-z0-9]+", "-", t.casefold()).strip("-")
        assert r["p"] == (re.sub(r"\s+", " ", html.unescape(plain)).strip() or None)


def test_near_points_at_all_latitudes(spark):
    draw = random.Random(8)
    rows = []
    for k, lat in enumerate((-70.0, 0.0, 44.0, 70.0, 83.0)):
        rows += [(1000 * k + i, draw.random() * 0.05, lat + draw.random() * 0.01) for i in range(80)]
    m = lambda p, q: math.hypot((q[1] - p[1]) * math.cos(math.radians(p[2])) * geo.LON_M, (q[2] - p[2]) * geo.LAT_M)
    want = {(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and m(p, q) <= 150}
    got = {(r["a"], r["b"]) for r in grid.near_points(spark.createDataFrame(rows, "id long, x double, y double"), 150.0).collect()}
    assert got == want and len(want) > 100


def test_nearest_however_far(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 19.0, 0.0), (3, -120.0, 60.0)], "id long, x double, y double")
    targets = spark.createDataFrame([(7, 20.0, 0.0), (8, 21.0, 0.0)], "id long, x double, y double")
    assert {r["id"]: r["target"] for r in grid.nearest_point(points, targets, 100.0).collect()} == {1: 7, 2: 7, 3: 7}
    assert grid.nearest_point(points, targets.limit(0), 100.0).count() == 0
    lines = spark.createDataFrame([(20.0, -1.0, 20.0, 1.0), (25.0, 0.0, 26.0, 0.0)], "x0 double, y0 double, x1 double, y1 double")
    got = {r["id"]: (round(r["x"], 6), round(r["y"], 6)) for r in grid.snap_to_lines(points, lines, 100.0).collect()}
    assert got == {1: (20.0, 0.0), 2: (20.0, 0.0), 3: (20.0, 1.0)}


def test_large_areas_fill_few_cells(spark, hollow):
    boxes = spark.createDataFrame([(1, -93.0, 44.0, -92.0, 45.0), (2, -93.0, 44.0, -92.9999, 44.0001)], "fid long, min_x double, min_y double, max_x double, max_y double")
    assert grid.box_cells(grid.leveled(boxes, 1.0), 1.0).count() <= 50


def test_moves_both_ways(spark):
    schema = "id long, seq int, x double, y double"
    before = spark.createDataFrame([(1, 0, -93.0, 44.0), (1, 1, -93.0, 44.001)], schema)
    after = spark.createDataFrame([(1, 0, -93.0, 44.0), (1, 1, -93.0, 44.0005)], schema)
    row = measures.moved(before, after, ["id"], 3.0).first()
    assert row["added_m"] == 0 and row["dropped_m"] == pytest.approx(55.27 - 3, abs=1.1)


def test_simplify_like_one_by_one(spark):
    draw = random.Random(4)
    lines = {k: [(draw.random(), draw.random()) for _ in range(n)] for k, n in enumerate((2, 3, 12, 40))}

    def keep(p, lo, hi, tol):
        def d(i):
            (ax, ay), (bx, by), (x, y) = p[lo], p[hi], p[i]
            dx, dy = bx - ax, by - ay
            t = max(0.0, min(1.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
            return math.hypot(x - ax - t * dx, y - ay - t * dy)

        if hi - lo < 2:
            return set()
        mid = max(range(lo + 1, hi), key=lambda i: (d(i), -i))
        return {mid} | keep(p, lo, mid, tol) | keep(p, mid, hi, tol) if d(mid) > tol else set()

    rows = [(k, i, x, y) for k, p in lines.items() for i, (x, y) in enumerate(p)]
    got = {(r["id"], r["seq"]) for r in measures.simplified(spark.createDataFrame(rows, "id int, seq int, x double, y double"), ["id"], 0.2).collect()}
    assert got == {(k, i) for k, p in lines.items() for i in {0, len(p) - 1} | keep(p, 0, len(p) - 1, 0.2)}


def test_icp_lays_nodes_on_lines(spark):
    draw = random.Random(6)
    # streets of a town, and a plan of it in other units
    streets = [(-93.0 + 0.002 * i, 44.0, -93.0 + 0.002 * i, 44.01) for i in range(5)] + [(-93.0, 44.0 + 0.002 * i, -92.992, 44.0 + 0.002 * i) for i in range(6)]
    plan = lambda x, y: ((x + 93) * 1e5 + 20, (y - 44) * 1e5 - 30)
    nodes = []
    for i in range(80):
        x0, y0, x1, y1 = draw.choice(streets)
        t = draw.random()
        nodes.append((i, *plan(x0 + t * (x1 - x0), y0 + t * (y1 - y0))))
    anchors = [(*plan(x, y), x + draw.uniform(-1, 1) * 1e-4, y + draw.uniform(-1, 1) * 1e-4) for x, y in [(-93.0, 44.0), (-92.992, 44.0), (-93.0, 44.01), (-92.992, 44.01)]]
    n = spark.createDataFrame(nodes, "id long, px double, py double")
    a = spark.createDataFrame(anchors, "px double, py double, x double, y double")
    s = spark.createDataFrame(streets, "x0 double, y0 double, x1 double, y1 double")
    off = lambda fit: grid.snap_to_lines(graph.mapped(n, fit), s, 20.0).agg(F.avg("m")).first()[0]
    assert off(graph.icp(n, a, s)) < 0.5 * off(graph.affine_fit(a))
    assert graph.icp(n.limit(5), a, s)[0].tolist() == graph.affine_fit(a)[0].tolist()


def test_trails_are_put_together(spark):
    line = lambda t, k, pts: [(t, k, i, -93.0 + x * 1e-5, 44.0 + y * 1e-5) for i, (x, y) in enumerate(pts)]
    # 1 and 2 meet in a T, 3 lies apart; trail 20 is one line
    rows = line(10, 1, [(0, 0), (100, 0)]) + line(10, 2, [(50, 1), (50, 80)]) + line(10, 3, [(0, 300), (50, 300)]) + line(20, 4, [(0, 0), (9, 0)])
    got = graph.assembled(spark.createDataFrame(rows, "trail long, line long, seq int, x double, y double"), 5.0)
    assert {(r["trail"], r["pieces"], r["parts"], r["vertices"]) for r in got.collect()} == {(10, 3, 2, 6), (20, 1, 1, 2)}
    wanted = spark.createDataFrame([(10, 1e6), (20, 7.2)], "trail long, wanted_m double")
    assert {tuple(r) for r in graph.untidy(got, wanted).collect()} == {("in several parts", "10"), ("wrong length", "10")}


def test_lines_are_cut_at_the_nearest_vertex(spark):
    v = spark.createDataFrame([(k, i, -93.0 + i * 1e-4, 44.0) for k in (1, 2, 3) for i in range(5)], "line long, seq int, x double, y double")
    cuts = spark.createDataFrame([(1, -93.0 + 2.2e-4, 44.0, "before"), (2, -93.0 + 1.8e-4, 44.0, "after")], "line long, x double, y double, side string")
    got = {(r["line"], r["seq"]) for r in graph.cut_at(v, cuts).collect()}
    assert got == {(1, i) for i in range(3)} | {(2, i) for i in range(2, 5)} | {(3, i) for i in range(5)}


def test_release_names_skip_what_is_taken(spark):
    d = "2026-10-24"
    versions = spark.createDataFrame([("a", d), ("b", d), ("c", d), ("k", d), ("z", "2026-01-01")], "version string, date string")
    given = spark.createDataFrame([("x", d), ("y", f"{d}-3"), ("k", f"{d}-9"), ("k", f"{d}-8")], "version string, name string")
    got = {r["version"]: r["name"] for r in conflate.release_names(versions, given).collect()}
    assert got == {"a": f"{d}-2", "b": f"{d}-4", "c": f"{d}-5", "k": f"{d}-8", "z": "2026-01-01"}


def test_rules_and_anchors(spark):
    rows = spark.createDataFrame([(1, ["trail"], []), (2, ["hall"], []), (3, ["pond"], [("Rules", "https://r")])], "id long, categories array<string>, links array<struct<label:string,href:string>>")
    swaps = spark.createDataFrame([(3, "no boats", "boats allowed")], "id long, rule string, instead string")
    got = {r["id"]: (r["rules"], len(r["links"])) for r in places.ruled(rows, ["trail", "pond"], ["no fires", "no boats"], swaps, ("Rules", "https://r")).collect()}
    assert got == {1: (["no fires", "no boats"], 1), 2: ([], 0), 3: (["no fires", "boats allowed"], 1)}
    at = places.anchored(spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "id long, x double, y double"), spark.createDataFrame([(1, 5.0, 6.0, 1), (1, 7.0, 8.0, 2)], "id long, x double, y double, pos int"))
    assert {tuple(r) for r in at.collect()} == {(1, 7.0, 8.0), (2, 1.0, 1.0)}


def test_ids_taken_twice_are_refused(spark):
    a = spark.createDataFrame([(1,), (2,)], "id long")
    assert places.united([a, spark.createDataFrame([(3,)], "id long")]).count() == 3
    with pytest.raises(Exception, match="taken twice"):
        places.united([a, a.where("id = 2")]).collect()


def test_graph_faults(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0, 0.0), (8, 0.5, 9.0), (9, 0.5, 0.5)], "id long, x double, y double")
    edges = spark.createDataFrame([(1, 2, "path"), (2, 3, "path"), (3, 3, "path"), (8, 9, "road"), (1, 77, "path")], "a long, b long, type string")
    doors = spark.createDataFrame([(100, 1), (101, 55)], "place long, node long")
    got = sorted(tuple(r) for r in checks.graph_faults(nodes, edges, doors, ["path"], (0.0, 0.0, 3.0, 3.0)).collect())
    assert got == sorted([("out of bounds", "8"), ("apart", "8"), ("apart", "9"), ("loop", "3-3"), ("dangling", "77"), ("unknown type", "8-9"), ("entrance without a node", "55")])


def test_rounding_as_python_has_it(spark):
    import random

    from cairnfield.functions.geo import rounded_each, with_rounded

    draw = random.Random(6)
    ties = [(k + 0.5) / 2**j for k in range(40) for j in range(10)] + [44.37519625, -93.1234567500001, 0.00000005, -0.00000015, 1e300, -1e8, 99999999.99999996, 0.0]
    values = ties + [draw.uniform(-180, 180) for _ in range(4000)] + [(draw.randrange(-(10**9), 10**9) * 10 + 5) / 1e8 for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (7, 2, 0):
        got = with_rounded(df, {"r": F.col("v")}, places).select("v", "r", rounded_each(F.array("v"), places)[0].alias("e")).collect()
        assert [(r["r"], r["e"]) for r in got] == [(round(r["v"], places),) * 2 for r in got]
