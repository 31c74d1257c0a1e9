"""Checks that pass and fail, and connectors on a small net."""

import heapq
import math
import random

from cairnfield.functions import geo
from cairnfield.operators import checks, connect

PLACES = [("a", "Hall", ["building"]), ("b", "Loop", ["trail"]), ("c", "Lot", None)]


def keys(df):
    return sorted((r["check_name"], r["key"]) for r in df.collect())


def test_tags(spark):
    rows = spark.createDataFrame(PLACES, "id string, name string, categories array<string>")
    tags = spark.createDataFrame([("Loop", "x"), ("a", "y"), ("gone", "z")], "target string, value string")
    assert sorted((r["id"], r["value"]) for r in checks.tagged(rows, tags, "trail").collect()) == [("a", None), ("b", "x"), ("c", None)]
    assert keys(checks.untagged(rows, tags, "trail")) == [("missing target", "gone"), ("wrong category", "a")]


def test_parents_and_pairs(spark):
    spots = spark.createDataFrame([("s", "Rack, Hall (east)", "a"), ("t", "Rack", "a"), ("u", "Rack", "q"), ("v", "West of Rack, Hall", "a"), ("w", None, "a")], "id string, name string, parent string")
    assert keys(checks.parent_names(spots, spark.createDataFrame(PLACES, "id string, name string, categories array<string>"), "Rack")) == [("no parent", "u"), ("not named for its parent", "t"), ("not named for its parent", "v"), ("not named for its parent", "w")]
    walks = spark.createDataFrame([("a", ["trail"], None), ("b", ["trail"], "w"), ("c", ["lot"], "w")], "id string, categories array<string>, walk string")
    assert keys(checks.only_if(walks, "walk", "trail")) == [("trail without walk", "a"), ("walk without trail", "c")]
    links = spark.createDataFrame([("a", "g"), ("a", "g"), ("b", "g"), ("c", "h")], "id string, link string")
    assert keys(checks.once_each(links, "id", "link", "g")) == [("g: not once", "a"), ("g: not once", "c")]
    lines = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v int")
    assert keys(checks.same_values(lines, spark.createDataFrame([(1,)], "v int"), ["v"], ["c"], "id")) == [("differs from its source", "b")]


def test_connectors(spark):
    """Two houses on one lane: the second ends on the way of the first."""
    step = 0.0004  # about 44 m
    vertices = spark.createDataFrame([(i, -93.0, 44.0 + i * step) for i in range(12)], "id long, x double, y double")
    edges = spark.createDataFrame([(i, i + 1, 45.0) for i in range(11)], "a long, b long, cost double")
    nodes = spark.createDataFrame([(1, -93.0, 44.0)], "id long, x double, y double")
    houses = spark.createDataFrame([(1, -93.0001, 44.0 + 5 * step), (2, -93.0001, 44.0 + 9 * step), (3, -93.0001, 44.0), (4, -93.0, 45.0)], "id long, x double, y double")
    got = connect.connectors(houses, nodes, vertices, edges, 45.0, 25.0, 600.0).orderBy("anchor", "step").collect()
    ways = {}
    for r in got:
        ways.setdefault(r["anchor"], []).append(r["vertex"])
    assert ways == {1: [5, 4, 3, 2, 1, 0], 2: [9, 8, 7, 6, 5], 4: [11, 10, 9]}
    none = connect.connectors(houses.where("id < 0"), nodes, vertices, edges, 45.0, 25.0, 600.0)
    assert none.count() == 0
    assert connect.connectors(houses.where("id < 4"), nodes.where("id < 0"), vertices, edges, 45.0, 25.0, 600.0).count() == 0


def one_by_one(houses, nodes, vertices, edges, gap_m, stitch_m, limit):
    """Ways of connectors() by a plain search for each house in turn."""
    def away(p, q):
        return math.hypot((q[0] - p[0]) * geo.LON_M * math.cos(math.radians(p[1])), (q[1] - p[1]) * geo.LAT_M)

    net, ways, beside = list(nodes.values()), {}, {}
    for a, b, w in edges:
        beside.setdefault(a, []).append((b, w))
        beside.setdefault(b, []).append((a, w))
    for k, at in sorted(houses.items()):
        if min(away(at, n) for n in net) <= gap_m:
            continue
        cost = {v: 0.0 for v, p in vertices.items() if any(away(p, n) <= stitch_m for n in net)}
        heap, turn = [(0.0, v) for v in cost], {}
        while heap:
            c, v = heapq.heappop(heap)
            if c > cost[v]:
                continue
            for b, w in beside.get(v, []):
                if c + w <= limit and (b not in cost or (c + w, v) < (cost[b], turn.get(b, -1))):
                    if b not in cost or c + w < cost[b]:
                        heapq.heappush(heap, (c + w, b))
                    cost[b], turn[b] = c + w, v
        v = min(vertices, key=lambda v: (away(at, vertices[v]), v))
        if v in cost:
            ways[k] = [v]
            while v in turn:
                v = turn[v]
                ways[k].append(v)
            net += [vertices[v] for v in ways[k]]
    return ways


def test_connectors_as_one_by_one(spark):
    """Many houses in one another's reach on a grid with gaps, in bulk and in turn."""
    draw = random.Random(3)
    vertices = {i: (-93.0 + i % 14 * 0.0005, 44.0 + i // 14 * 0.0004) for i in range(140) if draw.random() < 0.93}
    edges = [(i, j, 45.0 + draw.randrange(30)) for i in vertices for j in ((i + 1) if i % 14 < 13 else -1, i + 14) if j in vertices]
    nodes = {n: vertices[v] for n, v in enumerate(draw.sample(sorted(vertices), 5))}
    houses = {h: (-93.0 + draw.random() * 0.007, 44.0 + draw.random() * 0.004) for h in draw.sample(range(1000), 12)}
    rows = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()], "id long, x double, y double")
    got = connect.connectors(rows(houses), rows(nodes), rows(vertices), spark.createDataFrame(edges, "a long, b long, cost double"), 45.0, 25.0, 200.0).orderBy("anchor", "step").collect()
    ways = {}
    for r in got:
        ways.setdefault(r["anchor"], []).append(r["vertex"])
    assert ways == one_by_one(houses, nodes, vertices, edges, 45.0, 25.0, 200.0)
    assert len(ways) > 4 and 0 < max(r["round"] for r in got)


def test_connectors_whose_ways_cannot_meet_settle_at_once(spark):
    from cairnfield.operators import connect

    # three streets side by side, closer than their ways are long, with nothing between them
    spots = [(10 * k + i, -93.0 + 0.001 * i, 44.0 + 0.001 * k) for k in range(3) for i in range(4)]
    vertices = spark.createDataFrame(spots, "id long, x double, y double")
    edges = spark.createDataFrame([(10 * k + i, 10 * k + i + 1, 80.0) for k in range(3) for i in range(3)], "a long, b long, cost double")
    houses = vertices.where("id % 10 = 3").selectExpr("id", "x", "y + 0.0001 AS y")
    got = connect.connectors(houses, vertices.where("id % 10 = 0"), vertices, edges, 45.0, 25.0, 300.0).collect()
    assert {(r["anchor"], r["vertex"]) for r in got} == {(10 * k + 3, 10 * k + i) for k in range(3) for i in range(4)}
    assert {r["round"] for r in got} == {0}
