"""Trails from named segments: parts, cuts, and lists that have gone stale."""

import pytest
from pyspark.sql import functions as F

from cairnfield.operators import graph, trails

NORTH = [(-93.18, 44.460), (-93.18, 44.461)]
LONG = [(-93.18, 44.461), (-93.18, 44.462), (-93.18, 44.463)]
MILE = 1609.344
WANTED = "trail string, nth int, fid long, part int, side string, x double, y double"


def layer(spark, features):
    """features: (fid, parts)."""
    rows = [(n, fid, p, i, x, y) for n, (fid, parts) in enumerate(features) for p, line in enumerate(parts) for i, (x, y) in enumerate(line)]
    return spark.createDataFrame(rows, "row int, fid long, part int, seq int, x double, y double")


def wants(spark, *rows):
    return spark.createDataFrame([(*r, *(None,) * (7 - len(r))) for r in rows], WANTED)


def lines(df):
    out = {}
    for r in df.orderBy("trail", "nth", "part", "seq").collect():
        out.setdefault((r["trail"], r["nth"], r["part"]), []).append((r["x"], r["y"]))
    return out


def faults(spark, features, *rows):
    return {(r["trail"], r["fid"]): r["why"] for r in trails.trail_faults(layer(spark, features), wants(spark, *rows)).collect()}


def test_segments_in_the_order_of_the_list(spark):
    got = lines(trails.trail_pieces(layer(spark, [(2, [LONG]), (1, [NORTH])]), wants(spark, ("robin", 0, 1), ("robin", 1, 2))))
    assert got == {("robin", 0, 0): NORTH, ("robin", 1, 0): LONG}


def test_a_cut_gives_each_trail_its_side_of_a_shared_vertex(spark):
    source = layer(spark, [(1, [NORTH]), (2, [LONG])])
    got = lines(trails.trail_pieces(source, wants(spark, ("woods", 0, 1), ("woods", 1, 2, None, "until", -93.18002, 44.46201), ("oak", 0, 2, None, "from", -93.18, 44.462))))
    assert got == {("woods", 0, 0): NORTH, ("woods", 1, 0): LONG[:2], ("oak", 0, 0): LONG[1:]}


def test_of_equally_near_vertices_the_first_is_cut(spark):
    loop = [(-93.18, 44.46), (-93.18, 44.461), (-93.18, 44.46)]
    assert lines(trails.trail_pieces(layer(spark, [(1, [loop])]), wants(spark, ("a", 0, 1, None, "until", -93.18, 44.46)))) == {("a", 0, 0): loop[:1]}


def test_parts(spark):
    source = layer(spark, [(4, [NORTH, LONG])])
    assert lines(trails.trail_pieces(source, wants(spark, ("a", 0, 4)))) == {("a", 0, 0): NORTH, ("a", 0, 1): LONG}
    assert lines(trails.trail_pieces(source, wants(spark, ("a", 0, 4, 1)))) == {("a", 0, 1): LONG}
    assert lines(trails.trail_pieces(source, wants(spark, ("a", 0, 4, 1, "from", -93.18, 44.462)))) == {("a", 0, 1): LONG[1:]}


def test_stale_lists_are_told_apart(spark):
    features = [(1, [NORTH]), (2, [LONG]), (3, [NORTH]), (3, [LONG]), (4, [NORTH, LONG])]
    got = faults(spark, features, ("a", 0, 9), ("b", 0, 3), ("c", 0, 4, 2), ("d", 0, 4, -1), ("e", 0, 4, None, "until", -93.18, 44.462), ("f", 0, 2, None, "from", -93.1805, 44.462), ("g", 0, 1), ("h", 0, 2, 0, "from", -93.18, 44.462), ("i", 0, 2, None, "from", None, None))
    assert got == {("a", 9): "not in the layer", ("b", 3): "in the layer twice", ("c", 4): "no such part", ("d", 4): "no such part", ("e", 4): "cut in a segment of several parts", ("f", 2): "no vertex near its cut", ("i", 2): "no vertex near its cut"}
    # what is at fault gives no vertices
    assert lines(trails.trail_pieces(layer(spark, features), wants(spark, ("a", 0, 9), ("b", 0, 3), ("f", 0, 2, None, "from", -93.1805, 44.462)))) == {}


def checked(spark, features, rows, miles):
    pieces, found = trails.checked_trails(layer(spark, features), wants(spark, *rows), spark.createDataFrame([(t, m * MILE) for t, m in miles.items()], "trail string, wanted_m double"))
    return pieces, {tuple(r) for r in found.collect()}


def test_whole_trails_of_the_stated_length_have_no_fault(spark):
    _, found = checked(spark, [(1, [NORTH]), (2, [LONG])], [("robin", 0, 1), ("robin", 1, 2)], {"robin": 0.21})
    assert found == set()


def test_a_trail_may_join_at_a_t_but_not_fall_apart(spark):
    side = [(-93.1799, 44.462), (-93.179, 44.462)]
    near = [(-93.18003, 44.4615), (-93.181, 44.4615)]  # meets LONG between two vertices, 2.4 m away
    _, found = checked(spark, [(2, [LONG]), (5, [side]), (6, [near])], [("t", 0, 2), ("t", 1, 6), ("apart", 0, 2), ("apart", 1, 5)], {"t": 0.186, "apart": 0.183})
    assert found == {("in several parts", "apart")}


def test_a_length_that_moved_and_a_trail_without_pieces(spark):
    _, found = checked(spark, [(1, [NORTH])], [("robin", 0, 1), ("gone", 0, 8)], {"robin": 0.5, "gone": 0.1})
    assert found == {("wrong length", "robin"), ("not in the layer", "gone: 8"), ("without pieces", "gone")}


def test_no_trails_listed_builds_none(spark):
    pieces, found = checked(spark, [(1, [NORTH])], [], {"x": 1.0})
    assert pieces.collect() == [] and found == set()


def test_a_cut_out_of_reach_is_refused(spark):
    v = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate(LONG)], "line int, seq int, x double, y double")
    far = spark.createDataFrame([(1, -92.0, 44.0, "before")], "line int, x double, y double, side string")
    with pytest.raises(Exception, match="line 1 has no vertex near its cut"):
        graph.cut_at(v, far).collect()
    near = far.withColumns({"x": F.lit(-93.18), "y": F.lit(44.462)})
    assert [r["seq"] for r in graph.cut_at(v, near).orderBy("seq").collect()] == [0, 1]
