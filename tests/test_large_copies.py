"""What larger copies of the tables bring: ids that a version has twice, shapes that two lines share."""

import pytest

from tests.conftest import DATA, same


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with parts whose new id another part has already, of another name and brand."""
    out = tmp_path_factory.mktemp("copies")
    part = spark.read.parquet(f"{DATA}/sf0.001/part.parquet")
    more = part.where("p_partkey % 13 = 0").selectExpr("p_partkey + 1000000 AS p_partkey", "'zz ' || p_name AS p_name", "'Brand#99' AS p_brand", "p_type", "p_size", "p_retailprice")
    part.unionByName(more).write.parquet(f"{out}/part.parquet")
    return str(out)


@pytest.fixture(scope="module")
def copies(folder):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet/*.parquet'")
    return c


def test_change_order_of_an_id_added_twice(spark, folder, copies):
    from cairnfield.plans.changes import QUERIES, SQL

    same(QUERIES["change_order"](spark, folder), copies, SQL["change_order"])


def test_change_summary_of_an_id_added_twice(spark, folder, copies):
    from cairnfield.plans.changes import QUERIES, SQL

    same(QUERIES["change_summary"](spark, folder), copies, SQL["change_summary"])


def test_lines_anti_of_lines_that_take_the_same_way(spark, tmp_path):
    import duckdb

    from cairnfield.plans.quality import QUERIES, SQL

    line = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet").where("l_orderkey = 3")
    far = line.selectExpr("l_orderkey + 5998999 AS l_orderkey", *[c for c in line.columns if c != "l_orderkey"])
    line.unionByName(far).write.parquet(f"{tmp_path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert c.execute(SQL["lines_anti"]).fetchall() == [(5999002,)]
    same(QUERIES["lines_anti"](spark, str(tmp_path)), c, SQL["lines_anti"])


def test_change_summary_of_missing_names(spark, tmp_path):
    import duckdb

    from cairnfield.plans.changes import QUERIES, SQL

    part = spark.read.parquet(f"{DATA}/sf0.001/part.parquet")
    lost = "CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS p_name"
    part.selectExpr(lost, *[c for c in part.columns if c != "p_name"]).write.parquet(f"{tmp_path}/part.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    same(QUERIES["change_summary"](spark, str(tmp_path)), c, SQL["change_summary"])


def test_words_are_counted_in_parts_that_follow_the_text(spark, duck, monkeypatch):
    from cairnfield.operators import diff
    from cairnfield.plans.changes import QUERIES, SQL

    monkeypatch.setattr(diff, "CHARS_A_TASK", 1000)
    got = QUERIES["word_bag_diff"](spark, f"{DATA}/sf0.001")
    chars = spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet").selectExpr("sum(length(text))").first()[0]
    assert got.rdd.getNumPartitions() == -(-chars // 1000) > 4
    # words themselves are never shuffled
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    same(got, duck, SQL["word_bag_diff"])


def test_short_lines_are_simplified_in_one_row(spark, monkeypatch):
    from cairnfield.operators import measures
    from cairnfield.sources import views

    v = views.line_vertices(spark, f"{DATA}/sf0.001").where("line % 5 = 0")
    kept = lambda: {(r["line"], r["seq"]) for r in measures.simplified(v, ["line"], 0.00008).collect()}
    short = kept()
    monkeypatch.setattr(measures, "FEW_VERTICES", 3)
    assert kept() == short
    monkeypatch.setattr(measures, "_simplified_many", None)
    monkeypatch.setattr(measures, "FEW_VERTICES", 64)
    assert kept() == short


def test_arrays_are_rounded_in_few_passes(spark):
    from pyspark.sql import functions as F

    from cairnfield.functions import geo

    odd = [0.0, -0.0, 1e-7, 5e-8, 1.5e-7, 2.5e-7, -93.12345675, 44.98765435, 123.00000005, 1e8, 1e300, float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in odd], "c double")
    both = geo.with_rounded(rows, {"one": F.col("c")}).select("one", F.get(geo.rounded_each(F.array("c")), 0).alias("each"))
    assert both.where("not (one <=> each)").count() == 0
    plan = rows.select(geo.rounded_each(F.array("c")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("transform(") <= 8


def test_places_of_large_keys(spark):
    """The square of a key times 104729 was more than a long holds."""
    from pyspark.sql import functions as F

    from cairnfield.sources import views

    keys = [0, 1, 7, 1998, 1999, -5, -1999, 9_384_000, 54_000_000, 10**12 + 3]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: (r["x"], r["y"]) for r in rows.select("k", views.place_x(F.col("k")).alias("x"), views.place_y(F.col("k")).alias("y")).collect()}
    remainder = lambda n, m: n % m if n >= 0 else -(-n % m)
    assert got == {k: (-93.35 + remainder(k * 7919, 3001) / 1e4, 44.35 + remainder(k * k * 104729 + k * 31, 1999) / 1e4) for k in keys}


def test_lines_of_large_keys(spark, tmp_path):
    from cairnfield.plans.catalog import queries

    line = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet").where("l_orderkey < 40")
    # a multiple of both periods of the places, so boxes lie as before
    line.selectExpr("l_orderkey + 5998999 * 9 AS l_orderkey", *[c for c in line.columns if c != "l_orderkey"]).write.parquet(f"{tmp_path}/far/lineitem.parquet")
    line.write.parquet(f"{tmp_path}/near/lineitem.parquet")
    for name in ("bbox", "off_runs"):
        near, far = (queries()[name](spark, f"{tmp_path}/{d}").drop("line").collect() for d in ("near", "far"))
        assert len(near) > 0 and (name != "bbox" or sorted(near) == sorted(far))
