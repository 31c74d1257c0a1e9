"""The chain from features to places: what each step adds, and that their order matters."""

import pytest
from pyspark.sql import functions as F

from cairnfield.operators import checks, places

FEATURE = "slug string, pos long, name string, x double, y double, categories array<string>, links array<struct<label:string,href:string>>"
SQUARE = [(-93.0, 44.0), (-92.999, 44.0), (-92.999, 44.001), (-93.0, 44.001), (-93.0, 44.0)]
FAR = [(x + 1, y) for x, y in SQUARE]


def frames(spark):
    link = [("plan", "/hall")]
    features = [("racks", 1, "Alpha", -92.9995, 44.0005, ["rack"], []), ("racks", 2, "Alpha", -92.9994, 44.0005, ["rack"], link), ("halls", 3, "Alpha", -92.9993, 44.0005, ["hall"], []), ("racks", 4, " ", -92.9993, 44.0005, [], []), ("racks", 5, "Old", -92.9993, 44.0005, [], []), ("racks", 6, "Beta", -92.9992, 44.0005, ["trail"], [])]
    edges = [(fid, owner, 0, *a, *b) for fid, owner, ring in ((10, "Hall", SQUARE), (20, "Barn", FAR)) for a, b in zip(ring, ring[1:], strict=False)]
    made = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "features": made(features, FEATURE),
        "superseded": made([("racks", "Old")], "slug string, name string"),
        "areas": made(edges, "fid long, owner string, ring int, x0 double, y0 double, x1 double, y1 double"),
        "reach_m": 25.0,
        "prefix": "rack",
        "removed": made([("rackgamma",)], "id string"),
        "patches": made([("rackbeta", "name", "Beta Prime", 1)], "id string, field string, value string, pos int"),
        "anchors": made([("rackbeta", -91.9995, 44.0005, 1)], "id string, x double, y double, pos int"),
        "additions": made([("new", "New", -93.5, 44.5, ["rack"], [])], "id string, name string, x double, y double, categories array<string>, links array<struct<label:string,href:string>>"),
        "rules": {"categories": ["trail"], "shared": ["no fires"], "swaps": made([], "id string, rule string, instead string"), "link": ("Rules", "/rules")},
    }


def ids(df):
    return {r["id"]: r for r in df.collect()}


def test_every_step(spark):
    f = frames(spark)
    pieces = spark.createDataFrame([("Loop", 0, 0, i + 2, -92.9995 + i * 1e-4, 44.0005) for i in range(5)], "trail string, nth int, part int, seq int, x double, y double")
    parts = spark.createDataFrame([("part", "Upper Loop", -92.9, 44.9, ["trail"], [])], f["additions"].schema)
    got = ids(places.built(**f, trails=places.trail_features(pieces, "trails", ["trail"]), pinned=spark.createDataFrame([("halls", "Alpha", "alpha-hall"), ("barns", "Alpha", "other")], "slug string, name string, id string"), parts=parts, parents=spark.createDataFrame([("rackalpha-1", 20)], "id string, parent long"), walks=(spark.createDataFrame([("rackbeta", "guide"), ("part", "short"), ("alpha-hall", "none")], "target string, value string"), "trail"), floors=spark.createDataFrame([("/hall", ["first", "attic"])], "href string, floors array<string>")))
    # names that are shared are numbered over all layers, a pinned id is kept in its layer alone
    assert set(got) == {"rackalpha-1", "rackalpha-2", "alpha-hall", "rackbeta", "rackloop", "part", "new"}
    assert got["rackalpha-1"]["parent"] == 20 and got["rackalpha-1"]["name"] == "Alpha, Barn"
    assert got["rackalpha-2"]["floors"] == ["first", "attic"] and got["rackalpha-2"]["name"] == "Alpha, Hall"
    assert got["rackbeta"]["name"] == "Beta Prime, Hall" and got["rackbeta"]["walk"] == "guide" and got["rackbeta"]["rules"] == ["no fires"]
    assert got["part"]["walk"] == "short" and got["alpha-hall"]["walk"] is None and got["new"]["parent"] is None
    assert got["rackloop"]["x"] == pytest.approx(-92.9993) and got["rackloop"]["name"] == "Loop, Hall"


def test_parents_come_before_anchors_are_moved(spark):
    """With the two steps the other way round the place would belong to another area."""
    f = frames(spark)
    assert ids(places.built(**f))["rackbeta"]["parent"] == 10
    moved = f["features"].withColumn("x", F.when(F.col("name") == "Beta", -91.9995).otherwise(F.col("x")))
    assert ids(places.built(**{**f, "features": moved}))["rackbeta"]["parent"] == 20


def test_ids_come_before_names_are_patched(spark):
    f = frames(spark)
    late = f["features"].withColumn("name", F.when(F.col("name") == "Beta", "Beta Prime").otherwise(F.col("name")))
    assert "rackbeta" in ids(places.built(**f)) and "rackbeta" not in ids(places.built(**{**f, "features": late}))


def test_an_id_taken_twice_is_an_error(spark):
    f = frames(spark)
    with pytest.raises(Exception, match="id rackbeta is taken twice"):
        places.built(**f, parts=spark.createDataFrame([("rackbeta", "X", 0.0, 0.0, [], [])], f["additions"].schema)).collect()


def test_faults_stop_the_write(spark):
    f = frames(spark)
    made = lambda rows, schema: spark.createDataFrame(rows, schema)
    pinned = made([("halls", "Alpha", "alpha-hall"), ("halls", "Gone", "g"), ("racks", "Beta", "g")], "slug string, name string, id string")
    parents = made([("rackalpha-1", "10"), ("nobody", "10"), ("rackold", "rackold")], "id string, parent string")
    areas = f["areas"].withColumn("fid", F.col("fid").cast("string"))
    found = places.chain_faults(f["features"], areas, "rack", f["removed"], f["patches"], parents, pinned, places=places.built(**f), walks=(made([("rackalpha-1", "x"), ("none", "y")], "target string, value string"), "trail"))
    assert {tuple(r) for r in found.collect()} == {("removal of an unknown id", "rackgamma"), ("patch of an unknown id", "rackbeta"), ("parent of an unknown id", "nobody"), ("unknown parent", "rackold"), ("its own parent", "rackold"), ("pinned name not in its layer", "g"), ("id pinned twice", "g"), ("wrong category", "rackalpha-1"), ("missing target", "none")}
    with pytest.raises(ValueError, match="rackgamma"):
        checks.require(found.where("key = 'rackgamma'"))


def test_built_places_hold_every_trail(spark):
    """trails were built from every fortieth order only."""
    from cairnfield.plans import catalog
    from tests.conftest import DATA

    got = catalog.queries()["built_places"](spark, f"{DATA}/sf0.001").where("id like 'customertrail%'").count()
    assert got == catalog.queries()["trail_pieces"](spark, f"{DATA}/sf0.001").select("trail").distinct().count()


def test_built_places_of_names_that_repeat(spark, tmp_path):
    """copies of a customer took one pinned id, and their swaps one key."""
    from cairnfield.plans import catalog
    from tests.conftest import DATA

    for name in ("supplier", "orders", "lineitem", "nation"):
        spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet").where("true" if name != "lineitem" else "l_orderkey < 40").write.parquet(f"{tmp_path}/{name}.parquet")
    customer = spark.read.parquet(f"{DATA}/sf0.001/customer.parquet")
    more = customer.withColumn("c_custkey", F.col("c_custkey") + 100_001)
    customer.unionByName(more).write.parquet(f"{tmp_path}/customer.parquet")
    got = [r["id"] for r in catalog.queries()["built_places"](spark, str(tmp_path)).where("id like 'pin%'").select("id").collect()]
    want = customer.unionByName(more).where("c_nationkey = 11 and c_custkey % 6 <> 0 and c_acctbal >= -900")
    assert sorted(got) == sorted(f"pin{r[0]}" for r in want.select("c_custkey").collect())
