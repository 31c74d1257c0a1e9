"""Layer files: feature collections in, canonical tables and files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Properties that change from one fetch to the next without the feature changing.
VOLATILE = ("OBJECTID", "OBJECTID_1", "FID", "GlobalID", "Shape__Area", "Shape__Length", "Shape_Area", "Shape_Leng", "Shape_Le_1", "SHAPE_Leng", "SHAPE_Area")

_COLLECTION = "name string, features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:variant,geometries:variant>>>"
_FEATURE = "properties map<string,string>, geometry struct<type:string,coordinates:variant,geometries:variant>"


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """One row per feature of a feature collection: _layer, pos, props, kind, coordinates, geometries (variants). A layer without features gives no rows."""
    docs = spark.read.text(path, wholetext=True).select(F.from_json("value", _COLLECTION).alias("d"))
    rows = docs.select(F.posexplode("d.features").alias("pos", "f"))
    return rows.select(F.lit(layer).alias("_layer"), F.col("pos").cast("long").alias("pos"), F.col("f.properties").alias("props"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.geometry.geometries").alias("geometries"))


def read_feature_lines(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """The same from a file with one feature a line, which tasks can share."""
    rows = spark.read.text(path).where("trim(value) <> ''").select(F.from_json("value", _FEATURE).alias("f"), F.monotonically_increasing_id().alias("pos"))
    return rows.select(F.lit(layer).alias("_layer"), "pos", F.col("f.properties").alias("props"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.geometry.geometries").alias("geometries"))


def vertices(features: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part, ring, seq, x, y of every position. Points are parts of one position, lines have ring 0.

    Members of a collection (column geometries, if there is one) follow each other as parts, those of collections inside it too.
    """
    if "geometries" in features.columns:
        flat = _members(features.select(*keys, "kind", "coordinates", "geometries"))
        rows = vertices(flat.drop("geometries"), [*keys, "shape"])
        part = F.dense_rank().over(Window.partitionBy(*keys).orderBy("shape", "part")) - 1
        return rows.withColumn("part", part).select(*keys, "part", "ring", "seq", "x", "y")
    depth = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
    json = F.to_json("coordinates")
    deep = F.from_json(json, "array<array<array<array<double>>>>")
    rings = F.from_json(json, "array<array<array<double>>>")
    line = F.from_json(json, "array<array<double>>")
    point = F.from_json(json, "array<double>")
    # every kind as parts of rings of positions
    shaped = (
        F.when(F.col("kind") == "MultiPolygon", deep)
        .when(F.col("kind") == "Polygon", F.array(rings))
        .when(F.col("kind") == "MultiLineString", F.transform(rings, lambda r: F.array(r)))
        .when(F.col("kind") == "LineString", F.array(F.array(line)))
        .when(F.col("kind") == "MultiPoint", F.transform(line, lambda p: F.array(F.array(p))))
        .when(F.col("kind") == "Point", F.array(F.array(F.array(point))))
    )
    rows = features.where(F.col("kind").isin(list(depth))).select(*keys, F.posexplode(shaped).alias("part", "rings"))
    rows = rows.select(*keys, "part", F.posexplode("rings").alias("ring", "positions")).select(*keys, "part", "ring", F.posexplode("positions").alias("seq", "p"))
    return rows.select(*keys, "part", "ring", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def _members(features: DataFrame, deep: int = 8) -> DataFrame:
    """features with shape, a text that orders the members of collections: one row for each member that is no collection. More than `deep` levels are an error."""
    kind = "array<struct<type:string,coordinates:variant,geometries:variant>>"
    rest = features.withColumn("shape", F.lit(""))
    out = rest.where("kind <> 'GeometryCollection'")
    for _ in range(deep):
        nested = rest.where("kind = 'GeometryCollection'").withColumn("members", F.from_json(F.to_json("geometries"), kind))
        kept = [c for c in rest.columns if c not in ("kind", "coordinates", "geometries", "shape")]
        rest = nested.select(*kept, "shape", F.posexplode("members").alias("at", "m")).select(*kept, F.col("m.type").alias("kind"), F.col("m.coordinates").alias("coordinates"), F.col("m.geometries").alias("geometries"), F.concat("shape", F.lpad(F.col("at").cast("string"), 9, "0")).alias("shape"))
        out = out.unionByName(rest.where("kind <> 'GeometryCollection'"))
    deeper = rest.where("kind = 'GeometryCollection'").withColumn("shape", F.raise_error(F.lit("collections are nested too deep")).cast("string"))
    return out.unionByName(deeper)


def without_volatile(props: Column, also: tuple[str, ...] = ()) -> Column:
    """A property map less what changes from fetch to fetch."""
    return F.map_filter(props, lambda k, _: ~k.isin([*VOLATILE, *also]))


def declared(features: DataFrame, fields: list[str]) -> DataFrame:
    """features with exactly the declared properties as columns. A property that no row even mentions is an error; a null is not."""
    known = {r[0] for r in features.select(F.explode(F.map_keys("props"))).distinct().collect()}  # names of properties, not rows
    missing = [f for f in fields if f not in known]
    if missing:
        raise ValueError(f"missing properties: {', '.join(missing)}")
    rest = [c for c in features.columns if c != "props"]
    return features.select(*rest, *[F.try_element_at("props", F.lit(f)).alias(f) for f in fields])


def lookup(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) of a file that holds one object; `value` is the type of its values."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{value}>"))).toDF("key", "value")


def swapped(position: Column) -> Column:
    """[x, y] as [y, x]."""
    return F.array(position[1], position[0])


def shape_of(kinds: Column) -> Column:
    """Index of a place's shape among its geometries: the first that isn't a point, else the first."""
    at = F.array_position(F.transform(kinds, lambda k: k != "Point"), F.lit(True))
    return F.when(F.size(kinds) == 0, F.lit(None)).when(at > 0, at - 1).otherwise(F.lit(0)).cast("int")


def moved_geometry(moved: Column, after: Column, before: Column) -> Column:
    """What a change shows: the moved stretches, else the new shape, else the old one."""
    return F.coalesce(moved, after, before)


def titles(sources: DataFrame) -> DataFrame:
    """(slug, title): of several sources of a slug the first gives the title. Columns slug, title, pos."""
    return sources.groupBy("slug").agg(F.min_by("title", "pos").alias("title"))


def write_canonical(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines with the columns in the order of df and rows in the order given: the same table gives the same bytes."""
    keys = F.struct(*order)
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"), keys.alias("_k")).repartitionByRange("_k").sortWithinPartitions("_k", "value")
    rows.select("value").write.mode("overwrite").text(path)


def write_layers(df: DataFrame, path: str, layer: str, order: list[str]) -> None:
    """One folder for each layer, rows in order within each file."""
    df.repartitionByRange(layer, *order).sortWithinPartitions(layer, *order).write.mode("overwrite").partitionBy(layer).parquet(path)
