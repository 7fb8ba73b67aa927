"""Rasters and listings derived from the driver's tables.

Each fixture has a DataFrame form (used by the Spark queries) and the SQL text
it is defined by (used as a CTE by the DuckDB oracles).  The SQL is the
specification; the DataFrame code computes the same thing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# Grid parameters of the derived rasters.
TILE = 32          # pixels per tile side
DEM_ZOOM = 6       # zoom of the dem grid (128 cells wide = 4 tiles)
DEM_WIDTH = 128
SCENE_ZOOM = 10    # zoom of the scenes grid
NODATA = -3.4028234663852886e38   # float32 minimum, the datasets' nodata


def sites(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(
        c.alias("id"),
        ((c * 7919) % 36000).cast("double") / 100 - 180 + 3e-3,
        ((c * 104729) % 16000).cast("double") / 100 - 80 + 3e-3,
    ).toDF("id", "lon", "lat")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    west = ((s * 37) % 340).cast("double") - 170 + 3e-3
    south = ((s * 17) % 120).cast("double") - 60 + 3e-3
    return table(spark, d, "supplier").select(
        s.alias("id"), west.alias("west"), south.alias("south"),
        (west + 5e-1 * (1 + n % 5)).alias("east"), (south + 5e-1 * (1 + n % 3)).alias("north"))


def utm_points(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(
        c.alias("id"), (500500 + c * 7).cast("double").alias("easting"),
        (4200000 + c * 10).cast("double").alias("northing"))


def rasters(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    res = (1 + s % 3).cast("double")
    return table(spark, d, "supplier").select(
        s.alias("source_id"), s.alias("priority"), res.alias("a"),
        (500500 + 1500 * (s % 10)).cast("double").alias("c"), (-res).alias("e"),
        (4205000 - 1500 * F.floor(s / 10)).cast("double").alias("f"),
        F.lit(1500).alias("width"), F.lit(1500).alias("height"), F.lit(NODATA).alias("nodata"))


def dem(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        (k % 128).alias("gx"), F.floor(k / 128).cast("bigint").alias("gy"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("bigint"))
         .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("v"))


def dem_dense(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        (k % 128).alias("gx"), F.floor(k / 128).cast("bigint").alias("gy"),
        (F.col("o_totalprice") / 1000).alias("v"))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("gx"), F.col("l_suppkey").alias("gy"),
        F.col("l_linenumber").alias("priority"), F.col("l_orderkey").alias("tie"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("v"))


def scenes_wide(spark: SparkSession, d: str) -> DataFrame:
    """scenes_bands with a column per band: v1, v2, v3."""
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("gx"), F.col("l_suppkey").alias("gy"),
        F.col("l_linenumber").alias("priority"), F.col("l_orderkey").alias("tie"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("v1"), F.round(F.col("l_quantity")).cast("bigint").alias("v2"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("v3"))


SCENE_BANDS = {1: "v1", 2: "v2", 3: "v3"}


def scenes_bands(spark: SparkSession, d: str) -> DataFrame:
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"v{b}").alias("v")) for b in (1, 2, 3)])
    return scenes_wide(spark, d).select("gx", "gy", "priority", "tie", F.inline(bands))


def objects(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(F.concat(
        F.lit("s3://b/source/"), k.cast("string"),
        F.when(k % 10 == 0, F.lit(".txt")).otherwise(F.lit(".zip"))).alias("path"))


def done(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("s3://b/4326/"), F.col("l_orderkey").cast("string"), F.lit(".tif")).alias("path")
    ).distinct()


FIXTURES = {
    "sites": sites, "boxes": boxes, "utm_points": utm_points, "rasters": rasters, "dem": dem,
    "dem_dense": dem_dense, "scenes": scenes, "scenes_bands": scenes_bands, "objects": objects, "done": done,
}

# The defining SQL of each fixture (portable between Spark SQL and DuckDB).
FIXTURE_SQL = {
    "sites": """select c_custkey id, cast((c_custkey*7919)%36000 as double)/100 - 180 + 3e-3 lon,
       cast((c_custkey*104729)%16000 as double)/100 - 80 + 3e-3 lat
from customer""",
    "boxes": """select s_suppkey id, cast((s_suppkey*37)%340 as double) - 170 + 3e-3 west,
       cast((s_suppkey*17)%120 as double) - 60 + 3e-3 south,
       cast((s_suppkey*37)%340 as double) - 170 + 3e-3 + 5e-1*(1 + s_nationkey%5) east,
       cast((s_suppkey*17)%120 as double) - 60 + 3e-3 + 5e-1*(1 + s_nationkey%3) north
from supplier""",
    "utm_points": """select c_custkey id, cast(500500 + c_custkey*7 as double) easting, cast(4200000 + c_custkey*10 as double) northing
from customer""",
    "rasters": """select s_suppkey source_id, s_suppkey priority, cast(1 + s_suppkey%3 as double) a, cast(500500 + 1500*(s_suppkey%10) as double) c,
       -cast(1 + s_suppkey%3 as double) e, cast(4205000 - 1500*floor(s_suppkey/10) as double) f,
       1500 width, 1500 height, cast(-3.4028234663852886e38 as double) nodata
from supplier""",
    "dem": """select o_orderkey % 128 gx, cast(floor(o_orderkey/128) as bigint) gy,
       case when o_orderstatus = 'P' then null else cast(round(o_totalprice*100) as bigint) end v
from orders""",
    "dem_dense": """select o_orderkey % 128 gx, cast(floor(o_orderkey/128) as bigint) gy, o_totalprice/1000 v
from orders""",
    "scenes": """select l_partkey gx, l_suppkey gy, l_linenumber priority, l_orderkey tie, cast(round(l_extendedprice*100) as bigint) v
from lineitem""",
    "scenes_bands": """select l_partkey gx, l_suppkey gy, l_linenumber priority, l_orderkey tie, 1 band, cast(round(l_extendedprice*100) as bigint) v from lineitem
union all
select l_partkey, l_suppkey, l_linenumber, l_orderkey, 2, cast(round(l_quantity) as bigint) from lineitem
union all
select l_partkey, l_suppkey, l_linenumber, l_orderkey, 3, cast(round(l_discount*100) as bigint) from lineitem""",
    "objects": """select concat('s3://b/source/', cast(o_orderkey as string), case when o_orderkey%10 = 0 then '.txt' else '.zip' end) path
from orders""",
    "done": """select distinct concat('s3://b/4326/', cast(l_orderkey as string), '.tif') path from lineitem""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the fixtures it reads, as CTEs."""
    ctes = ",\n".join(f"{n} as (\n{FIXTURE_SQL[n]}\n)" for n in names)
    return f"with {ctes}\n{sql}"
