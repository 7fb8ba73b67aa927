"""Readers (S1, S6-S9, S12): tile lists, tile stores, listings, work lists, GeoJSON."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import blocks as B
from ..operators.pyramid import STORE_SCHEMA, tile_bucket


def read_tile_list(spark: SparkSession, path: str) -> DataFrame:
    """Text, one JSON array ``[x, y, z]`` per line -> distinct (z, x, y)."""
    arr = F.from_json(F.col("value"), T.ArrayType(T.LongType()))
    return (spark.read.text(path)
                 .where(F.trim(F.col("value")) != "")
                 .select(arr.alias("t"))
                 .select(F.col("t")[2].cast("int").alias("z"), F.col("t")[0].cast("int").alias("x"),
                         F.col("t")[1].cast("int").alias("y"))
                 .dropDuplicates())


def tile_list_lines(tiles: DataFrame) -> DataFrame:
    """(z, x, y) -> the ``[x,y,z]`` text lines a tile list holds."""
    return tiles.select(F.to_json(F.array(F.col("x").cast("bigint"), F.col("y").cast("bigint"),
                                          F.col("z").cast("bigint"))).alias("value"))


def read_tiles(spark: SparkSession, store: str, tiles: DataFrame | None = None, z: int | None = None,
               ignore_corrupt: bool = False) -> DataFrame:
    """Point reads of stored blocks; missing tiles give no row, all-nodata blocks are skipped.

    ``valid_count > 0`` and ``z = ...`` are pushed into the parquet scan.  A tile list also meets the store by
    its buckets (quadkey prefixes), so that Spark can prune folders by the listed ones.
    ``ignore_corrupt`` (F8) skips unreadable files instead of failing the job.
    """
    df = (spark.read.schema(STORE_SCHEMA).option("ignoreCorruptFiles", str(ignore_corrupt).lower())
          .parquet(store))
    if z is not None:
        df = df.where(F.col("z") == z)
    df = df.where(F.col("valid_count") > 0)
    if tiles is not None:
        keys = tiles.select(*[F.col(c).cast("int").alias(c) for c in ("z", "x", "y")]).withColumn("bucket", tile_bucket())
        df = df.join(keys, ["z", "bucket", "x", "y"], "left_semi")
    return df.select(*B.BLOCK_COLUMNS)


def read_tile(spark: SparkSession, store: str, z: int, x: int, y: int) -> DataFrame:
    """S6 for one tile: only the files of its bucket are opened."""
    key = spark.range(1).select(tile_bucket(F.lit(x), F.lit(y), F.lit(z))).first()[0]      # a constant: evaluated on the driver
    return (spark.read.schema(STORE_SCHEMA).parquet(store)
            .where((F.col("z") == z) & (F.col("bucket") == key) & (F.col("x") == x) & (F.col("y") == y) & (F.col("valid_count") > 0))
            .select(*B.BLOCK_COLUMNS))


def read_tms(blocks: DataFrame, requested: DataFrame, size: int, dtype: str = "f4") -> DataFrame:
    """Requested tiles left-joined with stored ones; a missing tile reads as a zero block, one for each band
    that the blocks have (band 1 if they have none).

    The zeros are made row by row where they are needed: the plan carries their number, not the bytes.
    """
    bands = sorted(r[0] for r in blocks.select("band").distinct().collect()) or [1]        # a raster's bands: a handful
    keys = requested.select("z", "x", "y", F.explode(F.array(*[F.lit(b) for b in bands])).alias("band"))
    # late materialisation: only stored tiles that were requested carry pixels into the outer join
    hit = blocks.join(requested.select("z", "x", "y").distinct(), ["z", "x", "y"], "left_semi")
    j = keys.join(hit, ["z", "x", "y", "band"], "left")
    # a length that depends on the row: a constant would be folded into a literal of that many bytes
    zeros = F.repeat(F.lit("\0"), (F.lit(size * size * int(dtype[1])) + F.col("z") * 0).cast("int")).cast("binary")
    return j.select(
        "z", "x", "y", "band", F.lit(size).alias("size"),
        F.coalesce("dtype", F.lit(dtype)).alias("dtype"), "nodata",
        F.coalesce("valid_count", F.lit(size * size)).alias("valid_count"),
        F.coalesce("data", zeros).alias("data"), F.col("weight"),
        F.col("data").isNotNull().alias("stored"))


SOURCE_FIELDS = T.StructType([
    *B.BLOCK_FIELDS, T.StructField("source_id", T.LongType()), T.StructField("priority", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "dx", "dy", "west", "south", "east", "north")],
    T.StructField("bucket", T.IntegerType())])
SOURCE_BUCKETS = 64          # folders of a source-block table: a source's blocks lie in one of them


def source_bucket(source_id: str = "source_id") -> F.Column:
    return F.pmod(F.xxhash64(F.col(source_id).cast("long")), F.lit(SOURCE_BUCKETS)).cast("int")


def read_source_blocks(spark: SparkSession, path: str, sources: list[int] | None = None, box: tuple | None = None) -> DataFrame:
    """Blocks of a stored source table (K1's counterpart for sources), every band, with the grid of their source.

    ``sources`` opens only the folders of these sources, ``box`` (west, south, east, north in the sources' CRS) only row
    groups that can hold a block which meets it: both are filters on stored columns, so the scan prunes them.
    """
    df = spark.read.schema(SOURCE_FIELDS).parquet(path).where(F.col("valid_count") > 0)
    if sources is not None:
        held = spark.createDataFrame([(int(s),) for s in sources], "source_id long").select(source_bucket()).distinct().collect()
        df = df.where(F.col("bucket").isin([r[0] for r in held]) & F.col("source_id").isin([int(s) for s in sources]))
    if box is not None:
        west, south, east, north = (float(v) for v in box)
        df = df.where((F.col("west") < east) & (F.col("east") > west) & (F.col("south") < north) & (F.col("north") > south))
    return df.drop("bucket")


def list_objects(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """Distributed listing (path, length, modificationTime), file contents not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(prefix).select("path", "length", "modificationTime")


def partition_value(path: str, column: str) -> F.Column:
    """The value of a partition column in a file's path, unescaped; NULL if the path has none."""
    raw = F.regexp_extract(F.col(path), f"/{column}=([^/]+)/", 1)
    # a folder escapes what a path cannot hold as %XX, and a plus sign is itself
    return F.when(raw != "", F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))


def read_work_list(spark: SparkSession, path: str) -> DataFrame:
    """One source URI per line."""
    return (spark.read.text(path).select(F.trim(F.col("value")).alias("source"))
                 .where(F.col("source") != ""))


FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),                    # a number or a string, as text
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),       # JSON text: its depth depends on the type
    ])),
])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features (one per line, or FeatureCollections) -> id (text) + bounding box.

    Polygons and MultiPolygons; a feature without either has a NULL box.
    """
    coll = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("features", T.ArrayType(FEATURE_SCHEMA))])
    raw = spark.read.text(path).where(F.trim(F.col("value")) != "")
    parsed = raw.select(F.get_json_object("value", "$.type").alias("kind"), "value")
    single = parsed.where(F.col("kind") == "Feature").select(F.from_json("value", FEATURE_SCHEMA).alias("f"))
    many = (parsed.where(F.col("kind") == "FeatureCollection")
                  .select(F.explode(F.from_json("value", coll)["features"]).alias("f")))
    feats = single.unionByName(many)
    rings = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
    kind, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    feats = feats.select("f", F.when(kind == "Polygon", F.flatten(F.from_json(coords, rings)))
                         .when(kind == "MultiPolygon", F.flatten(F.flatten(F.from_json(coords, T.ArrayType(rings)))))
                         .alias("pts"))
    pts = F.col("pts")
    return feats.select(
        F.col("f.id").alias("id"),
        F.array_min(F.transform(pts, lambda p: p[0])).alias("west"),
        F.array_min(F.transform(pts, lambda p: p[1])).alias("south"),
        F.array_max(F.transform(pts, lambda p: p[0])).alias("east"),
        F.array_max(F.transform(pts, lambda p: p[1])).alias("north"),
    )


def bbox_features(df: DataFrame) -> DataFrame:
    """(id, west, south, east, north) -> one GeoJSON Feature (polygon) per line."""
    ring = F.array(*[F.array(F.col(a), F.col(b)) for a, b in
                     (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    feat = F.struct(F.lit("Feature").alias("type"), F.col("id"),
                    F.create_map().cast("map<string,string>").alias("properties"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feat).alias("value"))


def read_window(spark: SparkSession, store: str, z: int, row0: int, row1: int, col0: int, col1: int,
                scale: int = 1) -> DataFrame:
    """Pixels of the half-open window [row0, row1) x [col0, col1) at level ``z``,
    optionally decimated by an integer ``scale`` (nearest: pixel floor((i + .5) * scale)).

    The block range is a static filter, so it reaches the scan: partition pruning on
    ``z`` and row-group pruning on the stored ``x``/``y`` columns.  Returns
    (orow, ocol, v) for valid pixels.
    """
    size = spark.read.schema(STORE_SCHEMA).parquet(store).where(F.col("z") == z).select("size").first()
    if size is None:
        return spark.createDataFrame([], "orow long, ocol long, v double")
    s = size[0]
    blocks = read_tiles(spark, store, z=z).where(
        F.col("x").between(col0 // s, (col1 - 1) // s) & F.col("y").between(row0 // s, (row1 - 1) // s))
    return blocks.select("x", "y", "size", "dtype", "nodata", "data").mapInArrow(
        lambda it: _window_pixels(it, row0, row1, col0, col1, scale), "orow long, ocol long, v double")


def _window_pixels(batches, row0: int, row1: int, col0: int, col1: int, scale: int):
    """Each block sliced to the window before anything becomes a row."""
    def inside(lo, hi, first):
        at = np.arange(max(lo, first), hi)
        return at[(at - first) % scale == scale // 2]

    for rb in batches:
        for r in rb.to_pylist():
            size = r["size"]
            rows = inside(r["y"] * size, min((r["y"] + 1) * size, row1), row0)
            cols = inside(r["x"] * size, min((r["x"] + 1) * size, col1), col0)
            part = B.decode(r["data"], r["dtype"], size)[np.ix_(rows - r["y"] * size, cols - r["x"] * size)]
            i, j = np.nonzero(B.valid_mask(part, r["nodata"]))
            yield pa.RecordBatch.from_arrays([pa.array((rows[i] - row0) // scale, pa.int64()), pa.array((cols[j] - col0) // scale, pa.int64()),
                                              pa.array(part[i, j].astype(np.float64))], names=["orow", "ocol", "v"])
