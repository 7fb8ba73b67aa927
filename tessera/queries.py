"""Registered queries: one per operator family of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (nothing sampled or capped).  Output columns are aliased and
typed (BIGINT / DOUBLE / STRING / BOOLEAN) to match the DuckDB oracles in
:mod:`tessera.oracles`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import crs, grid, terrain as TR, uris
from .operators import blocks as B, cells as C, halo as H, mosaic as MO, pyramid as P, reproject as RP, warp as WP, windows as WN
from .plans import jobs as J
from .session import scratch_path
from .sources import fixtures as FX, readers as RD, sinks as SK
from .sources.tables import table

S = FX.TILE                  # tile size of the derived rasters
CHUNK = 2048                 # chunk size of the reference's tiles
SITE_ZOOMS = (0, 6, 14)


def _i(c):
    return F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")


def _site_tiles(spark, d, z: int) -> DataFrame:
    s = FX.sites(spark, d)
    return s.select("id", F.lit(z).cast("bigint").alias("z"),
                    grid.lon_to_tile_x("lon", F.lit(z)).alias("x"), grid.lat_to_tile_y("lat", F.lit(z)).alias("y"))


def _dem_store(spark, d) -> str:
    """The dem's non-empty tiles written once to a scratch tile store (K1); readers then scan it."""
    store = scratch_path(spark, "dem-store")
    SK.write_tiles(_dem_blocks(spark, d).where(F.col("valid_count") > 0), store)
    return store


def _dem_blocks(spark, d) -> DataFrame:
    """The dem as 32x32 f8 blocks at z6 (every tile with a row, empty ones included)."""
    return B.pack_blocks(FX.dem(spark, d), S, FX.DEM_ZOOM, dtype="f8", nodata=FX.NODATA)


# ====================================================================== grid (P*)
def tile_of_point(spark, d):
    s = FX.sites(spark, d).select("id", "lon", "lat", F.explode(F.array(*[F.lit(z) for z in SITE_ZOOMS])).alias("z"))
    return s.select("id", _i("z").alias("z"), _i(grid.lon_to_tile_x("lon", "z")).alias("x"),
                    _i(grid.lat_to_tile_y("lat", "z")).alias("y"))


def mercator_xy(spark, d):
    s = FX.sites(spark, d)
    x, y = crs.lonlat_to_mercator("lon", "lat")
    return s.select("id", F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"))


def tile_ul(spark, d):
    t = _site_tiles(spark, d, 14)
    return t.select("id", "z", "x", "y", F.round(grid.tile_ul_lon("x", "z"), 9).alias("lon"),
                    F.round(grid.tile_ul_lat("y", "z"), 9).alias("lat"))


def tile_bounds(spark, d):
    t = _site_tiles(spark, d, 14)
    b, a = grid.tile_bounds("x", "y", "z"), grid.tile_affine("x", "y", "z", CHUNK)
    return t.select("id", *[F.round(b[k], 4).alias(k) for k in ("ulx", "uly", "lrx", "lry")],
                    F.round(a["a"], 6).alias("a"), F.round(a["e"], 6).alias("e"))


def tile_quadkey(spark, d):
    s = FX.sites(spark, d).select("id", "lon", "lat", F.explode(F.array(*[F.lit(z) for z in (1, 6, 14)])).alias("z"))
    t = s.select("id", _i("z").alias("z"), grid.lon_to_tile_x("lon", "z").alias("x"), grid.lat_to_tile_y("lat", "z").alias("y"))
    return t.select("id", "z", grid.quadkey("x", "y", "z").alias("qk"))


def tile_parents(spark, d):
    t = _site_tiles(spark, d, 14).select("z", "x", "y").distinct()
    p, off = grid.parent("x", "y", "z"), grid.corner_offset("x", "y", CHUNK)
    return t.select("z", "x", "y", _i(p["z"]).alias("pz"), _i(p["x"]).alias("px"), _i(p["y"]).alias("py"),
                    grid.corner("x", "y").alias("corner"), _i(off["dx"]).alias("dx"), _i(off["dy"]).alias("dy"))


def tile_parent_set(spark, d):
    t = _site_tiles(spark, d, 14).select("z", "x", "y").distinct()
    p = grid.parent("x", "y", "z")
    return (t.groupBy(_i(p["z"]).alias("z"), _i(p["x"]).alias("x"), _i(p["y"]).alias("y"))
             .agg(F.count("*").alias("n_children")))


def tile_children(spark, d):
    t = _site_tiles(spark, d, 10).select("z", "x", "y").distinct()
    c = t.select("z", "x", "y", F.explode(grid.children("x", "y", "z")).alias("c"))
    return c.select("z", "x", "y", _i("c.z").alias("cz"), _i("c.x").alias("cx"), _i("c.y").alias("cy"))


def tiles_for_boxes(spark, d):
    t = J.cover_tiles(FX.boxes(spark, d), 6, key="id", west="west", south="south", east="east", north="north")
    return t.groupBy(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y")).agg(F.count("*").alias("n_boxes"))


def tile_list_json(spark, d):
    """S1 + P16: tiles written as a text tile list, read back and deduplicated."""
    path = scratch_path(spark, "tiles-txt")
    RD.tile_list_lines(_site_tiles(spark, d, 14)).write.mode("overwrite").text(path)
    t = RD.read_tile_list(spark, path)
    return t.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"),
                    grid.tile_key_path(F.lit("s3://b/3857"), "x", "y", "z").alias("path"))


def geojson_features(spark, d):
    """Footprints written as GeoJSON features (one per line), read back as boxes."""
    path = scratch_path(spark, "features")
    RD.bbox_features(FX.boxes(spark, d)).write.mode("overwrite").text(path)
    return RD.read_features(spark, path).select(_i("id").alias("id"), "west", "south", "east", "north")


# ====================================================================== CRS
def utm_to_lonlat(spark, d):
    p = FX.utm_points(spark, d)
    lon, lat = crs.utm_to_lonlat("easting", "northing", 10)
    return p.select("id", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


def lonlat_to_utm(spark, d):
    p = FX.utm_points(spark, d)
    lon, lat = crs.utm_to_lonlat("easting", "northing", 10)
    ll = p.select("id", lon.alias("lon"), lat.alias("lat"))
    e, n = crs.lonlat_to_utm("lon", "lat", 10)
    return ll.select("id", F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


def _footprints(spark, d):
    return J.footprints(FX.rasters(spark, d), "UTM:10")


def _footprint_table(spark, d):
    """The footprint index written once to the shared scratch folder and read back."""
    return J.write_footprint_index(spark, _footprints(spark, d), scratch_path(spark, "footprints"))


def suggest_zoom(spark, d):
    fp = _footprints(spark, d)
    return fp.select("source_id", F.round("res", 6).alias("res"),
                     _i(grid.zoom_for_resolution("res", CHUNK)).alias("zoom"))


def footprint_index(spark, d):
    fp = _footprints(spark, d)
    return fp.select("source_id", "west", "south", "east", "north",
                     *[F.round(F.col("ll")[k], 8).alias(f"lon_lat_{k}") for k in ("west", "south", "east", "north")])


def mosaic_grid(spark, d):
    """Mosaic resolution = highest of the inputs, one nodata for the group."""
    fp = _footprints(spark, d)
    return fp.agg(F.min(F.abs("a")).alias("res"), F.max("nodata").alias("nodata"),
                  F.count("*").alias("n_sources"), F.min("west").alias("west"), F.min("south").alias("south"),
                  F.max("east").alias("east"), F.max("north").alias("north"))


def plan_tiles(spark, d):
    """Footprints -> lon/lat boxes -> zoom of the finest source -> distinct tile cover."""
    fp = _footprint_table(spark, d)
    t = J.plan_tiles(fp, J.dataset_zoom(fp, CHUNK))
    return t.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"), "n_sources")


def source_overlap(spark, d):
    """J2 (Z1 planning): which source footprints meet each tile of the plan, in EPSG:3857.

    Bucketed equi-join + exact box test; no cartesian product.
    """
    fp = _footprint_table(spark, d)
    zoom = J.dataset_zoom(fp, CHUNK)
    pairs = J.tile_sources(J.plan_tiles(fp, zoom), fp, cell=grid.WORLD / 2 ** zoom)
    return pairs.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"), _i("source_id").alias("source_id"))


def source_window(spark, d):
    """Window of a z15 256-px tile on a z14 512-px source level, buffered by 2."""
    t = _site_tiles(spark, d, 15)
    w = grid.source_window("x", "y", "z", 14, 512, 256)
    t = t.select("id", w.alias("w"))
    bw = grid.buffer_window("w", 2)
    src_a = grid.WORLD / (2 ** 14 * 512)
    wt = grid.window_transform(F.lit(src_a), F.lit(-grid.HALF_WORLD), F.lit(-src_a), F.lit(grid.HALF_WORLD), "w")
    ps = grid.pixel_size(F.lit(src_a), F.lit(-src_a), F.col("w.scale"))
    return t.select("id", *[_i(F.col("w")[k]).alias(k) for k in ("row0", "row1", "col0", "col1")],
                    *[_i(bw[k]).alias("b" + k) for k in ("row0", "row1", "col0", "col1")],
                    F.col("w.scale").alias("scale"),
                    F.round(wt["c"], 4).alias("wc"), F.round(wt["f"], 4).alias("wf"),
                    F.round(ps["dx"], 6).alias("dx"), F.round(ps["dy"], 6).alias("dy"))


# ====================================================================== listings
def uri_names(spark, d):
    o = FX.objects(spark, d)
    return o.select("path", uris.uri_scheme("path").alias("scheme"), uris.uri_bucket("path").alias("bucket"),
                    uris.uri_key("path").alias("key"), uris.basename("path").alias("base"),
                    uris.target_name("path").alias("target"), uris.archive_member("path").alias("member"),
                    uris.normalise_uri("path").alias("http"))


def missing_targets(spark, d):
    """Z3 planning: archives whose converted target is not listed yet (left anti join)."""
    return J.missing_targets(FX.objects(spark, d), FX.done(spark, d))


def listing_union(spark, d):
    a = FX.objects(spark, d).select("path", F.lit("source").alias("listing"))
    b = FX.done(spark, d).select("path", F.lit("4326").alias("listing"))
    return a.unionByName(b)


def conversion_log(spark, d):
    """K5 / F8: every archive is converted; a source without pixels fails (output NULL)."""
    src = FX.objects(spark, d).where(uris.is_archive("path")).select(
        F.col("path").alias("source"),
        F.regexp_extract(uris.basename("path"), r"^(\d+)", 1).cast("bigint").alias("k"))
    px = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n_cells"))
    j = src.join(px, "k", "left").select("source", F.coalesce("n_cells", F.lit(0)).cast("bigint").alias("n_cells"))
    return SK.conversion_log(j.withColumn("ok", F.col("n_cells") > 0)).select("source", "output", "ok", "n_cells")


def listing_storage(spark, d):
    """S7 -> J1: scenes of odd priority are converted and written (K2); what the folder then holds is listed, and
    the archives without an output there are the rest of the work."""
    sc = FX.scenes(spark, d).withColumn("source", F.format_string("s3://b/source/scene %d+.zip", F.col("priority")))
    out = scratch_path(spark, "converted-list")
    made = J.convert(sc.where(F.col("priority") % 2 == 1), 2, "average").withColumn("target", uris.target_name("source")).drop("source")
    SK.write_converted(made, out, key="target")
    return J.missing_from_storage(spark, sc.select(F.col("source").alias("path")).distinct(), out)


def reproject_worklist(spark, d):
    """A work list of sources (text, one per line) -> 2x average per source -> K2 -> read back."""
    sc = FX.scenes(spark, d).withColumn("source", F.format_string("s3://b/source/scene-%d.tif", F.col("priority")))
    wl_path = scratch_path(spark, "worklist")
    sc.select(F.col("source").alias("value")).distinct().write.mode("overwrite").text(wl_path)
    out = scratch_path(spark, "converted")
    J.reproject_worklist(spark, wl_path, sc, out, ratio=2)
    back = spark.read.parquet(out)
    return back.select("target", _i("gx").alias("gx"), _i("gy").alias("gy"),
                       _i("vsum").alias("vsum"), _i("vcount").alias("vcount"), "v")


# ====================================================================== blocks, stats, pyramid
def dem_blocks_valid(spark, d):
    b = _dem_blocks(spark, d).where(F.col("valid_count") > 0)
    return b.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"),
                    _i("valid_count").alias("valid_count"), _i(F.length("data")).alias("nbytes"))


def dem_stats(spark, d):
    """Min, max, mean, stddev of valid pixels per tile and for the whole raster, from one row of
    moments per block."""
    st = J.raster_stats(spark, _dem_blocks(spark, d))
    return st.select(_i("x").alias("x"), _i("y").alias("y"), "n", "vmin", "vmax", F.round("mean", 4).alias("vmean"),
                     F.round(F.sqrt(F.col("m2") / F.col("n")), 2).alias("vstd"))


def block_failures(spark, d):
    """F8: the dem with truncated blocks (x = 1) and blocks of an unknown dtype (x = 2): both are logged with their
    reason, the others come through."""
    blk = _dem_blocks(spark, d)
    hurt = blk.withColumn("data", F.when(F.col("x") == 1, F.substring("data", 1, 100)).otherwise(F.col("data"))).withColumn(
        "dtype", F.when(F.col("x") == 2, "q9").otherwise(F.col("dtype")))
    good, dead = B.split_failures(B.try_blocks(hurt, lambda v: v * 2), scratch_path(spark, "tried"))
    st = B.block_stats(good.where(F.col("valid_count") > 0))
    return st.select(_i("x").alias("x"), _i("y").alias("y"), _i("vsum").alias("vsum"), F.lit(None).cast("string").alias("error")).unionByName(
        dead.select(_i("x").alias("x"), _i("y").alias("y"), F.lit(None).cast("bigint").alias("vsum"), "error"))


def reblock(spark, d):
    """Rows of the dem as 128x1 strips -> 32x32 square blocks -> cells."""
    blk = J.reblock(FX.dem(spark, d), FX.DEM_WIDTH, S, FX.DEM_ZOOM, dtype="f8", nodata=FX.NODATA)
    c = B.unpack_blocks(blk)
    return c.select(_i("gx").alias("gx"), _i("gy").alias("gy"), _i("v").alias("v"))


def source_blocks_read(spark, d):
    """Two sources stored as a source-block table; the blocks of the first that meet a box, read back through the
    table's folders and block boxes."""
    path = scratch_path(spark, "source-blocks")
    SK.write_source_blocks(_chunk_sources(spark, d), path)
    back = RD.read_source_blocks(spark, path, sources=[1], box=(-176.0, 80.0, -172.0, 84.5))
    st = B.block_stats(back, keep=("source_id",))
    return st.select("source_id", _i("x").alias("x"), _i("y").alias("y"), _i("valid_count").alias("valid_count"), _i("vsum").alias("vsum"))


def block_map(spark, d):
    """A kernel of the user's over every block (whole currency units), its result by tile."""
    units = B.map_blocks(_dem_blocks(spark, d).where(F.col("valid_count") > 0), lambda v: np.floor(v / 100), out_dtype="i4", out_nodata=-1.0)
    st = B.block_stats(units)
    return st.select(_i("x").alias("x"), _i("y").alias("y"), _i("valid_count").alias("n"), _i("vsum").alias("vsum"))


def tiles_antimeridian(spark, d):
    """Tiles of boxes of which every other one crosses 180 degrees."""
    b = FX.boxes(spark, d)
    odd = F.col("id") % 2 == 1
    b = b.select("id", F.when(odd, F.lit(177.0) + F.col("id") % 3).otherwise(F.col("west")).alias("west"), "south",
                 F.when(odd, F.lit(-179.0) + F.col("id") % 4).otherwise(F.col("east")).alias("east"), "north")
    t = J.cover_tiles(b, 7, key="id", west="west", south="south", east="east", north="north")
    return t.select("id", _i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"))


def overview_sizes(spark, d):
    dm = FX.dem(spark, d).agg((F.max("gx") + 1).alias("w"), (F.max("gy") + 1).alias("h"))
    lv = dm.select("w", "h", F.explode(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest("w", "h"))).cast("int"))).alias("k"))
    f = F.pow(F.lit(2.0), F.col("k"))
    return lv.select(_i("k").alias("level"), _i(F.ceil(F.col("w") / f)).alias("width"),
                     _i(F.ceil(F.col("h") / f)).alias("height"))


def decimate(spark, d):
    return C.decimate(FX.dem(spark, d).where(F.col("v").isNotNull()))


def _pyramid(spark, d, method):
    store = scratch_path(spark, f"pyramid-{method}")
    base = _dem_blocks(spark, d).where(F.col("valid_count") > 0)     # F1 before the first write
    return P.build_pyramid(spark, base, FX.DEM_ZOOM, store, method=method,
                           size=S, dtype="f8")


def pyramid_levels(spark, d):
    """Z2 (nearest): block pyramid z6 -> z0 through the tile store, unpacked to cells."""
    c = B.unpack_blocks(_pyramid(spark, d, "nearest"))
    return c.select(_i("z").alias("z"), "gx", "gy", _i("v").alias("v"))


def pyramid_average(spark, d):
    """Z2 (average): exact footprint means carried as (sum, count) planes."""
    c = B.unpack_blocks(_pyramid(spark, d, "average"), weighted=True)
    return c.select(_i("z").alias("z"), "gx", "gy", _i("wsum").alias("vsum"), _i("wcount").alias("vcount"),
                    (F.col("wsum") / F.col("wcount")).alias("v"))


def pyramid_average_i2(spark, d):
    """Z2 (average) of 16-bit tiles: sums stay exact, the stored pixel is the rounded mean."""
    cells = FX.dem(spark, d).select("gx", "gy", (F.col("v") % 30000).alias("v"))
    base = B.pack_blocks(cells, S, FX.DEM_ZOOM, dtype="i2", nodata=-32768.0).where(F.col("valid_count") > 0)
    pyr = P.build_pyramid(spark, base, FX.DEM_ZOOM, scratch_path(spark, "pyramid-i2"), method="average",
                          size=S, dtype="i2")
    c = B.unpack_blocks(pyr, weighted=True)
    return c.select(_i("z").alias("z"), "gx", "gy", _i("wsum").alias("vsum"), _i("wcount").alias("vcount"))


def stats_of_average(spark, d):
    """A7 over an averaged pyramid: tile statistics are those of the means, at every level."""
    st = B.block_stats(_pyramid(spark, d, "average"))
    return st.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"),
                     _i("valid_count").alias("n"), "vmin", "vmax")


def tms_of_average(spark, d):
    """S11 over an averaged level: the stored z5 tiles and their right neighbours."""
    blk = _pyramid(spark, d, "average").where(F.col("z") == FX.DEM_ZOOM - 1)
    req = blk.select("z", F.explode(F.array("x", F.col("x") + 1)).alias("x"), "y").distinct()
    st = B.block_stats(RD.read_tms(blk, req, S, dtype="f8"), keep=("stored",))
    return st.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"), "stored", "vmax")


def pyramid_mixed_nodata(spark, d):
    """Z2 over tiles that differ in nodata and dtype (a chequerboard), each pixel by its own tile's rule."""
    cells = FX.dem(spark, d).select("gx", "gy", (F.col("v") % 50 - 10).alias("v"),
                                    ((F.floor(F.col("gx") / S) + F.floor(F.col("gy") / S)) % 2).alias("odd"))
    base = (B.pack_blocks(cells.where("odd = 0"), S, FX.DEM_ZOOM, dtype="i2", nodata=-1.0)
             .unionByName(B.pack_blocks(cells.where("odd = 1"), S, FX.DEM_ZOOM, dtype="f4", nodata=-9.0))
             .where(F.col("valid_count") > 0))
    pyr = P.build_pyramid(spark, base, FX.DEM_ZOOM, scratch_path(spark, "pyramid-mixed"), method="nearest", size=S)
    return B.unpack_blocks(pyr).select(_i("z").alias("z"), "gx", "gy", _i("v").alias("v"))


def pyramid_manifest(spark, d):
    """A10 / K1: tiles and bytes per level of the written pyramid, with a total row."""
    store = _pyramid(spark, d, "nearest").select("z", B.pixel_bytes().alias("nbytes"))
    return (store.rollup(_i("z").alias("z"))
                 .agg(F.count("*").alias("n_tiles"), _i(F.sum("nbytes")).alias("nbytes")))


def tms_view(spark, d):
    """Every stored tile and its 8 neighbours requested; missing ones read as zeros."""
    blk = RD.read_tiles(spark, _dem_store(spark, d), z=FX.DEM_ZOOM)
    n = 2 ** FX.DEM_ZOOM
    req = (blk.select("z", F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                                               for dx in (-1, 0, 1) for dy in (-1, 0, 1)])).alias("o"), "x", "y")
              .select("z", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"))
              .where((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") < n) & (F.col("y") < n))
              .distinct())
    view = RD.read_tms(blk, req, S, dtype="f8")
    st = B.block_stats(view, keep=("stored",))
    return st.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"), "stored",
                     _i(F.coalesce("vsum", F.lit(0.0))).alias("vsum"))


def window_read(spark, d):
    """The buffered z5 windows on the z6 store, read decimated by their scale (2)."""
    blk = RD.read_tiles(spark, _dem_store(spark, d), z=FX.DEM_ZOOM)
    wins = blk.select(grid.parent("x", "y", "z").alias("p")).distinct().select("p.z", "p.x", "p.y")
    c = WN.window_cells(WN.read_windows(blk, wins, FX.DEM_ZOOM, S, S, buffer=2))
    return c.select(_i("z").alias("wz"), _i("x").alias("wx"), _i("y").alias("wy"), _i("row").alias("orow"), _i("col").alias("ocol"),
                    _i("v").alias("v"))


def shade_window(spark, d):
    """Z6 through P20 - P21 - S10: 32-px tiles of z6 (scale 1) and z5 (scale 2) shaded from windows on a level of
    64-px tiles, pixels that are not square (dx 1.5, dy 2); no pixel becomes a row before the shade."""
    dense = FX.dem_dense(spark, d)
    level = B.pack_blocks(dense, 2 * S, FX.DEM_ZOOM - 1, dtype="f8", nodata=FX.NODATA)
    at = [dense.select(F.lit(FX.DEM_ZOOM - k).alias("z"), *[F.floor(F.col(g) / (S << k)).cast("int").alias(c) for g, c in (("gx", "x"), ("gy", "y"))])
          for k in (0, 1)]
    sh = WN.shade_windows(level, at[0].unionByName(at[1]), FX.DEM_ZOOM - 1, 2 * S, S, "zfactor", pixel=(1.5, 2.0))
    return B.unpack_blocks(sh).select(_i("z").alias("z"), "gx", "gy", _i("v").alias("shade"))


def tiles_upsert(spark, d):
    """K1/O1: the tiles of every other column written again (values raised by 1.00) into the store of the dem:
    they replace those of their keys in the buckets they fall into, the rest stays."""
    store = _dem_store(spark, d)
    raised = FX.dem(spark, d).where(F.floor(F.col("gx") / S) % 2 == 1).select("gx", "gy", (F.col("v") + 100).alias("v"))
    SK.write_tiles(B.pack_blocks(raised, S, FX.DEM_ZOOM, dtype="f8", nodata=FX.NODATA).where(F.col("valid_count") > 0), store)
    c = B.unpack_blocks(RD.read_tiles(spark, store, z=FX.DEM_ZOOM))
    return c.select("gx", "gy", _i("v").alias("v"))


def pyramid_list(spark, d):
    """Z2 with a tile list (some tiles of every other parent): parents from the list, content from the store; three
    levels folded in one shuffle."""
    base = _dem_blocks(spark, d).where(F.col("valid_count") > 0)
    listed = base.where((F.floor(F.col("x") / 2) + F.floor(F.col("y") / 2)) % 2 == 0).where((F.col("x") + F.col("y")) % 2 == 0).select("z", "x", "y")
    pyr = P.build_pyramid(spark, base, FX.DEM_ZOOM, scratch_path(spark, "pyramid-list"), size=S, dtype="f8", tiles=listed)
    return B.unpack_blocks(pyr).select(_i("z").alias("z"), "gx", "gy", _i("v").alias("v"))


# ====================================================================== mosaic, warps
def mosaic_paint(spark, d):
    return C.mosaic_paint(FX.scenes(spark, d))


def chunk_average(spark, d):
    """Z1 on the scenes: paint the overlapping sources, average onto the z9 grid (2x)."""
    return C.paint_and_average(FX.scenes(spark, d), 2)


def chunk_tiles(spark, d):
    """Z1 end to end: scenes (z10 grid) -> paint -> 2x average -> 32x32 tiles at z9 ->
    empty tiles dropped -> tile store (K1) -> what was stored per tile."""
    # the tile list: every z9 tile holding a source pixel (a 2-column scan + distinct)
    tiles = FX.scenes(spark, d).select(F.lit(9).alias("z"), F.floor(F.col("gx") / (2 * S)).alias("x"),
                                       F.floor(F.col("gy") / (2 * S)).alias("y")).distinct()
    out = J.chunk(spark, FX.scenes(spark, d), FX.SCENE_ZOOM, FX.SCENE_ZOOM - 1, S, scratch_path(spark, "chunk"),
                  tiles=tiles, dtype="f8", nodata=FX.NODATA)
    st = B.block_stats(out)
    return st.select(_i("z").alias("z"), _i("x").alias("x"), _i("y").alias("y"),
                     _i("valid_count").alias("valid_count"), F.round("vsum", 4).alias("vsum"))


def chunk_bands(spark, d):
    """Three bands chunked into one store, those z9 tiles of the list with odd x + y."""
    sc = FX.scenes_wide(spark, d)
    tiles = (sc.select(F.lit(9).alias("z"), F.floor(F.col("gx") / (2 * S)).alias("x"),
                       F.floor(F.col("gy") / (2 * S)).alias("y"))
               .where((F.col("x") + F.col("y")) % 2 == 1).distinct())
    out = J.chunk(spark, sc, FX.SCENE_ZOOM, FX.SCENE_ZOOM - 1, S, scratch_path(spark, "chunk-bands"),
                  tiles=tiles, dtype="f8", nodata=FX.NODATA, bands=FX.SCENE_BANDS)
    return B.unpack_blocks(out).select(_i("band").alias("band"), "gx", "gy", F.round("v", 6).alias("v"))


def mosaic_bands(spark, d):
    """A8/R5 in block form: every band painted on its own."""
    painted = MO.paint_blocks(FX.scenes_wide(spark, d), S, FX.SCENE_ZOOM, bands=FX.SCENE_BANDS)
    return B.unpack_blocks(painted).select(_i("band").alias("band"), "gx", "gy", _i("v").alias("v"))


def mosaic_blocks(spark, d):
    """A8 in block form: scenes painted per tile (salted by source), unpacked (same oracle)."""
    painted = MO.paint_blocks(FX.scenes(spark, d), S, FX.SCENE_ZOOM)
    return B.unpack_blocks(painted).select("gx", "gy", _i("v").alias("v"))


def chunk_average_blocks(spark, d):
    """Z1 in block form: painted z10 tiles -> one weighted halving pass -> z9 (same oracle)."""
    painted = MO.paint_blocks(FX.scenes(spark, d), S, FX.SCENE_ZOOM)
    avg = P.pyramid_pass(painted, 1, "average", FX.SCENE_ZOOM - 1)
    c = B.unpack_blocks(avg, weighted=True)
    return c.select("gx", "gy", _i("wsum").alias("vsum"), _i("wcount").alias("vcount"),
                    (F.col("wsum") / F.col("wcount")).alias("v"))


def warp_bands(spark, d):
    """Every band painted and averaged on its own, the bands of a cell in one row until they are averaged."""
    return C.paint_and_average_bands(FX.scenes_wide(spark, d), {1: "v1", 2: "v2", 3: "v3"}, 2).select(
        _i("band").alias("band"), "gx", "gy", "vsum", "vcount", "v")


def warp_nearest(spark, d):
    return C.warp_nearest(FX.dem(spark, d), 1.5).select("gx", "gy", _i("v").alias("v"))


def warp_bilinear(spark, d):
    return C.warp_bilinear(FX.dem(spark, d), 0.75)


def warp_bilinear_blocks(spark, d):
    """R2 in block form: dem blocks -> bilinear onto the 0.75-pixel grid in 32-px tiles (same oracle)."""
    blk = _dem_blocks(spark, d).where(F.col("valid_count") > 0)
    out = WP.warp_blocks(blk, 0.75, S, FX.DEM_ZOOM, "bilinear")
    return B.unpack_blocks(out).select("gx", "gy", "v")


def warp_nearest_blocks(spark, d):
    """R4 in block form: dem blocks -> nearest onto the 1.5-pixel grid in 32-px tiles (same oracle)."""
    blk = _dem_blocks(spark, d).where(F.col("valid_count") > 0)
    out = WP.warp_blocks(blk, 1.5, S, FX.DEM_ZOOM, "nearest")
    return B.unpack_blocks(out).select("gx", "gy", _i("v").alias("v"))


# The dem is on the z6 Mercator grid; its 4326 target grid (Z3's conversion).
DEM_3857 = RP.Grid("EPSG:3857", -grid.HALF_WORLD, grid.HALF_WORLD, grid.WORLD / 2048, grid.WORLD / 2048)
DEM_4326 = RP.Grid("EPSG:4326", -180.0, 85.0625, 0.125, 0.0625)       # the raster reaches 85.05 degrees north


def warp_4326(spark, d):
    """R2 + P15 (Z3): the dem reprojected from EPSG:3857 to a 4326 grid, bilinear."""
    out = RP.warp_crs(FX.dem(spark, d), DEM_3857, DEM_4326, "bilinear")
    # values are cents: whole cents (projection maths differs by ulps between engines)
    return out.select("gx", "gy", _i(F.round("v")).alias("v"))


def warp_4326_nearest(spark, d):
    """R4 + P15: the same reprojection with nearest resampling."""
    out = RP.warp_crs(FX.dem(spark, d), DEM_3857, DEM_4326, "nearest")
    return out.select("gx", "gy", _i("v").alias("v"))


def warp_4326_blocks(spark, d):
    """Block form of ``warp_4326``: 32-px dem blocks -> 4326 target tiles of 32 px (same oracle)."""
    blk = _dem_blocks(spark, d).where(F.col("valid_count") > 0)
    out = RP.warp_blocks_crs(blk, DEM_3857, DEM_4326, S, 0, "bilinear")
    return B.unpack_blocks(out).select("gx", "gy", _i(F.round("v")).alias("v"))


def reproject_average_4326(spark, d):
    """The dem in four strips, each a source of the work list, averaged onto a coarser 4326 grid."""
    cells = FX.dem(spark, d).withColumn("source", F.format_string("s3://b/source/dem-%d.tif", F.floor(F.col("gx") / S)))
    wl = scratch_path(spark, "worklist")
    cells.select(F.col("source").alias("value")).distinct().write.text(wl)
    out = scratch_path(spark, "converted")
    J.reproject_average(spark, wl, cells, DEM_3857, RP.Grid("EPSG:4326", -180.0, 85.25, 0.5, 0.25), out)
    return spark.read.parquet(out).select("target", _i("gx").alias("gx"), _i("gy").alias("gy"), F.round("v", 4).alias("v"))


def reproject_average_blocks(spark, d):
    """Z4 in block form: every column of dem blocks is a source of the work list (same oracle)."""
    blk = _dem_blocks(spark, d).withColumn("source", F.format_string("s3://b/source/dem-%d.tif", "x"))
    wl, out = scratch_path(spark, "worklist"), scratch_path(spark, "converted")
    blk.select(F.col("source").alias("value")).distinct().write.text(wl)
    J.reproject_average_blocks(spark, wl, blk, DEM_3857, RP.Grid("EPSG:4326", -180.0, 85.25, 0.5, 0.25), out, S, dtype="f8")
    c = B.unpack_blocks(spark.read.parquet(out), keep=("target",))
    return c.select("target", _i("gx").alias("gx"), _i("gy").alias("gy"), F.round("v", 4).alias("v"))


def _chunk_sources(spark, d):
    base = FX.dem(spark, d)
    blocks = None
    for sid, x0, y0, dx, dy, lift in CHUNK_SOURCES:
        b = B.pack_blocks(base.select("gx", "gy", (F.col("v") + lift).alias("v")), S, 0, dtype="f8", nodata=FX.NODATA)
        b = b.select("*", F.lit(sid).alias("source_id"), F.lit(sid).alias("priority"),
                     *[F.lit(v).alias(k) for k, v in (("x0", x0), ("y0", y0), ("dx", dx), ("dy", dy))])
        blocks = b if blocks is None else blocks.unionByName(b)
    return blocks


def chunk_reproject(spark, d):
    """Z1 in block form: two overlapping 4326 sources of different resolution (both the dem, the upper one
    raised by 10000.00) averaged onto z5 Mercator tiles; the tile list leaves out every third column."""
    blocks = _chunk_sources(spark, d)
    tiles = spark.range(32).select(F.lit(5).alias("z"), F.col("id").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("y"))
    out = J.chunk_reproject(spark, blocks, RP.Grid("EPSG:4326", "x0", "y0", "dx", "dy"), 5, S, scratch_path(spark, "chunk-any"),
                            tiles=tiles.where(F.col("x") % 3 != 2), dtype="f8", nodata=FX.NODATA, paint_first=False)
    return B.unpack_blocks(out).select("gx", "gy", F.round("v", 4).alias("v"))


def chunk_mosaic(spark, d):
    """Z1 in the order of a mosaic: the same two sources painted on the finest source grid first, the mosaic then
    averaged onto z5 Mercator tiles; both sources meet inside target pixels."""
    tiles = spark.range(32).select(F.lit(5).alias("z"), F.col("id").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("y"))
    out = J.chunk_reproject(spark, _chunk_sources(spark, d), RP.Grid("EPSG:4326", "x0", "y0", "dx", "dy"), 5, S, scratch_path(spark, "chunk-mosaic"),
                            tiles=tiles.where(F.col("x") % 3 != 2), dtype="f8", nodata=FX.NODATA)
    return B.unpack_blocks(out).select("gx", "gy", F.round("v", 4).alias("v"))


# id (also the priority), x0, y0, dx, dy of a 4326 grid, and what is added to the dem
CHUNK_SOURCES = ((1, -179.97, 85.0, 0.125, 0.0625, 0), (2, -174.97, 80.0, 0.25, 0.125, 1000000))


def convert_missing(spark, d):
    """Z3: archives without a 4326 output reprojected from UTM, two bands, each on its own default grid;
    sources without pixels fail; a second run over the listing of what was written finds only those."""
    name = F.concat(F.lit("s3://b/source/"), F.col("source_id").cast("string"), F.lit(".zip"))
    ras = FX.rasters(spark, d).withColumn("source", name)
    k = F.col("o_orderkey")
    bands = F.array(*[F.struct(F.lit(b).alias("band"), v.cast("bigint").alias("v"))
                      for b, v in ((1, F.round(F.col("o_totalprice") * 100)), (2, F.col("o_custkey")))])
    cells = table(spark, d, "orders").select((1 + k % 9).alias("source_id"), (F.floor(k / 9) % 16).alias("gx"),
                                             F.floor(k / 144).alias("gy"), F.inline(bands)).withColumn("source", name).drop("source_id")
    listing = ras.select(F.col("source").alias("path"))
    out = scratch_path(spark, "converted-4326")
    done = spark.range(1).select(F.lit("s3://b/4326/2.tif").alias("path"))
    first = J.convert_missing(spark, listing, done, cells, ras, "UTM:10", out, "nearest")
    back = spark.read.parquet(out)
    second = J.convert_missing(spark, listing, done.unionByName(back.select(F.col("target").alias("path")).distinct()),
                               cells, ras, "UTM:10", scratch_path(spark, "converted-again"), "nearest")
    none = F.lit(None).cast("bigint")
    logs = [log.select(F.lit(kind).alias("kind"), F.col("source").alias("name"), none.alias("band"), none.alias("gx"), none.alias("gy"),
                       F.col("output").isNotNull().cast("bigint").alias("v")) for kind, log in (("first", first), ("second", second))]
    px = back.select(F.lit("pixel").alias("kind"), F.col("target").alias("name"), *[_i(c).alias(c) for c in ("band", "gx", "gy", "v")])
    return px.unionByName(logs[0]).unionByName(logs[1])


def _convert_inputs(spark, d):
    """(rasters with their archive names, two-band cells (source_id, gx, gy, band, v) of nine of them)"""
    ras = FX.rasters(spark, d).withColumn("source", _archive("source_id"))
    k = F.col("o_orderkey")
    bands = F.array(*[F.struct(F.lit(b).alias("band"), v.cast("bigint").alias("v"))
                      for b, v in ((1, F.round(F.col("o_totalprice") * 100)), (2, F.col("o_custkey")))])
    return ras, table(spark, d, "orders").select((1 + k % 9).alias("source_id"), (F.floor(k / 9) % 16).alias("gx"),
                                                 F.floor(k / 144).alias("gy"), F.inline(bands))


def _archive(c):
    return F.concat(F.lit("s3://b/source/"), F.col(c).cast("string"), F.lit(".zip"))


def convert_missing_blocks(spark, d):
    """Z3 from blocks: archives without a 4326 output, each bilinear from UTM onto its own default grid, both bands."""
    ras, cells = _convert_inputs(spark, d)
    packed = B.pack_blocks(cells, S, "source_id", dtype="f8", nodata=FX.NODATA, band="band")
    blocks = packed.withColumn("source", _archive("z"))
    done = spark.range(1).select(F.lit("s3://b/4326/2.tif").alias("path"))
    out = scratch_path(spark, "converted-blocks")
    log = J.convert_missing_blocks(spark, ras.select(F.col("source").alias("path")), done, blocks, ras, "UTM:10", out, S, "bilinear", dtype="f8")
    back = spark.read.parquet(out)
    c = B.unpack_blocks(back, keep=("target",))             # weights differ by ulps of a projected metre: hundreds, not cents
    px = c.select(F.lit("pixel").alias("kind"), F.col("target").alias("name"), *[_i(k).alias(k) for k in ("band", "gx", "gy")], _i(F.round(F.col("v") / 10000)).alias("v"))
    none = F.lit(None).cast("bigint")
    return px.unionByName(log.select(F.lit("log").alias("kind"), F.col("source").alias("name"), none.alias("band"), none.alias("gx"), none.alias("gy"),
                                     F.col("output").isNotNull().cast("bigint").alias("v")))


def pyramid_levels_cells(spark, d):
    """Z2 nearest in cell form (one pass, no shuffle): the cell twin of ``pyramid_levels``."""
    return C.pyramid_nearest(FX.dem(spark, d), FX.DEM_ZOOM).select("z", "gx", "gy", _i("v").alias("v"))


def pyramid_average_cells(spark, d):
    """Z2 average in cell form (one 2x2 aggregate per level): the cell twin of ``pyramid_average``."""
    return C.pyramid_average(FX.dem(spark, d), FX.DEM_ZOOM).select("z", "gx", "gy", _i("vsum").alias("vsum"),
                                                                   _i("vcount").alias("vcount"), "v")


# ====================================================================== terrain
def gradient(spark, d):
    return C.gradient(FX.dem_dense(spark, d), 2.0, 2.0).select("gx", "gy", "a", "b")


def hillshade_naive(spark, d):
    g = C.gradient(FX.dem_dense(spark, d), 2.0, 2.0)
    return g.select("gx", "gy", _i(TR.hillshade_naive("a", "b")).alias("shade"))


def hillshade_zfactor(spark, d):
    g = C.gradient(FX.dem_dense(spark, d), 2.0, 2.0)
    return g.select("gx", "gy", F.round(TR.aspect_zfactor("a", "b"), 9).alias("aspect"),
                    _i(TR.hillshade_zfactor("a", "b")).alias("shade"))


def slope_aspect_trig(spark, d):
    g = C.gradient(FX.dem_dense(spark, d), 2.0, 2.0)
    return g.select("gx", "gy", *[F.round(f("a", "b"), 9).alias(f.__name__)
                                  for f in (TR.cos_aspect, TR.sin_aspect, TR.sin_slope, TR.cos_slope)])


def hillshade_light(spark, d):
    """T3 per buffered tile (gradient and stretch inside tile + 2 px), cropped."""
    s = C.shade_tiles_light(FX.dem_dense(spark, d), S, buffer=2, h=1.0)
    return s.select(_i("tx").alias("tx"), _i("ty").alias("ty"), "gx", "gy", _i("shade").alias("shade"))


def shade_rgba(spark, d):
    """Light shade of each buffered tile, ramp stretched over that window, then cropped."""
    s = J.shade_rgba(FX.dem_dense(spark, d), S, buffer=2, h=1.0)
    out, channels = scratch_path(spark, "rgba"), ("shade", *SK.RGBA)
    SK.write_rgba(s, out, S, FX.DEM_ZOOM, channels)            # K4: a band per channel
    c = B.unpack_blocks(RD.read_tiles(spark, out, z=FX.DEM_ZOOM))
    image = c.groupBy("gx", "gy").agg(*[F.max(F.when(F.col("band") == i, F.col("v"))).alias(k) for i, k in enumerate(channels, start=1)])
    return image.select(_i(F.floor(F.col("gx") / S)).alias("tx"), _i(F.floor(F.col("gy") / S)).alias("ty"), "gx", "gy",
                        *[_i(k).alias(k) for k in channels])


def compare_shades(spark, d):
    """The three shaders on one raster (whole-raster stretch for the light shader)."""
    c = J.compare_shades(FX.dem_dense(spark, d), h=2.0, pixel=1.0)
    return c.select("gx", "gy", *[_i(k).alias(k) for k in ("naive", "zfactor", "light")])


def compare_shades_blocks(spark, d):
    """Z9/W2 in block form: the three shades of every tile, light stretched over the whole raster (same oracle)."""
    c = B.unpack_blocks(J.compare_shades_blocks(spark, _dense_store(spark, d), FX.DEM_ZOOM))
    return c.groupBy("gx", "gy").agg(*[_i(F.max(F.when(F.col("band") == b, F.col("v")))).alias(k)
                                       for b, k in ((1, "naive"), (2, "zfactor"), (3, "light"))])


def shade_halo(spark, d):
    """J5/W3/K3/Z6 in block form: strips to neighbours, z-factor shade per buffered tile, crop."""
    sh = J.shade_tiles(spark, _dense_store(spark, d), FX.DEM_ZOOM, scratch_path(spark, "shade"), "zfactor",
                       buffer=2, h=2.0)
    c = B.unpack_blocks(sh)
    return c.select("gx", "gy", _i("v").alias("shade"))


def _dense_store(spark, d) -> str:
    store = scratch_path(spark, "dem-dense")
    blk = B.pack_blocks(FX.dem_dense(spark, d), S, FX.DEM_ZOOM, dtype="f8", nodata=FX.NODATA)
    SK.write_tiles(blk.where(F.col("valid_count") > 0), store)
    return store


def shade_spacing(spark, d):
    """T2/Z6 in block form with pixels that are not square (dx 1.5, dy 2)."""
    sh = J.shade_tiles(spark, _dense_store(spark, d), FX.DEM_ZOOM, scratch_path(spark, "shade-dxdy"), "zfactor", h=(1.5, 2.0))
    return B.unpack_blocks(sh).select("gx", "gy", _i("v").alias("shade"))


def shade_rgba_blocks(spark, d):
    """T6/Z7 in block form: one tile block per channel (bands 1 to 4)."""
    sh = J.shade_tiles(spark, _dense_store(spark, d), FX.DEM_ZOOM, scratch_path(spark, "shade-rgba"), "rgba", h=1.0)
    return B.unpack_blocks(sh).select("gx", "gy", _i("band").alias("band"), _i("v").alias("v"))


def hillshade_light_blocks(spark, d):
    """T3 in block form: halo strips, light shade stretched per buffered tile, crop (same oracle)."""
    sh = J.shade_tiles(spark, _dense_store(spark, d), FX.DEM_ZOOM, scratch_path(spark, "shade-light"),
                       "light", buffer=2, h=1.0)
    c = B.unpack_blocks(sh)
    return c.select(_i(F.floor(F.col("gx") / S)).alias("tx"), _i(F.floor(F.col("gy") / S)).alias("ty"),
                    "gx", "gy", _i("v").alias("shade"))


def hillshade_naive_blocks(spark, d):
    """T1 in block form (int32 shade tiles), same oracle as the cell form."""
    sh = J.shade_tiles(spark, _dense_store(spark, d), FX.DEM_ZOOM, scratch_path(spark, "shade-naive"),
                       "naive", buffer=2, h=2.0)
    return B.unpack_blocks(sh).select("gx", "gy", _i("v").alias("shade"))


# ====================================================================== ordering (O1, O2)
def tile_partitions(spark, d):
    t = _site_tiles(spark, d, 14).select("z", "x", "y").distinct()
    t = t.select("z", "x", "y", grid.quadkey("x", "y", "z").alias("qk"))
    return t.repartitionByRange("qk").sortWithinPartitions("qk").select("qk", "z", "x", "y")


QUERIES = {f.__name__: f for f in (
    tile_of_point, mercator_xy, tile_ul, tile_bounds, tile_quadkey, tile_parents, tile_parent_set,
    tile_children, tiles_for_boxes, tile_list_json, geojson_features,
    utm_to_lonlat, lonlat_to_utm, suggest_zoom, footprint_index, mosaic_grid, plan_tiles, source_overlap, source_window,
    uri_names, missing_targets, listing_union, conversion_log, reproject_worklist,
    dem_blocks_valid, dem_stats, reblock, overview_sizes, decimate, pyramid_levels, pyramid_average,
    chunk_bands, mosaic_bands, pyramid_average_i2, stats_of_average, tms_of_average, pyramid_mixed_nodata,
    pyramid_manifest, tms_view, window_read,
    mosaic_paint, mosaic_blocks, chunk_average, chunk_average_blocks, chunk_tiles, warp_bands, warp_nearest, warp_bilinear,
    warp_bilinear_blocks, warp_nearest_blocks, warp_4326, warp_4326_nearest, warp_4326_blocks,
    pyramid_levels_cells, pyramid_average_cells,
    gradient, hillshade_naive, hillshade_zfactor, slope_aspect_trig, hillshade_light, shade_rgba,
    compare_shades, shade_halo, hillshade_light_blocks, hillshade_naive_blocks, tile_partitions,
    reproject_average_4326, chunk_reproject, convert_missing, shade_spacing, shade_rgba_blocks,
    shade_window, tiles_upsert, pyramid_list, chunk_mosaic, convert_missing_blocks,
    block_failures, compare_shades_blocks, listing_storage, source_blocks_read, block_map, tiles_antimeridian,
    reproject_average_blocks,
)}
