"""Composite jobs (Z1-Z10): the reference's scripts as Spark plans.

Each job composes operators; where it produces tiles it writes them with the
idempotent tile sink and returns the stored result read back (lineage cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, grid, terrain as TR, uris
from ..operators import blocks as B, cells as C, halo as H, mosaic as MO, overlap as OV, pyramid as P, reproject as RP
from ..operators.skew import salted_join
from ..sources import readers as RD, sinks as SK
from ..session import scratch_path

CHUNK_SIZE = 2048


# --------------------------------------------------------------------- Z5 plan
def footprints(rasters: DataFrame, src_crs: str) -> DataFrame:
    """Per raster its native box, the lon/lat box and the 3857 box (four corners each)
    and the default 3857 resolution.  ``rasters`` has source_id, a, c, e, f, width, height."""
    fp = rasters.select("*", F.col("c").alias("west"), (F.col("f") + F.col("e") * F.col("height")).alias("south"),
                        (F.col("c") + F.col("a") * F.col("width")).alias("east"), F.col("f").alias("north"))
    corners = [("west", "south"), ("west", "north"), ("east", "south"), ("east", "north")]
    keep = list(fp.columns)
    fp = crs.add_points(fp, src_crs, "EPSG:4326", [(x, y, f"_lon{i}", f"_lat{i}") for i, (x, y) in enumerate(corners)])
    fp = crs.add_points(fp, "EPSG:4326", "EPSG:3857", [(f"_lon{i}", f"_lat{i}", f"_mx{i}", f"_my{i}") for i in range(4)])

    def box(px, py):
        xs, ys = [F.col(f"{px}{i}") for i in range(4)], [F.col(f"{py}{i}") for i in range(4)]
        return F.struct(F.least(*xs).alias("west"), F.least(*ys).alias("south"),
                        F.greatest(*xs).alias("east"), F.greatest(*ys).alias("north"))
    fp = fp.select(*keep, box("_lon", "_lat").alias("ll"), box("_mx", "_my").alias("merc"))
    return fp.withColumn("res", crs.resolution_of("merc", "width", "height"))


def write_footprint_index(spark: SparkSession, fp: DataFrame, path: str) -> DataFrame:
    """S4 as a stored table: computed once per dataset, then read by planning
    jobs (zoom, tile cover, tile/source pairs) instead of being recomputed."""
    fp.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dataset_zoom(fp: DataFrame, chunk: int = CHUNK_SIZE) -> int:
    """P14 for the dataset: the zoom of its finest source (one number)."""
    return int(fp.agg(F.max(grid.zoom_for_resolution("res", chunk))).first()[0])


def cover_tiles(boxes: DataFrame, zoom: int, key: str = "source_id", west="ll.west", south="ll.south",
                east="ll.east", north="ll.north") -> DataFrame:
    """(key, z, x, y) for every tile at ``zoom`` meeting each lon/lat box.

    Generated in two steps -- tile rows, spread over tasks, then the tiles of each
    row -- so one huge box (a continent at z14 is ~1e8 tiles) is not generated
    inside a single task; plain explodes keep it code-generated.
    """
    z = F.lit(zoom)
    # a box whose west lies east of its east edge crosses 180 degrees: two boxes
    w, e = (F.col(c) if isinstance(c, str) else c for c in (west, east))
    halves = F.when(w > e, F.array(F.struct(w.alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), e.alias("e"))))
    boxes = boxes.withColumn("__half", F.explode(halves.otherwise(F.array(F.struct(w.alias("w"), e.alias("e"))))))
    rows = boxes.select(key, grid.lon_to_tile_x("__half.w", z).alias("x0"), grid.lon_to_tile_x("__half.e", z).alias("x1"),
                        F.explode_outer(F.sequence(grid.lat_to_tile_y(north, z),
                                                   grid.lat_to_tile_y(south, z))).alias("y"))
    return (rows.where(F.col("y").isNotNull()).repartition(key, "y")
                .select(key, z.cast("int").alias("z"), F.explode(F.sequence("x0", "x1")).alias("x"), "y")
                .distinct())


def plan_tiles(fp: DataFrame, zoom: int) -> DataFrame:
    """Distinct tiles at ``zoom`` meeting any footprint, with how many sources meet each."""
    return cover_tiles(fp, zoom).groupBy("z", "x", "y").agg(F.count("*").alias("n_sources"))


def tile_sources(tiles: DataFrame, fp: DataFrame, cell: float | None = None) -> DataFrame:
    """(tile, source) pairs whose 3857 boxes meet, by a bucketed equi-join."""
    b = grid.tile_bounds("x", "y", "z")
    t = tiles.select("z", "x", "y", b["ulx"].alias("xmin"), b["lry"].alias("ymin"),
                     b["lrx"].alias("xmax"), b["uly"].alias("ymax"))
    s = fp.select("source_id", F.col("merc.west").alias("xmin"), F.col("merc.south").alias("ymin"),
                  F.col("merc.east").alias("xmax"), F.col("merc.north").alias("ymax"))
    if cell is None:
        z = tiles.agg(F.max("z")).first()[0]
        cell = grid.WORLD / 2 ** int(z)
    return OV.overlap_join(t, s, cell).select("z", "x", "y", "source_id")


# --------------------------------------------------------------------- Z1 chunk
def chunk(spark: SparkSession, sources: DataFrame, src_zoom: int, zoom: int, size: int, out: str,
          tiles: DataFrame | None = None, dtype: str = "f4", nodata=None,
          order=("priority", "tie"), bands: dict[int, str] | None = None) -> DataFrame:
    """Z1 for sources on the same Mercator grid family: keep the source pixels of listed tiles,
    paint the overlapping sources (A8), average onto the ``zoom`` grid (R1), pack, drop empty
    tiles (F1) and write (K1).  A ``band`` column of the sources is kept apart (R5); sources that hold a column per
    band (``bands``: {band: column}) keep their bands in one row until the tiles are packed."""
    SK.write_tiles(chunk_blocks(sources, 2 ** (src_zoom - zoom), zoom, size, tiles, dtype, nodata, order, bands), out)
    return RD.read_tiles(spark, out, z=zoom)


def chunk_blocks(sources: DataFrame, factor: int, zoom: int, size: int, tiles: DataFrame | None = None,
                 dtype: str = "f4", nodata=None, order=("priority", "tie"), bands: dict[int, str] | None = None) -> DataFrame:
    """The blocks Z1 writes.  The tile list meets the pixels before the mosaic's shuffles, so
    only pixels of listed tiles are painted and averaged."""
    keys = ("band",) if "band" in sources.columns else ()
    if tiles is not None:
        span = size * factor
        wanted = tiles.where(F.col("z") == zoom).select(F.col("x").cast("bigint").alias("_x"),
                                                        F.col("y").cast("bigint").alias("_y"))
        sources = (sources.select("*", F.floor(F.col("gx") / span).alias("_x"), F.floor(F.col("gy") / span).alias("_y"))
                          .join(wanted, ["_x", "_y"], "left_semi"))
    if bands is not None:
        avg = C.paint_and_average_wide(sources, bands, factor, order=order)
        return MO.band_tiles(avg, size, zoom, bands, dtype, nodata).where(F.col("valid_count") > 0)
    avg = C.paint_and_average(sources, factor, order=order, extra_keys=keys)
    return (B.pack_blocks(avg, size, zoom, dtype=dtype, nodata=nodata, band="band" if keys else 1, sparse=True)
             .where(F.col("valid_count") > 0))


def chunk_reproject(spark: SparkSession, sources: DataFrame, src: RP.Grid, zoom: int, size: int, out: str,
                    tiles: DataFrame | None = None, dtype: str = "f4", nodata=None,
                    order=("priority", "source_id"), paint_first: bool = True) -> DataFrame:
    """Z1 in block form: source blocks of any CRS and resolution (grid columns per source) onto the Mercator tiles of
    ``zoom``, empty tiles dropped (F1), written (K1).

    The sources are one raster first, as behind a virtual mosaic: painted by ``order`` on the finest source
    grid (A8, A9), which is then averaged (R1) once.  ``paint_first=False`` averages every source on its
    own and paints the results.  Only mosaic tiles that reach a listed tile are painted.
    """
    n = 2 ** zoom * size
    dst = RP.Grid("EPSG:3857", -grid.HALF_WORLD, grid.HALF_WORLD, grid.WORLD / n, grid.WORLD / n)
    if tiles is not None:
        tiles = tiles.where(F.col("z") == zoom)
    if paint_first:
        made, src = _mosaic(sources, src, size, order, tiles, dst, (n, n))
        made = RP.warp_blocks_crs(made, src, dst, size, zoom, "average", dtype, nodata, (), tiles, (n, n))
    else:
        made = RP.warp_blocks_crs(sources, src, dst, size, zoom, "average", dtype, nodata, order, tiles, (n, n))
    SK.write_tiles(made, out)
    return RD.read_tiles(spark, out, z=zoom)


def _mosaic(sources: DataFrame, src: RP.Grid, size: int, order, tiles: DataFrame | None, dst: RP.Grid, extent) -> tuple[DataFrame, RP.Grid]:
    """The mosaic's blocks and grid; with a list, only the blocks whose edges reach a listed tile."""
    whole, onto = RP.mosaic_blocks_crs(sources, src, size, order)
    if tiles is None:
        return whole, onto
    # the mosaic tiles that some source block can reach, each once, without a pixel
    held = sources.where(F.col("valid_count") > 0).select(
        "x", "y", "size", *[F.lit(v).alias(c) if not isinstance(v, str) else F.col(v).alias(c) for c, v in (("x0", src.x0), ("y0", src.y0), ("dx", src.dx), ("dy", src.dy))])
    span = onto.dx * size, onto.dy * size
    left, top = F.col("x0") + F.col("x") * F.col("size") * F.col("dx"), F.col("y0") - F.col("y") * F.col("size") * F.col("dy")
    across, down = F.col("size") * F.col("dx"), F.col("size") * F.col("dy")
    reach = held.select(F.floor((left - onto.x0) / span[0]).alias("i0"), F.floor((left + across - onto.x0) / span[0]).alias("i1"),
                        F.floor((onto.y0 - top) / span[1]).alias("j0"), F.floor((onto.y0 - top + down) / span[1]).alias("j1")).distinct()
    keys = (reach.select("j0", "j1", F.explode(F.sequence("i0", "i1")).alias("x"))
                 .select("x", F.explode(F.sequence("j0", "j1")).alias("y")).distinct())
    wanted = tiles.select(F.col("x").cast("int").alias("tx"), F.col("y").cast("int").alias("ty"))
    listed = RP.reached_tiles(keys, size, onto, dst, size, extent).join(wanted, ["tx", "ty"], "left_semi").select("x", "y").distinct()
    return RP.mosaic_blocks_crs(sources, src, size, order, listed)


# --------------------------------------------------------------------- Z2 pyramid
def pyramid(spark: SparkSession, store: str, zoom: int, min_zoom: int = 0, method: str = "nearest",
            tiles: DataFrame | None = None, levels_per_pass: int | None = None) -> DataFrame:
    """Build levels zoom-1 .. min_zoom from the tiles stored at ``zoom``."""
    base = RD.read_tiles(spark, store, z=zoom)
    first = base.select("size", "dtype").first()
    if first is None:
        return base
    return P.build_pyramid(spark, base, zoom, store, min_zoom=min_zoom, method=method,
                           levels_per_pass=levels_per_pass, size=first["size"], dtype=first["dtype"], tiles=tiles, base_stored=True)


# --------------------------------------------------------------------- Z3 / Z4 conversion
def missing_targets(listing: DataFrame, targets: DataFrame) -> DataFrame:
    """Archives in ``listing`` whose converted name is not in ``targets`` (path columns)."""
    src = listing.where(uris.is_archive("path")).select(F.col("path").alias("source"),
                                                        uris.target_name("path").alias("target"))
    done = targets.where(uris.is_tiff("path")).select(F.col("path").alias("target"))
    return src.join(done, "target", "left_anti").select("source", "target")


def convert(cells: DataFrame, ratio: float, method: str = "bilinear", keys=("source",)) -> DataFrame:
    """R2/R1/R4 per source (every band keyed), e.g. the 4326 conversion of Z3 (bilinear)
    or Z4 (average).  ``ratio``: source pixels per target pixel; an average over less than
    one source pixel is the pixel that holds the target's centre."""
    if method == "bilinear":
        return C.warp_bilinear(cells, ratio, extra_keys=keys)
    if method == "average":
        if ratio < 1:
            return C.warp_nearest(cells, ratio, extra_keys=keys)
        return C.resample_average(cells, ratio, extra_keys=keys)
    if method == "nearest":
        return C.warp_nearest(cells, ratio, extra_keys=keys)
    raise ValueError(method)


def default_4326_grid(fp: DataFrame) -> DataFrame:
    """P13 per source: the default EPSG:4326 output grid -- origin at the lon/lat box's
    upper-left corner, square pixels keeping the diagonal's pixel count."""
    ll = F.col("ll")
    dx, dy = ll["east"] - ll["west"], ll["north"] - ll["south"]
    res = F.sqrt(dx * dx + dy * dy) / F.sqrt(F.col("width").cast("double") ** 2 + F.col("height").cast("double") ** 2)
    return fp.select("source_id", ll["west"].alias("dst_x0"), ll["north"].alias("dst_y0"), res.alias("dst_res"))


def convert_missing(spark: SparkSession, listing: DataFrame, targets: DataFrame, source_cells: DataFrame,
                    rasters: DataFrame, src_crs: str, out: str, method: str = "bilinear") -> DataFrame:
    """Z3: archives not converted yet (J1) -> each reprojected to EPSG:4326 on its own default
    grid, every band (R2/R5) -> one output per source (K2) -> log with NULL for failures (K5).

    ``source_cells``: (source, band, gx, gy, v); ``rasters``: (source, source_id, a, c, e, f,
    width, height) -- the per-source affine (north up).
    """
    todo = missing_targets(listing, targets)
    meta = rasters.join(todo.select("source"), "source", "left_semi")
    grids = default_4326_grid(footprints(meta, src_crs)).join(meta.select("source", "source_id", "a", "c", "e", "f"),
                                                              "source_id")
    # grids exist only for sources still to do: the finished ones' pixels go before any is counted, dealt or moved;
    # salted because one source may hold a large share of all pixels
    px = salted_join(source_cells.join(grids.select("source").distinct(), "source", "left_semi"), grids.select("source", "a", "c", "e", "f", "dst_x0", "dst_y0", "dst_res"),
                     ["source"])
    px = px.withColumn("neg_e", -F.col("e"))
    conv = RP.warp_crs(px, RP.Grid(src_crs, "c", "f", "a", "neg_e"),
                       RP.Grid("EPSG:4326", "dst_x0", "dst_y0", "dst_res", "dst_res"), method,
                       extra_keys=("source", "band"))
    return write_converted_with_log(conv, todo, out)


def convert_missing_blocks(spark: SparkSession, listing: DataFrame, targets: DataFrame, blocks: DataFrame, rasters: DataFrame,
                           src_crs: str, out: str, size: int = 512, method: str = "bilinear", dtype: str = "f4",
                           nodata=-3.4028234663852886e38) -> DataFrame:
    """Z3/Z4 from blocks: archives not converted yet, each reprojected (bilinear, or average for Z4) onto its own default
    4326 grid, every band, as blocks of ``size`` pixels per target (K2), with the log (K5).

    ``blocks``: block columns and ``source``; ``rasters`` as in :func:`convert_missing`.  No pixel becomes a row; the
    per-source grid meets blocks by a join salted by the block's place.
    """
    todo = missing_targets(listing, targets)
    meta = rasters.join(todo.select("source"), "source", "left_semi")
    grids = default_4326_grid(footprints(meta, src_crs)).join(meta.select("source", "source_id", "a", "c", "e", "f"), "source_id")
    held = salted_join(blocks.where(B.block_error().isNull()), grids.select("source", "a", "c", F.col("f"), (-F.col("e")).alias("neg_e"), "dst_x0", "dst_y0", "dst_res"),
                       ["source"], salt_from=("x", "y"))
    made = RP.warp_blocks_crs(held, RP.Grid(src_crs, "c", "f", "a", "neg_e"), RP.Grid("EPSG:4326", "dst_x0", "dst_y0", "dst_res", "dst_res"),
                              size, 0, method, dtype, nodata, key="source")
    log = write_converted_with_log(made, todo, out)
    # F8: what could not be read is told per source (an aggregate over the block columns, beside the outputs)
    dead = (blocks.select("source", B.block_error().alias("error")).where(F.col("error").isNotNull())
            .groupBy("source").agg(F.count("*").alias("failed_blocks"), F.min("error").alias("error")))
    return log.join(dead, "source", "left").withColumn("failed_blocks", F.coalesce("failed_blocks", F.lit(0)))


def write_converted_with_log(converted: DataFrame, sources: DataFrame, out: str) -> DataFrame:
    """K2 + K5: write each source's output under its target name, return the log
    (source, output or NULL when the source produced nothing)."""
    # this run's rows, kept once in the shared folder: the log must not see outputs of earlier runs
    spark = converted.sparkSession
    named = converted.withColumn("target", uris.target_name("source")).drop("source")
    held = scratch_path(spark, "converted")
    named.write.parquet(held)
    named = spark.read.schema(named.schema).parquet(held)
    SK.write_converted(named, out, key="target")
    made = named.select("target").distinct().withColumn("ok", F.lit(True))
    sources = sources.select("source", uris.target_name("source").alias("target"))
    log = sources.join(made, "target", "left").select("source", F.coalesce("ok", F.lit(False)).alias("ok"))
    return SK.conversion_log(log)


def reproject_worklist(spark: SparkSession, worklist: str, cells: DataFrame, out: str, ratio: int = 2) -> DataFrame:
    """Sources named in a text work list, averaged per source, written per source."""
    wl = RD.read_work_list(spark, worklist)
    px = salted_join(cells, wl.distinct(), ["source"], how="left_semi")
    return write_converted_with_log(convert(px, ratio, "average"), wl, out)


def reproject_average(spark: SparkSession, worklist: str, cells: DataFrame, src: RP.Grid, dst: RP.Grid, out: str) -> DataFrame:
    """Sources named in a text work list, each reprojected with average (R1), written per source, logged."""
    wl = RD.read_work_list(spark, worklist).distinct()
    px = salted_join(cells, wl, ["source"], how="left_semi")
    return write_converted_with_log(RP.warp_crs(px, src, dst, "average", extra_keys=("source",)), wl, out)


def reproject_average_blocks(spark: SparkSession, worklist: str, blocks: DataFrame, src: RP.Grid, dst: RP.Grid, out: str,
                             size: int = 512, dtype: str = "f4", nodata=-3.4028234663852886e38) -> DataFrame:
    """Z4 from blocks (block columns and ``source``): the sources of a text work list averaged onto ``dst``, as
    blocks of ``size`` pixels per target, logged.  Only partial sums per target tile are shuffled."""
    wl = RD.read_work_list(spark, worklist).distinct()
    held = salted_join(blocks.where(B.block_error().isNull()), wl, ["source"], how="left_semi", salt_from=("x", "y"))
    return write_converted_with_log(RP.warp_blocks_crs(held, src, dst, size, 0, "average", dtype, nodata, key="source"), wl, out)


# --------------------------------------------------------------------- Z6-Z9 terrain
def shade_tiles(spark: SparkSession, store: str, zoom: int, out: str, method: str = "zfactor",
                buffer: int = 2, h=2.0) -> DataFrame:
    """Shade every stored tile with a ``buffer``-pixel halo from its neighbours, crop, write (K3)."""
    sh = H.shade_blocks(RD.read_tiles(spark, store, z=zoom), method, buffer=buffer, h=h)
    SK.write_shade(sh, out)
    return RD.read_tiles(spark, out, z=zoom)


def shade_rgba(cells: DataFrame, size: int, buffer: int = 2, h: float = 1.0) -> DataFrame:
    """Light-source shade per buffered tile, colour ramp stretched over the window, cropped."""
    from pyspark.sql import Window
    s = C.shade_tiles_light(cells, size, buffer=buffer, h=h, crop_output=False)
    w = Window.partitionBy("tx", "ty")
    s = s.select("*", F.min("shade").over(w).alias("hmin"), F.max("shade").over(w).alias("hmax"))
    s = C.crop(s, size).select("tx", "ty", "gx", "gy", "shade", TR.ramp_index("shade", "hmin", "hmax").alias("idx"))
    return s.select("tx", "ty", "gx", "gy", "shade",
                    *[TR.ramp_channel("idx", TR.RAMP[ch]).alias(ch) for ch in ("r", "g", "b", "a")])


def compare_shades(cells: DataFrame, h: float = 2.0, pixel: float = 1.0) -> DataFrame:
    """Naive, z-factor (gradient spacing ``h``) and light-source (spacing ``pixel``,
    whole-raster stretch) shades of one raster, side by side, from one gradient pass."""
    g = C.gradient(cells, h, h)
    k = h / pixel
    g = g.select("gx", "gy", TR.hillshade_naive("a", "b").alias("naive"),
                 TR.hillshade_zfactor("a", "b").alias("zfactor"),
                 TR.light_intensity(F.col("a") * k, F.col("b") * k).alias("i"))
    stats = g.agg(F.min("i").alias("imin"), F.max("i").alias("imax"))      # one row
    imin, imax = stats.select("imin").scalar(), stats.select("imax").scalar()   # merged by Catalyst
    return g.select("gx", "gy", "naive", "zfactor", TR.quantise(TR.stretch("i", imin, imax)).alias("light"))


def compare_shades_blocks(spark: SparkSession, store: str, zoom: int, buffer: int = 2, h: float = 2.0, pixel: float = 1.0) -> DataFrame:
    """Z9 from stored tiles: bands 1 naive, 2 z-factor, 3 light stretched over the whole raster."""
    return H.compare_blocks(RD.read_tiles(spark, store, z=zoom), scratch_path(spark, "compare"), buffer, h, pixel)


def raster_stats(spark: SparkSession, blocks: DataFrame, band: int = 1) -> DataFrame:
    """(x, y, n, vmin, vmax, mean, m2) per tile and, with null x and y, of the whole raster: one row of
    moments per block, merged; no pixel becomes a row."""
    held = scratch_path(spark, "moments")
    B.block_moments(blocks.where(F.col("band") == band)).write.parquet(held)
    each = spark.read.parquet(held)
    whole = B.merge_moments(each).select(F.lit(None).cast("int").alias("x"), F.lit(None).cast("int").alias("y"), "n", "vmin", "vmax", "mean", "m2")
    return B.merge_moments(each, ("x", "y")).unionByName(whole)


def missing_from_storage(spark: SparkSession, listing: DataFrame, out: str) -> DataFrame:
    """S7 + J1: archives of ``listing`` whose output is not among the files below ``out`` (one folder per target, K2).

    The folder is listed by Spark, file contents unread; an output counts if one of its files holds a byte.
    """
    done = RD.list_objects(spark, out, "*.parquet").where(F.col("length") > 0).select(RD.partition_value("path", "target").alias("path")).distinct()
    return missing_targets(listing, done)


def serve_view(blocks: DataFrame, requested: DataFrame, size: int, dtype: str = "f4") -> DataFrame:
    """The tile-service view: requested tiles, stored ones or zero blocks (ZeroBlock codes)."""
    return RD.read_tms(blocks, requested, size, dtype)


# --------------------------------------------------------------------- Z10 reblock
def reblock(cells_or_strips: DataFrame, width: int, size: int, zoom: int, dtype: str = "f4",
            nodata=None, strips: bool = False) -> DataFrame:
    """Strip-organised rows -> square blocks, one shuffle on the new block key."""
    st = cells_or_strips if strips else B.pack_strips(cells_or_strips, width, dtype=dtype, nodata=nodata)
    return B.reblock_strips(st, size, zoom)
