"""Block form equals cell form (pack/unpack, pyramid, halo shading, reblock)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks as B, cells as C, halo as H, pyramid as P
from tessera.session import scratch_path
from tessera.sources import sinks as SK


def _raster(spark, w, h, gap=0.3, seed=1, ints=True):
    rng = np.random.default_rng(seed)
    rows = []
    for gy in range(h):
        for gx in range(w):
            if rng.random() < gap:
                rows.append((gx, gy, None))
            else:
                rows.append((gx, gy, float(rng.integers(0, 10_000)) if ints else float(rng.normal(100, 30))))
    return spark.createDataFrame(rows, "gx long, gy long, v double")


def _cells(df):
    return sorted((r.gx, r.gy, r.v) for r in df.collect())


def test_pack_unpack_roundtrip(spark):
    cells = _raster(spark, 40, 37, gap=0.4)
    blk = B.pack_blocks(cells, 16, 5, dtype="f8", nodata=-9999.0)
    assert blk.count() == 9
    out = B.unpack_blocks(blk).select("gx", "gy", "v")
    assert _cells(out) == _cells(cells.where(F.col("v").isNotNull()))
    # valid_count is stored per block
    vc = {(r.x, r.y): r.valid_count for r in blk.collect()}
    exp = {(r.x, r.y): r.n for r in cells.where(F.col("v").isNotNull())
           .groupBy((F.col("gx") / 16).cast("int").alias("x"), (F.col("gy") / 16).cast("int").alias("y"))
           .agg(F.count("*").alias("n")).collect()}
    assert vc == exp


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_block_pyramid_equals_cell_pyramid(spark, levels):
    cells = _raster(spark, 64, 48, gap=0.6, seed=levels)
    blk = B.pack_blocks(cells, 8, 4, dtype="f8", nodata=-1.0).where(F.col("valid_count") > 0)
    store = scratch_path(spark, "t-pyr")
    pyr = P.build_pyramid(spark, blk, 4, store, method="nearest", levels_per_pass=levels)
    got = B.unpack_blocks(pyr).select(F.col("z").cast("bigint").alias("z"), "gx", "gy", "v")
    exp = C.pyramid_nearest(cells, 4)
    assert sorted(got.collect()) == sorted(exp.select("z", "gx", "gy", F.col("v").cast("double")).collect())
    # no all-nodata tile is stored at any level
    assert pyr.where(F.col("valid_count") == 0).count() == 0

    store2 = scratch_path(spark, "t-pyra")
    pa = P.build_pyramid(spark, blk, 4, store2, method="average", levels_per_pass=levels)
    ga = B.unpack_blocks(pa, weighted=True).select(F.col("z").cast("bigint").alias("z"), "gx", "gy", "wsum", "wcount")
    ea = C.pyramid_average(cells, 4).select("z", "gx", "gy", F.col("vsum").alias("wsum"), F.col("vcount").alias("wcount"))
    assert sorted(ga.collect()) == sorted(ea.collect())


@pytest.mark.parametrize("method", ["naive", "zfactor"])
def test_halo_shading_equals_whole_raster(spark, method):
    cells = _raster(spark, 45, 30, gap=0.0, seed=7, ints=False)
    blk = B.pack_blocks(cells, 16, 3, dtype="f8", nodata=-1e30)
    got = H.unpack_shade(H.shade_blocks(blk, method, buffer=2, h=2.0))
    exp = C.shade(cells, method, h=2.0)
    assert sorted(got.select("gx", "gy", F.col("shade").cast("bigint")).collect()) == \
        sorted(exp.select("gx", "gy", F.col("shade").cast("bigint")).collect())


def test_light_shading_blocks_match_cells(spark):
    cells = _raster(spark, 40, 40, gap=0.0, seed=3, ints=False)
    blk = B.pack_blocks(cells, 16, 3, dtype="f8", nodata=-1e30)
    got = H.unpack_shade(H.shade_blocks(blk, "light", buffer=2, h=1.0))
    exp = C.shade_tiles_light(cells, 16, buffer=2, h=1.0)
    a = {(r.gx, r.gy): int(r.shade) for r in got.collect()}
    b = {(r.gx, r.gy): int(r.shade) for r in exp.collect()}
    assert a == b


def test_reblock_strips_is_identity(spark):
    cells = _raster(spark, 50, 21, gap=0.2, seed=5)
    st = B.pack_strips(cells, 50, dtype="f8", nodata=-5.0)
    assert st.count() == 21
    sq = B.reblock_strips(st, 16, 7)
    assert _cells(B.unpack_blocks(sq).select("gx", "gy", "v")) == _cells(cells.where(F.col("v").isNotNull()))


def test_map_and_fold_blocks(spark):
    cells = _raster(spark, 32, 32, gap=0.1, seed=9)
    blk = B.pack_blocks(cells, 16, 3, dtype="f8", nodata=-1.0)
    doubled = B.map_blocks(blk, lambda a: a * 2)
    got = _cells(B.unpack_blocks(doubled).select("gx", "gy", "v"))
    exp = sorted((r.gx, r.gy, r.v * 2) for r in cells.where(F.col("v").isNotNull()).collect())
    assert got == exp

    def count_kernel(key, rows):
        n = sum(r["valid_count"] for r in rows)
        a = np.full((16, 16), float(n))
        return [B.block_record(2, key[0], key[1], 1, 16, "f8", None, a, 256)]
    folded = B.fold_blocks(blk, [F.col("x") % 1, F.col("y") % 1], count_kernel)
    assert folded.count() == 1 and B.block_stats(folded).first().vmax == float(cells.where(F.col("v").isNotNull()).count())


def test_tile_store_replaces_tiles_by_key(spark):
    cells = _raster(spark, 32, 32, gap=0.1, seed=11)
    blk = B.pack_blocks(cells, 16, 5, dtype="f4", nodata=-1.0)
    store = scratch_path(spark, "t-store")
    SK.write_tiles(blk, store)
    SK.write_tiles(blk.withColumn("z", F.lit(4)).where((F.col("x") == 0) & (F.col("y") == 0)), store)
    SK.write_tiles(blk.withColumn("z", F.lit(4)).where((F.col("x") == 1) & (F.col("y") == 1)), store)
    df = spark.read.parquet(store)
    assert df.where("z = 5").count() == 4          # untouched by the level-4 rewrites
    assert df.where("z = 4").count() == 2          # a second area is added, nothing is lost
    SK.write_tiles(blk.withColumn("z", F.lit(4)).where((F.col("x") == 1) & (F.col("y") == 1))
                   .withColumn("valid_count", F.lit(7).cast("int")), store)
    again = spark.read.parquet(store).where("z = 4")
    assert again.count() == 2 and again.where("valid_count = 7").count() == 1      # same key: replaced


@pytest.mark.parametrize("method,ratio", [("bilinear", 0.75), ("bilinear", 1.25), ("nearest", 1.5), ("nearest", 0.5),
                                          ("bilinear", 12.5), ("nearest", 200.0)])
def test_block_warp_equals_cell_warp(spark, method, ratio):
    from tessera.operators import warp as WP
    cells = _raster(spark, 50, 41, gap=0.35, seed=13)
    blk = B.pack_blocks(cells, 16, 4, dtype="f8", nodata=-1e30).where(F.col("valid_count") > 0)
    got = B.unpack_blocks(WP.warp_blocks(blk, ratio, 16, 4, method)).select("gx", "gy", "v")
    exp = (C.warp_bilinear(cells, ratio) if method == "bilinear" else C.warp_nearest(cells, ratio))
    assert _cells(got) == _cells(exp.select("gx", "gy", F.col("v").cast("double")))


@pytest.mark.parametrize("method,step", [("bilinear", 0.0004), ("nearest", 0.0004), ("average", 0.0011), ("average", 0.0001)])
def test_utm_block_warp_equals_cell_warp(spark, method, step):
    """The source grid is read from columns; a step of 0.0001 degrees is finer than the source, 0.0011 coarser."""
    from tessera.operators.reproject import Grid, warp_blocks_crs, warp_crs
    src = Grid("UTM:10", "x0", "y0", "res", "res")
    dst = Grid("EPSG:4326", -123.0, 37.99, step, step)
    grids = [F.lit(v).alias(k) for k, v in (("x0", 500500.0), ("y0", 4205000.0), ("res", 30.0))]
    cells = _raster(spark, 24, 20, gap=0.2, seed=21)
    blk = B.pack_blocks(cells, 8, 0, dtype="f8", nodata=-1e30).select("*", *grids)
    got = {(r.gx, r.gy): r.v for r in B.unpack_blocks(warp_blocks_crs(blk, src, dst, 16, 0, method)).collect()}
    exp = {(r.gx, r.gy): r.v for r in warp_crs(cells.select("*", *grids), src, dst, method).collect()}
    assert got.keys() == exp.keys() and len(got) >= 20      # the coarsest grid has 24 pixels in all
    assert all(abs(got[k] - exp[k]) < 1e-6 for k in got)


def test_bulging_block_edges_reach_every_target_tile(spark):
    """1000 m pixels far from the meridian: a block's straight edge is a curve in lon/lat."""
    from tessera.operators.reproject import Grid, warp_blocks_crs, warp_crs
    src, dst = Grid("UTM:10", 300000.0, 5100000.0, 1000.0, 1000.0), Grid("EPSG:4326", -125.8, 46.2, 0.01, 0.01)
    cells = spark.range(96 * 64).select((F.col("id") % 96).alias("gx"), F.floor(F.col("id") / 96).alias("gy"),
                                        F.col("id").cast("double").alias("v"))
    blk = B.pack_blocks(cells, 32, 0, dtype="f8", nodata=-1e30)
    got = _cells(B.unpack_blocks(warp_blocks_crs(blk, src, dst, 8, 0, "nearest")))
    assert got == _cells(warp_crs(cells, src, dst, "nearest"))


def test_sources_are_painted_after_each_was_averaged(spark):
    from tessera.operators.reproject import Grid, warp_blocks_crs
    rows = [(sid, i % 4, i // 4, float(sid)) for sid in range(1, 31) for i in range(16) if sid < 30 or i % 4 < 2]
    cells = spark.createDataFrame(rows, "sid int, gx long, gy long, v double")
    blk = None
    for sid in range(1, 31):
        b = B.pack_blocks(cells.where(F.col("sid") == sid), 4, 0, dtype="f4", nodata=-1.0).withColumn("sid", F.lit(sid))
        blk = b if blk is None else blk.unionByName(b)
    plane = Grid("EPSG:3857", 0.0, 0.0, 1.0, 1.0)
    out = warp_blocks_crs(blk.coalesce(2), plane, Grid("EPSG:3857", 0.0, 0.0, 2.0, 2.0), 2, 0, "average", "i2", -1.0, ("sid",))
    assert _cells(B.unpack_blocks(out)) == [(0, 0, 30), (0, 1, 30), (1, 0, 29), (1, 1, 29)]
    none = warp_blocks_crs(blk.where("sid < 0"), plane, plane, 4, 0, "average")
    assert none.count() == 0


def test_tile_list_is_joined_before_the_partial_sums_are_shuffled(spark):
    from tessera.operators.reproject import Grid, warp_blocks_crs
    plane = Grid("EPSG:3857", 0.0, 0.0, 1.0, 1.0)
    blk = B.pack_blocks(_raster(spark, 40, 40), 8, 0, dtype="f8", nodata=-1.0)
    tiles = spark.createDataFrame([(1, 2)], "x int, y int")
    out = warp_blocks_crs(blk, plane, plane, 8, 0, "nearest", tiles=tiles)
    assert [(r.x, r.y) for r in out.collect()] == [(1, 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("LeftSemi")


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_utm_to_4326_scatter_equals_gather(spark, method):
    from tessera.functions import crs
    from tessera.operators.reproject import Grid, warp_crs
    src = Grid("UTM:10", 500500.0, 4205000.0, 30.0, 30.0)
    dst = Grid("EPSG:4326", -123.0, 37.99, 0.0004, 0.0003)
    cells = _raster(spark, 24, 20, gap=0.2, seed=21)
    got = warp_crs(cells, src, dst, method)
    # gather: every target pixel in a generous range, inverse-projected, read from the source
    t = spark.range(0, 40).select(F.col("id").alias("ti")).crossJoin(spark.range(0, 40).select(F.col("id").alias("tj")))
    t = t.select("ti", "tj", (dst.x0 + (F.col("ti") + 0.5) * dst.dx).alias("X"),
                 (dst.y0 - (F.col("tj") + 0.5) * dst.dy).alias("Y"))
    e, n = crs.lonlat_to_utm("X", "Y", 10)
    t = t.select("ti", "tj", ((e - src.x0) / src.dx - 0.5).alias("sx"), ((src.y0 - n) / src.dy - 0.5).alias("sy"))
    valid = cells.where(F.col("v").isNotNull())
    if method == "nearest":
        exp = t.join(valid, (F.floor(F.col("sx") + 0.5) == F.col("gx")) & (F.floor(F.col("sy") + 0.5) == F.col("gy"))) \
               .select(F.col("ti").alias("gx"), F.col("tj").alias("gy"), "v")
        assert _cells(got) == _cells(exp)
    else:
        nb = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "ox int, oy int")
        j = t.crossJoin(nb).select("ti", "tj", "sx", "sy", (F.floor("sx") + F.col("ox")).alias("gx"),
                                   (F.floor("sy") + F.col("oy")).alias("gy"), "ox", "oy")
        j = j.join(valid, ["gx", "gy"]).select("ti", "tj", "v", (
            F.when(F.col("ox") == 0, 1 - (F.col("sx") - F.floor("sx"))).otherwise(F.col("sx") - F.floor("sx")) *
            F.when(F.col("oy") == 0, 1 - (F.col("sy") - F.floor("sy"))).otherwise(F.col("sy") - F.floor("sy"))).alias("w"))
        exp = j.where("w > 0").groupBy("ti", "tj").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))
        a = {(r.gx, r.gy): r.v for r in got.collect()}
        b = {(r.ti, r.tj): r.v for r in exp.collect()}
        assert a.keys() == b.keys() and len(a) > 100
        assert all(abs(a[k] - b[k]) <= 1e-6 * max(1.0, abs(b[k])) for k in a)


def test_pyramid_parents_come_from_the_list(spark):
    cells = _raster(spark, 32, 32, gap=0.0, seed=17)
    blk = B.pack_blocks(cells, 8, 3, dtype="f8", nodata=-1.0)           # 4 x 4 tiles at z3
    listed = spark.createDataFrame([(3, 0, 0), (3, 3, 3)], "z int, x int, y int")
    store = scratch_path(spark, "t-list-pyr")
    pyr = P.build_pyramid(spark, blk, 3, store, method="nearest", tiles=listed)
    keys = sorted((r.z, r.x, r.y) for r in pyr.where("z < 3").collect())
    assert keys == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (2, 1, 1)]
    # a listed parent still merges its unlisted stored children: z2 (0,0) has all four quadrants
    z2 = [r for r in pyr.collect() if (r.z, r.x, r.y) == (2, 0, 0)][0]
    assert z2.valid_count == 64


def test_block_paint_equals_cell_paint_on_a_hot_tile(spark):
    from tessera.operators import mosaic as MO
    rng = np.random.default_rng(5)
    rows = []
    for src in range(40):                      # 40 overlapping sources, all on the same 2 tiles
        prio, tie = int(rng.integers(0, 5)), int(rng.integers(0, 3))
        for gx in range(16):
            for gy in range(8):
                if rng.random() < 0.7:
                    rows.append((gx, gy, prio, tie, int(rng.integers(0, 50))))
    cells = spark.createDataFrame(rows, "gx long, gy long, priority int, tie long, v long")
    got = B.unpack_blocks(MO.paint_blocks(cells, 8, 5, share=50)).select("gx", "gy", F.col("v").cast("long").alias("v"))
    exp = C.mosaic_paint(cells)
    assert sorted(got.collect()) == sorted(exp.collect())


def test_pick_parity_and_unmasked_blocks(spark):
    cells = _raster(spark, 32, 32, gap=0.0, seed=23)
    blk = B.pack_blocks(cells, 8, 2, dtype="f8", nodata=-1.0)
    pyr = P.build_pyramid(spark, blk, 2, scratch_path(spark, "t-pick"), min_zoom=1, pick=(0, 0))
    got = B.unpack_blocks(pyr.where("z = 1")).select("gx", "gy", "v")
    exp = C.decimate(cells, pick=0)
    assert _cells(got) == _cells(exp)
    # nodata NULL: nothing masked, every pixel counts and unpacks (missing ones as 0)
    sparse = _raster(spark, 8, 8, gap=0.5, seed=2)
    nb = B.pack_blocks(sparse, 8, 1, dtype="f4", nodata=None)
    assert nb.first().valid_count == 64 and B.unpack_blocks(nb).count() == 64


def test_halo_with_buffer_equal_to_tile_size(spark):
    cells = _raster(spark, 24, 16, gap=0.0, seed=31, ints=False)
    blk = B.pack_blocks(cells, 4, 3, dtype="f8", nodata=-1e30)
    got = H.unpack_shade(H.shade_blocks(blk, "zfactor", buffer=4, h=2.0))
    exp = C.shade(cells, "zfactor", h=2.0)
    assert sorted(got.select("gx", "gy", F.col("shade").cast("bigint")).collect()) == \
        sorted(exp.select("gx", "gy", F.col("shade").cast("bigint")).collect())


@pytest.mark.parametrize("dtype,nodata", [("u1", 0.0), ("i2", -1.0), ("f4", -1.0), ("f8", None)])
def test_averaged_store_reads_as_means(spark, dtype, nodata):
    value = 200.0 if dtype == "u1" else 20000.0
    cells = spark.range(16 * 16).select((F.col("id") % 16).alias("gx"), F.floor(F.col("id") / 16).alias("gy"),
                                        F.lit(value).alias("v"))
    blk = B.pack_blocks(cells, 4, 2, dtype=dtype, nodata=nodata)
    pyr = P.build_pyramid(spark, blk, 2, scratch_path(spark, "t-mean"), method="average")
    for r in B.block_stats(pyr).collect():
        assert (r.vmin, r.vmax, r.vsum) == (value, value, 16 * value)
    assert {r.v for r in B.unpack_blocks(pyr).select("v").distinct().collect()} == {value}
    top = B.unpack_blocks(pyr.where("z = 0"), weighted=True)
    assert {(r.wsum, r.wcount) for r in top.collect()} == {(16 * value, 16)}
    doubled = B.map_blocks(pyr, lambda a: a / 2)
    assert B.block_stats(doubled).agg(F.max("vmax")).first()[0] == value / 2


def test_siblings_with_their_own_nodata_and_dtype(spark):
    a = B.block_record(1, 0, 0, 1, 2, "i2", -1.0, np.array([[-1, 5], [-9, -9]]), 3)
    b = B.block_record(1, 1, 0, 1, 2, "f4", -9.0, np.array([[-9.0, -1.0], [2.5, -1.0]]), 3)
    blk = spark.createDataFrame([tuple(r[c] for c in B.BLOCK_COLUMNS) for r in (a, b)], B.BLOCK_SCHEMA)
    top = P.pyramid_pass(blk, 1, "nearest")
    assert top.first().valid_count == 2
    assert sorted((r.gx, r.gy, r.v) for r in B.unpack_blocks(top).collect()) == [(0, 0, -9.0), (1, 0, -1.0)]
    avg = B.unpack_blocks(P.pyramid_pass(blk, 1, "average"))
    assert sorted((r.gx, r.v) for r in avg.collect()) == [(0, float(np.float32(-13 / 3))), (1, float(np.float32(0.5 / 3)))]   # stored as f4


def test_layout_keeps_every_valid_value():
    assert B.joint_layout([("i2", (-1.0,)), ("f4", (-9.0, None))]) == ("f4", (-9.0, -1.0))
    assert B.fit_layout(np.array([-9.0, 4.0]), "i2", (-9.0, -1.0)) == ("i2", -1.0)
    assert B.fit_layout(np.array([4.0, np.nan]), "u1", (-9.0, 0.0)) == ("u1", 0.0)
    dtype, nodata = B.fit_layout(np.array([-9.0, -1.0]), "i2", (-9.0, -1.0))
    assert dtype == "f8" and np.isnan(nodata)


def test_paint_and_pack_carry_one_row_per_pixel():
    import pyarrow as pa
    from tessera.operators import mosaic as MO
    n2, batches = 16, 40
    rng = np.random.default_rng(3)
    rows = sorted((int(o), int(rng.integers(0, 9)), s, float(rng.integers(0, 99))) for s in range(200) for o in range(n2))
    off, p, t, v = (np.array(c) for c in zip(*rows))
    zero = np.zeros(len(off), dtype=np.int32)
    whole = pa.RecordBatch.from_pydict({"x": zero, "y": zero, "band": zero, "salt": zero.astype(np.int64), "off": off.astype(np.int32),
                                        "p": p, "t": t, "v": v})
    step = len(off) // batches
    sizes = []
    keep = B.last_of_runs

    def spy(cols, key):
        out = keep(cols, key)
        sizes.append(len(out[0]))
        return out
    B.last_of_runs = spy
    try:
        cut = list(MO._paint_sorted((whole.slice(i, step) for i in range(0, len(off), step)), 4, 3))
    finally:
        B.last_of_runs = keep
    one = list(MO._paint_sorted([whole], 4, 3))
    assert [b.to_pydict() for b in cut] == [b.to_pydict() for b in one]
    assert len(sizes) == batches and max(sizes) <= n2


def test_duplicate_pixels_keep_the_greatest_value(spark):
    cells = spark.range(4000).select((F.col("id") % 4).alias("gx"), F.lit(0).cast("long").alias("gy"),
                                     (F.col("id") * 7919 % 4001).cast("double").alias("v"))
    got = B.unpack_blocks(B.pack_blocks(cells.repartition(5), 4, 1, nodata=-1.0))
    exp = cells.groupBy("gx", "gy").agg(F.max("v").alias("v"))
    assert _cells(got) == _cells(exp)


def test_halo_wider_than_a_tile_is_refused(spark):
    blk = B.pack_blocks(_raster(spark, 8, 8, gap=0.0), 4, 1, nodata=-1.0)
    with pytest.raises(Exception, match="wider than a tile"):
        H.shade_blocks(blk, "zfactor", buffer=5).count()
