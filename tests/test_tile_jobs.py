"""Window chain, keyed store, paint before average, conversion from blocks, measured skew, failures as rows,
folding by a list, whole-raster stretch, mergeable moments, listing of storage."""

import glob
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import grid
from tessera.operators import blocks as B, halo as H, mosaic as MO, pyramid as P, reproject as RP, skew as SW, windows as WN
from tessera.plans import jobs as J
from tessera.session import local_path, scratch_path
from tessera.sources import readers as RD, sinks as SK

NODATA = -9999.0


def _blocks(spark, planes, dtype="f4", nodata=NODATA):
    """{(z, x, y[, band]): 2-D float array with NaN} -> block rows."""
    recs = []
    for key, vals in planes.items():
        z, x, y, band = (*key, 1)[:4]
        arr, valid = B.from_float(np.asarray(vals, np.float64), dtype, nodata)
        recs.append(B.block_record(z, x, y, band, len(vals), dtype, nodata, arr, valid))
    return spark.createDataFrame([tuple(r[c] if not isinstance(r[c], bytes) else bytearray(r[c]) for c in B.BLOCK_COLUMNS) for r in recs], B.BLOCK_SCHEMA)


def _raster(h, w, seed, gap=0.0):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(500, 60, (h, w))).astype(np.float64)
    v[rng.random((h, w)) < gap] = np.nan
    return v


def _tiles_of(v, size, z):
    return {(z, x, y): v[y * size:(y + 1) * size, x * size:(x + 1) * size]
            for y in range(v.shape[0] // size) for x in range(v.shape[1] // size)}


def _planes(df):
    return {(r["z"], r["x"], r["y"], r["band"]): B.row_values(r.asDict()) for r in df.collect()}


# ---- windows ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("dz, scale", [(1, 1.0), (0, 2.0), (-1, 4.0), (2, 0.5)])
def test_windows_of_a_512_level_for_256_tiles(spark, dz, scale):
    src_zoom, buffer = 2, 2
    v = _raster(1024, 1024, 3, gap=0.05)                                    # the upper left 2 x 2 of 4 x 4 tiles
    blocks = _blocks(spark, _tiles_of(v, 512, src_zoom))
    z = src_zoom + dz
    n = int(1024 / scale / 256)
    tiles = spark.createDataFrame([(z, x, y) for x in range(n + 1) for y in range(n)], "z int, x int, y int")
    got = _planes(WN.read_windows(blocks, tiles, src_zoom, 512, 256, buffer))
    at = np.arange(-buffer, 256 + buffer) + 0.5
    assert len(got) >= n * n
    for x in range(n):
        for y in range(n):
            rows, cols = (np.floor((256 * k + at) * scale).astype(int) for k in (y, x))
            want = np.full((260, 260), np.nan)
            ri, ci = (np.flatnonzero((k >= 0) & (k < 1024)) for k in (rows, cols))
            want[np.ix_(ri, ci)] = v[np.ix_(rows[ri], cols[ci])]
            np.testing.assert_array_equal(got[(z, x, y, 1)], want)


def test_shaded_windows_equal_the_shade_of_the_decimated_raster(spark):
    v = _raster(128, 128, 5)
    blocks = _blocks(spark, _tiles_of(v, 64, 4))
    tiles = spark.createDataFrame([(4, x, y) for x in range(4) for y in range(4)], "z int, x int, y int")
    got = _planes(WN.shade_windows(blocks, tiles, 4, 64, 32, "zfactor", pixel=(1.5, 2.0)))
    half = v[1::2, 1::2]
    want = H.shade_zfactor(H.masked_gradient(half, 4.0, 0), H.masked_gradient(half, 3.0, 1))
    assert len(got) == 4                                                     # tiles beyond the raster give nothing
    for (_, x, y, _), plane in got.items():
        np.testing.assert_array_equal(plane, want[32 * y:32 * y + 32, 32 * x:32 * x + 32])


def test_window_chain_never_unpacks(spark):
    blocks = _blocks(spark, _tiles_of(_raster(64, 64, 6), 32, 3))
    tiles = spark.createDataFrame([(3, 0, 0)], "z int, x int, y int")
    plan = WN.shade_windows(blocks, tiles, 3, 32, 32)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("FlatMapGroupsInArrow") == 1        # slice, assemble, shade
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_windows_of_several_bands_and_empty_inputs(spark):
    a, b = _raster(32, 32, 7), _raster(32, 32, 8)
    blocks = _blocks(spark, {(1, 0, 0, 1): a, (1, 0, 0, 2): b})
    tiles = spark.createDataFrame([(1, 0, 0), (1, 0, 0)], "z int, x int, y int")
    got = _planes(WN.read_windows(blocks, tiles, 1, 32, 32))
    np.testing.assert_array_equal(got[(1, 0, 0, 1)], a)
    np.testing.assert_array_equal(got[(1, 0, 0, 2)], b)
    assert WN.read_windows(blocks.where("false"), tiles, 1, 32, 32).count() == 0
    assert WN.read_windows(blocks, tiles.where("false"), 1, 32, 32).count() == 0


# ---- keyed store ----------------------------------------------------------------------------------------------------

def _files(store):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local_path(store)}/z=*/bucket=*/*.parquet")}


def test_adding_one_tile_rewrites_one_bucket(spark):
    store = scratch_path(spark, "t-buckets")
    z = 6
    planes = {(z, x, y): np.full((4, 4), 100.0 * x + y) for x in range(0, 64, 3) for y in range(0, 64, 5)}
    SK.write_tiles(_blocks(spark, planes), store)
    before = _files(store)
    folders = {os.path.dirname(f) for f in before}
    assert len(folders) == 64                                               # 8 x 8 ancestors three levels up
    SK.write_tiles(_blocks(spark, {(z, 1, 1): np.full((4, 4), 7.0), (z, 0, 0): np.full((4, 4), 9.0)}), store)
    after = _files(store)
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert [os.path.basename(c) for c in changed] == ["bucket=q000"]
    got = _planes(RD.read_tiles(spark, store, z=z))
    assert len(got) == len(planes) + 1 and got[(z, 0, 0, 1)][0, 0] == 9.0 and got[(z, 1, 1, 1)][0, 0] == 7.0
    assert got[(z, 3, 5, 1)][0, 0] == 305.0                                 # same bucket, kept
    SK.write_tiles(_blocks(spark, {(2, 0, 0): np.ones((4, 4))}), store)     # a new level leaves the others alone
    assert {k: v for k, v in _files(store).items() if "/z=6/" in k} == after


def test_a_tile_read_opens_the_files_of_its_prefix(spark):
    store = scratch_path(spark, "t-prefix")
    SK.write_tiles(_blocks(spark, {(6, x, y): np.full((4, 4), x + y + 1.0) for x in range(0, 64, 4) for y in range(0, 64, 4)}), store)
    one = RD.read_tile(spark, store, 6, 20, 40)
    assert [B.row_values(r.asDict())[0, 0] for r in one.collect()] == [61.0]
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    key = spark.range(1).select(P.tile_bucket(F.lit(20), F.lit(40), F.lit(6))).first()[0]
    assert scan.metrics().get("numFiles").get().value() == len([f for f in _files(store) if f"/bucket={key}/" in f]) <= 2
    assert RD.read_tile(spark, store, 6, 21, 40).count() == 0
    listed = spark.createDataFrame([(6, 20, 40), (6, 0, 0), (6, 1, 0)], "z int, x int, y int")
    assert {(r.x, r.y) for r in RD.read_tiles(spark, store, listed).collect()} == {(20, 40), (0, 0)}


def test_tiles_lie_in_quadkey_order_in_their_files(spark):
    store = scratch_path(spark, "t-order")
    SK.write_tiles(_blocks(spark, {(5, x, y): np.ones((2, 2)) for x in range(8) for y in range(8)}).repartition(5), store)
    for f in _files(store):
        keys = [r[0] for r in spark.read.parquet(f).withColumn("z", F.lit(5)).select(grid.quadkey("x", "y", "z")).collect()]
        assert keys == sorted(keys)


# ---- pyramid with a list ----------------------------------------------------------------------------------------------

def _one_level_at_a_time(planes, listed, base, size, method):
    """The plain rule: level after level, parents of the list, content from what was built."""
    out, level, cur = dict(planes), base, dict(planes)
    known = set(listed)
    while level > 0:
        level, known, nxt = level - 1, {(x >> 1, y >> 1) for x, y in known}, {}
        for px, py in known:
            kids = [(x, y, v, None) for (z, x, y), v in cur.items() if (x >> 1, y >> 1) == (px, py)]
            if kids:
                vals, _ = P._merge_children(kids, size, method)
                if not np.isnan(vals).all():
                    nxt[(level, px, py)] = vals
        out.update(nxt)
        cur = nxt
    return out


@pytest.mark.parametrize("levels", [1, 2, 3, None])
def test_listed_pyramid_is_the_same_however_many_levels_are_folded(spark, levels):
    rnd = random.Random(2)
    planes = {(5, x, y): _raster(8, 8, 40 * x + y, gap=0.3) for x in range(20) for y in range(20) if rnd.random() < 0.5}
    listed = [(x, y) for x in range(22) for y in range(20) if rnd.random() < 0.05]
    tiles = spark.createDataFrame([(5, x, y) for x, y in listed], "z int, x int, y int")
    pyr = P.build_pyramid(spark, _blocks(spark, planes, "f8"), 5, scratch_path(spark, "t-listed"), size=8, dtype="f8", tiles=tiles, levels_per_pass=levels)
    got, want = _planes(pyr), _one_level_at_a_time(planes, listed, 5, 8, "nearest")
    assert {k[:3] for k in got} == set(want)
    for k, v in got.items():
        np.testing.assert_array_equal(v, want[k[:3]])


def test_listed_pyramid_has_a_shuffle_per_pass_not_per_level(spark):
    blocks = _blocks(spark, {(3, 0, 0): np.ones((4, 4))})
    parents = spark.createDataFrame([(2, 0, 0)], "z int, x int, y int")
    plan = P.pyramid_pass(blocks, 3, parents=parents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2                     # blocks, and the list


# ---- paint before average, reprojection --------------------------------------------------------------------------------

def test_sources_are_painted_before_the_mosaic_is_averaged(spark):
    """Two sources on one grid, inside one target pixel: the mean of the painted pixels, not the upper source's mean."""
    size, zoom = 4, 3
    px = grid.WORLD / 2 ** zoom / size / 4                                  # four source pixels a target pixel, a side
    low, high = np.full((16, 16), 10.0), np.full((16, 16), np.nan)
    high[0, 0], high[5, 5] = 90.0, 50.0
    b = _blocks(spark, {(0, 0, 0): low}).withColumn("source_id", F.lit(1)).unionByName(
        _blocks(spark, {(0, 0, 0): high}).withColumn("source_id", F.lit(2)))
    b = b.withColumn("priority", F.col("source_id")).withColumn("px", F.lit(px)).withColumn("x0", F.lit(-grid.HALF_WORLD)).withColumn("y0", F.lit(grid.HALF_WORLD))
    src = RP.Grid("EPSG:3857", "x0", "y0", "px", "px")
    first = _planes(J.chunk_reproject(spark, b, src, zoom, size, scratch_path(spark, "t-paint"), dtype="f8", nodata=NODATA))[(zoom, 0, 0, 1)]
    assert first[0, 0] == (15 * 10 + 90) / 16 and first[1, 1] == (15 * 10 + 50) / 16 and first[2, 2] == 10
    each = _planes(J.chunk_reproject(spark, b, src, zoom, size, scratch_path(spark, "t-each"), dtype="f8", nodata=NODATA, paint_first=False))[(zoom, 0, 0, 1)]
    assert each[0, 0] == 90 and each[1, 1] == 50


def test_mosaic_takes_the_finest_grid_and_a_list_limits_it(spark):
    fine, coarse = _raster(16, 16, 1, gap=0.2), _raster(16, 16, 2, gap=0.5)
    sources = [(1, fine, 0.0, 0.0, 1.0), (2, coarse, 4.0, -6.0, 2.0)]      # id, pixels, x0, y0, pixel
    b = None
    for sid, v, x0, y0, px in sources:
        one = _blocks(spark, _tiles_of(v, 8, 0)).select("*", F.lit(sid).alias("priority"), F.lit(x0).alias("x0"), F.lit(y0).alias("y0"), F.lit(px).alias("px"))
        b = one if b is None else b.unionByName(one)
    made, onto = RP.mosaic_blocks_crs(b, RP.Grid("EPSG:3857", "x0", "y0", "px", "px"), 8, ("priority",))
    assert (onto.x0, onto.y0, onto.dx, onto.dy) == (0.0, 0.0, 1.0, 1.0)
    want = np.full((40, 40), np.nan)
    want[:16, :16] = fine
    over = np.repeat(np.repeat(coarse, 2, axis=0), 2, axis=1)
    want[6:38, 4:36] = np.where(np.isnan(over), want[6:38, 4:36], over)
    got = np.full((40, 40), np.nan)
    for (_, x, y, _), v in _planes(made).items():
        got[8 * y:8 * y + 8, 8 * x:8 * x + 8] = v
    np.testing.assert_array_equal(got, want)
    some = spark.createDataFrame([(0, 0), (1, 2)], "x int, y int")
    part, _ = RP.mosaic_blocks_crs(b, RP.Grid("EPSG:3857", "x0", "y0", "px", "px"), 8, ("priority",), some)
    assert {k[1:3] for k in _planes(part)} == {(0, 0), (1, 2)}


def test_a_listed_chunk_equals_the_whole_one_on_its_tiles(spark):
    v = _raster(64, 64, 9, gap=0.1)
    b = _blocks(spark, _tiles_of(v, 16, 0), "f8").select("*", F.lit(1).alias("priority"), F.lit(1).alias("source_id"))
    src, zoom = RP.Grid("EPSG:4326", -170.0, 80.0, 0.7, 0.4), 3
    whole = _planes(J.chunk_reproject(spark, b, src, zoom, 16, scratch_path(spark, "t-whole"), dtype="f8", nodata=NODATA))
    pick = sorted(whole)[::3]
    tiles = spark.createDataFrame([k[:3] for k in pick], "z int, x int, y int")
    part = _planes(J.chunk_reproject(spark, b, src, zoom, 16, scratch_path(spark, "t-part"), tiles=tiles, dtype="f8", nodata=NODATA))
    assert sorted(part) == pick
    for k in pick:
        np.testing.assert_allclose(part[k], whole[k], rtol=1e-12)


@pytest.mark.parametrize("method", ["bilinear", "average"])
def test_conversion_from_blocks_equals_the_cell_conversion(spark, method):
    planes, meta = {}, []
    for sid in (1, 2, 3):
        for band in (1, 2):
            planes.update({(sid, x, y, band): p for (_, x, y), p in _tiles_of(_raster(16, 16, 10 * sid + band, gap=0.1), 8, 0).items()})
        meta.append((f"s3://b/source/{sid}.zip", sid, float(sid), 500500.0 + 90 * sid, -float(sid), 4205000.0, 16, 16))
    rasters = spark.createDataFrame(meta, "source string, source_id int, a double, c double, e double, f double, width int, height int")
    name = F.concat(F.lit("s3://b/source/"), F.col("z").cast("string"), F.lit(".zip"))
    blocks = _blocks(spark, planes, "f8").withColumn("source", name)
    bad = blocks.where("z = 1 and x = 0 and y = 0 and band = 1").withColumn("data", F.substring("data", 1, 9))
    blocks = blocks.unionByName(bad.withColumn("x", F.lit(7)))
    listing = rasters.select(F.col("source").alias("path"))
    done = spark.createDataFrame([("s3://b/4326/2.tif",)], "path string")
    out, out2 = scratch_path(spark, "t-conv-b"), scratch_path(spark, "t-conv-c")
    log = J.convert_missing_blocks(spark, listing, done, blocks, rasters, "UTM:10", out, 8, method, dtype="f8", nodata=NODATA)
    assert {(r.source[-5], r.ok, r.failed_blocks, r.error) for r in log.collect()} == {("1", True, 1, "9 of 512 bytes"), ("3", True, 0, None)}
    cells = B.unpack_blocks(blocks.where(B.block_error().isNull()), keep=("source",)).select("source", "band", "gx", "gy", "v")
    J.convert_missing(spark, listing, done, cells, rasters, "UTM:10", out2, method)
    got = {(r.target, r.band, r.gx, r.gy): r.v for r in B.unpack_blocks(spark.read.parquet(out), keep=("target",)).collect()}
    want = {(r.target, r.band, r.gx, r.gy): r.v for r in spark.read.parquet(out2).collect()}
    assert got.keys() == want.keys() and {k[0] for k in got} == {"s3://b/4326/1.tif", "s3://b/4326/3.tif"}
    np.testing.assert_allclose([got[k] for k in sorted(got)], [want[k] for k in sorted(want)], rtol=1e-6)


def test_target_grids_by_row_need_a_key(spark):
    with pytest.raises(ValueError):
        RP.warp_blocks_crs(_blocks(spark, {(0, 0, 0): np.ones((4, 4))}), RP.Grid("EPSG:4326", 0.0, 0.0, 1.0, 1.0), RP.Grid("EPSG:4326", "x", "y", 1.0, 1.0), 4, 0)


# ---- skew ---------------------------------------------------------------------------------------------------------------

def test_a_tile_under_a_thousand_sources_is_dealt_out(spark):
    hot = spark.range(1000).select(F.col("id").alias("priority"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p")).select(
        (F.col("p") % 8).alias("gx"), (F.col("p") / 8).cast("long").alias("gy"), "priority", F.lit(0).cast("long").alias("tie"), F.col("priority").alias("v"))
    cold = spark.range(64 * 500).select((F.col("id") % 400 + 8).alias("gx"), F.floor(F.col("id") / 400).alias("gy"), F.lit(1).cast("long").alias("priority"),
                                        F.lit(0).cast("long").alias("tie"), F.col("id").alias("v"))
    cells = hot.unionByName(cold)
    keyed = MO.paint_rows(cells, 8, share=2000)
    groups = {(r.x, r.y, r.salt): r["count"] for r in keyed.groupBy("x", "y", "salt").count().collect()}
    assert sum(groups.values()) == 64000 + 32000
    assert len([k for k in groups if k[:2] == (0, 0)]) == 32 and max(groups.values()) < 2 * 2000      # not 64,000 in one
    assert {k[2] for k in groups if k[:2] != (0, 0)} == {0}                  # tiles that are not hot are left alone
    dealt = keyed.repartition(24, "x", "y", "band", "salt").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    counts = sorted(r["count"] for r in dealt)
    assert counts[-1] < 4 * counts[len(counts) // 2]
    painted = {(r.gx, r.gy): r.v for r in B.unpack_blocks(MO.paint_blocks(cells, 8, 5, share=2000)).where("gx < 8 and gy < 8").collect()}
    assert len(painted) == 64 and set(painted.values()) == {999.0}


def test_hot_keys_are_few_and_null_keys_stay(spark):
    rows = spark.createDataFrame([(None, i) for i in range(50)] + [("a", i) for i in range(300)] + [(str(i), i) for i in range(100)], "k string, gx int")
    assert {(r.k, r._salts) for r in SW.hot_keys(rows, ["k"], share=40).collect()} == {(None, 2), ("a", 8)}
    got = SW.salted(rows, ["k"], ("gx",), share=40)
    assert got.count() == 450 and got.where("_salt is null").count() == 0
    joined = SW.salted_join(rows, spark.createDataFrame([("a", 1), ("7", 2)], "k string, w int"), ["k"], salt_from=("gx",), share=40)
    assert joined.count() == 301


# ---- failures, statistics, stretch ---------------------------------------------------------------------------------------

def test_failures_become_rows_and_neighbours_stay(spark):
    blocks = _blocks(spark, {(1, x, 0): np.full((4, 4), float(x + 1)) for x in range(5)})
    hurt = blocks.withColumn("data", F.when(F.col("x") == 1, F.substring("data", 1, 10)).otherwise(F.col("data"))).withColumn(
        "dtype", F.when(F.col("x") == 2, "zz").otherwise(F.col("dtype")))

    def kernel(v):
        if v[0, 0] == 4:
            raise ArithmeticError("no fours")
        return v + 1

    good, dead = B.split_failures(B.try_blocks(hurt, kernel), scratch_path(spark, "t-dead"))
    assert {k[1]: v[0, 0] for k, v in _planes(good).items()} == {0: 2.0, 4: 6.0}
    assert {r.x: r.error for r in dead.collect()} == {1: "10 of 64 bytes", 2: "unknown dtype zz", 3: "ArithmeticError: no fours"}
    assert B.split_failures(B.try_blocks(hurt.where("false"), kernel), scratch_path(spark, "t-none"))[1].count() == 0


def test_moments_merge_to_those_of_all_pixels(spark):
    rng = np.random.default_rng(4)
    planes = {(3, x, y): 1e9 + rng.normal(0, 1 + x, (8, 8)) for x in range(4) for y in range(3)}       # a large mean: no cancellation
    planes[(3, 0, 0)][:] = np.nan
    planes[(3, 1, 1)][2:] = np.nan
    st = {(r.x, r.y): r for r in J.raster_stats(spark, _blocks(spark, planes, "f8")).collect()}
    assert (0, 0) not in st
    for key, v in [((1, 1), planes[(3, 1, 1)]), ((None, None), np.stack(list(planes.values())))]:
        v, r = v[~np.isnan(v)], st[key]
        assert (r.n, r.vmin, r.vmax) == (v.size, v.min(), v.max())
        np.testing.assert_allclose([r["mean"], np.sqrt(r.m2 / r.n)], [v.mean(), v.std()], rtol=1e-9)
    assert J.raster_stats(spark, _blocks(spark, planes, "f8").where("false")).count() in (0, 1)


def test_whole_raster_stretch_has_no_seams(spark):
    v = _raster(32, 32, 12)
    store = scratch_path(spark, "t-compare")
    SK.write_tiles(_blocks(spark, _tiles_of(v, 8, 4), "f8"), store)
    got = np.full((3, 32, 32), np.nan)
    for (_, x, y, band), plane in _planes(J.compare_shades_blocks(spark, store, 4)).items():
        got[band - 1, 8 * y:8 * y + 8, 8 * x:8 * x + 8] = plane
    a, b = H.masked_gradient(v, 2.0, 0), H.masked_gradient(v, 2.0, 1)
    for plane, want in zip(got, (H.shade_naive(a, b), H.shade_zfactor(a, b), H.shade_light(a * 2, b * 2))):
        np.testing.assert_array_equal(plane, want)


# ---- listing ---------------------------------------------------------------------------------------------------------------

def test_listing_of_what_was_written_plans_the_rest(spark):
    out = scratch_path(spark, "t-listing")
    names = ["a b+c.tif", "50%25.tif", "ü/x.tif"]
    SK.write_converted(spark.createDataFrame([(f"s3://b/4326/{n}", 1) for n in names], "target string, v int"), out, key="target")
    listing = spark.createDataFrame([(f"s3://b/source/{n[:-4]}.zip",) for n in [*names, "new.tif"]], "path string")
    assert [r.source for r in J.missing_from_storage(spark, listing, out).collect()] == ["s3://b/source/new.zip"]


def test_tiles_of_a_box_across_180_degrees(spark):
    boxes = spark.createDataFrame([(1, 179.0, -1.0, -179.0, 1.0), (2, -1.0, -1.0, 1.0, 1.0)], "source_id int, west double, south double, east double, north double")
    got = {(r.source_id, r.x, r.y) for r in J.cover_tiles(boxes, 4, west="west", south="south", east="east", north="north").collect()}
    assert got == {(1, x, y) for x in (0, 15) for y in (7, 8)} | {(2, x, y) for x in (7, 8) for y in (7, 8)}


# ---- view, strips, source tables ---------------------------------------------------------------------------------------------

def test_missing_tiles_read_as_zeros_in_every_band_without_a_literal(spark):
    blocks = _blocks(spark, {(3, 1, 1, 1): np.ones((64, 64)), (3, 1, 1, 4): np.full((64, 64), 2.0)})
    view = RD.read_tms(blocks, spark.createDataFrame([(3, 1, 1), (3, 2, 1)], "z int, x int, y int"), 64)
    got = {k: (v.min(), v.max()) for k, v in _planes(view).items()}
    assert got == {(3, 1, 1, 1): (1, 1), (3, 1, 1, 4): (2, 2), (3, 2, 1, 1): (0, 0), (3, 2, 1, 4): (0, 0)}
    assert all(len(r["data"]) == 64 * 64 * 4 for r in view.collect())
    assert len(view._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    none = RD.read_tms(blocks.where("false"), spark.createDataFrame([(3, 2, 1)], "z int, x int, y int"), 8, "i2")
    assert [(r.band, bytes(r["data"]), r.stored) for r in none.collect()] == [(1, bytes(128), False)]


def test_strips_keep_band_dtype_and_nodata(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for band, dtype, nodata in ((1, "i2", -1.0), (2, "f4", None)):
        v = rng.integers(0, 100, (21, 50)).astype("<" + dtype)
        v[3, 4] = -1
        want[band] = v
        rows += [(r, 50, dtype, nodata, bytearray(v[r].tobytes()), band) for r in range(21)]
    st = spark.createDataFrame(rows, "row long, width int, dtype string, nodata double, data binary, band int").repartition(5)
    sq = B.reblock_strips(st, 16, 7).collect()
    assert {(r["band"], r["dtype"], r["nodata"]) for r in sq} == {(1, "i2", -1.0), (2, "f4", None)}
    for r in sq:
        got = B.decode(r["data"], r["dtype"], 16)
        part = want[r["band"]][16 * r["y"]:16 * r["y"] + 16, 16 * r["x"]:16 * r["x"] + 16]
        np.testing.assert_array_equal(got[:part.shape[0], :part.shape[1]], part)
    assert len(sq) == 2 * 4 * 2


def test_strips_of_mixed_layouts_meet_in_one_that_holds_all(spark):
    a, b = np.arange(8, dtype="<i2"), np.arange(8, dtype="<f4") + 0.5
    b[2] = -7
    st = spark.createDataFrame([(0, 8, "i2", 3.0, bytearray(a.tobytes())), (1, 8, "f4", -7.0, bytearray(b.tobytes()))], "row long, width int, dtype string, nodata double, data binary")
    [r] = B.reblock_strips(st, 8, 2).collect()
    got = B.row_values(r.asDict())
    np.testing.assert_array_equal(np.isnan(got[:2]), [[i == 3 for i in range(8)], [i == 2 for i in range(8)]])
    assert got[0, 5] == 5 and got[1, 5] == 5.5 and r["valid_count"] == 14


def test_source_table_is_pruned_by_source_and_box(spark):
    blocks = None
    for sid in range(6):
        one = _blocks(spark, {(0, x, y): np.full((4, 4), 10.0 * sid) for x in range(8) for y in range(8)}).select(
            "*", F.lit(sid).alias("source_id"), F.lit(sid).alias("priority"), F.lit(100.0 * sid).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("dx"), F.lit(1.0).alias("dy"))
        blocks = one if blocks is None else blocks.unionByName(one)
    path = scratch_path(spark, "t-sources")
    SK.write_source_blocks(blocks, path)
    some = RD.read_source_blocks(spark, path, sources=[2, 5], box=(205.0, -6.0, 211.0, -1.0))
    assert {(r.source_id, r.x, r.y) for r in some.collect()} == {(2, x, y) for x in (1, 2) for y in (0, 1)}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters:")[1].split("]")[0] and "west" in plan.split("PushedFilters:")[1]
    assert RD.read_source_blocks(spark, path).count() == 6 * 64
    SK.write_source_blocks(blocks.where("source_id = 2 and x = 0"), path)       # a source written again
    again = RD.read_source_blocks(spark, path, sources=[2])
    assert again.count() == 8


def test_window_pixels_are_sliced_in_the_kernel(spark):
    v = _raster(32, 32, 21, gap=0.2)
    store = scratch_path(spark, "t-window")
    SK.write_tiles(_blocks(spark, _tiles_of(v, 8, 4)), store)
    for scale, (r0, r1, c0, c1) in ((1, (3, 20, 5, 30)), (3, (2, 31, 1, 32)), (4, (0, 40, -3, 9))):
        got = {(r.orow, r.ocol): r.v for r in RD.read_window(spark, store, 4, r0, r1, max(c0, 0), c1, scale).collect()}
        want = {((r - r0) // scale, (c - max(c0, 0)) // scale): v[r, c] for r in range(r0, min(r1, 32)) for c in range(max(c0, 0), min(c1, 32))
                if (r - r0) % scale == scale // 2 and (c - max(c0, 0)) % scale == scale // 2 and not np.isnan(v[r, c])}
        assert got == want


def test_bands_in_one_row_are_painted_and_averaged_apart(spark):
    from tessera.operators import cells as C

    rnd = random.Random(5)
    rows = [(rnd.randrange(8), rnd.randrange(8), rnd.randrange(3), rnd.randrange(2), *[rnd.choice([None, rnd.randrange(40)]) for _ in range(2)]) for _ in range(600)]
    wide = spark.createDataFrame(rows, "gx long, gy long, priority int, tie int, a long, b long")
    tall = wide.select("gx", "gy", "priority", "tie", F.inline(F.array(*[F.struct(F.lit(k).alias("band"), F.col(c).alias("v")) for k, c in ((1, "a"), (7, "b"))])))
    got = C.paint_and_average_bands(wide, {1: "a", 7: "b"}).select("band", "gx", "gy", "vsum", "vcount", "v")
    want = C.paint_and_average(tall, extra_keys=("band",)).select("band", "gx", "gy", "vsum", "vcount", "v")
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("method", ["nearest", "average"])
@pytest.mark.parametrize("dx, dy, x0, y0", [(1.0, 1.0, 0.0, 0.0), (2.0, 2.0, 0.0, 0.0), (1.5, 2.25, 0.3, -0.7), (0.5, 0.75, 0.1, 0.2), (7.0, 5.0, -3.0, 4.0)])
def test_grids_of_one_crs_by_rows_and_columns_equal_the_general_way(method, dx, dy, x0, y0):
    rng = np.random.default_rng(6)
    vals = np.round(rng.normal(100, 30, (16, 16)))
    vals[rng.random((16, 16)) < 0.3] = np.nan
    arr, valid = B.from_float(vals, "f8", NODATA)
    row = {**B.block_record(0, 2, 3, 1, 16, "f8", NODATA, arr, valid), "p": 0, "t": 0}
    dst = RP.Grid("EPSG:3857", x0, y0, dx, dy)

    def planes(src):
        out = {}
        with np.errstate(all="ignore"):
            for tx, ty, off, num, den, near in RP._block_partials(row, src, dst, 8, method, None):
                for k, o in enumerate(off.tolist()):
                    at = out.setdefault((int(tx), int(ty), o), [0.0, 0.0, None])
                    if len(num):
                        at[0], at[1] = at[0] + num[k], at[1] + den[k]
                    else:
                        at[2] = near[k]
        return out

    fast = planes(RP.Grid("EPSG:3857", 0.0, 0.0, 1.0, 1.0))
    plain = RP.np_transform
    try:
        RP.np_transform = lambda a, b, x, y: plain("EPSG:3857", "EPSG:3857", x, y)
        slow = planes(RP.Grid("EPSG:0", 0.0, 0.0, 1.0, 1.0))                # another name: not known to be the same CRS
    finally:
        RP.np_transform = plain
    assert fast == slow and len(fast) > 5
