"""Published values of the reference used as goldens."""

import math

from pyspark.sql import functions as F

from tessera.functions import crs, grid, terrain as TR


def dms(v):
    v = abs(v)
    d = int(v)
    m = int((v - d) * 60)
    s = (v - d - m / 60) * 3600
    return d, m, round(s, 2)


# UTM 10N corners of a 1500 x 1500, 1 m raster and their lon/lat as printed by the
# dataset's metadata (degrees, minutes, seconds; west and north).
UTM_POINTS = [
    ((500500.0, 4205000.0), ((122, 59, 39.50), (37, 59, 33.55))),
    ((500500.0, 4203500.0), ((122, 59, 39.50), (37, 58, 44.89))),
    ((502000.0, 4205000.0), ((122, 58, 38.00), (37, 59, 33.55))),
    ((502000.0, 4203500.0), ((122, 58, 38.02), (37, 58, 44.88))),
    ((501250.0, 4204250.0), ((122, 59, 8.76), (37, 59, 9.22))),
]


def test_utm_inverse_matches_published_corners(spark):
    df = spark.createDataFrame([p for p, _ in UTM_POINTS], "e double, n double")
    lon, lat = crs.utm_to_lonlat("e", "n", 10)
    got = df.select(lon.alias("lon"), lat.alias("lat")).collect()
    for r, (_, (lo, la)) in zip(got, UTM_POINTS):
        assert r.lon < 0 and r.lat > 0
        assert dms(r.lon) == lo
        assert dms(r.lat) == la


def test_utm_forward_inverts_inverse(spark):
    df = spark.createDataFrame([p for p, _ in UTM_POINTS], "e double, n double")
    lon, lat = crs.utm_to_lonlat("e", "n", 10)
    ll = df.select("e", "n", lon.alias("lon"), lat.alias("lat"))
    e, n = crs.lonlat_to_utm("lon", "lat", 10)
    for r in ll.select("e", "n", e.alias("e2"), n.alias("n2")).collect():
        assert abs(r.e - r.e2) < 1e-3 and abs(r.n - r.n2) < 1e-3


def test_zoom_of_one_metre_raster_is_14(spark):
    df = spark.createDataFrame([(1, 1.0, 500500.0, -1.0, 4205000.0, 1500, 1500)],
                               "source_id long, a double, c double, e double, f double, width int, height int")
    from tessera.plans.jobs import footprints
    fp = footprints(df, "UTM:10")
    r = fp.select("res", grid.zoom_for_resolution("res", 2048).alias("z"),
                  F.log2(F.lit(grid.WORLD) / (F.col("res") * 2048)).alias("raw")).first()
    assert round(r.res, 5) == 1.27052
    assert round(r.raw, 2) == 13.91
    assert r.z == 14


def test_ten_metre_data_gives_zoom_11(spark):
    r = spark.range(1).select(grid.zoom_for_resolution(F.lit(9.555), 2048).alias("z")).first()
    assert r.z == 11


def test_window_of_tile_5252_11446_15(spark):
    df = spark.createDataFrame([(5252, 11446, 15)], "x long, y long, z int")
    w = grid.source_window("x", "y", "z", 14, 512, 256)
    r = df.select(w.alias("w"), grid.buffer_window(w, 2).alias("b")).first()
    assert (r.w.row0, r.w.row1, r.w.col0, r.w.col1, r.w.scale) == (2930176, 2930432, 1344512, 1344768, 1.0)
    assert (r.b.row0, r.b.row1, r.b.col0, r.b.col1) == (2930174, 2930434, 1344510, 1344770)


def test_overview_halving():
    assert [math.ceil(1500 / 2 ** k) for k in (1, 2, 3)] == [750, 375, 188]


def test_flat_ground_shades(spark):
    r = spark.range(1).select(TR.hillshade_naive(F.lit(0.0), F.lit(0.0)).alias("n"),
                              TR.hillshade_zfactor(F.lit(0.0), F.lit(0.0)).alias("z")).first()
    assert r.n == 217 and r.z == 180
