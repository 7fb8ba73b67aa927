"""Composite jobs and the readers/writers they use."""

from pyspark.sql import functions as F

from tessera.plans import jobs as J
from tessera.session import scratch_path
from tessera.sources import readers as RD


def test_missing_targets_and_log(spark):
    listing = spark.createDataFrame([("s3://b/source/a.zip",), ("s3://b/source/b.zip",), ("s3://b/source/c.txt",),
                                     ("s3://b/source/zipped/d.zip",)], "path string")
    done = spark.createDataFrame([("s3://b/4326/a.tif",), ("s3://b/4326/x.tif",)], "path string")
    todo = {(r.source, r.target) for r in J.missing_targets(listing, done).collect()}
    # every 'source' and every '.zip' is replaced; 'zip' inside a folder name stays
    assert todo == {("s3://b/source/b.zip", "s3://b/4326/b.tif"),
                    ("s3://b/source/zipped/d.zip", "s3://b/4326/zipped/d.tif")}


def test_reproject_worklist_writes_per_source_and_logs_failures(spark):
    wl = scratch_path(spark, "t-wl")
    spark.createDataFrame([("s3://b/source/s1.zip",), ("s3://b/source/s2.zip",)], "value string") \
        .write.mode("overwrite").text(wl)
    cells = spark.createDataFrame([("s3://b/source/s1.zip", 0, 0, 4.0), ("s3://b/source/s1.zip", 1, 0, 6.0),
                                   ("s3://b/source/s3.zip", 0, 0, 1.0)], "source string, gx long, gy long, v double")
    out = scratch_path(spark, "t-conv")
    log = {r.source: (r.ok, r.output) for r in J.reproject_worklist(spark, wl, cells, out, ratio=2).collect()}
    assert log == {"s3://b/source/s1.zip": (True, "s3://b/4326/s1.tif"), "s3://b/source/s2.zip": (False, None)}
    back = spark.read.parquet(out).collect()
    assert [(r.target, r.gx, r.gy, r.v) for r in back] == [("s3://b/4326/s1.tif", 0, 0, 5.0)]


def test_tile_list_roundtrip_and_features(spark):
    p = scratch_path(spark, "t-tiles")
    spark.createDataFrame([("[1, 2, 3]",), ("[1,2,3]",), ("",), ("[4,5,6]",)], "value string").write.text(p)
    got = sorted(tuple(r) for r in RD.read_tile_list(spark, p).collect())
    assert got == [(3, 1, 2), (6, 4, 5)]
    f = scratch_path(spark, "t-feat")
    fc = ('{"type":"FeatureCollection","features":[{"type":"Feature","id":7,"properties":{},"geometry":'
          '{"type":"Polygon","coordinates":[[[1.0,2.0],[3.0,2.0],[3.0,5.0],[1.0,5.0],[1.0,2.0]]]}}]}')
    spark.createDataFrame([(fc,)], "value string").write.text(f)
    r = RD.read_features(spark, f).first()
    assert (r.id, r.west, r.south, r.east, r.north) == ("7", 1.0, 2.0, 3.0, 5.0)


def test_features_multipolygon_and_string_ids(spark):
    f = scratch_path(spark, "t-feat2")
    lines = ['{"type":"Feature","id":"n38w122","properties":{"a":"b"},"geometry":{"type":"MultiPolygon","coordinates":'
             '[[[[1,2],[3,2],[3,5],[1,2]]],[[[10,-4],[12,-4],[12,0.5],[10,-4]],[[11,-3],[11,-2],[11.5,-2],[11,-3]]]]}}',
             '{"type":"Feature","properties":{},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}',
             '{"type":"Feature","id":3,"properties":{},"geometry":{"type":"Point","coordinates":[5,6]}}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f)
    got = sorted((tuple(r) for r in RD.read_features(spark, f).collect()), key=str)
    assert got == sorted([("n38w122", 1.0, -4.0, 12.0, 5.0), (None, 0.0, 0.0, 1.0, 1.0),
                          ("3", None, None, None, None)], key=str)


def test_list_objects_reads_no_content(spark):
    p = scratch_path(spark, "t-list")
    spark.createDataFrame([("x",)], "value string").write.text(p + "/source")
    df = RD.list_objects(spark, p, glob="*.txt")
    assert "content" not in df.columns
    assert df.count() >= 1 and all(r.length > 0 for r in df.collect())


def test_plan_and_overlap_jobs(spark):
    r = spark.createDataFrame([(1, 1.0, 500500.0, -1.0, 4205000.0, 1500, 1500),
                               (2, 2.0, 502000.0, -2.0, 4205000.0, 1500, 1500)],
                              "source_id long, a double, c double, e double, f double, width int, height int")
    fp = J.footprints(r, "UTM:10")
    z = J.dataset_zoom(fp)
    assert z == 14
    tiles = J.plan_tiles(fp, z)
    pairs = J.tile_sources(tiles, fp)
    # every planned tile meets at least one source, every source meets a planned tile
    assert {t.x for t in tiles.collect()} >= {p.x for p in pairs.collect()}
    assert {p.source_id for p in pairs.collect()} == {1, 2}
    assert pairs.select("z", "x", "y").distinct().count() == tiles.count()
    assert tiles.where(F.col("n_sources") < 1).count() == 0


def test_convert_missing_reprojects_each_source_on_its_own_grid(spark):
    from tessera.operators.reproject import Grid, warp_crs
    listing = spark.createDataFrame([("s3://b/source/r1.zip",), ("s3://b/source/r2.zip",), ("s3://b/source/r3.zip",)],
                                    "path string")
    done = spark.createDataFrame([("s3://b/4326/r2.tif",)], "path string")
    rasters = spark.createDataFrame([
        ("s3://b/source/r1.zip", 1, 30.0, 500500.0, -30.0, 4205000.0, 12, 10),
        ("s3://b/source/r2.zip", 2, 30.0, 510000.0, -30.0, 4205000.0, 12, 10),
        ("s3://b/source/r3.zip", 3, 10.0, 520000.0, -10.0, 4200000.0, 12, 10)],
        "source string, source_id long, a double, c double, e double, f double, width int, height int")
    rows = [(f"s3://b/source/r{k}.zip", b, gx, gy, float(100 * k + 10 * b + gx + gy))
            for k in (1, 2) for b in (1, 2) for gx in range(12) for gy in range(10)]
    cells = spark.createDataFrame(rows, "source string, band int, gx long, gy long, v double")
    out = scratch_path(spark, "t-z3")
    log = {r.source: (r.ok, r.output) for r in J.convert_missing(spark, listing, done, cells, rasters, "UTM:10", out).collect()}
    # r2 already converted (skipped), r3 has no pixels (failed), r1 converted
    assert log == {"s3://b/source/r1.zip": (True, "s3://b/4326/r1.tif"), "s3://b/source/r3.zip": (False, None)}
    got = spark.read.parquet(out)
    assert {r.target for r in got.select("target").distinct().collect()} == {"s3://b/4326/r1.tif"}
    assert {r.band for r in got.select("band").distinct().collect()} == {1, 2}
    # equals a single-grid warp with r1's own default grid
    g = J.default_4326_grid(J.footprints(rasters.where("source_id = 1"), "UTM:10")).first()
    exp = warp_crs(cells.where("source = 's3://b/source/r1.zip' and band = 1"),
                   Grid("UTM:10", 500500.0, 4205000.0, 30.0, 30.0),
                   Grid("EPSG:4326", g.dst_x0, g.dst_y0, g.dst_res, g.dst_res))
    a = {(r.gx, r.gy): r.v for r in got.where("band = 1").collect()}
    b = {(r.gx, r.gy): r.v for r in exp.collect()}
    assert a.keys() == b.keys() and len(a) > 50
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_f6_conversion_proposes_few_cells_and_leaves_finished_sources_alone(spark, monkeypatch):
    from tessera.operators import reproject as RP
    rasters = spark.createDataFrame([(f"s3://b/source/r{k}.zip", k, 30.0, 500500.0, -30.0, 4205000.0, 12, 10) for k in (1, 2)],
                                    "source string, source_id long, a double, c double, e double, f double, width int, height int")
    cells = spark.createDataFrame([(f"s3://b/source/r{k}.zip", 1, gx, gy, float(k + gx + gy)) for k in (1, 2) for gx in range(12) for gy in range(10)],
                                  "source string, band int, gx long, gy long, v double")
    dealt, proposed = [], []
    joined, points = J.salted_join, RP._add_points
    monkeypatch.setattr(J, "salted_join", lambda big, *a, **k: dealt.append(big) or joined(big, *a, **k))
    monkeypatch.setattr(RP, "_add_points", lambda df, *a: proposed.append(df) or points(df, *a))
    done = spark.createDataFrame([("s3://b/4326/r2.tif",)], "path string")
    J.convert_missing(spark, rasters.select(F.col("source").alias("path")), done, cells, rasters, "UTM:10", scratch_path(spark, "t-f6"), "nearest")
    assert dealt[0].count() == 120                       # r2 is finished: none of its pixels is counted or dealt
    assert proposed[0].count() == 120 and proposed[1].count() <= 12 * 120
