"""Properties of the tile grid columns."""

from pyspark.sql import functions as F

from tessera.functions import grid


def _tiles(spark, z=7, n=300):
    return spark.range(n).select(F.lit(z).alias("z"), ((F.col("id") * 37) % (2 ** z)).alias("x"),
                                 ((F.col("id") * 91) % (2 ** z)).alias("y"))


def test_parent_of_children_is_tile(spark):
    t = _tiles(spark)
    c = t.select("z", "x", "y", F.explode(grid.children("x", "y", "z")).alias("c"))
    p = c.select("z", "x", "y", grid.parent("c.x", "c.y", "c.z").alias("p"))
    bad = p.where((F.col("p.z") != F.col("z")) | (F.col("p.x") != F.col("x")) | (F.col("p.y") != F.col("y")))
    assert bad.count() == 0
    assert c.count() == 4 * t.count()


def test_quadkey_extends_parent(spark):
    t = _tiles(spark)
    q = t.select(grid.quadkey("x", "y", "z").alias("qk"),
                 grid.quadkey(grid.shiftright("x", 1), grid.shiftright("y", 1), F.col("z") - 1).alias("pqk"))
    assert q.where(~F.col("qk").startswith(F.col("pqk")) | (F.length("qk") != 7)).count() == 0
    assert spark.range(1).select(grid.quadkey(F.lit(1), F.lit(1), F.lit(1))).first()[0] == ""
    # digit = xbit + 2*ybit, high bit first
    assert spark.range(1).select(grid.quadkey(F.lit(3), F.lit(5), F.lit(3))).first()[0] == "213"


def test_children_bounds_tile_parent(spark):
    t = _tiles(spark, 5, 50)
    c = t.select("z", "x", "y", F.explode(grid.children("x", "y", "z")).alias("c"))
    b = c.select(grid.tile_bounds("x", "y", "z").alias("p"), grid.tile_bounds("c.x", "c.y", "c.z").alias("b"))
    agg = b.groupBy("p").agg(F.min("b.ulx").alias("ulx"), F.max("b.uly").alias("uly"),
                             F.max("b.lrx").alias("lrx"), F.min("b.lry").alias("lry")).collect()
    for r in agg:
        assert abs(r.ulx - r.p.ulx) < 1e-6 and abs(r.uly - r.p.uly) < 1e-6
        assert abs(r.lrx - r.p.lrx) < 1e-6 and abs(r.lry - r.p.lry) < 1e-6


def test_lonlat_to_tile_inverts_tile_ul(spark):
    t = _tiles(spark, 9, 200)
    eps = 1e-7
    p = t.select("z", "x", "y", (grid.tile_ul_lon("x", "z") + eps).alias("lon"),
                 (grid.tile_ul_lat("y", "z") - eps).alias("lat"))
    back = p.select("x", "y", grid.lon_to_tile_x("lon", "z").alias("x2"), grid.lat_to_tile_y("lat", "z").alias("y2"))
    assert back.where((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2"))).count() == 0


def test_corner_names_and_offsets(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "x int, y int")
    r = df.select("x", "y", grid.corner("x", "y").alias("c"), grid.corner_offset("x", "y", 2048).alias("o")).collect()
    got = {(a.x, a.y): (a.c, a.o.dx, a.o.dy) for a in r}
    assert got == {(0, 0): ("ul", 0, 0), (0, 1): ("ll", 0, 1024), (1, 0): ("ur", 1024, 0), (1, 1): ("lr", 1024, 1024)}


def test_tiles_for_bbox_covers_box(spark):
    df = spark.createDataFrame([(-10.5, 20.25, 3.75, 41.0)], "w double, s double, e double, n double")
    t = df.select(F.explode(grid.tiles_for_bbox("w", "s", "e", "n", F.lit(4))).alias("t")).select("t.*")
    xs = sorted({r.x for r in t.collect()})
    ys = sorted({r.y for r in t.collect()})
    assert xs == list(range(7, 9)) and ys == list(range(5, 8))


def test_quadkey_order_is_z_order(spark):
    t = _tiles(spark, 6, 400).distinct()
    rows = t.select("x", "y", grid.quadkey("x", "y", "z").alias("qk")).collect()

    def morton(x, y):
        return sum((((x >> i) & 1) << (2 * i)) | (((y >> i) & 1) << (2 * i + 1)) for i in range(6))
    by_qk = [(r.x, r.y) for r in sorted(rows, key=lambda r: r.qk)]
    by_morton = sorted(((r.x, r.y) for r in rows), key=lambda p: morton(*p))
    assert by_qk == by_morton
