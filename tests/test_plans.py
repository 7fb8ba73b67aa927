"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from tessera.functions import grid
from tessera.operators import blocks as B, cells as C, overlap as OV
from tessera.session import scratch_path
from tessera.sources import fixtures as FX, readers as RD, sinks as SK

from .conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_overlap_join_is_an_equi_join(spark):
    a = spark.range(200).select(F.col("id").alias("a"), (F.col("id") * 1.5).alias("xmin"), F.lit(0.0).alias("ymin"),
                                (F.col("id") * 1.5 + 4).alias("xmax"), F.lit(3.0).alias("ymax"))
    b = spark.range(300).select(F.col("id").alias("b"), F.col("id").cast("double").alias("xmin"),
                                F.lit(1.0).alias("ymin"), (F.col("id") + 0.5).alias("xmax"), F.lit(2.0).alias("ymax"))
    j = OV.overlap_join(a, b, 2.0)
    plan = _plan(j)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # brute force
    exp = {(i, k) for i in range(200) for k in range(300)
           if i * 1.5 < k + 0.5 and k < i * 1.5 + 4}
    got = {(r.a, r.b) for r in j.collect()}
    assert got == exp                               # each pair once, none missing


def test_tile_reads_push_level_and_nodata_filters(spark):
    blk = B.pack_blocks(FX.dem(spark, SMALL), 32, 6, dtype="f4", nodata=FX.NODATA)
    store = scratch_path(spark, "t-push")
    SK.write_tiles(blk, store)
    df = RD.read_tiles(spark, store, z=6).select("x", "y", "valid_count")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(z" in plan and "= 6)" in plan
    assert "PushedFilters: [IsNotNull(valid_count), GreaterThan(valid_count,0)]" in plan


def test_scan_reads_only_needed_columns(spark):
    df = C.mosaic_paint(FX.scenes(spark, SMALL))
    plan = _plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_extendedprice:double>" in plan


def test_aggregates_are_partial_before_shuffle(spark):
    plan = _plan(C.resample_average(FX.dem(spark, SMALL), 2))
    assert plan.index("partial_sum") > plan.index("Exchange")      # partial below the exchange


def test_paint_and_average_pre_aggregates_every_shuffle(spark):
    plan = _plan(C.paint_and_average(FX.scenes(spark, SMALL), 2))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_max" in plan and "partial_sum" in plan


def test_halo_needs_no_shuffle(spark):
    plan = _plan(C.halo(FX.dem(spark, SMALL), 32, 2))
    assert "Exchange" not in plan


def test_quadkey_stays_in_the_jvm(spark):
    t = spark.range(10).select(grid.quadkey(F.col("id"), F.col("id"), F.lit(5)).alias("q"))
    assert "Python" not in _plan(t) and "BatchEvalPython" not in _plan(t)


def test_salted_join_spreads_a_hot_key(spark):
    from tessera.operators.skew import salted, salted_join
    big = spark.range(20000).select(F.lit("hot").alias("source"), (F.col("id") % 200).alias("gx"),
                                    (F.col("id") / 200).cast("long").alias("gy"))
    small = spark.createDataFrame([("hot", 1.5), ("cold", 2.5)], "source string, a double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = salted_join(big, small, ["source"], share=1250)
        plan = _plan(j)
        assert any("Join [" in ln and "_salt" in ln for ln in plan.splitlines())   # joined on the salt too
        assert j.count() == 20000 and set(j.columns) == {"source", "gx", "gy", "a"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the hot key's rows fall on as many salts as its count needs, i.e. on 16 join keys instead of one
    per = salted(big, ["source"], ("gx", "gy"), share=1250).groupBy("_salt").count().collect()
    assert len(per) == 16 and max(r["count"] for r in per) < 2 * 1250
    semi = salted_join(big, small.where("source = 'hot'"), ["source"], how="left_semi", share=1250)
    assert semi.count() == 20000


def test_window_read_prunes_to_the_window(spark):
    blk = B.pack_blocks(FX.dem(spark, SMALL), 32, 6, dtype="f8", nodata=FX.NODATA)
    store = scratch_path(spark, "t-win")
    SK.write_tiles(blk, store)
    w = RD.read_window(spark, store, 6, 3, 11, 40, 72, scale=2)
    plan = _plan(w)
    assert "PartitionFilters: [isnotnull(z" in plan
    import re
    assert "PushedFilters: [IsNotNull(valid_count), IsNotNull(x), IsNotNull(y)" in plan   # block range at the scan
    assert re.search(r"\(x#\d+ >= 1\)", plan)
    got = {(r.orow, r.ocol): r.v for r in w.collect()}
    dem = {(r.gx, r.gy): r.v for r in FX.dem(spark, SMALL).collect() if r.v is not None}
    exp = {((gy - 3) // 2, (gx - 40) // 2): float(v) for (gx, gy), v in dem.items()
           if 3 <= gy < 11 and 40 <= gx < 72 and (gy - 3) % 2 == 1 and (gx - 40) % 2 == 1}
    assert got == exp and len(got) > 10


def test_chunk_meets_the_tile_list_before_painting(spark):
    from tessera.plans import jobs as J
    tiles = spark.createDataFrame([(9, 0, 0)], "z int, x int, y int")
    blk = J.chunk_blocks(FX.scenes_bands(spark, SMALL), 2, 9, 32, tiles, nodata=FX.NODATA)
    plan = _plan(blk)
    # a plan tree prints children below their parents: the join lies under every aggregate
    assert plan.index("LeftSemi") > max(i for i in range(len(plan)) if plan.startswith("Aggregate(", i))
    assert plan.count("lineitem.parquet") == 1       # one scan for the three bands
    assert {(r.x, r.y) for r in blk.collect()} == {(0, 0)}
