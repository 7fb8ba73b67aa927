"""Tiles with few pixels: bytes follow the pixels, the blocks read the same."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks as B, cells as C, mosaic as MO, pyramid as P, skew as SW
from tessera.plans import jobs as J
from tessera.session import scratch_path

NODATA = -9999.0


def _scattered(spark, bands=False):
    """Two sources of one pixel in each of 300 tiles of 32 pixels, and one tile that is full."""
    rows = [(40 * k, 33 * k, p, k, 10 * k + p) for k in range(1, 301) for p in (1, 2)]
    rows += [(gx, gy, 1, 5, gx + gy) for gx in range(32) for gy in range(32)]
    if not bands:
        return spark.createDataFrame(rows, "gx long, gy long, priority int, tie long, v long")
    return spark.createDataFrame([(*r[:4], b, r[4] + b) for r in rows for b in (1, 2)], "gx long, gy long, priority int, tie long, band int, v long")


def test_f3_painted_tiles_and_layers_hold_covered_pixels_only(spark):
    cells = _scattered(spark)
    painted = MO.paint_blocks(cells, 32, 10)
    size = {(r.x, r.y): r.n for r in painted.select("x", "y", F.octet_length("data").alias("n")).collect()}
    assert len(size) == 301 and size[0, 0] == 32 * 32 * 8 and max(n for t, n in size.items() if t != (0, 0)) < 100
    got = B.unpack_blocks(painted).select("gx", "gy", F.col("v").cast("long").alias("v"))
    assert sorted(got.collect()) == sorted(C.mosaic_paint(cells).collect())
    assert painted.where(B.block_error().isNotNull()).count() == 0
    one = pa.RecordBatch.from_pydict({**{c: np.zeros(1, np.int32) for c in ("x", "y", "band")}, "salt": np.zeros(1, np.int64),
                                      "off": np.full(1, 7, np.int32), "p": np.ones(1, np.int64), "t": np.ones(1, np.int64), "v": np.ones(1)})
    assert sum(b.nbytes for b in MO._paint_sorted([one], 32, 10)) < 200


def test_f2_painted_bands_hold_covered_pixels_only(spark):
    cells = _scattered(spark, bands=True)
    painted = MO.paint_blocks(cells, 32, 10)
    total = painted.agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("b")).first()
    assert total.n == 602 and total.b < 602 * 100 + 2 * 8192
    got = B.unpack_blocks(painted).select("band", "gx", "gy", F.col("v").cast("long").alias("v"))
    assert sorted(got.collect()) == sorted(C.mosaic_paint(cells, keys=("band", "gx", "gy")).collect())


def test_layers_merge_the_same_however_they_are_cut():
    rng = np.random.default_rng(1)
    rows, best = [], {}
    for tile in range(6):
        for _ in range(3):                            # three layers a tile
            off = np.sort(rng.choice(16, 5, replace=False))
            recs = np.zeros(5, MO.LAYER)
            recs["off"], recs["p"], recs["t"], recs["v"] = off, rng.integers(0, 3, 5), rng.integers(0, 3, 5), rng.integers(0, 9, 5)
            rows.append((10, tile, 0, 1, recs.tobytes()))
            for r in recs.tolist():
                best[tile, r[0]] = max(best.get((tile, r[0]), r[1:]), r[1:])
    names = ("z", "x", "y", "band", "px")
    whole = pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.binary() if n == "px" else pa.int32()) for i, n in enumerate(names)})
    for step in (1, 2, 5, 18):
        got = {}
        for rb in MO._merge_sorted((whole.slice(i, step) for i in range(0, 18, step)), 4, NODATA):
            for r in rb.to_pylist():
                vals = B.row_values(r).ravel()
                got |= {(r["x"], int(o)): vals[o] for o in np.flatnonzero(~np.isnan(vals))}
        assert got == {k: v[2] for k, v in best.items()}


@pytest.mark.parametrize("levels", [1, 3])
def test_f1_sparse_blocks_average_as_dense_ones(spark, levels):
    cells = C.mosaic_paint(_scattered(spark))
    folded = [P.pyramid_pass(B.pack_blocks(cells, 32, 10, nodata=NODATA, sparse=s), levels, "average") for s in (True, False)]
    assert "FlatMapGroups" not in folded[0]._jdf.queryExecution().executedPlan().toString()      # no call for each parent
    got, exp = [sorted(B.unpack_blocks(f, weighted=True).collect()) for f in folded]
    assert got == exp and len(got) > 300
    least = folded[0].select(F.min(F.octet_length("data") + F.octet_length("weight"))).first()[0]
    assert least < 200


def test_f5_chunk_stores_pixels_not_empty_tiles(spark):
    out = J.chunk(spark, _scattered(spark), 10, 9, 32, scratch_path(spark, "t-sparse-chunk"), dtype="f8", nodata=NODATA)
    exp = {(r.gx, r.gy): r.v for r in C.paint_and_average(_scattered(spark), 2).collect()}
    assert {(r.gx, r.gy): r.v for r in B.unpack_blocks(out).collect()} == exp
    row = out.agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("b")).first()
    assert row.b < row.n * 100 + 8192
    st = {(r.x, r.y): r.vsum for r in B.block_stats(out).collect()}
    assert sum(st.values()) == pytest.approx(sum(exp.values()))


def test_f4_chunk_bands_stores_pixels_of_listed_tiles(spark):
    cells = _scattered(spark, bands=True)
    tiles = cells.select(F.lit(9).alias("z"), F.floor(F.col("gx") / 64).alias("x"), F.floor(F.col("gy") / 64).alias("y")).where("(x + y) % 2 = 1").distinct()
    out = J.chunk(spark, cells, 10, 9, 32, scratch_path(spark, "t-sparse-bands"), tiles=tiles, dtype="f8", nodata=NODATA)
    exp = C.paint_and_average(cells, 2, extra_keys=("band",)).where("(floor(gx / 32) + floor(gy / 32)) % 2 = 1")
    assert sorted(B.unpack_blocks(out).select("band", "gx", "gy", "v").collect()) == sorted(exp.select("band", "gx", "gy", "v").collect())
    assert out.select(F.max(F.octet_length("data"))).first()[0] < 100


def test_sparse_blocks_cut_short_are_told(spark):
    blk = B.pack_blocks(spark.createDataFrame([(3, 4, 5.0)], "gx long, gy long, v double"), 32, 3, nodata=NODATA, sparse=True)
    assert [r.e for r in blk.select(B.block_error().alias("e")).collect()] == [None]
    cut = blk.withColumn("data", F.expr("substring(data, 1, 20)"))
    assert [r.e for r in cut.select(B.block_error().alias("e")).collect()] == ["20 of 8192 bytes"]


def _wide(spark):
    """Overlapping sources with a column per band: missing values and priorities, NaN, equal (priority, tie), a full tile."""
    rng = np.random.default_rng(5)
    rows = [(int(g[0]), int(g[1]), int(p) if p else None, int(t), *[None if v == 0 else float("nan") if v == 1 else float(v) for v in vs])
            for g, p, t, vs in zip(rng.integers(0, 90, (3000, 2)), rng.integers(0, 3, 3000), rng.integers(0, 2, 3000), rng.integers(0, 12, (3000, 2)))]
    rows += [(gx, gy, 1, 5, float(gx), float(gy)) for gx in range(96, 128) for gy in range(32)]
    rows += [(gx, 7, p, 1, None, None) for gx in (500, 501) for p in (1, 2)]
    wide = spark.createDataFrame(rows, "gx long, gy long, priority int, tie long, a double, b double")
    each = [wide.select("gx", "gy", "priority", "tie", F.lit(n).alias("band"), F.col(c).alias("v")) for n, c in ((1, "a"), (4, "b"))]
    return wide, each[0].unionByName(each[1])


def _pixels(blocks):
    return sorted(B.unpack_blocks(blocks).select("band", "gx", "gy", "v").collect())


def test_f2_bands_in_columns_paint_as_bands_in_rows_with_one_shuffle(spark):
    wide, rows = _wide(spark)
    painted = MO.paint_blocks(wide, 32, 10, bands={1: "a", 4: "b"})
    assert painted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got, best = _pixels(painted), {}
    for r in rows.where("v is not null").collect():
        key = (-1 if r.priority is None else r.priority, r.tie, float("inf") if r.v != r.v else r.v)
        best[r.band, r.gx, r.gy] = max(best.get((r.band, r.gx, r.gy), key), key)
    assert got == sorted((*k, v[2]) for k, v in best.items() if v[0] >= 0 and v[2] != float("inf"))
    assert got == _pixels(MO.paint_blocks(rows, 32, 10))
    hot = MO.paint_blocks(wide, 32, 10, share=300, bands={1: "a", 4: "b"})            # some tiles salted, others not
    assert "salt" in hot._jdf.queryExecution().executedPlan().toString() and _pixels(hot) == got


def test_f2_tiles_without_a_hot_one_are_not_counted_by_key(spark):
    rows = _scattered(spark).select("gx", "gy")
    assert SW.found_hot(rows, ["gx", "gy"], 1000) is None
    assert SW.found_hot(rows.withColumn("k", F.lit(1)), ["k"], 1000).collect()[0].asDict() == {"k": 1, "_salts": 2}


def test_f4_bands_in_columns_chunk_as_bands_in_rows(spark):
    wide, rows = _wide(spark)
    rows, wide = rows.where("not isnan(v) or v is null"), wide.select(
        "gx", "gy", "priority", "tie", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("a", "b")])
    tiles = wide.select(F.lit(9).alias("z"), F.floor(F.col("gx") / 64).alias("x"), F.floor(F.col("gy") / 64).alias("y")).where("x <> 1 or y <> 0").distinct()
    made = [J.chunk(spark, df, 10, 9, 32, scratch_path(spark, "t-wide"), tiles=tiles, dtype="f8", nodata=NODATA, **more)
            for df, more in ((wide, {"bands": {1: "a", 4: "b"}}), (rows, {}))]
    got, exp = [sorted(m.select("z", "x", "y", "band", "valid_count").collect()) for m in made]
    assert got == exp and len(got) > 4
    assert _pixels(made[0]) == _pixels(made[1])
