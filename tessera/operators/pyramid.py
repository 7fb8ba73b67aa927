"""Pyramid building in block form (Z2): every lower zoom level down to ``min_zoom``.

Each parent tile is built from its (at most four) children: a child is halved
(``nearest`` picks pixel 2i+1 on both axes, ``average`` stores the mean and
carries exact sums and counts beside it), placed in its quadrant, and empty parents are dropped.

Scale design:
* one shuffle per *pass*, not per level: blocks are grouped by their ancestor
  ``levels`` zooms up, and the kernel folds all intermediate levels inside the
  group.  A group holds at most 4**levels blocks, so ``levels`` is chosen from
  a memory budget per group;
* each pass is written to the tile store (partitioned by ``z``) and the next
  pass reads only its top level back (partition pruning), which also cuts the
  lineage: a lost executor re-runs at most one pass.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from ..functions import grid
from ..session import path_exists, scratch_path

METHODS = ("nearest", "average")


def _halve(vals: np.ndarray, cnt: np.ndarray | None, method: str, pick=(1, 1)):
    """Halve a float array (NaN = missing). Returns (values, counts or None)."""
    if method == "nearest":
        return vals[pick[0]::2, pick[1]::2], None
    h, w = vals.shape
    if cnt is None:
        cnt = (~np.isnan(vals)).astype(np.int64)
    sums = np.nan_to_num(vals, nan=0.0).reshape(h // 2, 2, w // 2, 2).sum(axis=(1, 3))
    cnts = cnt.reshape(h // 2, 2, w // 2, 2).sum(axis=(1, 3))
    sums[cnts == 0] = np.nan
    return sums, cnts


def _merge_children(children: list[tuple], size: int, method: str, pick=(1, 1)):
    """children: (x, y, vals, cnt) at one zoom, all with the same parent."""
    out = np.full((size, size), np.nan)
    cnt_out = np.zeros((size, size), dtype=np.int64) if method == "average" else None
    half = size // 2
    for x, y, vals, cnt in children:
        sub, sub_cnt = _halve(vals, cnt, method, pick)
        dx, dy = (x % 2) * half, (y % 2) * half
        out[dy:dy + half, dx:dx + half] = sub
        if cnt_out is not None:
            cnt_out[dy:dy + half, dx:dx + half] = sub_cnt
    return out, cnt_out


def _pass_kernel(levels: int, method: str, min_zoom: int, pick=(1, 1)):
    """Fold one group's blocks up ``levels`` zooms; ``allowed``: the parents of the list one zoom up (None: all)."""
    def kernel(key, rows, allowed: set | None = None):
        if not rows:
            return []
        size, band, z = B.one_size(rows), rows[0]["band"], rows[0]["z"]
        cur = {}
        for r in rows:
            if method == "average":
                sums, cnt = B.row_sums(r)
                vals = np.where(cnt > 0, sums, np.nan)
            else:
                vals, cnt = B.row_values(r), None
            cur[(r["x"], r["y"])] = (vals, cnt, (r["dtype"], (r["nodata"],)))
        out = []
        for _ in range(levels):
            if z <= min_zoom:
                break
            z -= 1
            groups: dict = {}
            for (x, y), (vals, cnt, layout) in cur.items():
                if allowed is None or (x >> 1, y >> 1) in allowed:
                    groups.setdefault((x >> 1, y >> 1), []).append((x, y, vals, cnt, layout))
            if allowed is not None:
                allowed = {(x >> 1, y >> 1) for x, y in allowed}
            nxt = {}
            for (px, py), kids in groups.items():
                vals, cnt = _merge_children([k[:4] for k in kids], size, method, pick)
                dtype, nodatas = B.joint_layout([k[4] for k in kids])
                if method == "average":
                    valid = int((cnt > 0).sum())
                    if valid == 0:
                        continue
                    mean = vals / np.maximum(cnt, 1)
                    if np.dtype(dtype).kind != "f":
                        mean = np.rint(mean)
                    dtype, nodata = B.fit_layout(mean, dtype, nodatas)
                    arr, _ = B.from_float(mean, dtype, nodata)
                    out.append(B.block_record(z, px, py, band, size, dtype, nodata, arr, valid,
                                              weight=B.encode_sums(np.nan_to_num(vals, nan=0.0), cnt)))
                else:
                    dtype, nodata = B.fit_layout(vals, dtype, nodatas)
                    arr, valid = B.from_float(vals, dtype, nodata)
                    if valid == 0:
                        continue   # all-nodata parent: dropped
                    out.append(B.block_record(z, px, py, band, size, dtype, nodata, arr, valid))
                nxt[(px, py)] = (vals, cnt, (dtype, (nodata,)))
            cur = nxt
        return out
    return kernel


def _fold_sparse(tbl, levels: int, min_zoom: int):
    """The average of whole groups of sparse blocks, pixel by pixel: block batches, or None if the blocks are not all
    sparse floats of one layout, a tile comes twice, or a mean is the nodata value."""
    cols = {c: tbl.column(c).to_pylist() for c in ("z", "size", "dtype", "nodata", "data", "weight")}
    if any(len(set(cols[c])) != 1 for c in ("z", "size", "dtype", "nodata")):
        return None
    z, size, dtype, nodata = (cols[c][0] for c in ("z", "size", "dtype", "nodata"))
    if nodata is None or dtype not in ("f4", "f8") or size % 2 or not all(B.is_sparse(d, dtype, size) for d in cols["data"]):
        return None
    sums = cols["weight"][0] is not None
    if not all((w is not None) == sums and (not sums or B.is_sparse_sums(w, size)) for w in cols["weight"]):
        return None
    x, y, band = (tbl.column(c).to_numpy().astype(np.int64) for c in ("x", "y", "band"))
    if len(np.unique(np.stack((x, y, band)), axis=1)[0]) != len(x):
        return None
    of, recs = B.pixel_records(cols["weight" if sums else "data"], B.SPARSE_SUMS if sums else B.sparse_record(dtype))
    ok = recs["c"] > 0 if sums else B.valid_mask(recs["v"], nodata) & ~np.isnan(recs["v"])
    of, recs = of[ok], recs[ok]
    off = recs["off"].astype(np.int64)
    gx, gy, gb = x[of] * size + off % size, y[of] * size + off // size, band[of]
    total = recs["s"] if sums else recs["v"].astype(np.float64)
    count = recs["c"] if sums else np.ones(len(of), np.int64)
    out = []
    for _ in range(levels):
        if z <= min_zoom or not len(gx):
            break
        z, gx, gy = z - 1, gx >> 1, gy >> 1
        off = (gy % size) * size + gx % size
        order = np.lexsort((off, gx // size, gy // size, gb))
        gx, gy, gb, off, total, count = (a[order] for a in (gx, gy, gb, off, total, count))
        first = np.flatnonzero(np.append(True, (gx[1:] != gx[:-1]) | (gy[1:] != gy[:-1]) | (gb[1:] != gb[:-1])))
        gx, gy, gb, off, total, count = gx[first], gy[first], gb[first], off[first], np.add.reduceat(total, first), np.add.reduceat(count, first)
        mean = (total / count).astype("<" + dtype)
        if not B.valid_mask(mean, nodata).all() or np.isnan(mean).any():
            return None
        tx, ty = gx // size, gy // size
        starts = np.flatnonzero(np.append(True, (tx[1:] != tx[:-1]) | (ty[1:] != ty[:-1]) | (gb[1:] != gb[:-1])))
        n = np.diff(np.append(starts, len(gx)))
        few = (n + 1) * B.sparse_record(dtype).itemsize < size * size * int(dtype[1:])
        if few.any():
            held, at = np.repeat(few, n), np.cumsum(n[few]) - n[few]
            data = B.sparse_arrays(B.sparse_record(dtype), at, {"off": off[held], "v": mean[held]}, fill=nodata)
            weight = B.sparse_arrays(B.SPARSE_SUMS, at, {"off": off[held], "s": total[held], "c": count[held]})
            s = starts[few]
            out.append(B.block_batch([np.full(len(s), z), tx[s], ty[s], gb[s]], size, dtype, nodata, n[few], data, weight))
        dense = []
        for s, k in zip(starts[~few].tolist(), n[~few].tolist()):
            arr, planes = np.full(size * size, nodata, dtype="<" + dtype), (np.zeros(size * size), np.zeros(size * size, np.int64))
            for plane, vals in zip((arr, *planes), (mean, total, count)):
                plane[off[s:s + k]] = vals[s:s + k]
            dense.append(B.block_record(z, tx[s], ty[s], gb[s], size, dtype, nodata, arr, k, weight=B.encode_sums(*planes)))
        if dense:
            out += B.records_to_table(dense).to_batches()
    return out


def levels_for_budget(size: int, dtype: str, method: str, budget_bytes: int = 256 << 20,
                      max_levels: int = 3) -> int:
    """Levels per pass so that 4**levels input blocks fit the per-group budget
    (at most ``max_levels``: groups of <= 64 blocks keep passes parallel)."""
    per_block = size * size * (8 + (8 if method == "average" else 0))   # float64 working copy (+counts)
    fit = int(math.floor(math.log(max(budget_bytes / per_block, 1.0), 4)))
    return max(1, min(max_levels, fit))


def _up(c: str, levels: int) -> F.Column:
    return F.call_function("shiftright", F.col(c), F.lit(levels)).cast("int")


def pyramid_pass(blocks: DataFrame, levels: int, method: str = "nearest", min_zoom: int = 0,
                 pick=(1, 1), parents: DataFrame | None = None) -> DataFrame:
    """One shuffle: group blocks by their ancestor ``levels`` up and emit every level in between.
    ``pick`` = (row, col) parity kept by ``nearest`` (the reference's reads keep pixel 2i+1).

    ``parents`` (z, x, y one zoom up): the tile list's parents.  They are cogrouped with the blocks under
    the same ancestor, and every level inside the group is built from listed parents only.
    """
    if parents is not None:
        kernel = _pass_kernel(levels, method, min_zoom, pick)

        def fold(key, tbl, listed):
            allowed = set(zip(listed.column("x").to_pylist(), listed.column("y").to_pylist()))
            rows, out = tbl.select(B.BLOCK_COLUMNS).to_pylist(), []
            for band in sorted({r["band"] for r in rows}):
                out += kernel(key, [r for r in rows if r["band"] == band], allowed)
            return B.records_to_table(out)

        def grouped(df, z_up, up):
            return df.select((F.col("z") - z_up).cast("int").alias("_k0"), _up("x", up).alias("_k1"), _up("y", up).alias("_k2"),
                             *df.columns).groupBy("_k0", "_k1", "_k2")

        held = blocks.select(*B.BLOCK_COLUMNS)
        return (grouped(held, levels, levels).cogroup(grouped(parents.select("z", "x", "y"), levels - 1, levels - 1))
                .applyInArrow(fold, B.BLOCK_SCHEMA))
    keys = [F.col("z") - levels, F.col("band"),
            F.call_function("shiftright", F.col("x"), F.lit(levels)),
            F.call_function("shiftright", F.col("y"), F.lit(levels))]
    quick = (lambda tbl: _fold_sparse(tbl, levels, min_zoom)) if method == "average" else None
    return B.fold_blocks_sorted(blocks, keys, _pass_kernel(levels, method, min_zoom, pick), quick)


TILE_KEY = ["z", "x", "y", "band"]
BUCKET_LEVELS = 3            # a bucket holds the tiles under one ancestor this many levels up: 64 at most a band
STORE_SCHEMA = T.StructType([*B.BLOCK_FIELDS, T.StructField("bucket", T.StringType(), True)])


def tile_bucket(x="x", y="y", z="z") -> F.Column:
    """Partition of a stored tile: "q" and the quadkey digits of its ancestor ``BUCKET_LEVELS`` up (just "q" above)."""
    up = F.greatest(grid.col(z) - BUCKET_LEVELS, F.lit(0)).cast("int")
    return F.concat(F.lit("q"), F.substring(grid.quadkey(x, y, z), F.lit(1), up))


def write_level_store(df: DataFrame, store: str, levels: tuple | None = None, grouped: bool = False) -> None:
    """K1: tiles keyed by (z, x, y, band): a tile replaces the stored one of its key, all others stay.

    The store is partitioned by zoom and by quadkey prefix (O1: inside a file, tiles lie in quadkey order), so that
    tiles near each other share a folder.  Only the buckets that new tiles fall into are written: they are read, merged
    by key and replaced; every other bucket is left as it is.  Where the store has nothing at the zooms
    written (``levels``, if the caller knows them), the tiles go straight into it.  Tiles are brought together by
    bucket before they are written, unless the caller's rows are ``grouped`` by an ancestor already.
    """
    spark = df.sparkSession
    new = df.select(*B.BLOCK_COLUMNS, tile_bucket().alias("bucket"))
    if path_exists(spark, store) and (levels is None or any(path_exists(spark, f"{store}/z={z}") for z in levels)):
        new = _through_scratch(new, "tiles-new")
        touched = new.select("z", "bucket").distinct()
        old = spark.read.schema(STORE_SCHEMA).parquet(store).join(touched, ["z", "bucket"], "left_semi")
        kept = old.join(new.select(*TILE_KEY), TILE_KEY, "left_anti").select(*new.columns)
        # the buckets are replaced while they are read, so what stays of them is put aside first
        new = new.unionByName(_through_scratch(kept, "tiles-kept"))
    if not grouped:
        new = new.hint("rebalance", "z", "bucket")
    (new.sortWithinPartitions("z", "bucket", grid.morton("x", "y"), "band")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("z", "bucket").parquet(store))


def _through_scratch(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_level_store(spark: SparkSession, store: str, z: int | None = None) -> DataFrame:
    df = spark.read.schema(STORE_SCHEMA).parquet(store)        # known schema: no inference job
    if z is not None:
        df = df.where(F.col("z") == z)        # partition pruning
    return df.select(*B.BLOCK_COLUMNS)


def build_pyramid(spark: SparkSession, base: DataFrame, base_zoom: int, store: str,
                  min_zoom: int = 0, method: str = "nearest", levels_per_pass: int | None = None,
                  size: int | None = None, dtype: str | None = None, tiles: DataFrame | None = None,
                  pick=(1, 1), base_stored: bool = False) -> DataFrame:
    """Write ``base`` (blocks at ``base_zoom``) and all lower levels to ``store``; return the store.

    ``base_stored``: the base is what the store holds at ``base_zoom``, so it is not written again.

    ``tiles`` (optional, columns z,x,y at base_zoom) is the tile list: only
    ancestors of listed tiles are built (parents come from the list, content
    from the store).
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if not base_stored:
        write_level_store(base, store, (base_zoom,))
    if levels_per_pass is None:
        levels_per_pass = levels_for_budget(size or 2048, dtype or "f4", method)
    z = base_zoom
    while z > min_zoom:
        levels = min(levels_per_pass, z - min_zoom)
        src = read_level_store(spark, store, z)
        parents = None
        if tiles is not None:
            k = base_zoom - z + 1
            parents = tiles.select((F.col("z") - k).cast("int").alias("z"), _up("x", k).alias("x"), _up("y", k).alias("y")).distinct()
        write_level_store(pyramid_pass(src, levels, method, min_zoom, pick, parents), store, tuple(range(z - levels, z)), grouped=True)
        z -= levels
    return read_level_store(spark, store)
