"""Pixel reprojection between coordinate systems (J4 + R2/R4 with a CRS change, Z3).

A raster grid is ``Grid(crs, x0, y0, dx, dy)``: pixel (i, j) has its centre at
``(x0 + (i + .5) dx, y0 - (j + .5) dy)`` in ``crs`` (north up).

Target pixel t is resampled from the source at the inverse-projected centre
``s`` (in source pixel units, integers at pixel centres): bilinear reads
``floor(s)`` and ``floor(s) + 1`` on each axis, nearest reads ``floor(s + .5)``.
``average`` takes the mean of the source pixels whose projected centre lies in the target
pixel, and where there is none (target finer than source) the pixel that nearest reads.
Written as scatter + aggregate: each valid source cell maps the corners of the
region of ``s`` values that would read it forward into the target grid, proposes
the target cells inside (plus a one-cell margin), and keeps exactly those whose
inverse-projected centre reads it.  One hash aggregate then forms
``sum(w v) / sum(w)``.  Projection formulas are staged Column expressions
(see :func:`tessera.functions.crs.add_points`), so everything but UTM's series stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import crs as CRS
from . import blocks as B


METHODS = ("bilinear", "nearest", "average")


@dataclass(frozen=True)
class Grid:
    """North-up pixel grid.  Each of x0, y0, dx, dy is a number, or the name of a
    column holding it (one grid per row, e.g. per source raster)."""
    crs: str
    x0: float | str
    y0: float | str
    dx: float | str
    dy: float | str

    def columns(self) -> list[str]:
        return [v for v in (self.x0, self.y0, self.dx, self.dy) if isinstance(v, str)]

    def at(self, row: dict) -> "Grid":
        """The grid of one row: numbers only."""
        return Grid(self.crs, *[float(row[v]) if isinstance(v, str) else v for v in (self.x0, self.y0, self.dx, self.dy)])


def _c(v):
    return F.col(v) if isinstance(v, str) else F.lit(float(v))


def _add_points(df: DataFrame, src: str, dst: str, points: list[tuple]) -> DataFrame:
    """Columns for projected points, ``(x, y, name of the projected x, of the projected y)``.

    Column expressions, but for UTM: its series for several points make one generated method larger than the JVM
    compiles, and interpreted they are slow; there the points are projected batch by batch in NumPy (a narrow map).
    """
    if src.upper() == dst.upper() or not any(c.upper().startswith("UTM:") for c in (src, dst)):
        return CRS.add_points(df, src, dst, points)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for p in points for n in p[2:]]])

    def run(batches):
        for rb in batches:
            cols, names = list(rb.columns), list(rb.schema.names)
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                for x, y, px, py in points:
                    X, Y = np_transform(src, dst, *[rb.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in (x, y)])
                    cols += [pa.array(X, pa.float64()), pa.array(Y, pa.float64())]
                    names += [px, py]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return df.mapInArrow(run, schema)


def warp_crs(df: DataFrame, src: Grid, dst: Grid, method: str = "bilinear", extra_keys=(),
             margin: int = 1) -> DataFrame:
    """Resample cells ``(gx, gy, v)`` on ``src`` onto ``dst``; returns ``(extra_keys.., gx, gy, v)``
    on ``dst``.  Grid parameters given as column names are read per row.

    ``margin``: target pixels proposed beyond the corners' box on each side (it must cover the bend of a pixel's edge)."""
    if method not in METHODS:
        raise ValueError(method)
    lo, hi = (-1.0, 1.0) if method == "bilinear" else (-0.5, 0.5)
    carry = list(dict.fromkeys(src.columns() + dst.columns()))
    sx0, sy0, sdx, sdy = (_c(v) for v in (src.x0, src.y0, src.dx, src.dy))
    dx0, dy0, ddx, ddy = (_c(v) for v in (dst.x0, dst.y0, dst.dx, dst.dy))
    cells = df.where(F.col("v").isNotNull()).select(*extra_keys, *carry, "gx", "gy", "v")
    # corners of the s-region reading this cell, in source CRS coordinates
    corners = []
    for k, (ox, oy) in enumerate(((lo, lo), (lo, hi), (hi, lo), (hi, hi))):
        cells = cells.withColumn(f"_cx{k}", sx0 + (F.col("gx") + ox + 0.5) * sdx) \
                     .withColumn(f"_cy{k}", sy0 - (F.col("gy") + oy + 0.5) * sdy)
        corners.append((f"_cx{k}", f"_cy{k}", f"_tx{k}", f"_ty{k}"))
    direct = []                                 # average: the target cell that holds the centre
    if method == "average":
        cells = cells.withColumn("_mx", sx0 + (F.col("gx") + 0.5) * sdx).withColumn("_my", sy0 - (F.col("gy") + 0.5) * sdy)
        corners.append(("_mx", "_my", "_tmx", "_tmy"))
        direct = [F.floor((F.col("_tmx") - dx0) / ddx).alias("_di"), F.floor((dy0 - F.col("_tmy")) / ddy).alias("_dj")]
    held = ["_di", "_dj"] if direct else []
    fwd = _add_points(cells, src.crs, dst.crs, corners)
    txs = [(F.col(f"_tx{k}") - dx0) / ddx - 0.5 for k in range(4)]
    tys = [(dy0 - F.col(f"_ty{k}")) / ddy - 0.5 for k in range(4)]
    ranged = fwd.select(*extra_keys, *carry, "gx", "gy", "v", *direct,
                        F.greatest(F.ceil(F.least(*txs) - margin), F.lit(0)).alias("_ti0"),
                        F.floor(F.greatest(*txs) + margin).alias("_ti1"),
                        F.greatest(F.ceil(F.least(*tys) - margin), F.lit(0)).alias("_tj0"),
                        F.floor(F.greatest(*tys) + margin).alias("_tj1"))
    # explode_outer + null filter: no inferred filter copies the projection into the scan
    cand = (ranged.select("*", F.explode_outer(F.sequence("_ti0", F.greatest("_ti0", "_ti1"))).alias("ti"))
                  .where(F.col("ti").isNotNull())
                  .select("*", F.explode_outer(F.sequence("_tj0", F.greatest("_tj0", "_tj1"))).alias("tj"))
                  .where(F.col("tj").isNotNull())
                  .select(*extra_keys, *carry, "gx", "gy", "v", *held, "ti", "tj",
                          (dx0 + (F.col("ti") + 0.5) * ddx).alias("_X"),
                          (dy0 - (F.col("tj") + 0.5) * ddy).alias("_Y")))
    inv = _add_points(cand, dst.crs, src.crs, [("_X", "_Y", "_SX", "_SY")])
    sx = (F.col("_SX") - sx0) / sdx - 0.5
    sy = (sy0 - F.col("_SY")) / sdy - 0.5
    s = inv.select(*extra_keys, "gx", "gy", "v", *held, "ti", "tj", sx.alias("sx"), sy.alias("sy"))
    read = (F.floor(F.col("sx") + 0.5) == F.col("gx")) & (F.floor(F.col("sy") + 0.5) == F.col("gy"))
    if method == "average":
        inside = (F.col("_di") == F.col("ti")) & (F.col("_dj") == F.col("tj"))
        return (s.where(inside | read).groupBy(*extra_keys, F.col("ti").alias("gx"), F.col("tj").alias("gy"))
                 .agg(F.avg(F.when(inside, F.col("v"))).alias("_mean"), F.max(F.when(read, F.col("v"))).alias("_near"))
                 .select(*extra_keys, "gx", "gy", F.coalesce(F.col("_mean"), F.col("_near").cast("double")).alias("v")))
    if method == "nearest":
        return (s.where(read)
                 .select(*extra_keys, F.col("ti").alias("gx"), F.col("tj").alias("gy"), "v"))
    fx, fy = F.floor("sx"), F.floor("sy")
    wx = F.when(fx == F.col("gx"), 1 - (F.col("sx") - fx)).when(fx + 1 == F.col("gx"), F.col("sx") - fx)
    wy = F.when(fy == F.col("gy"), 1 - (F.col("sy") - fy)).when(fy + 1 == F.col("gy"), F.col("sy") - fy)
    w = s.select(*extra_keys, "ti", "tj", "v", (wx * wy).alias("w")).where(F.col("w") > 0)
    return (w.groupBy(*extra_keys, "ti", "tj")
             .agg(F.sum(F.col("w") * F.col("v")).alias("wv"), F.sum("w").alias("ws"))
             .select(*extra_keys, F.col("ti").alias("gx"), F.col("tj").alias("gy"),
                     (F.col("wv") / F.col("ws")).alias("v")))


# ---------------------------------------------------------------------------- block form
# NumPy twins of the Column projections in tessera.functions.crs (same formulas), for kernels.
def _np_to_lonlat(crs: str, x, y):
    crs = crs.upper()
    if crs == "EPSG:4326":
        return x, y
    if crs == "EPSG:3857":
        from ..functions.grid import EARTH_RADIUS
        return np.degrees(x / EARTH_RADIUS), np.degrees(2 * np.arctan(np.exp(y / EARTH_RADIUS)) - np.pi / 2)
    if crs.startswith("UTM:"):
        k = CRS.utm_constants(int(crs[4:]))
        xi, eta = y / k["k0A"], (x - CRS.UTM_FALSE_EASTING) / k["k0A"]
        xp, ep = xi.copy(), eta.copy()
        for j, b in enumerate(k["beta"], start=1):
            xp = xp - b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
            ep = ep - b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        chi = np.arcsin(np.sin(xp) / np.cosh(ep))
        lat = chi.copy()
        for j, d in enumerate(k["delta"], start=1):
            lat = lat + d * np.sin(2 * j * chi)
        return k["lon0"] + np.degrees(np.arctan2(np.sinh(ep), np.cos(xp))), np.degrees(lat)
    raise ValueError(crs)


def _np_from_lonlat(crs: str, lon, lat):
    crs = crs.upper()
    if crs == "EPSG:4326":
        return lon, lat
    if crs == "EPSG:3857":
        from ..functions.grid import EARTH_RADIUS
        return EARTH_RADIUS * np.radians(lon), EARTH_RADIUS * np.log(np.tan(np.pi / 4 + np.radians(lat) / 2))
    if crs.startswith("UTM:"):
        k = CRS.utm_constants(int(crs[4:]))
        n = k["n"]
        phi, dl = np.radians(lat), np.radians(lon - k["lon0"])
        c = 2 * np.sqrt(n) / (1 + n)
        t = np.sinh(np.arctanh(np.sin(phi)) - c * np.arctanh(c * np.sin(phi)))
        xp, ep = np.arctan(t / np.cos(dl)), np.arctanh(np.sin(dl) / np.sqrt(1 + t * t))
        e, nn = ep.copy(), xp.copy()
        for j, a in enumerate(k["alpha"], start=1):
            e = e + a * np.cos(2 * j * xp) * np.sinh(2 * j * ep)
            nn = nn + a * np.sin(2 * j * xp) * np.cosh(2 * j * ep)
        return CRS.UTM_FALSE_EASTING + k["k0A"] * e, k["k0A"] * nn
    raise ValueError(crs)


def np_transform(src: str, dst: str, x, y):
    if src.upper() == dst.upper():
        return x, y
    lon, lat = _np_to_lonlat(src, x, y)
    return _np_from_lonlat(dst, lon, lat)


PART_SCHEMA = T.StructType([
    T.StructField("tx", T.IntegerType(), False), T.StructField("ty", T.IntegerType(), False),
    T.StructField("band", T.IntegerType(), False), T.StructField("k", T.StringType(), True),
    T.StructField("p", T.LongType(), False), T.StructField("t", T.LongType(), False), T.StructField("off", T.BinaryType(), False),
    T.StructField("num", T.BinaryType(), False), T.StructField("den", T.BinaryType(), False),
    T.StructField("near", T.BinaryType(), False),
])
_PART_ARROW = pa.schema([("tx", pa.int32()), ("ty", pa.int32()), ("band", pa.int32()), ("k", pa.string()), ("p", pa.int64()), ("t", pa.int64()),
                         ("off", pa.binary()), ("num", pa.binary()), ("den", pa.binary()), ("near", pa.binary())])
STRIP_PIXELS = 1 << 18       # pixels projected at a time
PART_BYTES = 8 << 20         # partials per emitted batch
_ROW = 1 << 31               # target pixel (i, j) as one number: j * _ROW + i


def _window(size, gx0, gy0, g, src_crs, dst, extent):
    """Target pixels [i0, i1) x [j0, j1) that a block's pixels and one around them can reach: every
    pixel of its four edges is projected, so edges that bulge are followed."""
    k = np.arange(-1.0, size + 2.0)
    lo, hi = np.full(k.size, -1.0), np.full(k.size, size + 1.0)
    px, py = gx0 + np.concatenate((k, k, lo, hi)), gy0 + np.concatenate((lo, hi, k, k))
    X, Y = np_transform(src_crs, dst.crs, g[0] + px * g[2], g[1] - py * g[3])
    u, v = (X - dst.x0) / dst.dx, (dst.y0 - Y) / dst.dy
    ok = np.isfinite(u) & np.isfinite(v)
    if not ok.any():
        return 0, 0, 0, 0
    i0, j0 = max(int(np.floor(u[ok].min())) - 1, 0), max(int(np.floor(v[ok].min())) - 1, 0)
    i1, j1 = int(np.floor(u[ok].max())) + 2, int(np.floor(v[ok].max())) + 2
    if extent is not None:
        i1, j1 = min(i1, extent[0]), min(j1, extent[1])
    return i0, i1, j0, j1


def _centre_sums(vals, gx0, gy0, g, src_crs, dst, win):
    """(target pixel numbers ascending, sums, counts) of the valid pixels by the target pixel that holds their centre."""
    size = vals.shape[0]
    ids, sums, counts = [], [], []
    step = max(1, STRIP_PIXELS // size)
    for r in range(0, size, step):
        v = vals[r:r + step]
        jj, ii = np.nonzero(~np.isnan(v))
        if not len(jj):
            continue
        X, Y = np_transform(src_crs, dst.crs, g[0] + (gx0 + ii + 0.5) * g[2], g[1] - (gy0 + r + jj + 0.5) * g[3])
        ti, tj = np.floor((X - dst.x0) / dst.dx), np.floor((dst.y0 - Y) / dst.dy)
        ok = (ti >= win[0]) & (ti < win[1]) & (tj >= win[2]) & (tj < win[3])      # false for NaN
        u, inv = np.unique(tj[ok].astype(np.int64) * _ROW + ti[ok].astype(np.int64), return_inverse=True)
        ids.append(u)
        sums.append(np.bincount(inv, v[jj[ok], ii[ok]], len(u)))
        counts.append(np.bincount(inv, minlength=len(u)))
    if not ids:
        return np.empty(0, np.int64), np.empty(0), np.empty(0)
    u, inv = np.unique(np.concatenate(ids), return_inverse=True)
    return u, np.bincount(inv, np.concatenate(sums), len(u)), np.bincount(inv, np.concatenate(counts), len(u))


def _axis_partials(vals, gx0, gy0, g, dst: Grid, size_t: int, method: str, win):
    """:func:`_block_partials` for grids of one CRS (nearest, average): rows and columns are independent, so pixels are
    picked and summed by whole rows and columns."""
    i0, i1, j0, j1 = win
    size, none = vals.shape[0], np.empty(0)
    # the source pixel that holds each target centre
    pick_c = np.floor((dst.x0 + (np.arange(i0, i1) + 0.5) * dst.dx - g[0]) / g[2] - 0.5 + 0.5) - gx0
    pick_r = np.floor((g[1] - (dst.y0 - (np.arange(j0, j1) + 0.5) * dst.dy)) / g[3] - 0.5 + 0.5) - gy0
    sums = counts = None
    if method == "average":                                # by the target pixel that holds each source centre
        k = np.arange(size)
        ti = np.floor((g[0] + (gx0 + k + 0.5) * g[2] - dst.x0) / dst.dx)
        tj = np.floor((dst.y0 - (g[1] - (gy0 + k + 0.5) * g[3])) / dst.dy)
        cs, rs = (np.flatnonzero(np.append(True, t[1:] != t[:-1])) for t in (ti, tj))
        ok = ~np.isnan(vals)
        s, c = (np.add.reduceat(np.add.reduceat(a, rs, axis=0), cs, axis=1) for a in (np.where(ok, vals, 0.0), ok.astype(np.int64)))
        in_r, in_c = (tj[rs] >= j0) & (tj[rs] < j1), (ti[cs] >= i0) & (ti[cs] < i1)
        sums, counts = np.zeros((j1 - j0, i1 - i0)), np.zeros((j1 - j0, i1 - i0), np.int64)
        at = np.ix_((tj[rs][in_r] - j0).astype(np.int64), (ti[cs][in_c] - i0).astype(np.int64))
        sums[at], counts[at] = s[np.ix_(in_r, in_c)], c[np.ix_(in_r, in_c)]
    for ty in range(j0 // size_t, (j1 - 1) // size_t + 1):
        for tx in range(i0 // size_t, (i1 - 1) // size_t + 1):
            a0, a1 = max(i0, tx * size_t), min(i1, (tx + 1) * size_t)
            b0, b1 = max(j0, ty * size_t), min(j1, (ty + 1) * size_t)
            part = slice(b0 - j0, b1 - j0), slice(a0 - i0, a1 - i0)
            off = ((np.arange(b0, b1) % size_t) * size_t)[:, None] + (np.arange(a0, a1) % size_t)[None, :]
            rows, cols = pick_r[part[0]], pick_c[part[1]]
            ok_r, ok_c = (rows >= 0) & (rows < size), (cols >= 0) & (cols < size)
            near = np.full(off.shape, np.nan)
            near[np.ix_(ok_r, ok_c)] = vals[np.ix_(rows[ok_r].astype(np.int64), cols[ok_c].astype(np.int64))]
            m = ~np.isnan(near)
            if counts is not None:
                have = counts[part] > 0
                if have.any():
                    yield tx, ty, off[have], sums[part][have], counts[part][have].astype(np.float64), none
                m &= ~have
            if m.any():
                yield tx, ty, off[m], none, none, near[m]


def _block_partials(row, src: Grid, dst: Grid, size_t: int, method: str, extent):
    """What one source block gives to each target tile: (tx, ty, offsets, num, den, near)."""
    vals, size = B.row_values(row), row["size"]
    gx0, gy0 = row["x"] * size, row["y"] * size
    g = [row[v] if isinstance(v, str) else v for v in (src.x0, src.y0, src.dx, src.dy)]
    win = i0, i1, j0, j1 = _window(size, gx0, gy0, g, src.crs, dst, extent)
    if i0 >= i1 or j0 >= j1:
        return
    if src.crs.upper() == dst.crs.upper() and method != "bilinear" and (i1 - i0) * (j1 - j0) <= 8 * size * size + 64:
        yield from _axis_partials(vals, gx0, gy0, g, dst, size_t, method, win)
        return
    none = np.empty(0)
    direct = None
    if method == "average":
        direct, sums, counts = _centre_sums(vals, gx0, gy0, g, src.crs, dst, win)
        dj, di = direct // _ROW, direct % _ROW
        tiles, inv = np.unique(np.stack((di // size_t, dj // size_t)), axis=1, return_inverse=True)
        for k, (tx, ty) in enumerate(tiles.T):
            m = inv.reshape(-1) == k
            yield tx, ty, (dj[m] % size_t) * size_t + di[m] % size_t, sums[m], counts[m].astype(np.float64), none

    def tap(iy, ix):
        iy, ix = iy - gy0, ix - gx0
        ok = (iy >= 0) & (iy < size) & (ix >= 0) & (ix < size)
        out = np.full(iy.shape, np.nan)
        out[ok] = vals[iy[ok].astype(np.int64), ix[ok].astype(np.int64)]
        return out

    for ty in range(j0 // size_t, (j1 - 1) // size_t + 1):
        for tx in range(i0 // size_t, (i1 - 1) // size_t + 1):
            a0, a1 = max(i0, tx * size_t), min(i1, (tx + 1) * size_t)
            b0, b1 = max(j0, ty * size_t), min(j1, (ty + 1) * size_t)
            step = max(1, STRIP_PIXELS // (a1 - a0))
            for b in range(b0, b1, step):
                tj, ti = (m.ravel() for m in np.meshgrid(np.arange(b, min(b + step, b1)), np.arange(a0, a1), indexing="ij"))
                X, Y = np_transform(dst.crs, src.crs, dst.x0 + (ti + 0.5) * dst.dx, dst.y0 - (tj + 0.5) * dst.dy)
                sx, sy = (X - g[0]) / g[2] - 0.5, (g[1] - Y) / g[3] - 0.5
                off = (tj % size_t) * size_t + ti % size_t
                if method == "bilinear":
                    fx, fy = np.floor(sx), np.floor(sy)
                    num, den = np.zeros(off.size), np.zeros(off.size)
                    for dy in (0, 1):
                        for dx in (0, 1):
                            v = tap(fy + dy, fx + dx)
                            w = (1 - (sx - fx) if dx == 0 else sx - fx) * (1 - (sy - fy) if dy == 0 else sy - fy)
                            use = (w > 0) & ~np.isnan(v)
                            num += np.where(use, w * np.nan_to_num(v), 0.0)
                            den += np.where(use, w, 0.0)
                    m = den > 0
                    if m.any():
                        yield tx, ty, off[m], num[m], den[m], none
                    continue
                v = tap(np.floor(sy + 0.5), np.floor(sx + 0.5))
                m = ~np.isnan(v)
                if direct is not None:
                    m &= ~np.isin(tj.astype(np.int64) * _ROW + ti, direct)
                if m.any():
                    yield tx, ty, off[m], none, none, v[m]


def _partials(batches, src: Grid, dst: Grid, size_t: int, method: str, extent):
    out, held = [], 0
    for rb in batches:
        for i in range(rb.num_rows):
            row = rb.slice(i, 1).to_pylist()[0]
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                for tx, ty, off, num, den, near in _block_partials(row, src, dst.at(row), size_t, method, extent):
                    out.append({"tx": int(tx), "ty": int(ty), "band": row["band"], "k": row["k"], "p": row["p"], "t": row["t"],
                                "off": off.astype("<i4").tobytes(), "num": num.tobytes(), "den": den.tobytes(),
                                "near": near.tobytes()})
                    held += 4 * off.size + 8 * (num.size + den.size + near.size)
                    if held > PART_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=_PART_ARROW)
                        out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_PART_ARROW)


def _merge_partials(batches, size_t: int, zoom_t: int, out_dtype: str, out_nodata, key: str | None = None):
    """Partials sorted by tile and source -> blocks; four planes are held, however many sources meet a tile."""
    n = size_t * size_t
    tile = source = None
    done, num, den, near = np.full(n, np.nan), np.zeros(n), np.zeros(n), np.full(n, np.nan)

    def fold_source():
        with np.errstate(invalid="ignore", divide="ignore"):
            v = np.where(den > 0, num / den, near)
        np.copyto(done, v, where=~np.isnan(v))           # a later source lies over the earlier ones
        num[:], den[:], near[:] = 0.0, 0.0, np.nan

    def finish():
        fold_source()
        v = done.reshape(size_t, size_t)
        arr, valid = B.from_float(v if out_dtype[0] == "f" else np.rint(v), out_dtype, out_nodata)
        rec = B.block_record(zoom_t, tile[0], tile[1], tile[2], size_t, out_dtype, out_nodata, arr, valid)
        empty = np.isnan(done).all()
        done[:] = np.nan
        made = B.records_to_table([] if empty else [rec])
        return (made if key is None else made.append_column(key, pa.array([tile[3]] * made.num_rows, pa.string()))).to_batches()

    for rb in batches:
        for i in range(rb.num_rows):
            r = rb.slice(i, 1).to_pylist()[0]
            at, src = (r["tx"], r["ty"], r["band"], r["k"]), (r["p"], r["t"])
            if tile is not None and at != tile:
                yield from finish()
            elif tile is not None and src != source:
                fold_source()
            tile, source = at, src
            off = np.frombuffer(r["off"], "<i4")
            if r["num"]:
                num[off] += np.frombuffer(r["num"])
                den[off] += np.frombuffer(r["den"])
            if r["near"]:
                near[off] = np.frombuffer(r["near"])
    if tile is not None:
        yield from finish()


def warp_blocks_crs(blocks: DataFrame, src: Grid, dst: Grid, size_t: int, zoom_t: int,
                    method: str = "bilinear", out_dtype: str = "f8", out_nodata=-3.4028234663852886e38,
                    order=(), tiles: DataFrame | None = None, extent: tuple | None = None, key: str | None = None) -> DataFrame:
    """Block form of :func:`warp_crs`; both grids may be columns of the blocks (one per source).

    Each source block is resampled where it lies: it gives every target tile it reaches the
    weighted sums (average: sums and counts) of the pixels it holds.  Only these partial sums are
    shuffled, and they are added per tile in a sorted streaming pass, so neither the ratio of the
    grids nor the number of sources bounds a group.  ``order`` names at most two integral columns
    that tell sources apart; the greatest one with a value wins a pixel (A8), after each source
    was resampled on its own.  ``tiles`` (x, y) keeps listed tiles only, before the shuffle;
    ``extent`` is the target grid's (width, height) in pixels, needed where the target CRS does
    not reach the whole source (latitudes beyond Mercator).  ``key`` names a string column whose values have
    targets of their own (a source with its own target grid): tiles are made per key, and the result carries it.
    """
    if method not in METHODS:
        raise ValueError(method)
    if dst.columns() and key is None:
        raise ValueError("target grids that differ by row need a key that tells their tiles apart")
    order = [F.col(c).cast("long") for c in order] + [F.lit(0).cast("long")] * (2 - len(order))
    own = F.lit(None).cast("string") if key is None else F.col(key)
    rows = blocks.where(F.col("valid_count") > 0).select(
        *[c for c in B.BLOCK_COLUMNS if c != "weight"], *dict.fromkeys(src.columns() + dst.columns()),
        own.alias("k"), order[0].alias("p"), order[1].alias("t"))
    parts = rows.mapInArrow(lambda it: _partials(it, src, dst, size_t, method, extent), PART_SCHEMA)
    if tiles is not None:
        wanted = tiles.select(F.col("x").cast("int").alias("tx"), F.col("y").cast("int").alias("ty"))
        parts = parts.join(wanted, ["tx", "ty"], "left_semi").select(*PART_SCHEMA.names)
    schema = B.BLOCK_SCHEMA if key is None else T.StructType([*B.BLOCK_FIELDS, T.StructField(key, T.StringType())])
    return (parts.repartition("k", "tx", "ty", "band").sortWithinPartitions("k", "tx", "ty", "band", "p", "t")
                 .mapInArrow(lambda it: _merge_partials(it, size_t, zoom_t, out_dtype, out_nodata, key), schema))


def reached_tiles(keys: DataFrame, size: int, src: Grid, dst: Grid, size_t: int, extent: tuple | None) -> DataFrame:
    """(x, y) of source blocks -> (x, y, tx, ty): the target tiles each can reach, from its projected edges alone."""
    def run(batches):
        for rb in batches:
            out = {"x": [], "y": [], "tx": [], "ty": []}
            for x, y in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                    i0, i1, j0, j1 = _window(size, x * size, y * size, (src.x0, src.y0, src.dx, src.dy), src.crs, dst, extent)
                for ty in range(j0 // size_t, (j1 - 1) // size_t + 1) if i0 < i1 and j0 < j1 else ():
                    for tx in range(i0 // size_t, (i1 - 1) // size_t + 1):
                        for k, v in (("x", x), ("y", y), ("tx", tx), ("ty", ty)):
                            out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int32()) for k in out]))
    return keys.select(F.col("x").cast("int"), F.col("y").cast("int")).mapInArrow(run, "x int, y int, tx int, ty int")


def mosaic_blocks_crs(blocks: DataFrame, src: Grid, size_m: int, order=(), tiles: DataFrame | None = None) -> tuple[DataFrame, Grid]:
    """A8/A9 in block form: sources of one CRS painted onto one grid of the finest source's pixels.

    Every mosaic pixel takes, from the greatest source by ``order`` that is valid there, the pixel that holds its
    centre.  The grid begins at the sources' upper left; its four numbers come from one small aggregate over
    the blocks' grid columns.  ``tiles`` (x, y of mosaic tiles) limits what is painted.
    """
    x0, y0, dx, dy = (_c(v) for v in (src.x0, src.y0, src.dx, src.dy))
    r = blocks.agg(F.min(x0).alias("x0"), F.max(y0).alias("y0"), F.min(dx).alias("dx"), F.min(dy).alias("dy")).first()
    grid = Grid(src.crs, *[0.0 if r[c] is None else float(r[c]) for c in ("x0", "y0")], *[1.0 if r[c] is None else float(r[c]) for c in ("dx", "dy")])
    return warp_blocks_crs(blocks, src, grid, size_m, 0, "nearest", "f8", float("nan"), order, tiles), grid
