"""Coordinate conversions as Column expressions.

Supported systems (the ones the reference's data uses): EPSG:4326 lon/lat,
EPSG:3857 spherical Mercator, and UTM north zones on the GRS80 ellipsoid
(e.g. EPSG:26910, NAD83 / UTM 10N).  UTM uses the Krueger series to third
order, which is well below a millimetre inside a zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import EARTH_RADIUS, col

# GRS80 ellipsoid and the UTM projection constants.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def utm_constants(zone: int = 10, inv_f: float = GRS80_INV_F, a: float = GRS80_A) -> dict:
    """Series coefficients of the Krueger expansion (third order in n)."""
    f = 1.0 / inv_f
    n = f / (2 - f)
    big_a = a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    return {
        "lon0": -183.0 + 6.0 * zone,
        "n": n,
        "k0A": UTM_K0 * big_a,
        "alpha": [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240],
        "beta": [n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, n ** 2 / 48 + n ** 3 / 15, 17 * n ** 3 / 480],
        "delta": [2 * n - 2 * n ** 2 / 3 - 2 * n ** 3, 7 * n ** 2 / 3 - 8 * n ** 3 / 5, 56 * n ** 3 / 15],
    }


# ----------------------------------------------------------------- 4326 <-> 3857
def lonlat_to_mercator(lon, lat) -> tuple[Column, Column]:
    x = EARTH_RADIUS * F.radians(col(lon))
    y = EARTH_RADIUS * F.ln(F.tan(math.pi / 4 + F.radians(col(lat)) / 2))
    return x, y


def mercator_to_lonlat(x, y) -> tuple[Column, Column]:
    lon = F.degrees(col(x) / EARTH_RADIUS)
    lat = F.degrees(2 * F.atan(F.exp(col(y) / EARTH_RADIUS)) - math.pi / 2)
    return lon, lat


# ----------------------------------------------------------------- UTM <-> 4326
def utm_to_lonlat(easting, northing, zone: int = 10) -> tuple[Column, Column]:
    k = utm_constants(zone)
    xi = col(northing) / k["k0A"]
    eta = (col(easting) - UTM_FALSE_EASTING) / k["k0A"]
    xi_p, eta_p = xi, eta
    for j, b in enumerate(k["beta"], start=1):
        xi_p = xi_p - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, d in enumerate(k["delta"], start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = k["lon0"] + F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p)))
    return lon, F.degrees(lat)


def lonlat_to_utm(lon, lat, zone: int = 10) -> tuple[Column, Column]:
    k = utm_constants(zone)
    n = k["n"]
    phi = F.radians(col(lat))
    dl = F.radians(col(lon) - k["lon0"])
    c = 2 * math.sqrt(n) / (1 + n)
    t = F.sinh(F.atanh(F.sin(phi)) - c * F.atanh(c * F.sin(phi)))
    xi_p = F.atan(t / F.cos(dl))
    eta_p = F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    e, nn = eta_p, xi_p
    for j, a in enumerate(k["alpha"], start=1):
        e = e + a * F.cos(2 * j * xi_p) * F.sinh(2 * j * eta_p)
        nn = nn + a * F.sin(2 * j * xi_p) * F.cosh(2 * j * eta_p)
    return UTM_FALSE_EASTING + k["k0A"] * e, k["k0A"] * nn


# ----------------------------------------------------------------- dispatch
def transform_point(src: str, dst: str, x, y) -> tuple[Column, Column]:
    """Convert between 'EPSG:4326', 'EPSG:3857' and 'UTM:<zone>' (north)."""
    src, dst = src.upper(), dst.upper()
    if src == dst:
        return col(x), col(y)
    if src.startswith("UTM:"):
        x, y = utm_to_lonlat(x, y, int(src[4:]))
    elif src == "EPSG:3857":
        x, y = mercator_to_lonlat(x, y)
    elif src != "EPSG:4326":
        raise ValueError(f"unsupported CRS {src}")
    if dst == "EPSG:4326":
        return x, y
    if dst == "EPSG:3857":
        return lonlat_to_mercator(x, y)
    if dst.startswith("UTM:"):
        return lonlat_to_utm(x, y, int(dst[4:]))
    raise ValueError(f"unsupported CRS {dst}")


def add_points(df: DataFrame, src: str, dst: str, points: list[tuple]) -> DataFrame:
    """Add transformed coordinates for several points: ``points`` = [(x, y, out_x, out_y)].

    UTM sources are evaluated in stages (xi/eta, then xi'/eta', then chi, then
    lon/lat), one projection each, so no subtree is repeated: the series stays
    in whole-stage codegen with one evaluation per point.
    """
    src, dst = src.upper(), dst.upper()
    keep = list(df.columns)
    if src.startswith("UTM:"):
        k = utm_constants(int(src[4:]))
        tmp = [f"__p{i}" for i in range(len(points))]
        df = df.select("*", *[c for t, (x, y, _, _) in zip(tmp, points) for c in (
            (col(y) / k["k0A"]).alias(f"{t}_xi"), ((col(x) - UTM_FALSE_EASTING) / k["k0A"]).alias(f"{t}_eta"))])
        cols = []
        for t in tmp:
            xi, eta = F.col(f"{t}_xi"), F.col(f"{t}_eta")
            xp, ep = xi, eta
            for j, b in enumerate(k["beta"], start=1):
                xp = xp - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
                ep = ep - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            cols += [xp.alias(f"{t}_xp"), ep.alias(f"{t}_ep")]
        df = df.select("*", *cols)
        df = df.select("*", *[F.asin(F.sin(F.col(f"{t}_xp")) / F.cosh(F.col(f"{t}_ep"))).alias(f"{t}_chi")
                              for t in tmp])
        cols = []
        for t in tmp:
            chi = F.col(f"{t}_chi")
            lat = chi
            for j, dd in enumerate(k["delta"], start=1):
                lat = lat + dd * F.sin(2 * j * chi)
            lon = k["lon0"] + F.degrees(F.atan2(F.sinh(F.col(f"{t}_ep")), F.cos(F.col(f"{t}_xp"))))
            cols += [lon.alias(f"{t}_lon"), F.degrees(lat).alias(f"{t}_lat")]
        df = df.select(*keep, *cols)
        points = [(f"{t}_lon", f"{t}_lat", ox, oy) for t, (_, _, ox, oy) in zip(tmp, points)]
        src = "EPSG:4326"
        keep_tmp = [f"{t}_{c}" for t in tmp for c in ("lon", "lat")]
    else:
        keep_tmp = []
    outs = []
    for x, y, ox, oy in points:
        tx, ty = transform_point(src, dst, x, y)
        outs += [tx.alias(ox), ty.alias(oy)]
    return df.select(*keep, *outs).drop(*keep_tmp) if keep_tmp else df.select(*keep, *outs)


def add_bbox(df: DataFrame, src: str, dst: str, west, south, east, north, name: str) -> DataFrame:
    """Add ``name`` = struct(west, south, east, north): the box through all four
    transformed corners (not two).  Corners are staged columns (see :func:`add_points`)."""
    tmp = f"__{name}"
    pts = [(cx, cy, f"{tmp}_x{i}", f"{tmp}_y{i}")
           for i, (cx, cy) in enumerate(((west, south), (west, north), (east, south), (east, north)))]
    keep = list(df.columns)
    staged = add_points(df, src, dst, pts)
    xs = [F.col(f"{tmp}_x{i}") for i in range(4)]
    ys = [F.col(f"{tmp}_y{i}") for i in range(4)]
    return staged.select(*keep, F.struct(F.least(*xs).alias("west"), F.least(*ys).alias("south"),
                                         F.greatest(*xs).alias("east"), F.greatest(*ys).alias("north")).alias(name))


def resolution_of(box, width, height) -> Column:
    """Square output pixel keeping the diagonal's pixel count (default warp rule),
    for a box already in the destination CRS (see :func:`add_bbox`)."""
    b = col(box)
    dx, dy = b["east"] - b["west"], b["north"] - b["south"]
    w, h = col(width).cast("double"), col(height).cast("double")
    return F.sqrt(dx * dx + dy * dy) / F.sqrt(w * w + h * h)


def suggest_resolution(df: DataFrame, src: str, dst: str, west, south, east, north, width, height,
                       name: str = "res") -> DataFrame:
    """Add the default output resolution of each raster in ``dst`` as column ``name``."""
    box = f"__box_{name}"
    out = add_bbox(df, src, dst, west, south, east, north, box)
    return out.withColumn(name, resolution_of(box, width, height)).drop(box)
