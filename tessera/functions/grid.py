"""Web Mercator tile grid as Column expressions (no Python UDFs).

A tile is ``(z, x, y)`` with ``x`` growing east and ``y`` growing south,
``n = 2**z`` tiles per axis.  Everything here stays inside Catalyst, so it
is code-generated and can be pushed next to scans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the spherical Mercator grid (EPSG:3857).
EARTH_RADIUS = 6378137.0
HALF_WORLD = math.pi * EARTH_RADIUS          # 20037508.342789244 m
WORLD = 2.0 * HALF_WORLD
# Corner names by (x % 2, y % 2) of a child inside its parent.
CORNER_NAMES = {(0, 0): "ul", (0, 1): "ll", (1, 0): "ur", (1, 1): "lr"}


def col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def shiftright(c, bits) -> Column:
    return F.call_function("shiftright", col(c), col(bits))


def shiftleft(c, bits) -> Column:
    return F.call_function("shiftleft", col(c), col(bits))


def n_tiles(z) -> Column:
    """2**z as DOUBLE."""
    return F.pow(F.lit(2.0), col(z))


# --------------------------------------------------------------------------- P10
def lon_to_tile_x(lon, z) -> Column:
    n = n_tiles(z)
    x = F.floor((col(lon) + 180) / 360 * n)
    return F.least(F.greatest(x, F.lit(0)), (n - 1).cast("bigint"))


def lat_to_tile_y(lat, z) -> Column:
    n = n_tiles(z)
    r = F.radians(col(lat))
    y = F.floor((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n)
    return F.least(F.greatest(y, F.lit(0)), (n - 1).cast("bigint"))


def lonlat_to_tile(lon, lat, z) -> Column:
    return F.struct(col(z).cast("int").alias("z"), lon_to_tile_x(lon, z).alias("x"),
                    lat_to_tile_y(lat, z).alias("y"))


# --------------------------------------------------------------------------- P1
def tile_ul_lon(x, z) -> Column:
    return col(x) / n_tiles(z) * 360 - 180


def tile_ul_lat(y, z) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * col(y) / n_tiles(z)))))


# --------------------------------------------------------------------------- P3 / P4
def tile_span(z) -> Column:
    """Tile width in metres."""
    return WORLD / n_tiles(z)


def tile_bounds(x, y, z) -> Column:
    """(ulx, uly, lrx, lry) in EPSG:3857, closed form."""
    s = tile_span(z)
    return F.struct(
        (col(x) * s - HALF_WORLD).alias("ulx"),
        (HALF_WORLD - col(y) * s).alias("uly"),
        ((col(x) + 1) * s - HALF_WORLD).alias("lrx"),
        (HALF_WORLD - (col(y) + 1) * s).alias("lry"),
    )


def tile_affine(x, y, z, size) -> Column:
    """Pixel -> map transform of a tile of ``size`` pixels: x = a*col + c, y = e*row + f."""
    s = tile_span(z)
    return F.struct(
        (s / col(size)).alias("a"),
        (col(x) * s - HALF_WORLD).alias("c"),
        (-s / col(size)).alias("e"),
        (HALF_WORLD - col(y) * s).alias("f"),
    )


# --------------------------------------------------------------------------- P5-P8
def parent(x, y, z) -> Column:
    return F.struct((col(z) - 1).alias("z"), shiftright(col(x), 1).alias("x"),
                    shiftright(col(y), 1).alias("y"))


def children(x, y, z) -> Column:
    """array of the four child tiles (explode it for 1 -> 4 rows)."""
    return F.array(*[
        F.struct((col(z) + 1).alias("z"), (col(x) * 2 + dx).alias("x"), (col(y) * 2 + dy).alias("y"))
        for dy in (0, 1) for dx in (0, 1)
    ])


def corner(x, y) -> Column:
    cx, cy = col(x) % 2, col(y) % 2
    out = None
    for (i, j), name in CORNER_NAMES.items():
        cond = (cx == i) & (cy == j)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def corner_offset(x, y, size) -> Column:
    """Pixel offset (dx, dy) of a child's quadrant inside the parent; half = size/2."""
    half = F.floor(col(size) / 2)
    return F.struct(((col(x) % 2) * half).alias("dx"), ((col(y) % 2) * half).alias("dy"))


# --------------------------------------------------------------------------- P9
def _spread_bits(v: Column) -> Column:
    """Insert a zero bit above every bit of a non-negative 31-bit integer (Morton spreading)."""
    v = v.cast("bigint")
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = shiftleft(v, F.lit(shift)).bitwiseOR(v).bitwiseAND(F.lit(mask))
    return v


def quadkey(x, y, z) -> Column:
    """Quadkey string (digit = xbit + 2*ybit, high bit first); '' when z <= 1.

    The digits are the base-4 form of the Morton code of (x, y), left-padded to
    z digits -- bit arithmetic only, so it is code-generated.
    """
    digits = F.lpad(F.conv(morton(x, y).cast("string"), 10, 4), col(z).cast("int"), "0")
    return F.when(col(z) > 1, digits).otherwise(F.lit(""))


def morton(x, y) -> Column:
    """Morton code of (x, y): tiles of one zoom in its order are in quadkey order, without a string."""
    return _spread_bits(col(x)).bitwiseOR(shiftleft(_spread_bits(col(y)), F.lit(1)))


# --------------------------------------------------------------------------- P11
def tiles_for_bbox(west, south, east, north, z) -> Column:
    """array<struct<z,x,y>> of every tile meeting the box (explode it)."""
    x0, x1 = lon_to_tile_x(west, z), lon_to_tile_x(east, z)
    y0, y1 = lat_to_tile_y(north, z), lat_to_tile_y(south, z)
    return F.flatten(F.transform(
        F.sequence(y0, y1),
        lambda yy: F.transform(F.sequence(x0, x1),
                               lambda xx: F.struct(col(z).cast("int").alias("z"), xx.alias("x"), yy.alias("y"))),
    ))


# --------------------------------------------------------------------------- P14
def zoom_for_resolution(res, chunk_size=2048) -> Column:
    """round(log2(2*pi*R / (res * chunk))): the zoom whose tile pixels best match ``res`` metres."""
    return F.round(F.log2(F.lit(WORLD) / (col(res) * chunk_size))).cast("int")


# --------------------------------------------------------------------------- P16
def tile_key_path(prefix, x, y, z, ext="tif") -> Column:
    return F.format_string(f"%s/%d/%d/%d.{ext}", col(prefix), col(z), col(x), col(y))


# --------------------------------------------------------------------------- P20-P23
def source_window(x, y, z, src_zoom, src_size, dst_size) -> Column:
    """Pixel window of tile (z,x,y) on a source pyramid level ``src_zoom`` of
    ``src_size`` pixel tiles, the destination tile being ``dst_size`` pixels.

    rows/cols are half-open; ``scale`` is source pixels per destination pixel.
    """
    k = F.pow(F.lit(2.0), F.lit(src_zoom) - col(z))
    scale = k * (float(src_size) / float(dst_size))
    r0 = src_size * (col(y) * k)
    c0 = src_size * (col(x) * k)
    span = F.floor(src_size * k)
    return F.struct(
        r0.alias("row0"), (r0 + span).alias("row1"),
        c0.alias("col0"), (c0 + span).alias("col1"),
        scale.alias("scale"),
    )


def buffer_window(w, buffer) -> Column:
    w = col(w)
    pad = col(buffer) * w["scale"]
    return F.struct((w["row0"] - pad).alias("row0"), (w["row1"] + pad).alias("row1"),
                    (w["col0"] - pad).alias("col0"), (w["col1"] + pad).alias("col1"),
                    w["scale"].alias("scale"))


def window_transform(a, c, e, f, w) -> Column:
    """Georeference of a window: same pixel size, origin moved to the window's corner."""
    w = col(w)
    return F.struct(col(a).alias("a"), (col(c) + w["col0"] * col(a)).alias("c"),
                    col(e).alias("e"), (col(f) + w["row0"] * col(e)).alias("f"))


def pixel_size(a, e, scale) -> Column:
    return F.struct((F.abs(col(a)) * col(scale)).alias("dx"), (F.abs(col(e)) * col(scale)).alias("dy"))
