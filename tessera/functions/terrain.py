"""Terrain shading maths (T1-T6) as Column expressions.

Inputs are the two gradients of an elevation surface: ``a`` along rows
(downwards) and ``b`` along columns (eastwards), as returned first and second
by a 2-D central-difference gradient.  Constant trigonometry is evaluated once
in Python and enters the plan as literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import col

PI = math.pi
# Default light position (degrees) and z-factor of the shaders.
AZIMUTH = 315.0
ALTITUDE = 45.0
Z_FACTOR = 0.05


def _lit(v: float) -> Column:
    return F.lit(float(v))


# ------------------------------------------------------------------ T1
def hillshade_naive(a, b, azimuth: float = AZIMUTH, altitude: float = ALTITUDE) -> Column:
    """255*(shade+1)/2 truncated to INT; slope = pi/2 - atan(|grad|), aspect = atan2(-a, b)."""
    a, b = col(a), col(b)
    az = azimuth * PI / 180.0
    alt = altitude * PI / 180.0
    slope = PI / 2.0 - F.atan(F.sqrt(a * a + b * b))
    aspect = F.atan2(-a, b)
    shaded = math.sin(alt) * F.sin(slope) + math.cos(alt) * F.cos(slope) * F.cos(az - aspect)
    return F.floor(255 * (shaded + 1) / 2).cast("int")


# ------------------------------------------------------------------ T4
def aspect_zfactor(a, b, azimuth: float = AZIMUTH) -> Column:
    """Aspect in radians as the z-factor shader defines it (flat cells get a fixed value)."""
    a, b = col(a), col(b)
    az = math.radians(90.0 - azimuth)
    flat = -1 * (PI / 4 - az)
    t = F.atan2(b, -a)
    return (F.when((a == 0) & (b > 0), _lit(PI / 2))
            .when((a == 0) & (b < 0), _lit(2 * PI - PI / 2))
            .when(a == 0, _lit(flat))
            .when(t < 0, t + 2 * PI)
            .otherwise(t))


# ------------------------------------------------------------------ T2
def hillshade_zfactor(a, b, azimuth: float = AZIMUTH, altitude: float = ALTITUDE,
                      z_factor: float = Z_FACTOR) -> Column:
    """floor(255*max(0, cos(zen)cos(sl) + sin(zen)sin(sl)cos(az-aspect))) as 0..255."""
    a, b = col(a), col(b)
    az = math.radians(90.0 - azimuth)
    zen = math.radians(90.0 - altitude)
    g = F.atan(z_factor * F.sqrt(a * a + b * b))
    v = math.cos(zen) * F.cos(g) + math.sin(zen) * F.sin(g) * F.cos(az - aspect_zfactor(a, b, azimuth))
    return F.floor(255.0 * F.greatest(_lit(0.0), v)).cast("int")


# ------------------------------------------------------------------ T5
def cos_aspect(a, b) -> Column:
    a, b = col(a), col(b)
    return (F.when((a == 0) & (b == 0), _lit(-1.0)).when(a == 0, _lit(0.0))
            .when((b == 0) & (a < 0), _lit(1.0)).when(b == 0, _lit(-1.0))
            .otherwise(-a / F.sqrt(b * b + a * a)))


def sin_aspect(a, b) -> Column:
    a, b = col(a), col(b)
    return (F.when(b == 0, _lit(0.0)).when((a == 0) & (b < 0), _lit(-1.0))
            .when(a == 0, _lit(1.0)).otherwise(b / F.sqrt(b * b + a * a)))


def sin_slope(a, b) -> Column:
    a, b = col(a), col(b)
    return F.sqrt(a * a + b * b) / F.sqrt(a * a + b * b + 1)


def cos_slope(a, b) -> Column:
    a, b = col(a), col(b)
    return 1 / F.sqrt(a * a + b * b + 1)


# ------------------------------------------------------------------ T3
def light_direction(azimuth: float = AZIMUTH, altitude: float = ALTITUDE) -> tuple[float, float, float]:
    az = math.radians(90.0 - azimuth)
    alt = math.radians(altitude)
    return (math.cos(az) * math.cos(alt), math.sin(az) * math.cos(alt), math.sin(alt))


def light_intensity(a, b, azimuth: float = AZIMUTH, altitude: float = ALTITUDE) -> Column:
    """Unit surface normal (-b, a, 1)/|.| dotted with the light direction (rows grow downwards)."""
    a, b = col(a), col(b)
    d0, d1, d2 = light_direction(azimuth, altitude)
    m = F.sqrt(b * b + a * a + 1)
    return (-b / m) * d0 + (a / m) * d1 + (1 / m) * d2


def stretch(v, vmin, vmax, eps: float = 1e-6) -> Column:
    """(v - min)/(max - min) when the range exceeds eps, then clipped to 0..1."""
    v, vmin, vmax = col(v), col(vmin), col(vmax)
    s = F.when(vmax - vmin > eps, (v - vmin) / (vmax - vmin)).otherwise(v)
    return F.least(F.greatest(s, _lit(0.0)), _lit(1.0))


def quantise(v) -> Column:
    """255*v truncated (v in 0..1) -> 0..255."""
    return F.floor(255.0 * col(v)).cast("int")


# ------------------------------------------------------------------ T6
# The "darkmatter" ramp as (position, value) stops per channel,
# positions and values on a 0..1 scale.
RAMP = {
    "r": [(0.0, 60 / 255.0), (1.0, 220 / 255.0)],
    "g": [(0.0, 75 / 255.0), (1.0, 1.0)],
    "b": [(0.0, 80 / 255.0), (1.0, 100 / 255.0)],
    "a": [(0.0, 0.4), (162 / 255.0, 0.0), (1.0, 0.2)],
}
RAMP_STEPS = 256


def ramp_index(v, vmin, vmax, steps: int = RAMP_STEPS) -> Column:
    """Colour-table index of v once stretched over [vmin, vmax] (0 when the range is empty)."""
    v, vmin, vmax = col(v), col(vmin), col(vmax)
    t = F.when(vmax > vmin, (v - vmin) / (vmax - vmin)).otherwise(_lit(0.0))
    return F.least(F.floor(t * steps), F.lit(steps - 1)).cast("int")


def ramp_channel(idx, stops, steps: int = RAMP_STEPS) -> Column:
    """Byte value of table entry ``idx``: linear between stops, sampled at idx/(steps-1)."""
    idx = col(idx)
    xi = idx * (1.0 / (steps - 1))
    out = None
    for (x0, y0), (x1, y1) in zip(stops[:-1], stops[1:]):
        val = (xi - x0) / (x1 - x0) * (y1 - y0) + y0
        cond = xi <= x1
        out = F.when(cond, val) if out is None else out.when(cond, val)
    out = out.otherwise(_lit(stops[-1][1]))
    out = F.when(idx == 0, _lit(stops[0][1])).when(idx == steps - 1, _lit(stops[-1][1])).otherwise(out)
    return F.floor(out * 255.0).cast("int")
