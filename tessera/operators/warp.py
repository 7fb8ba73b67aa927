"""Block-form warps between axis-aligned grids (J4 + R2/R4 as Arrow kernels).

Target pixel centre t maps to source pixel coordinate (t + 0.5) * ratio - 0.5 (bilinear) or
floor((t + 0.5) * ratio) (nearest), the same rules as the cell-form warps in :mod:`cells`.  This is
the block warp of :mod:`reproject` with one CRS on both sides: partial sums per source block,
added per target tile, so any ratio has bounded groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .reproject import Grid, warp_blocks_crs

PLANE = "EPSG:3857"          # any CRS: the same on both sides, so nothing is projected


def warp_blocks(blocks: DataFrame, ratio: float, size_t: int, zoom_t: int, method: str = "bilinear",
                out_dtype: str = "f8", out_nodata=-3.4028234663852886e38) -> DataFrame:
    """Resample source blocks onto a grid of ``ratio`` source pixels per target pixel,
    cut into ``size_t`` tiles at ``zoom_t``.  Empty target tiles are dropped."""
    r = float(ratio)
    return warp_blocks_crs(blocks, Grid(PLANE, 0.0, 0.0, 1.0, 1.0), Grid(PLANE, 0.0, 0.0, r, r), size_t, zoom_t,
                           method, out_dtype, out_nodata)
