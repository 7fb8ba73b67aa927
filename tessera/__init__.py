"""tessera: elevation rasters on Spark.

Rasters are DataFrames in one of two physical forms that mean the same thing:

* cell form  -- one row per pixel ``(gx, gy, v)`` or ``(z, x, y, row, col, v)``;
  every operator is plain DataFrame / SQL here, so Catalyst plans it and DuckDB
  can check it.
* block form -- one row per tile ``(z, x, y, band, size, dtype, nodata,
  valid_count, data BINARY)``; pixel kernels run on these as Arrow batches.

Tile arithmetic (Web Mercator grid, quadkeys, windows, projections) is made of
Column expressions in :mod:`tessera.functions`.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers on any
    executor run the kernels without the package being installed there."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 -- older cloudpickle: fall back to import by name
        pass


_ship_by_value()
