"""Raster operators: cell form (``cells``) and block form (``blocks``, ``pyramid``, ``halo``)."""
