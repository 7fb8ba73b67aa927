"""Readers (S*), writers (K*) and the rasters derived from the driver's tables."""
