"""Column expressions: tile grid (grid), projections (crs), URIs (uris), terrain maths (terrain)."""
