"""Overlap (range) join of two box tables without a cartesian product.

Both sides are bucketed on a regular grid of ``cell`` units: every box is
exploded to the grid cells it touches, the sides are equi-joined on the cell
(a hash / sort-merge join Spark can partition and AQE can de-skew), and the
exact intersection test is applied.  A pair meeting in several cells is kept
only in the cell holding the lower-left corner of the intersection, so each
pair appears exactly once without a ``distinct`` shuffle.

Choose ``cell`` near the typical box size: a box of w x h touches about
(w/cell + 1) * (h/cell + 1) cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_cells(df: DataFrame, xmin: str, ymin: str, xmax: str, ymax: str, cell: float) -> DataFrame:
    """One row per grid cell a box touches: (_cx, _cy) added.  Two plain explodes
    (explode_outer + null filter, so no filter is inferred and pushed into the scan)."""
    def rng(lo, hi, name, frame):
        a, b = F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)
        return (frame.select("*", F.explode_outer(F.sequence(a, F.greatest(a, b))).alias(name))
                     .where(F.col(name).isNotNull()))
    return rng(xmin, xmax, "_cx", rng(ymin, ymax, "_cy", df))


def overlap_join(left: DataFrame, right: DataFrame, cell: float,
                 lbox=("xmin", "ymin", "xmax", "ymax"), rbox=("xmin", "ymin", "xmax", "ymax"),
                 closed: bool = False) -> DataFrame:
    """Pairs of rows whose boxes intersect (open boxes unless ``closed``).

    Box columns of each side are renamed with ``l_`` / ``r_`` prefixes in the
    output; all other columns are kept (names must not clash).
    """
    lb = [f"l_{c}" for c in ("xmin", "ymin", "xmax", "ymax")]
    rb = [f"r_{c}" for c in ("xmin", "ymin", "xmax", "ymax")]
    lo = [c for c in left.columns if c not in lbox]
    ro = [c for c in right.columns if c not in rbox]
    L = left.select(*lo, *[F.col(a).alias(b) for a, b in zip(lbox, lb)])
    R = right.select(*ro, *[F.col(a).alias(b) for a, b in zip(rbox, rb)])
    L = _with_cells(L, *lb, cell)
    R = _with_cells(R, *rb, cell)
    lt = (lambda a, b: a <= b) if closed else (lambda a, b: a < b)
    hit = (lt(F.col("l_xmin"), F.col("r_xmax")) & lt(F.col("r_xmin"), F.col("l_xmax"))
           & lt(F.col("l_ymin"), F.col("r_ymax")) & lt(F.col("r_ymin"), F.col("l_ymax")))
    # report each pair once: in the cell of the intersection's lower-left corner
    own = ((F.floor(F.greatest("l_xmin", "r_xmin") / cell) == F.col("_cx"))
           & (F.floor(F.greatest("l_ymin", "r_ymin") / cell) == F.col("_cy")))
    return L.join(R, ["_cx", "_cy"]).where(hit & own).drop("_cx", "_cy")
