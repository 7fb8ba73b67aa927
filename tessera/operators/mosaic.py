"""Block-form mosaic paint (A8): overlapping sources -> one layer per tile.

Where several sources cover a pixel, the valid value with the greatest
``(priority, tie, value)`` wins.  Rows are hash-partitioned by tile and sorted by (tile, pixel, priority, tie); a streaming
Arrow pass keeps the winner of every pixel and emits the painted tiles.  Cells that hold a column per band stay one
row until then, each band with winners of its own.

A tile covered by many sources (the hot group) is split before anything is gathered, into as many salts as its measured
rows need.  Its rows take two stages, both bounded:

1. rows are keyed by (tile, salt) with the salt taken from the *source
   identity* (priority, tie), hash-partitioned and sorted by
   (tile, salt, pixel, priority, tie, value); a streaming Arrow pass keeps the
   last row of every pixel run -- the winner inside that group -- and emits
   one partial layer per (tile, salt): a record (pixel, priority, tie, value) for
   every pixel it covers;
2. the partial layers of a tile are brought together
   (hash-partitioned and sorted by tile) and merged by a per-pixel
   lexicographic max in a streaming pass.

Bytes follow the pixels covered, not the tiles met: layers hold records of covered pixels only, and painted
tiles with few pixels take the sparse block form.  Between Arrow batches a pass keeps one row per pixel and band
of the unfinished tile, however many sources cover it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from .skew import SHARE_ROWS, found_hot, salted, with_salts

PAINT_SCHEMA = T.StructType([
    T.StructField("z", T.IntegerType(), False), T.StructField("x", T.IntegerType(), False),
    T.StructField("y", T.IntegerType(), False), T.StructField("band", T.IntegerType(), False),
    T.StructField("salt", T.LongType(), False),
    T.StructField("px", T.BinaryType(), False),
])
LAYER = np.dtype([("off", "<i4"), ("p", "<i8"), ("t", "<i8"), ("v", "<f8")])
LAYER_ROWS = 1 << 18         # records of partial layers merged at once, and the unfinished tile
_EMPTY = np.iinfo(np.int64).min


def _integers(rb: pa.RecordBatch, name: str) -> np.ndarray:
    """An integral column; no priority or tie is less than any (a pixel that has no other source stays empty)."""
    col = rb.column(name)
    if col.null_count:
        if name not in ("p", "t"):
            raise ValueError("a cell without gx, gy or band lies on no tile")
        col = col.fill_null(_EMPTY)
    return col.to_numpy(zero_copy_only=False)


def _paint_sorted(batches, size: int, z: int):
    carry = None
    names = ("x", "y", "band", "salt", "off", "p", "t")
    arrow = pa.schema([("z", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("band", pa.int32()), ("salt", pa.int64()), ("px", pa.binary())])

    def emit(cols, k):
        cx, cy, cb, cs, off, pp, tt, vv = (c[:k] for c in cols)
        new = np.ones(k, bool)
        new[1:] = (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1]) | (cb[1:] != cb[:-1]) | (cs[1:] != cs[:-1])
        # rows are sorted by (group, off, p, t, v): the last row of each (group, off) run wins
        last = np.append(new[1:] | (off[1:] != off[:-1]), True)
        starts = np.flatnonzero(new)
        recs = np.empty(int(last.sum()), LAYER)
        for name, vals in zip(LAYER.names, (off, pp, tt, vv)):
            recs[name] = vals[last]
        cuts = np.append((np.cumsum(last) - last)[starts], len(recs))
        per_chunk = max(1, len(starts) * B.PACK_BYTES // max(1, recs.nbytes))
        for c0 in range(0, len(starts), per_chunk):
            st, at = starts[c0:c0 + per_chunk], cuts[c0:c0 + per_chunk + 1]
            m = len(st)
            part = recs[at[0]:at[-1]]
            px = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(((at - at[0]) * LAYER.itemsize).astype(np.int32).tobytes()),
                                                        pa.py_buffer(part.tobytes())])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, z), pa.int32()), pa.array(cx[st], pa.int32()), pa.array(cy[st], pa.int32()),
                pa.array(cb[st], pa.int32()), pa.array(cs[st], pa.int64()), px], schema=arrow)

    for rb in batches:
        if rb.num_rows == 0:
            continue
        cols = [*[_integers(rb, k) for k in names], rb.column("v").to_numpy(zero_copy_only=False).astype(np.float64)]
        if carry is not None:
            cols = [np.concatenate((a, b)) for a, b in zip(carry, cols)]
        cx, cy, cb, cs = cols[:4]
        last = len(cx) - 1
        same = (cx == cx[last]) & (cy == cy[last]) & (cb == cb[last]) & (cs == cs[last])
        k = int(np.flatnonzero(~same).max()) + 1 if (~same).any() else 0
        if k:
            yield from emit(cols, k)
        carry = B.last_of_runs([c[k:] for c in cols], 4)
    if carry is not None and len(carry[0]):
        yield from emit(carry, len(carry[0]))


def _winners(tile: np.ndarray, recs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tile, record) of the greatest (priority, tie, value) of every pixel, by tile and pixel."""
    key = tile.astype(np.int64) << 32 | recs["off"]
    if not (key[1:] > key[:-1]).all():                # several layers in a tile: otherwise all are winners already
        order = np.lexsort((recs["v"], recs["t"], recs["p"], key))
        last = order[np.append(key[order][1:] != key[order][:-1], True)]
        tile, recs = tile[last], recs[last]
    return tile, recs


def _merge_sorted(batches, size: int, nodata):
    """Partial layers sorted by tile -> one painted block per tile (lexicographic max per pixel)."""
    held: tuple | None = None                         # (keys z, x, y, band; tile of each record; records)

    def emit(keys, tile, recs):
        ok = (recs["p"] != _EMPTY) & ~np.isnan(recs["v"])
        tile, recs = tile[ok], recs[ok]
        if not len(tile):
            return
        starts = np.concatenate(([0], np.flatnonzero(tile[1:] != tile[:-1]) + 1))
        yield from B.tile_batches([k[tile[starts]] for k in keys], starts, recs["off"], recs["v"], size, "f8", nodata, True)

    for rb in batches:
        at, names = 0, ("z", "x", "y", "band")
        planes = rb.column("px").to_pylist()
        cols = [rb.column(c).to_numpy() for c in names]
        sizes = np.cumsum([len(p) // LAYER.itemsize for p in planes]) if planes else np.zeros(0, np.int64)
        while at < len(planes):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + LAYER_ROWS, side="right")))
            keys = [c[at:to] for c in cols]
            row = np.repeat(np.arange(to - at), [len(p) // LAYER.itemsize for p in planes[at:to]])
            recs = np.frombuffer(b"".join(planes[at:to]), LAYER)
            if held is not None:
                row = np.concatenate((np.zeros(len(held[1]), np.int64), row + 1))
                keys, recs = [np.concatenate((a, b)) for a, b in zip(held[0], keys)], np.concatenate((held[1], recs))
            new = np.ones(len(keys[0]), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            keys, tile = [k[new] for k in keys], (np.cumsum(new) - 1)[row]
            tile, recs = _winners(tile, recs)
            done = tile < len(keys[0]) - 1            # the last tile may go on
            if done.any():
                yield from emit(keys, tile[done], recs[done])
            held = [k[-1:] for k in keys], recs[~done]
            at = to
    if held is not None:
        yield from emit(held[0], np.zeros(len(held[1]), np.int64), held[1])


def _band_winners(cols: list[np.ndarray], values: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each band the rows that win their pixel, by pixel: ``cols`` (x, y, band, off, p, t) come sorted, and a band is
    (values, whether there is one)."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
    pixel, p, t = np.cumsum(new), cols[4], cols[5]
    tied = ~new[1:] & (p[1:] == p[:-1]) & (t[1:] == t[:-1])
    out = []
    for v, held in values:
        at = np.flatnonzero(held)
        if tied.any():                                # the value decides
            at = at[np.lexsort((v[at], t[at], p[at], pixel[at]))]
        out.append(at[np.append(pixel[at][1:] != pixel[at][:-1], True)[:len(at)]])
    return out


def _paint_tiles(batches, size: int, z: int, dtype: str, nodata, bands: list[tuple]):
    """Rows sorted by tile, pixel, priority and tie -> one painted block per tile and band.  ``bands`` are (band or
    None for the rows' own, value column)."""
    carry = None
    n = len(bands)

    def emit(cols, values, winners, k):
        for (band, _), (v, _), at in zip(bands, values, winners):
            at = at[(at < k) & (cols[4][at] != _EMPTY) & ~np.isnan(v[at])] if k else at[:0]
            if not len(at):
                continue
            x, y, b, off = (c[at] for c in cols[:4])
            starts = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (b[1:] != b[:-1])))
            b = b[starts] if band is None else np.full(len(starts), band)
            yield from B.tile_batches([np.full(len(starts), z), x[starts], y[starts], b], starts, off, v[at], size, dtype, nodata, True)

    for rb in batches:
        if rb.num_rows == 0:
            continue
        cols = [_integers(rb, k) for k in ("x", "y", "band", "off", "p", "t")]
        for _, name in bands:
            col = rb.column(name)
            cols += [col.to_numpy(zero_copy_only=False).astype(np.float64), col.is_valid().to_numpy(zero_copy_only=False)]
        if carry is not None:
            cols = [np.concatenate((a, b)) for a, b in zip(carry, cols)]
        values = [(cols[6 + 2 * i], cols[7 + 2 * i]) for i in range(n)]
        winners = _band_winners(cols, values)
        last = len(cols[0]) - 1
        other = np.any([c != c[last] for c in cols[:3]], axis=0)
        k = int(np.flatnonzero(other).max()) + 1 if other.any() else 0
        yield from emit(cols, values, winners, k)
        kept = np.unique(np.concatenate([at[at >= k] for at in winners]))
        carry = [c[kept] for c in cols]
    if carry is not None and len(carry[0]):
        values = [(carry[6 + 2 * i], carry[7 + 2 * i]) for i in range(n)]
        yield from emit(carry, values, _band_winners(carry, values), len(carry[0]))


def _keyed(cells: DataFrame, size: int, order, bands: dict[int, str] | None) -> DataFrame:
    """Cells by tile and pixel: (x, y, band, off, p, t, v), or with a column v<band> for each of ``bands``."""
    p, t = order
    values = {"v": "v"} if bands is None else {f"v{b}": c for b, c in bands.items()}
    band = F.col("band") if bands is None and "band" in cells.columns else F.lit(1)
    return cells.where(F.coalesce(*[F.col(c).cast("double") for c in values.values()]).isNotNull()).select(
        F.floor(F.col("gx") / size).cast("int").alias("x"), F.floor(F.col("gy") / size).cast("int").alias("y"),
        band.cast("int").alias("band"),
        ((F.col("gy") % size) * size + F.col("gx") % size).cast("int").alias("off"),
        F.col(p).cast("long").alias("p"), F.col(t).cast("long").alias("t"),
        *[F.col(c).cast("double").alias(n) for n, c in values.items()])


def _share(size: int, share: int | None) -> int:
    return max(SHARE_ROWS, 4 * size * size) if share is None else share


def paint_rows(cells: DataFrame, size: int, order=("priority", "tie"), share: int | None = None) -> DataFrame:
    """Cells keyed for painting: (x, y, band, salt, off, p, t, v).  The sources of a tile that holds more than ``share``
    rows are dealt over salts, as many as its measured rows need (default: four rows a pixel, SHARE_ROWS at least)."""
    return _with_salt(salted(_keyed(cells, size, order, None), ["x", "y", "band"], ("p", "t"), _share(size, share)))


def _with_salt(rows: DataFrame) -> DataFrame:
    return rows.select("x", "y", "band", F.col("_salt").cast("long").alias("salt"), "off", "p", "t", "v")


def tiles_of_rows(keyed: DataFrame, size: int, z: int, bands: dict[int, str] | None = None, dtype: str = "f8", nodata=None) -> DataFrame:
    """Rows (x, y, band, off, p, t and v, or v<band> for each of ``bands``) -> painted tiles, in one shuffle."""
    named = [(None, "v")] if bands is None else [(b, f"v{b}") for b in bands]
    return (keyed.repartition("x", "y", "band").sortWithinPartitions("x", "y", "band", "off", "p", "t")
                 .mapInArrow(lambda it: _paint_tiles(it, size, z, dtype, nodata, named), B.BLOCK_SCHEMA))


def paint_blocks(cells: DataFrame, size: int, z: int, order=("priority", "tie"), share: int | None = None,
                 nodata=-3.4028234663852886e38, bands: dict[int, str] | None = None) -> DataFrame:
    """Cells ``(gx, gy, <order...>, v)`` from overlapping sources -> painted f8 blocks at ``z``.

    ``order`` names two integral columns (source priority and a tie-break); the value
    breaks remaining ties.  A ``band`` column of the cells is kept apart; cells that hold a column per band
    (``bands``: {band: column}) are painted band by band and shuffled once for all.
    """
    keyed, key, share = _keyed(cells, size, order, bands), ["x", "y", "band"], _share(size, share)
    hot = found_hot(keyed, key, share)
    if hot is None:
        return tiles_of_rows(keyed, size, z, bands, nodata=nodata)
    met = with_salts(keyed, key, hot)
    cold = tiles_of_rows(met.where(F.col("_salts").isNull()).drop("_salts"), size, z, bands, nodata=nodata)
    split = met.where(F.col("_salts").isNotNull())
    if bands is not None:
        each = F.inline(F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"v{b}").alias("v")) for b in bands]))
        split = split.select("x", "y", "off", "p", "t", "_salts", each).where(F.col("v").isNotNull())
    split = _with_salt(split.withColumn("_salt", F.pmod(F.xxhash64("p", "t"), F.col("_salts"))))
    parts = (split.repartition("x", "y", "band", "salt")
                  .sortWithinPartitions("x", "y", "band", "salt", "off", "p", "t", "v")
                  .mapInArrow(lambda it: _paint_sorted(it, size, z), PAINT_SCHEMA))
    return cold.unionByName(parts.repartition("x", "y", "band").sortWithinPartitions("x", "y", "band")
                                 .mapInArrow(lambda it: _merge_sorted(it, size, nodata), B.BLOCK_SCHEMA))


def band_tiles(cells: DataFrame, size: int, z: int, bands, dtype: str = "f8", nodata=None) -> DataFrame:
    """Cells (gx, gy and a column v<band> for each of ``bands``) packed into a block per tile and band, in one shuffle for
    all bands; of several cells of a pixel the greatest value of a band stays, null is no value."""
    values = {b: f"v{b}" for b in bands}
    keyed = _keyed(cells.select("*", F.lit(0).alias("_zero")), size, ("_zero", "_zero"), values)
    return tiles_of_rows(keyed, size, z, values, dtype, nodata)
