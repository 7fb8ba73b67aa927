"""Block form: one row per tile, pixels packed little-endian row-major in ``data``.

Block rows carry ``(z, x, y, band, size, dtype, nodata, valid_count, data,
weight)``.  ``nodata`` is the sentinel stored in ``data`` for missing pixels
(NULL = nothing is masked).  ``data`` is always the pixel value.  ``weight`` is
optional: a FLOAT64 plane of sums and an INT64 plane of sample counts, which
carry exact averages through a pyramid whatever the dtype of ``data``.  Rows of
one level may differ in dtype and nodata: every kernel decodes a row by its own
columns.  ``valid_count`` is stored so
that a filter on it can be pushed into the parquet scan (early nodata pruning).
Where few pixels of a tile are set, ``data`` and ``weight`` may be in sparse form (:func:`sparse_record`):
:func:`decode` reads both forms, so that kernels see the same arrays.

Kernels see NumPy arrays through Arrow batches (``mapInArrow`` for per-block
maps, ``groupBy().applyInArrow`` for folds over a bounded number of blocks).
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_FIELDS = [
    T.StructField("z", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("y", T.IntegerType(), False),
    T.StructField("band", T.IntegerType(), False),
    T.StructField("size", T.IntegerType(), False),
    T.StructField("dtype", T.StringType(), False),
    T.StructField("nodata", T.DoubleType(), True),
    T.StructField("valid_count", T.IntegerType(), False),
    T.StructField("data", T.BinaryType(), False),
    T.StructField("weight", T.BinaryType(), True),
]
BLOCK_SCHEMA = T.StructType(BLOCK_FIELDS)
BLOCK_COLUMNS = [f.name for f in BLOCK_FIELDS]

CELL_SCHEMA = T.StructType([
    T.StructField("z", T.IntegerType(), False),
    T.StructField("band", T.IntegerType(), False),
    T.StructField("gx", T.LongType(), False),
    T.StructField("gy", T.LongType(), False),
    T.StructField("v", T.DoubleType(), True),
])
CELL_WEIGHT_SCHEMA = T.StructType(CELL_SCHEMA.fields + [
    T.StructField("wsum", T.DoubleType(), True), T.StructField("wcount", T.LongType(), True)])

DTYPES = ("u1", "i2", "i4", "i8", "f4", "f8")


# ------------------------------------------------------------------ NumPy helpers
def decode(data: bytes, dtype: str, size: int) -> np.ndarray:
    if is_sparse(data, dtype, size):
        recs = np.frombuffer(data, sparse_record(dtype))
        out = np.full(size * size, recs["v"][0], dtype="<" + dtype)
        out[recs["off"][1:]] = recs["v"][1:]
        return out.reshape(size, size)
    return np.frombuffer(data, dtype="<" + dtype).reshape(size, size)


SPARSE = -0x53505253        # in place of the first record's offset


def sparse_record(dtype: str) -> np.dtype:
    """A record of sparse ``data``: pixel offset and value.  The first one holds SPARSE and the value of all pixels
    that have no record; the others follow by offset."""
    return np.dtype([("off", "<i4"), ("v", "<" + dtype)])


SPARSE_SUMS = np.dtype([("off", "<i4"), ("s", "<f8"), ("c", "<i8")])     # the same for ``weight``


def is_sparse(data: bytes, dtype: str, size: int) -> bool:
    """A block is sparse only where that makes it shorter, so its length tells."""
    return 4 <= len(data) != size * size * int(dtype[1:]) and data[:4] == np.int32(SPARSE).tobytes()


def is_sparse_sums(weight: bytes, size: int) -> bool:
    return 4 <= len(weight) != size * size * 16 and weight[:4] == np.int32(SPARSE).tobytes()


def sparse_arrays(kind: np.dtype, starts: np.ndarray, fields: dict, fill=0) -> pa.Array:
    """Binary column of sparse planes: row i holds the pixels ``starts[i]`` to ``starts[i + 1]`` (the last: to the end)."""
    n, m = len(starts), len(fields["off"])
    if np.asarray(fields["off"]).dtype.kind != "i":
        raise ValueError("a cell without gx, gy or band lies on no tile")
    recs = np.zeros(n + m, kind)
    heads = starts + np.arange(n)
    body = np.ones(n + m, bool)
    body[heads] = False
    recs["off"][heads] = SPARSE
    for name, vals in fields.items():
        recs[name][body] = vals
    if "v" in fields:
        recs["v"][heads] = fill
    at = np.append(heads, n + m) * kind.itemsize
    if at[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(recs.tobytes())])
    raw = recs.tobytes()
    return pa.array([raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())


def encode(arr: np.ndarray, dtype: str) -> bytes:
    return np.ascontiguousarray(arr, dtype="<" + dtype).tobytes()


def valid_mask(arr: np.ndarray, nodata) -> np.ndarray:
    if nodata is None:
        return np.ones(arr.shape, dtype=bool)
    if np.isnan(nodata):
        return ~np.isnan(arr)
    return arr != np.asarray(nodata, dtype=arr.dtype)


def to_float(arr: np.ndarray, nodata) -> np.ndarray:
    """float64 copy with NaN where the block has nodata."""
    out = arr.astype(np.float64)
    out[~valid_mask(arr, nodata)] = np.nan
    return out


def from_float(vals: np.ndarray, dtype: str, nodata) -> tuple[np.ndarray, int]:
    """Cast back to ``dtype`` with NaN -> nodata; returns (array, valid count).

    With ``nodata=None`` nothing is masked: missing pixels are stored as 0 and
    every pixel counts as valid (so no such tile is ever dropped as empty).
    """
    ok = ~np.isnan(vals)
    fill = 0 if nodata is None else nodata
    out = np.where(ok, vals, fill).astype("<" + dtype)
    return out, int(ok.size if nodata is None else ok.sum())


def row_values(row: dict) -> np.ndarray:
    """A block row's pixels as float64 with NaN = missing, by its own dtype and nodata."""
    return to_float(decode(row["data"], row["dtype"], row["size"]), row["nodata"])


def encode_sums(sums: np.ndarray, counts: np.ndarray) -> bytes:
    return encode(sums, "f8") + encode(counts, "i8")


def row_sums(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of a block row: its ``weight`` planes, or its values counted once each."""
    size = row["size"]
    if row["weight"] is None:
        vals = row_values(row)
        return np.nan_to_num(vals, nan=0.0), (~np.isnan(vals)).astype(np.int64)
    if is_sparse_sums(row["weight"], size):
        recs = np.frombuffer(row["weight"], SPARSE_SUMS)[1:]
        sums, counts = np.zeros(size * size), np.zeros(size * size, np.int64)
        sums[recs["off"]], counts[recs["off"]] = recs["s"], recs["c"]
        return sums.reshape(size, size), counts.reshape(size, size)
    half = size * size * 8
    return decode(row["weight"][:half], "f8", size), decode(row["weight"][half:], "i8", size)


def one_size(rows: list[dict]) -> int:
    """The tile size of a group (tile numbers mean different pixels under different sizes)."""
    sizes = {r["size"] for r in rows}
    if len(sizes) != 1:
        raise ValueError(f"blocks of one level differ in size: {sorted(sizes)}")
    return sizes.pop()


def joint_layout(layouts: list[tuple]) -> tuple:
    """(dtype, nodata candidates) able to hold blocks of several (dtype, candidates)."""
    dtype = np.result_type(*["<" + d for d, _ in layouts]).str[1:]
    known = {n for _, nodatas in layouts for n in nodatas if n is not None}
    return dtype, tuple(sorted(known, key=lambda n: (n != n, n))) or (None,)


def fit_layout(vals: np.ndarray, dtype: str, nodatas: tuple) -> tuple:
    """(dtype, nodata) under which every valid value stays valid: the first candidate that fits
    the dtype and that no valid value equals, else float64 with NaN."""
    stored = vals[~np.isnan(vals)].astype("<" + dtype)
    for nodata in nodatas:
        if nodata is None:
            return dtype, None
        if stored.dtype.kind != "f":
            limits = np.iinfo(stored.dtype)
            if not (limits.min <= nodata <= limits.max and nodata == int(nodata)):
                continue
        if not (stored == np.asarray(nodata).astype(stored.dtype)).any():
            return dtype, nodata
    return "f8", float("nan")


def block_record(z, x, y, band, size, dtype, nodata, arr, valid, weight=None) -> dict:
    return {"z": int(z), "x": int(x), "y": int(y), "band": int(band), "size": int(size),
            "dtype": dtype, "nodata": None if nodata is None else float(nodata), "valid_count": int(valid),
            "data": encode(arr, dtype), "weight": weight}


def records_to_table(records: list[dict]) -> pa.Table:
    arrow_schema = pa.schema([
        ("z", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("band", pa.int32()),
        ("size", pa.int32()), ("dtype", pa.string()), ("nodata", pa.float64()),
        ("valid_count", pa.int32()), ("data", pa.binary()), ("weight", pa.binary()),
    ])
    if not records:
        return arrow_schema.empty_table()
    return pa.Table.from_pylist(records, schema=arrow_schema)


def pixel_bytes() -> F.Column:
    """Length of a block's ``data`` from its layout, so that counting bytes does not read the pixels."""
    return F.col("size").cast("long") * F.col("size") * F.substring("dtype", 2, 1).cast("int")


# ------------------------------------------------------------------ pack / unpack
def pack_blocks(cells: DataFrame, size: int, z, dtype: str = "f8", nodata=None,
                value: str = "v", band=1, sparse: bool = False) -> DataFrame:
    """Cell rows ``(gx, gy, v)`` -> one block per tile; NULL values become nodata.

    ``sparse``: tiles with few pixels take the sparse form, so that bytes follow the pixels held, not the tiles met.

    One shuffle (hash on the tile key), a sort within each partition, then a
    streaming Arrow pass that cuts tiles at key changes: one Python call per
    batch rather than per tile.  Of several cells of one pixel the greatest value
    stays, so what is carried between batches never exceeds size*size cells.
    """
    if dtype not in DTYPES:
        raise ValueError(dtype)
    band_col = F.col("band") if isinstance(band, str) else F.lit(band)
    keyed = cells.select(
        F.lit(z).cast("int").alias("z") if not isinstance(z, str) else F.col(z).cast("int").alias("z"),
        F.floor(F.col("gx") / size).cast("int").alias("x"),
        F.floor(F.col("gy") / size).cast("int").alias("y"),
        band_col.cast("int").alias("band"),
        ((F.col("gy") % size) * size + F.col("gx") % size).cast("int").alias("off"),
        F.col(value).cast("double").alias("v"),
    )
    ordered = keyed.repartition("z", "x", "y", "band").sortWithinPartitions("z", "x", "y", "band", "off", "v")
    return ordered.mapInArrow(lambda it: _pack_sorted(it, size, dtype, nodata, sparse), BLOCK_SCHEMA)


PACK_BYTES = 64 << 20     # working memory for tiles under construction in one batch

_BLOCK_ARROW = pa.schema([
    ("z", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("band", pa.int32()),
    ("size", pa.int32()), ("dtype", pa.string()), ("nodata", pa.float64()),
    ("valid_count", pa.int32()), ("data", pa.binary()), ("weight", pa.binary()),
])


def last_of_runs(cols: list[np.ndarray], key: int) -> list[np.ndarray]:
    """Rows of one tile sorted by pixel: the last row of every pixel (column ``key``)."""
    off = cols[key]
    last = np.append(off[1:] != off[:-1], True)[:len(off)]
    return [c[last] for c in cols]


def tile_batches(keys: tuple, starts: np.ndarray, off: np.ndarray, vals: np.ndarray, size: int, dtype: str, nodata, sparse: bool):
    """Block batches of tiles given by their pixels: ``keys`` (z, x, y, band) a tile, whose pixels (offset and value, each
    pixel once, by offset) lie from its ``starts`` on.  NaN is missing."""
    stops = np.append(starts[1:], len(off))
    few = np.zeros(len(starts), bool)
    if sparse and nodata is not None:                 # without nodata every pixel is one
        few = (stops - starts + 1) * sparse_record(dtype).itemsize < size * size * int(dtype[1:])
    if few.any():
        held = np.repeat(few, stops - starts) & ~np.isnan(vals)
        n = np.add.reduceat(held.astype(np.int64), starts)[few]
        v = vals[held].astype("<" + dtype)
        data = sparse_arrays(sparse_record(dtype), np.cumsum(n) - n, {"off": off[held], "v": v}, fill=nodata)
        yield block_batch([k[few] for k in keys], size, dtype, nodata, n, data)
    full = np.flatnonzero(~few)
    per_chunk = max(1, PACK_BYTES // (size * size * 8))      # tiles built at once: bounded memory
    for c0 in range(0, len(full), per_chunk):
        at = full[c0:c0 + per_chunk]
        tid = np.repeat(np.arange(len(at)), stops[at] - starts[at])
        rows = np.concatenate([np.arange(a, b) for a, b in zip(starts[at], stops[at])])
        buf = np.full((len(at), size * size), np.nan)
        buf[tid, off[rows]] = vals[rows]
        ok = ~np.isnan(buf)
        arr = np.where(ok, buf, 0 if nodata is None else nodata).astype("<" + dtype)
        if nodata is None:                            # nothing masked: every pixel is valid
            ok = np.ones_like(ok)
        yield block_batch([k[at] for k in keys], size, dtype, nodata, ok.sum(axis=1),
                           pa.array([arr[i].tobytes() for i in range(len(at))], pa.binary()))


def block_batch(keys, size: int, dtype: str, nodata, valid, data: pa.Array, weight: pa.Array | None = None) -> pa.RecordBatch:
    n = len(data)
    return pa.RecordBatch.from_arrays([
        *[pa.array(k, pa.int32()) for k in keys], pa.array(np.full(n, size), pa.int32()), pa.array([dtype] * n, pa.string()),
        pa.array([nodata] * n, pa.float64()), pa.array(valid, pa.int32()), data,
        pa.nulls(n, pa.binary()) if weight is None else weight], schema=_BLOCK_ARROW)


def _pack_sorted(batches, size: int, dtype: str, nodata, sparse: bool = False):
    """Rows sorted by tile key -> block batches.  All complete tiles of a batch
    are scattered into one (tiles, size*size) array; only the last, possibly
    unfinished tile is carried into the next batch."""
    names = ("z", "x", "y", "band", "off", "v")
    carry = None

    def emit(cols, k_end):
        cz, cx, cy, cb, off, vals = (c[:k_end] for c in cols)
        change = np.flatnonzero((cz[1:] != cz[:-1]) | (cx[1:] != cx[:-1]) |
                                (cy[1:] != cy[:-1]) | (cb[1:] != cb[:-1])) + 1
        starts = np.concatenate(([0], change))
        # of several cells of a pixel the last one: rows are sorted by (tile, pixel, value)
        new = np.zeros(k_end, bool)
        new[starts] = True
        last = np.append((off[1:] != off[:-1]) | new[1:], True)
        first = np.cumsum(last) - last
        yield from tile_batches([c[starts] for c in (cz, cx, cy, cb)], first[starts], off[last], vals[last], size, dtype, nodata, sparse)

    for rb in batches:
        if rb.num_rows == 0:
            continue
        cols = [rb.column(k).to_numpy(zero_copy_only=False) for k in names]
        cols[5] = cols[5].astype(np.float64)
        if carry is not None:
            cols = [np.concatenate((a, b)) for a, b in zip(carry, cols)]
        cz, cx, cy, cb = cols[:4]
        last = len(cz) - 1
        same = (cz == cz[last]) & (cx == cx[last]) & (cy == cy[last]) & (cb == cb[last])
        k_end = int(np.flatnonzero(~same).max()) + 1 if (~same).any() else 0   # rows of finished tiles
        if k_end:
            yield from emit(cols, k_end)
        carry = last_of_runs([c[k_end:] for c in cols], 4)
    if carry is not None and len(carry[0]):
        yield from emit(carry, len(carry[0]))


UNPACK_ROWS = 256        # pixel rows per emitted batch for large tiles
UNPACK_PIXELS = 1 << 20  # small tiles are unpacked together, up to this many pixels per batch


def _cells_batch(z, band, gx, gy, v, extra: dict, weighted, wsum=None, wcount=None):
    out = {"z": z.astype(np.int32), "band": band.astype(np.int32), "gx": gx.astype(np.int64),
           "gy": gy.astype(np.int64)}
    if weighted:
        out["v"] = pa.array(np.where(wcount > 0, wsum / np.maximum(wcount, 1), np.nan), from_pandas=True)
        out["wsum"] = pa.array(wsum, from_pandas=True)
        out["wcount"] = wcount.astype(np.int64)
    else:
        out["v"] = pa.array(v, from_pandas=True)
    out.update(extra)
    return pa.RecordBatch.from_pydict(out)


def pixel_records(planes: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(plane of each pixel, records) of sparse planes."""
    recs = np.frombuffer(b"".join(planes), kind)
    of = np.repeat(np.arange(len(planes)), np.array([len(p) for p in planes]) // kind.itemsize)
    body = recs["off"] != SPARSE
    return of[body], recs[body]


def _unpack_sparse(rb, cols, i: int, j: int, valid_only: bool, weighted: bool, keep):
    """Cells of the sparse blocks i to j - 1 of a batch, which share size, dtype and nodata."""
    size, dtype, nodata = cols["size"][i], cols["dtype"][i], cols["nodata"][i]
    sums = weighted and cols["weight"][i] is not None
    if sums != (weighted and cols["weight"][j - 1] is not None) or (weighted and len({w is None for w in cols["weight"][i:j]}) > 1):
        for k in range(i, j):
            yield from _unpack_sparse(rb, cols, k, k + 1, valid_only, weighted, keep)
        return
    of, recs = pixel_records(cols["weight" if sums else "data"][i:j], SPARSE_SUMS if sums else sparse_record(dtype))
    ok = recs["c"] > 0 if sums else valid_mask(recs["v"], nodata)
    v = None if sums else recs["v"].astype(np.float64)
    if v is not None:
        ok &= ~np.isnan(v)
    of, recs = of[ok], recs[ok]
    if not len(of):
        return
    z, band, x, y = (np.asarray(cols[c][i:j], dtype=np.int64)[of] for c in ("z", "band", "x", "y"))
    off = recs["off"].astype(np.int64)
    extra = {kk: rb.column(kk).take(pa.array(i + of)) for kk in keep}
    at = (z, band, x * size + off % size, y * size + off // size)
    if weighted:
        yield _cells_batch(*at, None, extra, True, wsum=recs["s"] if sums else v[ok], wcount=recs["c"] if sums else np.ones(len(of), np.int64))
    else:
        yield _cells_batch(*at, v[ok], extra, False)


def _marked(rb) -> np.ndarray:
    """Which blocks of a batch are sparse (:func:`is_sparse`), from the buffer of ``data``."""
    raw, at = binary_buffer(rb.column("data"))
    size, kind = rb.column("size").to_numpy(zero_copy_only=False).astype(np.int64), rb.column("dtype").dictionary_encode()
    width = np.array([int(t[1:]) for t in kind.dictionary.to_pylist()], np.int64)[kind.indices.to_numpy(zero_copy_only=False)]
    length = at[1:] - at[:-1]
    out = (length >= 4) & (length != size * size * width)
    first = at[:-1][out]
    out[out] = np.all([raw[first + i] == b for i, b in enumerate(np.int32(SPARSE).tobytes())], axis=0)
    return out


def binary_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a binary column without nulls."""
    bufs = col.buffers()
    wide = pa.types.is_large_binary(col.type)
    at = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(bufs[2], np.uint8)[at[0]:at[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _unpack_marked(rb, keep):
    """Cells of the sparse blocks of a batch, all at once, if they share size, dtype and nodata; else None."""
    for c in ("size", "dtype", "nodata"):
        if len(rb.column(c).unique()) > 1:
            return None
    size, dtype, nodata = (rb.column(c)[0].as_py() for c in ("size", "dtype", "nodata"))
    kind = sparse_record(dtype)
    raw, at = binary_buffer(rb.column("data"))
    recs = np.frombuffer(raw.tobytes(), kind)
    of = np.repeat(np.arange(rb.num_rows), (at[1:] - at[:-1]) // kind.itemsize)
    ok = (recs["off"] != SPARSE) & valid_mask(recs["v"], nodata)
    v = recs["v"].astype(np.float64)
    ok &= ~np.isnan(v)
    of, off = of[ok], recs["off"][ok].astype(np.int64)
    z, band, x, y = (rb.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[of] for c in ("z", "band", "x", "y"))
    extra = {kk: rb.column(kk).take(pa.array(of)) for kk in keep}
    return _cells_batch(z, band, x * size + off % size, y * size + off // size, v[ok], extra, False)


def _unpack_batches(batches: Iterator[pa.RecordBatch], valid_only: bool, weighted: bool, keep=()):
    for rb in batches:
        if valid_only and not weighted and rb.num_rows and not any(rb.column(c).null_count for c in ("data", "size", "dtype", "nodata")):
            marked = _marked(rb)
            cells = _unpack_marked(rb.filter(pa.array(marked)), keep) if marked.any() else None
            if cells is not None:
                if cells.num_rows:
                    yield cells
                rb = rb.filter(pa.array(~marked))
        if not rb.num_rows:
            continue
        cols = rb.to_pydict()
        n = rb.num_rows
        thin = [valid_only and nd is not None and is_sparse(d, t, s) and (not weighted or w is None or is_sparse_sums(w, s))
                for d, t, s, nd, w in zip(*[cols[c] for c in ("data", "dtype", "size", "nodata", "weight")])]
        i = 0
        while i < n:
            size, dtype, nodata = cols["size"][i], cols["dtype"][i], cols["nodata"][i]
            if thin[i]:                               # a run of sparse blocks, pixel by pixel
                j = i + 1
                while j < n and thin[j] and cols["size"][j] == size and cols["dtype"][j] == dtype and cols["nodata"][j] == nodata:
                    j += 1
                yield from _unpack_sparse(rb, cols, i, j, valid_only, weighted, keep)
                i = j
                continue
            # a run of small blocks of one layout is decoded as one (k, size, size) array
            j = i + 1
            if size * size * 4 <= UNPACK_PIXELS:
                while (j < n and not thin[j] and (j - i + 1) * size * size <= UNPACK_PIXELS and cols["size"][j] == size
                       and cols["dtype"][j] == dtype and cols["nodata"][j] == nodata):
                    j += 1
            k = j - i
            if weighted:
                planes = [row_sums({c: cols[c][b] for c in ("data", "dtype", "size", "nodata", "weight")})
                          for b in range(i, j)]
                cnt = np.stack([p[1] for p in planes])
                arr = np.where(cnt > 0, np.stack([p[0] for p in planes]), np.nan)
            else:
                arr = np.stack([decode(d, dtype, size) for d in cols["data"][i:j]])
                arr = to_float(arr, nodata)
            zs = np.asarray(cols["z"][i:j])
            bs = np.asarray(cols["band"][i:j])
            xs = np.asarray(cols["x"][i:j], dtype=np.int64)
            ys = np.asarray(cols["y"][i:j], dtype=np.int64)
            for r0 in range(0, size, UNPACK_ROWS):
                part = arr[:, r0:r0 + UNPACK_ROWS]
                sel = ~np.isnan(part) if valid_only else np.ones(part.shape, dtype=bool)
                bi, rr, cc = np.nonzero(sel)
                if len(bi) == 0:
                    continue
                v = part[bi, rr, cc]
                extra = {kk: rb.column(kk).take(pa.array(i + bi)) for kk in keep}
                if weighted:
                    c = cnt[:, r0:r0 + UNPACK_ROWS][bi, rr, cc]
                    yield _cells_batch(zs[bi], bs[bi], xs[bi] * size + cc, ys[bi] * size + r0 + rr, None, extra,
                                       True, wsum=v, wcount=c)
                else:
                    yield _cells_batch(zs[bi], bs[bi], xs[bi] * size + cc, ys[bi] * size + r0 + rr, v, extra, False)
            i = j


def unpack_blocks(blocks: DataFrame, valid_only: bool = True, weighted: bool = False,
                  keep: tuple = ()) -> DataFrame:
    """Block rows -> cell rows ``(z, band, gx, gy, v)`` (plus ``wsum, wcount`` if weighted).

    ``keep`` names extra block columns copied onto every cell.  A narrow map:
    no shuffle.  Filter and project blocks *before* calling it, so the scan
    below reads only what is needed.
    """
    base = CELL_WEIGHT_SCHEMA if weighted else CELL_SCHEMA
    schema = T.StructType(list(base.fields) + [blocks.schema[k] for k in keep])   # never mutate the shared schema
    return blocks.select(*BLOCK_COLUMNS, *keep).mapInArrow(
        lambda it: _unpack_batches(it, valid_only, weighted, keep), schema)


# ------------------------------------------------------------------ failures (F8)
def block_error() -> F.Column:
    """Why a block row cannot be read (NULL: it can), from its columns alone: usable as a filter before any kernel."""
    size = F.octet_length("data")
    return (F.when(F.col("data").isNull() | F.col("size").isNull() | F.col("dtype").isNull(), F.lit("incomplete row"))
             .when(~F.col("dtype").isin(*DTYPES), F.concat(F.lit("unknown dtype "), F.col("dtype")))
             .when((size != pixel_bytes()) & ~_holds_sparse(), F.concat(size.cast("string"), F.lit(" of "), pixel_bytes().cast("string"), F.lit(" bytes"))))


def _holds_sparse() -> F.Column:
    """``data`` is whole in sparse form: marked, and a record for the fill and for every valid pixel."""
    record = F.substring("dtype", 2, 1).cast("int") + 4
    return ((F.substring("data", 1, 4) == F.lit(bytearray(np.int32(SPARSE).tobytes())))
            & (F.octet_length("data") == (F.col("valid_count") + 1) * record))


def try_blocks(blocks: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], out_dtype: str | None = None,
               out_nodata="same") -> DataFrame:
    """:func:`map_blocks` that keeps failures: block columns and ``error``.  A row that cannot be read or whose
    kernel raises comes out with its key, no pixels and the reason; its neighbours are not touched."""
    schema = T.StructType([*BLOCK_FIELDS, T.StructField("error", T.StringType(), True)])
    arrow = pa.schema([*_BLOCK_ARROW, ("error", pa.string())])

    def _run(batches):
        for rb in batches:
            recs = []
            for r in rb.to_pylist():
                error = r.pop("error")
                if error is None:
                    try:
                        od, on = out_dtype or r["dtype"], r["nodata"] if out_nodata == "same" else out_nodata
                        arr, valid = from_float(kernel(row_values(r)), od, on)
                        recs.append({**block_record(r["z"], r["x"], r["y"], r["band"], r["size"], od, on, arr, valid), "error": None})
                        continue
                    except Exception as e:  # noqa: BLE001 -- whatever a kernel raises is a row of the result
                        error = f"{type(e).__name__}: {e}"
                recs.append({**r, "size": r["size"] or 0, "dtype": r["dtype"] or "", "valid_count": 0, "data": b"", "weight": None, "error": error})
            yield from pa.Table.from_pylist(recs, schema=arrow).to_batches()

    return blocks.select(*BLOCK_COLUMNS, block_error().alias("error")).mapInArrow(_run, schema)


def split_failures(tried: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, dead letters) of a :func:`try_blocks` result, computed once: both are written in one pass, apart."""
    spark = tried.sparkSession
    tried.withColumn("failed", F.col("error").isNotNull()).write.partitionBy("failed").parquet(path)
    back = spark.read.schema(T.StructType([*tried.schema.fields, T.StructField("failed", T.BooleanType())])).parquet(path)
    return (back.where(~F.col("failed")).select(*BLOCK_COLUMNS),
            back.where(F.col("failed")).select("z", "x", "y", "band", "size", "dtype", "error"))


# ------------------------------------------------------------------ statistics
def block_moments(blocks: DataFrame, keep: tuple = ()) -> DataFrame:
    """Per block: n, vmin, vmax, mean and m2 (sum of squared distances from the mean) of valid pixels: one row a
    block, mergeable by :func:`merge_moments`."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in (
        ("z", T.IntegerType()), ("x", T.IntegerType()), ("y", T.IntegerType()), ("band", T.IntegerType()), ("n", T.LongType()),
        ("vmin", T.DoubleType()), ("vmax", T.DoubleType()), ("mean", T.DoubleType()), ("m2", T.DoubleType()))]
        + [blocks.schema[k] for k in keep])
    arrow = pa.schema([(f.name, pa_type(f.dataType)) for f in schema.fields])

    def _run(batches):
        for rb in batches:
            out = []
            for r in rb.to_pylist():
                v = row_values(r)
                v = v[~np.isnan(v)]
                row = {**{k: r[k] for k in ("z", "x", "y", "band", *keep)}, "n": v.size}
                if v.size:
                    mean = float(v.mean())
                    row |= {"vmin": float(v.min()), "vmax": float(v.max()), "mean": mean, "m2": float(((v - mean) ** 2).sum())}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return blocks.select(*BLOCK_COLUMNS, *keep).mapInArrow(_run, schema)


def merge_moments(moments: DataFrame, keys: tuple = ()) -> DataFrame:
    """Moments of groups of blocks: (keys.., n, vmin, vmax, mean, m2).  The mean first, then the parts' spread about it:
    sums of squares are never subtracted.  Reads ``moments`` twice: write it if it is costly."""
    part = moments.where(F.col("n") > 0)
    mean = part.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("all_mean"))
    if keys:
        named = mean.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "all_mean")
        met = part.join(named, [part[k].eqNullSafe(named[f"_k_{k}"]) for k in keys])
    else:
        met = part.withColumn("all_mean", mean.select("all_mean").scalar())
    off = F.col("mean") - F.col("all_mean")
    return met.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax"),
                                  F.max("all_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))


def block_stats(blocks: DataFrame, keep: tuple = ()) -> DataFrame:
    """Per block: valid_count, min, max and sum of valid pixels (a narrow map)."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in (
        ("z", T.IntegerType()), ("x", T.IntegerType()), ("y", T.IntegerType()), ("band", T.IntegerType()),
        ("valid_count", T.IntegerType()), ("vmin", T.DoubleType()), ("vmax", T.DoubleType()),
        ("vsum", T.DoubleType()))] + [blocks.schema[k] for k in keep])

    def _run(batches):
        for rb in batches:
            c = rb.to_pydict()
            out = {f.name: [] for f in schema.fields}
            for i in range(rb.num_rows):
                arr = to_float(decode(c["data"][i], c["dtype"][i], c["size"][i]), c["nodata"][i])
                ok = ~np.isnan(arr)
                n = int(ok.sum())
                for k in ("z", "x", "y", "band"):
                    out[k].append(c[k][i])
                out["valid_count"].append(n)
                out["vmin"].append(float(arr[ok].min()) if n else None)
                out["vmax"].append(float(arr[ok].max()) if n else None)
                out["vsum"].append(float(arr[ok].sum()) if n else None)
                for k in keep:
                    out[k].append(c[k][i])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [(f.name, pa_type(f.dataType)) for f in schema.fields]))

    return blocks.select(*BLOCK_COLUMNS, *keep).mapInArrow(_run, schema)


def pa_type(t):
    return {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(),
            T.BooleanType(): pa.bool_(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}[t]


# ------------------------------------------------------------------ strips
STRIP_SCHEMA = T.StructType([
    T.StructField("row", T.LongType(), False), T.StructField("width", T.IntegerType(), False),
    T.StructField("dtype", T.StringType(), False), T.StructField("nodata", T.DoubleType(), True),
    T.StructField("data", T.BinaryType(), False),
])


def pack_strips(cells: DataFrame, width: int, dtype: str = "f8", nodata=None) -> DataFrame:
    """Cells -> one block per raster row (``width`` x 1), the layout of strip-organised sources.

    Hash-partitioned and sorted by row, then a streaming Arrow pass builds all
    finished rows of a batch at once (no per-row Python call)."""
    keyed = cells.select(F.col("gy").cast("bigint").alias("row"), F.col("gx").cast("int").alias("off"),
                         F.col("v").cast("double").alias("v"))
    ordered = keyed.repartition("row").sortWithinPartitions("row")
    return ordered.mapInArrow(lambda it: _strips_sorted(it, width, dtype, nodata), STRIP_SCHEMA)


def _strips_sorted(batches, width: int, dtype: str, nodata):
    arrow = pa.schema([("row", pa.int64()), ("width", pa.int32()), ("dtype", pa.string()),
                       ("nodata", pa.float64()), ("data", pa.binary())])
    carry = None

    def emit(rows, off, vals):
        starts = np.concatenate(([0], np.flatnonzero(rows[1:] != rows[:-1]) + 1))
        per_chunk = max(1, PACK_BYTES // (width * 8))
        for c0 in range(0, len(starts), per_chunk):
            st = starts[c0:c0 + per_chunk]
            r0 = st[0]
            r1 = starts[c0 + per_chunk] if c0 + per_chunk < len(starts) else len(rows)
            tid = np.repeat(np.arange(len(st)), np.diff(np.concatenate((st, [r1]))))
            buf = np.full((len(st), width), np.nan)
            buf[tid, off[r0:r1]] = vals[r0:r1]
            arr, _ = from_float(buf, dtype, nodata)
            n = len(st)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows[st], pa.int64()), pa.array(np.full(n, width), pa.int32()),
                pa.array([dtype] * n, pa.string()), pa.array([nodata] * n, pa.float64()),
                pa.array([arr[i].tobytes() for i in range(n)], pa.binary())], schema=arrow)

    for rb in batches:
        if rb.num_rows == 0:
            continue
        cols = [rb.column(k).to_numpy(zero_copy_only=False) for k in ("row", "off", "v")]
        cols[2] = cols[2].astype(np.float64)
        if carry is not None:
            cols = [np.concatenate((a, b)) for a, b in zip(carry, cols)]
        rows = cols[0]
        k = int(np.flatnonzero(rows != rows[-1]).max()) + 1 if (rows != rows[-1]).any() else 0
        if k:
            yield from emit(rows[:k], cols[1][:k], cols[2][:k])
        carry = [c[k:] for c in cols]
    if carry is not None and len(carry[0]):
        yield from emit(*carry)


SEGMENT_SCHEMA = T.StructType([
    T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType()), T.StructField("band", T.IntegerType()),
    T.StructField("r", T.IntegerType()), T.StructField("dtype", T.StringType()),
    T.StructField("nodata", T.DoubleType()), T.StructField("seg", T.BinaryType())])
_SEGMENT_ARROW = pa.schema([("x", pa.int32()), ("y", pa.int32()), ("band", pa.int32()), ("r", pa.int32()), ("dtype", pa.string()),
                            ("nodata", pa.float64()), ("seg", pa.binary())])


def _segments(batches, size: int):
    """Strips -> their segments, as the bytes they are stored in (the last one may be short)."""
    for rb in batches:
        parts = []
        for i, (row, width, dtype, nodata, band) in enumerate(zip(*[rb.column(c).to_pylist() for c in ("row", "width", "dtype", "nodata", "band")])):
            n, step = -(-width // size), size * int(dtype[1])
            raw = memoryview(rb.column("data")[i].as_buffer())
            parts.append(pa.RecordBatch.from_arrays([
                pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, row // size), pa.int32()), pa.array(np.full(n, band), pa.int32()),
                pa.array(np.full(n, row % size), pa.int32()), pa.array([dtype] * n, pa.string()), pa.array([nodata] * n, pa.float64()),
                pa.array([bytes(raw[k:k + step]) for k in range(0, width * int(dtype[1]), step)], pa.binary())], schema=_SEGMENT_ARROW))
        if parts:
            yield from pa.Table.from_batches(parts).combine_chunks().to_batches()


def _square(key: tuple, parts: list[tuple], z: int, size: int) -> dict | None:
    """Segments (r, dtype, nodata, bytes) of one square -> its block, in their own dtype and nodata; strips that differ
    in them are brought to a dtype and nodata that hold all."""
    layouts = {p[1:3] for p in parts}
    if len(layouts) == 1:
        dtype, nodata = parts[0][1:3]
        arr = np.full((size, size), 0 if nodata is None else nodata, dtype="<" + dtype)
        for r, _, _, seg in parts:
            arr[r, :len(seg) // int(dtype[1])] = np.frombuffer(seg, "<" + dtype)
        valid = int(valid_mask(arr, nodata).sum())
    else:
        vals = np.full((size, size), np.nan)
        for r, dt, nd, seg in parts:
            row = to_float(np.frombuffer(seg, "<" + dt), nd)
            vals[r, :len(row)] = row
        dtype, nodatas = joint_layout([(d, (n,)) for d, n in sorted(layouts, key=str)])
        dtype, nodata = fit_layout(vals, dtype, nodatas)
        arr, valid = from_float(vals, dtype, nodata)
    return block_record(z, key[0], key[1], key[2], size, dtype, nodata, arr, valid) if valid else None


def reblock_strips(strips: DataFrame, size: int, z: int, band: int = 1) -> DataFrame:
    """Strip blocks -> square ``size`` blocks with one shuffle on the new block key.

    Each strip is cut into row segments addressed to their square block, as stored bytes; a
    group then holds ``size`` segments of ``size`` pixels.  A ``band`` column of the strips is kept
    (``band`` names it where they have none), dtype and nodata too.
    """
    own = strips if "band" in strips.columns else strips.withColumn("band", F.lit(band))

    def _squares(batches):
        """Segments sorted by (x, y, band, r) -> one square block per run."""
        cur, parts = None, []
        for rb in batches:
            done = []
            for *key, r, dtype, nodata, seg in zip(*[rb.column(c).to_pylist() for c in ("x", "y", "band", "r", "dtype", "nodata", "seg")]):
                if tuple(key) != cur:
                    if cur is not None:
                        done.append(_square(cur, parts, z, size))
                    cur, parts = tuple(key), []
                parts.append((r, dtype, nodata, seg))
            done = [d for d in done if d is not None]
            if done:
                yield from records_to_table(done).to_batches()
        last = _square(cur, parts, z, size) if cur is not None else None
        if last is not None:
            yield from records_to_table([last]).to_batches()

    return (own.select("row", "width", "dtype", "nodata", "band", "data").mapInArrow(lambda it: _segments(it, size), SEGMENT_SCHEMA)
               .repartition("x", "y", "band").sortWithinPartitions("x", "y", "band", "r")
               .mapInArrow(_squares, BLOCK_SCHEMA))


# ------------------------------------------------------------------ generic kernels
def map_blocks(blocks: DataFrame, kernel: Callable[[np.ndarray], np.ndarray],
               out_dtype: str | None = None, out_nodata="same") -> DataFrame:
    """Apply ``kernel(float64 array with NaN = missing) -> float64 array`` to every block."""

    def _run(batches):
        for rb in batches:
            cols = rb.to_pydict()
            recs = []
            for i in range(rb.num_rows):
                size, dtype, nodata = cols["size"][i], cols["dtype"][i], cols["nodata"][i]
                res = kernel(to_float(decode(cols["data"][i], dtype, size), nodata))
                od = out_dtype or dtype
                on = nodata if out_nodata == "same" else out_nodata
                arr, valid = from_float(res, od, on)
                recs.append(block_record(cols["z"][i], cols["x"][i], cols["y"][i], cols["band"][i],
                                         size, od, on, arr, valid))
            yield from records_to_table(recs).to_batches()

    return blocks.select(*BLOCK_COLUMNS).mapInArrow(_run, BLOCK_SCHEMA)


def fold_blocks(blocks: DataFrame, keys: list, kernel: Callable[[tuple, list[dict]], list[dict]]) -> DataFrame:
    """Group blocks by ``keys`` (Columns) and fold each group with ``kernel``.

    ``kernel(key, rows)`` gets the group's block rows as dicts and returns block
    records.  Callers must keep groups bounded (e.g. the four children of a tile).
    """
    key_cols = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]

    def _run(key, tbl):
        rows = tbl.select(BLOCK_COLUMNS).to_pylist()
        return records_to_table(kernel(tuple(k.as_py() for k in key), rows))

    return (blocks.select(*key_cols, *BLOCK_COLUMNS)
            .groupBy(*names).applyInArrow(_run, BLOCK_SCHEMA))


def fold_blocks_sorted(blocks: DataFrame, keys: list, kernel: Callable[[tuple, list[dict]], list[dict]], quick=None) -> DataFrame:
    """:func:`fold_blocks` for many small groups: rows come sorted by group and are cut where the key changes, so a group
    costs no Python call of Spark's.  ``quick(columns)`` may take all finished groups of a batch at once: it returns
    batches, or None where it cannot."""
    names = [f"_k{i}" for i in range(len(keys))]

    def fold(tbl: pa.Table):
        made = quick(tbl) if quick is not None else None
        if made is not None:
            yield from made
            return
        cur, rows, out = None, [], []
        for key, row in zip(zip(*[tbl.column(k).to_pylist() for k in names]), tbl.select(BLOCK_COLUMNS).to_pylist()):
            if key != cur:
                if rows:
                    out += kernel(cur, rows)
                if len(out) >= 256:
                    yield from records_to_table(out).to_batches()
                    out = []
                cur, rows = key, []
            rows.append(row)
        if rows:
            out += kernel(cur, rows)
        if out:
            yield from records_to_table(out).to_batches()

    def run(batches):
        held: list[pa.RecordBatch] = []
        for rb in batches:
            if rb.num_rows == 0:
                continue
            key = list(zip(*[rb.column(k).to_pylist() for k in names]))
            cut = len(key)
            while cut and key[cut - 1] == key[-1]:
                cut -= 1                              # the last group may go on
            if held and (cut or [held[-1].column(k)[-1].as_py() for k in names] != list(key[-1])):
                yield from fold(pa.Table.from_batches([*held, rb.slice(0, cut)]))
                held = []
            elif cut:
                yield from fold(pa.Table.from_batches([rb.slice(0, cut)]))
            held.append(rb.slice(cut))
        if held:
            yield from fold(pa.Table.from_batches(held))

    return (blocks.select(*[k.alias(n) for k, n in zip(keys, names)], *BLOCK_COLUMNS).repartition(*names)
                  .sortWithinPartitions(*names).mapInArrow(run, BLOCK_SCHEMA))


def fold_blocks_keyed(blocks: DataFrame, keys: list[str], kernel) -> DataFrame:
    """Like :func:`fold_blocks` but grouping on existing columns ``keys`` (kept out of the rows)."""
    def _run(key, tbl):
        rows = tbl.select(BLOCK_COLUMNS).to_pylist()
        return records_to_table(kernel(tuple(k.as_py() for k in key), rows))

    return blocks.groupBy(*keys).applyInArrow(_run, BLOCK_SCHEMA)
