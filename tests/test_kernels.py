"""Property tests of the NumPy kernels (no Spark): random masks, sizes and batch splits."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tessera.operators import blocks as B, halo as H, pyramid as P


def _arrays(draw, size):
    vals = np.array(draw(st.lists(st.integers(-1000, 1000), min_size=size * size, max_size=size * size)),
                    dtype=np.float64).reshape(size, size)
    mask = np.array(draw(st.lists(st.booleans(), min_size=size * size, max_size=size * size))).reshape(size, size)
    vals[mask] = np.nan
    return vals


@st.composite
def rasters(draw):
    size = draw(st.sampled_from([2, 4, 6]))
    return _arrays(draw, size)


@settings(max_examples=60, deadline=None)
@given(rasters())
def test_halve_matches_brute_force(a):
    n = a.shape[0] // 2
    near, _ = P._halve(a, None, "nearest")
    avg, cnt = P._halve(a, None, "average")
    for i in range(n):
        for j in range(n):
            assert (np.isnan(near[i, j]) and np.isnan(a[2 * i + 1, 2 * j + 1])) or near[i, j] == a[2 * i + 1, 2 * j + 1]
            cell = a[2 * i:2 * i + 2, 2 * j:2 * j + 2]
            ok = ~np.isnan(cell)
            assert cnt[i, j] == ok.sum()
            if ok.any():
                assert avg[i, j] == cell[ok].sum()
            else:
                assert np.isnan(avg[i, j])


@settings(max_examples=60, deadline=None)
@given(rasters(), st.sampled_from([1.0, 2.0, 0.5]))
def test_masked_gradient_matches_loop(a, h):
    g = H.masked_gradient(a, h, 0)
    n, m = a.shape
    for i in range(n):
        for j in range(m):
            v = a[i, j]
            p = a[i - 1, j] if i > 0 else np.nan
            q = a[i + 1, j] if i < n - 1 else np.nan
            if np.isnan(v) or (np.isnan(p) and np.isnan(q)):
                exp = np.nan
            elif np.isnan(p):
                exp = (q - v) / h
            elif np.isnan(q):
                exp = (v - p) / h
            else:
                exp = (q - p) / (2.0 * h)
            assert (np.isnan(exp) and np.isnan(g[i, j])) or g[i, j] == exp


@settings(max_examples=40, deadline=None)
@given(rasters(), st.sampled_from(["f4", "f8", "i2", "i4", "i8"]))
def test_encode_decode_roundtrip(a, dtype):
    nodata = -32768.0 if dtype == "i2" else -1e30 if dtype.startswith("f") else -(2.0 ** 31)
    arr, valid = B.from_float(a, dtype, nodata)
    assert valid == int((~np.isnan(a)).sum())
    back = B.to_float(B.decode(B.encode(arr, dtype), dtype, a.shape[0]), nodata)
    assert np.array_equal(np.isnan(back), np.isnan(a))
    assert np.array_equal(back[~np.isnan(a)], a[~np.isnan(a)])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 15)), min_size=1, max_size=60,
                unique_by=lambda t: t), st.lists(st.integers(1, 59), max_size=4))
def test_streaming_pack_equals_naive(cells, cuts):
    size = 4
    rows = sorted((6, x, y, 1, off, float(x * 100 + y * 10 + off)) for x, y, off in cells)
    cols = list(zip(*rows))
    tbl = pa.table({"z": pa.array(cols[0], pa.int32()), "x": pa.array(cols[1], pa.int32()),
                    "y": pa.array(cols[2], pa.int32()), "band": pa.array(cols[3], pa.int32()),
                    "off": pa.array(cols[4], pa.int32()), "v": pa.array(cols[5], pa.float64())})
    bounds = sorted({c for c in cuts if c < len(rows)} | {0, len(rows)})
    batches = [tbl.slice(a, b - a).to_batches()[0] for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    out = pa.Table.from_batches(list(B._pack_sorted(iter(batches), size, "f8", -1.0))).to_pylist()
    got = {(r["x"], r["y"]): B.to_float(B.decode(r["data"], "f8", size), -1.0) for r in out}
    exp = {}
    for _, x, y, _, off, v in rows:
        exp.setdefault((x, y), np.full(size * size, np.nan))[off] = v
    assert got.keys() == exp.keys()
    for k in exp:
        assert np.array_equal(np.isnan(got[k].ravel()), np.isnan(exp[k]))
        assert np.array_equal(got[k].ravel()[~np.isnan(exp[k])], exp[k][~np.isnan(exp[k])])
    assert all(r["valid_count"] == int((~np.isnan(exp[(r["x"], r["y"])])).sum()) for r in out)


def test_streaming_pack_bounds_tiles_per_chunk(monkeypatch):
    # force one tile per chunk: output must not change
    monkeypatch.setattr(B, "PACK_BYTES", 1)
    rows = [(6, x, 0, 1, off, float(x + off)) for x in range(5) for off in (0, 3)]
    cols = list(zip(*rows))
    tbl = pa.table({"z": pa.array(cols[0], pa.int32()), "x": pa.array(cols[1], pa.int32()),
                    "y": pa.array(cols[2], pa.int32()), "band": pa.array(cols[3], pa.int32()),
                    "off": pa.array(cols[4], pa.int32()), "v": pa.array(cols[5], pa.float64())})
    batches = list(B._pack_sorted(iter(tbl.to_batches()), 2, "f8", -1.0))
    assert sum(b.num_rows for b in batches) == 5 and len(batches) == 5
    out = pa.Table.from_batches(batches).to_pylist()
    assert [r["valid_count"] for r in out] == [2] * 5


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 5)), min_size=1, max_size=40, unique=True),
       st.lists(st.integers(1, 39), max_size=3))
def test_streaming_strips_equal_naive(cells, cuts):
    rows = sorted((r, off, float(r * 10 + off)) for r, off in cells)
    cols = list(zip(*rows))
    tbl = pa.table({"row": pa.array(cols[0], pa.int64()), "off": pa.array(cols[1], pa.int32()),
                    "v": pa.array(cols[2], pa.float64())})
    bounds = sorted({c for c in cuts if c < len(rows)} | {0, len(rows)})
    batches = [tbl.slice(a, b - a).to_batches()[0] for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    out = pa.Table.from_batches(list(B._strips_sorted(iter(batches), 6, "f8", -1.0))).to_pylist()
    got = {r["row"]: np.frombuffer(r["data"], dtype="<f8") for r in out}
    exp = {}
    for r, off, v in rows:
        exp.setdefault(r, np.full(6, -1.0))[off] = v
    assert got.keys() == exp.keys() and all(np.array_equal(got[k], exp[k]) for k in exp)
