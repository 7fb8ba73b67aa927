"""Helpers shared by the operators: table reads, scratch tables, Arrow batches as byte buffers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

# Kernels work on slices of at most this many bytes of text (plus one row), so that
# the NumPy temporaries of a task do not depend on how Spark cut its Arrow batches.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table written by `materialise` once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        with contextlib.suppress(Exception):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(id_col: str, modulus: int, remainder: int):
    """crc32 of the id as text, modulo `modulus`, equals `remainder` (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def tidy(run: Callable) -> Callable:
    """A map function whose worker gives freed memory back when its task ends (workers are reused by later stages)."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(Exception):           # glibc only
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def remembered(limit: int) -> Callable:
    """Keep up to `limit` results of a function in the process that calls it, by its arguments.

    Unlike lru_cache this travels by value to workers that do not have this package, and what a
    worker has remembered outlives the task.
    """
    def wrap(fn: Callable) -> Callable:
        name = f"{fn.__module__}.{fn.__qualname__}"

        @functools.wraps(fn)
        def call(*args):
            kept = sys.__dict__.setdefault("_tessera_remembered", {}).setdefault(name, {})
            got = kept.get(args, kept)
            if got is kept:
                if len(kept) >= limit:
                    kept.clear()
                got = kept[args] = fn(*args)
            return got
        return call
    return wrap


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty, offsets start at 0."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    n = len(col)
    if n == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay within `limit` (a longer single row forms its own range)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Yield (rows of the batch, bytes, offsets) slice by slice."""
    data, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
    for lo, hi in slices(off, limit):
        yield batch.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `values` over [offsets[i], offsets[i+1])."""
    c = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PRIME = (1 << 31) - 1
_BASES = (1_380_623_951, 715_225_739)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = [mix64(np.arange(256, dtype=np.uint64) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(_PRIME) for k in range(2)]


@remembered(8)
def _powers(base: int, n: int, step: int = 1) -> np.ndarray:
    """base^0, base^step, base^(2 step), ... modulo the prime."""
    out, have = np.ones(n, np.uint64), 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, step * have, _PRIME)) % np.uint64(_PRIME)
        have += more
    return out


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, by prefix sums of two polynomials modulo 2^31 - 1.

    A prime modulus: modulo a power of two, texts are known that collide under every base.
    """

    FINE = 4096

    def __init__(self, data: np.ndarray) -> None:
        n, p = len(data), np.uint64(_PRIME)
        self.prefix = []
        for base, values in zip(_BASES, _BYTES):
            term = _powers(base, 1 << max(16, n.bit_length()))[:n] * values[data]
            high = term >> np.uint64(31)
            term &= p
            term += high                                    # below 2^32: sums of 2^31 of them fit
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(term, out=sums[1:])
            self.prefix.append(sums)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        p, out = np.uint64(_PRIME), None
        coarse = int(starts.max(initial=0)) // self.FINE + 1
        for base, sums in zip(_BASES, self.prefix):
            back = pow(base, -1, _PRIME)
            shift = (_powers(back, self.FINE)[starts % self.FINE]
                     * _powers(back, 1 << max(8, coarse.bit_length()), self.FINE)[starts // self.FINE]) % p
            h = (sums[ends] - sums[starts]) % p * shift % p
            out = h if out is None else (out << np.uint64(32)) | h
        return mix64(mix64(out + _ODD) ^ (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(data)(starts, ends)
