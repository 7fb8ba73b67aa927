"""Embedding near-dedup by an epsilon grid order join.

Cosine >= t on unit vectors is a Euclidean distance of at most eps = sqrt(2 - 2 t).  Vectors are
rotated to their principal axes; the cells of a grid of width eps on the leading ones, in
lexicographic order, are the epsilon grid order.  A range-partitioned sort by it gives the
sequence, which is cut into intervals of bounded size by global position (however many partitions it has), each
with its bounding box on the leading axes.  The join recurses over
intervals of that sequence: a pair of intervals whose boxes are more than eps apart can hold no
link and is dropped, any other is expanded into the pairs of its children - rounds of an explode
and two equi-joins with the box table, down to the intervals that vectors are kept in; only then do vectors move.
Inside a task the recursion goes on over sub-blocks.  A pair of vectors is still provably distant if its cosine on the
leading axes plus the product of what both have outside them (Cauchy-Schwarz) stays below t; that is one narrow
matrix product, and what is left is verified by exact dot products in double precision.

Equal vectors are one class; only class representatives are joined and a class counts with its size.
A pair of intervals emits, per vector, the number of vectors linked to it and a spanning forest of its
links, never the links.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component, or whose id is
null, links with nothing and is its own component; vectors of different lengths are never compared;
rows that repeat an id and its vector count as vectors of their own; an empty table gives no rows.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, tidy
from tessera.llm.components import components, forest

AXES = 8                     # principal axes of the bounding boxes
CELLS = 4                    # leading axes of the grid order
BOUND = 24                   # axes of the bound on a cosine
INTERVAL_BYTES = 4 << 20     # vectors of an interval, as doubles
SUB = 512                    # vectors of a sub-block inside a task
FAN = 8                      # children of an interval


def units(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors from components as they were stored (4 or 8 bytes each)."""
    if all(len(r) == 4 * dim for r in raw):
        x = np.frombuffer(b"".join(raw), "<f4").astype(np.float64).reshape(-1, dim)
    else:
        x = np.stack([np.frombuffer(r, "<f4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)                           # no overflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, digest, dim, vec): the components in as few bytes as hold them exactly; all null if the vector links with nothing."""
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        digest, dims, vecs = [], [], []
        for i in range(len(lists)):
            v = lists[i].values if lists[i].is_valid else None
            x = None
            if v is not None and len(v) and not v.null_count and ids[i].is_valid:
                x = v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0      # -0.0 becomes 0.0
                if not np.isfinite(x).all() or not x.any():
                    x = None
            if x is None:
                for out in (digest, dims, vecs):
                    out.append(None)
                continue
            with np.errstate(over="ignore"):
                short = x.astype("<f4")
            digest.append(hashlib.sha256(x.tobytes()).digest()[:16])
            dims.append(len(x))
            vecs.append((short if (short == x).all() else x.astype("<f8")).tobytes())
        yield pa.RecordBatch.from_arrays([ids, pa.array(digest, pa.binary()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                         names=["id", "digest", "dim", "vec"])


def _moments(dim: int):
    """Sums of products (i, j) and of components (i, -1) of a partition's vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            if not len(batch):
                continue
            x = units(batch.column(0).to_pylist(), dim)
            n, s, ss = n + len(x), s + x.sum(axis=0), ss + x.T @ x
        if n:
            i, j = np.indices((dim, dim))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([i.ravel(), np.arange(dim), [-1]])), pa.array(np.concatenate([j.ravel(), np.full(dim, -1), [-1]])),
                pa.array(np.concatenate([ss.ravel(), s, [float(n)]]))], names=["i", "j", "s"])
    return run


def principal_axes(vecs: DataFrame, dim: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes as columns) from the second moments of all vectors; dim^2 sums reach the driver."""
    sums = vecs.select("vec").mapInArrow(_moments(dim), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    got = {(r["i"], r["j"]): r["s"] for r in sums}
    n = got.get((-1, -1), 0.0) or 1.0
    mean = np.array([got.get((i, -1), 0.0) for i in range(dim)]) / n
    cov = np.array([[got.get((i, j), 0.0) for j in range(dim)] for i in range(dim)]) / n - np.outer(mean, mean)
    _, v = np.linalg.eigh((cov + cov.T) / 2)
    return mean, v[:, ::-1][:, :axes]


def _keys(dim: int, mean: np.ndarray, axes: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            p = (units(batch.column(2).to_pylist(), dim) - mean) @ axes
            cell = np.floor(p[:, :CELLS] / eps).astype(np.int64)
            cell = np.pad(cell, ((0, 0), (0, CELLS - cell.shape[1])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              *[pa.array(cell[:, k]) for k in range(CELLS)], pa.array(np.ascontiguousarray(p[:, 0]))],
                                             names=["rep", "n", "vec", *[f"c{k}" for k in range(CELLS)], "p"])
    return run


_STORED = ["ids", "counts", "vecs", "width"]


def _row(ids, counts, vecs: list[bytes], dim: int, mean: np.ndarray, axes: np.ndarray, lead: list, lead_names: list[str]):
    """One row of vectors in order: ids and class sizes as int64, components of one width, the box of their projections."""
    wide = any(len(v) == 8 * dim for v in vecs)
    if wide:
        vecs = [v if len(v) == 8 * dim else np.frombuffer(v, "<f4").astype("<f8").tobytes() for v in vecs]
    p = (units(vecs, dim) - mean) @ axes
    return pa.RecordBatch.from_arrays([
        *lead, pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([np.array(counts, np.int64).tobytes()], pa.binary()),
        pa.array([b"".join(vecs)], pa.binary()), pa.array([8 if wide else 4], pa.int32()),
        *[pa.array([float(v)]) for v in p.min(axis=0)], *[pa.array([float(v)]) for v in p.max(axis=0)]],
        names=[*lead_names, *_STORED, *[f"lo{i}" for i in range(axes.shape[1])], *[f"hi{i}" for i in range(axes.shape[1])]])


def _blocks(dim: int, mean: np.ndarray, axes: np.ndarray, size: int):
    """Cut a sorted partition into pieces of at most `size` vectors: partition, first position, and the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at, held = TaskContext.get().partitionId(), 0, []

        def piece(rows):
            ids, counts, vecs = zip(*rows)
            return _row(ids, counts, list(vecs), dim, mean, axes, [pa.array([pid], pa.int32()), pa.array([at], pa.int64()), pa.array([len(rows)], pa.int64())],
                        ["pid", "at", "m"])

        for batch in batches:
            held += list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
            while len(held) >= size:
                yield piece(held[:size])
                held, at = held[size:], at + size
        if held:
            yield piece(held)
    return run


def _gathered(dim: int, mean: np.ndarray, axes: np.ndarray):
    """Pieces sorted by interval and position -> one row an interval."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, ids, counts, vecs = None, [], [], []

        def whole():
            return _row(np.concatenate(ids), np.concatenate(counts), vecs, dim, mean, axes, [pa.array([idx], pa.int64())], ["idx"])

        for batch in batches:
            for r in range(len(batch)):
                i, *raw, width = [batch.column(c)[r].as_py() for c in range(5)]
                if i != idx:
                    if idx is not None:
                        yield whole()
                    idx, ids, counts, vecs = i, [], [], []
                ids.append(np.frombuffer(raw[0], np.int64))
                counts.append(np.frombuffer(raw[1], np.int64))
                vecs += [raw[2][k:k + width * dim] for k in range(0, len(raw[2]), width * dim)]
        if idx is not None:
            yield whole()
    return run


def _apart(k: int, eps: float):
    """Squared distance of the boxes of i and j is at most eps^2 (a hair more, for rounding)."""
    gaps = [F.greatest(F.lit(0.0), F.col(f"jlo{a}") - F.col(f"ihi{a}"), F.col(f"ilo{a}") - F.col(f"jhi{a}")) for a in range(k)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= eps * eps + 1e-9


def _pairs(boxes: DataFrame, blocks: int, k: int, eps: float) -> DataFrame:
    """Pairs (i <= j) of blocks whose boxes are not provably distant, by recursion over intervals of the order."""
    levels, span = [boxes], 1
    while span < blocks:
        span *= FAN
        levels.append(levels[-1].groupBy(F.floor(F.col("idx") / FAN).cast("long").alias("idx")).agg(
            *[F.min(f"lo{a}").alias(f"lo{a}") for a in range(k)], *[F.max(f"hi{a}").alias(f"hi{a}") for a in range(k)]))
    level = levels.pop()
    pairs = level.select(F.col("idx").alias("i"), F.col("idx").alias("j"))     # the root: one interval, with itself
    child = F.sequence(F.lit(0), F.lit(FAN - 1))
    while levels:
        level = levels.pop()
        pairs = pairs.select((F.col("i") * FAN).alias("i"), F.explode(F.transform(child, lambda x: F.col("j") * FAN + x)).alias("j"))
        pairs = pairs.select(F.explode(F.transform(child, lambda x: F.col("i") + x)).alias("i"), "j").where("i <= j")
        a = level.select(F.col("idx").alias("i"), *[F.col(c).alias(f"i{c}") for c in level.columns if c != "idx"])
        b = level.select(F.col("idx").alias("j"), *[F.col(c).alias(f"j{c}") for c in level.columns if c != "idx"])
        pairs = pairs.join(a, "i").join(b, "j").where(_apart(k, eps)).select("i", "j")
    return pairs


def boxes(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = (x - mean) @ axes
    cuts = np.arange(0, len(x), SUB)
    return np.minimum.reduceat(p, cuts), np.maximum.reduceat(p, cuts)


def close_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with x[i] . y[j] >= cosine, for unit vectors and orthonormal axes.

    x . y is at most the product on the axes plus the product of the lengths outside them: one narrow product in
    single precision, loosened for its rounding, leaves few pairs, which are then computed in double precision."""
    def narrow(u):
        a = u @ axes
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", a, a)))
        return np.concatenate([a, rest[:, None]], axis=1).astype(np.float32)

    if axes.shape[1] < x.shape[1]:
        i, j = np.nonzero(narrow(x) @ narrow(y).T >= np.float32(cosine - 1e-4))
    else:
        i, j = np.nonzero(x @ y.T >= cosine - 1e-9)
    if len(i) > len(x) * len(y) // 32:                     # many: a whole product is cheaper than their gathering
        return np.nonzero(x @ y.T >= cosine)
    keep = np.zeros(len(i), bool)
    for lo in range(0, len(i), 1 << 15):
        part = slice(lo, lo + (1 << 15))
        keep[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= cosine
    return i[keep], j[keep]


def _verify(dim: int, mean: np.ndarray, axes: np.ndarray, cosine: float, eps: float):
    """Link counts (id, n, null) and forest edges (u, null, v) of pairs of intervals."""
    lead = axes[:, :min(AXES, dim)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                same = batch.column(0)[r].as_py() == batch.column(1)[r].as_py()
                raw = [batch.column(c)[r].as_py() for c in range(2, 10)]
                ids, counts, x = [], [], []
                for side in ((raw[:4],) if same else (raw[:4], raw[4:])):
                    ids.append(np.frombuffer(side[0], np.int64))
                    counts.append(np.frombuffer(side[1], np.int64))
                    x.append(units([side[2][k:k + side[3] * dim] for k in range(0, len(side[2]), side[3] * dim)], dim))
                if same:
                    ids, counts, x = ids * 2, counts * 2, x * 2
                got = [np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)]
                (alo, ahi), (blo, bhi) = boxes(x[0], mean, lead), boxes(x[1], mean, lead)
                fu, fv = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for s in range(len(alo)):
                    gap = np.maximum(0.0, np.maximum(blo - ahi[s], alo[s] - bhi))
                    for t in np.flatnonzero((gap * gap).sum(axis=1) <= eps * eps + 1e-9).tolist():
                        if same and t < s:
                            continue
                        a, b = slice(s * SUB, (s + 1) * SUB), slice(t * SUB, (t + 1) * SUB)
                        i, j = close_pairs(x[0][a], x[1][b], axes, cosine)
                        i, j = i + s * SUB, j + t * SUB
                        if same:
                            up = i < j
                            i, j = i[up], j[up]
                        if not len(i):
                            continue
                        np.add.at(got[0], i, counts[1][j])
                        np.add.at(got[0] if same else got[1], j, counts[0][i])
                        fu, fv = forest(np.concatenate([fu, ids[0][i]]), np.concatenate([fv, ids[1][j]]))
                for side in range(1 if same else 2):
                    hit = np.flatnonzero(got[side])
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[side][hit]), pa.array(got[side][hit]), pa.nulls(len(hit), pa.int64())],
                                                         names=["id", "n", "other"])
                if len(fu):
                    yield pa.RecordBatch.from_arrays([pa.array(fu), pa.nulls(len(fu), pa.int64()), pa.array(fv)], names=["id", "n", "other"])
    return run


def intervals(classes: DataFrame, dim: int, mean: np.ndarray, lead: np.ndarray, eps: float, size: int) -> tuple[DataFrame, int]:
    """(intervals of about `size` vectors in epsilon grid order, with their boxes; how many): idx, the stored vectors, lo*, hi*."""
    k = lead.shape[1]
    keyed = classes.select("rep", "n", "vec").mapInArrow(
        _keys(dim, mean, lead, eps), "rep long, n long, vec binary, " + ", ".join(f"c{i} long" for i in range(CELLS)) + ", p double")
    order = [f"c{i}" for i in range(CELLS)] + ["p", "rep"]
    spark = classes.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    box = ", ".join(f"{s}{i} double" for s in ("lo", "hi") for i in range(k))
    stored = "ids binary, counts binary, vecs binary, width int"
    pieces = materialise(keyed.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(
        tidy(_blocks(dim, mean, lead, max(1, size // 4))), f"pid int, at long, m long, {stored}, {box}"), "pieces")
    sizes = pieces.groupBy("pid").agg(F.sum("m").alias("m")).orderBy("pid").collect()     # one row per partition
    base, total = [], 0
    for r in sizes:
        base.append((r["pid"], total))
        total += r["m"]
    first = spark.createDataFrame(base, "pid int, base long")
    placed = pieces.join(F.broadcast(first), "pid").withColumn("idx", F.floor((F.col("base") + F.col("at")) / size).cast("long"))
    made = placed.repartition("idx").sortWithinPartitions("idx", "pid", "at").select("idx", *_STORED).mapInArrow(
        tidy(_gathered(dim, mean, lead)), f"idx long, {stored}, {box}")
    return materialise(made, "intervals"), -(-total // size)


def _found(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Counts and edges among the class representatives of one length."""
    eps = math.sqrt(max(0.0, 2.0 - 2.0 * cosine))
    mean, axes = principal_axes(classes, dim, min(BOUND, dim))
    lead = axes[:, :min(AXES, dim)]
    numbered, n = intervals(classes, dim, mean, lead, eps, max(64, INTERVAL_BYTES // (8 * dim)))
    pairs = _pairs(numbered.select("idx", *[f"{s}{i}" for s in ("lo", "hi") for i in range(lead.shape[1])]), n, lead.shape[1], eps)
    # pairs are turned so that every interval is the second one equally often: the last join is dealt by it
    odd = (F.col("i") + F.col("j")) % 2 == 1
    pairs = pairs.select(F.when(odd, F.col("j")).otherwise(F.col("i")).alias("i"), F.when(odd, F.col("i")).otherwise(F.col("j")).alias("j"))
    pairs = pairs.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "i", "j")
    a = numbered.select(F.col("idx").alias("i"), *[F.col(c).alias(f"{c}_a") for c in _STORED])
    b = numbered.select(F.col("idx").alias("j"), *[F.col(c).alias(f"{c}_b") for c in _STORED])
    # an interval with itself needs its vectors once
    tasks = pairs.join(a, "i").join(b, "j").select("i", "j", *[f"{c}_a" for c in _STORED],
                                                   *[F.when(F.col("i") != F.col("j"), F.col(f"{c}_b")).alias(f"{c}_b") for c in _STORED])
    return tasks.mapInArrow(tidy(_verify(dim, mean, axes, cosine, eps)), "id long, n long, other long")


def link_classes(embeddings: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per vector: id, n_links (other vectors with this cosine or more), component_id and kept."""
    rows = materialise(embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
                       .mapInArrow(tidy(_parse), "id long, digest binary, dim int, vec binary"), "vectors")
    classes = materialise(rows.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("dim").alias("dim"), F.min("vec").alias("vec")), "classes")
    dims = [r["d"] for r in classes.groupBy(F.col("dim").alias("d")).count().orderBy("d").collect()]
    found = None
    for d in dims:                                         # one per vector length that occurs
        part = _found(classes.where(F.col("dim") == d), d, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = materialise(found, "links")
    linked = components(found.where("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v")))
    counts = found.where("n is not null").groupBy(F.col("id").alias("cid")).agg(F.sum("n").alias("c"))
    named = (classes.select(F.col("digest").alias("g"), "rep", "n").join(counts, F.col("rep") == F.col("cid"), "left")
             .join(linked, F.col("rep") == F.col("node"), "left")
             .select("g", (F.coalesce("c", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.select("id", "digest").join(named, F.col("digest") == F.col("g"), "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)
