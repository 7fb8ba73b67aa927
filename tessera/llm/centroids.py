"""Centroid clustering with geometrically tightened drift bounds.

Every vector keeps its cluster, the distance to its own centroid (upper bound) and a lower bound on the
distance to any other one.  When the centroids move, the lower bound of a vector must shrink by as much
as any other centroid can have come nearer to it.  The full drift of a centroid is the coarse answer.
Here all vectors of a cluster are known to lie in a sphere around its old centroid, and the plane through
the sphere's centre and the two positions of the moved centroid tells more: points that the move brings
nearer by more than s lie inside one branch of the hyperbola with these positions as foci, which lies inside its
asymptotic cone.  If the sphere misses that cone, no vector of the cluster loses more than s (`loosening`).
A vector whose own distance stays under its loosened lower bound, or under half the way to the nearest other
centroid, keeps its cluster; the others are ambiguous and are compared with all centroids exactly.

Vectors are packed into blocks once, as integers; a round reads the blocks of the round before it and
writes new ones (no shuffle of vectors, every round is durable).  Beside each block stand the sums of the
vectors that changed their cluster, and the largest own distance per cluster; their aggregates (centroids x
components) are all that reaches the driver.  Decisions use exact integer distances; bounds only ever save work,
and are kept a hair loose for rounding.

Defined cases: kept vectors have exactly `dim` components, none null or non-finite, and no scaled component beyond
2^53; other rows are left out.  Fewer vectors than k: as many clusters as vectors.  No vectors: no rows.  Repeated
rows are vectors of their own; equal ids order by their components as first centroids, null ids come last.
A distance or sum beyond the range of long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import discard, materialise, tidy

SCALE = 256
BLOCK = 4096                 # vectors of a block
EXACT = 1 << 22              # components up to this size: sums of squares are exact in doubles (up to 128 components)
LARGEST = float(1 << 53)
HAIR = 1e-9                  # relative slack of the bounds

_STATS = "stats array<struct<cluster: int, n: long, radius: double, inertia: decimal(38,0), moved: array<decimal(38,0)>>>"


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: the most by which centroid j, moving from old[j] to new[j], can come nearer to any point of
    the sphere around old[i] with radius[i]; between 0 and the drift of j."""
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    middle = (old + new) / 2
    unit = (new - old) / np.where(drift > 0, drift, 1.0)[:, None]
    way = old[:, None, :] - middle[None, :, :]                             # [i, j]: from the foci's middle to the sphere's centre
    rho = np.sqrt((way ** 2).sum(axis=2))
    along = np.einsum("ijd,jd->ij", way, unit)
    phi = np.arccos(np.clip(along / np.where(rho > 0, rho, 1.0), -1.0, 1.0))
    # the widest cone around the direction of the move that the sphere does not enter
    reach = np.arcsin(np.clip(radius[:, None] / np.where(rho > 0, rho, 1.0), 0.0, 1.0))
    theta = np.where(radius[:, None] < rho, phi - reach, 0.0)
    return drift[None, :] * np.cos(np.clip(theta, 0.0, np.pi / 2)) + HAIR * (1.0 + drift[None, :])


def _narrow(x: np.ndarray) -> tuple[str, bytes]:
    big = np.abs(x).max() if x.size else 0
    kind = "<i2" if big < 1 << 15 else "<i4" if big < 1 << 31 else "<f8"
    return kind, x.astype(kind).tobytes()


def _kept(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """(ids, scaled vectors) of the rows of a batch that count."""
    ids, lists = batch.column(0), batch.column(1)
    fit = np.flatnonzero(np.asarray(pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(lists), dim), False)))
    lists = lists.take(pa.array(fit))
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * scale)
    good = (np.abs(x) <= LARGEST).all(axis=1)                              # false for NaN (null) and infinities
    return ids.take(pa.array(fit[good])), x[good] + 0.0


def _pack(dim: int, scale: int):
    """Blocks of vectors, not yet in any cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vecs, n = [], [], 0

        def blocks(last: bool):
            nonlocal held, vecs, n
            ids, x = pa.concat_arrays(held), np.concatenate(vecs)
            at = 0
            while len(x) - at >= BLOCK or (last and at < len(x)):
                part = x[at:at + BLOCK]
                kind, raw = _narrow(part)
                one = ids.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), pa.concat_arrays([one])), pa.array([kind]),
                    pa.array([raw], pa.binary())], names=["ids", "kind", "vecs"])
                at += len(part)
            held, vecs, n = [ids.slice(at)], [x[at:]], len(x) - at

        for batch in batches:
            ids, x = _kept(batch, dim, scale)
            held.append(ids)
            vecs.append(x)
            n += len(x)
            if n >= BLOCK:
                yield from blocks(False)
        if n:
            yield from blocks(True)
    return run


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c: doubles, or Python integers where those round."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        return (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    a, b = (np.array([[int(v) for v in row] for row in m], dtype=object) for m in (x, c))
    return np.array([[((row - other) ** 2).sum() for other in b] for row in a], dtype=object).reshape(len(a), len(b))


def _own(x: np.ndarray, c: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of x to its centroid."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        return ((x - c[cluster]) ** 2).sum(axis=1)
    return np.array([sum((int(a) - int(b)) ** 2 for a, b in zip(row, c[k])) for row, k in zip(x, cluster)], dtype=object)


def assign_block(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray | None, lower: np.ndarray | None,
                 loosened: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, squared own distances, lower bounds, number of vectors scanned exactly) of one block."""
    k = len(centroids)
    if cluster is None:
        todo = np.arange(len(x))
        cluster, lower, own = np.zeros(len(x), np.int32), np.zeros(len(x)), np.zeros(len(x))
    else:
        cluster, lower = cluster.copy(), lower - loosened[cluster]
        between = np.sqrt(_squares(centroids, centroids).astype(np.float64))
        np.fill_diagonal(between, np.inf)
        half = between.min(axis=1)[cluster] / 2 if k > 1 else np.inf
        own = _own(x, centroids, cluster)
        safe = np.sqrt(own.astype(np.float64)) * (1 + HAIR) < np.maximum(lower, half) * (1 - HAIR)
        todo = np.flatnonzero(~safe)
    if len(todo):
        d = _squares(x[todo], centroids)
        near = d.argmin(axis=1).astype(np.int32)                           # ties: the smaller number
        cluster[todo] = near
        if d.dtype == object:
            own = own.astype(object)
        rows = np.arange(len(todo))
        own[todo] = d[rows, near]
        rest = np.sqrt(d.astype(np.float64))
        rest[rows, near] = np.inf
        lower[todo] = rest.min(axis=1) * (1 - HAIR) if k > 1 else np.inf
    return cluster, own, lower, len(todo)


def _decimal(values) -> pa.Array:
    import decimal

    return pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _round(dim: int, centroids: np.ndarray, loosened: np.ndarray | None, id_type: pa.DataType):
    """One assignment of all blocks; beside each block what changed and how far its clusters reach."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                kind = batch.column(1)[r].as_py()
                x = np.frombuffer(batch.column(2)[r].as_py(), kind).astype(np.float64).reshape(-1, dim)
                before = None
                if loosened is None:
                    cluster, own, lower, scanned = assign_block(x, centroids, None, None, None)
                else:
                    before = np.frombuffer(batch.column(3)[r].as_py(), "<i4")
                    cluster, own, lower, scanned = assign_block(x, centroids, before, np.frombuffer(batch.column(4)[r].as_py(), "<f8"), loosened)
                moved = np.flatnonzero(cluster != before) if before is not None else np.arange(len(x))
                exact = x.astype(object) if np.abs(x[moved]).max(initial=0) > EXACT else x
                change, met = {}, set(cluster.tolist())
                for rows, at, sign in ((moved, cluster, 1), *(((moved, before, -1),) if before is not None else ())):
                    for c in np.unique(at[rows]).tolist():
                        part = exact[rows[at[rows] == c]].sum(axis=0)
                        change[c] = change.get(c, 0) + sign * part
                keys = sorted(met | set(change))
                own_f = np.sqrt(own.astype(np.float64))
                n, radius, inertia = [], [], []
                for c in keys:
                    here = cluster == c
                    n.append(int(here.sum()))
                    radius.append(float(own_f[here].max()) * (1 + HAIR) if n[-1] else 0.0)
                    inertia.append(sum(map(int, own[here])))
                flat = [v for c in keys if c in change for v in change[c]]
                lens = [dim if c in change else 0 for c in keys]
                stats = pa.StructArray.from_arrays([
                    pa.array(keys, pa.int32()), pa.array(n, pa.int64()), pa.array(radius), _decimal(inertia),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), _decimal(flat))],
                    names=["cluster", "n", "radius", "inertia", "moved"])
                one = batch.slice(r, 1)
                yield pa.RecordBatch.from_arrays([
                    one.column(0), one.column(1), one.column(2), pa.array([cluster.astype("<i4").tobytes()], pa.binary()),
                    pa.array([lower.astype("<f8").tobytes()], pa.binary()), pa.array([scanned], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), stats)],
                    names=["ids", "kind", "vecs", "cluster", "lower", "scanned", "stats"])
    return run


def _report(dim: int, centroids: np.ndarray, inertia: list[int], id_type: pa.DataType, id_col: str):
    """Rows of the last assignment: id, cluster, distance, inertias and the centroid's digest."""
    def long(v: int):
        return v if v < 1 << 63 else None

    digests = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    total = long(sum(inertia))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                x = np.frombuffer(batch.column(2)[r].as_py(), batch.column(1)[r].as_py()).astype(np.float64).reshape(-1, dim)
                cluster = np.frombuffer(batch.column(3)[r].as_py(), "<i4")
                own = [long(int(v)) for v in _own(x, centroids, cluster)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(r, 1).flatten(), pa.array(cluster), pa.array(own, pa.int64()),
                    pa.array([long(inertia[c]) for c in cluster], pa.int64()), pa.array([total] * len(x), pa.int64()),
                    pa.array([digests[c] for c in cluster])],
                    names=[id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
    return run


def first_centroids(rows: DataFrame, k: int, dim: int, scale: int, seed: str) -> np.ndarray:
    """The k kept vectors with the smallest sha256 of `seed:id`, in the order of these digests."""
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) <= LARGEST))
    first = (rows.where((F.size("v") == dim) & good).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
             .alias("h"), whole.alias("x")).orderBy(F.asc_nulls_last("h"), "x").limit(k).collect())
    return np.array([r["x"] for r in first], np.float64).reshape(-1, dim) + 0.0


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = SCALE, seed: str = "2",
            id_col: str = "vec_id", vec_col: str = "embedding", log: list | None = None) -> DataFrame:
    """Per kept vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    `log`, if given, receives (vectors scanned against all centroids, vectors) for each assignment.
    """
    kind = vectors.schema[id_col].dataType
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    centroids = first_centroids(rows, k, dim, scale, seed)
    ddl = f"ids array<{kind.simpleString()}>, kind string, vecs binary"
    out = (f"`{id_col}` {kind.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    id_type = to_arrow_type(kind)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], out)
    state = materialise(rows.mapInArrow(tidy(_pack(dim, scale)), ddl), "vectors")
    sums, counts = [[0] * dim for _ in centroids], [0] * len(centroids)
    loosened = None
    for turn in range(rounds + 1):
        step = tidy(_round(dim, centroids, loosened, id_type))
        new = materialise(state.mapInArrow(step, f"{ddl}, cluster binary, lower binary, scanned long, {_STATS}"), "assigned")
        discard(state)
        state = new
        each = state.select(F.explode("stats").alias("s")).select("s.*")
        found = each.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("inertia").alias("inertia")).collect()
        if log is not None:
            total = state.agg(F.sum("scanned").alias("s"), F.sum(F.size("ids")).alias("n")).first()
            log.append((total["s"], total["n"]))
        if turn == rounds:
            break
        change = (each.select("cluster", F.posexplode("moved").alias("at", "s")).groupBy("cluster", "at")
                  .agg(F.sum("s").alias("s")).collect())                   # at most one row per centroid and component
        for r in change:
            sums[r["cluster"]][r["at"]] += int(r["s"])
        radius = np.zeros(len(centroids))
        counts = [0] * len(centroids)
        for r in found:
            counts[r["cluster"]], radius[r["cluster"]] = r["n"], r["radius"]
        moved = np.array([[float(s // n) for s in part] if n else c.tolist() for part, n, c in zip(sums, counts, centroids)])
        away = loosening(centroids, moved, radius)
        np.fill_diagonal(away, 0.0)
        loosened, centroids = away.max(axis=1), moved
    inertia = [0] * len(centroids)
    for r in found:
        inertia[r["cluster"]] = int(r["inertia"])
    return state.select("ids", "kind", "vecs", "cluster").mapInArrow(tidy(_report(dim, centroids, inertia, id_type, id_col)), out)


__all__ = ["assign_block", "cluster", "first_centroids", "loosening"]
