"""Connected components of an edge list, by alternating large-star and small-star rounds.

Every round is a grouped minimum (combined before the shuffle) and an equi-join on the node.  Hub
nodes -- those with more than a thousandth of all edges, so two thousand at most -- are met by a
broadcast of that bounded table, and their edges are not gathered in one task; the other edges are
shuffled.  Rounds are written to the shared folder, so lineage stays short.  Nothing but two
checksums per round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise


HUBS = 1000        # a node with more than one HUBS-th of the edges is a hub: at most 2 * HUBS nodes


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges as (node, smallest node of its tree), nodes that are roots left out."""
    if not len(u):
        return u, v
    nodes, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = code[:len(u)], code[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    move = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[move], nodes[label[move]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a partition by a spanning forest, batch by batch."""
    u = v = np.zeros(0, np.int64)
    for batch in batches:
        u, v = forest(np.concatenate([u, batch.column(0).to_numpy()]), np.concatenate([v, batch.column(1).to_numpy()]))
        if len(u) > 1 << 21:
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
            u = v = np.zeros(0, np.int64)
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _star(edges: DataFrame, large: bool, limit: int) -> DataFrame:
    """One star operation: hang a node's larger (large) or all smaller (small) neighbours on the smallest one.

    Nodes with more than `limit` edge ends are hubs.
    """
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = sides.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"), F.count("*").alias("ends"))
    low = low.select("n", F.least("n", "m").alias("m"), "ends")
    hubs = low.where(F.col("ends") > limit).drop("ends")
    at = F.col("u") == F.col("n")
    met = sides.join(F.broadcast(hubs), at).unionByName(
        sides.join(F.broadcast(hubs), at, "left_anti").join(low.where(F.col("ends") <= limit).drop("ends"), at))
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, rounds: int = 64, hubs: int = HUBS) -> DataFrame:
    """(node, component) of every node on an edge (u, v: long, not null): the smallest node it can reach."""
    now = materialise(edges.select("u", "v").mapInArrow(_local, "u long, v long"), "cc")
    seen, size = None, now.count()
    for _ in range(rounds):
        # the large star makes one edge of each, so `size` bounds the edges of both steps
        new = materialise(_star(_star(now, True, size // hubs), False, size // hubs), "cc")
        # in a finished star every edge is (node, root): the checksums then repeat
        mark = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(now)
        now = new
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen, size = mark, mark[0]
    raise RuntimeError(f"components did not settle in {rounds} rounds")
