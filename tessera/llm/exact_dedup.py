"""Exact deduplication as a Grace hash job.

Level 0 is Spark's: every map task collapses the equal texts of its own partition (a
combiner, so a text held by a third of all rows crosses the shuffle at most once per map
task) and the rest is hash-partitioned by content.  Inside a reduce task the Grace scheme
goes on: records that exceed the memory budget are partitioned by further hash bits into
spill files, recursively, until a bucket fits an open-addressing table, which compares
complete contents.  The spill files are the task's own (unlinked when opened, as Spark's
own spills; nothing else ever reads them).

Defined cases: null text counts as empty, so all null and empty texts are one group; a null id
loses to any other; rows that repeat both the kept id and the text all show kept = true in
`classes`, while `survivors` returns exactly one of them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import tidy

MEMORY_BYTES = 64 << 20      # content held by one open-addressing table
FANOUT = 16                  # spill files per level of recursion
NO_ID = -(1 << 63)           # stands for a null id in the table: it loses to every other id


class ContentTable:
    """Open addressing (linear probing) from a 64-bit hash to a record, equal only if the whole content is."""

    def __init__(self) -> None:
        self.mask = (1 << 10) - 1
        self.slots = [-1] * (self.mask + 1)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.records: list = []
        self.size = 0

    def find(self, h: int, content: bytes) -> int:
        """Index of the record with this content, or -1 - slot where it belongs."""
        slot = h & self.mask
        while (i := self.slots[slot]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i
            slot = (slot + 1) & self.mask
        return -1 - slot

    def add(self, slot: int, h: int, content: bytes, record) -> None:
        self.slots[slot] = len(self.records)
        self.hashes.append(h)
        self.contents.append(content)
        self.records.append(record)
        self.size += len(content) + 200
        if 3 * len(self.records) > 2 * self.mask:
            self.mask = 4 * self.mask + 3
            self.slots = [-1] * (self.mask + 1)
            for i, g in enumerate(self.hashes):
                s = g & self.mask
                while self.slots[s] >= 0:
                    s = (s + 1) & self.mask
                self.slots[s] = i


def _merge(old: list, new: list) -> None:
    """Records are [keep_id, group_size, payload]; the larger id and its payload stay."""
    old[1] += new[1]
    if new[0] > old[0]:
        old[0], old[2] = new[0], new[2]


def _bits(digest: bytes, level: int) -> int:
    """The hash of one level: bytes of the digest that no level before has used (rehashed when they run out)."""
    if level >= 3:
        digest = hashlib.sha256(digest + bytes([level & 255])).digest()
        level = 0
    return int.from_bytes(digest[8 * level:8 * level + 8], "little")


def grace(records: Iterator[tuple[bytes, bytes, list]], level: int = 0,
          memory: int = MEMORY_BYTES) -> Iterator[tuple[bytes, bytes, list]]:
    """Group (digest, content, record) by complete content.

    Records go into the table until it holds `memory` bytes.  From then on a record whose content
    the table has merges there, and any other goes to one of FANOUT spill files, which are treated
    the same way with the next hash bits once the table has been emitted.
    """
    import pickle

    table, files, digests = ContentTable(), None, []
    for digest, content, record in records:
        h = _bits(digest, level)
        at = table.find(h, content)
        if at >= 0:
            _merge(table.records[at], record)
        elif table.size < memory or not table.records:
            table.add(-1 - at, h, content, record)
            digests.append(digest)
        else:
            if files is None:
                files = [tempfile.TemporaryFile() for _ in range(FANOUT)]
            pickle.dump((digest, content, record), files[(h >> 48) % FANOUT], protocol=5)
    yield from zip(digests, table.contents, table.records)
    del table, digests

    def again(f):
        f.seek(0)
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return

    for f in files or ():
        yield from grace(again(f), level + 1, memory)
        f.close()


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += 100 + sum(len(v) for v in r if isinstance(v, (bytes, str)))
        if size >= limit or len(out) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


_TYPES = "digest binary, content binary, keep_id long, group_size long"


def _schema(payload: pa.DataType | None) -> pa.Schema:
    fields = [("digest", pa.binary()), ("content", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())]
    return pa.schema(fields + ([("payload", payload)] if payload is not None else []))


def _combiner(memory: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = None

        def flush(table, digests):
            rows = ((d, c, None if r[0] == NO_ID else r[0], r[1], *r[2:][:payload is not None])
                    for d, c, r in zip(digests, table.contents, table.records))
            return _batches(rows, _schema(payload))

        table, digests = ContentTable(), []
        for batch in batches:
            has = "payload" in batch.schema.names
            payload = batch.schema.field("payload").type if has else None
            ids, contents = batch.column(0).to_pylist(), batch.column(1)
            loads = batch.column(2).to_pylist() if has else None
            for i, doc in enumerate(ids):
                content = contents[i].as_py() or b""
                digest = hashlib.sha256(content).digest()
                record = [NO_ID if doc is None else doc, 1, loads[i] if has else None]
                h = _bits(digest, 0)
                at = table.find(h, content)
                if at >= 0:
                    _merge(table.records[at], record)
                    continue
                table.add(-1 - at, h, content, record)
                digests.append(digest)
                if table.size > memory:
                    yield from flush(table, digests)
                    table, digests = ContentTable(), []
        yield from flush(table, digests)
    return run


def _reducer(memory: int, with_content: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = None

        def records():
            nonlocal payload
            for batch in batches:
                has = "payload" in batch.schema.names
                payload = batch.schema.field("payload").type if has else None
                cols = [batch.column(i).to_pylist() for i in (0, 2, 3)]
                loads = batch.column(4).to_pylist() if has else None
                contents = batch.column(1)
                for i, (d, k, n) in enumerate(zip(*cols)):
                    yield d, contents[i].as_py(), [NO_ID if k is None else k, n, loads[i] if has else None]

        out = grace(records(), 0, memory)
        first = next(out, None)
        if first is None:
            return

        def rows():
            item = first
            while item is not None:
                d, c, r = item
                keep = None if r[0] == NO_ID else r[0]
                yield (d, c, keep, r[1], r[2]) if payload is not None else (
                    (d, c, keep, r[1]) if with_content else (d, keep, r[1]))
                item = next(out, None)

        schema = _schema(payload)
        if payload is None and not with_content:
            schema = pa.schema([f for f in schema if f.name != "content"])
        yield from _batches(rows(), schema)
    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", payload: list[str] | None = None,
           memory: int = MEMORY_BYTES) -> DataFrame:
    """One row per distinct text: digest (sha-256), keep_id (largest id), group_size, and - if asked - the
    kept row's `payload` columns as a struct, with the content."""
    cols = [F.col(f"`{id_col}`").cast("long").alias("id"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("content")]
    types, out_types = T.StructType.fromDDL(_TYPES), T.StructType.fromDDL("digest binary, keep_id long, group_size long")
    if payload is not None:
        cols.append(F.struct(*[F.col(f"`{c}`").alias(f"p{i}") for i, c in enumerate(payload)],
                             F.col(f"`{text_col}`").isNull().alias("no_text")).alias("payload"))
        types = out_types = T.StructType([*types.fields, docs.select(*cols).schema["payload"]])
    local = docs.select(*cols).mapInArrow(tidy(_combiner(memory)), types)
    return local.repartition(F.col("digest")).mapInArrow(tidy(_reducer(memory, payload is not None)), out_types)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY_BYTES) -> DataFrame:
    """Per document: its id, keep_id, group_size, kept and the digest of its text.

    The per-document rows never pass the hash buckets: they carry (id, digest) only and meet the
    groups in an equi-join, whose large keys AQE splits (one group row per key on the other side).
    """
    found = groups(docs, id_col, text_col, memory=memory).withColumnRenamed("digest", "g")
    rows = docs.select(F.col(id_col).alias("__t_id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"))
    return rows.join(found, rows["digest"] == found["g"]).select(
        F.col("__t_id").alias(id_col), "keep_id", "group_size",
        F.col("__t_id").cast("long").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY_BYTES) -> DataFrame:
    """The kept row of every group, with all columns of `docs` in their order; exactly one row per distinct text."""
    rest = [c for c in docs.columns if c != text_col]
    kept = groups(docs, id_col, text_col, payload=rest, memory=memory)
    text = F.when(~F.col("payload.no_text"), F.col("content").cast("string"))
    return kept.select(*[(text if c == text_col else F.col(f"payload.p{rest.index(c)}")).cast(docs.schema[c].dataType).alias(c)
                         for c in docs.columns])
