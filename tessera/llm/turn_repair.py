"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is right if the initials of its roles read (s?(ua)+)?.  Rows are kept, given another role, or deleted,
and empty rows are inserted, at least cost; among the cheapest repairs the one whose audit (the initials of its
edits, D < I < K < R) comes first in ASCII order is taken.

Four states say what has been written: nothing, a system row, a user row, an assistant row.  A row's step is a few
inserts and one edit of the row.  No step is a prefix of another, so of two audits over the same rows the smaller one
is told by comparing step after step; a vector of four (cost, rank of the audit) is all that a pass over the rows must
carry.  Hirschberg: the forward vector of the first half and the backward vector of the second half meet in the
middle, the crossing state with the least (cost, audit) is certain, and both halves are solved apart.  Space is linear
in the rows (a byte a row).

On Spark only a skeleton of the rows moves: conversation, turn, role, digest of the text and what is wrong with it.  It is
range partitioned by conversation and turn, so that a long conversation lies in several tasks as segments.  Segments cut by
a partition's edge (two a partition at most) send their 4 x 4 matrix of (cost, rank) to the driver; matrices compose, and
the crossing states at the edges are chosen from them as they are in the middle of a segment.  Then every segment is
solved on its own.  Texts join the kept rows last.

Defined cases: null conversations are one conversation; null turns come first; null roles and texts count as one space;
rows with the same turn are ordered by role, then by the digest of their text; equal rows repeat each other; a
conversation without rows has cost 0 and an empty audit; a role without characters has no initial, so its row is illegal.
Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, remembered, tidy

SPACE = r"[^\x20\x09-\x0D]"
RETAG, DELETE, INSERT, CUT = 3, 4, 3, 3      # costs; CUT is added to a truncated row that stays
NEW, SYSTEM, USER, ASSISTANT = range(4)
_ENTER = {"s": {NEW: SYSTEM}, "u": {NEW: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NEXT = {NEW: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}         # what an insert or a new role must be
# codes: 4 * truncated + initial (0 none of them, 1 s, 2 u, 3 a); 8 must be deleted
GONE = 8
_INITIALS = " sua"
Vector = tuple[tuple[int, int] | None, ...]  # (cost, rank) by state, or none


def _by_steps(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """The least (cost, step) of one row from state to state; at most two inserts before its edit."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state = start
        for m in range(3):
            if m:
                state = _NEXT[state]
            ways = [(state, DELETE, "D")]
            if code != GONE:
                extra = CUT if code & 4 else 0
                kept = _ENTER.get(_INITIALS[code & 3], {}).get(state)
                if kept is not None:
                    ways.append((kept, extra, "K"))
                ways.append((_NEXT[state], RETAG + extra, "R"))
            for end, cost, edit in ways:
                step = (cost + m * INSERT, "I" * m + edit)
                if (start, end) not in best or step < best[start, end]:
                    best[start, end] = step
    return best


_ORDER = {step: i for i, step in enumerate(sorted("I" * m + e for m, e in product(range(3), "DKR")))}


@remembered(16)
def _steps(code: int) -> tuple[tuple[int, int, int, int, str], ...]:
    return tuple((a, b, cost, _ORDER[step], step) for (a, b), (cost, step) in sorted(_by_steps(code).items()))


def _ranked(keys: list[tuple | None]) -> Vector:
    """(cost, rank) from (cost, anything comparable): ranks are dense, and equal only for equal audits."""
    ranks = {k: i for i, k in enumerate(sorted({k[1:] for k in keys if k is not None}))}
    return tuple(None if k is None else (k[0], ranks[k[1:]]) for k in keys)


@remembered(1 << 16)
def _forward(vector: Vector, code: int) -> Vector:
    """Vectors of 4 states, or of 4 start states x 4 states."""
    out: list[tuple | None] = [None] * len(vector)
    for base in range(0, len(vector), 4):
        for a, b, cost, order, _ in _steps(code):
            v = vector[base + a]
            if v is not None:
                key = (v[0] + cost, v[1], order)
                if out[base + b] is None or key < out[base + b]:
                    out[base + b] = key
    return _ranked(out)


@remembered(1 << 16)
def _backward(vector: Vector, code: int) -> Vector:
    out: list[tuple | None] = [None] * 4
    for a, b, cost, order, _ in _steps(code):
        v = vector[b]
        if v is not None:
            key = (v[0] + cost, order, v[1])
            if out[a] is None or key < out[a]:
                out[a] = key
    return _ranked(out)


def _less(vector: Vector) -> tuple[int, Vector]:
    """The least cost, and the vector relative to it: few relative vectors occur, so that their steps are remembered."""
    low = min(v[0] for v in vector if v is not None)
    return low, tuple(None if v is None else (v[0] - low, v[1]) for v in vector)


def _one(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


# trailing inserts: none after nothing or an assistant row, I after a user row, II after a system row
END: Vector = ((0, 0), (2 * INSERT, 2), (INSERT, 1), (0, 0))
TAIL = ("", "II", "I", "")


def sweep(codes: bytes, vector: Vector, lo: int, hi: int) -> Vector:
    """The forward vector after rows lo .. hi, up to a constant cost."""
    for i in range(lo, hi):
        vector = _forward(_less(vector)[1], codes[i])
    return vector


def sweep_back(codes: bytes, vector: Vector, lo: int, hi: int) -> Vector:
    """The backward vector before rows lo .. hi, up to a constant cost."""
    for i in range(hi - 1, lo - 1, -1):
        vector = _backward(_less(vector)[1], codes[i])
    return vector


def crossing(ahead: Vector, behind: Vector) -> int:
    """The state in which the cheapest repair with the least audit passes from the first rows to the rest."""
    return min((a[0] + b[0], a[1], b[1], s) for s, (a, b) in enumerate(zip(ahead, behind)) if a is not None and b is not None)[3]


def solve(codes: bytes, start: int, end: Vector) -> tuple[list[str], list[int], int]:
    """(steps, states after each row, cost without what `end` adds) of the best repair from state `start`; `end` is
    the backward vector behind the last row."""
    steps, states, cost = [""] * len(codes), [start] * len(codes), 0
    todo = [(0, len(codes), start, end)] if codes else []
    while todo:                                            # a stack instead of recursion
        lo, hi, first, last = todo.pop()
        if hi - lo == 1:
            best = min((c + last[b][0], o, last[b][1], b, c, step) for a, b, c, o, step in _steps(codes[lo])
                       if a == first and last[b] is not None)
            steps[lo], states[lo], cost = best[5], best[3], cost + best[4]
            continue
        mid = (lo + hi) // 2
        state = crossing(sweep(codes, _one(first), lo, mid), sweep_back(codes, last, mid, hi))
        todo.append((mid, hi, state, last))
        todo.append((lo, mid, first, _one(state)))
    return steps, states, cost


def matrix(codes: bytes) -> list[list[int] | None]:
    """16 (cost, rank): from each state to each state over all rows, ranks comparable among all of them."""
    vector: Vector = tuple((0, 0) if a == b else None for a in range(4) for b in range(4))
    total = 0
    for c in codes:
        low, vector = _less(vector)
        vector, total = _forward(vector, c), total + low
    return [None if v is None else [v[0] + total, v[1]] for v in vector]


def chain(matrices: list[list[list[int] | None]]) -> list[tuple[int, Vector]]:
    """For the segments of one conversation, in order: the state each is entered in, and the backward vector behind it."""
    behind = [END]
    for m in reversed(matrices[1:]):
        vector = behind[-1]
        keys = []
        for a in range(4):
            ways = [(m[4 * a + b][0] + vector[b][0], m[4 * a + b][1], vector[b][1]) for b in range(4)
                    if m[4 * a + b] is not None and vector[b] is not None]
            keys.append(min(ways) if ways else None)
        behind.append(_less(_ranked(keys))[1])
    behind.reverse()
    state, out = NEW, []
    for m, vector in zip(matrices, behind):
        out.append((state, vector))
        ways = [(m[4 * state + b][0] + vector[b][0], m[4 * state + b][1], vector[b][1], b) for b in range(4)
                if m[4 * state + b] is not None and vector[b] is not None]
        state = min(ways)[3]
    return out


# ---- on Spark ------------------------------------------------------------------------------------------------

_SEGMENT = ("key string, pid int, edge boolean, codes binary, roles array<string>, digests binary, blank long, duplicate long, "
            "truncated long, illegal long, head string, tail string, matrix string")


def skeleton(rows: DataFrame) -> DataFrame:
    """key, turn, role, digest, blank, cut, met_before: what decides, without the texts.  `rows` has key, turn, role, text."""
    slim = rows.select("key", "turn", "role", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("digest"),
                       (~F.col("text").rlike(SPACE)).alias("blank"),
                       (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    slim = slim.groupBy("key", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("copies"))
    first = slim.groupBy(F.col("key").alias("k"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))).alias("first"))
    same = (slim["key"] == first["k"]) & (slim["role"] == first["r"]) & (slim["digest"] == first["d"])
    return slim.join(first, same).select(
        "key", "turn", "role", "digest", "blank", "cut", "copies", (~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("met_before"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one conversation in a sorted partition, as codes; the first and the last run may go on elsewhere."""
    pid, key, done = TaskContext.get().partitionId(), None, 0
    codes, roles, digests, count, illegal = bytearray(), [], [], [0, 0, 0, 0], 0

    def segment(edge: bool):
        m = json.dumps(matrix(bytes(codes))) if edge else None
        row = [key, pid, edge, bytes(codes), roles, b"".join(digests), count[1], count[2], count[3], illegal, roles[0][:1], roles[-1][:1], m]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)

    for batch in batches:
        for k, role, digest, blank, cut, copies, before in zip(*[batch.column(i).to_pylist() for i in range(7)]):
            if k != key:
                if key is not None:
                    yield segment(done == 0)
                    done += 1
                key, codes, roles, digests, count, illegal = k, bytearray(), [], [], [0, 0, 0, 0], 0
            initial = role[:1]
            for copy in range(copies):
                fault = 1 if blank else 2 if before or copy else 3 if cut else 0
                count[fault] += 1
                codes.append(GONE if fault in (1, 2) else 4 * (fault == 3) + max(0, _INITIALS.find(initial or " ")))
                if roles and roles[-1][:1] + initial not in ("su", "ua", "au"):
                    illegal += 1
                roles.append(role)
                digests.append(digest)
    if key is not None:
        yield segment(True)


_NAMES = ["key", "pid", "edge", "codes", "roles", "digests", "blank", "duplicate", "truncated", "illegal", "head", "tail", "matrix"]
_TYPES = [pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
          pa.string(), pa.string(), pa.string()]


def _solved(states: dict[tuple[str, int], tuple[int, Vector, bool]]):
    """Solve each segment; rows of edits, and one row (edit null) for its audit and cost."""
    names = ["key", "pid", "at", "edit", "role", "digest", "was", "audit", "cost"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.int64()]
    said = {USER: "user", ASSISTANT: "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        rows = []
        for batch in batches:
            for r in batch.to_pylist():
                key, pid, roles, digests = r["key"], r["pid"], r["roles"], r["digests"]
                state, end, last = states.get((key, pid), (NEW, END, True))
                steps, after, cost = solve(r["codes"], state, end)
                at, audit = 0, []
                for i, (step, now) in enumerate(zip(steps, after)):
                    audit.append(step)
                    for _ in step[:-1]:
                        state = _NEXT[state]
                        rows.append((key, pid, at, "I", said[state], None, None, None, None))
                        at += 1
                    edit = step[-1]
                    role = None if edit == "D" else roles[i] if edit == "K" else said[now]
                    rows.append((key, pid, at, edit, role, digests[16 * i:16 * i + 16], roles[i], None, None))
                    at, state = at + 1, now
                    if len(rows) >= 8192:
                        yield out()
                        rows = []
                if last:
                    for _ in TAIL[state]:
                        audit.append("I")
                        cost += INSERT
                        state = _NEXT[state]
                        rows.append((key, pid, at, "I", said[state], None, None, None, None))
                        at += 1
                rows.append((key, pid, at, None, None, None, None, "".join(audit), cost))
        if rows:
            yield out()
    return run


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(edits, conversations) of the cheapest repairs.

    edits: id, pid, at (together the order of the edits), edit (D, I, K or R), role (of the repaired row; null: deleted) and text.
    conversations: id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    spark = turns.sparkSession
    kind = turns.schema[id_col].dataType.simpleString()
    space = F.lit(" ")
    rows = turns.select(F.to_json(F.struct(F.col(f"`{id_col}`").alias("id"))).alias("key"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`").cast("string"), space).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), space).alias("text"))
    order = [F.asc("key"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = skeleton(rows).repartitionByRange(width, *order).sortWithinPartitions(*order)
    cuts = materialise(ranged.select("key", "role", "digest", "blank", "cut", "copies", "met_before").mapInArrow(tidy(_segments), _SEGMENT), "segments")

    met: dict[str, list] = {}                              # runs at a partition's edge: two rows a partition at most
    for r in cuts.where("edge").orderBy("key", "pid").select("key", "pid", "head", "tail", "matrix").collect():
        met.setdefault(r["key"], []).append(r)
    states, seams = {}, []
    for key, runs in met.items():
        for i, (r, (state, end)) in enumerate(zip(runs, chain([json.loads(r["matrix"]) for r in runs]))):
            states[key, r["pid"]] = (state, end, i == len(runs) - 1)
        broken = sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(runs, runs[1:]))
        if broken:
            seams.append((key, broken))
    done = materialise(cuts.select("key", "pid", "codes", "roles", "digests").mapInArrow(
        tidy(_solved(states)), "key string, pid int, at long, edit string, role string, digest binary, was string, audit string, cost long"), "edits")

    back = F.from_json("key", f"id {kind}")["id"].alias(id_col)
    once = rows.select("key", "role", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16).alias("digest"), "text")
    once = once.groupBy("key", "role", "digest").agg(F.first("text").alias("text"))            # equal texts
    stays = done.where("edit in ('K', 'R')")
    kept = stays.join(once.select(F.col("key").alias("k"), F.col("role").alias("w"), F.col("digest").alias("d"), "text"),
                      (F.col("key") == F.col("k")) & (F.col("was") == F.col("w")) & (F.col("digest") == F.col("d")), "left")
    cols = ["key", back, "pid", "at", "edit", "role", "text"]
    edits = kept.select(*cols).unionByName(done.where("edit in ('I', 'D')").withColumn("text", F.when(F.col("edit") == "I", "")).select(*cols))

    seam = spark.createDataFrame(seams, "key string, broken long")
    faults = cuts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    audits = done.where("edit is null").groupBy("key").agg(
        F.sum("cost").alias("cost"), F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("pid", "audit"))), lambda x: x["audit"])).alias("audit"))
    spans = (rows.groupBy("key", "turn").agg(F.lit(1).alias("one")).groupBy("key")
             .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")))
    met_all = spans.join(faults, "key").join(audits, "key").join(seam, "key", "left")
    conversations = met_all.select("key", back, F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                                   (F.col("illegal") + F.coalesce("broken", F.lit(0))).alias("illegal"), "cost", "audit")
    return edits, conversations


def digest(edits: DataFrame) -> DataFrame:
    """key, repaired_sha256: of the repaired `role:text` lines of each conversation, in order, as a stream."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = None, None
        for batch in batches:
            out = []
            for k, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if k != key:
                    if key is not None:
                        out.append((key, whole.hexdigest()))
                    key, whole, lead = k, hashlib.sha256(), ""
                whole.update(f"{lead}{role}:{text}".encode())
                lead = "\n"
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["key", "repaired_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (key, whole.hexdigest())], names=["key", "repaired_sha256"])

    rows = edits.where("role is not null").repartition("key").sortWithinPartitions("key", "pid", "at").select("key", "role", "text")
    return rows.mapInArrow(tidy(run), "key string, repaired_sha256 string")


def damage(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Faults by crc32 of `conv:turn` modulo 20: 0 dropped, 1 no text, 2 no full stops, 3 twice, 4 the user's (nulls: one space)."""
    def said(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = turns.select(F.col(f"`{id_col}`").alias(id_col), "turn", said("role").alias("role"), said("text").alias("text"),
                        (F.crc32(F.concat(said(f"`{id_col}`"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("fault"))
    hurt = rows.where("fault <> 0").select(
        id_col, "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return hurt.drop("copy")


def report(turns: DataFrame, damaged: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation of `turns`: the repair of its rows in `damaged`, with the digest of the repaired rows."""
    edits, found = repair(damaged, id_col)
    every = turns.select(F.to_json(F.struct(F.col(f"`{id_col}`").alias("id"))).alias("key"), F.col(f"`{id_col}`").alias(id_col)).dropDuplicates(["key"])
    joined = every.join(found.drop(id_col), "key", "left").join(digest(edits), "key", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(id_col, *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


__all__ = ["chain", "damage", "digest", "matrix", "repair", "report", "solve"]
