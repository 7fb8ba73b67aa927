"""Chat formatting over a prefix tree of conversations.

Conversations that share initial turns share a path of the tree, and the text of a shared path is
emitted once.  A turn's identity is the chained hash of all turns up to it; a node joins the
consecutive turns that the same conversations pass, so paths without a branch are one node.  A node's
path key (the ids from its root) sorts parents before children: a range-partitioned sort by it IS the
depth-first order, whatever the size of a tree.  Stream offsets are prefix sums over the sorted
partitions; of each partition only its length and the chain of nodes open at its end reach the driver.

Every node carries its position ids (positions continue from its parent's end, so they run as in each
separate conversation) and its attention: the stream intervals of its ancestors, adjacent ones merged.
The unit of positions and intervals is one character of the formatted text.

The template marks turns by control strings, which texts may contain as well: their first character
(and every backslash) is escaped, so the rendering can be read back exactly.

Defined cases: null text and null role are empty; turns are ordered by (turn, role, text), nulls first,
and repeated rows are turns of their own; a null id is one conversation; an empty table gives no
rows.  A conversation is streamed through one task (its digest and its text are sequential).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise

ASK, ASKED, SAY, SAID = "[INST] ", " [/INST]", "<s>", "</s>"
SPEAKER = "assistant"                                      # the role whose texts are trained on
_ESCAPE = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.S)


def render(role: str, text: str) -> str:
    """One formatted turn."""
    if role == SPEAKER:
        return f"{SAY}{escape(text)}{SAID}"
    return f"{ASK}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{ASKED}"


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of a formatted conversation; start and end span the escaped text."""
    at = 0
    while at < len(formatted):
        if formatted.startswith(SAY, at):
            a = at + len(SAY)
            b = formatted.index(SAID, a)
            yield SPEAKER, unescape(formatted[a:b]), a, b
            at = b + len(SAID)
        else:
            if not formatted.startswith(ASK, at):
                raise ValueError(f"no turn starts at {at}")
            head = formatted.index("\n", at)
            b = formatted.index(ASKED, head + 1)
            yield unescape(formatted[at + len(ASK):head]), unescape(formatted[head + 1:b]), head + 1, b
            at = b + len(ASKED)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted turns with their chained hash; rows come sorted by conversation and turn."""
    key, index, chain = None, 0, b""
    for batch in batches:
        out, size = [], 0
        for k, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if k != key:
                key, index, chain = k, 0, b""
            piece = render(role or "", text or "")
            chain = hashlib.sha256(chain + piece.encode("utf-8", "surrogatepass")).digest()[:16]
            out.append((k, index, chain, piece))
            index += 1
            size += len(piece)
            if size > 4 << 20:
                yield _rows(out, ["key", "idx", "h", "piece"], [pa.string(), pa.int64(), pa.binary(), pa.string()])
                out, size = [], 0
        if out:
            yield _rows(out, ["key", "idx", "h", "piece"], [pa.string(), pa.int64(), pa.binary(), pa.string()])


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


_NODE = ["key", "level", "node", "parent", "path", "position", "units", "piece", "loss"]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NODE_TYPES = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string(), _SPANS]
_SPAN_DDL = "array<struct<start: long, end: long>>"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree nodes on every conversation's path: turns that as many conversations pass are one node.

    Only the owner (the smallest conversation key on a node) emits the node's text."""
    out, size = [], 0
    key, level, path, position, run = None, 0, b"", 0, None   # run: [count, owner, last hash, pieces, units]

    def close():
        nonlocal level, path, position, size
        count, owner, last, pieces, units = run
        parent = path[-16:] or None
        path += last
        text = "".join(pieces) if owner == key else None
        loss = None
        if text is not None:
            loss = [{"start": a, "end": b} for role, _, a, b in parse(text) if role == SPEAKER]
        out.append((key, level, last, parent, path, position, units, text, loss))
        size += 200 + len(path) + (len(text) if text else 0)
        level, position = level + 1, position + units

    for batch in batches:
        for k, h, piece, count, owner in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if k != key:
                if run:
                    close()
                key, level, path, position, run = k, 0, b"", 0, None
            if run and run[0] == count:
                run[2] = h
                run[4] += len(piece)
                if owner == key:
                    run[3].append(piece)
            else:
                if run:
                    close()
                run = [count, owner, h, [piece] if owner == key else [], len(piece)]
            if size > 4 << 20:
                yield _rows(out, _NODE, _NODE_TYPES)
                out, size = [], 0
    if run:
        close()
    if out:
        yield _rows(out, _NODE, _NODE_TYPES)


_FLOW = [*_NODE[1:], "pid", "offset", "missing", "local"]
_FLOW_TYPES = [*_NODE_TYPES[1:], pa.int32(), pa.int64(), pa.int32(), _SPANS]


def _flow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Offsets inside a sorted partition, and the ancestors that lie in it; the last row is the partition's summary:
    its length (units), the path of its last node and, as `local`, the nodes open at its end."""
    pid, at, stack, last = TaskContext.get().partitionId(), 0, [], b""   # stack: (level, start, end)
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(8)]
        out, size = [], 0
        for row in zip(*cols):
            level, units = row[0], row[5]
            common = next((i for i in range(0, min(len(last), len(row[3])), 16) if last[i:i + 16] != row[3][i:i + 16]),
                          min(len(last), len(row[3]))) // 16
            while stack and stack[-1][0] >= min(level, common):
                stack.pop()
            out.append((*row, pid, at, level - len(stack), [{"start": a, "end": b} for _, a, b in stack]))
            size += 200 + len(row[6])
            stack.append((level, at, at + units))
            at, last = at + units, row[3]
            if size > 4 << 20:
                yield _rows(out, _FLOW, _FLOW_TYPES)
                out, size = [], 0
        if out:
            yield _rows(out, _FLOW, _FLOW_TYPES)
    if last:
        end = [{"start": a, "end": b} for _, a, b in stack]
        yield _rows([(-1, b"", None, last, 0, at, None, None, pid, at, len(last) // 16 - len(stack), end)], _FLOW, _FLOW_TYPES)


def _attend(inherited: dict[int, tuple[int, list[tuple[int, int]]]]):
    """Stream offsets and merged ancestor intervals, from each partition's start and inherited chain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            starts, attends = [], []
            for pid, off, missing, local in zip(d["pid"], d["offset"], d["missing"], d["local"]):
                base, chain = inherited[pid]
                spans = [*chain[:missing], *((base + s["start"], base + s["end"]) for s in local)]
                merged: list[list[int]] = []
                for a, b in spans:
                    if a == b:
                        continue
                    if merged and merged[-1][1] == a:
                        merged[-1][1] = b
                    else:
                        merged.append([a, b])
                starts.append(base + off)
                attends.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in ("node", "parent", "level", "piece", "loss", "units", "position")],
                 pa.array(starts, pa.int64()), pa.array(attends, _SPANS)],
                names=["node", "parent", "level", "text", "loss", "units", "position_start", "stream_start", "attends"])
    return run


def format_tree(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of the conversations' prefix tree.

    nodes: node, parent, level, text (formatted), loss (spans of the text under the loss mask), units (length),
    position_start (position id of its first unit), stream_start (offset in the depth-first stream) and
    attends (stream intervals of its ancestors).  paths: conversation id, level, node - one row per node on its path.
    """
    kind = turns.schema[id_col].dataType
    rows = turns.select(F.to_json(F.struct(F.col(id_col).alias("id"))).alias("key"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text").select("key", "role", "text")
    chained = materialise(ordered.mapInArrow(_turns, "key string, idx long, h binary, piece string"), "turns")
    passed = chained.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("n"), F.min("key").alias("owner"))
    met = chained.join(passed, chained["h"] == passed["g"]).select("key", "idx", "h", "piece", "n", "owner")
    walked = met.repartition("key").sortWithinPartitions("key", "idx").select("key", "h", "piece", "n", "owner").mapInArrow(
        _nodes, f"key string, level long, node binary, parent binary, path binary, position long, units long, piece string, loss {_SPAN_DDL}")
    walked = materialise(walked, "walked")
    paths = walked.select(F.from_json("key", f"id {kind.simpleString()}")["id"].alias(id_col), "key", "level", "node")

    ddl = (f"level long, node binary, parent binary, path binary, position long, units long, piece string, loss {_SPAN_DDL}, "
           f"pid int, offset long, missing int, local {_SPAN_DDL}")
    once = walked.where("piece is not null").drop("key")
    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flow = materialise(once.repartitionByRange(width, "path").sortWithinPartitions("path").mapInArrow(_flow, ddl), "flow")
    ends = flow.where("level = -1").orderBy("pid").select("pid", "path", "units", "missing", "local").collect()
    inherited, base, chain = {}, 0, []
    for e in ends:                                         # one row per partition
        inherited[e["pid"]] = (base, chain)
        own = [(base + s["start"], base + s["end"]) for s in e["local"]]
        chain, base = [*chain[:e["missing"]], *own], base + e["units"]
    nodes = flow.where("level >= 0").mapInArrow(
        _attend(inherited), f"node binary, parent binary, level long, text string, loss {_SPAN_DDL}, units long, "
                            f"position_start long, stream_start long, attends {_SPAN_DDL}")
    return nodes, paths


def read_back(nodes: DataFrame, paths: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the tree alone: its turns parsed from the concatenated node texts, with digests."""
    kind = paths.schema[id_col].dataType.simpleString()
    met = paths.join(nodes.select(F.col("node").alias("__n"), "text", "loss", "units"), paths["node"] == F.col("__n")).select(
        "key", F.col(id_col).alias("id"), "level", "text", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [met_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key, ident, turns, whole, masked, n, chars, total = None, None, 0, None, None, 0, 0, 0
        for batch in batches:
            out = []
            for k, i, text, loss in zip(*[batch.column(c).to_pylist() for c in (0, 1, 2, 3)]):
                if k != key:
                    if key is not None:
                        out.append((ident, n, whole.hexdigest(), chars, masked.hexdigest(), total))
                    key, ident, n, chars, total = k, i, 0, 0, 0
                    whole, masked = hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse(text):       # a node holds whole turns
                    whole.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in loss:
                    said = unescape(text[span["start"]:span["end"]])
                    masked.update(said.encode())
                    chars += len(said)
                total += len(text)
            if out:
                yield _rows(out, names, types)
        if key is not None:
            yield _rows([(ident, n, whole.hexdigest(), chars, masked.hexdigest(), total)], names, types)

    from pyspark.sql.pandas.types import to_arrow_type

    met_id = to_arrow_type(paths.schema[id_col].dataType)
    out = met.repartition("key").sortWithinPartitions("key", "level").select("key", "id", "text", "loss").mapInArrow(
        run, f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("id", id_col)


def probe(spark: SparkSession, text: str = "</s>[INST] ok [/INST]", conv_id: int = -1) -> DataFrame:
    """A conversation whose texts are made of control strings: a user and an assistant turn."""
    return spark.range(2).select(F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(SPEAKER).alias("role"), F.lit(text).alias("text"))
