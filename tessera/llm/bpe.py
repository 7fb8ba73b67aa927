"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs no regular expression.  Every code point gets a class from a class
array; one look-ahead by shifted comparisons marks the apostrophes that a contraction
suffix follows and the last white space of a run.  The classes drive a small automaton whose
transition functions form a finite monoid (closed once, as a composition table), so the
states at all positions come from an associative scan over blocks: compose each block's
functions, scan the block summaries, then apply.  A position starts a piece if the transition
taken there says so.  The byte slices feed a cache of merged pieces; piece offsets are kept
and returned, and decoding gathers token bytes by their offsets.

Defined cases: null text is encoded as empty (no ids, no offsets) and decodes to an empty text;
special-token strings inside a text are ordinary text.  Null ids and repeated rows are encoded like any other row; an
empty table gives no rows; texts are encoded whole, however long.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import remembered, text_slices, tidy

# code point classes
OTHER, LETTER, NUMBER, SPACE, WHITE, APOS = range(6)
# symbols: the classes above (SPACE and WHITE inside a run), then these
APOS1, APOS2, LAST_SPACE, LAST_WHITE = range(6, 10)
SYMBOLS = 10          # plus the same again for the first code point of a document
# states
BEGIN, IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, AFTER_SPACE, AFTER_WHITE, SUFFIX1, SUFFIX2 = range(9)
STATES = 9


@remembered(1)
def class_array() -> np.ndarray:
    """Class of every code point: letters (L*), numbers (N*), white space, apostrophe, anything else."""
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        k = kinds.get(unicodedata.category(chr(cp))[0])
        if k is not None:
            out[cp] = k
    # the Unicode property White_Space
    out[[*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    out[0x20] = SPACE
    out[ord("'")] = APOS
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a piece start here) of the automaton."""
    if state == SUFFIX2:                                   # two letters of a contraction to come
        return SUFFIX1, False
    if state == SUFFIX1:                                   # the last one; then whatever follows starts anew
        return BEGIN, False
    if symbol in (LAST_SPACE, LAST_WHITE):                 # the run's last: a piece of its own, or the prefix of the next
        return (AFTER_SPACE if symbol == LAST_SPACE else AFTER_WHITE), True
    if symbol in (SPACE, WHITE):
        return IN_WHITE, state != IN_WHITE
    if symbol in (APOS1, APOS2) and state not in (IN_OTHER, AFTER_SPACE):
        return (SUFFIX1 if symbol == APOS1 else SUFFIX2), True
    run = {LETTER: IN_LETTER, NUMBER: IN_NUMBER}.get(symbol, IN_OTHER)
    return run, state not in (run, AFTER_SPACE)


@remembered(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, composition table, state reached from BEGIN by element, delta, start flag)."""
    delta = np.zeros((STATES, 2 * SYMBOLS), np.uint8)
    start = np.zeros((STATES, 2 * SYMBOLS), bool)
    for s in range(STATES):
        for y in range(SYMBOLS):
            delta[s, y], start[s, y] = _step(s, y)
            delta[s, SYMBOLS + y], start[s, SYMBOLS + y] = _step(BEGIN, y)[0], True
    identity = tuple(range(STATES))
    generators = [tuple(int(v) for v in delta[:, y]) for y in range(2 * SYMBOLS)]
    elements, index, todo = [identity], {identity: 0}, [identity]
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in index:
                index[h] = len(elements)
                elements.append(h)
                todo.append(h)
    n = len(elements)
    table = np.zeros((n, n), np.uint16)
    for i, f in enumerate(elements):
        for j, g in enumerate(elements):
            table[i, j] = index[tuple(g[x] for x in f)]
    first = np.array([f[BEGIN] for f in elements], np.uint8)
    return np.array([index[g] for g in generators], np.uint16), table, first, delta, start


def _prefix(elements: np.ndarray, width: int = 256) -> np.ndarray:
    """Exclusive associative scan: the composition of all elements before each position."""
    _, table, _, _, _ = monoid()
    n = len(elements)
    if n <= width:
        out, acc = np.zeros(n, np.uint16), 0
        for i, e in enumerate(elements.tolist()):
            out[i] = acc
            acc = int(table[acc, e])
        return out
    rows = -(-n // width)
    grid = np.zeros((width, rows), np.uint16)              # column = one block; element 0 is the identity
    padded = np.zeros(rows * width, np.uint16)
    padded[:n] = elements
    grid[:] = padded.reshape(rows, width).T
    flat, m = table.ravel(), np.uint32(table.shape[0])
    acc = grid[0]
    for j in range(1, width):
        acc = flat[acc * m + grid[j]]
    acc = _prefix(acc, width)
    out = np.empty((width, rows), np.uint16)
    for j in range(width):
        out[j] = acc
        acc = flat[acc * m + grid[j]]
    return out.T.ravel()[:n]


def piece_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Indices of the code points that start a piece; documents (non-empty ones) start at `doc_starts`."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = class_array()[points]
    begins = np.zeros(n + 1, bool)
    begins[doc_starts] = True
    begins[n] = True
    fits = ~begins[1:]                                     # the next code point belongs to the same document
    after = np.zeros(n, np.uint8)
    after[:-1] = cls[1:]
    white = (cls == SPACE) | (cls == WHITE)
    symbol = cls.copy()
    symbol[cls == APOS] = OTHER
    last = white & fits & (after != SPACE) & (after != WHITE)
    symbol[last] = cls[last] + (LAST_SPACE - SPACE)
    at = np.flatnonzero((cls == APOS) & fits)
    if len(at):
        one = points[at + 1]
        two = np.where(at + 2 < n, points[np.minimum(at + 2, n - 1)], 0)
        two = np.where(fits[np.minimum(at + 1, n - 1)], two, 0)
        # fixed values: contraction suffixes s t m d, re ve ll
        symbol[at[np.isin(one, [ord(c) for c in "stmd"])]] = APOS1
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        symbol[at[pair]] = APOS2
    symbol[begins[:n]] += SYMBOLS
    of, _, first, _, start = monoid()
    state = first[_prefix(of[symbol])]
    return np.flatnonzero(start.ravel()[state.astype(np.uint16) * np.uint16(2 * SYMBOLS) + symbol])


def byte_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets of all pieces of the documents in a UTF-8 buffer."""
    text = data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(points) == len(data):
        at = None
        docs = offsets[:-1][offsets[1:] > offsets[:-1]]
    else:
        at = np.flatnonzero((data & 0xC0) != 0x80)
        docs = np.searchsorted(at, offsets[:-1][offsets[1:] > offsets[:-1]])
    starts = piece_starts(points, docs)
    return starts if at is None else at[starts]


class Vocabulary:
    """Ranks of a tiktoken file, the cache of merged pieces, and the flat table for decoding."""

    CACHE = 120_000                                        # pieces per generation; two generations are held

    def __init__(self, path: str) -> None:
        with open(path, "rb") as fh:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in fh if line.strip())}
        n = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * n
        for t, r in self.ranks.items():
            tokens[r] = t
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked adjacent pair, leftmost first, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 64:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = 1 << 62
        pair = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and a linked list: n log n for pieces without a break."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))                        # part i covers [i, end[i])
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
                continue
            alive[mid], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, i, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Each piece's ids, as little-endian unsigned 32-bit integers."""
        got = list(map(self.young.get, pieces))
        if None in got:
            young, old = self.young, self.old
            for i, g in enumerate(got):
                if g is None:
                    p = pieces[i]
                    g = young.get(p)
                    if g is None:
                        g = old.get(p)
                        if g is None:
                            g = np.array(self.merge(p), "<u4").tobytes()
                        if len(p) <= 64:
                            young[p] = g
                    got[i] = g
            if len(young) > self.CACHE:
                self.old, self.young = young, {}
        return got

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of ids, gathered by token offsets."""
        lens = self.lengths[ids]
        total = int(lens.sum())
        ends = np.cumsum(lens)
        shift = np.repeat(self.starts[ids] - (ends - lens), lens)
        return self.flat[shift + np.arange(total)]


@remembered(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_buffer(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Per document: ids and piece ends (byte offsets in the document), both as little-endian uint32."""
    if len(data) == 0:
        return [b""] * (len(offsets) - 1), [b""] * (len(offsets) - 1)
    starts = byte_pieces(data, offsets)
    ends = np.append(starts[1:], len(data))
    raw = data.tobytes()
    got = vocab.encode_pieces([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    cut = np.searchsorted(starts, offsets)
    cuts, offs = cut.tolist(), offsets.tolist()
    ids = [b"".join(got[cuts[i]:cuts[i + 1]]) for i in range(len(cuts) - 1)]
    stops = [(ends[cuts[i]:cuts[i + 1]] - offs[i]).astype("<u4").tobytes() for i in range(len(cuts) - 1)]
    return ids, stops


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, ids (binary, uint32 little-endian) and piece_ends (binary, the byte offset
    in the document where each pre-token ends)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for rows, data, off in text_slices(batch, "__t_text"):
                ids, ends = encode_buffer(vocab, data, off)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(ends, pa.binary())], names=[id_col, "n_tokens", "ids", "piece_ends"])
        vocab.old = {}                                     # a worker between tasks holds one generation

    return docs.select(F.col(id_col), F.col(text_col).alias("__t_text")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n_tokens long, ids binary, piece_ends binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of `encoded`: id, n_tokens, the ids and the decoded bytes."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for rows, data, off in text_slices(batch, "__t_ids"):
                out = vocab.decode(np.frombuffer(data.tobytes(), "<u4").astype(np.int64))
                lens = np.concatenate([[0], np.cumsum(vocab.lengths[np.frombuffer(data.tobytes(), "<u4")])])
                cuts = lens[off // 4]
                decoded = pa.Array.from_buffers(pa.large_binary(), len(rows), [
                    None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array((off[1:] - off[:-1]) // 4, pa.int64()), rows.column(1),
                     decoded.cast(pa.binary())], names=[id_col, "n_tokens", "ids", "decoded"])

    return encoded.select(F.col(id_col), F.col(ids_col).alias("__t_ids")).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n_tokens long, ids binary, decoded binary")


__all__ = ["Vocabulary", "byte_pieces", "decode", "encode", "encode_buffer", "vocabulary"]
