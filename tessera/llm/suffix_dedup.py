"""Removal of repeated byte strings with suffix arrays built by linear grouping.

Every byte covered by a string of L bytes that also starts anywhere else is removed.  Equal strings
have equal minima of their K-gram hashes, at the same offset: the minimiser positions (anchors) of
all strings of L bytes are the only places where a comparison is needed, about 2 / (L - K + 2) of all
positions.  So

1. each map task finds the anchors of its texts and their contexts (the bytes that strings of
   length L with this anchor can cover); equal contexts are collapsed before the shuffle;
2. anchors are grouped by their K-gram; occurrences with equal contexts cover them whole, K-grams
   with one context only vanish;
3. the K-grams left bring one context per class.  The contexts of a group, cut into chunks of 48
   bytes aligned at the anchor, form one integer string.  Its suffix array is built by grouping:
   phase 1 takes the groups of suffixes with equal Lyndon prefixes in descending order and moves the
   suffixes that their previous-smaller pointers name into new groups; phase 2 emits each group's order
   by following those pointers, without renaming or recursion.  Only runs of chunks that another context of the K-gram
   holds at the same place enter the string, and equal runs once.  Suffixes that agree over all the
   whole chunks of a string of length L are neighbours in the array: neighbours are compared symbol by symbol, and runs
   of equal ones are candidates; the bytes before and after the chunks decide.

Equal texts are one unit: if two documents share a text of at least L bytes, all of it goes.

Defined cases: null text is empty; texts shorter than L keep everything; every document of equal
texts shows the same result; strings are judged on the input, not on what is left.  Null ids and rows that repeat an id
show the result of their text (a repeated row is another document with that text); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise, mix64, text_slices

LENGTH = 400                 # bytes of a repeated string
GRAM = 200                   # bytes of an anchor's K-gram
CHUNK = 48                   # bytes of a symbol
SLICE = 1 << 20              # bytes of text treated at once
CONTEXTS = 4096              # contexts of one suffix array (whole groups)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix64(np.arange(256, dtype=np.uint64) + _ODD)


class WindowHasher:
    """64-bit hashes of windows of one buffer, by prefix sums of a polynomial modulo 2^64: one product a position,
    for windows of LENGTH + GRAM bytes at most (texts known to collide under such a modulus are longer)."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        power = np.full(n + 1, _ODD)
        power[0] = 1
        np.cumprod(power, out=power)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(power[:n] * _BYTE[data], out=self.prefix[1:])
        power.fill(_INV)
        power[0] = 1
        self.inverse = np.cumprod(power, out=power)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


# ---------------------------------------------------------------- suffix array by grouping

def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of a sequence of integers whose last one is its unique smallest."""
    n = len(s)
    symbols = sorted(set(s))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in s]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    below = [g - 1 for g in range(len(symbols))]           # neighbours in the order of the groups
    above = [g + 1 for g in range(len(symbols))]
    above[-1] = -1
    done, prev, skip = bytearray(n), [-1] * n, [-1] * n
    at = len(symbols) - 1
    while at >= 0:                                          # phase 1: descending
        here = members[at]
        for i in here:
            done[i] = 1
        split: dict[int, dict[int, list[int]]] = {}
        last, times = -1, 0
        for i in [*here, -1]:
            j = -1
            if i >= 0:
                j = i - 1
                while j >= 0 and done[j]:
                    j = skip[j]
                prev[i] = skip[i] = j
                k = i - 1                                   # shorten the paths just walked
                while k > j and done[k]:
                    skip[k], k = j, skip[k]
                if j == last:
                    times += 1
                    continue
            if last >= 0:
                split.setdefault(group[last], {}).setdefault(times, []).append(last)
            last, times = j, 1
        for g, parts in split.items():
            moved = sum(map(len, parts.values()))
            under = g
            for times in sorted(parts):                     # more repetitions of the prefix: a larger group
                new = len(members)
                part = parts[times]
                members.append(part)
                for p in part:
                    group[p] = new
                up = above[under]
                below.append(under)
                above.append(up)
                above[under] = new
                if up >= 0:
                    below[up] = new
                under = new
            members[g] = [] if moved == len(members[g]) else [p for p in members[g] if group[p] == g]
        at = below[at]
    first = [0] * len(members)
    g, total = number[s[-1]], 0
    while below[g] >= 0:
        g = below[g]
    while g >= 0:
        first[g] = total
        total += len(members[g])
        g = above[g]
    out, placed = [0] * n, bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    first[group[n - 1]] += 1
    for i in range(n):                                      # phase 2: ascending
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[first[g]] = j
            first[g] += 1
            placed[j] = 1
            j = prev[j]
    return out


# ---------------------------------------------------------------- anchors

def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every w consecutive values (length len(x) - w + 1)."""
    n = len(x)
    pad = np.concatenate([x, np.repeat(x[-1:], -n % w)]).reshape(-1, w)
    left = op.accumulate(pad, axis=1).ravel()
    right = op.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[:n - w + 1], left[w - 1:n])


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(position, document, K-gram hash, context hash, bytes before, bytes from the anchor on) of all anchors."""
    n, w = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    spans = WindowHasher(data)
    h = mix64((spans.prefix[gram:] - spans.prefix[:n - gram + 1]) * spans.inverse[:n - gram + 1])   # of every position
    low = _sliding(h, w, np.minimum)
    doc = np.repeat(np.arange(len(off) - 1), off[1:] - off[:-1])
    low[doc[:len(low)] != doc[length - 1:]] = 0             # strings across documents do not count
    padded = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    at = np.flatnonzero(_sliding(padded, w, np.maximum)[:len(h)] == h)
    d = doc[at]
    before, after = np.minimum(length - gram, at - off[d]), np.minimum(length, off[d + 1] - at)
    context = mix64(spans(at - before, at + after) + before.astype(np.uint64))
    return at, d, h[at], context, before, after


def uid(text: bytes) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)


def _fresh(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray, seen: set[int], least: int):
    """Texts of at least `least` bytes that this task has not met: (uid array, mask)."""
    raw, offs = data.tobytes(), off.tolist()
    ids, new = np.zeros(len(offs) - 1, np.int64), np.zeros(len(offs) - 1, bool)
    for i in range(len(offs) - 1):
        if offs[i + 1] - offs[i] < least:
            continue
        ids[i] = u = uid(raw[offs[i]:offs[i + 1]])
        if u not in seen:
            seen.add(u)
            new[i] = True
    return ids, new


_FOUND = ["kind", "gram", "context", "uid", "pos", "before", "after"]
_FOUND_DDL = "kind int, gram long, context long, uid long, pos long, before int, after int"
SHIP, MULTI, MARK, NEED, NEED_WHOLE = range(5)


def _found(kind, gram, context, unit, pos, before, after) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(unit), 1 << 16):
        c = slice(lo, lo + (1 << 16))
        yield pa.RecordBatch.from_arrays([
            pa.array(kind[c].astype(np.int32)), pa.array(gram[c].view(np.int64)), pa.array(context[c].view(np.int64)), pa.array(unit[c]),
            pa.array(pos[c]), pa.array(before[c].astype(np.int32)), pa.array(after[c].astype(np.int32))], names=_FOUND)


def _classes(cols: list[np.ndarray], multi: np.ndarray):
    """Sort occurrences by (gram, context, uid, pos), drop equal ones: (columns, class starts, class sizes, repeated)."""
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    cols, multi = [c[order] for c in cols], multi[order]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
    at = np.flatnonzero(new)
    multi = np.maximum.reduceat(multi, at) if len(at) else multi
    cols = [c[at] for c in cols]
    first = np.ones(len(at), bool)
    first[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(at)))
    repeated = (sizes > 1) | ((np.add.reduceat(multi, starts) > 0) if len(starts) else np.zeros(0, bool))
    return cols, starts, sizes, repeated


def _anchor_rows(length: int, gram: int):
    """Anchors of a task's texts, equal contexts collapsed: one row to ship for each, and marks for the repeated ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple] = []
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", SLICE):
                units, new = _fresh(rows, data, off, seen, length)
                if not new.any():
                    continue
                at, d, g, c, before, after = anchors(data, off, length, gram)
                ok = new[d]
                at, d = at[ok], d[ok]
                held.append((g[ok], c[ok], units[d], at - off[d], before[ok].astype(np.int32), after[ok].astype(np.int32)))
        if not held:
            return
        cols = [np.concatenate(c) for c in zip(*held)]
        del held, seen
        cols, starts, sizes, repeated = _classes(cols, np.zeros(len(cols[0]), np.int64))
        marked = np.repeat(repeated, sizes)
        yield from _found(np.full(int(marked.sum()), MARK), *[c[marked] for c in cols])
        yield from _found(np.where(repeated, MULTI, SHIP), *[c[starts] for c in cols])
    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of contexts that occur twice, and one occurrence of every context of K-grams with several contexts."""
    got = [[b.column(i).to_numpy() for i in range(7)] for b in batches]
    if not got:
        return
    cols = [np.concatenate(c) for c in zip(*got)]
    del got
    multi = (cols[0] == MULTI).astype(np.int64)
    cols, starts, sizes, repeated = _classes(cols[1:], multi)
    marked = np.repeat(repeated, sizes)
    yield from _found(np.full(int(marked.sum()), MARK), *[c[marked] for c in cols])
    grams = cols[0][starts]
    several = np.zeros(len(starts), bool)
    same = grams[1:] == grams[:-1]
    several[1:] |= same
    several[:-1] |= same
    yield from _found(np.where(repeated[several], NEED_WHOLE, NEED), *[c[starts[several]] for c in cols])


# ---------------------------------------------------------------- contexts

def _unique_texts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        for rows, data, off in text_slices(batch, "text", 4 * SLICE):
            units, new = _fresh(rows, data, off, seen, least)
            if new.any():
                mask = pa.array(new)
                yield pa.RecordBatch.from_arrays([pa.array(units[new]), rows.column(0).filter(mask)], names=["uid", "text"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, uid, pos, before, context bytes) of the wanted anchors of each text."""
    names = ["gram", "uid", "pos", "before", "bytes"]
    for batch in batches:
        out, size = [], 0
        for u, text, wanted in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            raw = text.encode()
            for a in wanted:
                b = raw[a["pos"] - a["before"]:a["pos"] + a["after"]]
                out.append((a["gram"], u, a["pos"], a["before"], b))
                size += len(b) + 40
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)


def chunk_symbols(data: np.ndarray, starts: np.ndarray, spans: WindowHasher) -> np.ndarray:
    """A number for each chunk, the same exactly for equal bytes: numbered by hash, and every chunk compared with the
    first one of its hash (should two differ, all are numbered by their bytes)."""
    _, first, symbol = np.unique(spans(starts, starts + CHUNK), return_index=True, return_inverse=True)
    if not len(starts):
        return symbol
    view = np.lib.stride_tricks.sliding_window_view(data, CHUNK)
    for lo in range(0, len(starts), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        if not (view[starts[part]] == view[starts[first[symbol[part]]]]).all():
            known: dict[bytes, int] = {}
            return np.array([known.setdefault(view[i].tobytes(), len(known)) for i in starts.tolist()])
    return symbol


def _shared_runs(gram: np.ndarray, ctx: np.ndarray, chunk: np.ndarray, symbol: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """(chunk rows, their run's number): runs of at least `need` chunks, from the anchor or before it on, each of which another
    context of the K-gram holds at the same place.  No other chunk lies in a string that two contexts share."""
    if not len(ctx):
        return ctx, ctx
    _, group = np.unique(gram, return_inverse=True)
    lo, n = int(chunk.min()), int(symbol.max()) + 1
    place = (group[ctx] * (int(chunk.max()) - lo + 1) + chunk - lo) * n + symbol
    _, inv, times = np.unique(place, return_inverse=True, return_counts=True)
    shared = (times[inv] > 1) | (need == 0)
    new = np.append(True, (ctx[1:] != ctx[:-1]) | (shared[1:] != shared[:-1]))
    run = np.cumsum(new) - 1
    good = shared[new] & (np.bincount(run) >= need) & (chunk[new] <= 0)
    inside = np.flatnonzero(good[run])
    return inside, (np.cumsum(good) - 1)[run[inside]]


def repeated_strings(gram: np.ndarray, before: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) relative to the anchor: the bytes of each context covered by strings of `length`
    bytes that another context of its K-gram holds at the same place."""
    m = len(contexts)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts])
    base = np.cumsum(size) - size                           # where each context begins in `data`
    zero = base + before                                    # where its anchor is
    after = size - before
    lo, hi = -(before // CHUNK), after // CHUNK             # chunks lo .. hi - 1, aligned at the anchor
    per = hi - lo
    ctx = np.repeat(np.arange(m), per)
    chunk = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + np.repeat(lo, per)
    starts = zero[ctx] + CHUNK * chunk
    spans = WindowHasher(data)
    symbol = chunk_symbols(data, starts, spans)
    need = (length - CHUNK) // CHUNK                        # whole chunks inside any string of `length` bytes
    inside, run = _shared_runs(gram, ctx, chunk, symbol, need)
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    of, c, symbol = ctx[inside], chunk[inside], symbol[inside] + 2          # 1 ends a run, 0 the string
    at = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    long = np.diff(np.append(at, len(run)))
    step = np.arange(len(run)) - np.repeat(at, long)
    rows = np.full((len(at), int(long.max())), -1)
    rows[run, step] = symbol
    rows, one = np.unique(rows, axis=0, return_inverse=True)                # equal runs stand in the string once
    held = rows >= 0
    size = held.sum(axis=1)
    begin = np.cumsum(size + 1) - size - 1                  # one separator after every run
    s = np.ones(int(size.sum()) + len(rows) + 1, np.int64)
    s[(begin[:, None] + np.arange(rows.shape[1]))[held]], s[-1] = rows[held], 0
    sa = np.array(suffix_array(s.tolist()))
    tail = np.append(s, np.full(need, -1))
    agree = np.ones(len(sa) - 1, bool)                      # neighbours in the array share their first `need` symbols
    for k in range(need):
        there = tail[sa + k]
        agree &= there[1:] == there[:-1]
    rank = np.zeros(len(s), np.int64)
    rank[sa] = np.cumsum(np.append(False, ~agree))
    fits = (step + need <= np.repeat(long, long)) & (c <= 0)
    of, c, cls = of[fits], c[fits], rank[(begin[one.ravel()][run] + step)[fits]]
    g = gram[of].view(np.uint64) if gram.dtype == np.int64 else gram[of]
    core = mix64(mix64(g + cls.astype(np.uint64)) + (c + 4096).astype(np.uint64))
    _, inv, n = np.unique(core, return_inverse=True, return_counts=True)
    many = n[inv] > 1
    of, c, core = of[many], c[many], core[many]
    first, last = np.full(m, 1 << 30), np.full(m, -(1 << 30))
    for delta in range(CHUNK):                              # the string starts delta bytes before its first whole chunk
        r = CHUNK * c - delta
        ok = (r >= -before[of]) & (r + length <= after[of])
        o, rr = of[ok], r[ok]
        if not len(o):
            continue
        a = zero[o] + rr
        tail = a + delta + CHUNK * need
        key = mix64(core[ok] + mix64(spans(a, a + delta) + np.uint64(delta)) * np.uint64(3)
                    + mix64(spans(tail, a + length)) * np.uint64(5))
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        hit = n[inv] > 1
        np.minimum.at(first, o[hit], rr[hit])
        np.maximum.at(last, o[hit], rr[hit])
    got = np.flatnonzero(first <= last)
    return got, first[got], last[got] + length


def _context_marks(length: int):
    """(uid, start, end) found inside the groups; rows come sorted by gram, whole groups are treated together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]

        def treat(cols):
            got, a, b = repeated_strings(np.array(cols[0], np.int64), np.array(cols[3], np.int64), cols[4], length)
            pos = np.array(cols[2], np.int64)[got]
            return pa.RecordBatch.from_arrays([pa.array(np.array(cols[1], np.int64)[got]), pa.array(pos + a), pa.array(pos + b)],
                                              names=["uid", "start", "end"])

        for batch in batches:
            for k in range(5):
                held[k] += batch.column(k).to_pylist()
            while len(held[0]) > CONTEXTS:
                cut = CONTEXTS
                while cut < len(held[0]) and held[0][cut] == held[0][cut - 1]:
                    cut += 1
                if cut == len(held[0]):
                    break
                yield treat([c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held[0]:
            yield treat(held)
    return run


# ---------------------------------------------------------------- removal

def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, spans, kept) of texts with marks."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out, size = [], 0
        for u, text, marks in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            raw, spans = text.encode(), merged([(s["start"], s["end"]) for s in marks])
            edges = [0, *[x for s in spans for x in s], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((u, [{"start": a, "end": b} for a, b in spans], kept))
            size += len(kept) + 64 * len(spans) + 64
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), kind, pa.binary()))], names=["uid", "spans", "kept"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), kind, pa.binary()))], names=["uid", "spans", "kept"])


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text_col: str = "text") -> DataFrame:
    """(uid, spans, kept) of every distinct text that loses bytes to another place (equal texts apart):
    the removed byte spans, merged, and the bytes left."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    local = materialise(texts.mapInArrow(_anchor_rows(length, gram), _FOUND_DDL), "anchors")
    met = materialise(local.where(F.col("kind") <= MULTI).repartition("gram").mapInArrow(_grouped, _FOUND_DDL), "grams")
    known = local.where(F.col("kind") == MARK).select("uid", F.col("pos"), "before", "after").unionByName(
        met.where(F.col("kind") == MARK).select("uid", "pos", "before", "after"))
    marks = materialise(known.select("uid", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("end")), "marks")
    discard(local)
    needs = met.where(F.col("kind") >= NEED)
    involved = marks.select("uid").unionByName(needs.select("uid")).distinct().withColumnRenamed("uid", "v")
    single = texts.mapInArrow(lambda b: _unique_texts(b, length), "uid long, text string")
    units = materialise(single.join(involved, F.col("uid") == F.col("v"), "left_semi").dropDuplicates(["uid"]), "texts")

    wanted = needs.groupBy(F.col("uid").alias("v")).agg(F.collect_list(F.struct("gram", "pos", "before", "after")).alias("wanted"))
    contexts = units.join(wanted, F.col("uid") == F.col("v")).select("uid", "text", "wanted").mapInArrow(
        _contexts, "gram long, uid long, pos long, before long, bytes binary")
    more = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(_context_marks(length), "uid long, start long, end long")
    spans = marks.unionByName(more).groupBy(F.col("uid").alias("v")).agg(F.collect_set(F.struct("start", "end")).alias("marks"))
    return units.join(spans, F.col("uid") == F.col("v")).select("uid", "text", "marks").mapInArrow(
        _cut, "uid long, spans array<struct<start: long, end: long>>, kept binary")


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256, n_kept (bytes left) and untouched (none removed)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text.cast("binary"), 256).alias("sha")).withColumn(
        "uid", F.conv(F.substring("sha", 1, 16), 16, -10).cast("long"))
    cut = removals(docs, length, gram, text_col).select(
        F.col("uid").alias("v"), F.size("spans").cast("long").alias("s"), F.sha2("kept", 256).alias("k"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("r"))
    sizes = base.groupBy(F.col("uid").alias("w")).agg(F.count("*").alias("copies")).where("copies > 1")
    known = cut.join(sizes, F.col("v") == F.col("w"), "full_outer").select(F.coalesce("v", "w").alias("u"), "s", "r", "k", "copies")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    removed = F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).cast("long")
    return base.join(known, F.col("uid") == F.col("u"), "left").select(
        F.col("id").alias(id_col), "n_bytes",
        removed.alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("s", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("k", "sha")).alias("kept_sha256"),
        (F.col("n_bytes") - removed).alias("n_kept"), (removed == 0).alias("untouched"))
