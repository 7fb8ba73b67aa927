"""N-gram Jaccard self-join with multiple global orders.

A document is the set of its word n-grams (64-bit hashes).  Two sets with Jaccard similarity t or
more share a token within their prefixes - the first n - ceil(t n) + 1 tokens - under EVERY global
order of the tokens.  The join uses three pseudo-random orders, all with the very frequent tokens
last, and intersects their filters before it verifies anything:

1. equal sets are one class (a commutative 128-bit digest), so copies cost one representative;
2. order 1 runs over the whole corpus: prefix tokens are shuffled, buckets of one document vanish,
   the others meet under the size filter and a parity-sketch filter (the Hamming distance of two
   sketches never exceeds the sets' symmetric difference).  A bucket emits a spanning forest of its
   candidate pairs, never the pairs; components of the forests are candidate groups, and every
   similar pair lies inside one;
3. inside a group, cut into hash blocks and block pairs when it is large, orders 2 and 3 must both
   give a common prefix token as well, and only pairs that pass all filters are counted exactly.
   Links leave as spanning forests again.

Frequent tokens are those with a per-mille or more of all sets, so there are at most 1000 times the
mean set size of them, however large the corpus: that list is broadcast.  Their buckets are dealt
over block pairs by their counts.

Defined cases: null and empty texts (and texts of white space) have an empty set and are linked with
nothing; a text with fewer words than n has its whole sequence as its only element; a null id never
names a component (its row shows the smallest id of its class or component, or null); repeated rows
give repeated results; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, mix64, span_hashes, text_slices, tidy
from tessera.llm.components import components, forest

BITS, LEVELS = 512, 8                 # parity sketch: 512 bits, doubled until it has 0.7 bits a token
BLOCK = 1024                         # sets per block of a large group or a frequent token's bucket
SHARED_ROWS = 1 << 18        # entries a task settles together
BLOCK_BYTES = 8 << 20
HEAVY_SHARE = 0.001
SEEDS = tuple(np.uint64(s) for s in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0xA54FF53A5F1D36F1))
TOP = np.uint64(1 << 63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word n-gram hashes of every document: (tokens, offsets), ascending within a document."""
    docs = len(off) - 1
    b = _LOWER[data]
    word = ~_BLANK[b]
    first, last = word.copy(), word.copy()
    if len(b):
        edge = np.zeros(len(b) + 1, bool)
        edge[off] = True
        first[1:] &= ~word[:-1] | edge[1:-1]
        last[:-1] &= ~word[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    h = span_hashes(b, s, e)
    wo = np.searchsorted(s, off)
    words = wo[1:] - wo[:-1]
    doc = np.repeat(np.arange(docs), words)
    c = np.uint64(0x9FB21C651E98DF25)
    full = len(h) - n + 1
    out_h, out_d = [], []
    if full > 0:
        g = np.full(full, np.uint64(n))
        for k in range(n):
            g = g * c + h[k:full + k]
        inside = doc[:full] == doc[n - 1:]
        out_h.append(mix64(g[inside]))
        out_d.append(doc[:full][inside])
    for k in range(1, n):                                   # shorter texts: the whole sequence is the only element
        d = np.flatnonzero(words == k)
        if len(d):
            g = np.full(len(d), np.uint64(k))
            for j in range(k):
                g = g * c + h[wo[d] + j]
            out_h.append(mix64(g))
            out_d.append(d)
    t, d = np.concatenate(out_h), np.concatenate(out_d)
    order = np.argsort(t)
    order = order[np.argsort(d[order].astype(np.uint32), kind="stable")]
    t, d = t[order], d[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
    t, d = t[new], d[new]
    return t, np.searchsorted(d, np.arange(docs + 1))


def digests(tokens: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit commutative digest of every set, as two int64."""
    out = []
    for seed in SEEDS[:2]:
        c = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(mix64(mix64(tokens ^ seed)), out=c[1:])
        out.append(mix64((c[off[1:]] - c[off[:-1]]) ^ (off[1:] - off[:-1]).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def sketches(tokens: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Parity sketch of every set; XOR of its halves gives the sketch of half the length."""
    sizes = off[1:] - off[:-1]
    bits = np.full(len(sizes), BITS)
    for _ in range(LEVELS - 1):
        bits[(bits < 0.7 * sizes) & (bits < BITS << (LEVELS - 1))] *= 2
    start = np.cumsum(bits) - bits
    bit = (mix64(tokens + SEEDS[2]).astype(np.int64) & (np.repeat(bits, sizes) - 1)) + np.repeat(start, sizes)
    raw = np.packbits((np.bincount(bit, minlength=int(bits.sum())) & 1).astype(np.uint8)).tobytes()
    return [raw[a // 8:(a + b) // 8] for a, b in zip(start.tolist(), bits.tolist())]


class Sketches:
    """Sketches of some sets, comparable pair by pair at the length of the shorter one."""

    def __init__(self, raw: list[bytes]) -> None:
        lengths = np.array([len(r) for r in raw])
        self.level = np.log2(lengths // (BITS // 8)).astype(np.int64) if len(raw) else lengths
        self.at, self.rows = {}, {}
        for k in np.unique(self.level).tolist():
            width = (BITS >> 6) << k
            own = np.flatnonzero(self.level == k)
            up = np.flatnonzero(self.level == k + 1)          # similar sets differ by one level at most
            rows = [np.frombuffer(b"".join([raw[i] for i in own.tolist()]), np.uint64).reshape(len(own), width)]
            if len(up):
                more = np.frombuffer(b"".join([raw[i] for i in up.tolist()]), np.uint64).reshape(len(up), 2 * width)
                rows.append(more[:, :width] ^ more[:, width:])
            self.rows[k] = np.concatenate(rows)
            self.at[k] = np.full(len(raw), -1)
            self.at[k][own] = np.arange(len(own))
            self.at[k][up] = len(own) + np.arange(len(up))

    def distance(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hamming distances: lower bounds of the sets' symmetric differences."""
        out = np.zeros(len(i), np.int64)
        low = np.minimum(self.level[i], self.level[j])
        for k in np.unique(low).tolist():
            pick = np.flatnonzero(low == k)
            a, b = self.at[k][i[pick]], self.at[k][j[pick]]
            known = (a >= 0) & (b >= 0)                       # levels further apart: no bound, distance 0
            pick, a, b = pick[known], a[known], b[known]
            for lo in range(0, len(pick), 1 << 14):
                hi = lo + (1 << 14)
                out[pick[lo:hi]] = np.bitwise_count(self.rows[k][a[lo:hi]] ^ self.rows[k][b[lo:hi]]).sum(axis=1, dtype=np.int64)
        return out


def ordered(tokens: np.ndarray, seed: np.uint64, heavy: np.ndarray) -> np.ndarray:
    """Sort keys of the tokens under one global order: pseudo-random, frequent tokens (sorted `heavy`) last."""
    key = mix64(tokens ^ seed) >> np.uint64(1)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
        key[heavy[at] == tokens] |= TOP
    return key


def extra(sizes: np.ndarray) -> np.ndarray:
    """How many tokens the long prefix (see `prefixes`) is longer by."""
    return sizes // 10


def prefix_lengths(sizes: np.ndarray, pct: int) -> np.ndarray:
    return np.where(sizes > 0, sizes - (pct * sizes + 99) // 100 + 1, 0)


def prefixes(tokens: np.ndarray, off: np.ndarray, seed: np.uint64, heavy: np.ndarray, pct: int,
             long: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order keys of all prefix tokens, index of each one's token, does it lie within the plain prefix).

    With `long` the prefixes are longer by `extra`.  Similar sets then share at least `extra` - 1 tokens
    of them: of the set a whose long prefix ends first, at most n_a - p_a tokens lie beyond, and the
    overlap is t max(n_a, n_b) or more.
    """
    sizes = off[1:] - off[:-1]
    key = ordered(tokens, seed, heavy)
    d = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(key)
    order = order[np.argsort(d[order].astype(np.uint32), kind="stable")]
    rank = np.arange(len(order)) - np.repeat(off[:-1], sizes)
    plain = prefix_lengths(sizes, pct)
    keep = rank < np.repeat(np.minimum(plain + extra(sizes), sizes) if long else plain, sizes)
    return key[order[keep]], order[keep], (rank < np.repeat(plain, sizes))[keep]


def allowed_difference(a: np.ndarray, b: np.ndarray, pct: int) -> np.ndarray:
    """Largest symmetric difference of sets of these sizes with similarity pct / 100."""
    both = a + b
    return both - 2 * ((pct * both + 99 + pct) // (100 + pct))


# ---------------------------------------------------------------- passes over the documents

def _summaries(n: int):
    """Per document: set size, digest and sketch; per task: its frequent tokens (doc_id null, kind 1)."""
    names = ["kind", "id", "size", "d1", "d2", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, sets = [], 0
        tally_t = tally_n = np.zeros(0, np.int64)

        def compact():
            nonlocal held, tally_t, tally_n
            t, inv = np.unique(np.concatenate([tally_t.view(np.uint64), *held]), return_inverse=True)
            w = np.concatenate([tally_n, np.ones(len(inv) - len(tally_n), np.int64)])
            c = np.bincount(inv, weights=w, minlength=len(t)).astype(np.int64)
            more = c > 1                                     # a token seen once so far is no candidate yet
            tally_t, tally_n, held = t[more].view(np.int64), c[more], []

        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                tokens, to = shingle_sets(data, off, n)
                d1, d2 = digests(tokens, to)
                size = to[1:] - to[:-1]
                fresh = np.zeros(len(size), bool)
                for i, x in enumerate(d1.tolist()):
                    if size[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                sets += int(fresh.sum())
                held.append(tokens[np.repeat(fresh, size)])
                if sum(map(len, held)) > 1 << 21:
                    compact()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(len(size), np.int32)), rows.column(0), pa.array(size), pa.array(d1), pa.array(d2),
                    pa.array(sketches(tokens, to), pa.binary())],
                    names=names)
        if held:
            compact()
        some = tally_n >= max(4, 2 * HEAVY_SHARE * sets)
        if some.any() or sets:
            k = int(some.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.array(tally_n[some]), pa.array(tally_t[some]),
                pa.array(np.zeros(k, np.int64)), pa.nulls(k, pa.binary())], names=names)
    return run


def _entries(n: int, pct: int, heavy, blocks):
    """(bucket, side, core, d1, need) of the long order-1 prefixes; a frequent token's bucket is dealt over block pairs.

    core: within the plain prefix.  need: how many more of the set's entries must meet another set's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, count = heavy.value, blocks.value
        seen: set[int] = set()
        for batch in batches:
            for _, data, off in text_slices(batch, "text"):
                tokens, to = shingle_sets(data, off, n)
                d1, _ = digests(tokens, to)
                key, at, core = prefixes(tokens, to, SEEDS[0], hot, pct, long=True)
                d = np.repeat(np.arange(len(to) - 1), to[1:] - to[:-1])[at]
                need = extra(to[1:] - to[:-1]) - 2 - np.bincount(d[key >= TOP], minlength=len(to) - 1)
                fresh = np.zeros(len(d1), bool)
                for i, x in enumerate(d1.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                keep = fresh[d]
                key, at, d, core = key[keep], at[keep], d[keep], core[keep]
                of = d1[d]
                nb = np.ones(len(key), np.int64)
                if len(hot):
                    is_hot = np.flatnonzero(key >= TOP)
                    nb[is_hot] = count[np.searchsorted(hot, tokens[at[is_hot]])]
                own = (of.view(np.uint64) % nb.astype(np.uint64)).astype(np.int64)
                rep = np.repeat(np.arange(len(key)), nb)     # one copy for each block the own block meets
                other = np.arange(len(rep)) - np.repeat(np.cumsum(nb) - nb, nb)
                lo, hi = np.minimum(own[rep], other), np.maximum(own[rep], other)
                bucket = mix64(key[rep] + mix64((lo << 32 | hi).astype(np.uint64) + np.uint64(1))).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket), pa.array((own[rep] != lo) & (lo != hi)), pa.array(core[rep]), pa.array(of[rep]),
                    pa.array(need[d][rep].astype(np.int32))], names=["bucket", "side", "core", "d1", "need"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of buckets with two sets or more; rows come sorted by bucket and set, so a task holds some whole buckets
    at a time, never its partition."""
    held: list[np.ndarray] | None = None

    def settled(cols: list[np.ndarray]):
        bucket, d1 = cols[0], cols[3]
        new = np.ones(len(bucket), bool)                    # the same set may come from several map tasks
        new[1:] = (bucket[1:] != bucket[:-1]) | (d1[1:] != d1[:-1])
        at = np.flatnonzero(new)
        same = bucket[at][1:] == bucket[at][:-1]
        keep = np.zeros(len(at), bool)
        keep[1:] |= same
        keep[:-1] |= same
        at = at[keep]
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in cols], names=["bucket", "side", "core", "d1", "need"])

    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        held = cols if held is None else [np.concatenate(c) for c in zip(held, cols)]
        if len(held[0]) >= SHARED_ROWS:
            cut = int(np.searchsorted(held[0], held[0][-1]))                # the last bucket may go on
            yield from settled([c[:cut] for c in held])
            held = [c[cut:] for c in held]
    if held is not None:
        yield from settled(held)


def _candidates(pct: int):
    """Spanning forest of the pairs of each bucket that pass the size and sketch filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        tail: tuple | None = None

        def passing(i, j, size, sketch):
            a, b = size[i], size[j]
            ok = 100 * np.minimum(a, b) >= pct * np.maximum(a, b)
            i, j, a, b = i[ok], j[ok], a[ok], b[ok]
            ok = sketch.distance(i, j) <= allowed_difference(a, b, pct)
            return i[ok], j[ok]

        def treat(bucket, side, d1, size, sketch):
            nonlocal edges
            order = np.argsort(bucket, kind="stable")
            bucket, side, d1, size = bucket[order], side[order], d1[order], size[order]
            sketch = Sketches([sketch[k] for k in order.tolist()])
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            length = np.diff(np.append(starts, len(bucket)))
            run_len = np.repeat(length, length)
            left = np.repeat(starts + length, length) - np.arange(len(bucket))    # rows to the bucket's end
            split = np.repeat(np.add.reduceat(side.astype(np.int64), starts) > 0, length)   # two sides: cross pairs only
            found = []
            small = run_len <= 64
            for step in range(1, int(length[length <= 64].max(initial=1))):
                i = np.flatnonzero(small & (left > step))
                if not len(i):
                    break
                j = i + step
                ok = ~split[i] | (side[i] != side[j])
                found.append(passing(i[ok], j[ok], size, sketch))
            for s0, m in zip(starts[length > 64].tolist(), length[length > 64].tolist()):
                for x in range(s0, s0 + m - 1):                # row by row: memory stays with the bucket's length
                    j = np.arange(x + 1, s0 + m)
                    if split[x]:
                        j = j[side[j] != side[x]]
                    found.append(passing(np.full(len(j), x), j, size, sketch))
                    if len(found) > 256:
                        found = [forest(*(np.concatenate(c) for c in zip(*found)))]
            i, j = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            i, j = i.astype(np.int64), j.astype(np.int64)
            edges = forest(np.concatenate([edges[0], d1[i]]), np.concatenate([edges[1], d1[j]]))

        def rows(batch):
            return (batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(),
                    batch.column(3).to_numpy(), batch.column(4).to_pylist())

        for batch in batches:                                  # sorted by bucket: keep the last bucket for the next batch
            now = rows(batch)
            if tail is not None:
                now = tuple([*a, *b] if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(tail, now))
            cut = int(np.searchsorted(now[0], now[0][-1]))
            tail = tuple(c[cut:] for c in now)
            if cut:
                treat(*(c[:cut] for c in now))
        if tail is not None:
            treat(*tail)
        if len(edges[0]):
            yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], names=["u", "v"])
    return run


# ---------------------------------------------------------------- verification inside candidate groups

def overlaps(rows: np.ndarray, tokens: np.ndarray, m: int, split: int | None, columns: int = 4096) -> np.ndarray:
    """Counts of common tokens between sets: (m, m), or (split, m - split) between the two sides."""
    order = np.argsort(tokens)
    t, r = tokens[order], rows[order]
    new = np.ones(len(t), bool)
    new[1:] = t[1:] != t[:-1]
    code = np.cumsum(new) - 1
    many = np.bincount(code)[code] > 1                        # a token of one set is in no intersection
    t, r, code = t[many], r[many], code[many]
    _, code = np.unique(code, return_inverse=True)
    k = m if split is None else split
    out = np.zeros((k, m - (0 if split is None else split)), np.float32)
    for lo in range(0, int(code.max(initial=-1)) + 1, columns):
        a, b = np.searchsorted(code, [lo, lo + columns])
        x = np.zeros((m, columns), np.float32)
        x[r[a:b], code[a:b] - lo] = 1
        out += x[:k] @ x[(0 if split is None else split):].T
    return out


def similar_pairs(tokens: np.ndarray, off: np.ndarray, split: int | None, heavy: np.ndarray, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of the sets with similarity pct / 100 or more; with `split`, only pairs across it."""
    size = off[1:] - off[:-1]
    m = len(size)
    d = np.repeat(np.arange(m), size)
    left, right = (np.arange(m),) * 2 if split is None else (np.arange(split), np.arange(split, m))
    a, b = size[left][:, None], size[right][None, :]
    ok = 100 * np.minimum(a, b) >= pct * np.maximum(a, b)
    if split is None:
        ok &= left[:, None] < right[None, :]
    for seed in SEEDS[1:]:                                     # the other orders' filters, intersected
        if not ok.any():
            break
        key, at, _ = prefixes(tokens, off, seed, heavy, pct)
        ok &= overlaps(d[at], key, m, split) > 0
    i, j = np.nonzero(ok)
    if not len(i):
        return i, j
    live = np.zeros(m, bool)
    live[left[i]] = live[right[j]] = True                      # only sets of some surviving pair are counted
    keep = live[d]
    common = overlaps(d[keep], tokens[keep], m, split)[i, j].astype(np.int64)
    i, j = left[i], right[j]
    linked = 100 * common >= pct * (size[i] + size[j] - common)
    return i[linked], j[linked]


def _sets(n: int):
    """Token sets of candidate representatives whose digest is the expected one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                tokens, to = shingle_sets(data, off, n)
                d1, d2 = digests(tokens, to)
                good = np.flatnonzero((d1 == rows.column(2).to_numpy()) & (d2 == rows.column(3).to_numpy()))
                take = rows.take(pa.array(good))
                yield pa.RecordBatch.from_arrays(
                    [take.column(0), take.column(1), take.column(4), take.column(5),
                     pa.array([tokens[to[i]:to[i + 1]].tobytes() for i in good.tolist()], pa.binary())],
                    names=["rep", "grp", "blk", "nb", "tokens"])
    return run


def _links(pct: int, heavy):
    """Verified links of each (group, lo, hi) as spanning forests; rows come sorted by that key, then side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = heavy.value
        key, reps, sides, sets, held = None, [], [], [], 0
        out_u, out_v = [], []

        def done():
            order = sorted(range(len(reps)), key=lambda k: (sides[k], reps[k]))
            off = np.zeros(len(order) + 1, np.int64)
            np.cumsum([len(sets[k]) // 8 for k in order], out=off[1:])
            tokens = np.frombuffer(b"".join([sets[k] for k in order]), np.uint64)
            rep = np.array([reps[k] for k in order], np.int64)
            split = None if key[1] == key[2] else len(order) - sum(sides)
            if len(rep) < 2 or split == 0 or split == len(rep):
                return
            i, j = similar_pairs(tokens, off, split, hot, pct)
            u, v = forest(rep[i], rep[j])
            out_u.append(u)
            out_v.append(v)

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(6)]
            for g, lo, hi, side, rep, t in zip(*cols):
                if (g, lo, hi) != key:
                    if key is not None:
                        done()
                    key, reps, sides, sets = (g, lo, hi), [], [], []
                    if len(out_u) > 4096:
                        yield flush()
                        out_u, out_v = [], []
                reps.append(rep)
                sides.append(side)
                sets.append(t)
        if key is not None:
            done()
        if out_u:
            yield flush()
    return run


def similarity_classes(docs: DataFrame, n: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles and component_id (smallest id reachable by links, itself included)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    first = materialise(texts.mapInArrow(tidy(_summaries(n)), "kind int, id long, size long, d1 long, d2 long, sketch binary"), "sets")
    sums = first.where("kind = 0")
    full = sums.where("size > 0")
    found = full.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.min("size").alias("size"), F.min("sketch").alias("sketch"))
    reps = materialise(found, "reps")
    n_sets = reps.count()

    # frequent tokens: at most mean set size / HEAVY_SHARE of them
    least = max(16, int(HEAVY_SHARE * n_sets))
    hot = (first.where("kind = 1").groupBy("d1").agg(F.sum("size").alias("c")).where(F.col("c") >= least)).toPandas()
    token = hot["d1"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    heavy = sc.broadcast(token[order])
    blocks = sc.broadcast(np.maximum(1, -(-hot["c"].to_numpy(np.int64)[order] // (2 * BLOCK))))

    kinds = "bucket long, side boolean, core boolean, d1 long, need int"
    entries = texts.mapInArrow(tidy(_entries(n, pct, heavy, blocks)), kinds)
    shared = materialise(entries.repartition("bucket").sortWithinPartitions("bucket", "d1").mapInArrow(tidy(_shared), kinds), "shared")
    # a set with too few entries that meet another set's is in no similar pair (frequent tokens count in `need`)
    hopeful = shared.groupBy("d1").agg(F.count("*").alias("met"), F.max("need").alias("least")).where(
        F.col("met") >= F.col("least")).select(F.col("d1").alias("e1"))
    known = reps.groupBy("d1").agg(F.min("size").alias("size"), F.min("sketch").alias("sketch"))
    known = known.join(hopeful, known["d1"] == hopeful["e1"], "left_semi")
    met = shared.where("core").select("bucket", "side", "d1").join(known, "d1").select("bucket", "side", "d1", "size", "sketch")
    edges = met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_candidates(pct)), "u long, v long")
    grouped = components(edges)

    members = reps.where("rep is not null").join(grouped, reps["d1"] == grouped["node"]).select(
        "rep", F.col("component").alias("grp"), "d1", "d2", "size")
    counts = members.groupBy("grp").agg(F.count("*").alias("m"), F.sum(F.col("size") * 8).alias("bytes")).where("m > 1").select(
        F.col("grp").alias("g"), F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("nb"))
    members = members.join(counts, members["grp"] == counts["g"]).select(
        "rep", "grp", "d1", "d2", F.pmod(F.xxhash64("d1", "d2"), F.col("nb")).cast("int").alias("blk"), "nb")
    wanted = texts.where("id is not null and text is not null").join(members, F.col("id") == F.col("rep")).select(
        "rep", "grp", "d1", "d2", "blk", "nb", "text")
    sets = wanted.mapInArrow(tidy(_sets(n)), "rep long, grp long, blk int, nb int, tokens binary").dropDuplicates(["rep"])
    dealt = sets.select("rep", "grp", "blk", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("oth"), "tokens").select(
        "grp", F.least("blk", "oth").alias("lo"), F.greatest("blk", "oth").alias("hi"),
        (F.col("blk") > F.col("oth")).cast("int").alias("side"), "rep", "tokens")
    links = dealt.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi").mapInArrow(tidy(_links(pct, heavy)), "u long, v long")
    linked = components(links)

    named = reps.join(linked, reps["rep"] == linked["node"], "left").select(
        F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "rep").alias("component_id"))
    out = sums.join(named, (sums["size"] > 0) & (sums["d1"] == named["e1"]) & (sums["d2"] == named["e2"]), "left")
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id"))


def survivors(docs: DataFrame, n: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the documents that a smaller id of their component represents; rows with a null id stay."""
    found = similarity_classes(docs, n, pct, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).cast("long").alias("__t_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["__t_gone"], "left_anti")

