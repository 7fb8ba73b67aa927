"""Token-ID output in binary files coded with word-aligned Simple-8b.

A 64-bit word has a selector in its top four bits and sixty bits of payload:

    selector   0          escape: the payload is an index into the block's raw 64-bit values
    selectors  1 .. 14    60 x 1, 30 x 2, 20 x 3, 15 x 4, 12 x 5, 10 x 6, 8 x 7, 7 x 8, 6 x 10, 5 x 12, 4 x 15, 3 x 20,
                          2 x 30, 1 x 60 (ids x bits)
    selector  15          run: one id (low 32 bits) repeated (28 bits of count)

Ids are coded in blocks of `BLOCK`; each starts on a word of its own, and the file keeps the byte offset of every
block, so that blocks are read and decoded apart, all at once by selector.  A file holds

    magic | blocks: words, then raw values | block offsets, words per block | doc ids, null flags, token counts | trailer

in ascending order of documents.  `write` deals documents over tasks by ranges of their id, encodes and packs them
as they stream by, and rolls files at `FILE_IDS`; what comes back from the tasks is the manifest, one row per file.  A task
that is repeated writes under a new name, and only names in the manifest (which Spark commits) are ever read.
`read` opens the files of a manifest and decodes group after group of blocks.

Text is encoded by the tokenizers library.  Pre-tokens of plain characters are found in the bytes by shifted comparisons;
the library's model merges every distinct one once per worker (a bounded cache), hundreds in one call.  No pre-token runs
across a space that follows a character other than white space, so texts are cut there, and pieces with any
other character, or with a special token, go through the whole library.

Defined cases: null text is empty (the end id alone); null ids come first; equal ids are ordered by a hash of their text,
then by the text; no rows: no files and no rows.  Very long texts are one document over many blocks.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, remembered, text_buffer, text_slices, tidy
from tessera.session import scratch_path

MAGIC = b"TESS-S8B"
BLOCK = 1024                 # ids of a block
GROUP = 256                  # blocks coded or decoded together
FILE_IDS = 8 << 20           # ids after which a file is closed (at the end of a document)
SLICE = 4 << 20              # bytes of text encoded at once
CACHE = 500_000              # distinct pre-tokens of a generation; a worker remembers two
LINES = 256                  # pre-tokens that the library's model sees at once
_COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0], np.int64)
_BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], np.int64)
_TRAILER = "<QQQQQ8s"       # offset of the footer, blocks, documents, ids, ids of a block, magic


# ---- the code ------------------------------------------------------------------------------------------------

def _windows(good: np.ndarray, count: int) -> np.ndarray:
    """Are all of `count` values from here on good?  (rows apart; what lies behind a row's end counts as good)"""
    out, have = good.copy(), 1
    while have < count:
        step = min(have, count - have)
        out[:, :-step] &= out[:, step:].copy()
        have += step
    return out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, raw values, words per block, raw values per block) of uint64 ids, cut into blocks of BLOCK."""
    ids = ids.astype(np.uint64)
    m = len(ids)
    if m == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), z, z
    first = np.arange(0, m, BLOCK)
    rows = np.zeros((len(first), BLOCK), np.uint64)                         # padded by zeros, which fit everywhere
    rows.ravel()[:m] = ids
    how = np.zeros(rows.shape, np.uint8)                                   # the escape takes any id
    top = int(ids.max())
    narrow = rows.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
    for s in range(14, 0, -1):                                             # from wide to narrow: the later fit holds more
        if top < 1 << int(_BITS[s]):
            how[:] = s
            continue
        fits = _windows(narrow < narrow.dtype.type(1 << int(_BITS[s])), int(_COUNT[s]))
        if not fits[:, :BLOCK - int(_COUNT[s])].any():                      # so no narrower one fits before a block's last ids
            break
        np.copyto(how, s, where=fits)
    how = how.ravel()[:m]
    run = None
    same = np.zeros(rows.shape, bool)
    same[:, :-1] = rows[:, 1:] == rows[:, :-1]
    if _windows(same, 2).any():
        at = np.arange(m)
        left = np.minimum((at // BLOCK + 1) * BLOCK, m) - at               # ids up to the end of the block
        change = np.where(np.append(ids[1:] != ids[:-1], True), at + 1, m)
        run = np.minimum(np.minimum.accumulate(change[::-1])[::-1] - at, left)
        how[(run > np.minimum(_COUNT[how], left)) & (ids >> np.uint64(32) == 0)] = 15

    pos, ends, begins = first.copy(), np.minimum(first + BLOCK, m), np.zeros(m, bool)
    while len(pos):                                                        # one word of every block at a time
        begins[pos] = True
        sel = how[pos]
        step = _COUNT[sel]
        if run is not None:
            step = np.where(sel == 15, run[pos], step)
        pos = pos + step
        on = pos < ends
        if not on.all():
            pos, ends = pos[on], ends[on]
    start = np.flatnonzero(begins)
    block = start // BLOCK
    sel = how[start]
    words = sel.astype(np.uint64) << np.uint64(60)
    stop = np.minimum((block + 1) * BLOCK, m)
    for s in np.unique(sel).tolist():
        k = np.flatnonzero(sel == s)
        p = start[k]
        if s == 15:
            words[k] |= ids[p] | (run[p].astype(np.uint64) << np.uint64(32))
        elif s > 0:
            count, bits, end = int(_COUNT[s]), int(_BITS[s]), stop[k]
            word, full = words[k], p + count <= end
            for j in range(count):
                if full.all():
                    word |= ids[p + j] << np.uint64(j * bits)
                else:
                    there = p + j < end
                    word[there] |= ids[p[there] + j] << np.uint64(j * bits)
            words[k] = word
    escape = np.flatnonzero(sel == 0)
    raw_per = np.bincount(block[escape], minlength=len(first))
    base = np.cumsum(raw_per) - raw_per
    words[escape] |= (np.arange(len(escape)) - base[block[escape]]).astype(np.uint64)
    return words, ids[start[escape]], np.bincount(block, minlength=len(first)), raw_per


def unpack(words: np.ndarray, raw: np.ndarray, words_per: np.ndarray, raw_per: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; `lengths` are their numbers of ids."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.where(sel == 15, ((words >> np.uint64(32)) & np.uint64((1 << 28) - 1)).astype(np.int64), _COUNT[sel])
    block = np.repeat(np.arange(len(words_per)), words_per)
    last = np.cumsum(words_per) - 1
    over = np.bincount(block, counts, minlength=len(words_per)).astype(np.int64) - lengths
    counts[last] -= over                                                   # only a block's last word may be part empty
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(sel).tolist():
        rows = np.flatnonzero(sel == s)
        p, w, n = start[rows], words[rows], counts[rows]
        if s == 0:
            base = np.cumsum(raw_per) - raw_per
            out[p] = raw[base[block[rows]] + (w & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif s == 15:
            at = np.repeat(p - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out[at] = np.repeat(w & np.uint64(0xFFFFFFFF), n)
        else:
            mask = np.uint64((1 << int(_BITS[s])) - 1)
            for j in range(int(_COUNT[s])):
                there = n > j
                out[p[there] + j] = (w[there] >> np.uint64(j * int(_BITS[s]))) & mask
    return out


# ---- the files -----------------------------------------------------------------------------------------------

def _store(uri: str):
    """(file system, path) of a URI of the shared folder, as tasks reach it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


class TokenFile:
    """Writes one file: documents in, blocks out as they fill."""

    def __init__(self, folder: str, name: str) -> None:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        self.name, self.out = name, store.open_output_stream(f"{path}/{name}")
        self.out.write(MAGIC)
        self.at, self.n_ids, self.waiting, self.size = len(MAGIC), 0, [], 0
        self.offsets, self.words, self.raws, self.docs, self.nulls, self.counts = [], [], [], [], [], []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc or 0)
        self.nulls.append(doc is None)
        self.counts.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= BLOCK * GROUP:
            self._flush(BLOCK * GROUP)

    def _flush(self, least: int) -> None:
        """Code whole groups of blocks; with least = 0 the rest, too."""
        ids = np.concatenate(self.waiting)
        lo = 0
        while len(ids) - lo >= max(least, 1):
            part = ids[lo:lo + BLOCK * GROUP]
            words, raw, words_per, raw_per = pack(part)
            w0 = r0 = 0
            for w, r in zip(words_per.tolist(), raw_per.tolist()):
                self.offsets.append(self.at)
                self.words.append(w)
                self.raws.append(r)
                self.out.write(words[w0:w0 + w].astype("<u8").tobytes() + raw[r0:r0 + r].astype("<u8").tobytes())
                self.at += 8 * (w + r)
                w0, r0 = w0 + w, r0 + r
            lo += len(part)
        self.waiting, self.size = [ids[lo:]], len(ids) - lo

    def close(self) -> int:
        if self.size:
            self._flush(0)
        foot = self.at
        for values, kind in ((self.offsets, "<u8"), (self.words, "<u4"), (self.raws, "<u4"), (self.docs, "<i8"), (self.nulls, "u1"), (self.counts, "<i8")):
            raw = np.asarray(values, kind).tobytes()
            self.out.write(raw)
            self.at += len(raw)
        self.out.write(struct.pack(_TRAILER, foot, len(self.offsets), len(self.docs), self.n_ids, BLOCK, MAGIC))
        self.out.close()
        return self.at + struct.calcsize(_TRAILER)


def read_file(folder: str, name: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc id, offset in the file's ids, ids as uint32) of each document of a file, a group of blocks at a time."""
    store, path = _store(folder)
    with store.open_input_file(f"{path}/{name}") as f:
        size = f.size()
        f.seek(size - struct.calcsize(_TRAILER))
        foot, n_blocks, n_docs, n_ids, width, magic = struct.unpack(_TRAILER, f.read(struct.calcsize(_TRAILER)))
        if magic != MAGIC:
            raise ValueError(f"{folder}/{name} is not a whole token file")
        f.seek(foot)
        got = [np.frombuffer(f.read(n * np.dtype(k).itemsize), k)
               for n, k in ((n_blocks, "<u8"), (n_blocks, "<u4"), (n_blocks, "<u4"), (n_docs, "<i8"), (n_docs, "u1"), (n_docs, "<i8"))]
        offsets, words_per, raw_per, docs, nulls, counts = got[0].astype(np.int64), got[1].astype(np.int64), got[2].astype(np.int64), *got[3:]
        lengths = np.minimum(width, n_ids - width * np.arange(n_blocks))
        doc, start, held, have = 0, 0, [], 0
        for lo in range(0, n_blocks, GROUP):
            hi = min(lo + GROUP, n_blocks)
            f.seek(int(offsets[lo]))
            data = np.frombuffer(f.read(int(8 * (words_per[lo:hi] + raw_per[lo:hi]).sum())), "<u8")
            is_raw = np.repeat(np.tile([False, True], hi - lo), np.stack([words_per[lo:hi], raw_per[lo:hi]], axis=1).ravel())
            ids = unpack(data[~is_raw], data[is_raw], words_per[lo:hi], raw_per[lo:hi], lengths[lo:hi]).astype("<u4")
            held.append(ids)
            have += len(ids)
            while doc < n_docs and counts[doc] <= have:
                whole = np.concatenate(held) if len(held) > 1 else held[0]
                while doc < n_docs and counts[doc] <= len(whole):
                    yield (None if nulls[doc] else int(docs[doc])), start, whole[:counts[doc]]
                    whole, start, doc = whole[counts[doc]:], start + int(counts[doc]), doc + 1
                held, have = [whole], len(whole)
        while doc < n_docs:                                                # documents without ids at the end
            yield (None if nulls[doc] else int(docs[doc])), start, np.zeros(0, "<u4")
            doc += 1


# ---- the tokenizer -------------------------------------------------------------------------------------------

# kinds of bytes; characters on whose classes all Unicode versions agree are plain: \t, \n, \r, those from the space to ~, and
# the letters from U+00C0 to U+00FF (two bytes: C3, then 80 to BF but 97 and B7)
_SPACE, _WHITE, _OTHER, _LETTER, _DIGIT, _NONE = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58], _KIND[[9, 10, 13]], _KIND[32] = _DIGIT, _WHITE, _SPACE
_CONTROL = np.isin(np.arange(256), [*range(9), 11, 12, *range(14, 32), 127])
_SPECIAL = b"<|"             # begins every special token of the vocabulary
# the last two bytes of white space beyond U+007F
_WIDE = np.array([0xC285, 0xC2A0, 0x9A80, *range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF, 0x819F])


def odd_bytes(data: np.ndarray) -> np.ndarray:
    """Where bytes of characters stand that are not plain, and where special tokens may begin."""
    odd = [np.flatnonzero(_CONTROL[data]) if data.min(initial=32) < 32 or (data == 127).any() else np.zeros(0, np.int64)]
    high = np.flatnonzero(data >= 128)
    if len(high):
        byte, follows = data[high], np.diff(high, prepend=-2) == 1
        second = np.zeros(len(high), bool)
        second[1:] = follows[1:] & (byte[:-1] == 0xC3) & (byte[1:] < 0xC0) & (byte[1:] != 0x97) & (byte[1:] != 0xB7)
        odd.append(high[~(second | np.append(second[1:], False))])
    mark = np.flatnonzero(data[:-1] == _SPECIAL[0])
    odd.append(mark[data[mark + 1] == _SPECIAL[1]])
    return np.sort(np.concatenate(odd))


def token_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where pre-tokens start, is it one whole piece for the library) in the texts of a UTF-8 buffer.

    A piece starts with its text and at each space that follows a character other than white space: no pre-token runs
    across one.  Pieces with characters that are not plain, or with a special token, are not cut further.
    """
    n = len(data)
    full = offsets[1:] > offsets[:-1]
    begin, end = offsets[:-1][full], offsets[1:][full]
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    kind = _KIND[data]
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[begin], after[end - 1] = _NONE, _WHITE
    # white space: its run's first, and its last before anything else; the rest: another kind starts, or the space before it did
    white = kind <= _WHITE
    start = (before > _WHITE) | (after > _WHITE)
    start &= white
    start |= (kind != before) & (before != _SPACE) & ~white
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[start[quote]]
    if len(quote):                                                         # 's 't 'm 'd 're 've 'll
        stop = end[np.searchsorted(end, quote, side="right")]
        one = np.where(quote + 1 < stop, data[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < stop, data[np.minimum(quote + 2, n - 1)], 0)
        size = np.where(np.isin(one, list(b"stmd")), 2, 0)
        size[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))] = 3
        quote, size, stop = quote[size > 0], size[size > 0], stop[size > 0]
        start[quote + 1] = False
        start[(quote + size)[quote + size < stop]] = True
    odd = odd_bytes(data)
    if not len(odd):
        at = np.flatnonzero(start)
        return at, np.zeros(len(at), bool)
    piece = (kind == _SPACE) & (before > _WHITE)
    at = odd[odd + 1 < n] + 1                                             # white space that is not plain
    at = at[piece[at]]
    pair = data[np.maximum(at - 2, 0)].astype(np.int64) << 8 | data[at - 1]
    piece[at[(data[at - 1] < 128) | np.isin(pair, _WIDE)]] = False
    piece[begin] = True
    start |= piece
    at, pieces = np.flatnonzero(start), np.flatnonzero(piece)
    whole = np.zeros(len(pieces), bool)
    whole[np.searchsorted(pieces, odd, side="right") - 1] = True
    first = piece[at]
    whole = whole[np.cumsum(first) - 1]
    held = first | ~whole
    return at[held], whole[held]


def byte_symbols() -> dict[int, str]:
    """The character by which byte-level BPE writes a byte: itself if it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


@remembered(2)
def buffer_encoder(path: str, special_as_text: bool):
    """A function: UTF-8 buffer and offsets of texts -> (all ids, ids per text), through a bounded cache of pre-tokens.
    Each distinct pre-token of the buffer is looked up once; those not known go to the library's model together."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"                         # one thread a task
    from array import array

    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    model = Tokenizer(tokenizer.model)                                     # takes pre-tokens, line by line
    model.pre_tokenizer = CharDelimiterSplit("\n")
    symbols = np.array([ord(c) for _, c in sorted(byte_symbols().items())], "<u2")
    symbols[0xFF] = ord("\n")                                              # no byte of UTF-8, no symbol of another byte
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    lengths = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)
    for token, i in vocab.items():
        lengths[i] = len(token)
    young: dict[bytes, bytes] = {}
    old: dict[bytes, bytes] = {}

    def merged(tokens: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, by the library's merges: ids belong to a pre-token up to its number of symbols."""
        out = []
        for lo in range(0, len(tokens), LINES):
            part = tokens[lo:lo + LINES]
            lines = symbols[np.frombuffer(b"\xff".join(part), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(model.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
            held = np.append(0, np.cumsum(lengths[ids]))
            ends = np.append(0, np.cumsum(np.fromiter(map(len, part), np.int64, len(part))))
            cut = np.minimum(np.searchsorted(held, ends), len(ids))
            if held[-1] != ends[-1] or (held[cut] != ends).any():
                raise ValueError(f"{path} does not write every byte as a symbol of its own")
            flat, cut = ids.tobytes(), (4 * cut).tolist()
            out += [flat[a:b] for a, b in zip(cut, cut[1:])]
        return out

    def whole(pieces: list[bytes]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def ids_of(tokens: list[bytes], is_whole: np.ndarray) -> list[bytes]:
        got = list(map(young.get, tokens))
        asked = [i for i, g in enumerate(got) if g is None]
        for i in asked:
            got[i] = old.get(tokens[i])
        unknown = [i for i in asked if got[i] is None]
        for way, which in ((merged, [i for i in unknown if not is_whole[i]]), (whole, [i for i in unknown if is_whole[i]])):
            for i, ids in zip(which, way([tokens[i] for i in which])):
                got[i] = ids
        for i in asked:
            if len(tokens[i]) <= 64:                                       # longer ones are rare and large
                young[tokens[i]] = got[i]
        return got

    def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nonlocal young, old
        starts, is_whole = token_starts(data, offsets)
        bounds = np.append(starts, len(data)).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        which = tokens.indices.to_numpy()
        keys, key_offsets = text_buffer(tokens.dictionary)
        keys, cut = keys.tobytes(), key_offsets.tolist()
        odd = np.zeros(len(tokens.dictionary), bool)
        odd[which[is_whole]] = True
        got = ids_of([keys[a:b] for a, b in zip(cut, cut[1:])], odd)
        pool, held = np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), np.int64, len(got)) // 4
        count = held[which]
        ends = np.cumsum(count)
        ids = pool[np.repeat((np.cumsum(held) - held)[which] - (ends - count), count) + np.arange(count.sum())]
        if len(young) > CACHE:
            young, old = {}, young
        return ids, np.diff(np.append(0, ends)[np.searchsorted(starts, offsets)])

    return encode


@remembered(2)
def piece_encoder(path: str, special_as_text: bool):
    """A function: list of texts -> list of ids (little-endian uint32 bytes)."""
    encode = buffer_encoder(path, special_as_text)

    def listed(texts: list[str]) -> list[bytes]:
        ids, counts = encode(*text_buffer(pa.array(texts, pa.large_string())))
        cut = np.append(0, np.cumsum(counts)).tolist()
        return [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]

    return listed


# ---- on Spark ------------------------------------------------------------------------------------------------

_MANIFEST = "name string, pid int, seq int, local_start long, n_docs long, n_ids long, n_bytes long"


def _writer(folder: str, path: str, end_id: int, file_ids: int, special_as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        encode, file, seq, before = None, None, 0, 0

        def closed():
            size = file.close()
            return pa.RecordBatch.from_pylist([{"name": file.name, "pid": pid, "seq": seq, "local_start": before, "n_docs": len(file.docs),
                                                "n_ids": file.n_ids, "n_bytes": size}], schema=_SCHEMA)

        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text", SLICE):
                encode = encode or buffer_encoder(path, special_as_text)
                ids, counts = encode(data, offsets)
                cut = np.append(0, np.cumsum(counts))
                ids, cut = np.insert(ids, cut[1:], end_id), (cut + np.arange(len(cut))).tolist()
                for doc, lo, hi in zip(rows.column(0).to_pylist(), cut, cut[1:]):
                    file = file or TokenFile(folder, f"part-{pid:05d}-{seq:05d}-{attempt}.s8b")
                    file.add(doc, ids[lo:hi])
                    if file.n_ids >= file_ids:
                        yield closed()
                        before, seq, file = before + file.n_ids, seq + 1, None
        if file is not None:
            yield closed()
    return run


_SCHEMA = pa.schema([("name", pa.string()), ("pid", pa.int32()), ("seq", pa.int32()), ("local_start", pa.int64()),
                     ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def write(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
          file_ids: int = FILE_IDS, special_as_text: bool = False) -> tuple[DataFrame, str]:
    """Encode, pack and write all documents in ascending order of id; (manifest, folder)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(width, F.asc_nulls_first("id"), "h").sortWithinPartitions(F.asc_nulls_first("id"), "h", "text")
    made = ranged.select("id", "text").mapInArrow(tidy(_writer(folder, path, end_id, file_ids, special_as_text)), _MANIFEST)
    return materialise(made, "token-manifest"), folder


def _reader(folder: str, base: dict[int, int], id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                                              names=[id_col, "start", "ids"])
        for batch in batches:
            for row in batch.to_pylist():
                docs, starts, ids, size = [], [], [], 0
                first = base[row["pid"]] + row["local_start"]
                for doc, start, got in read_file(folder, row["name"]):
                    docs.append(doc)
                    starts.append(first + start)
                    ids.append(got.tobytes())
                    size += 4 * len(got) + 100
                    if size > 4 << 20:
                        yield out()
                        docs, starts, ids, size = [], [], [], 0
                if docs:
                    yield out()
    return run


def read(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files of a manifest: id, start (ids of all documents before it), ids (uint32, little-endian)."""
    sums = manifest.groupBy("pid").agg(F.sum("n_ids").alias("n")).orderBy("pid").collect()     # one row per writing task
    base, total = {}, 0
    for r in sums:
        base[r["pid"]], total = total, total + r["n"]
    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = manifest.select("pid", "seq", "name", "local_start").repartitionByRange(width, "pid", "seq")
    return names.mapInArrow(tidy(_reader(folder, base, id_col)), f"`{id_col}` long, start long, ids binary")


__all__ = ["TokenFile", "buffer_encoder", "pack", "piece_encoder", "read", "read_file", "token_starts", "unpack", "write"]
