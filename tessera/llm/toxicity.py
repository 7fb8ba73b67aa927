"""Toxicity by Levenshtein automata intersected with a lexicon trie.

The lexicon holds whole words and stems (word beginnings) whose document frequency under label 1
exceeds that under label 0 many times over.  The Levenshtein automaton of the lexicon - all its
words within one edit, short words and stems exactly - is intersected with the trie and
determinised into one transition table over code points; a word's edits and entry are read off the
state in which it ends.  All words of a batch walk the table together, one code point per step,
and drop out where the table has no way on.

Each hit is then seen in its context window: a hit between quotation marks that open before and
close after it within the window counts as quoted, the others as abuse, and hits that stand close
together count as a cluster.  A logistic regression on these context scores gives the document's
score, placed so that `threshold` is the training sample's best cut by F1.

The fit reads at most SAMPLE documents of each label (chosen by a hash of the id); whole texts are
scored.  Defined cases: null and empty texts have no hit and get the score of a text without hits;
without both labels the lexicon is empty and every score is the share of label 1.  Rows with a null id and rows
that repeat are scored like any other row; labels of null ids are ignored, and of several labels of an id the largest
counts; an empty table gives no rows.  Texts are scored whole, however long.  Columns are taken by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import LETTER, class_array
from tessera.llm.common import segment_sums, text_slices
from tessera.llm.langid import lowered

SAMPLE = 4_000               # labelled documents of each label (documented bound of the fit)
TERMS = 512                  # lexicon entries, the most telling ones
LONGEST = 40                 # letters of a lexicon term
THRESHOLD = 0.3
MIN_DOCS, MIN_RATIO = 4, 25.0
STEM_LENGTHS, STEM_DOCS = (4, 5, 6), 5
FUZZY_FROM = 5               # words of at least so many letters may have one edit
WINDOW = 12                  # words on each side of a hit
QUOTES = "\"“”„«»‹›"


# ---------------------------------------------------------------- the automaton

@dataclass
class Automaton:
    symbols: np.ndarray        # code point -> symbol (0: not in the lexicon)
    table: np.ndarray          # (states, symbols) -> state; 0 is the sink, 1 the start
    edits: np.ndarray          # per state: 0 exact, 1 one edit, 9 no entry ends here
    weight: np.ndarray         # per state: the entry's weight
    stem: np.ndarray           # per state: an entry with an open end

    def run(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The state in which each word (a span of lower-cased code points) ends."""
        sym = self.symbols[points]
        flat, width = self.table.ravel(), self.table.shape[1]
        final = np.zeros(len(starts), np.int64)
        live, state, at, stop = np.arange(len(starts)), np.ones(len(starts), np.int64), starts.copy(), ends
        while len(live):
            state = flat[state * width + sym[at]].astype(np.int64)
            at = at + 1
            done = (at >= stop) & (state > 0)
            if done.any():
                final[live[done]] = state[done]
            more = (state > 0) & ~done
            live, state, at, stop = live[more], state[more], at[more], stop[more]
        return final


def build(entries: list[tuple[str, bool, float]]) -> Automaton:
    """Determinise trie x Levenshtein automaton for (word, open_end, weight) entries."""
    children: list[dict[str, int]] = [{}]
    word_at: dict[int, float] = {}
    stem_at: dict[int, float] = {}
    reach = [0]                                            # does an entry below allow an edit
    for word, open_end, weight in entries:
        node, path = 0, [0]
        for ch in word:
            if ch not in children[node]:
                children[node][ch] = len(children)
                children.append({})
                reach.append(0)
            node = children[node][ch]
            path.append(node)
        if open_end:
            stem_at[node] = weight
        else:
            word_at[node] = weight
            if len(word) >= FUZZY_FROM:
                for p in path:
                    reach[p] = 1
    depth_ok = {n for n in word_at if reach[n]}
    alphabet = sorted({ch for kids in children for ch in kids})
    number = {ch: i + 1 for i, ch in enumerate(alphabet)}

    def close(found: set[tuple[int, int]]) -> frozenset:
        """Deletions of a lexicon letter cost no input; a stem that was reached stays reached (marked by -1 - node)."""
        for node, e in list(found):
            if node >= 0 and e == 0:
                found.update((kid, 1) for kid in children[node].values() if reach[kid])
        found.update((-1 - node, 0) for node, e in list(found) if node >= 0 and e == 0 and node in stem_at)
        return frozenset(found)

    def step(state: frozenset, ch: str | None) -> frozenset:
        out = set()
        for node, e in state:
            if node < 0:
                out.add((node, e))
                continue
            kids = children[node]
            if ch in kids and (e == 0 or reach[kids[ch]]):
                out.add((kids[ch], e))
            if e == 0 and reach[node]:
                out.add((node, 1))
                out.update((kid, 1) for kid in kids.values() if reach[kid])
        return close(out) if out else frozenset()

    start = close({(0, 0)})
    index = {frozenset(): 0, start: 1}
    rows, todo = [[0] * (len(alphabet) + 1)], [start]
    at = 0
    while at < len(todo):
        state = todo[at]
        at += 1
        relevant = {ch for node, _ in state if node >= 0 for ch in children[node]}
        relevant |= {ch for node, e in state if node >= 0 and e == 0 for kid in children[node].values() for ch in children[kid]}
        other = step(state, None)
        row = [None] * (len(alphabet) + 1)
        for ch in [None, *relevant]:
            nxt = other if ch is None else step(state, ch)
            if nxt not in index:
                index[nxt] = len(index)
                todo.append(nxt)
            row[number.get(ch, 0)] = index[nxt]
        rest = row[0]
        rows.append([rest if v is None else v for v in row])
    states = [frozenset(), *todo]
    edits, weight, stem = np.full(len(states), 9), np.zeros(len(states)), np.zeros(len(states), bool)
    for i, state in enumerate(states):
        best = [(e, -word_at[n], False) for n, e in state if n >= 0 and n in word_at and (e == 0 or n in depth_ok)]
        best += [(0, -stem_at[-1 - n], True) for n, _ in state if n < 0]
        if best:
            e, w, s = min(best)
            edits[i], weight[i], stem[i] = e, -w, s
    symbols = np.zeros(0x110000, np.int64)
    for ch, i in number.items():
        symbols[ord(ch)] = i
    return Automaton(symbols, np.array(rows, np.int32), edits, weight, stem)


# ---------------------------------------------------------------- context scores

def words_of(data: np.ndarray, off: np.ndarray):
    """Code points, document offsets in them, and the letter runs as (start, end)."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    poff = off if len(points) == len(data) else np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), off)
    if len(points) == 0:
        return points, poff, np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = class_array()[points] == LETTER
    edge = np.zeros(len(points) + 1, bool)
    edge[poff] = True
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:-1]
    last[:-1] &= ~letter[1:] | edge[1:-1]
    return points, poff, np.flatnonzero(first), np.flatnonzero(last) + 1


FEATURES = 11


def context_scores(auto: Automaton, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature row per document, from hits and their context windows."""
    n = len(off) - 1
    x = np.zeros((n, FEATURES))
    points, poff, s, e = words_of(data, off)
    if not len(s):
        return x
    woff = np.searchsorted(s, poff)
    words = (woff[1:] - woff[:-1]).astype(np.float64)
    x[:, 8] = np.log1p(words)
    state = auto.run(points, s, e)
    hit = np.flatnonzero(auto.edits[state] < 9)
    if not len(hit):
        return x
    doc = np.searchsorted(woff, hit, side="right") - 1
    st = state[hit]
    # the window of a hit: WINDOW words each way, inside its document
    lo = s[np.maximum(hit - WINDOW, woff[doc])]
    hi = e[np.minimum(hit + WINDOW, woff[doc + 1] - 1)]
    quote = np.isin(points, [ord(c) for c in QUOTES])
    marks = np.zeros(len(points) + 1, np.int64)
    np.cumsum(quote, out=marks[1:])
    before, after = marks[s[hit]] - marks[lo], marks[hi] - marks[e[hit]]
    quoted = (before % 2 == 1) & (after >= 1)
    exact, stem = (auto.edits[st] == 0) & ~auto.stem[st], auto.stem[st]
    fuzzy = auto.edits[st] == 1
    for j, kind in enumerate((exact & ~quoted, stem & ~quoted, fuzzy & ~quoted, exact & quoted, stem & quoted, fuzzy & quoted)):
        x[:, j] = np.log1p(np.bincount(doc[kind], minlength=n))
    sure = hit[~fuzzy & ~quoted]
    sdoc = doc[~fuzzy & ~quoted]
    if len(sure):
        near = np.searchsorted(sure, np.minimum(sure + WINDOW, woff[sdoc + 1] - 1), side="right") - np.arange(len(sure))
        np.maximum.at(x[:, 6], sdoc, near.astype(np.float64))
        x[:, 6] = np.log1p(x[:, 6])
        x[:, 7] = np.minimum(1.0, np.bincount(sdoc, minlength=n) / np.maximum(1.0, words) * 20)
        x[:, 9] = np.log1p(np.bincount(sdoc, weights=auto.weight[st][~fuzzy & ~quoted], minlength=n))
        x[:, 10] = x[:, 0] + x[:, 1] > 0
    return x


@dataclass
class Model:
    auto: Automaton
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    threshold: float

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = ((context_scores(self.auto, data, off) - self.mean) / self.scale) @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 30) -> tuple[np.ndarray, float]:
    z = np.column_stack([x, np.ones(len(x))])
    w, reg = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], l2), 1e-9)
    loss = lambda v: (weight * (np.logaddexp(0.0, z @ v) - y * (z @ v))).sum() / weight.sum() + 0.5 * (reg * v * v).sum()
    now = loss(w)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - y)) / weight.sum() + reg * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z / weight.sum() + np.diag(reg + 1e-9)
        step, t = np.linalg.solve(hess, grad), 1.0
        while (new := loss(w - t * step)) > now and t > 1e-6:
            t /= 2
        w, done = w - t * step, now - new < 1e-10
        now = new
        if done:
            break
    return w[:-1], float(w[-1])


def place(score_raw: np.ndarray, y: np.ndarray, weight: np.ndarray, threshold: float) -> float:
    """Shift that puts the weighted best-F1 cut of the raw scores at `threshold`."""
    order = np.argsort(-score_raw, kind="stable")
    r, yy, ww = score_raw[order], y[order], weight[order]
    tp = np.cumsum(ww * yy)
    f1 = 2 * tp / np.maximum(np.cumsum(ww) + (ww * yy).sum(), 1e-12)
    f1[:-1][r[:-1] == r[1:]] = -1
    i = int(np.argmax(f1))
    cut = (r[i] + (r[i + 1] if i + 1 < len(r) else r[i] - 1)) / 2
    return float(np.log(threshold / (1 - threshold)) - cut)


# ---------------------------------------------------------------- fit and score

def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts by label of words and word beginnings, per batch."""
    for batch in batches:
        count: dict[tuple[str, bool], list[int]] = {}
        for rows, data, off in text_slices(lowered(batch, "text"), "text"):
            labels = rows.column(0).to_pylist()
            points, poff, s, e = words_of(data, off)
            text, woff = points.astype("<u4").tobytes().decode("utf-32-le"), np.searchsorted(s, poff).tolist()
            s, e = s.tolist(), e.tolist()
            for d, y in enumerate(labels):
                words = {text[a:b] for a, b in zip(s[woff[d]:woff[d + 1]], e[woff[d]:woff[d + 1]])}
                words = {w for w in words if len(w) <= LONGEST}
                terms = {(w, False) for w in words}
                for k in STEM_LENGTHS:
                    terms |= {(w[:k], True) for w in words if len(w) > k}
                for t in terms:
                    c = count.get(t)
                    if c is None:
                        c = count[t] = [0, 0]
                    c[y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([t[0] for t in count], pa.string()), pa.array([t[1] for t in count], pa.bool_()),
             pa.array([c[0] for c in count.values()], pa.int64()), pa.array([c[1] for c in count.values()], pa.int64())],
            names=["term", "stem", "n0", "n1"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, threshold: float = THRESHOLD, max_terms: int = TERMS) -> Model:
    """Learn lexicon and weights from at most `sample` documents of each label (rows that repeat an id count once: the
    smallest text).

    Bounds of the fit: the lexicon holds the `max_terms` terms of most toxic documents, none longer than LONGEST letters.
    Scoring has no such bounds: every word of every text runs through the automaton.
    """
    one = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("__t_key")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    share = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64(F.col("__t_key")), F.col("__t_key")]
    ids = one.where("label = 0").orderBy(*by_hash).limit(sample).unionByName(one.where("label = 1").orderBy(*by_hash).limit(sample))
    picked = docs.select(F.col(id_col).alias("__t_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), F.col("__t_id") == F.col("__t_key")).groupBy("__t_key", "label").agg(F.min("text").alias("text")).select("label", "text")   # at most 2 * sample ids
    sizes = {r["label"]: r["n"] for r in picked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        p = min(max(share.get(1, 0) / max(1, sum(share.values())), 1e-6), 1 - 1e-6)
        return Model(build([]), np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), float(np.log(p / (1 - p))), threshold)
    ratio = (F.col("n1") / n1) / ((F.col("n0") + 0.5) / n0)
    terms = (picked.mapInArrow(_term_rows, "term string, stem boolean, n0 long, n1 long").groupBy("term", "stem")
             .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).withColumn("ratio", ratio)
             .where((F.col("n1") >= F.when(F.col("stem"), max(STEM_DOCS, n1 // 160)).otherwise(MIN_DOCS)) & (F.col("ratio") >= MIN_RATIO / F.least(
                 F.lit(4.0), F.greatest(F.lit(1.0), 8.0 / F.col("n1")))))
             .orderBy(F.desc("n1"), "term", "stem").limit(max_terms).select("term", "stem", "ratio").collect())
    auto = build([(r["term"], r["stem"], float(np.log(r["ratio"]))) for r in sorted(terms)])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(lowered(batch, "text"), "text"):
                x = context_scores(auto, data, off)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    got = picked.mapInArrow(rows_of, "label int, x binary").toPandas()
    x, y = np.frombuffer(b"".join(got["x"]), np.float64).reshape(len(got), -1), got["label"].to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))                          # the same fit whatever the row order
    x, y = x[order], y[order]
    weight = np.where(y == 1, share[1] / n1, share[0] / n0)
    weight = weight / weight.mean()
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    w, b = logistic((x - mean) / scale, y, weight)
    b += place(((x - mean) / scale) @ w + b, y, weight, threshold)
    return Model(auto, mean, scale, w, b, threshold)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1) and predicted (score >= the model's threshold)."""
    kind = docs.schema[id_col].dataType.simpleString()
    # a table of a few MB, bounded by TERMS; as bytes, so that the model's class travels by value
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = cloudpickle.loads(held.value)
        for batch in batches:
            for rows, data, off in text_slices(lowered(batch, "text"), "text"):
                s = m.score(data, off)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(s), pa.array((s >= m.threshold).astype(np.int32))],
                                                 names=["id", "score", "predicted"])

    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
