"""Quality scores by Bradley-Terry pairwise ranking.

A document's worth is w . x of its features; the chance that document a is preferred to b is
sigmoid(w . (x_a - x_b)).  Preference pairs come from the labels: a document labelled 1 is
preferred to one labelled 0.  The logistic loss on the feature differences is minimised by
Newton steps.  Scores are thresholded by quantile: the raw score at the quantile that the
labels give the lower class is mapped to `threshold`, so that predicted = score >= threshold.

Features are computed on whole texts, vectorised over batches.  The fit reads a bounded sample
of the labelled documents (`SAMPLE`, chosen by a hash of the id) and of the pairs (`PAIRS`).

Defined cases: null or empty text has all-zero features and still gets a score; without both
labels in the sample every score is 0.5.  Rows with a null id and rows that repeat are scored like any other row;
labels of null ids are ignored, and of several labels of an id the largest counts; an empty table gives no rows.  Texts
are read whole, however long.  Columns are taken by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import segment_sums, span_hashes, text_slices

SAMPLE = 12_000              # labelled documents (documented bound of the fit)
PAIRS = 60_000               # preference pairs drawn from them
THRESHOLD = 0.3
BUCKETS = 64                 # hashed byte bigrams of symbols

_CLASS = np.zeros(256, np.uint8)     # 0 other symbol, 1 lower, 2 upper, 3 digit, 4 space, 5 newline, 6 high byte, 7 plain punctuation
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[0x20, 0x09]] = 4
_CLASS[[0x0A, 0x0D, 0x0B, 0x0C]] = 5
_CLASS[0x80:] = 6
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 7


def _words(data: np.ndarray, cls: np.ndarray, begins: np.ndarray):
    """Start and end of every word (a run without white space inside one document)."""
    word = (cls != 4) & (cls != 5)
    first = word.copy()
    first[1:] &= ~word[:-1] | begins[1:len(word)]
    last = word.copy()
    last[:-1] &= ~word[1:] | begins[1:len(word)]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


NAMES = ["log_bytes", "lower", "upper", "digit", "space", "newline", "high", "punct", "symbol", "mean_word", "long_word",
         "short_word", "distinct", "same_as_before", "top_repeat", "upper_words", "symbol_words", "line_len", "distinct_lines",
         "stops", "sentence", "caps_start"]


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature matrix of the documents of a buffer."""
    n = len(off) - 1
    length = (off[1:] - off[:-1]).astype(np.float64)
    some = np.maximum(length, 1.0)
    x = np.zeros((n, len(NAMES) + BUCKETS))
    if len(data) == 0:
        return x
    cls = _CLASS[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[off] = True
    x[:, 0] = np.log1p(length)
    for j, k in enumerate((1, 2, 3, 4, 5, 6, 7, 0)):
        x[:, 1 + j] = segment_sums(cls == k, off) / some
    s, e = _words(data, cls, begins)
    if len(s):
        wo = np.searchsorted(s, off)
        count = np.maximum(1, wo[1:] - wo[:-1]).astype(np.float64)
        size = e - s
        x[:, 9] = segment_sums(size, wo) / count / 10.0
        x[:, 10] = segment_sums(size > 20, wo) / count
        x[:, 11] = segment_sums(size <= 2, wo) / count
        h = span_hashes(data, s, e)
        doc = np.repeat(np.arange(n), wo[1:] - wo[:-1])
        order = np.lexsort((h, doc))
        hs, ds = h[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        x[:, 12] = segment_sums(new, wo) / count
        runs = np.diff(np.append(np.flatnonzero(new), len(hs)))
        most = np.zeros(n)
        np.maximum.at(most, ds[new], runs)
        x[:, 14] = most / count
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        x[:, 13] = segment_sums(same, wo) / count
        kinds = np.zeros(len(data) + 1, np.int64)
        np.cumsum(cls == 2, out=kinds[1:])
        up = kinds[e] - kinds[s]
        x[:, 15] = segment_sums((up > 1) & (2 * up >= size), wo) / count
        np.cumsum(cls == 0, out=kinds[1:])
        x[:, 16] = segment_sums((kinds[e] - kinds[s]) > 0, wo) / count
        x[:, 21] = segment_sums(cls[s] == 2, wo) / count
        x[:, 20] = segment_sums(data[e - 1] == ord("."), wo) / count
        x[:, 19] = segment_sums(size <= 4, wo) / count
    lines = np.flatnonzero((cls == 5) | begins[1:])
    lo = np.searchsorted(lines, off)
    per = np.maximum(1, lo[1:] - lo[:-1]).astype(np.float64)
    x[:, 17] = np.log1p(length / per) / 10.0
    ls = np.concatenate([[0], lines[:-1] + 1])
    lh = span_hashes(data, np.minimum(ls, lines + 1), lines + 1)
    ld = np.repeat(np.arange(n), lo[1:] - lo[:-1])
    order = np.lexsort((lh, ld))
    new = np.ones(len(lh), bool)
    new[1:] = (lh[order][1:] != lh[order][:-1]) | (ld[order][1:] != ld[order][:-1])
    x[:, 18] = segment_sums(new, lo) / per
    at = np.flatnonzero((cls == 0) | (cls == 3))
    doc = np.searchsorted(off, at, side="right") - 1
    cell = doc * BUCKETS + (data[at].astype(np.int64) * 37 + (cls[np.maximum(at - 1, 0)] == cls[at]) * 11) % BUCKETS
    x[:, len(NAMES):] = np.sqrt(np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS) / some[:, None])
    return x


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float                 # raw score that is mapped to the threshold
    slope: float
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) / self.scale) @ self.weights
        z = np.clip(self.slope * (raw - self.cut) + np.log(self.threshold / (1 - self.threshold)), -40, 40)
        return 1.0 / (1.0 + np.exp(-z))


def bradley_terry(diff: np.ndarray, l2: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights that minimise mean log(1 + exp(-w . d)) + l2 |w|^2 / 2 over the rows d of `diff`."""
    n, d = diff.shape
    w = np.zeros(d)
    loss = lambda v: np.logaddexp(0.0, -(diff @ v)).mean() + 0.5 * l2 * v @ v
    now = loss(w)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(np.clip(diff @ w, -40, 40)))
        grad = -(diff * p[:, None]).mean(axis=0) + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / n + (l2 + 1e-9) * np.eye(d)
        step, t = np.linalg.solve(hess, grad), 1.0
        while (new := loss(w - t * step)) > now and t > 1e-6:
            t /= 2
        w, done = w - t * step, now - new < 1e-9
        now = new
        if done:
            break
    return w


def train(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, threshold: float = THRESHOLD, seed: int = 7) -> Model:
    """Fit on feature rows with labels 0/1: draw preference pairs, rank, then place the quantile cut."""
    d = x.shape[1]
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), np.log(threshold / (1 - threshold)), 1.0, threshold)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    a, b = rng.choice(good, pairs), rng.choice(bad, pairs)
    w = bradley_terry(z[a] - z[b])
    raw = z @ w
    order = np.sort(raw)
    # quantile cut: of the quantiles around the labels' own share of zeros, the one with the fewest wrong labels
    share = len(bad) / len(y)
    tries = np.unique(np.clip(np.linspace(0.4 * share, min(1.0, 1.6 * share), 121), 0, 1))
    cuts = np.quantile(order, tries)
    wrong = [np.mean((raw >= c) != (y == 1)) + 1e-6 * abs(q - share) for c, q in zip(cuts, tries)]
    spread = float(np.std(raw)) or 1.0
    return Model(mean, scale, w, float(cuts[int(np.argmin(wrong))]), 2.0 / spread, threshold)


def sample_ids(labels: DataFrame, label_col: str, id_col: str, bound: int) -> DataFrame:
    """At most `bound` labelled ids with their label, the smallest by a hash of the id; one row per id."""
    return (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("__t_key")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
            .orderBy(F.xxhash64(F.col("__t_key")), F.col("__t_key")).limit(bound))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, off in text_slices(batch, "text"):
            x = features(data, off)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, threshold: float = THRESHOLD, pairs: int = PAIRS) -> Model:
    """Learn from at most `sample` labelled documents and `pairs` preference pairs drawn among them; only their feature
    rows reach the driver.  Rows that repeat an id count once: the smallest text."""
    ids = F.broadcast(sample_ids(labels, label_col, id_col, sample))      # at most `sample` ids
    rows = docs.select(F.col(id_col).alias("__t_id"), F.col(text_col).alias("text")).join(
        ids, F.col("__t_id") == F.col("__t_key")).groupBy("__t_key", "label").agg(F.min("text").alias("text")).select("label", "text").mapInArrow(_feature_rows, "label int, x binary")
    got = rows.toPandas()
    if not len(got):
        return train(np.zeros((0, len(NAMES) + BUCKETS)), np.zeros(0))
    x = np.frombuffer(b"".join(got["x"]), np.float64).reshape(len(got), -1)
    order = np.lexsort((*x.T[:6], got["label"].to_numpy()))               # the same fit whatever the row order
    return train(x[order], got["label"].to_numpy()[order], pairs, threshold)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1) and predicted (score >= the model's threshold)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                s = model.score(features(data, off))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(s), pa.array((s >= model.threshold).astype(np.int32))],
                    names=["id", "score", "predicted"])

    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
