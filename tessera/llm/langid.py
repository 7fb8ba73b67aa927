"""Language identification with bit-sliced Bloom filters of n-grams.

One filter per language, stored bit-sliced: a slot holds one bit per language, so the AND of an
n-gram's slots is the bitmask of all languages whose filter contains it.  Per document and
language the masks' bits are counted, the count is corrected for the filter's false positives
(hits - n * fp) / (1 - fp), and the largest corrected count decides.

An n-gram is four consecutive bytes of the lower-cased text in which everything but letters is
a space.  A language's filter holds the n-grams that are characteristic of it: seen at least
`min_count` times in its sample, with at least `ratio` of the highest relative frequency that any
language gives them.

Defined cases: `und` with score 0 if the text is null or has no letter, or if nothing was learned;
a text with letters but no known n-gram gets the language with most training documents, score 0;
ties go to the language that sorts first.  Whole texts are read, however long.  Rows with a null id and rows that
repeat are predicted like any other row (in the fit a row with a null id is left out); an empty table gives no rows, and
a fit on it a model that knows nothing.  Columns are taken by name, others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise, mix64, segment_sums, text_buffer, text_slices, tidy

UND = "und"
SAMPLE_PER_LANG = 1500       # expected training documents per language (documented bound of the fit)
GRAMS_PER_LANG = 200_000     # n-grams per filter, the most frequent ones
GRAMS = 2_000_000            # n-grams of all filters together
HASHES = 3
BITS_PER_GRAM = 16


def _letter_table() -> np.ndarray:
    t = np.full(256, 0x20, np.uint8)
    t[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


LETTERS = _letter_table()


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as uint32, their document offsets): windows of four bytes within a document, at most two spaces."""
    b = LETTERS[data]
    if len(b) < 4:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    w = b.astype(np.uint32)
    g = (w[:-3] << 24) | (w[1:-2] << 16) | (w[2:-1] << 8) | w[3:]
    space = (b == 0x20).astype(np.uint8)
    ok = (space[:-3] + space[1:-2] + space[2:-1] + space[3:]) <= 2
    for k in (1, 2, 3):                                    # windows that would cross a document's end
        edge = offsets[1:-1] - k
        ok[edge[(edge >= 0) & (edge < len(ok))]] = False
    before = np.zeros(len(ok) + 1, np.int64)
    np.cumsum(ok, out=before[1:])
    return g[ok], before[np.minimum(offsets, len(ok))]


def lowered(batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
    i = batch.schema.get_field_index(column)
    return batch.set_column(i, column, pc.utf8_lower(batch.column(i)))


@dataclass
class Model:
    langs: list[str]
    masks: np.ndarray          # uint64[words, slots]: bit l % 64 of word l // 64 = language l
    false_rate: np.ndarray     # per language: chance that a foreign n-gram passes its filter
    prior: int                 # language with most training documents

    def lookup(self, g: np.ndarray) -> list[np.ndarray]:
        """Per word of 64 languages: the bitmask of the languages that contain each n-gram."""
        slots = np.uint64(self.masks.shape[1] - 1)
        out: list[np.ndarray] = []
        x = mix64(g.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for h in range(HASHES):
            at = ((x >> np.uint64(20 * h)) & slots).astype(np.int64)
            for w in range(len(self.masks)):
                m = self.masks[w][at]
                if h == 0:
                    out.append(m)
                else:
                    out[w] &= m
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected counts per document and language."""
        g, off = grams(data, offsets)
        n = (off[1:] - off[:-1]).astype(np.float64)
        out = np.zeros((len(n), len(self.langs)))
        masks = self.lookup(g)
        for i in range(len(self.langs)):
            bit = ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.uint8)
            fp = self.false_rate[i]
            out[:, i] = np.maximum(0.0, (segment_sums(bit, off) - n * fp) / (1.0 - fp))
        return out


def build(langs: list[str], sets: list[np.ndarray], prior: int) -> Model:
    """Fill the bit-sliced filters from one n-gram set per language."""
    most = max((len(s) for s in sets), default=1)
    slots = 1 << max(10, int(np.ceil(np.log2(max(1, most) * BITS_PER_GRAM))))
    slots = min(slots, 1 << 20)                            # three 20-bit hashes out of 64 bits
    masks = np.zeros((-(-len(langs) // 64), slots), np.uint64)
    for i, s in enumerate(sets):
        x = mix64(s.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for h in range(HASHES):
            at = ((x >> np.uint64(20 * h)) & np.uint64(slots - 1)).astype(np.int64)
            masks[i // 64][at] |= np.uint64(1 << (i % 64))
    fill = np.array([np.mean((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(langs))])
    return Model(langs, masks, np.minimum(fill ** HASHES, 0.99), prior)


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        sample_per_lang: int = SAMPLE_PER_LANG, min_count: int = 3, ratio: float = 0.3, most_grams: int = GRAMS) -> Model:
    """Learn the filters from about `sample_per_lang` documents of each language (all, if there are fewer): those whose
    id hashes below the language's rate.

    Bounds of the fit: only n-gram counts reach the driver, at most `most_grams` in all (each language has an equal share, its
    most frequent ones), and one count per language.
    """
    known = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, 1024), np.uint64), np.zeros(0), 0)
    rates = F.create_map(*[x for k, n in sorted(sizes.items()) for x in (F.lit(k), F.lit(min(1.0, sample_per_lang / n)))])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 32)) / float(1 << 32)
    picked = known.where(draw < rates[F.col(lang_col).cast("string")]).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(lowered(batch, "text"), "text"):
                g, goff = grams(data, off)
                names, code = np.unique(np.array(rows.column(0).to_pylist(), object).astype(str), return_inverse=True)
                of = np.repeat(code, goff[1:] - goff[:-1]).astype(np.uint64)
                key, n = np.unique((of << np.uint64(32)) | g, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[(key >> np.uint64(32)).astype(np.int64)]),
                     pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])

    counts = materialise(picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("t"))
    top = counts.where(F.col("n") >= min_count).withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= max(1, min(GRAMS_PER_LANG, most_grams // len(sizes))))
    got = top.select("lang", "gram", "n").toPandas()
    totals = {r["lang"]: r["t"] for r in total.collect()}
    discard(counts)
    langs = sorted(sizes)
    prior = max(range(len(langs)), key=lambda i: (sizes.get(langs[i], 0), -i))
    every = np.unique(got["gram"].to_numpy(np.int64))
    rate = np.zeros((len(langs), len(every)))
    for i, name in enumerate(langs):
        mine = got[got["lang"] == name]
        rate[i, np.searchsorted(every, mine["gram"].to_numpy(np.int64))] = mine["n"].to_numpy() / totals.get(name, 1)
    best = rate.max(axis=0, initial=0.0)
    return build(langs, [every[(rate[i] > 0) & (rate[i] >= ratio * best)] for i in range(len(langs))], prior)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, lang_pred, score (the winner's share of all corrected counts, 0 to 1) and known (corrected
    count of the winner per n-gram of the text)."""
    return _predicted(docs, model, [id_col], text_col).withColumnRenamed("c0", id_col)


def accepted(docs: DataFrame, model: Model, min_known: float = 0.05, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a known language: not `und`, and at least `min_known` of the n-grams recognised."""
    out = _predicted(docs, model, docs.columns, text_col).where((F.col("lang_pred") != UND) & (F.col("known") >= min_known))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _predicted(docs: DataFrame, model: Model, kept: list[str], text_col: str) -> DataFrame:
    """The columns `kept` as c0, c1, ..., then lang_pred, score and known."""
    at = kept.index(text_col) if text_col in kept else len(kept)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, UND], object)
        for batch in batches:
            letters = pc.fill_null(pc.match_substring_regex(batch.column(at), r"\p{L}"), False)
            batch = batch.append_column("__t_letters", letters)
            name = batch.schema.names[at]
            for rows, _, _ in text_slices(batch, name):
                data, off = text_buffer(pc.utf8_lower(rows.column(at)))
                n = len(rows)
                has = rows.column(rows.num_columns - 1).to_numpy(zero_copy_only=False)
                if model.langs:
                    c = model.counts(data, off)
                    total, win = c.sum(axis=1), c.argmax(axis=1)
                    top = c[np.arange(n), win]
                    win = np.where(total > 0, win, model.prior)
                    score = np.where(total > 0, top / np.maximum(total, 1e-300), 0.0)
                    _, goff = grams(data, off)
                    known = top / np.maximum(1, goff[1:] - goff[:-1])
                    win, score, known = np.where(has, win, len(model.langs)), np.where(has, score, 0.0), np.where(has, known, 0.0)
                else:
                    win, score, known = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(i) for i in range(len(kept))], pa.array(names[win].tolist(), pa.string()),
                     pa.array(np.clip(score, 0, 1)), pa.array(np.clip(known, 0, 1))],
                    names=[*[f"c{i}" for i in range(len(kept))], "lang_pred", "score", "known"])

    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))
    if text_col not in kept:
        cols.append(F.col(f"`{text_col}`").alias("__t_text"))
    return docs.select(*cols).mapInArrow(
        tidy(run), f"{kinds}, lang_pred string, score double, known double")
