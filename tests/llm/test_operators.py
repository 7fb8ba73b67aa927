"""Operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns,
against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import (bpe, chat_tree, components, exact_dedup, grid_join, langid, mixing, ngram_join, quality,
                         suffix_dedup, toxicity)
from tessera.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, digest string, `a b` int"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = say(120), say(90)
    out = [None, "", "   ", "one", "one two", "One TWO", "12 34", base, base, base + " more", "x " + base, say(60) + passage + say(60),
           say(30) + passage, passage, "z" * 3000, "ab" * 900, say(3000), "é漢😀'll  \n don't I'VE\t\t x", base]
    for i in range(12):                                    # near copies
        w = base.split()
        w[i * 7] = "edit"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", None, "de", "en"]
    rows = [(i, t, langs[i % 4], f"s{i % 3}" if i % 5 else None, "clash", i) for i, t in enumerate(_texts())]
    rows += [(None, "null id text", "en", "s0", None, None), rows[7], rows[7]]
    return spark.createDataFrame(rows, DDL).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def _rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {name_} as select * from read_parquet('{SMALL}/{name_}.parquet')")
    got = QUERIES[name](spark, SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda df: sorted(map(tuple, df[cols].astype(str).itertuples(index=False)))
    assert key(got) == key(want)


def test_exact_dedup(spark, docs, empty):
    src = _rows(docs)
    by = {}
    for r in src:
        by.setdefault(r["text"] or "", []).append(r["doc_id"])
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    for memory in (64 << 20, 1000):                        # 1000 bytes: recursion through spill files
        got = _rows(exact_dedup.classes(docs, memory=memory))
        assert len(got) == len(src)
        for r in got:
            t = next(s["text"] or "" for s in src if s["doc_id"] == r["doc_id"])
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep[t], len(by[t]), r["doc_id"] == keep[t])
            assert bytes(r["digest"]) == hashlib.sha256(t.encode()).digest()
        left = _rows(exact_dedup.survivors(docs, memory=memory))
        assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in left) == sorted(-1 if i is None else i for i in keep.values())
        assert {r["doc_id"]: r["text"] or "" for r in left} == {keep[t]: t for t in keep}
    assert exact_dedup.survivors(docs).columns == docs.columns
    assert not _rows(exact_dedup.classes(empty)) and not _rows(exact_dedup.survivors(empty))


def test_grace_compares_contents():
    """Records with the same digest but different contents stay apart."""
    rec = [(b"x" * 32, c, [i, 1, None]) for i, c in enumerate([b"a", b"b", b"a", b"c" * 50, b"c" * 50])]
    for memory in (1, 1 << 20):
        got = {c: tuple(r[:2]) for _, c, r in exact_dedup.grace(iter([(d, c, list(r)) for d, c, r in rec]), 0, memory)}
        assert got == {b"a": (2, 2), b"b": (1, 1), b"c" * 50: (4, 2)}


def _brute_classes(src, n, pct):
    sets = {}
    for r in src:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n,pct", [(4, 85), (5, 80), (1, 50)])
def test_ngram_join(docs, empty, n, pct):
    src = _rows(docs)
    want = _brute_classes(src, n, pct)
    got = _rows(ngram_join.similarity_classes(docs, n, pct))
    assert len(got) == len(src)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    left = {r["doc_id"] for r in _rows(ngram_join.survivors(docs, n, pct))}
    assert left == {i for i, (_, c) in want.items() if i == c} | {None}
    assert not _rows(ngram_join.similarity_classes(empty, n, pct))


def test_overlap_bounds():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        a = rnd.choice(1 << 20, rnd.integers(5, 900), replace=False).astype(np.uint64)
        b = np.concatenate([a[:int(len(a) * rnd.uniform(0.8, 1))], rnd.choice(1 << 20, rnd.integers(0, 60)).astype(np.uint64) + np.uint64(1 << 21)])
        sets = [np.unique(a), np.unique(b)]
        off = np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
        sk = ngram_join.Sketches(ngram_join.sketches(np.concatenate(sets), off))
        assert sk.distance(np.array([0]), np.array([1]))[0] <= len(np.setxor1d(*sets))


def _naive_cut(texts, length):
    where = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            where.setdefault(t[i:i + length], []).append((d, i))
    out = []
    for d, t in enumerate(texts):
        cover = [False] * len(t)
        for i in range(len(t) - length + 1):
            if len(where[t[i:i + length]]) > 1:
                cover[i:i + length] = [True] * length
        out.append(cover)
    return out


def test_suffix_array():
    rnd = random.Random(2)
    for _ in range(300):
        s = [rnd.randint(1, rnd.randint(1, 4)) for _ in range(rnd.randint(0, 25))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("length,gram", [(400, 200), (100, 40)])
def test_suffix_dedup(docs, empty, length, gram):
    src = _rows(docs)
    covers = _naive_cut([(r["text"] or "").encode() for r in src], length)
    want = []
    for r, c in zip(src, covers):
        b = (r["text"] or "").encode()
        kept = bytes(x for x, gone in zip(b, c) if not gone)
        spans = sum(1 for i, gone in enumerate(c) if gone and not (i and c[i - 1]))
        want.append((str(r["doc_id"]), len(b), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    got = [(str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in _rows(suffix_dedup.deduplicate(docs, length, gram))]
    assert sorted(got) == sorted(want)
    assert not _rows(suffix_dedup.deduplicate(empty, length, gram))


def test_bpe(docs, empty):
    ranks = bpe.vocabulary(PATH).ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, PATH)
    for r, d in zip(sorted(_rows(coded), key=lambda r: (str(r["doc_id"]))), sorted(_rows(docs), key=lambda r: str(r["doc_id"]))):
        assert np.frombuffer(r["ids"], "<u4").tolist() == enc.encode_ordinary(d["text"] or "")
        ends = np.frombuffer(r["piece_ends"], "<u4").tolist()
        assert not ends or ends[-1] == len(d["text"].encode())
    text = {str(r["doc_id"]): (r["text"] or "").encode() for r in _rows(docs)}
    assert all(bytes(r["decoded"]) == text[str(r["doc_id"])] for r in _rows(bpe.decode(coded, PATH)))
    assert not _rows(bpe.decode(bpe.encode(empty, PATH), PATH))
    rnd = random.Random(4)
    parts = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "é", "1", "!", "　", "½", "漢", "A"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    ids, _ = bpe.encode_buffer(bpe.vocabulary(PATH), np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [enc.encode_ordinary(t) for t in texts]


def test_chat_tree(spark):
    a, b = "hello", "</s>[INST] \\ [/INST]<s>"
    convs = {1: [("user", a), ("assistant", b)], 2: [("user", a), ("assistant", b), ("user", "x")], 3: [("user", a), ("assistant", "c")],
             4: [("system", None), ("user", ""), ("assistant", "")], 5: [("user", a), ("assistant", b)], None: [(None, "n\n"), ("assistant", "\\l ")]}
    rows = [(c, i, r, t, "extra") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [(6, 0, "user", "twice", ""), (6, 0, "user", "twice", "")]
    convs[6] = [("user", "twice"), ("user", "twice")]
    nodes, paths = chat_tree.format_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string").repartition(4))
    got = {r["conv_id"]: r for r in _rows(chat_tree.read_back(nodes, paths))}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[c]["n_turns"] == len(turns)
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    tree = {bytes(r["node"]): r for r in _rows(nodes)}
    stream = sorted(tree.values(), key=lambda r: r["stream_start"])
    assert [r["stream_start"] for r in stream] == [sum(x["units"] for x in stream[:i]) for i in range(len(stream))]
    for r in tree.values():                                # attention = ancestors; positions continue the parent's
        up, spans, p = r, [], r["parent"]
        while p is not None:
            up = tree[bytes(p)]
            spans.append((up["stream_start"], up["stream_start"] + up["units"]))
            p = up["parent"]
        assert suffix_dedup.merged(spans) == [(s["start"], s["end"]) for s in r["attends"]]
        assert r["position_start"] == sum(e - s for s, e in spans)
    assert sum(r["text"].count("hello") for r in tree.values()) == 1       # shared turns are emitted once


def test_grid_join(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 12))
    x[50:120] = x[0] + rnd.normal(size=(70, 12)) * 0.25
    x[130] = x[131] = x[0]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    bad = [(400, None, 0), (401, [], 0), (402, [0.0] * 12, 0), (403, [float("nan")] + [1.0] * 11, 0), (404, [None] + [1.0] * 11, 0), (405, [1.0, 2.0], 0), (406, [2.0, 4.0], 0)]
    got = {r["vec_id"]: r for r in _rows(grid_join.link_classes(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").repartition(4)))}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(300)
    for _ in range(300):
        new = np.minimum(label, np.where(link, label[None, :], 999).min(axis=1))
        if (new == label).all():
            break
        label = new
    for i in range(300):
        assert (got[i]["n_links"], got[i]["component_id"]) == (link[i].sum(), label[i])
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(400, 405))
    assert (got[405]["n_links"], got[406]["component_id"], got[406]["kept"]) == (1, 405, False)


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 40)]
    for hubs in (components.HUBS, 4, 1):                   # every node a hub, the star's centre alone, none
        got = dict(components.components(spark.createDataFrame(edges, "u long, v long").repartition(6), hubs=hubs).collect())
        assert all(got[i] == 3 for i in range(10, 41)) and all(got[i] == 100 for i in range(100, 160))


def test_mixing_meets_targets(spark, docs, empty):
    out = mixing.calibrate(docs).cache()
    assert out.count() == docs.count()
    cells = out.groupBy("source").agg(F.sum(F.col("tokens") * F.col("rate")).alias("w"), F.sum("tokens").alias("n")).collect()
    goal = {r["source"]: r["n"] ** mixing.TEMPER["source"] for r in cells}
    total, whole = sum(goal.values()), sum(r["n"] for r in cells)
    assert all(abs(r["w"] / whole - goal[r["source"]] / total) < 0.02 for r in cells)
    left = mixing.sample(docs)
    assert left.columns == docs.columns and left.count() == out.where("sampled").count()
    assert not _rows(mixing.calibrate(empty))


def test_language(spark, docs, empty):
    train = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(
        [("the cat sat on the mat with the dog", "en"), ("der hund und die katze sitzen auf der matte", "de")] * 30)], "doc_id long, text string, lang string")
    model = langid.fit(train)
    got = {r["doc_id"]: r for r in _rows(langid.predict(docs, model))}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 6))
    assert all(r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1 for r in got.values())
    hit = {r["doc_id"]: r["lang_pred"] for r in _rows(langid.predict(train, model))}
    assert all(hit[i] == ("en", "de")[i % 2] for i in hit)
    assert langid.accepted(docs, model).columns == docs.columns
    assert {r["lang_pred"] for r in _rows(langid.predict(docs, langid.fit(empty)))} == {"und"}


def test_levenshtein_automaton():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    entries = [("idiot", False, 1.0), ("worthless", False, 2.0), ("scum", False, 3.0), ("lowei", True, 4.0)]
    auto = toxicity.build(entries)
    rnd = random.Random(1)
    words = ["idiot", "idot", "idiiot", "xdiot", "idiots", "scum", "scuma", "scu", "worthles", "wrothless", "loweixyz", "lowe", "lowei"]
    words += ["".join(rnd.choice("idotscum") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    state = auto.run(points, ends - [len(w) for w in words], ends)
    for w, s in zip(words, state):
        best = min([distance(w, t) for t, open_end, _ in entries if not open_end and (distance(w, t) == 0 or (len(t) >= 5 and distance(w, t) == 1))]
                   + [0 for t, open_end, _ in entries if open_end and w.startswith(t)], default=9)
        assert auto.edits[s] == best, w


@pytest.mark.parametrize("name,column,modulus,rest", [("op5_toxicity", "toxic", 4, 2), ("op10_quality", "quality", 5, 0)])
def test_held_out_accuracy(spark, name, column, modulus, rest):
    d = SMALL.replace("sf0.001", "sf0.01")
    got = QUERIES[name](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got[column]).mean() > 0.9


def test_scores_of_odd_rows(docs, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(30)], "doc_id long, quality int, toxic int")
    for mod, col in ((quality, "quality"), (toxicity, "toxic")):
        for lab in (labels, labels.limit(0)):
            got = _rows(mod.score(docs, mod.fit(docs, lab, col)))
            assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
        assert not _rows(mod.score(empty, mod.fit(empty, labels, col)))


def test_bradley_terry_ranks():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 5))
    y = (x @ np.array([2.0, -1, 0, 0, 0]) > -0.8).astype(int)
    m = quality.train(x, y)
    assert np.mean((m.score(x) >= 0.3) == (y == 1)) > 0.95


def test_pipeline(spark):
    src = {r["doc_id"]: r["text"] for r in _rows(spark.read.parquet(f"{SMALL}/documents.parquet"))}
    out = _rows(corpus_pipeline.run(spark, SMALL))
    ids = [r["doc_id"] for r in out]
    assert 0 < len(ids) == len(set(ids)) and len({src[i] for i in ids}) == len(ids)
    near = _brute_classes([{"doc_id": i, "text": src[i]} for i in ids], 5, 80)
    assert all(i == c for i, (_, c) in near.items())       # no near duplicates are left
    ranks = bpe.vocabulary(PATH).ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == enc.encode_ordinary(src[r["doc_id"]]) for r in out)


def test_words_of_a_thue_morse_pair_do_not_link(spark):
    """Two different words whose polynomials agree modulo 2^64 under every base."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similarity_classes(df, n=4, pct=85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_span_hashes_do_not_depend_on_the_place():
    from tessera.llm.common import SpanHasher

    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 60_000).astype(np.uint8)
    starts = rng.integers(0, 59_000, 4000)
    ends = starts + rng.integers(0, 9, 4000)
    seen = {}
    for h, a, b in zip(SpanHasher(data)(starts, ends).tolist(), starts, ends):
        assert seen.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_grid_join_skips_distant_pairs(spark, monkeypatch):
    """Clusters far apart: of the pairs of intervals fewer than half are kept, before any vector moves; no link is lost."""
    rnd = np.random.default_rng(11)
    centres = np.concatenate([np.eye(12)[:2], -np.eye(12)[:2]])
    x = (centres[np.arange(1500) % 4] + rnd.normal(size=(1500, 12)) * 0.05).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>").repartition(7)
    monkeypatch.setattr(grid_join, "INTERVAL_BYTES", 8 * 12 * 100)
    kept = []
    plain = grid_join._pairs
    monkeypatch.setattr(grid_join, "_pairs", lambda b, n, k, eps: kept.append((plain(b, n, k, eps).count(), n)) or plain(b, n, k, eps))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in grid_join.link_classes(df).collect()}
    pairs, n = kept[0]
    assert n == 15 and pairs < n * (n + 1) / 4
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.9
    assert all(got[i] == (link[i].sum() - 1, i % 4) for i in range(1500))


@pytest.mark.parametrize("dim", [3, 24, 40])
def test_bound_on_a_cosine_loses_no_pair(dim):
    rnd = np.random.default_rng(dim)
    x = rnd.normal(size=(700, dim))
    x[350:] = x[:350] + rnd.normal(size=(350, dim)) * np.linspace(0, 0.6, 350)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    axes = np.linalg.qr(rnd.normal(size=(dim, dim)))[0][:, :min(24, dim)]
    i, j = grid_join.close_pairs(x, x, axes, 0.9)
    want = np.argwhere(x @ x.T >= 0.9)
    assert {*zip(i.tolist(), j.tolist())} == {*map(tuple, want.tolist())} and len(want) > 700


def test_grid_join_of_nothing_and_clashing_columns(spark):
    ddl = "vec_id long, embedding array<float>, id string, digest string, dim int, vec string, n int"
    assert grid_join.link_classes(spark.createDataFrame([], ddl)).count() == 0
    rows = [(1, [1.0, 0.0], "a", "b", 1, "c", 2), (2, [2.0, 0.1], None, None, None, None, None), (None, [1.0, 0.0], "a", "b", 1, "c", 2), (3, [1e30, 1e30], "", "", 0, "", 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in grid_join.link_classes(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, True), 3: (0, 3, True)}


# ---- evidence by plainer means ---------------------------------------------------------------------------------------

LONG = 200_000


def _letters(rows):
    return sum(c.isalpha() for c in rows)


def test_language_id_against_exact_sets(spark):
    """The Bloom filters answer as exact n-gram sets would, apart from a few false positives."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    counts = {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            data = np.frombuffer(text.lower().encode(), np.uint8)
            g, _ = langid.grams(data, np.array([0, len(data)]))
            for k in g.tolist():
                counts.setdefault(lang, {}).setdefault(k, 0)
                counts[lang][k] += 1
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    best = {}
    for lang, c in counts.items():
        for k, n in c.items():
            if n >= 3:
                best[k] = max(best.get(k, 0.0), n / total[lang])
    known = {lang: {k for k, n in c.items() if n >= 3 and n / total[lang] >= 0.3 * best[k]} for lang, c in counts.items()}
    wrong = 0
    for doc, text, _ in rows:
        if text is None or not any(ch.isalpha() for ch in text):
            assert got[doc] == ("und", 0.0)
            continue
        data = np.frombuffer(text.lower().encode(), np.uint8)
        g = langid.grams(data, np.array([0, len(data)]))[0].tolist()
        hits = {lang: sum(k in s for k in g) for lang, s in known.items()}
        if sum(hits.values()):
            top = max(sorted(hits), key=lambda x: hits[x])
            wrong += got[doc][0] != top
            assert abs(got[doc][1] - hits[top] / sum(hits.values())) < 0.05
    assert wrong <= len(rows) // 100


@pytest.mark.parametrize("score, label, modulus", [("toxicity", "toxic", (4, 2)), ("quality", "quality", (5, 0))])
def test_held_out_labels_are_ranked(spark, score, label, modulus):
    from tessera.llm.common import held_out

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op5_toxicity" if score == "toxicity" else "op10_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(F.col("doc_id").alias("i"), F.col(label).alias("y"))
    rows = got.where("held_out").join(labels, F.col("doc_id") == F.col("i")).select("score", "y", "predicted").where("y is not null").collect()
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    pos, neg = [r["score"] for r in rows if r["y"] == 1], [r["score"] for r in rows if r["y"] == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    recall = np.mean([r["predicted"] for r in rows if r["y"] == 1])
    precision = np.mean([r["y"] for r in rows if r["predicted"] == 1])
    assert auc >= (0.8 if score == "toxicity" else 0.95) and recall >= (0.6 if score == "toxicity" else 0.95) and precision >= 0.9


def test_scores_of_long_texts_and_odd_rows(spark, docs, empty):
    rows = [(1, "alpha beta " * LONG, None, None, None, None), (2, "z" * LONG, None, None, None, None), (None, "alpha", None, None, None, None),
            (1, None, None, None, None, None), (1, None, None, None, None, None)]
    odd = spark.createDataFrame(rows, DDL)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    for op, col in ((toxicity, "toxic"), (quality, "quality")):
        model = op.fit(docs, labels)
        got = op.score(odd, model).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
        assert op.score(empty, model).count() == 0
        nothing = op.fit(empty, labels)
        assert len({r["score"] for r in op.score(odd, nothing).collect()}) == 1
        assert col in labels.columns
    model = langid.fit(docs)
    assert langid.predict(odd, model).count() == 5 and langid.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(empty)).collect()} == {"und"}


def test_a_fit_meets_each_labelled_id_once(spark):
    docs = spark.createDataFrame([(1, "good text here")] * 500 + [(2, "bad bad")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    twice = spark.createDataFrame([(1, "good text here"), (2, "bad bad")], "doc_id long, text string")
    a, b = quality.fit(docs, labels, sample=2), quality.fit(twice, labels, sample=2)
    assert [r["score"] for r in quality.score(twice, a).orderBy("doc_id").collect()] == [r["score"] for r in quality.score(twice, b).orderBy("doc_id").collect()]


def test_chat_tree_of_nothing_and_of_long_texts(spark):
    ddl = "conv_id long, turn long, role string, text string, key string, level long, path string"
    nodes, paths = chat_tree.format_tree(spark.createDataFrame([], ddl))
    assert nodes.count() == 0 and paths.count() == 0
    rows = [(1, 0, "user", "[INST] " * LONG, "k", 1, "p"), (1, 1, "assistant", "\\<s>" * 1000, "k", 1, "p"), (2, 0, "user", "[INST] " * LONG, None, None, None)]
    got = {r["conv_id"]: r for r in chat_tree.read_back(*chat_tree.format_tree(spark.createDataFrame(rows, ddl))).collect()}
    for conv in (1, 2):
        want = "".join(f"{r}\n{t}\n" for c, _, r, t, *_ in rows if c == conv)
        assert got[conv]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_mixing_keeps_clashing_columns(spark):
    rows = [(i, "word " * (i % 50), "en" if i % 3 else "de", f"s{i % 4}", f"t{i}", i, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string, tokens int, rate double")
    kept = mixing.sample(df)
    assert kept.columns == df.columns
    marks = {r["doc_id"]: r["sampled"] for r in mixing.calibrate(df).collect()}
    assert {tuple(r) for r in kept.collect()} == {r for r in rows if marks[r[0]]}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_pipeline_stages_on_odd_tables(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns, name
    language = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(texts[i] is None or not any(c.isalpha() for c in texts[i]) for i in language)
    exact = [r["text"] or "" for r in corpus_pipeline.exact(spark, docs, SMALL).collect()]
    assert sorted(exact) == sorted({t or "" for t in texts.values()})


def test_chunk_symbols_are_exact_even_if_hashes_collide():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    data[1000:1400] = data[:400]
    starts = np.concatenate([np.arange(0, 300, 7), np.arange(1000, 1300, 7), np.arange(2000, 3000, 48)])
    want = [data[i:i + suffix_dedup.CHUNK].tobytes() for i in starts]
    for spans in (suffix_dedup.WindowHasher(data), lambda a, b: np.zeros(len(a), np.uint64)):
        got = suffix_dedup.chunk_symbols(data, starts, spans)
        assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


def test_neighbours_in_the_suffix_array_decide(monkeypatch):
    """With an order that is not the suffix array's, repeats are lost: equality comes from neighbours in the array."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("ab") for _ in range(97)) for _ in range(12)]
    contexts = [("".join(rnd.choice(words) for _ in range(8)))[:600].encode() for _ in range(40)]
    args = (np.zeros(40, np.int64), np.full(40, 200), contexts, 400)
    base = [a.tolist() for a in suffix_dedup.repeated_strings(*args)]
    brute = {}
    for i, c in enumerate(contexts):
        for r in range(-200, 1):
            if 200 + r + 400 <= len(c):
                brute.setdefault((r, c[200 + r:600 + r]), []).append(i)
    hit = {i for k, v in brute.items() if len(v) > 1 for i in v}
    assert set(base[0]) == hit
    real = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: sorted(range(len(s)), key=lambda i: (i * 7919) % len(s)))
    assert not hit or len(suffix_dedup.repeated_strings(*args)[0]) < len(hit)
    monkeypatch.setattr(suffix_dedup, "suffix_array", real)
