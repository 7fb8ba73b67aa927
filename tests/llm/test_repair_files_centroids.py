"""Conversation repair, token files and centroid clustering against brute force."""

import hashlib
import itertools
import math
import os
import random
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import centroids, token_files, turn_repair
from tessera.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
WHITE = " \t\n\x0b\x0c\r"
CHATS = "conv_id long, turn long, role string, text string, `key` string, pid int"


# ---- conversation repair -----------------------------------------------------------------------------------------

def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        said = [" " if v is None else v for v in (conv, turn, role, text)]
        fault = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        role, text = said[2:]
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        if fault:
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def _faults(rows):
    """Rows of one conversation, in order: (role, text, fault)."""
    out, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def _cheapest(rows):
    """(cost, audit, repaired rows) by a table over all rows that carries whole audits."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    enter = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    names = {"u": "user", "a": "assistant"}

    def inserts(table):
        for _ in range(2):
            for q, (c, audit, said) in list(table.items()):
                n = follow[q]
                new = (c + 3, audit + "I", [*said, (names[n], "")])
                if n not in table or new[:2] < table[n][:2]:
                    table[n] = new
        return table

    now = {"": (0, "", [])}
    for role, text, fault in rows:
        nxt = {}
        for q, (c, audit, said) in inserts(dict(now)).items():
            ways = [(q, c + 4, audit + "D", said)]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if (q, role[:1]) in enter:
                    ways.append((role[0], c + extra, audit + "K", [*said, (role, text)]))
                n = follow[q]
                ways.append((n, c + 3 + extra, audit + "R", [*said, (names[n], text)]))
            for state, cost, a, s in ways:
                if state not in nxt or (cost, a) < nxt[state][:2]:
                    nxt[state] = (cost, a, s)
        now = nxt
    return min(v for q, v in inserts(dict(now)).items() if q in ("", "a"))


def _expected(rows):
    chats, out = {}, {}
    for r in rows:
        chats.setdefault(r[0], [])
    for r in _damaged(rows):
        chats[r[0]].append(r)
    for conv, turns in chats.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        marked = _faults(turns)
        cost, audit, said = _cheapest(marked)
        known = {r[1] for r in turns if r[1] is not None}
        initials = [r[2][:1] for r in turns]
        out[conv] = {
            "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
            **{f: sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()}
    return out


def _check_repair(got, rows):
    want = _expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert {k: r[k] for k in want[r["conv_id"]]} == want[r["conv_id"]], r


def test_hirschberg_is_the_least_of_all_edit_sequences():
    def every(codes):
        best = None
        for steps in itertools.product([("I" * m, e) for m in range(3) for e in "DKR"], repeat=len(codes)):
            for tail in ("", "I", "II"):
                state, cost, ok = turn_repair.NEW, 0, True
                for (ins, edit), code in zip(steps, codes):
                    for _ in ins:
                        state, cost = turn_repair._NEXT[state], cost + 3
                    if edit == "D":
                        cost += 4
                    elif code == turn_repair.GONE:
                        ok = False
                    else:
                        cost += 3 * (code >= 4) + 3 * (edit == "R")
                        if edit == "K":
                            state = turn_repair._ENTER.get(" sua"[code & 3], {}).get(state)
                            ok = state is not None
                        else:
                            state = turn_repair._NEXT[state]
                    if not ok:
                        break
                if not ok:
                    continue
                for _ in tail:
                    state, cost = turn_repair._NEXT[state], cost + 3
                if state in (turn_repair.NEW, turn_repair.ASSISTANT):
                    found = (cost, "".join(i + e for i, e in steps) + tail)
                    best = found if best is None or found < best else best
        return best

    for n in range(4):
        for codes in itertools.product(range(9), repeat=n):
            if n == 3 and hash(codes) % 5:
                continue
            steps, states, cost = turn_repair.solve(bytes(codes), turn_repair.NEW, turn_repair.END)
            state = states[-1] if n else turn_repair.NEW
            tail = turn_repair.TAIL[state]
            assert (cost + 3 * len(tail), "".join(steps) + tail) == every(codes), codes


def test_segments_chain_to_the_same_repair():
    rnd = random.Random(4)
    for _ in range(300):
        codes = bytes(rnd.choice([0, 1, 2, 2, 3, 3, 4, 6, 7, 8]) for _ in range(rnd.randint(1, 40)))
        steps, states, cost = turn_repair.solve(codes, turn_repair.NEW, turn_repair.END)
        cuts = sorted(rnd.sample(range(1, len(codes)), min(len(codes) - 1, rnd.randint(0, 4)))) if len(codes) > 1 else []
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        got, total = [], 0
        for part, (state, end) in zip(parts, turn_repair.chain([turn_repair.matrix(p) for p in parts])):
            s, _, c = turn_repair.solve(part, state, end)
            got, total = got + s, total + c
        assert (got, total) == (steps, cost)


def _chats():
    rnd = random.Random(6)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(1, 9)):
            t = rnd.choice([turn, turn, turn, None, turn + rnd.randint(0, 3)])
            rows.append((conv, t, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]),
                         rnd.choice(["Yes.", "No", " \t", "", None, "So!  \n", f"t{turn}?", "é漢.", "x" * 5000 + "."])))
    rows += [(3, 1, "user", "Again.")] * 4                                  # repeated rows
    rows += [(1000, i, "user" if i % 2 == 0 else "assistant", f"turn {i // 3}{'.' if i % 7 else ''}") for i in range(3000)]
    rows += [(1001, None, "user", None)]
    return rows


def test_repair_against_a_plain_table(spark):
    rows = _chats()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], CHATS).repartition(6)
    got = turn_repair.report(df, turn_repair.damage(df)).collect()
    _check_repair([r.asDict() for r in got], rows)


def test_repaired_rows_are_legal_and_carry_their_texts(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in _chats()], CHATS)
    edits, _ = turn_repair.repair(df)
    by = {}
    for r in edits.orderBy("pid", "at").collect():
        if r["role"] is not None:
            assert r["text"] is not None and (r["text"] == "") == (r["edit"] == "I")
            by.setdefault(r["key"], []).append(r["role"][0])
    for said in by.values():
        assert "".join(said).lstrip("s")[::2].strip("u") == "" and "".join(said)[-1] == "a"


def test_repair_of_the_table(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from read_parquet('{SMALL}/conversations.parquet')").fetchall()
    _check_repair([r.asDict() for r in QUERIES["op11_turn_repair"](spark, SMALL).collect()], rows)


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], CHATS)
    assert turn_repair.report(df, turn_repair.damage(df)).count() == 0


# ---- token files --------------------------------------------------------------------------------------------------

def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for trial in range(200):
        m = int(rng.integers(0, 5000))
        bits = rng.integers(0, 64, m) if trial % 3 else np.minimum(rng.integers(0, 64, m), rng.integers(1, 20))
        ids = rng.integers(0, 1 << 63, m, dtype=np.uint64) >> (63 - bits).astype(np.uint64)
        if trial % 2:
            ids = np.repeat(ids, rng.integers(1, 50, m))[:m]               # runs
        words, raw, words_per, raw_per = token_files.pack(ids)
        lengths = np.minimum(token_files.BLOCK, m - token_files.BLOCK * np.arange(len(words_per)))
        assert (token_files.unpack(words, raw, words_per, raw_per, lengths) == ids).all()
        assert words_per.sum() == len(words) and raw_per.sum() == len(raw) == ((ids >> np.uint64(60)) > 0).sum()
    small = rng.integers(0, 2, 60 * 17).astype(np.uint64)
    assert len(token_files.pack(small)[0]) <= 18                           # sixty bits a word


def test_file_round_trip(tmp_path):
    rng = np.random.default_rng(2)
    docs = [(None, rng.integers(0, 50000, 10)), (-5, np.zeros(0)), (1, rng.integers(0, 1 << 32, 700_000)), (1, np.full(9000, 7)),
            *[(i, rng.integers(0, 50000, int(rng.integers(0, 900)))) for i in range(2, 900)], (2000, np.zeros(0))]
    f = token_files.TokenFile(str(tmp_path), "a.s8b")
    for doc, ids in docs:
        f.add(doc, ids.astype("<u4"))
    assert f.close() == os.path.getsize(tmp_path / "a.s8b")
    start = 0
    for (doc, ids), (d, s, got) in zip(docs, token_files.read_file(f"file://{tmp_path}", "a.s8b"), strict=True):
        assert d == doc and s == start and (got == ids.astype("<u4")).all()
        start += len(ids)


def test_pieces_meet_the_library():
    t, encode, rnd = Tokenizer.from_file(JSON), token_files.piece_encoder(JSON, False), random.Random(3)
    letters = "ab  \n\t'sé1!.,\x1c\x85\xa0 ​漢<|endoftext|>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", "<|endoftext|> x", " "]) for _ in range(1500)]
    texts += ["", " ", " word", "word,  word. Wörd. 's it's", " " * 3000, "z" * 30000, "a b " * 20000]
    for text, got in zip(texts, encode(texts)):
        assert np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes() == got, repr(text)


def _files_of(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, name string").repartition(5)
    manifest, folder = token_files.write(df, JSON, **more)
    return token_files.read(manifest, folder).collect(), manifest


def test_token_files(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["the", "Haus", "été", "\n", "", "ok."]) for _ in range(rnd.randint(0, 300))), "clash", None) for i in range(300)]
    rows += [(None, "no id", None, None), (7, None, None, None), (7, "", None, None), (7, "again", None, None), (500, "q" * 50000, None, None)]
    got, manifest = _files_of(spark, rows, file_ids=3000)
    assert manifest.count() > 8                                            # several files a task
    t = Tokenizer.from_file(JSON)
    want = sorted((r[0] is not None, r[0] or 0, t.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows)
    have = sorted((r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got)
    assert [h[1] for h in have] == [None if not w[0] else w[1] for w in want]
    assert sorted((h[1] is not None, h[1] or 0, h[2]) for h in have) == want
    at = 0
    for start, _, ids in have:                                             # no gap and no overlap
        assert start == at
        at += len(ids)


def test_token_files_of_nothing(spark):
    assert _files_of(spark, [])[0] == []


def test_token_files_of_the_table(spark):
    t, at = Tokenizer.from_file(JSON), 0
    got = {r["doc_id"]: r for r in QUERIES["op12_token_files"](spark, SMALL).collect()}
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{SMALL}/documents.parquet') order by doc_id").fetchall()
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


# ---- centroids ----------------------------------------------------------------------------------------------------

def _lloyd(rows, k=40, rounds=5, dim=64):
    """{position in rows: (cluster, distance, cluster_inertia, inertia, digest)} with Python integers."""
    kept = [(i, v, [math.floor(256 * float(x)) for x in e]) for i, (v, e) in enumerate(rows)
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[1] is None, hashlib.sha256(f"2:{r[1]}".encode()).hexdigest() if r[1] is not None else "", r[2]))
    cents = [r[2] for r in order[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents)) for _, _, x in kept]
    for _ in range(rounds):
        at = nearest()
        for j in range(len(cents)):
            mine = [x for (_, _, x), (_, a) in zip(kept, at) if a == j]
            if mine:
                cents[j] = [sum(c) // len(mine) for c in zip(*mine)]
    at = nearest()
    own = [sum(d for d, j in at if j == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(v), j, d, own[j], sum(own), digest[j]) for (_, v, _), (d, j) in zip(kept, at))


def _check_centroids(df, rows, **more):
    got = centroids.cluster(df, **more).collect()
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == _lloyd(rows, **more)


def test_loosening_holds_and_is_tighter_than_the_drift():
    rng = np.random.default_rng(5)
    tighter = total = 0
    for _ in range(60):
        dim, k = int(rng.integers(1, 6)), 5
        old, radius = rng.normal(size=(k, dim)) * 5, rng.random(k) * 3
        new = old + rng.normal(size=(k, dim)) * rng.choice([0, 0.1, 2, 8])
        bound, drift = centroids.loosening(old, new, radius), np.sqrt(((new - old) ** 2).sum(axis=1))
        for i in range(k):
            x = rng.normal(size=(400, dim))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * rng.random((400, 1)) ** 0.2
            for j in range(k):
                gain = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert gain.max() <= bound[i, j] + 1e-9
                total, tighter = total + 1, tighter + (bound[i, j] < 0.9 * drift[j])
    assert tighter > total / 4


def test_centroids_on_odd_rows(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(i % 5, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (901, None), (902, []), (903, [1.0] * 7), (904, [None] + [0.0] * 7),
             (905, [math.nan] + [0.0] * 7), (906, [math.inf] * 8), (907, [0.0] * 8), (908, [-0.0] * 8), (909, [1e5] * 8), (910, [-3e9] * 8)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "vec_id long, embedding array<double>, cluster int, ids string").repartition(6)
    log = []
    got = centroids.cluster(df, k=7, dim=8, log=log).collect()
    want = _lloyd(rows, k=7, dim=8)
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == want
    assert log[0][0] == log[0][1] and log[-1][0] < log[-1][1] / 2          # later rounds scan few vectors


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([0, 2, 4, 1, 3, 1, 3, 2, 2, 0, 4])]
    _check_centroids(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows, k=4, dim=2)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    _check_centroids(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows)


def test_centroids_of_the_table(spark):
    rows = duckdb.sql(f"select vec_id, embedding from read_parquet('{SMALL}/embeddings.parquet')").fetchall()
    got = QUERIES["op13_centroids"](spark, SMALL).collect()
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == _lloyd(rows)


# ---- workers --------------------------------------------------------------------------------------------------------

def test_kernels_run_where_the_package_is_not_installed(tmp_path):
    """Workers whose path lacks this repository: kernels and what they call travel by value."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from tessera.session import get_session\n"
            "s = get_session('local[4]', **{'spark.sql.shuffle.partitions': '4'})\n"
            "def lacks(batches):\n"
            "    import importlib.util\n"
            "    for b in batches:\n"
            "        assert importlib.util.find_spec('tessera') is None\n"
            "        yield b\n"
            "s.range(4).mapInArrow(lacks, 'id long').count()\n"
            "from tessera.llm.queries import QUERIES\n"
            "import corpus_pipeline\n"
            f"for n, q in [*QUERIES.items(), ('pipeline', corpus_pipeline.run)]: print(n, q(s, {SMALL!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
