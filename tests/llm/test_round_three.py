"""Work left out of two kernels: equal runs in op3's suffix array, pieces of letters in op12's encoder."""

import random
import sys

import numpy as np
import public_tokenizers
import regex
import tokenizers
from tokenizers import Tokenizer

from tessera.llm import suffix_dedup, token_files


def test_op3_equal_runs_enter_the_suffix_array_once(monkeypatch):
    rng = np.random.default_rng(7)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    hashes = [int(h) for h in rng.integers(-1 << 62, 1 << 62, 3)]             # as K-grams are known by
    gram, tails, heads = [word(200) for _ in range(3)], [word(200) for _ in range(4)], [word(200) for _ in range(3)]
    contexts, grams, before = [], [], []
    for i in range(240):
        g, head = int(rng.integers(3)), int(rng.integers(0, 201))
        left = heads[rng.integers(3)] if rng.random() < .5 else word(200)
        right = tails[rng.integers(4)][:rng.integers(100, 201)] + word(60)
        contexts.append(left[200 - head:] + gram[g] + right[:200])
        grams.append(hashes[g])
        before.append(head)
    taken, real = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: taken.append(len(s)) or real(s))
    got = suffix_dedup.repeated_strings(np.array(grams, np.int64), np.array(before, np.int64), contexts, 400)
    where = {}
    for i, (g, b, c) in enumerate(zip(grams, before, contexts)):
        for r in range(-b, len(c) - b - 399):
            if -200 <= r <= 0:
                where.setdefault((g, r, c[b + r:b + r + 400]), []).append((i, r))
    exp = {}
    for held in where.values():
        for i, r in held if len(held) > 1 else ():
            lo, hi = exp.get(i, (r, r))
            exp[i] = min(lo, r), max(hi, r)
    assert {i: (a, b) for i, a, b in zip(*[x.tolist() for x in got])} == {i: (lo, hi + 400) for i, (lo, hi) in exp.items()}
    assert len(exp) > 50
    assert taken[0] < sum(len(c) for c in contexts) / suffix_dedup.CHUNK / 2


def test_op3_without_shared_runs_no_suffix_array():
    rng = np.random.default_rng(8)
    contexts = [bytes(rng.integers(97, 123, 600).astype(np.uint8)) for _ in range(5)]
    got = suffix_dedup.repeated_strings(np.zeros(5, np.int64), np.full(5, 200), contexts, 400)
    assert [len(x) for x in got] == [0, 0, 0]


def test_op12_pieces_of_letters_go_to_the_model_uncut(monkeypatch):
    cuts, real = [], regex.compile

    class Counted:
        def __init__(self, pattern):
            self.pattern = real(pattern)

        def findall(self, text):
            cuts.append(text)
            return self.pattern.findall(text)

    monkeypatch.setattr(regex, "compile", Counted)
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_files, "CACHE", 40)           # the dictionaries change over
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinrstéÀÿ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    odd = ["I'll", "x1", "漢字", "a\n", "<|endoftext|>", "", "..", "ª", "×", "z" * 90]
    texts = [" ".join(rng.choice(words if rng.random() < .9 else odd) for _ in range(30)) for _ in range(200)] + ["", " ", "  a"]
    library = Tokenizer.from_file(path)
    encode = token_files.piece_encoder.__wrapped__(path, False)
    for _ in range(2):
        for lo in range(0, len(texts), 20):
            got = [np.frombuffer(b, "<u4").tolist() for b in encode(texts[lo:lo + 20])]
            assert got == [e.ids for e in library.encode_batch(texts[lo:lo + 20], add_special_tokens=False)]
    assert not {t[1:] for t in cuts} & set(words)


def _library_calls(monkeypatch):
    """What the tokenizers library is called with from here on: lists of texts, and single pre-tokens."""
    calls, real = [], tokenizers.Tokenizer

    class Model:
        def __init__(self, model):
            self.real = model

        def tokenize(self, text):
            calls.append(text)
            return self.real.tokenize(text)

    class Counted:
        def __init__(self, model=None, held=None):
            self.__dict__["held"] = held if held is not None else real(model.real)

        @staticmethod
        def from_file(path):
            return Counted(held=real.from_file(path))

        @property
        def model(self):
            return Model(self.held.model)

        def encode_batch_fast(self, texts, **more):
            calls.append(texts)
            return self.held.encode_batch_fast(texts, **more)

        def __getattr__(self, name):
            return getattr(self.held, name)

        def __setattr__(self, name, value):
            setattr(self.held, name, value)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    return calls


def test_op12_distinct_pre_tokens_meet_the_model_together(monkeypatch):
    monkeypatch.setattr(sys, "_tessera_remembered", {}, raising=False)
    calls, path = _library_calls(monkeypatch), public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(4)
    words = ["".join(rng.choice("aeinrstéÀÿ") for _ in range(12)) for _ in range(5000)]
    texts = [" ".join(words[i:i + 50]) + "." for i in range(0, 5000, 50)] * 2
    got = token_files.piece_encoder(path, False)(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [
        e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert len(calls) < len(words) / 50


def test_op12_pre_tokens_of_plain_characters_start_where_the_pattern_does():
    rng, cut = random.Random(5), regex.compile(public_tokenizers.PATTERN)
    letters = [*"ab19 .,'\n\r\té", "ÿ", "  ", "'s", "'ll", "'re", "'ve", "'t", "'l", " '", "''"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    starts, whole = token_files.token_starts(data, offsets)
    want = [lo + len(t[:m.start()].encode()) for lo, t in zip(offsets.tolist(), texts) for m in cut.finditer(t)]
    assert starts.tolist() == want and not whole.any()


def test_op12_odd_characters_and_spaces_meet_the_library_whole():
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(6)
    odd = ["×", "÷", "À", "漢", "　", " ", "\u0085", " ", " ", " ", " ", "\x0b", "\x0c", "\x1c", "\x7f", "\x00",
           "ß", "ñ", "̀", "😀", "²", "ª", "٣", "<|endoftext|>", "<|", "<", "|", "'s", "'ll", " ", " ", "  ", "\n", "ab", "9", "."]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    for special in (False, True):
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = special
        got = token_files.piece_encoder(path, special)(texts)
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
