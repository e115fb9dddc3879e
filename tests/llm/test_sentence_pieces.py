import itertools
import random

import numpy as np
import pytest
import sentencepiece

from ledgerloom.llm import sentence_pieces as sp
from ledgerloom.llm.token_counts import SPACE_MARK, model_path
from tests.llm.test_token_counts import TEXTS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def lex():
    return sp.Lexicon.load(model_path())


def noise(seed, n):
    r = random.Random(seed)
    words = ["erhation", "ciónmente", "Schkeit", "été", "STUPID!!", "  ", "\n", "***", "a", "the", "日本", "🙂", "1234567", "ing", "   x", "\t"]
    return "".join(r.choice(words) + r.choice(["", " ", " ", "e", "."]) for _ in range(n))


def test_ids_equal_the_library(lex, library):
    for text in [*TEXTS, *(noise(i, 200) for i in range(20)), "aaaa" * 300, "abcabc" * 200]:
        assert list(lex.encode(text)) == (library.encode(text) if text else [])
        if SPACE_MARK not in (text or ""):
            assert lex.decode(lex.encode(text)) == (text or "")


def scanned(lex, text, size):
    marked, keep = lex.marked(text), lex.longest + 1
    n = max(1, len(marked) // max(size, 2 * lex.longest))
    edge = [len(marked) * k // n for k in range(n + 1)]
    parts = [(marked[max(0, i - keep) : j + keep], i - max(0, i - keep), j - max(0, i - keep), k == 0, k == n - 1) for k, (i, j) in enumerate(zip(edge, edge[1:]))]
    matrices = [lex.transfer(*p) for p in parts]
    half = len(matrices) // 2
    if half:  # associative: halves multiplied on their own
        left, right = matrices[0], matrices[half]
        for m in matrices[1:half]:
            left = sp.times(left, m)
        for m in matrices[half + 1 :]:
            right = sp.times(right, m)
        assert sp.times(left, right)[0, 0] > sp.NEVER
    states = sp.best_states(matrices, 0, 0)
    return [i for p, a, b in zip(parts, states, states[1:]) for i in lex.trace(*p, a, b)]


@pytest.mark.parametrize("size", [32, 50, 333])
def test_chunks_equal_the_whole(lex, library, size):
    for text in [noise(99, 300), "erhationingthe" * 60, "a" * 700, "x\n" * 200, "ab cd" * 100, "日本語" * 80, " " * 500]:
        assert scanned(lex, text, size) == library.encode(text)


def test_unigram_lattice_against_all_paths():
    pieces = {"a": -1.0, "b": -1.5, "ab": -1.7, "ba": -2.1, "aba": -2.9, "bb": -2.0, SPACE_MARK: -1.0, SPACE_MARK + "a": -1.2}
    lex = sp.Lexicon([("<unk>", 0.0, 2), *((p, s, 1) for p, s in pieces.items())], merges=False)

    def every(s):
        if not s:
            yield 0.0, []
        for n in range(1, len(s) + 1):
            if s[:n] in pieces or n == 1:
                for w, rest in every(s[n:]):
                    yield w + pieces.get(s[:n], lex.unknown_score), [s[:n], *rest]

    r = random.Random(3)
    for _ in range(40):
        text = "".join(r.choice("aabb c") for _ in range(9))
        best = max(w for w, _ in every(lex.marked(text)))
        found, weight = lex.path(lex.marked(text))
        assert np.isclose(weight, best)
    for text in ("abab" * 30, "abba ab" * 20):
        whole = lex.path(lex.marked(text))[1]
        ids = scanned(lex, text, 12)
        assert np.isclose(sum(lex.unknown_score if i == 0 else list(pieces.values())[i - 1] for i in ids), whole)
    assert list(itertools.chain(lex.encode("acc"))) == [8, 0]


def test_operator(spark, library):
    texts = [*TEXTS, noise(5, 4000), "giantword" * 9000]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(3, "a b", 5)], "doc_id long, text string, ids int")
    rows = sp.encode(docs, giant=20_000).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        options = [texts[r.doc_id], "a b"] if r.doc_id == 3 else [texts[r.doc_id]]
        assert list(r.ids) in [library.encode(t) if t else [] for t in options] and r.n_tokens == len(r.ids)
        assert r.round_trip == (SPACE_MARK not in (options[0] or ""))
    back = {r.doc_id: r.text for r in sp.decode(spark.createDataFrame([(1, library.encode("é x  y"))], "doc_id long, ids array<int>")).collect()}
    assert back == {1: "é x  y"}
    assert sp.encode(docs.limit(0)).collect() == []
