import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import jaccard_join as jj
from ledgerloom.llm.components import components


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {(len(w), *w)} if w else set()


def brute(rows, threshold=Fraction(4, 5)):
    sets = [shingles(t) for _, t in rows]
    links = [[False] * len(rows) for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) * threshold.denominator >= threshold.numerator * len(a | b):
                links[i][j] = links[j][i] = True
    cls = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            cls[i] = min([cls[i], *(cls[j] for j in range(len(rows)) if links[i][j])])
    least = {c: min(rows[i][0] for i in range(len(rows)) if cls[i] == c) for c in set(cls)}
    return Counter((rows[i][0], least[cls[i]], sum(links[i])) for i in range(len(rows)))


def near(dice, words, edits):
    words = list(words)
    for _ in range(edits):
        words[dice.randrange(len(words))] = f"e{dice.random()}"
    return " ".join(words)


def corpus(seed, n=40):
    dice = random.Random(seed)
    out = []
    passage = " ".join(f"p{i}" for i in range(15))
    for _ in range(n):
        base = [f"w{dice.randrange(10**6)}" for _ in range(dice.choice([6, 30, 120, 300]))]
        out.append(" ".join(base))
        out += [near(dice, base, dice.randint(0, max(1, len(base) // 40))) for _ in range(dice.choice([0, 0, 1, 3]))]
        if dice.random() < 0.3:
            out.append(passage + " " + " ".join(base[: len(base) // 2]))
    dice.shuffle(out)
    return out


@pytest.mark.parametrize("seed, limit, block", [(0, 64, 128), (1, 2, 3)])
def test_against_brute_force(spark, monkeypatch, seed, limit, block):
    monkeypatch.setattr(jj, "LIMIT", limit)  # small ones exercise recursion, leaders and blocks
    monkeypatch.setattr(jj, "BLOCK", block)
    texts = corpus(seed) + [None, "", " \n", "a", "a", "a b c", "x y z w v", "x y z w v", "x  y\nz w v"]
    rows = [(100 + 3 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_links int").repartition(5)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jj.join(docs).collect())
    assert got == brute(rows)


def test_a_large_group_of_near_copies_loses_no_link(spark):
    dice = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, near(dice, base, dice.randint(0, 3))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in jj.join(docs).collect()) == brute(rows)


def test_texts_of_shared_passages_lose_no_link(spark, monkeypatch):
    """Buckets of texts made of common passages stay large for more than two levels."""
    monkeypatch.setattr(jj, "LIMIT", 4)
    dice = random.Random(12)
    passages = [[f"p{k}w{i}" for i in range(8)] + ["and"] * 4 for k in range(80)]
    made = [[w for p in dice.sample(passages, 12) for w in p] for _ in range(2500)]
    texts = [" ".join(x) for x in made] + [" ".join(x[:-13] + [f"own{i}w{k}" for k in range(13)]) for i, x in enumerate(made[:200])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_links for r in jj.join(docs).collect()}
    links = jj.linked(jj.shingle_sets(texts), Fraction(4, 5)).sum(1)
    assert links[2500:].min() > 0 and got == dict(enumerate(links.tolist()))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (7, "other words in this text here"), (7, text + " more")], "doc_id long, text string")
    got = sorted(((r.doc_id or -1, r.class_id, r.n_links) for r in jj.join(docs).collect()), key=str)
    assert len(got) == 5 and all(n >= 2 for d, _, n in got if d in (5, -1))
    assert jj.join(docs.limit(0)).collect() == []
    assert [(r.class_id, r.n_links) for r in jj.join(docs.filter("doc_id = 7").limit(1)).collect()] == [(7, 0)]


def test_texts_that_share_a_doc_id_link_on_their_own(spark):
    """Null and repeated doc_ids, each with two texts; a null row with a copy of the unique doc 5."""
    dice = random.Random(5)
    base = [[f"t{k}w{i}" for i in range(60 + 20 * k)] for k in range(5)]
    rows = [(None, " ".join(base[0])), (None, " ".join(base[1])), (8, " ".join(base[2])), (8, " ".join(base[3])), (5, " ".join(base[4])), (None, " ".join(base[4]))]
    rows += [(10 + k, near(dice, x, 1)) for k, x in enumerate(base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jj.join(docs).collect())
    assert got == Counter([(None, None, 1), (None, None, 1), (8, 8, 1), (8, 8, 1), (5, None, 2), (None, None, 2), (10, None, 1), (11, None, 1), (12, 8, 1), (13, 8, 1), (14, None, 2)])


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (60, 50), (70, 70)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 60: 40}


def test_runs_reach_the_recall():
    assert jj.runs_for(0.9, 1) == 2 and jj.runs_for(0.9999, 1) == 6 and jj.runs_for(0.9999, 3) > jj.runs_for(0.99, 3)


def test_sketches_agree_as_often_as_the_sets():
    """Pairs at 0.8 agree on that share of coordinates, pass the sketches, and those at 0.5 don't."""
    dice = np.random.default_rng(4)
    for n in (20, 90, 700):
        rates, passed, others = [], 0, 0
        for _ in range(300):
            tokens = np.unique(dice.integers(0, 1 << 64, 2 * n, dtype=np.uint64))
            part = len(tokens) // 10
            a, b, c = tokens[: 9 * part], np.sort(np.concatenate([tokens[part : 9 * part], tokens[9 * part :]])), tokens[3 * part : 9 * part]
            (ma, fa), (mb, fb), (_, fc) = jj.sketches(a), jj.sketches(b), jj.sketches(c)
            rates.append((ma == mb).mean())
            words = lambda f: f.view(np.uint64)
            passed += jj.near(words(fa), words(fb), 0.8)
            others += jj.near(words(fa), words(fc[: len(fc)]), 0.95)
        assert abs(np.mean(rates) - 0.8) < 0.03 and passed == 300 and others == 0


def test_boilerplate_shuffles_no_texts(spark):
    """Texts that share half their words make no candidate components, however many they are."""
    dice = random.Random(2)
    common = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(common + [f"w{dice.randrange(10**9)}" for _ in range(100)])) for i in range(1500)]
    rows += [(5000 + i, near(dice, rows[i][1].split(), 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.selectExpr("doc_id key", "text", "xxhash64(text) text_hash")
    nodes = jj.cut_lineage(jj.sketch(texts).selectExpr("key node", "minima", "fine"))
    parts = components(jj.candidate_links(nodes, 0.8, jj.RECALL))
    assert parts.groupBy("label").count().agg({"count": "max"}).first()[0] <= 6
    linked = {r.doc_id for r in jj.join(docs).filter("n_links > 0").collect()}
    assert linked == {r[0] for r in rows[1500:]} | set(range(40))


def test_exact_links():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [9])]
    got = jj.linked(sets, Fraction(4, 5))
    assert {(i, j) for i, j in zip(*np.nonzero(got)) if i < j} == {(0, 1), (1, 2)}
