import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import language_id, line_quality, toxicity

SYLLABLES = {"xx": ["ka", "lo", "mi", "tru"], "yy": ["szcz", "øre", "bæ", "ny"], "zz": ["qua", "ion", "ment", "lle"]}
NASTY = ["vilething", "grubhead"]


def sentence(dice, lang, n):
    return " ".join("".join(dice.choice(SYLLABLES[lang]) for _ in range(dice.randint(1, 3))) for _ in range(n))


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language(spark):
    dice = random.Random(0)
    rows = [(i, sentence(dice, lang, dice.randint(5, 60)), lang, "s", 0.5) for i in range(240) for lang in [dice.choice(list(SYLLABLES))]]
    rows += [(900, None, "xx", "s", 0.1), (901, "", None, "s", 0.1), (902, "123 !!", "yy", "s", 0.1), (903, "日本", None, None, 0.1), (5, rows[5][1], "xx", "s", 0.1), (None, "kalomi", None, None, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text, lang, *_ in rows[:240]:
        assert by[i].held_out == (crc(i) % 4 == 2)
        if by[i].held_out:
            assert by[i].lang_pred == lang and 0 <= by[i].score <= 1
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred in SYLLABLES and by[None].lang_pred == "xx"
    assert language_id.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}


def test_more_languages_than_a_word_has_bits(spark):
    dice = random.Random(7)
    syllables = {f"l{k:03}": ["".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(6)] for k in range(130)}
    make = lambda lang, n: " ".join("".join(dice.choice(syllables[lang]) for _ in range(2)) for _ in range(n))
    rows = [(i, make(lang, 30), lang) for i, lang in enumerate(sorted(syllables) * 8)]
    rows += [(5000 + i, "ŵŷ " * 8000, "long") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).filter("held_out").collect()}
    assert len({lang for i, _, lang in rows if i in got}) > 100 and any(i >= 5000 for i in got)
    assert all(got[i] == lang for i, _, lang in rows if i in got)


def test_filters_return_every_inserted_language(spark):
    docs = spark.createDataFrame([(i, t * 5 + str(i), lang) for i in range(4) for lang, t in (("a", "ab abc ab"), ("b", "abc xyz"))], "doc_id long, text string, lang string")
    f = language_id.fit(docs)
    h = np.unique(language_id.ngrams(language_id.code_points(["abc " * 4])[0])[0])
    mask = f.tables[0][language_id.slots(h)[0]]
    assert (mask & 3).all() and (f.false < 0.01).all()
    assert f.predict(["xyz xyz", "ab ab ab", "漢字"])[0] == ["b", "a", "a"]


def test_language_scores_against_brute_force(spark):
    """The filters' popcounts against sets of n-grams counted in plain Python."""
    dice = random.Random(21)
    rows = [(i, sentence(dice, lang, 30), lang) for i in range(90) for lang in [list(SYLLABLES)[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    grams = lambda t: ["".join(c if c.isalpha() else " " for c in f"\n{t.lower()}\n"[k - 1 : k + 2]) for k in range(1, len(t) + 1) if t[k - 1].isalpha()]
    seen = {lang: {} for lang in SYLLABLES}
    for i, text, lang in rows:
        if crc(i) % 4 != 2:
            for g in grams(text):
                seen[lang][g] = seen[lang].get(g, 0) + 1
    share = {lang: {g: n / sum(of.values()) for g, n in of.items()} for lang, of in seen.items()}
    most = {g: max(s.get(g, 0) for s in share.values()) for s in share.values() for g in s}
    own = {lang: {g for g, n in of.items() if n >= language_id.LEAST_COUNT and share[lang][g] >= language_id.LEAST_SHARE * most[g]} for lang, of in seen.items()}
    for r in language_id.identify(docs).collect():
        hits = {lang: sum(g in own[lang] for g in grams(rows[r.doc_id][1])) for lang in sorted(own)}
        assert r.lang_pred == max(hits, key=hits.get) and r.score == pytest.approx(hits[r.lang_pred] / sum(hits.values()), abs=1e-3)


def test_long_texts_alone_teach_a_language_and_repeated_rows_one_text(spark):
    dice = random.Random(8)
    rows = [(i, sentence(dice, "xx", 40), "xx") for i in range(40)] + [(100 + i, sentence(dice, "zz", 9000), "zz") for i in range(12)] + [(7778, "ŵŷ ŵ ŷŷ " * 5, "copies")] * 60
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(docs, rows=3).collect()
    assert all(r.lang_pred == "zz" for r in got if 100 <= r.doc_id < 200) and all(r.lang_pred == "copies" for r in got if r.doc_id == 7778)


def labelled(dice):
    rows, labels = [], []
    for i in range(500):
        lines = [sentence(dice, "xx", dice.randint(4, 14)) for _ in range(dice.randint(1, 6))]
        toxic, quality = dice.random() < 0.3, dice.random() < 0.7
        if toxic:
            k = dice.randrange(len(lines))
            lines[k] += " " + dice.choice(NASTY)
        if not quality:
            lines = [" ".join(w + "***" for w in x.split()) for x in lines]
        rows.append((i, "\n".join(lines), 9.0))
        labels.append((i, int(quality), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("run, column, buckets, kept", [(line_quality.classify, 1, 5, 0), (toxicity.score, 2, 3, 1)])
def test_classifiers(spark, run, column, buckets, kept):
    rows, labels = labelled(random.Random(1))
    more = [(900, None, 1.0), (901, "", 1.0), (902, " \n \n", 1.0), (903, "12 !!", 1.0), (4, rows[4][1], 1.0), (None, "kalo", 1.0), (904, "ka lo mi " * 30000, 1.0)]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels + [(3, None, None), (None, 1, 1), (77, 5, 5)], "doc_id long, quality int, toxic int")
    got = run(docs, marks).collect()
    assert len(got) == len(rows) + len(more)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 for r in got)
    right = [by[i].predicted == labels[i][column] for i in range(500) if by[i].held_out]
    assert all(by[i].held_out == (crc(i) % buckets == kept) for i in range(500))
    assert np.mean(right) > 0.95
    assert run(docs.limit(0), marks).collect() == []
    assert len({round(r.score, 6) for r in run(docs.limit(20), marks.limit(0)).collect() if r.doc_id is not None and r.doc_id < 500}) == 1


@pytest.mark.parametrize("run, column", [(line_quality.classify, 1), (toxicity.score, 2)])
def test_long_texts_teach_too(spark, run, column):
    """All texts with the label that is looked for have more than 20,000 characters."""
    dice = random.Random(5)
    rows, labels = [], []
    for i in range(200):
        long = i % 2
        lines = [sentence(dice, "xx", 12) for _ in range(400 if long else 4)]
        if column == 2 and long:
            lines[100] += " " + NASTY[0]
        if column == 1 and not long:
            lines = [" ".join(w + "***" for w in x.split()) for x in lines]
        rows.append((i, "\n".join(lines)))
        labels.append((i, long, long))
    assert min(len(t) for i, t in rows if i % 2) > 20_000
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert np.mean([r.predicted == r.doc_id % 2 for r in run(docs, marks).collect()]) > 0.95


def test_network_scores_against_plain_loops():
    """Gates, states and attention of each window, one number at a time."""
    net, texts = toxicity.Network(3), ["bad you a b c " * 9, "the cat", "", "x y z"]
    net.learn_words(toxicity.Words(texts[:2]).hash[:4], np.array([3.0, -2.0, 1.0, 4.0]))
    net.p["out"] *= 9
    p, h = {k: v.astype(float) for k, v in net.p.items()}, toxicity.HIDDEN
    logistic = lambda x: 1 / (1 + np.exp(-x))

    def window_score(w, tokens):
        inputs = []
        for token in tokens:
            place = list(net.known).index(w.hash[token]) + 1 if w.hash[token] in net.known else 0
            inputs.append(np.r_[p["word"][place], np.mean([p["triple"][t] for t in w.triples_of(token)], axis=0)])
        states = []
        for side, name in enumerate(("ahead", "back")):
            state, made = np.zeros(h), []
            for x in inputs if side == 0 else inputs[::-1]:
                gate, own = x @ p["in"][:, side * 3 * h : (side + 1) * 3 * h] + p["bias"][side * 3 * h : (side + 1) * 3 * h], state @ p[name]
                z, r = logistic(gate[:h] + own[:h]), logistic(gate[h : 2 * h] + own[h : 2 * h])
                state = (1 - z) * np.tanh(gate[2 * h :] + r * own[2 * h :]) + z * state
                made.append(state)
            states.append(made if side == 0 else made[::-1])
        states = [np.r_[a, b] for a, b in zip(*states)]
        look = np.exp([s @ p["look"] for s in states])
        return sum(x * s for x, s in zip(look / look.sum(), states)) @ p["out"] + p["base"][0]

    got = net.scores(texts)
    for text, score in zip(texts, got):
        w = toxicity.Words([text])
        n = len(w.number)
        starts = range(0, max(n - toxicity.WINDOW, 0) + toxicity.STRIDE, toxicity.STRIDE) if n else []
        best = max((window_score(w, w.number[i : i + toxicity.WINDOW]) for i in starts if i == 0 or i - toxicity.STRIDE + toxicity.WINDOW < n), default=None)
        assert score == pytest.approx(0 if best is None else logistic(best), abs=1e-4)


def test_network_gradient():
    net, words = toxicity.Network(1), toxicity.Words(["bad you a b c " * 3, "the cat sat on mat", "x"])
    net.learn_words(words.hash, np.linspace(-3, 3, len(words.hash)))
    windows, text = words.windows()
    assert len(windows) == 3 and (np.bincount(text, minlength=3) == 1).all()
    y = np.array([1, 0, 0], np.float32)[text]
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = net.gradient(words, windows, y)

    def loss():
        x, _ = net.inputs(words)
        gates = np.concatenate([x @ net.p["in"] + net.p["bias"], np.zeros((1, 6 * toxicity.HIDDEN))])
        s = net.pool(net.states(gates, windows, len(words.hash)), windows, len(words.hash))[2]
        return np.mean(np.log1p(np.exp(-s)) * y + np.log1p(np.exp(s)) * (1 - y))

    for k, p in net.p.items():
        flat, at = p.ravel(), int(np.argmax(np.abs(g[k].ravel())))
        old = flat[at]
        ends = []
        for step in (1e-2, -1e-2):
            flat[at] = old + step
            ends.append(loss())
        flat[at] = old
        assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(g[k].ravel()[at], rel=1e-2, abs=1e-5), k


def test_windows_cover_every_word():
    texts = ["", "a", "w " * 24, "w " * 25, "w " * 100, "x y"]
    w = toxicity.Words(texts)
    windows, text = w.windows()
    count = np.bincount(w.text, minlength=len(texts))
    for i, n in enumerate(count):
        own = windows[text == i]
        assert (len(own) == 0) == (n == 0)
        if n:
            assert len(own) == 1 + max(0, -(-(n - toxicity.WINDOW) // toxicity.STRIDE))
            assert (own != len(w.hash)).sum() >= n


def test_chain_marginals_against_all_paths():
    model = line_quality.LineModel([])
    rng = np.random.default_rng(0)
    model.moves, model.start = rng.normal(size=(2, 2)), 0.7
    e, d = rng.normal(size=7), np.array([0, 0, 0, 0, 1, 2, 2])
    p, two, first = model.marginals(e, d, pairs=True)
    want, pairs = np.zeros(7), np.zeros((2, 2))
    for doc in range(3):
        at = np.flatnonzero(d == doc)
        total, one, moved = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for path in np.ndindex(*[2] * len(at)):
            s = sum(e[k] for k, y in zip(at, path) if y) + model.start * path[0] + sum(model.moves[a, b] for a, b in zip(path, path[1:]))
            w = np.exp(s)
            total += w
            one += w * np.array(path)
            for a, b in zip(path, path[1:]):
                moved[a, b] += w
        want[at] = one / total
        pairs += moved / total
    assert np.allclose(p, want) and np.allclose(two, pairs)


def test_highest_windows_do_not_depend_on_groups(monkeypatch):
    dice = random.Random(6)
    texts = [None, "", *(sentence(dice, dice.choice(list(SYLLABLES)), dice.randint(0, 60)) for _ in range(40))]
    net = toxicity.Network(2)
    whole = net.highest(texts, False)
    monkeypatch.setattr("ledgerloom.llm.stream.GROUP_CHARS", 300)
    parts = net.highest(texts, False)
    assert [k for k, _, _ in whole] == [k for k, _, _ in parts] == [i for i, t in enumerate(texts) if t]
    for (_, h, t), (_, h2, t2) in zip(whole, parts):
        assert (h == h2).all() and all((x == y).all() for x, y in zip(t, t2))


def test_a_learnt_line_model_is_the_same_on_spark_and_off(spark):
    rows, labels = labelled(random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    model = line_quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "quality")
    local = line_quality.LineModel.of([t for _, t, _ in rows], [q for _, q, _ in labels])
    assert np.allclose(model.weights, local.weights) and np.allclose(model.moves, local.moves)
