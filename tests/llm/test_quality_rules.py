import random
import re

import numpy as np

from ledgerloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, hit = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit |= {p + k for p in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_base_counts(spark):
    dice = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b c a b c", "x x x x x", "a\nb\na\n a\n\n", "é|ñ* 日本\u00a0x\u2003y <b>\r\nq\x0bz\x1cw", "a b c d " * 40]
    texts += [" ".join(dice.choice("abcd") for _ in range(dice.randint(1, 90))) for _ in range(60)] + [" ".join(f"w{i}" for i in range(20000))]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in enumerate(texts)] + [(1, "", None, None, 3)], "doc_id long, text string, lang string, source string, n_words int")
    rows = q.judge(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert q.judge(docs.limit(0)).collect() == []


def test_base_counts_against_sql(spark):
    """The same counts in DuckDB's SQL, over a whole table."""
    import duckdb

    folder = "/root/testdata/sf0.001"
    found = duckdb.sql(f"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM '{folder}/documents.parquet'),
        g AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS three,
              list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w),
        places AS (SELECT doc_id, unnest(three) AS s, unnest(range(1, len(three) + 1)) AS i FROM g),
        twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
        hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id)
        SELECT g.doc_id, len(w), len(array_to_string(w, '')), len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')), len(lines) - len(list_distinct(lines)), coalesce(n, 0),
               len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) FROM g LEFT JOIN hit USING (doc_id)""").fetchall()
    rows = q.judge(spark.read.parquet(f"{folder}/documents.parquet")).select(*q.RESULT[:-2]).collect()
    assert sorted(map(tuple, rows)) == sorted(found) and len(found) >= 200


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = q.base_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def documents(dice, n, junk=False):
    for _ in range(n):
        words = ["".join(dice.choice("abcdefghij") for _ in range(dice.randint(2, 8))) for _ in range(int(dice.lognormvariate(5, 0.7)) + 60)]
        yield " ".join(w + (dice.choice(["***", "###", "&&&"]) if junk else "") for w in words)


def test_estimates_against_numpy_and_outliers_go(spark):
    dice = random.Random(4)
    rows = [(i, t, "en", dice.choice(["s", None])) for i, t in enumerate([*documents(dice, 400), *documents(dice, 20, junk=True)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    kept = {r.doc_id: r for r in q.judge(docs).collect()}
    assert all(kept[i].kept == (i < 400) for i in kept)

    # the least determinant of many more starts in numpy
    x = {g: [] for g in ("s", None)}
    for r in q.statistics(q.base_counts(docs, "doc_id", "source")).collect():
        x[r.source].append((r.doc_id, [r[c] for c in q.STATS]))
    for own in x.values():
        ids, v = [i for i, _ in own], np.array([s for _, s in own])
        count, best = int(np.ceil(q.CORE * len(v))), (np.inf, None)
        for start in range(40):
            first = v[np.random.default_rng(start).choice(len(v), 30, replace=False)] if start else v
            mean, low = first.mean(0), floored(np.cov(first.T, bias=True))
            for _ in range(30):
                d = (np.linalg.solve(low, (v - mean).T) ** 2).sum(0)
                core = v[d <= np.sort(d)[count - 1]]
                mean, low = core.mean(0), floored(np.cov(core.T, bias=True))
            best = min(best, (2 * np.log(np.diag(low)).sum(), start, mean, low), key=lambda b: b[0])
        d = (np.linalg.solve(best[3], (v - best[2]).T) ** 2).sum(0)
        d /= max(np.sort(d)[(len(d) + 1) // 2 - 1] / q.CHI_MEDIAN, 1)
        got = np.array([kept[i].distance for i in ids])
        assert np.allclose(got, d, rtol=0.05, atol=0.05)


def floored(cov):
    low = np.zeros_like(cov)
    for i in range(len(cov)):
        for j in range(i + 1):
            s = cov[i, j] - low[i, :j] @ low[j, :j]
            low[i, j] = np.sqrt(max(s, q.FLOORS[i])) if i == j else s / low[j, j]
    return low


def test_small_groups_keep_what_passes_the_base_rules(spark):
    text = " ".join(f"w{i}***" for i in range(80))
    docs = spark.createDataFrame([(1, text, "en", "s")] * 2, "doc_id long, text string, lang string, source string")
    assert [(r.kept, r.distance) for r in q.judge(docs).collect()] == [(True, None)] * 2


def test_small_groups_are_judged_by_their_language_or_the_corpus(spark):
    dice = random.Random(8)
    rows = [(i, t, "en", f"s{i % 20}") for i, t in enumerate(documents(dice, 200))] + [(1000 + i, t, "en", f"s{i}") for i, t in enumerate(documents(dice, 5, junk=True))]
    rows += [(2000, next(documents(dice, 1)), "de", "s0"), (2001, next(documents(dice, 1, junk=True)), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert len(got) == len(rows) and all(r.distance is not None for r in got.values())
    assert all(r.kept == (i < 1000 or i == 2000) for i, r in got.items())
