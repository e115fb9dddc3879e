"""Quality rules: base counts, then robust multivariate outliers, all in Spark's own functions.

Each language and source, and for small ones the language or the corpus, gets
minimum-covariance-determinant estimates of the transformed statistics. Three deterministic
starts (quartile widths, the covariance of squashed scores, that of directions) are
refitted to the CORE share of documents that are nearest under the estimate before; the
start with the least determinant goes on so until it falls no more. A document
goes where its squared Mahalanobis distance, scaled so that the group's median is that of a
chi-square variable, passes CUTOFF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import BLANK_CHARS, BLANKS, cut_lineage, release, written

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATS = ("x0", "x1", "x2", "x3", "x4")
CORE = 0.75
#: Refits at most, and the fall of a determinant's logarithm that asks for another one.
MOST_STEPS, LEAST_FALL = 20, 1e-3
CHI_MEDIAN = 4.351  # median of a chi-square variable with five degrees of freedom
# Chosen on labelled rows: of those that pass the base rules, quality 1 comes to 52 and quality 0 begins at 384.
CUTOFF = 80.0
LEAST_GROUP = 40
# Least variance of each statistic given those before it, so that a constant one doesn't reject every small departure.
FLOORS = (0.04, 0.002, 0.05, 0.01, 0.25)
GROUPS_TO_SEND = 20_000
RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"]


def without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def sorted_windows(words: Column) -> Column:
    """Each three words' hash and place, by hash."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    window = lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p"))
    return F.when(F.size(words) >= 3, F.sort_array(F.transform(at, window)))


def covered(windows: Column) -> Column:
    """Words inside windows that the text has twice or more.

    Sorted windows equal to a neighbour stay, and every place adds the words up to the next
    one, three at most.
    """
    equal = lambda x, i: (F.get(windows, i - 1)["h"] == x["h"]) | (F.get(windows, i + 1)["h"] == x["h"])
    places = F.sort_array(F.transform(F.filter(windows, lambda x, i: F.coalesce(equal(x, i), F.lit(False))), lambda x: x["p"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    walk = F.aggregate(places, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")))
    return F.coalesce(walk["n"], F.lit(0)).cast("long")


def base_counts(docs: DataFrame, *more: str) -> DataFrame:
    """The base counts of every row; a null text counts as an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANK_CHARS, "") != "")
    return (
        docs.select(*more, text.alias("text"), words.alias("words"), lines.alias("lines"))
        .select(
            *more,
            F.size("words").cast("long").alias("n_words"),
            without(F.col("text"), BLANK_CHARS).cast("long").alias("word_chars"),
            (F.length("text") - without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
            (F.length("text") - without(F.col("text"), CAPITALS)).cast("long").alias("n_capitals"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            sorted_windows(F.col("words")).alias("windows"),
        )
        .withColumn("n_repeat_words", covered(F.col("windows")))
        .drop("windows")
        .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    )


def statistics(counts: DataFrame) -> DataFrame:
    share = lambda c, of, times: F.log1p(F.lit(float(times)) * F.col(c) / F.greatest(F.col(of), F.lit(1)))
    x = (
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars", 1000),
        share("n_capitals", "word_chars", 10),
        share("n_repeat_words", "n_words", 100),
    )
    return counts.withColumns(dict(zip(STATS, x)))


def distance(rows: DataFrame) -> DataFrame:
    """The rows with d2, the squared distance, by forward substitution in the group's Cholesky factor."""
    y: list[str] = []
    for i in range(len(STATS)):
        left = F.col(STATS[i]) - F.col(f"m{i}")
        for j in range(i):
            left = left - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", left / F.col(f"l{i}{i}"))
        y.append(f"y{i}")
    return rows.withColumn("d2", sum((F.col(c) * F.col(c) for c in y[1:]), F.col(y[0]) * F.col(y[0]))).drop(*y)


def factor(groups: DataFrame) -> DataFrame:
    """Cholesky factor l of the covariances c, and the logarithm of their determinant; a variance under its floor becomes the floor."""
    p = range(len(STATS))
    for i in p:
        for j in range(i + 1):
            s = F.col(f"c{j}{i}")
            for k in range(j):
                s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            groups = groups.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(FLOORS[i]))) if i == j else s / F.col(f"l{j}{j}"))
    size = sum((F.log(F.col(f"l{i}{i}")) for i in p[1:]), F.log(F.col("l00")))
    return groups.withColumn("size", F.lit(2.0) * size).drop(*[f"c{j}{i}" for i in p for j in range(i + 1)])


def estimate(core: DataFrame) -> DataFrame:
    p = range(len(STATS))
    return factor(core.groupBy("grp", "start").agg(
        *[F.avg(STATS[i]).alias(f"m{i}") for i in p],
        *[F.covar_pop(STATS[j], STATS[i]).alias(f"c{j}{i}") for i in p for j in range(i + 1)],
    ))


def first_estimates(fit: DataFrame, send) -> DataFrame:
    """Three of each group, around its medians: quartile widths alone, covariances of squashed scores, and of directions."""
    p = range(len(STATS))
    quartiles = fit.groupBy("grp").agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], F.lit(1000)).alias(c) for c in STATS])
    width = lambda i: F.sqrt(F.greatest(F.pow((F.col(STATS[i])[2] - F.col(STATS[i])[0]) / F.lit(1.349), F.lit(2)), F.lit(FLOORS[i])))
    middle = quartiles.select("grp", *[F.col(STATS[i])[1].alias(f"m{i}") for i in p], *[width(i).alias(f"w{i}") for i in p])
    scores = fit.join(send(middle), "grp").select("grp", *[((F.col(STATS[i]) - F.col(f"m{i}")) / F.col(f"w{i}")).alias(f"z{i}") for i in p])
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in p[1:]), F.col("z0") * F.col("z0")))
    scores = scores.withColumn("length", F.greatest(length, F.lit(1e-9)))
    made = scores.groupBy("grp").agg(*[
        F.avg(f(i) * f(j)).alias(f"{name}{j}{i}")
        for name, f in (("t", lambda i: F.tanh(f"z{i}")), ("u", lambda i: F.col(f"z{i}") / F.col("length")))
        for i in p for j in range(i + 1)])
    both = middle.join(made, "grp")
    start = lambda number, c: both.select(
        "grp", F.lit(number).alias("start"), *[f"m{i}" for i in p],
        *[(c(i, j) * F.col(f"w{i}") * F.col(f"w{j}")).alias(f"c{j}{i}") for i in p for j in range(i + 1)])
    starts = (start(0, lambda i, j: F.lit(float(i == j))), start(1, lambda i, j: F.col(f"t{j}{i}")), start(2, lambda i, j: F.col(f"u{j}{i}")))
    return factor(starts[0].unionByName(starts[1]).unionByName(starts[2]))


def refitted(fit: DataFrame, now: DataFrame, send) -> DataFrame:
    """Estimates of the CORE share of each group's rows that is nearest under the ones given."""
    near = distance(fit.join(send(now.drop("size")), "grp")).select("grp", "start", *STATS, "d2")
    cut = near.groupBy("grp", "start").agg(F.percentile_approx("d2", F.lit(CORE), F.lit(1000)).alias("cut"))
    return estimate(near.join(send(cut), ["grp", "start"]).filter(F.col("d2") <= F.col("cut")))


def least_determinants(fit: DataFrame, send) -> DataFrame:
    """Of each group the estimate that refits come to from its best start.

    All starts are refitted twice, and the one with the least determinant goes on. A refit
    never has a larger determinant, but for the share's approximate bound and the floors, so
    a group whose determinant doesn't fall any more is at its end.
    """
    now = cut_lineage(first_estimates(fit, send))
    for _ in range(2):
        before, now = now, cut_lineage(refitted(fit, now, send))
        release(before)
    best = now.groupBy("grp").agg(F.min_by(F.struct(*[c for c in now.columns if c != "grp"]), F.struct("size", "start")).alias("best"))
    falling, done = cut_lineage(best.select("grp", "best.*")), []
    for _ in range(MOST_STEPS):
        further = refitted(fit, falling, send).join(falling.select("grp", F.col("size").alias("before")), "grp")
        further = cut_lineage(further.withColumn("falls", F.col("before") - F.col("size") >= F.lit(LEAST_FALL)).drop("before"))
        done.append(further.filter("not falls"))
        falling = further.filter("falls")
        if falling.isEmpty():
            break
    for part in done:
        falling = falling.unionByName(part)
    return falling.drop("start", "size", "falls")


def pooled(rows: DataFrame) -> DataFrame:
    """Of each language and source (own): grp, whose estimate judges it, and feeds, the estimates that its rows enter.

    grp is the first of own, its language and the whole corpus with LEAST_GROUP fitted rows.
    """
    enough = lambda c: F.col(c) >= LEAST_GROUP
    groups = cut_lineage(rows.groupBy("own", "speech").agg(F.count_if(~F.col("base_failed")).alias("n")))
    spoken = groups.groupBy("speech").agg(F.sum("n").alias("spoken"), F.count_if(~enough("n")).alias("lacking"))
    whole = (groups.agg(F.sum("n")).first()[0] or 0) >= LEAST_GROUP
    asked = whole and not spoken.filter((F.col("lacking") > 0) & ~enough("spoken")).isEmpty()
    corpus = lambda there: F.lit("all" if there else None).cast("string")
    grp = F.when(enough("n"), F.col("own")).when(enough("spoken"), F.col("speech")).otherwise(corpus(whole))
    feeds = F.array(F.when(enough("n"), F.col("own")), F.when((F.col("lacking") > 0) & enough("spoken"), F.col("speech")), corpus(asked))
    return groups.join(spoken, "speech").select("own", grp.alias("grp"), F.array_compact(feeds).alias("feeds"))


def verdicts(docs: DataFrame, carry: str, cutoff: float = CUTOFF) -> DataFrame:
    """The column carry, and judge's other columns, of every row of docs (carry, text, lang and source)."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    rows = docs.select(F.col(carry).alias("carry"), F.col("text").cast("string").alias("text"), F.concat(F.lit("g"), name("lang"), F.lit("\x00"), name("source")).alias("own"), F.concat(F.lit("l"), name("lang")).alias("speech"))
    rows = written(statistics(base_counts(rows, "carry", "own", "speech")))
    pools = cut_lineage(pooled(rows))
    small = pools.count() <= GROUPS_TO_SEND
    send = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    fit = rows.filter(~F.col("base_failed")).select("own", *STATS).join(send(pools.select("own", "feeds")), "own").select(F.explode("feeds").alias("grp"), *STATS)
    now = cut_lineage(least_determinants(fit, send))
    middle = distance(fit.join(send(now), "grp")).groupBy("grp").agg(F.percentile_approx("d2", F.lit(0.5), F.lit(1000)).alias("middle"))
    now = cut_lineage(now.join(middle, "grp"))
    # A group's median may only widen its ellipse: floors alone can make distances small.
    scaled = F.col("d2") / F.greatest(F.col("middle") / F.lit(CHI_MEDIAN), F.lit(1.0))
    return (
        distance(rows.join(send(pools.select("own", "grp")), "own").join(send(now), "grp", "left"))
        .withColumn("distance", scaled)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.lit(cutoff), F.lit(True)))
        .select("carry", *RESULT[1:])
    )


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, base counts, base_failed, kept and distance of every row.

    Words are runs of other characters than space and U+0009 to U+000D. A null text counts
    as empty and fails the base rules, as every text under 50 words does; long texts count
    whole. Estimates are of the rows of a language and source (null is a value of its own)
    that pass the base rules; where they are fewer than LEAST_GROUP, of those of the
    language over all sources, and then of the whole corpus. Only in a corpus with fewer of
    them is distance null, and the base rules alone decide. Rows that repeat each give a
    row, and count as often. Other columns are not read; an empty table gives an empty result.
    """
    return verdicts(docs.select(F.col("doc_id").cast("long").alias("carry"), "text", "lang", "source"), "carry", cutoff).withColumnRenamed("carry", "doc_id").select(*RESULT)
