"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are bins of its own statistics and of the lines
before and after it. Forward-backward gives each line's probability of being good; weighted
by the lines' lengths they make the document's score. The chain is trained by gradient
ascent on documents' labels, which all their lines take. Executors count the statistics of
the fit's lines into fixed cells, whose sums give the bins' edges, and then return a byte
for each bin, so that no text comes to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, keyed_text, release, slices
from ledgerloom.llm.stream import capitals, code_points, groups, letters, mixed

#: The fit's bounded sample of labelled rows, and the lines of which it makes features at once.
FIT_ROWS, FIT_LINES = 4000, 1 << 17
#: Cells in which statistics are counted.
CELLS = np.r_[0.0, np.geomspace(1e-6, 64.0, 4095)]
STATISTICS = 8
BINS, STEPS, RATE, DECAY = 6, 120, 0.08, 2e-3
THRESHOLD = 0.3
RESULT = "doc_id long, held_out boolean, score double, predicted int"
MARKS = np.array([ord(c) for c in "#*$%&|<>!"], np.uint32)


def line_statistics(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of each line, its length, and the document it is of; a text without words has one line, of no length."""
    codes, starts = code_points(texts)
    ends = np.flatnonzero(codes == 10)
    begin = np.r_[0, ends + 1][: len(ends)]
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    add = lambda x: np.add.reduceat(x.astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    chars = add(~blank)
    word_at = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    doc = np.searchsorted(starts, begin, side="right") - 1
    line_of_word = np.searchsorted(begin, word_at, side="right") - 1
    n_words = np.bincount(line_of_word, minlength=len(begin))
    with np.errstate(over="ignore"):
        h = mixed(codes) * ~blank
        sums = np.add.reduceat(h, word_at) if len(word_at) else np.zeros(0, np.uint64)
    same = np.r_[False, (sums[1:] == sums[:-1]) & (line_of_word[1:] == line_of_word[:-1])] if len(sums) else np.zeros(0, bool)
    again = np.bincount(line_of_word, weights=same, minlength=len(begin))
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(h, begin) if len(begin) else np.zeros(0, np.uint64)
    upper, letter = add(capitals()[codes]), add(letters()[codes])
    marks, digits = add(np.isin(codes, MARKS)), add((codes >= 48) & (codes < 58))

    keep = n_words > 0
    doc_words = np.bincount(doc, weights=n_words, minlength=len(texts))
    keep[np.searchsorted(doc, np.flatnonzero(doc_words == 0))] = True
    at = np.flatnonzero(keep)
    d = doc[at]
    first = np.r_[True, d[1:] != d[:-1]] if len(d) else np.zeros(0, bool)
    repeat = np.r_[False, whole[at][1:] == whole[at][:-1]] & ~first if len(d) else first
    w, c = np.maximum(n_words[at], 1), np.maximum(chars[at], 1)
    stats = np.stack([
        np.log1p(n_words[at]), np.log(c / w), marks[at] / c, upper[at] / np.maximum(letter[at], 1), again[at] / w,
        digits[at] / c, repeat.astype(float), np.log1p(doc_words[d]),
    ], 1)
    return stats, chars[at], d


def padded(x: np.ndarray, d: np.ndarray, step: int) -> np.ndarray:
    """Bins of the line step places on in the same document, or -1."""
    out = np.full_like(x, -1)
    if step > 0:
        ok = d[step:] == d[:-step]
        out[:-step][ok] = x[step:][ok]
    else:
        ok = d[:step] == d[-step:]
        out[-step:][ok] = x[:step][ok]
    return out


def cell_counts(stats: np.ndarray) -> np.ndarray:
    """How many values of each statistic are in each cell."""
    at = np.clip(np.searchsorted(CELLS, stats, side="right") - 1, 0, len(CELLS) - 1)
    return np.stack([np.bincount(at[:, k], minlength=len(CELLS)) for k in range(STATISTICS)])


def bin_edges(counts: np.ndarray) -> list[np.ndarray]:
    """Of each statistic: what is over 0, quantiles, and two deviations over the mean."""
    out, n = [], int(counts[0].sum())
    for c in counts if n else ():
        quantiles = CELLS[np.searchsorted(np.cumsum(c), np.ceil(n * np.arange(1, BINS) / BINS))]
        mean = c @ CELLS / n
        out.append(np.unique(np.r_[1e-9, quantiles, mean + 2 * np.sqrt(c @ (CELLS - mean) ** 2 / n)]))
    return out


class LineModel:
    """Weights of features for good, and the chain's 2 x 2 transitions (0 bad, 1 good)."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges, self.width = edges, BINS + 4
        self.weights = np.zeros(3 * len(edges) * self.width + 1)
        self.moves = np.zeros((2, 2))
        self.start = 0.0

    @classmethod
    def of(cls, texts: list[str], labels: list[int]) -> "LineModel":
        """The model that these texts teach."""
        stats, _, d = line_statistics(texts)
        model = cls(bin_edges(cell_counts(stats)))
        bins = model.bins(stats)
        return model.teach([bins[d == k] for k in range(len(texts))], labels)

    def teach(self, docs: list[np.ndarray], labels: list[int]) -> "LineModel":
        """docs: the bins of each text's lines."""
        if len(set(labels)) == 2:
            self.train(docs, np.array(labels))
        else:
            self.weights[-1] = 0.0 if not labels else (3.0 if labels[0] else -3.0)
        return self

    def bins(self, stats: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, stats[:, k]) for k, e in enumerate(self.edges)], 1).astype(np.int8) if self.edges else np.zeros((len(stats), 0), np.int8)

    def features(self, bins: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Numbers of each line's features: its own bins, and those of the lines around it."""
        bins, parts = bins.astype(np.int64), []
        for block, x in enumerate((bins, padded(bins, d, -1), padded(bins, d, 1))):
            parts.append((x + 1) + (np.arange(bins.shape[1]) + block * bins.shape[1]) * self.width)
        return np.concatenate(parts, 1)

    def emissions(self, f: np.ndarray) -> np.ndarray:
        out = np.full(len(f), self.weights[-1])
        for k in range(f.shape[1]):
            out += self.weights[f[:, k]]
        return out

    def marginals(self, e: np.ndarray, d: np.ndarray, pairs: bool = False):
        """Probability of good for each line, and if asked for the summed probabilities of neighbouring pairs.

        All documents go forward and back together, line by line, the longest the longest.
        """
        n = len(e)
        begin = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if n else np.zeros(0, np.int64)
        length = np.diff(np.r_[begin, n])
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        good = 1 / (1 + np.exp(-np.clip(e, -30, 30)))
        local = np.stack([1 - good, good], 1)
        move = np.exp(self.moves - self.moves.max())
        forward, back = np.empty((n, 2)), np.empty((n, 2))
        most = int(length[0]) if n else 0
        active = np.searchsorted(-length, -np.arange(most), side="left") if n else []
        for t in range(most):
            at = begin[: active[t]] + t
            x = local[at] * (np.array([1.0, np.exp(self.start)]) if t == 0 else forward[at - 1] @ move)
            forward[at] = x / x.sum(1, keepdims=True)
        for t in range(most - 1, -1, -1):
            last = begin[: active[t]][length[: active[t]] == t + 1] + t
            back[last] = 1.0
            more = begin[: active[t + 1]] + t if t + 1 < most else begin[:0]
            x = (local[more + 1] * back[more + 1]) @ move.T
            back[more] = x / x.sum(1, keepdims=True)
        both = forward * back
        p = both[:, 1] / both.sum(1)
        if not pairs:
            return p
        left = np.flatnonzero(d[1:] == d[:-1])
        two = forward[left][:, :, None] * move[None] * (local[left + 1] * back[left + 1])[:, None, :]
        return p, (two / two.sum((1, 2), keepdims=True)).sum(0), begin

    def train(self, docs: list[np.ndarray], labels: np.ndarray) -> None:
        n, size = len(docs), len(self.weights)
        ends = np.cumsum([len(x) for x in docs])
        group = (ends - 1) // FIT_LINES
        parts = []
        for k in np.unique(group):
            of = np.flatnonzero(group == k)
            d = np.repeat(np.arange(len(of)), [len(docs[i]) for i in of])
            parts.append((np.concatenate([docs[i] for i in of]), d, labels[of][d]))
        kept = np.zeros((2, 2))
        for _, d, y in parts:
            for v in (0, 1):
                kept[v, v] += np.sum((d[1:] == d[:-1]) & (y[1:] == v))
        made = [self.features(bins, d) for bins, d, _ in parts] if len(parts) == 1 else None
        m, v = np.zeros(size + 5), np.zeros(size + 5)
        for step in range(1, STEPS + 1):
            g = np.zeros(size + 5)
            g[size : size + 4] = kept.ravel()
            for bins, d, y in parts:
                f = made[0] if made else self.features(bins, d)
                p, two, first = self.marginals(self.emissions(f), d, pairs=True)
                miss = y - p
                for k in range(f.shape[1]):
                    g[:size] += np.bincount(f[:, k], weights=miss, minlength=size)
                g[size - 1] += miss.sum()
                g[size : size + 4] -= two.ravel()
                g[size + 4] += miss[first].sum()
            now = np.r_[self.weights, self.moves.ravel(), self.start]
            g = g / n - DECAY * now
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            now = now + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.weights, self.moves, self.start = now[:size], now[size : size + 4].reshape(2, 2), float(now[-1])

    def scores(self, texts: list[str | None]) -> list[float]:
        out = []
        for a, b in groups(texts):
            stats, length, d = line_statistics(texts[a:b])
            p = self.marginals(self.emissions(self.features(self.bins(stats), d)), d)
            w = np.maximum(length, 1)
            out += (np.bincount(d, weights=p * w, minlength=b - a) / np.bincount(d, weights=w, minlength=b - a)).tolist()
        return out


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, learn="true") -> DataFrame:
    """doc_id, label and text of the rows labelled doc_ids with the least hash, in a checkpoint.

    Labels other than 0 and 1 and null doc_ids are left out; of several labels for one
    doc_id the least counts, of several texts that with the least hash. Null texts count as
    empty ones.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("label in (0, 1) and doc_id is not null").filter(learn)
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    known = marks.join(docs.filter("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.coalesce("text", F.lit(""))
    found = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64(text), text.alias("text"))).alias("t"))
    return cut_lineage(found.select("doc_id", "label", "t.text").repartition(slices(docs.sparkSession), "doc_id"))


def fit(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, learn="true") -> LineModel:
    sample = bound_batches(labelled(docs, labels, label, rows, learn))

    def count(batches):
        for b in batches:
            for i, j in groups(texts := b.column("text").to_pylist()):
                counts = cell_counts(line_statistics(texts[i:j])[0])
                k, cell = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(cell, pa.int32()), pa.array(counts[k, cell], pa.int64())], names=["k", "cell", "n"])

    counts = np.zeros((STATISTICS, len(CELLS)), np.int64)
    for k, cell, n in sample.mapInArrow(count, "k int, cell int, n long").groupBy("k", "cell").agg(F.sum("n")).collect():
        counts[k, cell] = n
    model = LineModel(bin_edges(counts))

    def bins(batches):
        for b in batches:
            for i, j in groups(texts := b.column("text").to_pylist()):
                stats, _, d = line_statistics(texts[i:j])
                found = model.bins(stats)
                part = [found[x:y].tobytes() for x, y in zip(*np.searchsorted(d, [np.arange(j - i), np.arange(1, j - i + 1)]))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("label").slice(i, j - i), pa.array(part, pa.binary())], names=["doc_id", "label", "bins"])

    learnt = sorted(sample.mapInArrow(bins, "doc_id long, label int, bins binary").collect())
    release(sample)
    width = max(len(model.edges), 1)
    return model.teach([np.frombuffer(r[2], np.int8).reshape(-1, width) for r in learnt], [r[1] for r in learnt])


def classify(docs: DataFrame, labels: DataFrame, buckets: int = 5, kept: int = 0, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score (of quality 1) and predicted (score >= THRESHOLD) of every row.

    Learns from labelled rows whose crc32(doc_id) mod buckets is not kept: rows of them, of
    whole texts (see labelled). A null or empty text has one line without words, and is
    scored like others; long texts are scored whole. Without labels of both kinds the score
    is the same for all. A null doc_id counts as an empty string. Rows that repeat each give
    a row; other columns are not read; an empty table gives an empty result.
    """
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % buckets == kept
    texts = keyed_text(docs).withColumn("held_out", out)
    model = docs.sparkSession.sparkContext.broadcast(fit(keyed_text(docs), labels, "quality", rows, ~out))

    def run(batches):
        for b in batches:
            scores = np.clip(model.value.scores(b.column("text").to_pylist()), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return bound_batches(texts).mapInArrow(run, RESULT)
