"""Toxicity from a bidirectional gated recurrent network with attention pooling.

A word's input is its own embedding, where the fit knows it, and the mean embedding of its
character triples. The network reads windows of WINDOW words, one every STRIDE words, and a
document's score is its most toxic window's. Documents' labels train it in numpy: in each
round executors find every labelled document's highest window, and the driver goes down the
gradient through time on these; it gets no other text. Words that part the labels start
with their log odds as the first component of their embedding; all else starts at random.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm.common import bound_batches, keyed_text, release
from ledgerloom.llm.line_quality import labelled
from ledgerloom.llm.stream import code_points, groups, letters, mixed

WINDOW, STRIDE = 24, 12
HIDDEN, WORD_DIM, TRIPLE_DIM, TRIPLES = 8, 4, 4, 4096
VOCABULARY, LEAST_TEXTS = 4000, 3
#: Share of known words that a step reads by their characters alone, and the pull to 0 of all weights.
UNSEEN, DECAY = 0.4, 0.03
#: The fit's bounded sample of labelled rows.
FIT_ROWS = 4000
ROUNDS, STEPS, RATE = 6, 14, 0.02
BLOCK = 4096
THRESHOLD = 0.7
RESULT = "doc_id long, held_out boolean, score double, predicted int"


class Words:
    """Distinct words of some texts; number: which one each token is; windows of tokens and the text of each window."""

    def __init__(self, texts: list[str | None]):
        codes, starts = code_points([(t or "").lower() for t in texts])
        letter = letters()[codes]
        begin = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
        self.texts = len(texts)
        at = np.flatnonzero(letter)
        run = np.cumsum(letter & ~np.r_[False, letter[:-1]])[at] - 1
        place = at - begin[run] if len(at) else at
        hashes = mixed(codes[at].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(21)))
        size = np.bincount(run, minlength=len(begin))
        edge = np.r_[0, np.cumsum(size)[:-1]].astype(np.int64) if len(begin) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            word = np.add.reduceat(hashes, edge) if len(begin) else np.zeros(0, np.uint64)
        self.hash, first, self.number = np.unique(word, return_index=True, return_inverse=True)
        self.text = np.searchsorted(starts, begin, side="right") - 1
        # character triples of the distinct words, around each character, edges being 0
        n = size[first]
        self.triple_edge = np.r_[0, np.cumsum(n)[:-1]].astype(np.int64) if len(n) else np.zeros(0, np.int64)
        spot = np.repeat(begin[first], n) + np.arange(int(n.sum())) - np.repeat(self.triple_edge, n)
        c = np.where(letter, codes, 0).astype(np.uint64)
        around = c[spot] << np.uint64(21)
        around |= np.where(spot > 0, c[spot - 1], 0)  # the character after the last is a line end
        around |= c[np.minimum(spot + 1, len(c) - 1)] << np.uint64(42)
        self.triple, self.triple_n = (mixed(around, 1) % np.uint64(TRIPLES)).astype(np.int64), n

    @classmethod
    def joined(cls, hashes: np.ndarray, triples: list[np.ndarray]) -> tuple["Words", np.ndarray]:
        """The distinct ones of words given by hash and triples, and the place of each word among them."""
        out = object.__new__(cls)
        out.hash, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        out.triple_n = np.array([len(triples[k]) for k in first], np.int64)
        out.triple_edge = np.cumsum(out.triple_n) - out.triple_n
        out.triple = np.concatenate([triples[k] for k in first]) if len(first) else np.zeros(0, np.int64)
        return out, number

    def triples_of(self, word: int) -> np.ndarray:
        return self.triple[self.triple_edge[word] : self.triple_edge[word] + self.triple_n[word]]

    def of(self, windows: np.ndarray) -> tuple["Words", np.ndarray]:
        """Only the distinct words in these windows, and the windows in their numbers."""
        used, number = np.unique(windows, return_inverse=True)
        number, used = number.reshape(windows.shape), used[used < len(self.hash)]
        out = object.__new__(Words)
        out.hash, n = self.hash[used], self.triple_n[used]
        out.triple_n, out.triple_edge = n, np.r_[0, np.cumsum(n)[:-1]].astype(np.int64)
        out.triple = self.triple[np.repeat(self.triple_edge[used] - out.triple_edge, n) + np.arange(int(n.sum()))]
        return out, number

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """A row of token numbers for each window (past the end: the number of distinct words), and its text."""
        count = np.bincount(self.text, minlength=self.texts)
        ends = np.cumsum(count)
        per = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
        text = np.repeat(np.arange(self.texts), per)
        start = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE + (ends - count)[text]
        at = start[:, None].astype(np.int32) + np.arange(WINDOW, dtype=np.int32)
        ok = at < ends[text][:, None]
        return np.where(ok, self.number[np.minimum(at, max(len(self.number) - 1, 0))] if len(self.number) else 0, len(self.hash)).astype(np.int32), text


def squash(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    def __init__(self, seed: int = 0):
        r, h = np.random.default_rng(seed), HIDDEN
        small = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
        self.p = {
            "word": small(VOCABULARY + 1, WORD_DIM) * np.float32(0.1), "triple": small(TRIPLES, TRIPLE_DIM),
            "in": small(WORD_DIM + TRIPLE_DIM, 6 * h), "bias": np.zeros(6 * h, np.float32),
            "ahead": small(h, 3 * h), "back": small(h, 3 * h),
            "look": small(2 * h), "out": small(2 * h), "base": np.array([-2.0], np.float32),
        }
        self.p["word"][0] = 0
        self.known = np.zeros(0, np.uint64)

    def vocabulary(self, w: Words) -> np.ndarray:
        """1 + the place among known words, or 0."""
        if not len(self.known):
            return np.zeros(len(w.hash), np.int64)
        at = np.minimum(np.searchsorted(self.known, w.hash), len(self.known) - 1)
        return np.where(self.known[at] == w.hash, at + 1, 0)

    def inputs(self, w: Words, unseen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        vocabulary = self.vocabulary(w)
        if unseen is not None:
            vocabulary = np.where(unseen, 0, vocabulary)
        if not len(w.hash):
            return np.zeros((0, WORD_DIM + TRIPLE_DIM), np.float32), vocabulary
        triples = np.add.reduceat(self.p["triple"][w.triple], w.triple_edge, axis=0) / w.triple_n[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][vocabulary], triples], 1), vocabulary

    def states(self, gates: np.ndarray, windows: np.ndarray, pad: int, keep: list | None = None) -> np.ndarray:
        """Hidden states (WINDOW, windows, both directions); keep gets what the gradient needs."""
        h = HIDDEN
        out = np.zeros((WINDOW, len(windows), 2 * h), np.float32)
        padded = windows == pad
        any_pad = padded.any(0)
        for side, name in enumerate(("ahead", "back")):
            u, state = self.p[name], np.zeros((len(windows), h), np.float32)
            own = np.ascontiguousarray(gates[:, side * 3 * h : (side + 1) * 3 * h])
            for t in range(WINDOW) if side == 0 else range(WINDOW - 1, -1, -1):
                x = own[windows[:, t]]
                y = state @ u
                zr = squash(x[:, : 2 * h] + y[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                n = np.tanh(x[:, 2 * h :] + r * y[:, 2 * h :])
                new = n + z * (state - n)
                if any_pad[t]:
                    new = np.where(padded[:, t, None], state, new)
                if keep is not None:
                    keep.append((side, t, state, z, r, n, y[:, 2 * h :]))
                state = out[t, :, side * h : (side + 1) * h] = new
        return out

    def pool(self, states: np.ndarray, windows: np.ndarray, pad: int):
        look = states @ self.p["look"]
        look[(windows == pad).T] = -1e9
        look = np.exp(look - look.max(0))
        look /= look.sum(0)
        pooled = np.einsum("tn,tnk->nk", look, states)
        return look, pooled, pooled @ self.p["out"] + self.p["base"][0]

    def window_scores(self, w: Words, windows: np.ndarray) -> np.ndarray:
        x, _ = self.inputs(w)
        gates = np.concatenate([x @ self.p["in"] + self.p["bias"], np.zeros((1, 6 * HIDDEN), np.float32)])
        out = np.empty(len(windows), np.float32)
        for i in range(0, len(windows), BLOCK):
            part = windows[i : i + BLOCK]
            out[i : i + BLOCK] = self.pool(self.states(gates, part, len(w.hash)), part, len(w.hash))[2]
        return out

    def gradient(self, w: Words, windows: np.ndarray, labels: np.ndarray, unseen: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the windows; w: the words that are in them."""
        h, pad, p = HIDDEN, len(w.hash), self.p
        x, vocabulary = self.inputs(w, unseen)
        gates = np.concatenate([x @ p["in"] + p["bias"], np.zeros((1, 6 * h), np.float32)])
        keep: list = []
        states = self.states(gates, windows, pad, keep)
        look, pooled, score = self.pool(states, windows, pad)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((1 / (1 + np.exp(-score)) - labels) / len(labels)).astype(np.float32)
        g["out"], g["base"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dp = d[:, None] * p["out"]
        dlook = np.einsum("nk,tnk->tn", dp, states)
        dlook = look * (dlook - (look * dlook).sum(0))
        g["look"] = np.einsum("tn,tnk->k", dlook, states)
        dstates = look[:, :, None] * dp + dlook[:, :, None] * p["look"]
        each = np.zeros((WINDOW, len(windows), 6 * h), np.float32)
        carry = {0: np.zeros((len(windows), h), np.float32), 1: np.zeros((len(windows), h), np.float32)}
        for side, t, state, z, r, n, yn in reversed(keep):
            name = ("ahead", "back")[side]
            dh = carry[side] + dstates[t, :, side * h : (side + 1) * h]
            real = (windows[:, t] != pad)[:, None]
            dn, dz = dh * (1 - z) * (1 - n * n) * real, dh * (state - n) * z * (1 - z) * real
            dr = dn * yn * r * (1 - r)
            dx = np.concatenate([dz, dr, dn], 1)
            dy = np.concatenate([dz, dr, dn * r], 1)
            g[name] += state.T @ dy
            carry[side] = np.where(real, dh * z, dh) + dy @ p[name].T
            each[t, :, side * 3 * h : (side + 1) * 3 * h] = dx
        number = windows.T.ravel()
        order = np.argsort(number, kind="stable")
        edge = np.searchsorted(number[order], np.arange(pad))
        real = int(np.searchsorted(number[order], pad))
        dgates = np.add.reduceat(each.reshape(-1, 6 * h)[order[:real]], edge, axis=0)
        g["in"], g["bias"] = x.T @ dgates, dgates.sum(0)
        dx = dgates @ p["in"].T
        for k in range(WORD_DIM):
            g["word"][:, k] = np.bincount(vocabulary, weights=dx[:, k], minlength=VOCABULARY + 1)
        g["word"][0] = 0
        share = dx[:, WORD_DIM:] / w.triple_n[:, None]
        for k in range(TRIPLE_DIM):
            g["triple"][:, k] = np.bincount(w.triple, weights=np.repeat(share[:, k], w.triple_n), minlength=TRIPLES)
        return g

    def learn_words(self, hashes: np.ndarray, pull: np.ndarray) -> None:
        """Known words, with a first embedding by how they part the labels."""
        order = np.argsort(hashes)
        self.known = hashes[order]
        self.p["word"][1 : len(order) + 1, 0] = np.clip(pull[order] / 4, -2, 2)

    def first_scores(self, w: Words, windows: np.ndarray) -> np.ndarray:
        """Before the first round: the largest first embedding in each window."""
        return np.r_[self.p["word"][self.vocabulary(w), 0], -9.0][windows].max(1)

    def highest(self, texts: list[str | None], first: bool) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
        """Of each text with words: its number, and hashes and triples of the words of its highest window."""
        out = []
        for a, b in groups(texts):
            w = Words(texts[a:b])
            windows, text = w.windows()
            score = self.first_scores(w, windows) if first else self.window_scores(w, windows)
            order = np.lexsort((-score, text))
            for k in order[np.r_[True, text[order][1:] != text[order][:-1]]] if len(order) else ():
                words = windows[k][windows[k] < len(w.hash)]
                out.append((a + int(text[k]), w.hash[words], [w.triples_of(x) for x in words]))
        return out

    def train(self, labels: list[int], top) -> "Network":
        """top(network, first) gives, for some of the labelled texts, the label and the words of the highest window."""
        if len(set(labels)) < 2:
            self.p["out"][:] = 0
            self.p["base"][0] = 6.0 if labels and labels[0] else -6.0
            return self
        m, v, step, dice = {}, {}, 0, np.random.default_rng(0)
        for round_ in range(ROUNDS):
            found = top(self, round_ == 0)
            y = np.array([label for label, _, _ in found], np.float32)
            own, flat = Words.joined(np.concatenate([h for _, h, _ in found]), [t for _, _, ts in found for t in ts])
            numbers = np.full((len(found), WINDOW), len(own.hash), np.int32)
            numbers[np.arange(WINDOW) < np.array([len(h) for _, h, _ in found])[:, None]] = flat
            for _ in range(STEPS):
                step += 1
                g = self.gradient(own, numbers, y, dice.random(len(own.hash)) < UNSEEN)
                for k in g:
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g[k]
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g[k] ** 2
                    self.p[k] = (self.p[k] * (1 - RATE * DECAY) - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The highest window's probability of each text; 0 for one without words."""
        out = np.zeros(len(texts))
        for a, b in groups(texts):
            w = Words(texts[a:b])
            windows, text = w.windows()
            if len(windows):
                first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
                best = np.maximum.reduceat(self.window_scores(w, windows), first).astype(np.float64)
                out[a + text[first]] = 1 / (1 + np.exp(-best))
        return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, learn="true") -> Network:
    """The network that rows labelled texts teach, whole ones; of them the driver gets words' counts and one window each."""
    sample = bound_batches(labelled(docs, labels, "toxic", rows, learn))
    spark = docs.sparkSession

    def count(batches):
        for b in batches:
            texts, bad = b.column("text").to_pylist(), b.column("label").to_numpy()
            for i, j in groups(texts):
                w = Words(texts[i:j])
                both = np.unique(w.text.astype(np.int64) * len(w.hash) + w.number)
                text, word = both // max(len(w.hash), 1), both % max(len(w.hash), 1)
                n, toxic = np.bincount(word, minlength=len(w.hash)), np.bincount(word, weights=bad[i:j][text], minlength=len(w.hash))
                yield pa.RecordBatch.from_arrays([pa.array(w.hash.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(toxic.astype(np.int64))], names=["word", "n", "bad"])

    marks = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    network = Network()
    if len(marks) == 2:
        rate = marks[1] / (marks[0] + marks[1])
        expected, spread = F.col("n") * F.lit(rate), F.sqrt(F.col("n") * F.lit(rate * (1 - rate)) + F.lit(1.0))
        words = (
            sample.mapInArrow(count, "word long, n long, bad long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
            .filter(F.col("n") >= LEAST_TEXTS).select("word", ((F.col("bad") - expected) / spread).alias("pull"))
            .orderBy(F.desc(F.abs("pull")), "word").limit(VOCABULARY).collect()
        )
        network.learn_words(np.array([r[0] for r in words], np.int64).view(np.uint64), np.array([r[1] for r in words], np.float64))

    def top(network: Network, first: bool):
        model = spark.sparkContext.broadcast(network)

        def windows(batches):
            for b in batches:
                ids, marks = b.column("doc_id").to_numpy(), b.column("label").to_numpy()
                best = model.value.highest(b.column("text").to_pylist(), first)
                at = np.array([k for k, _, _ in best], np.int64)
                packed = lambda parts: pa.array([x.tobytes() for x in parts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(marks[at], pa.int32()), packed(h for _, h, _ in best),
                     packed(np.array([len(t) for t in ts], np.uint32) for _, _, ts in best), packed(np.concatenate(ts).astype(np.uint16) for _, _, ts in best)],
                    names=["doc_id", "label", "hashes", "sizes", "triples"])

        found = sorted(sample.mapInArrow(windows, "doc_id long, label int, hashes binary, sizes binary, triples binary").collect())
        model.unpersist()
        parts = lambda r: np.split(np.frombuffer(r[4], np.uint16).astype(np.int64), np.cumsum(np.frombuffer(r[3], np.uint32))[:-1])
        return [(r[1], np.frombuffer(r[2], np.uint64), parts(r)) for r in found]

    network.train([label for label, n in marks.items() for _ in range(min(n, 1))], top)
    release(sample)
    return network


def score(docs: DataFrame, labels: DataFrame, buckets: int = 3, kept: int = 1, rows: int = FIT_ROWS, carry: list[str] = ()) -> DataFrame:
    """doc_id, held_out, score (of toxic 1) and predicted (score >= THRESHOLD) of every row.

    Learns from labelled rows whose crc32(doc_id) mod buckets is not kept: rows of them at
    most, of whole texts (see line_quality.labelled). Every word of every text is in a
    scored window; words are runs of letters, in lower case. A null text, an empty one and
    one without letters score 0. Without labels of both kinds the score is the same for all
    texts with words. A null doc_id counts as an empty string. Rows that repeat each give a
    row; other columns are not read, but for those named in carry, which the result has too;
    an empty table gives an empty result.
    """
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % buckets == kept
    texts = keyed_text(docs, *carry)
    model = docs.sparkSession.sparkContext.broadcast(fit(texts, labels, rows, ~out))

    def run(batches):
        for b in batches:
            found = model.value.scores(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(found, pa.float64()), pa.array((found >= THRESHOLD).astype(np.int32)), *(b.column(c) for c in carry)], names=["doc_id", "held_out", "score", "predicted", *carry])

    result = T.StructType([*T._parse_datatype_string(RESULT).fields, *(texts.schema[c] for c in carry)])
    return bound_batches(texts.withColumn("held_out", out)).mapInArrow(run, result)
