"""SentencePiece encoding and decoding as a max-plus scan.

A text's pieces are the best path in a lattice: an arc for every piece that the text holds
at a place, with a weight for it after the piece before. In a unigram model that is the
piece's score. In a BPE model it is 0 where the model's merges leave the two pieces apart
and minus infinity elsewhere: a sequence is the model's own if and only if all its
neighbours are such pairs. Words repeat, so each task solves a word once.

A giant text is split into chunks. A state at a chunk's edge is the piece that covers the
character before it; a chunk yields the matrix of best weights from the states at its start
to those at its end. Matrices are multiplied over blocks of chunks and then over the
document, which fixes the states at all edges, and each chunk is then traced on its own.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, keyed_text, slices
from ledgerloom.llm.token_counts import SPACE_MARK, model_path

GIANT_CHARS, CHUNK_CHARS, BLOCK_CHUNKS = 1 << 16, 1 << 13, 64
WORDS_KEPT, PAIRS_KEPT = 400_000, 1_000_000
NEVER = float("-inf")
WORD = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+|\n")
NORMAL, UNKNOWN, USER, BYTE, UNUSED = 1, 2, 4, 6, 5
RESULT = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"


class Lexicon:
    """A model's pieces. entries: (piece, score, kind) by id; merges: whether it is a BPE model."""

    def __init__(self, entries: list[tuple[str, float, int]], merges: bool, prefixed: bool = True):
        self.merges, self.prefixed = merges, prefixed
        self.ids = {p: i for i, (p, _, kind) in enumerate(entries) if kind in (NORMAL, USER, UNUSED)}
        self.score = {p: s for p, s, kind in entries if kind in (NORMAL, USER, UNUSED)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(entries) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(entries) if kind == UNKNOWN), 0)
        self.unknown_score = min(self.score.values(), default=0.0) - 10
        self.longest = max(map(len, self.ids), default=1)
        # places that no piece crosses, so that every path passes them
        self.apart = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}|\n.|.\n", p, re.S) for p in self.ids)
        self.surface = {i: (bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE_MARK, " ").encode() if kind in (NORMAL, USER, UNUSED) else b" \xe2\x81\x87 " if kind == UNKNOWN else b"") for i, (p, _, kind) in enumerate(entries)}
        # pieces that a path can have: of a BPE model those that its own merges reach
        self.good = {p: i for p, i in self.ids.items() if not merges or len(p) == 1 or self.merged(p) == [p]}
        # how long the pieces are that end with two characters, longest first
        sizes: dict[str, set[int]] = {}
        for p in self.good:
            if len(p) > 1:
                sizes.setdefault(p[-2:], set()).add(len(p))
        self.sizes = {k: tuple(sorted(v, reverse=True)) for k, v in sizes.items()}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, array] = {}

    @classmethod
    def load(cls, path: str) -> "Lexicon":
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if len(proto.normalizer_spec.precompiled_charsmap) or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError(f"{path}: a model that normalizes texts can't be decoded to them")
        return cls([(p.piece, p.score, p.type) for p in proto.pieces], proto.trainer_spec.model_type == 2, proto.normalizer_spec.add_dummy_prefix)

    def marked(self, text: str) -> str:
        """The text as the lattice reads it."""
        text = text.replace(" ", SPACE_MARK)
        return SPACE_MARK + text if text and self.prefixed else text

    def merged(self, s: str) -> list[str]:
        """What a BPE model's merges make of s: always the best neighbours, the first of equal ones."""
        parts = list(s)
        while len(parts) > 1:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                x = self.score.get(parts[k] + parts[k + 1], NEVER)
                if x > best:
                    best, at = x, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def piece(self, t: str) -> bool:
        """Whether t can be a piece of a path; any character can."""
        return t in self.good or len(t) == 1

    def key(self, t: str) -> int:
        i = self.good.get(t)
        return len(self.surface) + ord(t) if i is None else i

    def apart_from(self, before: str, t: str) -> bool:
        """Whether a BPE model's merges leave two pieces as they are."""
        k = self.key(before) << 22 | self.key(t)
        if (x := self.pairs.get(k)) is None:
            if len(self.pairs) > PAIRS_KEPT:
                self.pairs.clear()
            x = self.pairs[k] = self.merged(before + t) == [before, t]
        return x

    def weight(self, before: str, t: str) -> float:
        if not self.merges:
            return self.score.get(t, self.unknown_score)
        return 0.0 if not before or self.apart_from(before, t) else NEVER

    def path(self, s: str) -> tuple[list[str], float]:
        """The best path through a short text and its weight."""
        starts, weight = (self.merged_starts(s, [0], [0]), 0.0) if self.merges else self.scored_path(s)
        return self.pieces(s, starts), weight

    @staticmethod
    def pieces(s: str, starts: list[int]) -> list[str]:
        out, i = [], len(s)
        while i:
            out.append(s[starts[i] : i])
            i = starts[i]
        return out[::-1]

    def merged_starts(self, s: str, starts: list[int], keys: list[int]) -> list[int]:
        """Goes on with where the last piece of each prefix starts, and its key; only one piece fits, so the first that does is it."""
        good, pairs, sizes, extra = self.good, self.pairs, self.sizes, len(self.surface)
        for i in range(len(starts), len(s) + 1):
            for n in sizes.get(s[i - 2 : i], ()) if i > 1 else ():
                if n > i:
                    continue
                j = i - n
                t = s[j:i]
                k = good.get(t)
                if k is None:
                    continue
                if not j:
                    break
                fits = pairs.get(keys[j] << 22 | k)
                if fits is None:
                    fits = self.apart_from(s[starts[j] : j], t)
                if fits:
                    break
            else:
                j = i - 1
                k = good.get(s[j])
                if k is None:
                    k = extra + ord(s[j])
            starts.append(j)
            keys.append(k)
        return starts

    def learn(self, words: list[str]) -> None:
        """Solves sorted words, each from where it parts from the one before."""
        last, starts, keys = "", [0], [0]
        for s in words:
            if self.merges:
                same = 0
                for a, b in zip(last, s):
                    if a != b:
                        break
                    same += 1
                del starts[same + 1 :], keys[same + 1 :]
                self.words[s] = self.numbers(self.pieces(s, self.merged_starts(s, starts, keys)))
                last = s
            else:
                self.words[s] = self.numbers(self.path(s)[0])

    def scored_path(self, s: str) -> tuple[list[int], float]:
        starts, best = [0], [0.0]
        for i in range(1, len(s) + 1):
            top, at = NEVER, i - 1
            for j in range(max(i - self.longest, 0), i):
                if self.piece(t := s[j:i]) and best[j] + self.weight("", t) > top:
                    top, at = best[j] + self.weight("", t), j
            starts.append(at)
            best.append(top)
        return starts, best[-1]

    def numbers(self, pieces: list[str]) -> array:
        out = array("i")
        for t in pieces:
            if (i := self.ids.get(t)) is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in t.encode("utf-8", "surrogatepass"))
            elif not out or out[-1] != self.unknown:  # a run of unknown characters is one unknown piece
                out.append(self.unknown)
        return out

    def encode_all(self, texts: list[str | None]) -> list[array]:
        marked = [self.marked(t or "") for t in texts]
        if not self.apart:
            return [self.numbers(self.path(m)[0]) for m in marked]
        split = [WORD.findall(m) for m in marked]
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        self.learn(sorted(set().union(*split).difference(self.words)))
        get, out = self.words.__getitem__, []
        for words in split:
            ids = array("i")
            for x in map(get, words):
                ids.extend(x)
            out.append(ids)
        return out

    def encode(self, text: str | None) -> array:
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text[:1] == " " else text

    # --- chunks of giant texts ---

    def edge_states(self, text: str, at: int, first: bool, last: bool) -> list[tuple[str, int]]:
        """(piece, its end) of every piece over the character before at; at a text's ends there is only one state."""
        if first:
            return [("", at)]
        if last:
            return [("\0end", at)]
        return [(text[a:b], b) for a in range(max(0, at - self.longest), at) for b in range(at, min(len(text), a + self.longest) + 1) if self.piece(text[a:b])]

    def lattice(self, text: str, start: int, end: int, states: list[tuple[str, int]]):
        """Best weights from each of states to the pieces that begin in text[start:end], by end and piece.

        Vectors over states; where all paths pass a place, what follows is solved as words
        and the vectors only carry their weight on.
        """
        open_: dict[int, dict[str, np.ndarray]] = {}
        for k, (t, b) in enumerate(states):
            v = np.full(len(states), NEVER)
            v[k] = 0.0
            at = open_.setdefault(b, {})
            at[t] = np.maximum(at[t], v) if t in at else v
        i = start
        while i < end:
            here = open_.get(i)
            if here:
                if self.apart and i and self.passed(text, i) and (stop := self.last_pass(text, i, end)) > i:
                    v = np.maximum.reduce(list(here.values()))
                    words = WORD.findall(text[i:stop])
                    if not self.merges:
                        v = v + sum(self.path(s)[1] for s in words)
                    open_.setdefault(stop, {})[self.path(words[-1])[0][-1]] = v
                    i = stop
                    continue
                for j in range(i + 1, min(i + self.longest, len(text)) + 1):
                    t = text[i:j]
                    if not self.piece(t):
                        continue
                    for before, v in here.items():
                        w = self.weight(before, t)
                        if w > NEVER:
                            at = open_.setdefault(j, {})
                            at[t] = np.maximum(at[t], v + w) if t in at else v + w
            i += 1
        return open_

    def passed(self, text: str, i: int) -> bool:
        return text[i - 1] == "\n" or text[i : i + 1] == "\n" or (text[i : i + 1] == SPACE_MARK and text[i - 1] != SPACE_MARK)

    def last_pass(self, text: str, i: int, end: int) -> int:
        for k in range(end, i, -1):
            if k < len(text) and self.passed(text, k):
                return k
        return i

    def transfer(self, text: str, start: int, end: int, first: bool, last: bool) -> np.ndarray:
        before = self.edge_states(text, start, first, False)
        after = self.edge_states(text, end, False, last)
        open_ = self.lattice(text, start, end, before)
        out = np.full((len(before), len(after)), NEVER)
        for k, (t, b) in enumerate(after):
            if last:
                out[:, k] = np.maximum.reduce([*open_.get(end, {}).values(), np.full(len(before), NEVER)])
            elif t in open_.get(b, {}):
                out[:, k] = open_[b][t]
        return out

    def trace(self, text: str, start: int, end: int, first: bool, last: bool, entry: int, leave: int) -> array:
        """Ids of the pieces that begin in the chunk, from the state entry to the state leave."""
        before = self.edge_states(text, start, first, False)[entry]
        t, b = self.edge_states(text, end, False, last)[leave]
        if before[1] >= end and not last:
            return array("i")
        inner = text[before[1] : (end if last else b)]
        return self.numbers(self.between(before[0], inner, None if last else t))

    def between(self, before: str, s: str, final: str | None) -> list[str]:
        """The best path through s after the piece before, with final as its last piece."""
        head = next((k for k in range(1, len(s)) if self.apart and self.passed(s, k)), len(s))
        tail = next((k for k in range(len(s) - 1, head, -1) if self.passed(s, k)), head) if head < len(s) else head
        if head == len(s):
            return self.bounded(before, s, final)
        out = self.bounded(before, s[:head], None)
        for w in WORD.findall(s[head:tail]):
            out += self.path(w)[0]
        return out + self.bounded("", s[tail:], final)

    def bounded(self, before: str, s: str, final: str | None) -> list[str]:
        open_ = self.steps(before, s)
        ends = open_.get(len(s), {})
        t = final if final is not None else max(ends, key=lambda x: ends[x][0], default=None)
        out, i = [], len(s)
        while i > 0:
            out.append(t)
            i, t = i - len(t), open_[i][t][1]
        return out[::-1]

    def steps(self, before: str, s: str) -> dict[int, dict[str, tuple[float, str]]]:
        open_: dict[int, dict[str, tuple[float, str]]] = {0: {before: (0.0, "")}}
        for i in range(len(s)):
            for j in range(i + 1, min(i + self.longest, len(s)) + 1):
                if i in open_ and self.piece(t := s[i:j]):
                    for b, (x, _) in open_[i].items():
                        w = self.weight(b, t)
                        if w > NEVER and x + w > open_.setdefault(j, {}).get(t, (NEVER, ""))[0]:
                            open_[j][t] = (x + w, b)
        return open_


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    out = np.full((x.shape[0], y.shape[1]), NEVER)
    for k in range(x.shape[1]):
        np.maximum(out, x[:, k, None] + y[k], out=out)
    return out


def best_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The state at every edge of a row of chunks on the best way from entry to leave."""
    ahead = [matrices[0][entry]]
    for m in matrices[1:]:
        ahead.append((ahead[-1][:, None] + m).max(0))
    out = [leave]
    for k in range(len(matrices) - 1, 0, -1):
        out.append(int(np.argmax(ahead[k - 1] + matrices[k][:, out[-1]])))
    return [entry, *out[::-1]]


_LEXICONS: dict[str, Lexicon] = {}


def lexicon(path: str | None) -> Lexicon:
    path = path or model_path()
    if path not in _LEXICONS:
        _LEXICONS[path] = Lexicon.load(path)
    return _LEXICONS[path]


def pack(m: np.ndarray) -> dict:
    return {"rows": m.shape[0], "cells": m.tobytes()}


def unpack(x) -> np.ndarray:
    return np.frombuffer(x["cells"], np.float64).reshape(x["rows"], -1)


def split(marked: str, longest: int) -> list[tuple[int, int]]:
    """Edges of about equal chunks."""
    n = max(1, len(marked) // max(CHUNK_CHARS, 2 * longest))
    edge = [len(marked) * k // n for k in range(n + 1)]
    return list(zip(edge, edge[1:]))


def encode(docs: DataFrame, path: str | None = None, giant: int = GIANT_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip (decoding the ids gives the text) of every row.

    ids are those of the library for the model at path, without begin and end. A null or
    empty text has no ids and makes the trip. A literal mark for spaces (U+2581) counts and
    is decoded as a space, as in the library, and then doesn't make it. Texts longer than
    giant go through the scan over chunks, others are one chunk. Rows that repeat each give
    a row; other columns are not read; an empty table gives an empty result.
    """
    texts = keyed_text(docs)
    long = F.coalesce(F.length("text") > giant, F.lit(False))

    def run(batches):
        lex = lexicon(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            yield from result(b.column("doc_id"), [(i, t or "") for i, t in zip(lex.encode_all(texts), texts)], lex)

    small = bound_batches(texts.filter(~long)).mapInArrow(run, RESULT)
    large = texts.filter(long).withColumn("row", F.monotonically_increasing_id())
    return small.unionByName(encode_giants(cut_lineage(large), path))


def result(doc_id, found, lex: Lexicon):
    size = [len(i) for i, _ in found]
    flat = array("i")
    for i, _ in found:
        flat.extend(i)
    ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)))
    same = [lex.decode(i) == t for i, t in found]
    yield pa.RecordBatch.from_arrays([doc_id, pa.array(size, pa.int64()), ids, pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "ids", "round_trip"])


def encode_giants(texts: DataFrame, path: str | None) -> DataFrame:
    """encode for texts of any length, over chunks; texts: row (one for each text), doc_id and text."""
    n = slices(texts.sparkSession)

    def to_chunks(batches):
        lex = lexicon(path)
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                marked, keep = lex.marked(text), lex.longest + 1
                parts = split(marked, lex.longest)
                for k, (i, j) in enumerate(parts):
                    left = max(0, i - keep)
                    yield pa.RecordBatch.from_pylist([{"row": row, "k": k, "chunks": len(parts), "start": i - left, "end": j - left, "text": marked[left : j + keep]}], schema=schema)

    schema = pa.schema([("row", pa.int64()), ("k", pa.int32()), ("chunks", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])
    chunks = bound_batches(texts).mapInArrow(to_chunks, "row long, k int, chunks int, start int, end int, text string")
    chunks = cut_lineage(chunks.repartition(n, "row", "k").withColumn("block", F.expr(f"k div {BLOCK_CHUNKS}")))

    def matrices(batches):
        lex = lexicon(path)
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_pylist([{"row": r["row"], "block": r["block"], "k": r["k"], "chunks": r["chunks"], **pack(lex.transfer(r["text"], r["start"], r["end"], r["k"] == 0, r["k"] == r["chunks"] - 1))} for r in rows], schema=pa.schema([("row", pa.int64()), ("block", pa.int64()), ("k", pa.int32()), ("chunks", pa.int32()), ("rows", pa.int32()), ("cells", pa.binary())]))

    each = cut_lineage(chunks.mapInArrow(matrices, "row long, block long, k int, chunks int, rows int, cells binary"))

    def product(pdf):
        total = None
        for x in pdf.sort_values("k").to_dict("records"):
            total = unpack(x) if total is None else times(total, unpack(x))
        return pdf.head(1)[["row", "block"]].assign(**{k: [v] for k, v in pack(total).items()})

    blocks = each.groupBy("row", "block").applyInPandas(product, "row long, block long, rows int, cells binary")

    def whole(pdf):
        pdf = pdf.sort_values("block")
        states = best_states([unpack(x) for x in pdf.to_dict("records")], 0, 0)
        return pdf[["row", "block"]].assign(entry=states[:-1], leave=states[1:])

    edges = blocks.groupBy("row").applyInPandas(whole, "row long, block long, entry int, leave int")

    def inside(pdf):
        pdf = pdf.sort_values("k")
        states = best_states([unpack(x) for x in pdf.to_dict("records")], int(pdf["entry"].iloc[0]), int(pdf["leave"].iloc[0]))
        return pdf[["row", "k"]].assign(entry=states[:-1], leave=states[1:])

    states = each.join(edges, ["row", "block"]).groupBy("row", "block").applyInPandas(inside, "row long, k int, entry int, leave int")

    def trace(batches):
        lex = lexicon(path)
        for b in batches:
            rows = [(r["row"], r["k"], lex.trace(r["text"], r["start"], r["end"], r["k"] == 0, r["k"] == r["chunks"] - 1, r["entry"], r["leave"]).tolist()) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["row", "k", "ids"])

    traced = chunks.join(states, ["row", "k"]).select("row", "k", "chunks", "start", "end", "text", "entry", "leave").mapInArrow(trace, "row long, k int, ids array<int>")
    ids = traced.groupBy("row").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))

    def finish(batches):
        lex = lexicon(path)
        for b in batches:
            yield from result(b.column("doc_id"), [(array("i", i), t) for i, t in zip(b.column("ids").to_pylist(), b.column("text").to_pylist())], lex)

    return texts.join(ids, "row").select("doc_id", "text", "ids").mapInArrow(finish, RESULT)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of every row of doc_id and ids; null ids give an empty text."""

    def run(batches):
        lex = lexicon(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([lex.decode(i or []) for i in b.column("ids").to_pylist()], pa.string())], names=["doc_id", "text"])

    return bound_batches(tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))).mapInArrow(run, "doc_id long, text string")
