"""Token counts of a SentencePiece BPE model, from pre-token frequencies.

No piece of such a model holds a space after another character, or a line end, so merges
never cross those places: a text's count is the sum over its pre-tokens (spaces with the
word after them, or a line end). The corpus's distinct pre-tokens are put into one table,
and the library counts the pieces of each once. Documents' pre-token frequencies are joined
to it: the most frequent pre-tokens, a bounded number, are sent to all workers and summed
where the document is; the rare rest, which no key dominates, is joined by a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, keyed_text, release, written

PRE_TOKEN = re.compile(r" *[^ \n]+| +|\n")
SLICE_CHARS = 1 << 22
#: Pre-tokens that are sent to all workers at most, and those that a worker collects before it passes them on.
FREQUENT, HELD = 1 << 18, 1 << 19
SPACE_MARK = "▁"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain_processor(path: str):
    """The library on the same model, but without the space it puts before a text."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    bad = [p.piece for p in proto.pieces if p.type == 1 and (re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p.piece) or "\n" in p.piece)]
    if bad or len(proto.normalizer_spec.precompiled_charsmap) or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError(f"{path}: pre-tokens don't part this model's pieces ({bad[:3]})")
    prefixed = proto.normalizer_spec.add_dummy_prefix
    proto.normalizer_spec.add_dummy_prefix = False
    return SentencePieceProcessor(model_proto=proto.SerializeToString()), prefixed


def frequencies(text: str | None, prefixed: bool) -> Counter:
    """How often a text has each pre-token."""
    text = (text or "").replace(SPACE_MARK, " ")
    if text and prefixed:
        text = " " + text
    if len(text) <= SLICE_CHARS:
        return Counter(PRE_TOKEN.findall(text))
    return Counter(m[0] for m in PRE_TOKEN.finditer(text))


_PROCESSORS: dict[str, tuple] = {}


def processor_of(path: str):
    if path not in _PROCESSORS:
        _PROCESSORS[path] = plain_processor(path)
    return _PROCESSORS[path]


def piece_table(texts: DataFrame, path: str | None) -> DataFrame:
    """token, n (how often the corpus has it) and pieces of every distinct pre-token."""

    def collect(batches):
        _, prefixed = processor_of(path or model_path())
        seen: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                seen.update(frequencies(text, prefixed))
                if len(seen) > HELD:
                    yield from passed_on(seen)
                    seen = Counter()
        yield from passed_on(seen)

    def passed_on(seen: Counter):
        tokens = list(seen)
        for i in range(0, len(tokens), 1 << 16):
            part = tokens[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([seen[t] for t in part], pa.int64())], names=["token", "n"])

    def pieces(batches):
        processor, _ = processor_of(path or model_path())
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("token"), b.column("n"), pa.array(map(len, processor.encode(b.column("token").to_pylist(), num_threads=1)), pa.int64())], names=["token", "n", "pieces"])

    tokens = texts.select("text").mapInArrow(collect, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return written(tokens.mapInArrow(pieces, "token string, n long, pieces long"))


def most_frequent(table: DataFrame, most: int) -> dict[str, int]:
    """Pieces of the pre-tokens that are at least so frequent that there are no more than most of them."""
    level = F.floor(F.log2("n")).cast("int")
    least, room = None, most
    for power, n in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        if n > room:
            break
        least, room = power, room - n
    if least is None:
        return {}
    return {r[0]: r[1] for r in table.filter(level >= least).select("token", "pieces").collect()}


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    A null or empty text has no bytes and no tokens; long texts count whole. Rows that
    repeat, also in doc_id, each give a row; a null doc_id stays null. Other columns are not
    read. An empty table gives an empty result. path: the model, where executors find it
    (default: the public file). frequent: pre-tokens that are sent to all workers at most.
    """
    texts = bound_batches(keyed_text(docs))
    table = piece_table(texts, path)
    known = docs.sparkSession.sparkContext.broadcast(most_frequent(table, frequent))

    def count(batches):
        _, prefixed = processor_of(path or model_path())
        pieces = known.value
        for b in batches:
            size, here, rare = [], [], []
            for text in b.column("text").to_pylist():
                total, left = 0, []
                for token, n in frequencies(text, prefixed).items():
                    k = pieces.get(token)
                    if k is None:
                        left.append((token, n))
                    else:
                        total += n * k
                size.append(len(text.encode()) if text else 0)
                here.append(total)
                rare.append(left)
            ends = pa.array([0, *(int(x) for x in accumulate(map(len, rare)))], pa.int32())
            flat = [x for left in rare for x in left]
            tokens, ns = (pa.array([x[k] for x in flat], t) for k, t in ((0, pa.string()), (1, pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(here, pa.int64()), pa.ListArray.from_arrays(ends, tokens), pa.ListArray.from_arrays(ends, ns)],
                names=["doc_id", "n_bytes", "here", "tokens", "ns"])

    counted = written(texts.mapInArrow(count, "doc_id long, n_bytes long, here long, tokens array<string>, ns array<long>").select(F.monotonically_increasing_id().alias("row"), "*"))
    rare = counted.filter(F.size("tokens") > 0).select("row", F.explode(F.arrays_zip("tokens", "ns")).alias("x")).select("row", F.col("x.tokens").alias("token"), F.col("x.ns").alias("n"))
    sums = cut_lineage(rare.join(table.select("token", "pieces"), "token").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("there")))
    release(table)
    total = (F.col("here") + F.coalesce("there", F.lit(0))).alias("n_tokens")
    return counted.select("row", "doc_id", "n_bytes", "here").join(sums, "row", "left").select("doc_id", "n_bytes", total).withColumn("over_limit", F.col("n_tokens") > limit)
