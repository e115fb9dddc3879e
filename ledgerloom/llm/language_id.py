"""Language ID with bit-sliced Bloom filters of character n-grams.

Every slot of a table holds one bit per language, in as many words as they need, so one
look-up by HASHES hashes and an AND give all languages whose filter has an n-gram. A
document's n-grams are counted for each language, the counts are corrected for the filter's
rate of false positives, and the highest decides. Executors count the fit's n-grams and set
the bits; the driver gets the tables alone, whose size follows the number of languages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, keyed_text, release
from ledgerloom.llm.stream import code_points, groups, letters, mixed

SLOTS_POWER, HASHES = 18, 3
#: The fit's bounded sample: labelled rows for each language.
FIT_ROWS = 1500
WORD = 64
LEAST_COUNT, LEAST_SHARE = 3, 0.35
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def ngrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each three characters around a letter, and the letters' places; other characters are all one."""
    letter = letters()[codes]
    c = np.where(letter, codes, 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    before, after = c[np.maximum(at - 1, 0)], c[np.minimum(at + 1, len(c) - 1)]
    if len(at) and at[0] == 0:
        before[0] = 0
    return mixed(before | (c[at] << np.uint64(21)) | (after << np.uint64(42))), at


def slots(h: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOTS_POWER) - 1)
    return [((h >> np.uint64(SLOTS_POWER * i)) & mask).astype(np.int64) for i in range(HASHES)]


class LanguageFilter:
    """languages: names in the order of their bits; usual: the one for texts that no filter knows."""

    def __init__(self, languages: list[str], usual: str, tables: np.ndarray):
        self.languages, self.usual = languages, usual
        full = [np.mean((tables[:, :, bit // WORD] >> np.uint64(bit % WORD)) & np.uint64(1), axis=1) for bit in range(len(languages))]
        self.false = np.array([np.prod(x) for x in full])
        narrow = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if min(len(languages), WORD) <= np.iinfo(t).bits)
        self.tables = tables.astype(narrow)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; und and 0 where it has no letter."""
        names, scores = [], []
        for a, b in groups(texts):
            codes, starts = code_points([(t or "").lower() for t in texts[a:b]])
            # lower() may change a text's length, so the starts are of the lowered texts
            h, at = ngrams(codes)
            of = np.searchsorted(starts, at, side="right") - 1
            n = np.bincount(of, minlength=b - a)
            s = slots(h)
            mask = self.tables[0][s[0]]
            for i in range(1, HASHES):
                mask = mask & self.tables[i][s[i]]
            hits = np.stack([np.bincount(of, weights=(mask[:, bit // WORD] >> (bit % WORD)) & 1, minlength=b - a) for bit in range(len(self.languages))], 1) if self.languages else np.zeros((b - a, 0))
            real = np.maximum(0.0, (hits - n[:, None] * self.false) / (1 - self.false))
            for i in range(b - a):
                total = real[i].sum()
                if not n[i]:
                    names.append("und")
                    scores.append(0.0)
                elif total <= 0:
                    names.append(self.usual or "und")
                    scores.append(0.0)
                else:
                    best = int(np.argmax(real[i]))
                    names.append(self.languages[best])
                    scores.append(float(real[i][best] / total))
        return names, scores


def held_out(buckets: int, kept: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % buckets == kept


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> LanguageFilter:
    """docs: doc_id, text and lang. Learns from about rows distinct texts of each language, whole ones with the least hashes."""
    spark, parts = docs.sparkSession, 1_000_000
    known = docs.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = sorted((r[0], r[1], r[2]) for r in known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02), F.count("*")).collect())
    languages = [name for name, _, _ in counts]
    tables = np.zeros((HASHES, 1 << SLOTS_POWER, max(1, -(-len(languages) // WORD))), np.uint64)
    if not languages:
        return LanguageFilter([], "", tables)
    shares = spark.createDataFrame([(name, bit, min(parts, -(-parts * rows // max(n, 1)))) for bit, (name, n, _) in enumerate(counts)], "lang string, bit int, share long")
    chosen = known.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(parts)) < F.col("share")).groupBy("bit", "h").agg(F.any_value("text").alias("text"))

    def count(batches):
        for b in batches:
            texts, bits = b.column("text").to_pylist(), b.column("bit").to_numpy()
            for i, j in groups(texts):
                codes, starts = code_points([t.lower() for t in texts[i:j]])
                h, at = ngrams(codes)
                of = bits[i:j][np.searchsorted(starts, at, side="right") - 1]
                for bit in np.unique(of):
                    grams, n = np.unique(h[of == bit], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), bit, np.int32)), pa.array(grams.view(np.int64)), pa.array(n)], names=["bit", "h", "n"])

    seen = bound_batches(chosen).mapInArrow(count, "bit int, h long, n long").groupBy("bit", "h").agg(F.sum("n").alias("n"))
    seen = cut_lineage(seen)
    share = (F.col("n") / F.col("total")).alias("share")
    shared = seen.join(F.broadcast(seen.groupBy("bit").agg(F.sum("n").alias("total"))), "bit").select("bit", "h", "n", share)
    own = shared.withColumn("most", F.max("share").over(Window.partitionBy("h"))).filter((F.col("n") >= LEAST_COUNT) & (F.col("share") >= F.lit(LEAST_SHARE) * F.col("most")))
    slot = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.struct(i.alias("i"), F.call_function("shiftrightunsigned", "h", i * SLOTS_POWER).bitwiseAND((1 << SLOTS_POWER) - 1).alias("slot")))
    bits = (
        own.select("bit", F.explode(slot).alias("s"))
        .groupBy("s.i", "s.slot", F.expr(f"bit div {WORD}").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % WORD).cast("int"))).alias("mask")).toArrow()
    )
    tables[tuple(bits.column(c).to_numpy() for c in ("i", "slot", "word"))] = bits.column("mask").to_numpy().view(np.uint64)
    release(seen)
    return LanguageFilter(languages, min((-n, name) for name, _, n in counts)[1], tables)


def identify(docs: DataFrame, buckets: int = 4, kept: int = 2, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Learns from rows with a lang whose crc32(doc_id) mod buckets is not kept; of every
    language, about rows distinct texts, whole ones. A null text, an empty one and one
    without letters give und and score 0. A text whose n-grams no language has gets the
    language with most rows to learn from, score 0; of equal ones, and of languages with
    equal counts, the first by name. Without labelled rows all are und. A null doc_id
    counts as an empty string. Rows that repeat each give a row; other columns are not
    read; an empty table gives an empty result.
    """
    texts = keyed_text(docs, "lang").withColumn("lang", F.col("lang").cast("string")).withColumn("held_out", held_out(buckets, kept))
    model = docs.sparkSession.sparkContext.broadcast(fit(texts.filter(~F.col("held_out")), rows))

    def run(batches):
        for b in batches:
            names, scores = model.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return bound_batches(texts.select("doc_id", "text", "held_out")).mapInArrow(run, RESULT)
