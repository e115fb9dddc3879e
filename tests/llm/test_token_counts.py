import pytest
import sentencepiece

from ledgerloom.llm import token_counts
from ledgerloom.llm.token_counts import count_tokens, model_path

TEXTS = [
    None, "", " ", "  ", "\n", " \n ", "a", "a b", "  two  spaces ", "tab\there", "line\n\nline \n x", "naïve Æther ñandú",
    "▁mark▁in text", "<s> </s> <unk> <0x0A>", "日本語のテキスト 🙂 zwj👩‍👩‍👧", "\x00\x01", "x" * 500, "word " * 3000,
    "THTHES!! REWH!! ST!!", "123 4567.89", "\r\n\r\n", " nbsp em",
]


@pytest.mark.parametrize("frequent, held, slice_chars", [(0, 3, 1 << 22), (6, 10**6, 1 << 22), (1 << 18, 10**6, 10)])
def test_counts_equal_the_library(spark, monkeypatch, frequent, held, slice_chars):
    """All pre-tokens joined by a shuffle, a few of them sent, and all of them sent."""
    monkeypatch.setattr(token_counts, "HELD", held)
    monkeypatch.setattr(token_counts, "SLICE_CHARS", slice_chars)
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, frequent=frequent).collect()}
    assert got == {i: len(library.encode(t)) if t else 0 for i, t in enumerate(TEXTS)}


def test_every_pretoken_is_counted_once(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(4)
    rows = token_counts.piece_table(docs, None).collect()
    assert len({r.token for r in rows}) == len(rows)
    assert {r.token: r.n for r in rows} == dict(sum((token_counts.frequencies(t, True) for t in TEXTS), token_counts.Counter()))


def test_operator_rows(spark):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(1, "", 7), (None, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in count_tokens(docs, limit=100).collect()}
    assert count_tokens(docs).count() == len(rows)
    assert got[0].n_bytes == 0 and got[0].n_tokens == 0 and not got[0].over_limit
    assert got[17].over_limit and got[17].n_bytes == 15000
    assert got[None].n_tokens == 2
    assert count_tokens(docs.limit(0)).collect() == []
