import random

import pytest

from ledgerloom.llm.token_counts import model_path

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    dice = random.Random(3)
    made = []
    for i in range(160):
        words = ["".join(dice.choice(["ka", "lo", "mi", "tru", "ne"]) for _ in range(dice.randint(1, 4))) for _ in range(dice.randint(60, 160))]
        made.append(words)
    rows = []
    for i, words in enumerate(made):
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 0))
    rows += [(1000 + i, " ".join(made[i]), "en", "s1", 0) for i in range(10)]  # copies
    rows += [(1100 + i, " ".join([*made[i][:-1], "changed"]), "en", "s1", 0) for i in range(10)]  # near copies
    rows += [(1200 + i, " ".join([*made[20 + i][:30], "grubhead", *made[40 + i][30:]]), "en", "s0", 0) for i in range(60)]  # toxic
    rows += [(1300 + i, "short text", "en", "s0", 0) for i in range(5)] + [(1400, None, None, None, None), (None, " ".join(made[3]) + " z", "en", "s2", 0)]
    labels = [(i, 1, int(1200 <= i < 1300)) for i in [*range(0, 160), *range(1200, 1260)]]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_each_stage_has_its_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[k] = [r.doc_id for r in docs.collect()]
    ids = lambda k: {i for i in kept[k] if i is not None}
    assert None in kept[0] and {i for i in ids(0) if 1300 <= i <= 1400} == set() and set(range(160)) <= ids(0)
    assert not any(1200 <= i < 1300 for i in ids(1)) and set(range(160)) <= ids(1)
    assert not any(i >= 1000 for i in ids(2)) and len(kept[2]) == len(set(kept[2]))
    assert ids(2) >= {i for i in range(160) if i != 3}
    assert ids(3) <= ids(2) and max(kept[3].count(i) for i in ids(3)) <= 3
    assert sorted(map(str, kept[4])) == sorted(map(str, kept[3]))


def test_run_gives_the_library_ids(spark, folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = pipeline.run(spark, folder).collect()
    assert rows and all(list(r.ids) == library.encode(texts[r.doc_id]) and r.round_trip for r in rows)


def test_rows_that_share_a_doc_id_have_their_own_verdicts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 160 or doc_id between 1200 and 1259")
    nulls = docs.filter("doc_id in (1, 2, 1200, 1201)").selectExpr("cast(null as long) doc_id", "concat(text, ' z') text", "lang", "source", "n_chars")
    short = spark.createDataFrame([(None, "short text", "en", "s0", 0), (7, "short text", "en", "s0", 0)], docs.schema)
    every = docs.unionByName(nulls).unionByName(short)
    kept = [r.text for r in pipeline.quality(spark, every, folder).collect()]
    assert "short text" not in kept and len(kept) == docs.count() + 4
    kept = [r.text for r in pipeline.nontoxic(spark, every, folder).filter("doc_id is null").collect()]
    assert len(kept) == 3 and not any("grubhead" in t for t in kept)
    other = docs.filter("doc_id < 4").selectExpr("doc_id", "reverse(text) text", "lang", "source", "n_chars")
    few = docs.filter("doc_id < 4").unionByName(other)
    assert pipeline.distinct(spark, few, folder).count() == 8


def test_empty_tables_clashing_columns_and_nulls(spark, folder):
    """Columns named as the operators' own, null rows, and no rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clash = ["row", "doc", "carry", "kept", "x0", "_copies", "copies", "class_id", "predicted", "score", "taken", "size", "label", "key", "node", "component", "own", "col"]
    more = docs.selectExpr("*", *[f"cast(doc_id as string) {c}" for c in clash])
    nulls = spark.createDataFrame([tuple([None] * len(more.columns))] * 2 + [(None, "", None, None, *[None] * (len(more.columns) - 4))], more.schema)
    for k, (name, stage) in enumerate(pipeline.STAGES):
        assert stage(spark, more.limit(0), folder).collect() == [], name
        out = stage(spark, more.filter("doc_id < 60").unionByName(nulls), folder)
        rows = out.collect()
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == more.columns, name
            assert all(r.key == r.row == str(r.doc_id) for r in rows if r.doc_id is not None), name
        assert sum(r.doc_id is None for r in rows) == (0, 3, 3, 0, 3)[k], name
        assert {r.doc_id for r in rows if r.doc_id is not None} <= set(range(60)) and len(rows) > 20, name
