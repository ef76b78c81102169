"""The stages of the pipeline on a small folder with nulls, copies and planted passages, against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import langid, quality_gbdt
from lexmill.llm._common import materialise

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    vocab = {"en": ["the", "and", "with", "house", "which", "there", "garden"], "de": ["und", "der", "nicht", "haus", "schön", "garten", "auch"]}
    passage = " ".join(f"q{i}" for i in range(30))
    text = lambda k, n: " ".join(w + rng.choice(["", "", "s", "er"]) + rng.choice(["", "", "", ","]) for w in rng.choices(vocab[k], k=n))
    rows = [(i, text("en" if i % 2 else "de", 60) if i % 3 else "!!! 1 2 3 $$ ## " * 9, "en" if i % 2 else "de", "s", 1) for i in range(120)]
    rows += [(200, rows[1][1], "en", "s", 1), (201, rows[1][1] + " more", "en", "s", 1), (202, None, "en", "s", 1), (203, "", "en", "s", 1)]
    rows += [(204, f"{text('en', 20)} {passage} {text('en', 20)}", "en", "s", 1), (None, f"{text('en', 20)} {passage}", "en", "s", 1), (None, text("en", 50), "en", "s", 1)]
    rows += [(205, text("en", 50), "en", "s", 1), (205, f"{passage} {text('en', 30)}", "en", "s", 2)]
    d = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), passage


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_decontaminate_null_and_repeated_ids(spark, folder):
    d, passage = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = corpus_pipeline.decontaminate(spark, docs, d)
    assert kept.columns == docs.columns
    assert rows_of(kept) == Counter({k: n for k, n in rows_of(docs).items() if passage not in (k[1] or "")})


def test_judging_stages(spark, folder):
    d, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model, names = quality_gbdt.fit(docs, spark.read.parquet(f"{d}/labels.parquet")), langid.fit(docs)
    good = lambda t: model.score(quality_gbdt.matrix([t or ""]))[0] >= 0.7
    named = lambda t: (p := names.predict(t or ""))[0] != "und" and p[1] >= 0.4
    for stage, test in ((corpus_pipeline.quality, good), (corpus_pipeline.language, named)):
        want = Counter({k: n for k, n in rows_of(docs).items() if test(k[1])})
        assert rows_of(stage(spark, docs, d)) == want and 0 < sum(want.values()) < docs.count()


def test_near_duplicates(spark, folder):
    d, passage = folder
    docs = spark.read.parquet(f"{d}/documents.parquet").where("doc_id is null or doc_id % 3 > 0 or doc_id > 200").where("doc_id is null or doc_id < 205")
    got = rows_of(corpus_pipeline.near_duplicates(spark, docs, d))
    assert got == Counter({k: n for k, n in rows_of(docs).items() if k[0] not in (200, 201)})


def test_whole_run(spark, folder):
    d, passage = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, d), "test-stage")
    assert docs.count() > 0 and not any(passage in t for _, t in rows_of(docs))
    want = corpus_pipeline.pack(spark, docs, d)
    got = corpus_pipeline.run(spark, d)
    assert got.columns == want.columns and got.count() > 0
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in want.collect()} == {i for i, _ in rows_of(docs)}


def test_stages_on_empty_tables_and_clashing_columns(spark, folder, tmp_path):
    d, _ = folder
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "pack" or out.columns == empty.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = ["score", "label", "size", "node", "component_id", "n", "item_id", "a", "b", "y", "held_out", "dim"]
    wide = docs.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, wide, d)
        assert out.columns == wide.columns
        assert rows_of(out) == rows_of(stage(spark, docs, d)) or name == "near_duplicates"  # of one id with two texts either may stay
        assert all(r[c] == f"{c}{'' if r['doc_id'] is None else r['doc_id']}" for r in out.collect() for c in names)
