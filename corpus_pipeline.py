"""Documents to packed training sequences: quality, language, near duplicates, benchmark passages, packing.

Every stage takes all documents the one before kept; stages that filter return the columns of ``documents`` unchanged.
A stage that only judges a text by itself filters rows where they lie, whatever their ids; near_duplicates drops by id.

Cases, the same in every stage unless it says otherwise: a null text counts as empty; a row with a null id is judged as any
other; very long texts are read whole; repeated rows are each judged; extra columns, whatever their names, are carried
along unchanged; an empty table gives an empty one with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontamination, langid, ngram_join, packing, quality_gbdt
from lexmill.llm._common import keep_rows, materialise, table, without


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring under 0.7 go; an empty text has a score too. Without labels of both kinds all scores are the smoothed
    prior, so all documents go."""
    model = quality_gbdt.fit(docs, table(spark, sf_dir, "labels"))
    return keep_rows(docs, lambda texts: (model.score(quality_gbdt.matrix(texts)) >= 0.7).tolist())


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, empty ones among them, and those in which no language holds two fifths."""
    model = langid.fit(docs)
    return keep_rows(docs, lambda texts: [name != "und" and share >= 0.4 for name, share in map(model.predict, texts)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents stays, once; rows without an id stay. Of several
    rows with one id one stays, whatever their texts. Empty texts are linked with nothing."""
    groups = materialise(ngram_join.join(docs), "pipeline-groups")
    kept = without(docs, groups.where("doc_id <> component_id"))
    ids = groups.where(F.col("doc_id").isNotNull()).agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] > ids["d"]:  # repeated rows: one of each id
        named = kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.where(F.col("doc_id").isNull()))
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; an empty benchmark keeps all."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, with their ids; an empty text is one piece of its end token."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pack", pack)]

#: SQL expresses neither the classifiers nor the tokenizer; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
