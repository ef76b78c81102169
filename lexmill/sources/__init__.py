"""Readers and writers: lines, pairs, lists of files, phrase tables, JSON documents, small dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, line_no (long, from 1 within a file), value. Compressed text is read as it is.

    A large file is read as several splits. A split's lines are counted first (one row a split); the counts before it are
    its offset, and lines are numbered where they were read, so no file meets in one task."""
    split = ["file", "_block"]
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), "value", F.monotonically_increasing_id().alias("_at"))
    from pyspark.sql.window import Window

    counts = raw.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = counts.select(*split, "_first", (F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")).alias("_before"))
    return raw.join(F.broadcast(before), split).select("file", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("line_no"), "value")


def whole_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file, value: whole files."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def listed_files(spark: SparkSession, path: str) -> list[str]:
    """The existing files named in a list, one a line; missing ones are left out."""
    return existing(spark, [r["value"].strip() for r in spark.read.text(path).collect() if r["value"].strip()])


def existing(spark: SparkSession, names: Sequence[str]) -> list[str]:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [n for n in names if jpath(n).getFileSystem(hadoop).exists(jpath(n))]


def column_lines(table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no (from 0), value: the lines of a text column."""
    return table.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "value"))


def phrase_table(spark: SparkSession, path: str) -> DataFrame:
    """src, tgt, lexw, prob, freq of tab-separated rows."""
    f = F.split("value", "\t")
    numbers = lambda c: F.transform(F.split(F.trim(c), " "), lambda x: x.cast("double"))
    return spark.read.text(path).where(F.size(f) == 5).select(F.get(f, 0).alias("src"), F.get(f, 1).alias("tgt"), numbers(F.get(f, 2)).alias("lexw"), numbers(F.get(f, 3)).alias("prob"), F.get(f, 4).cast("long").alias("freq"))


def replacement_rules(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t", -1)
    return spark.read.text(path).where(F.size(f) >= 5).select(*(F.get(f, i).alias(n) for i, n in enumerate(("rule_id", "pre_from", "pre_to", "post_from", "post_to"))))


def character_pairs(spark: SparkSession, path: str) -> dict[str, str]:
    """One-to-one character pairs, two tab-separated characters a line; the last line of a character counts. There are no
    more rows than characters."""
    f = F.split("value", "\t")
    rows = text_lines(spark, path).where((F.size(f) == 2) & (F.length(F.get(f, 0)) == 1) & (F.length(F.get(f, 1)) == 1))
    return {r["a"]: r["b"] for r in rows.groupBy(F.get(f, 0).alias("a")).agg(F.max_by(F.get(f, 1), "line_no").alias("b")).orderBy("a").collect()}


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """file, value: one JSON document a file."""
    return whole_texts(spark, path)


def write_lines(lines: DataFrame, path: str, value: str = "value", again: bool = True) -> None:
    """Writes text; with ``again`` false an existing result stays as it is."""
    lines.select(value).write.mode("overwrite" if again else "ignore").text(path)


def index_sink(write_batch):
    """A ``foreachBatch`` function that hands each partition's rows to ``write_batch(rows)`` in bulks of 5000."""

    def sink(batch: DataFrame, _epoch: int) -> None:
        def send(rows):
            bulk = []
            for r in rows:
                bulk.append(r.asDict(True))
                if len(bulk) == 5000:
                    write_batch(bulk)
                    bulk = []
            if bulk:
                write_batch(bulk)

        batch.foreachPartition(send)

    return sink


def translated(lines: DataFrame, client, value: str = "value", tries: int = 3) -> DataFrame:
    """Adds translation: ``client(list of texts) -> list of texts`` runs per Arrow batch, up to ``tries`` times; a batch
    that keeps failing is marked. Blank lines stay blank. No client ships with the library."""
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    def run(batches):
        for b in batches:
            texts = b.column(value).to_pylist()
            asked = [t for t in texts if t and t.strip()]
            got, error = None, ""
            for _ in range(tries if asked else 0):
                try:
                    got = client(asked)
                    break
                except Exception as e:  # the client's own failures
                    error = str(e)
            answers = iter(got if got is not None else [f"[ERROR: {error}]"] * len(asked))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([next(answers) if t and t.strip() else "" for t in texts], pa.string())], [*b.schema.names, "translation"])

    return lines.mapInArrow(run, StructType([*lines.schema.fields, StructField("translation", StringType())]))
