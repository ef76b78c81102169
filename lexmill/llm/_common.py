"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters to lower case on UTF-8 bytes; every other byte is kept.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_own: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one only where the session names none and one machine is all
    there is (tests, local mode)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    return _own[app]


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back: it cuts the lineage and survives
    the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexmill/{label}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def few(df: DataFrame, rows: int, a_task: int = 50_000) -> DataFrame:
    """``df``, of at most about ``rows`` short rows, in a task and file for each ``a_task`` of them, or one a core, however
    many shuffle partitions the session has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // a_task)))


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` has written, once no plan reads them any more; others are left alone."""
    for t in tables:
        if path := _paths.pop(t, None):
            jvm = t.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str, parts: int, held: int) -> Column:
    """True where crc32 of the id as text leaves ``held`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % parts == held, F.lit(False))


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, rows: int = 400):
    """A record batch in parts, so that only some of its texts are Python strings at a time."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def blobs(column: pa.Array) -> list[memoryview]:
    """The values of a binary column without copies; null as empty."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(at, at[1:])]


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words, cut at U+0020 and U+0009 to U+000D only: what ``bytes.split`` cuts at."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, held: Column, max_rows: int) -> DataFrame:
    """Texts of at most ``max_rows`` labelled documents outside the held-out fold: (doc_id, text, y).

    Ids are drawn by a hash of the id, so the choice doesn't depend on partitioning. Repeated ids with differing labels
    take the larger label; null labels and ids are left out. Only the drawn ids (``max_rows`` at most) are broadcast.
    """
    ids = (
        labels.select("doc_id", F.col(target).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held)
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def without(docs: DataFrame, ids: DataFrame, small: int = 500_000) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``ids``; rows with a null id stay. Up to ``small`` ids (8 bytes each, the
    size is counted) are broadcast so that texts stay where they are; more are joined by a shuffle."""
    ids = materialise(ids.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= small else ids, "doc_id", "left_anti").select(docs.columns)


def keep_rows(docs: DataFrame, test) -> DataFrame:
    """Rows for whose texts ``test(list of texts)`` is true, all columns as they are, judged where they lie."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(test(texts(b.column("text"))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
