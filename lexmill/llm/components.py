"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import few, materialise


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            a, c = find(u), find(v)
            if a != c:
                up[max(a, c)] = min(a, c)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "label"])


def components(edges: DataFrame, *, in_one_task: int = 300_000, rows: int | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v: long); the label is the component's smallest node.

    Up to ``in_one_task`` edges (16 bytes each) are joined by one task; above that every step is a distributed
    aggregation, written to the shared folder, until a step changes nothing. ``rows``: a bound of the number of edges, if
    one is known; tables are then written in as few files as they need."""
    edges = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialise(edges if rows is None else few(edges, rows), "edges")
    total = edges.count()
    if total <= in_one_task:
        return edges.coalesce(1).mapInArrow(_union_find, "node long, label long")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        large = materialise(few(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 2 * total), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v"))
        edges = materialise(few(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 2 * total), "edges")
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
