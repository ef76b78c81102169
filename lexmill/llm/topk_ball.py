"""Exact top-k search by inner product: ball-tree branch and bound per shard.

A bounded sample of rows gives the centres of a coarse partition of space. Every row goes to its nearest centre's cell, a
cell's shards are parts of it of bounded size, and a cell's radius is counted over all its rows. The sample also gives
every query a first k-th score.

Shards are visited in two waves. First each query meets one shard of the cell with the highest upper bound q.c + |q| r.
The k-th score found there is shared with all other shards: before anything is shuffled, those whose bound is below it are
left out, and what is sent carries the score along. Queries that start in neighbouring cells form a block, so a shard's
rows go only to the blocks that still need them.

In a shard a ball tree is built. Each query keeps a frontier of nodes in the order of their upper bounds; a round takes
the ``width`` best of each, cuts those below the current k-th score, opens inner nodes and scores leaves, which raises the
k-th score for the next round.

Cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an id;
repeated rows count once; vectors of different lengths are never compared; a query with fewer than k others returns all;
ties go to the smaller id; empty tables give no rows. Extra columns are ignored. Equal vectors are kept as their k + 1
smallest ids in a shard, which is exact because only those can be among the answers. Components are integers of 64 bits;
inner products beyond a long are not supported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm._common import materialise


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<long>) of the rows that take part: floor(scale * x), x as double."""
    good = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0))
        .where(F.coalesce(good, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))
        .dropDuplicates()
    )


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


@dataclass
class BallTree:
    """Nodes in arrays; the points of a node are ``order[start:end]``."""

    points: np.ndarray
    ids: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    right: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @staticmethod
    def build(points: np.ndarray, ids: np.ndarray, leaf: int = 64) -> BallTree:
        x = points.astype(float)
        order = np.arange(len(x))
        center, radius, left, right, start, end = [], [], [], [], [], []
        stack = [(0, len(x), -1)]
        while stack:
            lo, hi, parent = stack.pop()
            me = len(center)
            if parent >= 0:
                (right if left[parent] >= 0 else left)[parent] = me
            own = order[lo:hi]
            c = x[own].mean(axis=0)
            d = np.sqrt(((x[own] - c) ** 2).sum(axis=1))
            center.append(c)
            radius.append(float(d.max()))
            for a, v in ((left, -1), (right, -1), (start, lo), (end, hi)):
                a.append(v)
            if hi - lo > leaf:
                far = x[own[d.argmax()]]
                across = x[own[((x[own] - far) ** 2).sum(axis=1).argmax()]]
                side = x[own] @ (across - far)
                mid = (hi - lo) // 2
                order[lo:hi] = own[np.argpartition(side, mid)]
                stack += [(lo + mid, hi, me), (lo, lo + mid, me)]
        return BallTree(points[order], ids[order], np.array(center), np.array(radius), *(np.array(a, np.int64) for a in (left, right, start, end)))

    def search(self, q: np.ndarray, q_ids: np.ndarray, kth: np.ndarray, k: int, block: int = 512, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids (queries x k, -1 where none): the shard's k best of each query that reach ``kth``."""
        out = [self._block(q[i : i + block], q_ids[i : i + block], kth[i : i + block].copy(), k, width) for i in range(0, len(q), block)]
        return np.concatenate([s for s, _ in out]), np.concatenate([i for _, i in out])

    def _block(self, q, q_ids, kth, k, width):
        low = np.iinfo(np.int64).min
        best, best_id = np.full((len(q), k), low), np.full((len(q), k), -1, np.int64)
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(self.points).max(initial=0)) * q.shape[1] < 2**52
        qf, pts = q.astype(float), self.points.astype(float) if exact else self.points
        norm = np.sqrt((qf**2).sum(axis=1))
        slack = 1e-9 * (1 + norm * (np.abs(self.center).max() + self.radius[0]) * q.shape[1])
        bound_of = lambda w, n: (qf[w] * self.center[n]).sum(axis=1) + norm[w] * self.radius[n] + slack[w]
        who, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        bound = bound_of(who, node)
        while len(who):
            live = bound >= kth[who]
            who, node, bound = who[live], node[live], bound[live]
            order = np.lexsort((-bound, who))
            who, node, bound = who[order], node[order], bound[order]
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, np.int64)
            now = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who)))) < width
            leaf = self.left[node] < 0
            self._score_leaves(who[now & leaf], node[now & leaf], q, qf, q_ids, pts, exact, best, best_id, kth, k)
            w, n = who[now & ~leaf], node[now & ~leaf]
            child, w = np.concatenate([self.left[n], self.right[n]]), np.concatenate([w, w])
            who, node, bound = np.concatenate([who[~now], w]), np.concatenate([node[~now], child]), np.concatenate([bound[~now], bound_of(w, child)])
        return best, np.where(best == low, -1, best_id)

    def _score_leaves(self, who, node, q, qf, q_ids, pts, exact, best, best_id, kth, k) -> None:
        """Scores of the queries ``who`` with the points of the leaves ``node``; best, best_id and kth rise in place."""
        low = np.iinfo(np.int64).min
        order = np.argsort(node, kind="stable")
        who, node = who[order], node[order]
        edges = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]])) if len(node) else np.zeros(1, np.int64)
        for a, b in zip(edges[:-1], edges[1:]):
            qs, n = who[a:b], node[a]
            ids = self.ids[self.start[n] : self.end[n]]
            own = pts[self.start[n] : self.end[n]]
            s = (qf[qs] @ own.T).round().astype(np.int64) if exact else q[qs] @ own.T
            s = np.where(ids[None, :] == q_ids[qs, None], low, s)
            some = (s >= np.maximum(kth[qs], low + 1)[:, None]).any(axis=1)
            if some.any():
                qs, s = qs[some], s[some]
                all_s = np.concatenate([best[qs], s], 1)
                all_i = np.concatenate([best_id[qs], np.broadcast_to(ids, s.shape)], 1)
                top = np.lexsort((all_i, -all_s.astype(float) if exact else np.negative(np.maximum(all_s, low + 1))), axis=-1)[:, :k]
                best[qs], best_id[qs] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)
                kth[qs] = np.maximum(kth[qs], best[qs, k - 1])


@dataclass
class Cells:
    """The coarse partition of one length of vectors: centres, and once they are known radii and the shards of each."""

    center: np.ndarray
    ids: np.ndarray
    points: np.ndarray
    radius: np.ndarray | None = None
    shard: np.ndarray | None = None
    parts: np.ndarray | None = None

    @staticmethod
    def of(ids: np.ndarray, points: np.ndarray, cells: int, rounds: int = 8) -> Cells:
        """Centres from a sample: every so manieth row of it, moved to the means of what lies nearest."""
        x = points.astype(float)
        c = x[np.unique(np.linspace(0, len(x) - 1, min(cells, len(x))).astype(np.int64))]
        for _ in range(rounds):
            own = nearest(x, c)[0]
            n = np.bincount(own, minlength=len(c))
            mean = np.stack([np.bincount(own, x[:, j], len(c)) for j in range(x.shape[1])], 1) / np.maximum(n, 1)[:, None]
            c = np.where(n[:, None] > 0, mean, c)
        return Cells(c, ids, points)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products with the rows of every cell; an empty cell has none."""
        norm = np.sqrt((q**2).sum(axis=1))[:, None]
        slack = 1e-9 * (1 + norm * (np.abs(self.center).max() + self.radius.max()) * q.shape[1])
        return np.where(self.parts > 0, q @ self.center.T + norm * self.radius + slack, -np.inf)


def nearest(x: np.ndarray, c: np.ndarray, at_once: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every row and the distance to it."""
    own = [((c**2).sum(axis=1) - 2 * x[i : i + at_once] @ c.T).argmin(axis=1) for i in range(0, len(x), at_once)]
    at = np.concatenate(own) if own else np.zeros(0, np.int64)
    return at, np.sqrt(((x - c[at]) ** 2).sum(axis=1))


ASKED = "id long, v array<bigint>, dim int, kth long, start int, shard int, block int"


def search(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, scale: int = 256, shard_rows: int = 8192, block_rows: int = 16384, seeds: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score for every query (ids divisible by ``every``) against all rows. ``seeds`` bounds the
    sample, and with it the number of cells; larger cells have more shards."""
    spark = vectors.sparkSession
    raw = materialise(quantised(vectors, id_col, vector_col, scale).withColumn("dim", F.size("v")), "topk-vectors")
    n = raw.count()
    drawn = raw.orderBy(F.xxhash64("id"), "id").limit(seeds).collect()
    of = lambda d: [r for r in drawn if r["dim"] == d]
    dims = [r["dim"] for r in raw.select("dim").distinct().collect()]
    cells = {d: Cells.of(np.array([r["id"] for r in of(d)], np.int64), np.array([r["v"] for r in of(d)], np.int64).reshape(-1, d), max(1, -(-n // shard_rows))) for d in dims if of(d)}
    for d in dims:  # a length that the sample missed is one cell round the origin
        cells.setdefault(d, Cells(np.zeros((1, d)), np.zeros(0, np.int64), np.zeros((0, d), np.int64)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim = b.column("dim").to_numpy()
            cell, away = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                cell[at], away[at] = nearest(rows_of(b.column("v").take(pa.array(at)), int(d)).astype(float), cells[int(d)].center)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(away)], [*b.schema.names, "cell", "away"])

    placed = materialise(raw.mapInArrow(assign, "id long, v array<bigint>, dim int, cell int, away double"), "topk-cells")
    sizes = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()
    shards = 0
    for d in dims:
        c = cells[d]
        c.radius, c.shard, c.parts = np.zeros(len(c.center)), np.zeros(len(c.center), np.int64), np.zeros(len(c.center), np.int64)
        for row in sorted((r for r in sizes if r["dim"] == d), key=lambda r: r["cell"]):
            c.radius[row["cell"]], c.shard[row["cell"]], c.parts[row["cell"]] = row["r"], shards, -(-row["n"] // shard_rows)
            shards += int(c.parts[row["cell"]])
    low = np.iinfo(np.int64).min
    shipped = spark.sparkContext.broadcast(cells)  # ``seeds`` centres and rows at most

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th score of the sample, and the shard where the query starts."""
        for b in batches:
            dim, ids = b.column("dim").to_numpy(), b.column("id").to_numpy()
            kth, start = np.full(b.num_rows, low), np.zeros(b.num_rows, np.int32)
            for d in np.unique(dim):
                c, at = shipped.value[int(d)], np.flatnonzero(dim == d)
                v = rows_of(b.column("v").take(pa.array(at)), int(d))
                if len(c.ids) > k:
                    s = v @ c.points.T
                    s[ids[at, None] == c.ids[None, :]] = low
                    kth[at] = np.partition(s, -k, axis=1)[:, -k]
                best = c.bounds(v.astype(float)).argmax(axis=1)
                start[at] = c.shard[best] + ids[at] // every % c.parts[best]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), b.column("dim"), pa.array(kth), pa.array(start)], ["id", "v", "dim", "kth", "start"])

    is_query = F.pmod("id", F.lit(every)) == 0
    asking = materialise(placed.where(is_query).select("id", "v", "dim").mapInArrow(first, "id long, v array<bigint>, dim int, kth long, start int"), "topk-queries")
    started = {r["start"]: r["n"] for r in asking.groupBy("start").agg(F.count("*").alias("n")).collect()}  # a row a shard at most
    block_of = np.cumsum([started.get(i, 0) for i in range(max(shards, 1))]) // block_rows

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every other shard whose bound reaches the k-th score."""
        for b in batches:
            dim, kth, start = (b.column(x).to_numpy() for x in ("dim", "kth", "start"))
            for d in np.unique(dim):
                c, at = shipped.value[int(d)], np.flatnonzero(dim == d)
                for lo in range(0, len(at), 1024):
                    own = at[lo : lo + 1024]
                    bound = c.bounds(rows_of(b.column("v").take(pa.array(own)), int(d)).astype(float))
                    q, cell = np.nonzero(bound >= kth[own, None])
                    times = c.parts[cell]
                    shard = np.repeat(c.shard[cell] - np.cumsum(times) + times, times) + np.arange(times.sum())
                    q = own[np.repeat(q, times)]
                    q, shard = q[shard != start[q]], shard[shard != start[q]]
                    part = b.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays([*(part.column(x) for x in ("id", "v", "dim", "kth", "start")), pa.array(shard.astype(np.int32)), pa.array(block_of[start[q]].astype(np.int32))], [x.split()[0] for x in ASKED.split(", ")])

    def answer(key, left: pa.Table, right: pa.Table) -> pa.Table:
        got: list[np.ndarray] = []
        for d in np.unique(right.column("dim").to_numpy()):  # a shard has vectors of one length
            ids, v = left.column("id").to_numpy(), rows_of(left.column("v").combine_chunks(), int(d))
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            _, inv = np.unique(v, axis=0, return_inverse=True)
            inv = inv.ravel()
            by = np.argsort(inv, kind="stable")
            head = np.flatnonzero(np.concatenate([[True], inv[by][1:] != inv[by][:-1]]))
            turn = np.arange(len(by)) - np.repeat(head, np.diff(np.append(head, len(by))))
            keep = np.sort(by[turn <= k])
            tree = BallTree.build(v[keep], ids[keep])
            q_ids = right.column("id").to_numpy()
            s, i = tree.search(rows_of(right.column("v").combine_chunks(), int(d)), q_ids, right.column("kth").to_numpy().copy(), k)
            r, c = np.nonzero(s > low)
            got.append(np.stack([q_ids[r], i[r, c], s[r, c]]))
        q, i, s = np.concatenate(got, axis=1) if got else np.zeros((3, 0), np.int64)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.int64())})

    parts_of = spark.createDataFrame([(d, i, int(c.shard[i]), int(c.parts[i])) for d, c in cells.items() for i in range(len(c.center))], "dim int, cell int, base int, parts int")
    rows = placed.join(F.broadcast(parts_of), ["dim", "cell"]).select("id", "v", "dim", (F.col("base") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("shard"))

    def met(asked: DataFrame) -> DataFrame:
        """The answers of the asked shards: a shard's rows go to the blocks that ask it, and no others."""
        wanted = asked.select(F.col("shard").alias("_shard"), F.col("block").alias("_block")).distinct()
        own = rows.join(wanted, F.col("shard") == F.col("_shard")).select("id", "v", "dim", F.col("_shard").alias("shard"), F.col("_block").alias("block"))
        return own.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(answer, "query_id long, vec_id long, score long")

    near = materialise(met(asking.withColumn("shard", F.col("start")).withColumn("block", F.lit(0))), "topk-near")
    best = near.groupBy(F.col("query_id").alias("id")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k).select("id", F.element_at("s", k).alias("reached"))  # k scores a query
    raised = asking.join(best, "id", "left").select("id", "v", "dim", F.greatest("kth", F.coalesce("reached", F.lit(low))).alias("kth"), "start")
    found = near.unionByName(met(materialise(raised.mapInArrow(others, ASKED), "topk-asked")))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
