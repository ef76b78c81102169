"""Words of one side of sentence pairs against those of the other, by blocks of target words.

A block holds every pair that has one of its target words: the source words once, and of the target words its own. What
belongs to a target word meets in one task as integers, where a row for each two words of a pair would be shuffled. A pair
goes to as many blocks as it has target words at most; a task works through its words in steps of ``AT_ONCE`` products.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of a block at most (by the mean), and products of two words that are looked at together.
PAIRS, AT_ONCE = 20_000, 1_000_000
EMPTY = "<eps>"


def blocks(pairs: DataFrame) -> int:
    return max(pairs.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // PAIRS))


def _block(word: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(count)).cast("int")


def spread(pairs: DataFrame, count: int) -> DataFrame:
    """b, r (0), k, s, m, j, w, v: from k, s and t (arrays of words) a row for each block of t's words; j and w are the
    positions and words of t that are the block's own."""
    own = F.transform("t", lambda w, j: F.struct(_block(w, count).alias("b"), j.alias("j"), w.alias("w")))
    each = pairs.select("k", "s", F.size("t").alias("m"), own.alias("x")).where("m > 0 and size(s) > 0")
    each = each.select("k", "s", "m", "x", F.explode(F.array_distinct("x.b")).alias("b")).select("b", "k", "s", "m", F.filter("x", lambda e: e["b"] == F.col("b")).alias("x"))
    return each.select("b", F.lit(0).alias("r"), "k", "s", "m", F.col("x.j").alias("j"), F.col("x.w").alias("w"), F.lit(None).cast("array<double>").alias("v"))


def beside(rows: DataFrame, more: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``more`` (b, r, s, and w or v), each block in a partition of its own."""
    for name in rows.columns:
        if name not in more.columns:
            more = more.withColumn(name, F.lit(None).cast(rows.schema[name].dataType))
    return rows.unionByName(more).repartitionById(count, "b")


def totals_rows(totals: DataFrame, no: int, count: int) -> DataFrame:
    """lw, v in a few hundred rows of many words, for every block."""
    chunk = totals.groupBy(F.pmod(F.xxhash64("lw"), F.lit(256)).alias("_c")).agg(F.collect_list(F.struct("lw", "v")).alias("_l"))
    return chunk.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("b"), F.lit(no).alias("r"), F.col("_l.lw").alias("s"), F.col("_l.v").alias("v"))


class Block:
    """The rows of one block as arrays."""

    def __init__(self, batches: Iterable[pa.RecordBatch]):
        self.words: dict[str, int] = {EMPTY: 0}
        src, n, m, who, at, word, keys = [], [], [], [], [], [], []
        self.more: dict[int, list[tuple]] = {}
        seen = 0
        for b in batches:
            for no in pc.unique(b.column("r")).to_pylist():
                own = b.filter(pc.equal(b.column("r"), no))
                s, sizes = self._codes(own.column("s")), pc.list_value_length(own.column("s")).to_numpy(zero_copy_only=False)
                if no:
                    w = self._codes(own.column("w")) if own.column("w").null_count == 0 else None
                    self.more.setdefault(no, []).append((s, sizes, w, own.column("v").flatten().to_numpy(zero_copy_only=False)))
                    continue
                src.append(s)
                n.append(sizes)
                m.append(own.column("m").to_numpy(zero_copy_only=False))
                keys.append(own.column("k"))
                who.append(np.repeat(np.arange(seen, seen + own.num_rows, dtype=np.int32), pc.list_value_length(own.column("j")).to_numpy(zero_copy_only=False)))
                at.append(own.column("j").flatten().to_numpy(zero_copy_only=False))
                word.append(self._codes(own.column("w")))
                seen += own.num_rows
        cat = lambda parts, t: np.concatenate(parts).astype(t, copy=False) if parts else np.zeros(0, t)
        self.src, self.n, self.m = cat(src, np.int32), cat(n, np.int64), cat(m, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.keys = pa.chunked_array(keys) if keys else None
        order = np.argsort(rw := cat(word, np.int32), kind="stable")
        self.who, self.at, self.rw = cat(who, np.int32)[order], cat(at, np.int32)[order], rw[order]
        self.names = pa.array(list(self.words), pa.string())

    def _codes(self, lists: pa.Array) -> np.ndarray:
        coded = lists.flatten().dictionary_encode()
        ids = np.array([self.words.setdefault(w, len(self.words)) for w in coded.dictionary.to_pylist()], np.int32)
        return ids[coded.indices.to_numpy(zero_copy_only=False)] if len(ids) else np.zeros(0, np.int32)

    def totals(self, no: int) -> np.ndarray:
        out = np.ones(len(self.words))
        for s, _, _, v in self.more.get(no, []):
            out[s] = v
        return out

    def groups(self) -> Iterator[list[slice]]:
        """Entries by whole target words, ``AT_ONCE`` products together; a word with more of them in several slices."""
        ends = np.append(np.flatnonzero(np.diff(self.rw)) + 1, len(self.rw)) if len(self.rw) else np.zeros(0, np.int64)
        size = np.concatenate([[0], np.cumsum(self.n[self.who] + 1)])
        lo = 0
        while lo < len(self.rw):
            hi = ends[max(np.searchsorted(size[ends], size[lo] + AT_ONCE, "right") - 1, np.searchsorted(ends, lo, "right"))]
            cuts, a = [], lo
            while a < hi:
                z = min(hi, max(a + 1, int(np.searchsorted(size, size[a] + AT_ONCE, "right")) - 1))
                cuts.append(slice(a, z))
                a = z
            yield cuts
            lo = hi

    def products(self, cut: slice, empty: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice's entries: where each entry starts, its number for each product, the source position (-1 is the empty
        word, if asked for) and the key of the two words."""
        who, more = self.who[cut], int(empty)
        n = self.n[who] + more
        start = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        entry = np.repeat(np.arange(len(n)), n)
        i = np.arange(n.sum()) - start[entry] - more
        lw = np.where(i < 0, 0, self.src[self.first[who][entry] + np.maximum(i, 0)])
        return start, entry, i, self.rw[cut][entry].astype(np.int64) * len(self.words) + lw


def word_pair_counts(pairs: DataFrame, needed: DataFrame) -> DataFrame:
    """x, y, c: in how many of ``pairs`` (k, s and t, sets of words) x and y occur, for those of ``needed`` (x, y) that do."""
    count = blocks(pairs)
    asked = needed.groupBy("y").agg(F.collect_set("x").alias("s")).select(_block(F.col("y"), count).alias("b"), F.lit(1).alias("r"), "s", F.array("y").alias("w"))

    def run(batches):
        block = Block(batches)
        want = [np.repeat(w.astype(np.int64), sizes) * len(block.words) + s for s, sizes, w, _ in block.more.get(1, [])]
        want = np.sort(np.concatenate(want)) if want else np.zeros(0, np.int64)
        keep = np.isin(block.rw, want // len(block.words))
        block.who, block.at, block.rw = block.who[keep], block.at[keep], block.rw[keep]
        found = np.zeros(len(want), np.int64)
        for cuts in block.groups():
            for cut in cuts:
                key = block.products(cut, False)[3]
                at = np.minimum(np.searchsorted(want, key), len(want) - 1)
                found += np.bincount(at[want[at] == key], minlength=len(want))
        hit = np.flatnonzero(found)
        for lo in range(0, len(hit), 100_000):
            h = hit[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([block.names.take(pa.array(want[h] % len(block.words))), block.names.take(pa.array(want[h] // len(block.words))), pa.array(found[h])], ["x", "y", "c"])

    return beside(spread(pairs, count), asked, count).mapInArrow(run, "x string, y string, c long")
