"""Benchmark decontamination by spaced-seed hashing.

Texts become words (letters, digits and underscores, lower-cased), words 64-bit hashes. Fixed masks over a window of
words ignore some positions, so a window still hits when those words were substituted. Hits of a document window and a
benchmark window fix a diagonal; along it the two texts are compared word by word. An item is found when some stretch of
the diagonal has at most one mismatch to four matches and at least ``least`` matching words, or four fifths of a shorter
item; the masks hit every such stretch. The figures are those of the best stretch (a match counts 1, a mismatch costs
``cost``) where it holds enough words itself, else those of the stretch with the most matches.

The benchmark side is taken in blocks of about ``block_words`` words, each sent to all tasks: what is broadcast is
bounded, and a larger benchmark takes more passes. Documents are never shuffled.

Cases: null or empty texts on either side match nothing; items of five to nine words are found with one word substituted
or missing at an end, shorter ones only as the whole run of their words, items of fewer than ``shortest`` words never; null ids are matched and carried; repeated documents
are reported once; repeated item ids count as one item with several texts; empty tables give no rows. Extra columns are
ignored; texts are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.llm._common import keep_rows, materialise, texts

#: The longest window.
SPAN = 10
#: Positions each mask looks at. Cut a stretch with at most a fifth of its words substituted into fives: either one of them
#: is whole, or two neighbours have one substitution each, at i and j. The other masks ignore all (i, j) without a whole five between.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 5, 6), (0, 3, 4, 5, 8, 9), (0, 1, 2, 7, 8, 9), (0, 1, 2, 5, 6, 9), (0, 1, 2, 3, 5, 6, 7, 8))
#: Masks of shorter items by their number of words: any one substitution is ignored by some mask.
SHORT = {
    5: ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4)), 6: ((0, 1, 2, 3, 4), (0, 3, 4, 5), (0, 1, 2, 5)), 7: ((0, 1, 2, 3, 4), (0, 1, 4, 5, 6), (0, 1, 2, 5, 6)),
    8: ((0, 1, 2, 3, 4), (0, 1, 2, 5, 6, 7)), 9: ((0, 1, 2, 3, 4), (0, 1, 2, 3, 5, 6, 7, 8)),
}
_WORD = re.compile(r"\w+")
_ODD = np.array([(2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1 for i in range(SPAN)], np.uint64)
_BITS = 22


class _Hashes(dict):
    """word -> 64-bit hash, emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str, known: dict) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One hash for each window that ends with the last of ``places``, of the words at ``places``."""
    n = len(h) - places[-1]
    out = np.full(max(n, 0), sum(1 << p for p in places), np.uint64)
    for p in places if n > 0 else ():
        out += h[p : p + n] * _ODD[p]
    return out ^ (out >> np.uint64(29))


class Index:
    """The seeds of one block of the benchmark."""

    def __init__(self, items: list[tuple], shortest: int):
        known = _Hashes()
        self.ids, self.words, seeds = [], [], []
        shapes = set()
        for item_id, text in items:
            h = word_hashes(text or "", known)
            if len(h) < shortest:
                continue
            me = len(self.ids)
            self.ids.append(item_id)
            self.words.append(h)
            for m in SHORT.get(len(h), (tuple(range(len(h))),)) if 0 < len(h) < SPAN else MASKS if len(h) else ():
                shapes.add(m)
                w = window_hashes(h, m)
                seeds.append((w, np.full(len(w), me), np.arange(len(w))))
        self.shapes = sorted(shapes)
        key, item, at = (np.concatenate([s[i] for s in seeds]) if seeds else np.zeros(0, np.int64) for i in range(3))
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.at = key[order].astype(np.uint64), item[order], at[order]
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(self.key >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows (document, item, diagonal), each once; h and doc are the words of all documents one after another."""
        found = []
        for places in self.shapes:
            w = window_hashes(h, places)
            if not len(w) or not len(self.key):
                continue
            at = np.flatnonzero(self.bitmap[(w >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = at[doc[at] == doc[at + places[-1]]]
            lo, hi = np.searchsorted(self.key, w[at], "left"), np.searchsorted(self.key, w[at], "right")
            n = hi - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            seed = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            at = np.repeat(at, n)
            found.append(np.stack([doc[at], self.item[seed], at - self.at[seed]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def best_stretch(same: np.ndarray, cost: int) -> tuple[int, int]:
    """Matches and length of the stretch with the largest (matches - cost * mismatches)."""
    c = np.concatenate([[0], np.cumsum(np.where(same, 1, -cost))])
    low = np.minimum.accumulate(c)
    end = int((c - low).argmax())
    start = int(np.flatnonzero(c[: end + 1] == low[end])[-1])
    return int(same[start:end].sum()), end - start


def widest_stretch(same: np.ndarray) -> tuple[int, int]:
    """Matches and length of the stretch with the most matches among those with at least four matches to a mismatch."""
    c = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])
    m = np.concatenate([[0], np.cumsum(same)])
    start = np.searchsorted(-np.minimum.accumulate(c), -c)  # for each end the first start from which the sum is not negative
    end = int((m - m[start]).argmax())
    return int(m[end] - m[start[end]]), int(end - start[end])


def found(ix: Index, rows: list[str], known: dict, least: int, cost: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) -> matches and length, for each row and item found in it."""
    words = [word_hashes(t, known) for t in rows]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    flat = np.concatenate(words)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for d, i, diagonal in ix.hits(flat, np.repeat(np.arange(len(words)), np.diff(first))).tolist():
        item = ix.words[i]
        at = diagonal - first[d]
        s, e = max(0, -at), min(len(item), len(words[d]) - at)
        same = item[s:e] == words[d][at + s : at + e]
        enough = min(least, -(-4 * len(item) // 5))
        if same.sum() < enough:
            continue
        got = best_stretch(same, cost)
        if got[0] < enough:
            got = widest_stretch(same)
        if got[0] >= enough:
            best[d, i] = max(best.get((d, i), (0, 0)), got)
    return best


def blocks_of(benchmark: DataFrame, shortest: int, block_words: int) -> Iterator[Broadcast]:
    """The broadcast index of each block of the benchmark. Items are dealt to blocks by a hash, about ``block_words`` words
    each: the number of blocks follows from a sum, and no task or driver holds more than one block."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text").distinct()
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0)).alias("n")).first()["n"]
    count = -(-words // block_words)
    dealt = materialise(items.select("item_id", "text", F.pmod(F.xxhash64("text"), F.lit(max(count, 1))).alias("block")), "benchmark-blocks") if count > 1 else items.withColumn("block", F.lit(0))
    for block in range(count):
        own = [(r["item_id"], r["text"]) for r in dealt.where(F.col("block") == block).select("item_id", "text").collect()]
        if own:
            yield spark.sparkContext.broadcast(Index(sorted(own, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1])), shortest))


def clean(docs: DataFrame, benchmark: DataFrame, *, least: int = 13, shortest: int = 5, cost: int = 4, block_words: int = 500_000) -> DataFrame:
    """Rows of ``docs`` that hold no item, all columns as they are; each row is judged by its own text, whatever its id."""
    for index in blocks_of(benchmark, shortest, block_words):

        def test(rows: list[str], index=index) -> list[bool]:
            ix, known, keep = index.value, _Hashes(), []
            for lo in range(0, len(rows), 500):
                part = rows[lo : lo + 500]
                out = {d for d, _ in found(ix, part, known, least, cost)}
                keep += [i not in out for i in range(len(part))]
            return keep

        docs = keep_rows(docs, test)
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, *, least: int = 13, shortest: int = 5, cost: int = 4, block_words: int = 500_000) -> DataFrame:
    """doc_id, item_id, matched_words, overlap_words: one row for each document and item found in it."""
    kind, item_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    parts = []
    for index in blocks_of(benchmark, shortest, block_words):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix, known = index.value, _Hashes()
            for b in batches:
                for lo in range(0, b.num_rows, 500):
                    c = b.slice(lo, 500)
                    best = found(ix, texts(c.column("text")), known, least, cost)
                    if best:
                        at = list(best)
                        yield pa.RecordBatch.from_arrays(
                            [c.column("doc_id").take(pa.array([d for d, _ in at])), pa.array([ix.ids[i] for _, i in at]).cast(item_type), pa.array([best[k][0] for k in at], pa.int64()), pa.array([best[k][1] for k in at], pa.int64())],
                            ["doc_id", "item_id", "matched_words", "overlap_words"],
                        )

        parts.append(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, item_id {item_kind}, matched_words long, overlap_words long"))
    if not parts:
        return docs.where(F.lit(False)).select("doc_id", F.lit(None).cast(item_kind).alias("item_id"), F.lit(0).cast("long").alias("matched_words"), F.lit(0).cast("long").alias("overlap_words"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("doc_id", "item_id").agg(F.max("matched_words").alias("matched_words"), F.max("overlap_words").alias("overlap_words"))

