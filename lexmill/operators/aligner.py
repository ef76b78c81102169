"""Word and phrase alignment of sentence pairs."""

from __future__ import annotations

import math
from functools import reduce
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.regex import tokens
from lexmill.operators.blocks import Block, beside, blocks, spread, totals_rows


def word_table(pairs: DataFrame, rounds: int = 5, tension: float = 4.0, null_prob: float = 0.08, key: str = "pair_id", src: str = "src", tgt: str = "tgt", least: float = 1e-7) -> DataFrame:
    """lw, rw, p: translation probabilities p(rw | lw) by expectation-maximisation of a lexical model whose alignment
    prior falls with the distance from the diagonal (log-linear, normalised over the source positions of each target
    word); the empty source word takes ``null_prob``. A table without target words that a source word gives ``least`` or less.

    Pairs are dealt to blocks of target words (``blocks``), in which a round needs nothing but the counts of each source word
    in all blocks. Only these are kept between rounds, so each round counts those before it again."""
    last = lambda b, model: model.table(b)
    return _rounds(pairs, rounds, tension, null_prob, key, src, tgt, least, last, "lw string, rw string, p double")


def own_links(pairs: DataFrame, rounds: int = 5, tension: float = 4.0, null_prob: float = 0.08, key: str = "pair_id", src: str = "src", tgt: str = "tgt", least: float = 1e-7) -> DataFrame:
    """``links`` by the pairs' own ``word_table``, found in its blocks: the table isn't written or joined."""
    last = lambda b, model: model.best(b)
    best = _rounds(pairs, rounds, tension, null_prob, key, src, tgt, least, last, f"k {pairs.schema[key].dataType.simpleString()}, j int, i int")
    return _lines_of_links(best, key)


def _rounds(pairs, rounds, tension, null_prob, key, src, tgt, least, last, schema) -> DataFrame:
    count = blocks(pairs)
    rows = spread(pairs.select(F.col(key).alias("k"), tokens(F.col(src)).alias("s"), tokens(F.col(tgt)).alias("t")), count)
    more: list[DataFrame] = []
    for no in range(1, rounds + 1):
        own = _pass(rows, more, count, Model(tension, null_prob, least, no - 1), lambda b, model: model.totals(b), "lw string, v double")
        more.append(totals_rows(own.groupBy("lw").agg(F.sum("v").alias("v")).persist(), no, count))  # a row a word
    return _pass(rows, more, count, Model(tension, null_prob, least, rounds), last, schema)


def _pass(rows, more, count, model, of, schema) -> DataFrame:
    both = beside(rows, reduce(DataFrame.unionByName, more), count) if more else rows.repartitionById(count, "b")

    def run(batches):
        yield from of(Block(batches), model)

    return both.mapInArrow(run, schema)


class Model:
    """``known`` rounds whose counts of source words a block has."""

    def __init__(self, tension: float, null_prob: float, least: float, known: int):
        self.tension, self.null_prob, self.least, self.known = tension, null_prob, least, known

    def _slice(self, b: Block, cut: slice):
        start, entry, i, pair = b.products(cut, True)
        who = b.who[cut][entry]
        weight = np.exp(-self.tension * np.abs((i + 1) / b.n[who] - ((b.at[cut] + 1) / b.m[b.who[cut]])[entry]))
        weight[start] = 0.0  # the empty word comes first
        prior = (1 - self.null_prob) * weight / np.add.reduceat(weight, start)[entry]
        prior[start] = self.null_prob
        return start, entry, i, pair, prior

    def _groups(self, b: Block):
        """Of each group of target words: its slices, the keys of its word pairs and their probabilities after the known
        rounds, those of ``least`` or less 0."""
        totals = [b.totals(no) for no in range(1, self.known + 1)]
        for cuts in b.groups():
            one = self._slice(b, cuts[0]) if len(cuts) == 1 else None
            parts = lambda: [one] if one else (self._slice(b, c) for c in cuts)  # noqa: B023, E731
            if one:
                keys, inverse = np.unique(one[3], return_inverse=True)
            else:
                keys, inverse = np.unique(np.concatenate([np.unique(x[3]) for x in parts()])), None
            at = lambda x: inverse if inverse is not None else np.searchsorted(keys, x[3])  # noqa: B023, E731
            p = np.ones(len(keys))
            for t in totals:
                p = self._counts(parts(), at, p) / t[keys % len(b.words)]
                p[p <= self.least] = 0.0
            yield cuts, parts, keys, at, p

    @staticmethod
    def _counts(parts, at, p: np.ndarray) -> np.ndarray:
        out = np.zeros(len(p))
        for x in parts:
            where = at(x)
            w = x[4] * p[where]
            whole = np.add.reduceat(w, x[0])
            out += np.bincount(where, w / np.where(whole > 0, whole, 1.0)[x[1]], len(p))
        return out

    def totals(self, b: Block):
        out = np.zeros(len(b.words))
        for _, parts, keys, at, p in self._groups(b):
            out += np.bincount(keys % len(b.words), self._counts(parts(), at, p), len(b.words))
        hit = np.flatnonzero(out)
        for lo in range(0, len(hit), 100_000):
            h = hit[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([b.names.take(pa.array(h)), pa.array(out[h])], ["lw", "v"])

    def table(self, b: Block):
        for _, _, keys, _, p in self._groups(b):
            hit = np.flatnonzero((p > self.least) & (keys % len(b.words) > 0))
            for lo in range(0, len(hit), 100_000):
                h = hit[lo : lo + 100_000]
                yield pa.RecordBatch.from_arrays([b.names.take(pa.array(keys[h] % len(b.words))), b.names.take(pa.array(keys[h] // len(b.words))), pa.array(p[h])], ["lw", "rw", "p"])

    def best(self, b: Block):
        for cuts, parts, _, at, p in self._groups(b):
            for cut, x in zip(cuts, parts()):
                start, entry, i, _, prior = x
                w = prior * np.where(p > self.least, p, 1e-7)[at(x)]
                w[start] = -1.0
                top = np.flatnonzero(w == np.maximum.reduceat(w, start)[entry])
                _, first = np.unique(entry[top], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(b.keys.take(pa.array(b.who[cut])).to_pylist(), b.keys.type), pa.array(b.at[cut].astype(np.int32)), pa.array(i[top[first]].astype(np.int32))], ["k", "j", "i"])


def expanded(pairs: DataFrame, tension: float, null_prob: float, key: str, src: str, tgt: str) -> DataFrame:
    """One row for each (pair, target position, source position or empty) with its prior."""
    w = pairs.select(F.col(key).alias("k"), tokens(F.col(src)).alias("s"), tokens(F.col(tgt)).alias("t")).withColumns({"n": F.size("s"), "m": F.size("t")}).where("n > 0 and m > 0")
    weight = lambda i, j: F.exp(-F.lit(tension) * F.abs((i + 1) / F.col("n") - (j + 1) / F.col("m")))
    each = w.select("k", "s", "n", "m", F.posexplode("t").alias("j", "rw"))
    z = F.aggregate(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: weight(i, F.col("j"))), F.lit(0.0), lambda a, v: a + v)
    each = each.withColumn("z", z)
    words = F.transform("s", lambda x, i: F.struct(i.alias("i"), x.alias("lw"), ((1 - null_prob) * weight(i, F.col("j")) / F.col("z")).alias("prior")))
    empty = F.array(F.struct(F.lit(-1).alias("i"), F.lit("<eps>").alias("lw"), F.lit(null_prob).alias("prior")))
    return each.withColumn("x", F.explode(F.concat(empty, words))).select("k", "j", "rw", "x.i", "x.lw", "x.prior")


def links(pairs: DataFrame, table: DataFrame, tension: float = 4.0, null_prob: float = 0.08, key: str = "pair_id", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """key, links: for each target word its best source word as ``i-j``; ties go to the smaller i."""
    e = expanded(pairs, tension, null_prob, key, src, tgt).where("i >= 0")
    best = e.join(table, ["lw", "rw"], "left").withColumn("w", F.col("prior") * F.coalesce("p", F.lit(1e-7))).groupBy("k", "j").agg(F.max_by("i", F.struct("w", (-F.col("i")).alias("ni"))).alias("i"))
    return _lines_of_links(best, key)


def _lines_of_links(best: DataFrame, key: str) -> DataFrame:
    one = F.struct("j", F.concat_ws("-", F.col("i").cast("string"), F.col("j").cast("string")).alias("l"))
    return best.groupBy("k").agg(F.sort_array(F.collect_list(one)).alias("_l")).select(F.col("k").alias(key), F.array_join(F.transform("_l", lambda x: x["l"]), " ").alias("links"))


# --- sampling aligner -------------------------------------------------------------------------------------------------


def sample_sizes(n: int, rounds: int, seed: int) -> list[int]:
    """Sub-corpus sizes 1 to n drawn with weights -1 / (k ln(1 - k / (n + 1)))."""
    if n < 1:
        return []
    weights = [-1.0 / (k * math.log(1 - k / (n + 1))) for k in range(1, n + 1)]
    return Random(seed).choices(range(1, n + 1), weights, k=rounds)


def phrase_candidates(pairs: DataFrame, key: str = "pair_id", src: str = "src", tgt: str = "tgt", longest: int = 7) -> DataFrame:
    """src, tgt, freq from one sub-corpus: words of both sides that occur on exactly the same lines form a group; on each
    of those lines the group's words, and the words left over, are a phrase pair if both sides are contiguous runs."""
    lines = pairs.select(F.col(key).alias("k"), F.explode(F.array(F.struct(F.lit(0).alias("side"), tokens(F.col(src)).alias("w")), F.struct(F.lit(1).alias("side"), tokens(F.col(tgt)).alias("w")))).alias("x"))
    words = lines.select("k", "x.side", F.posexplode("x.w").alias("at", "word"))
    # a set of lines is its sum of hashes: two of 64 bits, summed per task, so a word on very many lines stays small
    keyed = words.select("side", "word", "k").distinct().groupBy("side", "word").agg(F.bit_xor(F.xxhash64(F.lit(1), "k")).alias("g1"), F.bit_xor(F.xxhash64(F.lit(2), "k")).alias("g2"))
    both = keyed.groupBy("g1", "g2").agg(F.count_distinct("side").alias("_s")).where("_s = 2").select("g1", "g2")
    groups = keyed.join(both, ["g1", "g2"])
    marked = words.join(groups, ["side", "word"])
    on_line = marked.select("k", "g1", "g2").distinct()
    all_words = on_line.join(words, "k").join(marked.select("k", "g1", "g2", "side", "at", F.lit(True).alias("own")), ["k", "g1", "g2", "side", "at"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    phrase = all_words.groupBy("k", "g1", "g2", "own", "side").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("p"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    ok = phrase.where((F.col("hi") - F.col("lo") + 1 == F.size("p")) & (F.size("p") <= longest)).withColumn("text", F.array_join(F.transform("p", lambda x: x["word"]), " "))
    two = ok.groupBy("k", "g1", "g2", "own").pivot("side", [0, 1]).agg(F.first("text")).where("`0` is not null and `1` is not null")
    return two.groupBy(F.col("0").alias("src"), F.col("1").alias("tgt")).agg(F.count("*").alias("freq"))


def sampled_phrases(pairs: DataFrame, rounds: int = 10, seed: int = 1, key: str = "pair_id", longest: int = 7) -> DataFrame:
    """src, tgt, freq summed over seeded random sub-corpora (a sampling operator: its result depends on the seed, not on
    how rows are partitioned)."""
    n = pairs.count()
    out = None
    for i, size in enumerate(sample_sizes(n, rounds, seed)):
        part = pairs.where(F.pmod(F.xxhash64(F.lit(seed * 1000 + i), F.col(key)), F.lit(1 << 30)) < int(size / n * (1 << 30)))
        own = phrase_candidates(part, key, longest=longest)
        out = own if out is None else out.unionByName(own)
    return out.groupBy("src", "tgt").agg(F.sum("freq").alias("freq")) if out is not None else pairs.sparkSession.createDataFrame([], "src string, tgt string, freq long")
