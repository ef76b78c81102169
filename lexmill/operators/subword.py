"""Byte-pair encoding of words: learning, applying, recovering."""

from __future__ import annotations

import heapq
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.lines import Line, rule

END = "</w>"


def learn(lines: DataFrame, merges: int = 10_000, least: int = 2, value: str = "value", max_words: int = 3_000_000, max_letters: int = 30_000_000) -> list[tuple[str, str]]:
    """Merge pairs by falling frequency, ties by the smaller pair, from all words. Words are counted by Spark; up to
    ``max_words`` distinct ones of ``max_letters`` in all the merges are learned on the driver (about 40 bytes a letter), beyond that in rounds
    over a Spark table."""
    from lexmill.operators.tables import word_counts

    counts = word_counts(lines, value).where("word <> ''").persist()
    try:
        size = counts.agg(F.count("word").alias("n"), F.coalesce(F.sum(F.length("word")), F.lit(0)).alias("letters")).first()
        if size["n"] > max_words or size["letters"] > max_letters:
            return learn_in_rounds(counts, merges, least)
        own = counts.select("word", "freq").toArrow()
    finally:
        counts.unpersist()
    return learn_words(own.column("word").combine_chunks(), own.column("freq").to_numpy(), merges, least)


def learn_from(counts: dict[str, int], merges: int, least: int = 2) -> list[tuple[str, str]]:
    words = [w for w in counts if w]
    return learn_words(pa.array(words, pa.string()), np.array([counts[w] for w in words], np.int64), merges, least)


def learn_words(words: pa.Array, freq: np.ndarray, merges: int, least: int = 2) -> list[tuple[str, str]]:
    """Symbols of all words in one array with links to their neighbours. A merge looks at the places of its pair together and
    counts only the pairs beside them anew."""
    if not len(words):
        return []
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    n, last = len(letters), np.cumsum(size) - 1
    letters[last] += 1 << 21
    found, sym = np.unique(letters, return_inverse=True)
    del letters
    names = [chr(c & 0x1FFFFF) + (END if c >> 21 else "") for c in found.tolist()]
    ids = {w: k for k, w in enumerate(names)}
    sym = np.append(sym.astype(np.int32), np.int32(-1))  # the last stands for no neighbour
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[last] = n
    before[np.append(0, last[:-1] + 1)] = n
    weight = np.repeat(freq.astype(np.int64), size)
    key_of = lambda a, b: (a.astype(np.int64) << 32) | b.astype(np.int64)

    def by_key(keys: np.ndarray, *others: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[cut].tolist(), cut, [x[order] for x in others]

    place = np.flatnonzero(after[:n] < n).astype(np.int32)
    pairs: dict[int, int] = {}
    where: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[tuple[int, tuple[str, str], int]] = []
    push = lambda k: heapq.heappush(heap, (-pairs[k], (names[k >> 32], names[k & 0xFFFFFFFF]), k))
    if len(place):
        keys, cut, (place, w) = by_key(key_of(sym[place], sym[after[place]]), place, weight[place])
        pairs = dict(zip(keys, np.add.reduceat(w, cut).tolist()))
        for k, at in zip(keys, np.split(place, cut[1:])):
            where[k].append(at)
            push(k)
    out: list[tuple[str, str]] = []
    while len(out) < merges and heap:
        count, best, key = heapq.heappop(heap)
        if pairs.get(key) != -count:  # counted anew since
            continue
        if -count < least:
            break
        out.append(best)
        a, b = key >> 32, key & 0xFFFFFFFF
        if (c := ids.setdefault(best[0] + best[1], len(names))) == len(names):
            names.append(best[0] + best[1])
        p = np.sort(np.concatenate(where.pop(key)))
        p = p[(sym[p] == a) & (sym[after[p]] == b)]
        del pairs[key]
        if a == b:  # of a run of places every other one, from the left
            new = np.append(True, p[1:] != after[p[:-1]])
            p = p[(np.arange(len(p)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % 2 == 0]
        r, f = after[p], weight[p]
        left, right = before[p], after[r]
        gone_right = right < n
        minus_right = key_of(sym[r[gone_right]], sym[right[gone_right]])
        old_left = sym[left]
        sym[r] = -2
        gone_left = (left < n) & (sym[left] != -2)  # else it is the right side of the merge before
        minus_left = key_of(old_left[gone_left], np.full(gone_left.sum(), a))
        sym[p] = c
        after[p] = right
        before[right[gone_right]] = p[gone_right]
        left = before[p]
        own = (left < n) & ~np.isin(left, p, assume_unique=False)
        plus_left, plus_right = key_of(sym[left[own]], np.full(own.sum(), c)), key_of(np.full(gone_right.sum(), c), sym[right[gone_right]])
        plus, at, gain = np.concatenate([plus_left, plus_right]), np.concatenate([left[own], p[gone_right]]), np.concatenate([f[own], f[gone_right]])
        minus, loss = np.concatenate([minus_left, minus_right]), np.concatenate([f[gone_left], f[gone_right]])
        changed = set()
        if len(minus):
            keys, cut, (loss,) = by_key(minus, loss)
            for k, x in zip(keys, np.add.reduceat(loss, cut).tolist()):
                if k in pairs:
                    pairs[k] -= x
                    changed.add(k)
        if len(plus):
            keys, cut, (at, gain) = by_key(plus, at, gain)
            ends = [*cut[1:].tolist(), len(at)]
            for k, x, lo, hi in zip(keys, np.add.reduceat(gain, cut).tolist(), cut.tolist(), ends):
                pairs[k] = pairs.get(k, 0) + x
                where[k].append(at[lo:hi])
                changed.add(k)
        for k in changed:
            if pairs[k] > 0:
                push(k)
            else:
                del pairs[k]
                where.pop(k, None)
    return out


def learn_in_rounds(counts: DataFrame, merges: int, least: int = 2, top: int = 2_000) -> list[tuple[str, str]]:
    """The merges of ``learn_from`` with the words in a Spark table. A round counts all pairs and joins as many of the
    most frequent as no other can come before: a pair made by joining (a, b) is at most as frequent as the pairs that end
    with a or begin with b, so the round goes on while the next pair is more frequent than all of those."""
    spark = counts.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or "file://" + tempfile.mkdtemp(prefix="lexmill-")
    path = f"{folder.rstrip('/')}/bpe-{uuid.uuid4().hex}"
    split = F.split("word", "")
    last = F.concat(F.element_at(split, -1), F.lit(END))
    table = counts.where("word <> ''").select(F.concat(F.slice(split, 1, F.size(split) - 1), F.array(last)).alias("s"), "freq")
    out: list[tuple[str, str]] = []
    round_no = 0
    while len(out) < merges:
        table.write.parquet(f"{path}/round-{round_no}")
        if round_no > 1:
            _remove(spark, f"{path}/round-{round_no - 2}")
        table = spark.read.parquet(f"{path}/round-{round_no}")
        round_no += 1
        each = table.where(F.size("s") > 1).select("freq", F.explode(F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("a"), F.slice("s", 2, F.size("s") - 1).alias("b"))).alias("p"))
        ranked = each.groupBy("p.a", "p.b").agg(F.sum("freq").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "a", "b").limit(top).collect()
        batch = next_merges([((r["a"], r["b"]), r["n"]) for r in ranked], len(ranked) < top, {x + y for x, y in out})[: merges - len(out)]
        if not batch:
            break
        out += batch
        table = table.select(_joined(batch)("s").alias("s"), "freq")
    _remove(spark, path)
    return out


def _joined(batch: list[tuple[str, str]]):
    @F.pandas_udf("array<string>")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda s: reduce(lambda x, p: merged(x, p) if len(x) > 1 and p[0] in x else x, batch, list(s)))

    return run


def next_merges(ranked: list[tuple[tuple[str, str], int]], whole: bool, made: set[str]) -> list[tuple[str, str]]:
    """The leading pairs that are merged next, in this order, whatever the merges before them make. ``ranked`` is ordered;
    if it isn't the ``whole`` list, pairs as rare as its last are left to the next round. A pair that makes a symbol there is
    already (``made``, or a last character) ends the round: pairs of that symbol become more frequent."""
    starts: dict[str, int] = {}
    ends: dict[str, int] = {}
    for (a, b), n in ranked:
        starts[a], ends[b] = max(n, starts.get(a, 0)), max(n, ends.get(b, 0))
    out: list[tuple[str, str]] = []
    bound = 0 if whole or not ranked else ranked[-1][1]
    for (a, b), n in ranked:
        if out and n <= bound:
            break
        out.append((a, b))
        if a + b in made or ((a + b).endswith(END) and len(a + b) == 1 + len(END)):
            break
        made = made | {a + b}
        bound = max(bound, ends.get(a, 0), starts.get(b, 0))
    return out


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def merged(symbols: list[str], pair: tuple[str, str]) -> list[str]:
    """Every occurrence of the pair joined, from the left."""
    out: list[str] = []
    for s in symbols:
        if out and out[-1] == pair[0] and s == pair[1] and not out[-1].startswith("\0"):
            out[-1] = "\0" + pair[0] + s
        else:
            out.append(s)
    return [s.removeprefix("\0") for s in out]


class Encoder:
    """Applies merge pairs; the first of repeated pairs counts."""

    def __init__(self, codes: Iterable[tuple[str, str]], separator: str = "@@", whole: Iterable[str] = ()):
        self.rank: dict[tuple[str, str], int] = {}
        for i, p in enumerate(codes):
            self.rank.setdefault(tuple(p), i)
        self.separator, self.whole, self.known = separator, set(whole), {}
        self.tag = regex.compile("^<[A-Za-z]+(:.*)?>$")

    def word(self, w: str) -> list[str]:
        if w in self.whole or self.tag.match(w):
            return [w]
        if (out := self.known.get(w)) is None:
            s = [*w[:-1], w[-1] + END]
            while len(s) > 1:
                best = min(zip(s, s[1:]), key=lambda p: self.rank.get(p, len(self.rank)))
                if best not in self.rank:
                    break
                s = merged(s, best)
            s[-1] = s[-1].removesuffix(END)
            if len(self.known) > 500_000:
                self.known.clear()
            out = self.known[w] = [x for x in s if x]
        return out

    def line(self, text: str) -> str:
        return " ".join(f"{self.separator} ".join(self.word(w)) for w in text.split())


@rule("common", "BPE_Apply_Line")
def apply(codes: Iterable[tuple[str, str]], separator: str = "@@", whole: Iterable[str] = ()) -> Line:
    """Subwords joined by blanks, all but a word's last followed by the separator. Tags <X:...> and listed words stay."""
    enc = Encoder(codes, separator, whole)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda t: enc.line(t).strip() if t else None, na_action=None)

    return run


rule("common", "BPE_Apply")(apply)


def recover(c: Column, separator: str = "@@") -> Column:
    return F.replace(c, F.lit(separator + " "), F.lit(""))
