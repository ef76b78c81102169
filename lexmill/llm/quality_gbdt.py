"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text are computed once per document (``STATS``). Trees are grown level by level on histograms of
binned statistics, then flattened into four arrays (statistic, threshold, left child, value) so that scoring walks all
trees of all documents of a batch together with numpy indexing.

Cases: a null or empty text has all statistics 0 and still gets a score; null ids are scored and count as not held out;
repeated rows are scored once each; an empty table gives no rows; without labelled rows of both kinds every score is the
smoothed prior. Extra columns of the input are ignored.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import fold, labelled_sample, texts

STATS = [
    "log_bytes", "log_words", "word_len_mean", "word_len_sd", "short_words", "long_words", "distinct_words", "top_word", "adjacent_repeats", "distinct_pairs", "lower", "upper", "digits", "space",
    "punct", "bang", "pipe", "marks", "non_ascii", "mark_endings", "log_lines", "distinct_lines", "top_line", "line_len", "upper_words", "stops",
]
_ENDINGS = re.compile(rb"[!-/:-@\[-`{-~]{2,}(?=\s|\Z)")
_SHOUTED = re.compile(rb"(?<![^\s])[A-Z]{2,}(?![a-z])")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of ``STATS``."""
    if not text:
        return [0.0] * len(STATS)
    raw = text.encode("utf-8", "replace")
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    words = raw.split()
    n = len(words) or 1
    lens = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    count = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    by_line = Counter(lines)
    marks = hist[35] + hist[36] + hist[37] + hist[38] + hist[42] + hist[94] + hist[126]
    punct = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    return [
        math.log1p(size), math.log1p(len(words)), float(lens.mean()), float(lens.std()), float((lens <= 3).sum()) / n, float((lens >= 12).sum()) / n, len(count) / n, max(count.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n, len(set(zip(words, words[1:]))) / n, hist[97:123].sum() / size, hist[65:91].sum() / size, hist[48:58].sum() / size, (hist[9:14].sum() + hist[32]) / size,
        punct / size, hist[33] / size, hist[124] / size, marks / size, hist[128:].sum() / size, len(_ENDINGS.findall(raw)) / n, math.log1p(len(lines)), len(by_line) / (len(lines) or 1),
        max((len(k) * v for k, v in by_line.items()), default=0) / size, size / (len(lines) or 1), len(_SHOUTED.findall(raw)) / n, (hist[44] + hist[46]) / n,
    ]


def matrix(batch: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in batch], np.float32).reshape(-1, len(STATS))


@dataclass
class Trees:
    """All nodes of all trees in flat arrays; a leaf is its own child."""

    stat: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of ``x``: every row stands at one node of every tree and all move down together."""
        out = np.full(len(x), self.base)
        if len(self.roots):
            at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = np.where(x[rows, self.stat[at]] <= self.cut[at], self.left[at], self.right[at])
            out = out + self.value[at].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 5, bins: int = 64, rate: float = 0.12, ridge: float = 2.0, least: float = 4.0) -> Trees:
    """Fit on a bounded sample: second-order logistic boosting, one histogram pass a level for all its nodes."""
    n, f = x.shape
    share = (float(y.sum()) + 1.0) / (n + 2.0)
    base = math.log(share / (1 - share))
    stat, cut, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1], method="lower")) for j in range(f)]
        coded = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        offset = np.arange(f) * bins
        margin = np.full(n, base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            where = np.zeros(n, np.int64)
            first = len(stat)
            roots.append(first)
            level = [first]
            for s in (stat, left, right):
                s.append(first if s is not stat else 0)
            cut.append(np.inf)
            value.append(0.0)
            own = np.full(n, first)
            for d in range(depth + 1):
                k = len(level)
                live = where >= 0
                gs = np.bincount(where[live], g[live], k)
                hs = np.bincount(where[live], h[live], k)
                for i, node in enumerate(level):
                    value[node] = rate * gs[i] / (hs[i] + ridge)
                if d == depth:
                    break
                key = (where[live, None] * (f * bins) + offset + coded[live]).ravel()
                hg = np.bincount(key, np.repeat(g[live], f), k * f * bins).reshape(k, f, bins).cumsum(2)
                hh = np.bincount(key, np.repeat(h[live], f), k * f * bins).reshape(k, f, bins).cumsum(2)
                rg, rh = gs[:, None, None] - hg, hs[:, None, None] - hh
                gain = np.where((hh > least) & (rh > least), hg**2 / (hh + ridge) + rg**2 / (rh + ridge) - (gs**2 / (hs + ridge))[:, None, None], -1.0)
                best = gain.reshape(k, -1).argmax(1)
                new, onward = [], np.full((k, 2), -1)
                for i, node in enumerate(level):
                    if gain[i].ravel()[best[i]] > 1e-3:
                        j, b = divmod(int(best[i]), bins)
                        if b >= len(edges[j]):
                            continue
                        stat[node], cut[node] = j, float(edges[j][b])
                        for side, child in ((0, left), (1, right)):
                            child[node] = len(stat)
                            onward[i, side] = len(new)
                            new.append(len(stat))
                            stat.append(0)
                            cut.append(np.inf)
                            value.append(0.0)
                            left.append(new[-1])
                            right.append(new[-1])
                if not new:
                    break
                node_of = np.array(level)
                at = node_of[np.where(live, where, 0)]
                goes_right = x[np.arange(n), np.array(stat)[at]] > np.array(cut)[at]
                moved = np.where(live, onward[np.where(live, where, 0), goes_right.astype(int)], -1)
                own = np.where(moved >= 0, np.array(new)[np.maximum(moved, 0)], own)
                where, level = moved, new
            margin = margin + np.array(value)[own]
    ints = [np.array(a, np.int32) for a in (stat, left, right, roots)]
    return Trees(ints[0], np.array(cut, np.float32), ints[1], ints[2], np.array(value), ints[3], depth, base)


def fit(docs: DataFrame, labels: DataFrame, *, target: str = "quality", parts: int = 4, held: int = 2, max_rows: int = 12_000, **options) -> Trees:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold; only their statistics reach the driver."""
    sample = labelled_sample(docs, labels, target, fold("doc_id", parts, held), max_rows)
    schema = "y int, " + ", ".join(f"{s} float" for s in STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = matrix(texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("y"), *(pa.array(m[:, j]) for j in range(m.shape[1]))], ["y", *STATS])

    got = sample.select("text", "y").mapInArrow(run, schema).toPandas()
    got = got.sort_values(list(got.columns), ignore_index=True)  # the same trees however the rows arrive
    return grow(got[STATS].to_numpy(np.float32), got["y"].to_numpy(float), **options)


def score(docs: DataFrame, model: Trees, *, parts: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = texts(b.column("text"))
            p = np.concatenate([model.score(matrix(t[i : i + 512])) for i in range(0, len(t), 512)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return (
        docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
        .select("doc_id", fold("doc_id", parts, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    )
