"""Toxicity: a counterfactual-regularised classifier.

Logistic regression on the presence of words and word beginnings. For every labelled document that names an identity
term, the term is exchanged with each other term of its group in all its sentences, the swapped text gets its own features,
and the squared change of the score (the probability, not the margin) is penalised, so a neutral mention of a group moves
no score. The swapped features are exact: what other words of the document share stays, and a document that holds both
terms doesn't change. The terms are a parameter (``groups``, by default ``IDENTITY_GROUPS``, English); where no labelled
document names one, as in the synthetic tables, there is nothing to swap and plain logistic regression is what remains.

Cases: a null or empty text has no features and gets the score of the intercept; null ids are scored and count as not held
out; repeated rows are scored once each; an empty table gives no rows; without labelled rows of both kinds every score is
the smoothed prior. Extra columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import fold, labelled_sample, materialise, texts

#: Groups of terms that may stand for one another in a sentence.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "american"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "citizens", "foreigners", "natives"),
    ("disabled", "deaf", "blind", "autistic", "elderly", "young"),
)
_WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5)


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings (marked with a caret)."""
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]


def document_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)}


def swaps(groups) -> dict[str, list[str]]:
    return {t: [o for o in g if o != t] for g in groups for t in g}


def counterfactuals(text: str, partners: dict[str, list[str]]) -> list[tuple[str, str, set[str], set[str], float]]:
    """(term, other, features gained, features lost, weight) for every exchange of a term the text names with another of
    its group. The weights of a term's swaps add up to 1."""
    words = set(_WORD.findall(text.lower()))
    out = []
    for term in sorted(words & partners.keys()):
        for other in partners[term]:
            swapped = {other if w == term else term if w == other else w for w in words}
            gone, come = words - swapped, swapped - words
            before = {f for w in gone for f in features_of(w)}
            after = {f for w in come for f in features_of(w)}
            stay = {f for w in words & swapped for f in features_of(w)} if gone else set()
            out.append((term, other, after - before - stay, before - after - stay, 1 / len(partners[term])))
    return out


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, batch: list[str]) -> np.ndarray:
        known, out = self._known(), np.empty(len(batch))
        for i, text in enumerate(batch):
            hit: set[str] = set()
            for w in set(_WORD.findall(text.lower())):
                if (fs := known.get(w)) is None:
                    if len(known) > 500_000:  # a cache of words, never of results
                        known.clear()
                    fs = known[w] = tuple(f for f in features_of(w) if f in self.weights)
                if fs:
                    hit.update(fs)
            out[i] = self.bias + math.fsum(self.weights[f] for f in hit)
        return sigmoid(out)

    def _known(self) -> dict:
        if "_cache" not in self.__dict__:
            self.__dict__["_cache"] = {}
        return self.__dict__["_cache"]


@dataclass
class Swaps:
    """Swapped documents: the document of each, its weight, and the features it gains (1) or loses (-1)."""

    doc: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    col: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(found: list[tuple[int, float, list[int], list[int]]]) -> Swaps:
        """From (document, weight, gained, lost); swaps that change no feature stay, with nothing to penalise."""
        row = np.repeat(np.arange(len(found)), [len(g) + len(m) for _, _, g, m in found]).astype(np.int64)
        col = np.array([j for _, _, g, m in found for j in [*g, *m]], np.int64)
        value = np.array([v for _, _, g, m in found for v in [1.0] * len(g) + [-1.0] * len(m)])
        return Swaps(np.array([d for d, *_ in found], np.int64), np.array([k for _, k, *_ in found], float), row, col, value)

    def penalty(self, w: np.ndarray, z: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Weighted mean of the squared score changes; its gradient by the margins of the documents, which all features
        of a document share, and by the weights of the swapped features."""
        if not len(self.doc):
            return 0.0, np.zeros(len(z)), np.zeros(len(w))
        k = self.weight / self.weight.sum()
        own = z[self.doc]
        p, q = sigmoid(own), sigmoid(own + np.bincount(self.row, self.value * w[self.col], len(self.doc)))
        c = 2 * k * (q - p)
        by_doc = np.bincount(self.doc, c * (q * (1 - q) - p * (1 - p)), len(z))
        by_weight = np.bincount(self.col, self.value * (c * q * (1 - q))[self.row], len(w))
        return float((k * (q - p) ** 2).sum()), by_doc, by_weight


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, names: list[str], swapped: Swaps, *, fairness: float = 20.0, ridge: float = 2e-4, steps: int = 600) -> Model:
    """Accelerated gradient descent on mean logistic loss + ridge + fairness * mean squared score change under swaps.

    rows, cols: the presence matrix of the labelled documents."""
    n, f = len(y), len(names)
    prior = (float(y.sum()) + 1) / (n + 2)
    bias0 = math.log(prior / (1 - prior))
    if not n or not 0 < y.sum() < n:
        return Model({}, bias0)
    width = np.bincount(rows, minlength=n).max() + 1.0
    moved = np.bincount(swapped.row, np.abs(swapped.value), len(swapped.doc)).max() if len(swapped.doc) else 0.0
    # the change's slope is at most a quarter of what a swap moves plus a tenth of it for each feature both texts share
    rate = 1.0 / (0.25 * width + ridge + 2 * fairness * (moved / 4 + 0.1 * moved**0.5 * width**0.5))
    w = v = np.zeros(f + 1)
    v[f] = w[f] = bias0
    for t in range(steps):
        z = np.bincount(rows, v[cols], n) + v[f]
        _, by_doc, by_weight = swapped.penalty(v[:f], z)
        r = (sigmoid(z) - y) / n + fairness * by_doc
        grad = np.append(np.bincount(cols, r[rows], f) + ridge * v[:f] + fairness * by_weight, r.sum())
        nxt = v - rate * grad
        v = nxt + t / (t + 3) * (nxt - w)
        w = nxt
    return Model({name: float(w[j]) for j, name in enumerate(names) if w[j]}, float(w[f]))


def fit(docs: DataFrame, labels: DataFrame, *, target: str = "toxic", parts: int = 5, held: int = 0, max_rows: int = 12_000, max_features: int = 3000, groups=IDENTITY_GROUPS, **options) -> Model:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold. Two passes over that sample: the first
    counts features by label and keeps the ``max_features`` with the largest chi-square (identity terms always stay), the
    second returns the presence of the kept ones in each document and in its swapped forms."""
    sample = materialise(labelled_sample(docs, labels, target, fold("doc_id", parts, held), max_rows), "toxicity-sample")
    partners = swaps(groups)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg = Counter(), Counter()
        for b in batches:
            for t, y in zip(texts(b.column("text")), b.column("y").to_pylist()):
                (pos if y else neg).update(document_features(t))
        keys = sorted(pos.keys() | neg.keys())
        for i in range(0, len(keys), 50_000):
            k = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array([pos[x] for x in k], pa.int64()), pa.array([neg[x] for x in k], pa.int64())], ["f", "pos", "neg"])

    of = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = of.get(1, 0), of.get(0, 0)
    p, q = F.col("pos"), F.col("neg")
    seen = p + q
    chi = F.pow(p * F.lit(float(n0)) - q * F.lit(float(n1)), 2) / (seen * (F.lit(float(n0 + n1)) - seen + 1.0))
    kept = (
        sample.select("text", "y").mapInArrow(count, "f string, pos long, neg long")
        .groupBy("f").agg(*(F.sum(c).alias(c) for c in ("pos", "neg")))
        .select("f", chi.alias("chi"), F.col("f").isin(sorted(partners)).alias("own"))
        .where(F.col("own") | (F.col("chi") > 10.83))  # one in a thousand by chance
        .orderBy(F.desc("own"), F.desc("chi"), "f").limit(max_features).collect()
    )
    names = sorted(r["f"] for r in kept)
    at = {x: j for j, x in enumerate(names)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lambda fs: sorted(at[f] for f in fs if f in at)
        for b in batches:
            held = texts(b.column("text"))
            hits = [known(document_features(t)) for t in held]
            moves = [[{"weight": k, "gained": known(g), "lost": known(m)} for _, _, g, m, k in counterfactuals(t, partners)] for t in held]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(hits, pa.list_(pa.int32())), pa.array(moves, MOVES)], ["doc_id", "y", "hits", "moves"])

    kind = dict(docs.dtypes)["doc_id"]
    got = sample.mapInArrow(present, f"doc_id {kind}, y int, hits array<int>, moves array<struct<weight: double, gained: array<int>, lost: array<int>>>").collect()
    got = sorted(((r["doc_id"], r["y"], r["hits"], [(m["weight"], m["gained"], m["lost"]) for m in r["moves"]]) for r in got), key=lambda r: (r[0], r[2]))
    rows = np.repeat(np.arange(len(got)), [len(h) for _, _, h, _ in got]).astype(np.int64)
    cols = np.array([j for _, _, h, _ in got for j in h], np.int64)
    moves = Swaps.of([(i, *m) for i, (*_, ms) in enumerate(got) for m in ms])
    return train(rows, cols, np.array([y for _, y, _, _ in got], float), names, moves, **options)


MOVES = pa.list_(pa.struct([("weight", pa.float64()), ("gained", pa.list_(pa.int32())), ("lost", pa.list_(pa.int32()))]))


def score(docs: DataFrame, model: Model, *, parts: int = 5, held: int = 0, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(texts(b.column("text"))), pa.float64())], ["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return (
        docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
        .select("doc_id", fold("doc_id", parts, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    )
