"""Language identification by multilingual mixture inference.

Each language is a smoothed distribution over hashed character n-grams (1 to 3). A document's n-grams are taken as drawn
from a mixture of the languages; expectation-maximisation estimates the proportions, and languages are dropped one by one
while the penalised likelihood does not fall. The language with the largest proportion is the prediction, its proportion
the score.

Cases: a null text, or one without a letter, is ``und`` with score 0; with no learned language at all every document is
``und``; null ids and repeated rows are predicted once each; an empty table gives no rows; documents whose lang is null
teach nothing. Extra columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import fold, texts

BITS = 14
SIZE = 1 << BITS
_ASCII_LETTER = re.compile("[A-Za-z]")
_M1, _M2, _M3 = np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of the lower-cased text; runs of other than letters count as one blank."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    other = (code < 65) | ((code > 90) & (code < 97)) | ((code > 122) & (code < 170))
    c = np.where(other, np.uint32(32), code)
    c = np.concatenate([np.full(1, 32, np.uint32), c[~(other & np.concatenate([np.zeros(1, bool), other[:-1]]))], np.full(1, 32, np.uint32)])
    h1 = c * _M1
    h2 = h1[1:] ^ (c[:-1] * _M2)
    h3 = h2[1:] ^ (c[:-2] * _M3)
    down = np.uint32(32 - BITS)
    return np.bincount(np.concatenate([(h1 * _M2) >> down, (h2 * _M3) >> down, (h3 * _M1) >> down]), minlength=SIZE)


@dataclass
class Languages:
    names: list[str]
    prob: np.ndarray  # n-gram bins x languages

    def mixture(self, text: str, *, rounds: int = 8, penalty: float = 0.01, floor: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and the chosen languages. Dropping a language must cost less than ``penalty`` nats an n-gram."""
        count = grams(text)
        at = np.flatnonzero(count)
        c, p = count[at].astype(float), self.prob[at]
        n, k = c.sum(), len(self.names)
        share = np.full(k, 1.0 / k)

        def climb(share: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, float]:
            q = p[:, keep]
            s = share[keep] / share[keep].sum()
            for _ in range(rounds if len(keep) > 1 else 0):
                mix = q @ s
                s = s * ((c / mix) @ q) / n
            out = np.zeros(k)
            out[keep] = s
            return out, float(c @ np.log(q @ s)) / n

        keep = np.arange(k)
        share, fit = climb(share, keep)
        while len(keep) > 1:
            last = keep[share[keep].argmin()]
            rest = keep[keep != last]
            trial, without = climb(share, rest) if share[rest].sum() > 0 else (share, -np.inf)
            if share[last] >= floor and fit - without > penalty:
                break
            keep, share, fit = rest, trial, without
        return share, keep

    def predict(self, text: str) -> tuple[str, float]:
        if not text or not self.names or not has_letter(text):
            return "und", 0.0
        share, _ = self.mixture(text)
        best = int(share.argmax())
        return self.names[best], float(min(1.0, share[best]))


def fit(docs: DataFrame, *, parts: int = 4, held: int = 2, per_language: int = 3000, smooth: float = 0.5) -> Languages:
    """Learn from about ``per_language`` documents of each language (drawn by a hash of the id), the held-out fold left
    out. N-gram counts are summed by Spark; languages times bins numbers reach the driver."""
    seen = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~fold("doc_id", parts, held)).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in seen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Languages([], np.zeros((SIZE, 0)))
    draw = F.lit(False)
    for name in names:
        draw = draw | ((F.col("lang") == name) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, per_language / sizes[name]) * (1 << 20))))
    at = {name: j for j, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), SIZE), np.int64)
        for b in batches:
            for t, lang in zip(texts(b.column("text")), b.column("lang").to_pylist()):
                if t:
                    total[at[lang]] += grams(t)
        j, g = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(g.astype(np.int32)), pa.array(total[j, g])], ["lang_no", "gram", "n"])

    got = seen.where(draw).select("text", "lang").mapInArrow(count, "lang_no int, gram int, n long").groupBy("lang_no", "gram").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((SIZE, len(names)), smooth)
    np.add.at(total, (got["gram"].to_numpy(np.int64), got["lang_no"].to_numpy(np.int64)), got["n"].to_numpy(float))
    return Languages(names, total / total.sum(axis=0))


def identify(docs: DataFrame, model: Languages, *, parts: int = 4, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select("doc_id", fold("doc_id", parts, held).alias("held_out"), "lang_pred", "score")
