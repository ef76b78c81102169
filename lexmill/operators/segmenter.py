"""Dictionary word segmentation for Chinese.

Words come from a frequency dictionary passed as data; a line is cut along the path of largest probability, and
characters outside the dictionary stand alone. Without a dictionary every character stands alone. Runs of ASCII stay whole.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.chars import CHINESE
from lexmill.functions.regex import strip
from lexmill.operators.lines import Line, rule

_RUNS = regex.compile(rf"[{CHINESE}]+|[A-Za-z0-9]+(?:\.[0-9]+)?|\s+|.")


class Segmenter:
    def __init__(self, freq: Mapping[str, int] | None = None):
        self.freq = dict(freq or {})
        self.longest = max(map(len, self.freq), default=1)
        self.total = math.log(sum(self.freq.values()) or 1)

    def cut(self, text: str) -> list[str]:
        """White space tokens are kept, as blanks of their own."""
        return [w for run in _RUNS.findall(text) for w in (self._path(run) if "一" <= run[0] <= "龥" else [run])]

    def _path(self, run: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, len(run))] * (len(run) + 1)
        for i in range(len(run) - 1, -1, -1):
            ends = range(i + 1, min(len(run), i + self.longest) + 1)
            best[i] = max((math.log(self.freq.get(run[i:j], 1 if j == i + 1 else 0) or 1e-30) - self.total + best[j][0], j) for j in ends if j == i + 1 or run[i:j] in self.freq)
        out, i = [], 0
        while i < len(run):
            out.append(run[i : best[i][1]])
            i = best[i][1]
        return out


def _vectorised(freq: Mapping[str, int] | None, one) -> Line:
    seg = Segmenter(freq)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda t: one(seg, t) if t else None, na_action=None)

    return run


@rule("common", "Segment_Jieba")
def segment(dictionary: Mapping[str, int] | None = None) -> Line:
    return _vectorised(dictionary, lambda seg, t: " ".join(seg.cut(t.strip())))


def _chinese_only(seg: Segmenter, text: str) -> str:
    parts = regex.split(r"([!-~]+)", text.strip())
    return " ".join(" ".join(p if i % 2 else " ".join(seg.cut(p)) for i, p in enumerate(parts)).split())


@rule("zh", "Seg_Chinese_Only_In_Sentence")
def segment_chinese_only(dictionary: Mapping[str, int] | None = None) -> Line:
    """ASCII runs stay as they are."""
    return _vectorised(dictionary, _chinese_only)


rule("zh", "Seg_Chinese_Only")(segment_chinese_only)

# Marks that segmentation takes apart.
_MARKS = [("< s >", "<s>"), ("< url >", "<URL>"), ("_ unk", "_unk"), ("_ pad", "_pad")]


@rule("zh", "Segment_Jieba_Then_Char")
def segment_then_characters(dictionary: Mapping[str, int] | None = None) -> Line:
    """Segmented, lower-cased, then words that start with a Chinese character as single characters."""
    words = segment(dictionary)

    def run(c: Column) -> Column:
        x = F.lower(F.trim(F.regexp_replace(words(c), " +", " ")))
        for old, new in _MARKS:
            x = F.replace(x, F.lit(old), F.lit(new))
        apart = lambda w: F.when(w.rlike(f"^[{CHINESE}]"), F.filter(F.split(w, ""), lambda k: k != "")).otherwise(F.array(w))
        return F.array_join(F.flatten(F.transform(F.filter(F.split(strip(x), " "), lambda w: w != ""), apart)), " ")

    return run
