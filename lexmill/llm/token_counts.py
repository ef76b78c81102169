"""Token counts: rank-synchronous array merging.

Pre-tokens of a batch that were not met before are held as one ragged array of symbols. In every round each word's
lowest-rank pair is found with one segmented minimum and all of its occurrences are merged at once, in all words
together; the symbols that survive are the count. A cache of each word's number of tokens (emptied when full) keeps repeated
words out of the arrays.

Cases: a null or empty text has no bytes and no tokens; null ids are counted like others; repeated rows are counted once
each; an empty table gives no rows; special strings inside a text are one token each, as the library does by default.
Extra columns of the input are ignored; texts are counted whole, however long.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import texts
from lexmill.llm.packing import byte_letters

_NONE = np.int64(1) << 62
#: Letters whose lower case the library takes one by one or from a newer Unicode than Python's.
_OWN_LOWER = {0x3A3: 0x3C3, 0xA7CB: 0x264, 0xA7DC: 0x19B}
_SPACES = regex.compile(r"\s+")


class WordBpe:
    """A BPE of the ``tokenizers`` file format over a byte-level alphabet with an end-of-word suffix."""

    def __init__(self, path: str, words_kept: int = 400_000):
        spec = json.load(open(path, encoding="utf-8"))
        model, letters = spec["model"], byte_letters()
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        steps = spec["normalizer"]["normalizers"] if spec.get("normalizer") else []
        self.nfc, self.squeeze, self.lower = (any(s["type"] == t for s in steps) for t in ("NFC", "Replace", "Lowercase"))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.marks = special
        self.first, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for c, b in letters.items():
            self.first[b], self.last[b] = vocab[c], vocab[c + self.suffix]
        self.width = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.kept, self.most = {}, words_kept

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Words of the normalised text and the number of special strings in it."""
        if self.special is not None and any(m in text for m in self.marks):
            parts = self.special.split(text)
            return [w for p in parts for w in self.words.findall(self.normal(p))], len(self.special.findall(text))
        return self.words.findall(self.normal(text)), 0

    def normal(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.squeeze:
            text = _SPACES.sub(" ", text) if not text.isascii() else text
        if not self.lower:
            return text
        return text.lower() if text.isascii() else text.translate(_OWN_LOWER).lower()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def merge(self, words: list[str]) -> np.ndarray:
        """Symbols left of each (non-empty) word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        out = size.copy()
        letters = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size) - 1
        sym = self.first[letters]
        sym[ends] = self.last[letters[ends]]
        word = np.repeat(np.arange(len(raw)), size)
        rank = np.full(len(sym), _NONE)
        if len(sym) > 1:
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self.ranks(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            n = np.diff(np.append(starts, len(sym)))
            out[word[starts]] = n
            live = np.repeat(least < _NONE, n)
            if not live.all():  # finished words leave the arrays
                sym, word, rank = sym[live], word[live], rank[live]
                n, least = n[least < _NONE], least[least < _NONE]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, n)
            at = np.flatnonzero(hit)
            follows = np.concatenate([[False], at[1:] == at[:-1] + 1])
            if follows.any():  # a a a: every second one of a run, from the left
                run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1
            sym, word, rank = sym[keep], word[keep], rank[keep]
            touched = np.unique(np.concatenate([new, new[new > 0] - 1]))
            rank[touched] = _NONE
            touched = touched[touched < len(sym) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self.ranks(sym[touched], sym[touched + 1])
        return out

    def count(self, batch: list[str]) -> list[int]:
        split = [self.pretokens(t) for t in batch]
        if len(self.kept) > self.most:
            self.kept.clear()
        new = list({w for ws, _ in split for w in ws} - self.kept.keys())
        if new:
            self.kept.update(zip(new, self.merge(new).tolist()))
        return [sum(map(self.kept.__getitem__, ws)) + k for ws, k in split]


@lru_cache(maxsize=1)
def word_bpe(name: str) -> WordBpe:
    import public_tokenizers

    return WordBpe(name if "/" in name else public_tokenizers.path(name))


def count_tokens(docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for b in batches:
            t = texts(b.column("text"))
            n = [k for i in range(0, len(t), 256) for k in bpe.count(t[i : i + 256])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x.encode("utf-8", "replace")) for x in t], pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
