"""Packing: concatenate and cut.

Pass one tokenises every document once and writes its ids together with its start inside the partition, so each partition
holds its own prefix sums. The partition totals (one number a partition) are summed on the driver into global offsets.
Pass two cuts every document at the multiples of the window: a document that crosses one leaves a boundary record on each
side. Nothing is shuffled, and only the last sequence is padded.

Cases: a null or empty text is one end id; null ids are packed like others; repeated rows are packed once each; an empty
table gives no rows. Extra columns of the input are ignored. Texts of any length are cut, none is cut short.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import materialise, texts


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as ``tokenizers`` gives them without added special tokens.

    A byte-level file whose merges are numbered like its ids is run by ``tiktoken`` on the same vocabulary (about five
    times as fast, same ids); any other file by ``tokenizers``. Special strings inside a text become their ids, as is
    the library's default."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        model, vocab, letters = spec["model"], spec["model"]["vocab"], byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pre = spec.get("pre_tokenizer") or {}
        same = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not any(model.get(k) for k in ("end_of_word_suffix", "continuing_subword_prefix", "unk_token", "dropout", "ignore_merges", "byte_fallback"))
        same = same and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or not t["special"] for t in spec["added_tokens"])
        self.size = max([*vocab.values(), *self.special.values(), 0]) + 1
        if same:
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        else:
            from tokenizers import Tokenizer

            self.fast, self.slow = None, Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, self.kind)
        if any(s in text for s in self.special):
            return np.array(self.fast.encode(text, allowed_special="all"), self.kind)
        return np.array(self.fast.encode_ordinary(text), self.kind)


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """``name`` is a file of the public tokenizers package or a path of its own."""
    import public_tokenizers

    return Encoder(name if "/" in name else public_tokenizers.path(name), public_tokenizers.PATTERN)


def pack(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (array of int)."""
    kind = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                c = b.slice(lo, 1000)
                starts, sizes, held = [], [], []
                for t in texts(c.column("text")):
                    ids = np.append(enc.ids(t), enc.kind.type(end_id))
                    starts.append(at)
                    sizes.append(len(ids))
                    held.append(ids.tobytes())
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(held), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), c.column("doc_id"), pa.array(held, pa.binary())], ["part", "start", "n", "doc_id", "ids"])

    coded = materialise(docs.select("doc_id", "text").mapInArrow(encode, f"part int, start long, n long, doc_id {kind}, ids binary"), "packing-ids")
    totals = {r["part"]: r["n"] for r in coded.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row a partition
    base, at = {}, 0
    for part in sorted(totals):
        base[part] = at
        at += totals[part]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = encoder(tokenizer).kind
        for b in batches:
            out: list[tuple] = []
            for part, start, n, doc_id, raw in zip(*(b.column(c).to_pylist() for c in ("part", "start", "n", "doc_id", "ids"))):
                ids, at, i = np.frombuffer(raw, size).astype("<u4"), base[part] + start, 0
                while i < n:
                    k = min(n - i, window - (at + i) % window)
                    piece = ids[i : i + k]
                    out.append((doc_id, i, k, zlib.crc32(piece), n, (at + i) // window, (at + i) % window, piece))
                    i += k
                if len(out) >= 2000:
                    yield rows(out, b.schema)
                    out = []
            if out:
                yield rows(out, b.schema)

    def rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        cols = list(zip(*out))
        flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cols[2])]).astype(np.int32)), pa.array(np.concatenate(cols[7]).astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], schema.field("doc_id").type), *(pa.array(c, pa.int64()) for c in cols[1:7]), flat], ["doc_id", *NUMBERS, "ids"])

    return coded.mapInArrow(cut, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in NUMBERS) + ", ids array<int>")


NUMBERS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
