"""LM scoring: deleted interpolation of word n-grams.

    p(w | h) = a[k] c(h w) / c(h) + b[k] c(w) / N + d[k] / (V + 1),   k = frequency bucket of the context h

Counts come from all training documents; the weights of each bucket are learned by expectation-maximisation on a slice of
the training documents, scored with the counts of the others (the slice is deleted from them).

Documents are read once into blocks: the block's distinct words (48-bit hashes) and, per document, indexes into them. Each
block sends its distinct words and word pairs, with counts, to the bucket of their hash as delta-coded arrays; a bucket
sums them and returns to every block the totals in the block's own order, so a lookup is an array index and no word or
pair is ever a row. Local counts are summed before they move, so a very frequent word is one entry a block.

Cases: a null or empty text is the end token alone; null ids train and are scored; repeated rows train and are scored
once each; with no training token at all every count is 0 and scores fall back to the uniform part; an empty table gives
no rows. Extra columns are ignored; texts are scored whole. Words and pairs are told apart by 48-bit hashes: a false
match of a pair needs about 1e-7 luck a lookup at 10^7 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import fold, materialise, texts, words_of
from lexmill.llm.ngram_join import WordHashes, mixed

HELD, TRAIN, TUNE = 0, 1, 2
LEVELS = 24
_KEY = np.uint64(16)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0x5EED0FE2D0)  # a word never has this hash but by chance; the end of a text, and the context of its start
_CELLS = 129  # quarter powers of two, the last for zero


def pair_keys(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit keys of (previous word, word) and the previous words; a document starts after an end."""
    before = np.concatenate([[END], words[:-1]]) if len(words) else words
    return mixed(before * _PAIR + words) >> _KEY, before


def pack_sorted(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as 4-byte steps; longer steps stand apart."""
    step = np.diff(keys, prepend=np.uint64(0))
    over = step >= np.uint64(0xFFFFFFFF)
    return np.where(over, np.uint64(0xFFFFFFFF), step).astype("<u4").tobytes(), step[over].astype("<u8").tobytes()


def unpack_sorted(low: bytes, high: bytes) -> np.ndarray:
    step = np.frombuffer(low, "<u4").astype(np.uint64)
    step[step == np.uint64(0xFFFFFFFF)] = np.frombuffer(high, "<u8")
    return np.cumsum(step, dtype=np.uint64)


def pack_counts(n: np.ndarray) -> tuple[bytes, bytes]:
    return np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<u8").tobytes()


def unpack_counts(low: bytes, high: bytes) -> np.ndarray:
    n = np.frombuffer(low, np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(high, "<u8").astype(np.int64)
    return n


def blocks_of(docs: DataFrame, parts: int, held: int, tune_of: int, block_words: int) -> DataFrame:
    """block, role, doc_ids, sizes, vocab (48-bit hashes, frequent first), stream (indexes into vocab)."""
    kind = dict(docs.dtypes)["doc_id"]
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))
    role = F.when(fold("doc_id", parts, held), HELD).when(F.floor(crc / parts) % tune_of == 0, TUNE).otherwise(TRAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        known = WordHashes()
        open_: dict[int, tuple[list, list]] = {r: ([], []) for r in (HELD, TRAIN, TUNE)}
        size = dict.fromkeys(open_, 0)

        def close(r: int, of: pa.DataType) -> pa.RecordBatch:
            ids, held_ = open_[r]
            words = np.concatenate(held_)
            vocab, inv, n = np.unique(words, return_inverse=True, return_counts=True)
            by = np.argsort(-n, kind="stable")
            place = np.empty(len(by), "<u4")
            place[by] = np.arange(len(by))
            sizes = np.fromiter(map(len, held_), "<u4", len(held_))
            out = pa.RecordBatch.from_arrays([pa.array([uuid4().hex]), pa.array([r], pa.int32()), pa.array([ids], pa.list_(of)), pa.array([sizes.tobytes()]), pa.array([vocab[by].astype("<u8").tobytes()]), pa.array([place[inv].tobytes()])], ["block", "role", "doc_ids", "sizes", "vocab", "stream"])
            open_[r], size[r] = ([], []), 0
            return out

        of = None
        for b in batches:
            of = b.column("doc_id").type
            for i, t, r in zip(b.column("doc_id").to_pylist(), texts(b.column("text")), b.column("role").to_pylist()):
                words = words_of(t)
                h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) >> _KEY
                open_[r][0].append(i)
                open_[r][1].append(np.append(h, END))
                size[r] += len(h) + 1
                if size[r] >= block_words:
                    yield close(r, of)
        for r in open_:
            if size[r]:
                yield close(r, of)

    return docs.select("doc_id", "text", role.cast("int").alias("role")).mapInArrow(run, f"block string, role int, doc_ids array<{kind}>, sizes binary, vocab binary, stream binary")


class Block:
    """A block's tokens and its keys in sorted order; ``word_at`` and ``pair_at`` index the keys."""

    def __init__(self, sizes: bytes, vocab: bytes, stream: bytes):
        self.sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        vocab_a, self.tokens = np.frombuffer(vocab, "<u8"), np.frombuffer(stream, "<u4")
        by = np.argsort(vocab_a)
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.words, self.word_at = vocab_a[by], place[self.tokens]
        pairs, self.before = pair_keys(vocab_a[self.tokens], self.sizes)
        self.pairs, self.pair_at = np.unique(pairs, return_inverse=True)
        # the context of the block's first word is an end too, so every context is a word of the block
        self.context_at = np.concatenate([[place[self.tokens[-1]]], self.word_at[:-1]])


def keys_of(blocks: DataFrame, buckets: int) -> DataFrame:
    """gram (0 word, 1 pair), bucket, block, role, keys, counts: what the block sends to each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, role, sizes, vocab, stream in zip(*(b.column(c).to_pylist() for c in ("block", "role", "sizes", "vocab", "stream"))):
                own = Block(sizes, vocab, stream)
                for gram, keys, at in ((0, own.words, own.word_at), (1, own.pairs, own.pair_at)):
                    n = np.bincount(at, minlength=len(keys))
                    bucket = (keys * np.uint64(buckets) >> np.uint64(48)).astype(np.int64) if buckets < 1 << 16 else (keys >> np.uint64(24)).astype(np.int64) * buckets >> 24
                    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                    rows = [(gram, i, block, role, *pack_sorted(keys[s:e]), *pack_counts(n[s:e])) for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])) if e > s]
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2]), pa.array(cols[3], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[4:])], KEYS)

    return blocks.select("block", "role", "sizes", "vocab", "stream").mapInArrow(run, "gram int, bucket int, block string, role int, keys binary, keys_over binary, counts binary, counts_over binary")


KEYS = ["gram", "bucket", "block", "role", "keys", "keys_over", "counts", "counts_over"]
BACK = "block string, gram int, bucket int, role int, n binary, n_over binary, without binary, without_over binary, distinct long, total long"


def totals_of(keys: DataFrame) -> DataFrame:
    """For every (block, gram, bucket): the totals of the block's keys, in their order; for blocks of the tuning slice
    also the totals without that slice. One row of each bucket (block null) has its distinct keys and tokens."""

    def run(table: pa.Table) -> pa.Table:
        gram, bucket = table.column("gram")[0].as_py(), table.column("bucket")[0].as_py()
        blocks, roles = table.column("block").to_pylist(), table.column("role").to_numpy()
        own = [unpack_sorted(a, b) for a, b in zip(table.column("keys").to_pylist(), table.column("keys_over").to_pylist())]
        n = np.concatenate([unpack_counts(a, b) for a, b in zip(table.column("counts").to_pylist(), table.column("counts_over").to_pylist())])
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        role = np.repeat(roles, sizes)
        keys, at = np.unique(np.concatenate(own), return_inverse=True)
        kept = np.bincount(at, np.where(role == TRAIN, n, 0), len(keys)).astype(np.int64)
        full = kept + np.bincount(at, np.where(role == TUNE, n, 0), len(keys)).astype(np.int64)
        seen = full > 0
        out = [(None, gram, bucket, 0, b"", b"", None, None, int(seen.sum()), int(full.sum())), (None, gram, bucket, TUNE, b"", b"", None, None, int((kept > 0).sum()), int(kept.sum()))]
        ends = np.cumsum(sizes)
        for block, r, s, e in zip(blocks, roles.tolist(), ends - sizes, ends):
            out.append((block, gram, bucket, r, *pack_counts(full[at[s:e]]), *(pack_counts(kept[at[s:e]]) if r == TUNE else (None, None)), 0, 0))
        cols = list(zip(*out))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in BACK.split(", ")])

    return keys.groupBy("gram", "bucket").applyInArrow(run, BACK)


def counts_back(own: Block, back: pa.Table, low: str) -> tuple[np.ndarray, np.ndarray]:
    """The block's words' and pairs' counts: its buckets' arrays one after another."""
    out = []
    for gram in (0, 1):
        rows = sorted((b, n, o) for g, b, n, o in zip(*(back.column(c).to_pylist() for c in ("gram", "bucket", low, f"{low}_over"))) if g == gram)
        out.append(np.concatenate([unpack_counts(n, o) for _, n, o in rows]))
    return out[0], out[1]


def level(context: np.ndarray) -> np.ndarray:
    """The frequency bucket of a context: 0 unseen, then by powers of two."""
    return np.minimum(np.ceil(np.log2(context + 1.0)), LEVELS - 1).astype(np.int64)


def estimates(own: Block, words: np.ndarray, pairs: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level of the context, pair and word estimates of every token."""
    context = words[own.context_at]
    return level(context), pairs[own.pair_at] / np.maximum(context, 1), words[own.word_at] / max(total, 1)


def cells(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.minimum(np.round(-4 * np.log2(np.maximum(p, 1e-300))), _CELLS - 2), _CELLS - 1).astype(np.int64)


def learn_weights(got: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Mixture weights (levels x 3) by expectation-maximisation on rows (level, pair cell, word cell, tokens).

    Levels without data use the weights of all levels together; an unseen context has no pair estimate."""
    value = np.append(2.0 ** (-np.arange(_CELLS - 1) / 4), 0.0)

    def climb(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        p = np.stack([value[rows[:, 1]], value[rows[:, 2]], np.full(len(rows), uniform)], 1)
        n, w = rows[:, 3].astype(float), start
        for _ in range(rounds if len(rows) else 0):
            part = p * w
            w = (part / part.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
            w = np.maximum(w, 1e-6)
            w = w / w.sum()
        return w

    base = climb(got, np.array([0.3, 0.6, 0.1]))
    out = np.stack([climb(got[got[:, 0] == k], base) for k in range(LEVELS)])
    out[0] = [0.0, *(out[0, 1:] / out[0, 1:].sum())]
    return out


def score(docs: DataFrame, *, parts: int = 5, held: int = 1, tune_of: int = 8, block_words: int = 1_500_000, bucket_keys: int = 3_000_000) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    kind = dict(docs.dtypes)["doc_id"]
    blocks = materialise(blocks_of(docs, parts, held, tune_of, block_words), "lm-blocks")
    tokens = blocks.agg(F.coalesce(F.sum(F.octet_length("stream") / 4), F.lit(0)).alias("n")).first()["n"]
    buckets = int(min(1 << 24, max(6, tokens / bucket_keys)))
    back = materialise(totals_of(keys_of(blocks, buckets)), "lm-totals")
    sums = {(r["gram"], r["role"]): (r["d"] or 0, r["t"] or 0) for r in back.where("block is null").groupBy("gram", "role").agg(F.sum("distinct").alias("d"), F.sum("total").alias("t")).collect()}
    vocab, total = sums.get((0, 0), (0, 0))
    _, kept_total = sums.get((0, TUNE), (0, 0))
    uniform = 1.0 / (vocab + 1)
    columns = ["block", "sizes", "vocab", "stream"]

    def tally(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = np.zeros((0, 4), np.int64)
        for _, sizes, vocab_, stream in zip(*(left.column(c).to_pylist() for c in columns)):
            own = Block(sizes, vocab_, stream)
            k, p2, p1 = estimates(own, *counts_back(own, right, "without"), kept_total)
            cell, n = np.unique((k * _CELLS + cells(p2)) * _CELLS + cells(p1), return_counts=True)
            rows = np.stack([cell // _CELLS**2, cell // _CELLS % _CELLS, cell % _CELLS, n], 1)
        return pa.table({c: pa.array(rows[:, i], pa.int64()) for i, c in enumerate(("level", "pair", "word", "n"))})

    by_block = back.where("block is not null")
    tuned = blocks.where(F.col("role") == TUNE).select(*columns).groupBy("block").cogroup(by_block.where(F.col("role") == TUNE).groupBy("block")).applyInArrow(tally, "level long, pair long, word long, n long")
    got = tuned.groupBy("level", "pair", "word").agg(F.sum("n").alias("n")).toPandas()  # LEVELS * 129 * 129 rows at most
    weights = learn_weights(got.sort_values(["level", "pair", "word"]).to_numpy(np.int64).reshape(-1, 4), uniform)

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for ids, role, sizes, vocab_, stream in zip(*(left.column(c).to_pylist() for c in ("doc_ids", "role", *columns[1:]))):
            own = Block(sizes, vocab_, stream)
            words, pairs = counts_back(own, right, "n")
            k, p2, p1 = estimates(own, words, pairs, total)
            w = weights[k]
            p = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * uniform)
            c = words[own.word_at]
            base = np.log10((c + 0.5) / (total + 0.5 * (vocab + 1)))
            first = np.cumsum(own.sizes) - own.sizes
            out.append(pa.table([
                pa.array(ids, left.schema.field("doc_ids").type.value_type), pa.array([role == HELD] * len(ids)), pa.array(own.sizes), pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), pa.array(np.full(len(ids), total, np.int64)),
                pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(p, first)),
            ], names=RESULT))
        return pa.concat_tables(out)

    return blocks.groupBy("block").cogroup(by_block.groupBy("block")).applyInArrow(mark, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


RESULT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
