"""N-gram Jaccard join with set-relation skipping.

A document is its set of word shingles, a node is a distinct set (equal sets are one node, so copies cost nothing).

1. Shingles common in a bounded sample are ordered last, the others by their hash. Any order gives exact results; this
   one keeps common passages out of the prefixes.
2. Two sets that link share a shingle in their prefixes. Prefixes are dealt by shingle as packed arrays, the list of a
   very common shingle in parts. An index list is a run of one array by set size and position: an entry's own position
   bounds the sizes it can link with, and of each block of one size only the entries up to a largest position are looked
   at (``block_skip``). Lists longer than ``all_pairs`` give only each entry's neighbour and its leader, the entry of its
   size band with the smallest position.
3. A parity bitmap of each set bounds the overlap of a pair from above; pairs under the bound go.
4. Every node is verified against its leader or one candidate, then, a few times, against one or two more of other
   groups. Verified pairs form groups of highly similar sets with known overlaps.
5. Pairs inside a group need no more work. Long lists are read again, once, where they still hold several groups: a
   list's largest group only meets the rest, and block-skip leaves few of those pairs. For a pair (a, b) across groups, b
   is verified against a's partner p, and from |p & b|, |a & p| and the sizes both bounds of |a & b| follow; only pairs
   that the bounds leave open are verified.
6. Components of all links. Tables of ids are written by a task for each 50 000 rows, or one a core, and not by one a
   shuffle partition: a session with many partitions would else write thousands of files of a few rows.

Cases: without a word a document has size 0 and is its own component; with fewer words than a shingle the whole sequence
is one shingle; null ids get a size and a null component; repeated rows are returned once each; an empty table gives no
rows. Extra columns are ignored. Shingles and sets are compared by 64-bit hashes (48 bits in verification), which
may err with a probability of about 1e-9 for each pair of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import blobs, discard, few, materialise, slices, texts, words_of
from lexmill.llm.components import components

_ODD = np.array([(i * 2 + 3) * 0x9E3779B97F4A7C15 % (1 << 64) | 1 for i in range(64)], np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW48 = np.uint64((1 << 48) - 1)


class WordHashes(dict):
    """word -> 64-bit hash; a cache that is emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 60_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str, k: int, known: dict) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(h) - k + 1
    if n < 1:
        return mixed(np.array([int((h * _ODD[: len(h)]).sum()) + len(h) & (1 << 64) - 1], np.uint64))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += h[i : i + n] * _ODD[i]
    return np.unique(mixed(out))


def node_of(s: np.ndarray) -> int:
    """The id of a set: a hash of its elements, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection with which sets of these sizes link: 100 i >= percent (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


class Common:
    """Shingles that are ordered last, rarer ones first; and in how many parts each one's list is dealt."""

    def __init__(self, keys: np.ndarray, count: np.ndarray, per_part: float = math.inf):
        by = np.lexsort((keys, count))
        rank = np.empty(len(keys), np.int64)
        rank[by] = np.arange(len(keys))
        order = np.argsort(keys)
        self.keys, self.rank, self.parts = keys[order], rank[order], np.ceil(count[order] / per_part).astype(np.int64)

    def parts_of(self, s: np.ndarray) -> np.ndarray:
        if not len(self.keys) or self.parts.max() < 2:
            return np.ones(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        return np.where(self.keys[at] == s, np.maximum(self.parts[at], 1), 1)

    def prefix(self, s: np.ndarray, p: int) -> np.ndarray:
        if not len(self.keys):
            return s[:p]
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        late = self.keys[at] == s
        first = s[~late]
        if len(first) >= p:
            return first[:p]
        rest = at[late]
        return np.concatenate([first, self.keys[rest[np.argsort(self.rank[rest])]]])[:p]


def parity(s: np.ndarray) -> bytes:
    """A bitmap as wide as the set (a power of two, 64 bits to 64 kbit) of how often each cell is hit, modulo 2."""
    bits = 1 << min(16, max(6, int(len(s)).bit_length()))
    cell = (s >> np.uint64(48)).astype(np.int64) % bits
    return np.packbits(np.bincount(cell, minlength=bits) % 2 == 1, bitorder="little").tobytes()


def parity_bound(a: bytes, b: bytes, size_a: int, size_b: int) -> int:
    """An upper bound of the intersection: every differing cell is an element of one set alone."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, n), axis=0) for z in (x, y))
    return (size_a + size_b - int(np.bitwise_count(x ^ y).sum())) // 2


def common_shingles(docs: DataFrame, k: int, rows: int, sample: int, least: int, part_rows: int) -> Common:
    """Shingles of at least ``least`` different sets among about ``sample`` documents drawn by a hash of the id. A list
    expected to exceed ``part_rows`` entries is dealt in parts."""
    share = min(1.0, sample / max(rows, 1))
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(1 << 30)) < int(share * (1 << 30))).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, held = WordHashes(), set(), []
        for b in batches:
            for t in (t for c in slices(b) for t in texts(c.column("text"))):
                s = shingles(t, k, known)
                if len(s) and (me := node_of(s)) not in seen:
                    seen.add(me)
                    held.append(s)
            if sum(map(len, held)) > 250_000:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

    got = drawn.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    return Common(got["key"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64), part_rows * share)


def postings(docs: DataFrame, common, k: int, percent: int, buckets: int, flush: int = 300_000) -> DataFrame:
    """Packed prefixes by bucket of shingle: shingle, document of the row (its node, size and first shingle), position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, order, seen = WordHashes(), common.value, set()
        held: list[np.ndarray] = []
        nodes: list[int] = []
        sizes: list[int] = []
        total = 0
        for b in batches:
            for t in (t for c in slices(b) for t in texts(c.column("text"))):
                s = shingles(t, k, known)
                if not len(s) or (me := node_of(s)) in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(me)
                p = order.prefix(s, len(s) - int(-(-percent * len(s) // 100)) + 1)
                held.append(p)
                nodes.append(me)
                sizes.append(len(s))
                total += len(p)
                if total > flush or len(nodes) >= 60_000:
                    yield packed(held, nodes, sizes)
                    held, nodes, sizes, total = [], [], [], 0
        if held:
            yield packed(held, nodes, sizes)

    def packed(held: list[np.ndarray], nodes: list[int], sizes: list[int]) -> pa.RecordBatch:
        n = np.fromiter(map(len, held), np.int64, len(held))
        sh = np.concatenate(held)
        doc = np.repeat(np.arange(len(held)), n)
        at = np.minimum(np.arange(len(sh)) - np.repeat(np.cumsum(n) - n, n), 65_535)
        part = np.array(nodes, np.int64)[doc] % common.value.parts_of(sh)
        bucket = (((sh * _MIX) >> np.uint64(33)).astype(np.int64) + part * 40_503) % buckets
        by = np.lexsort((sh, bucket))
        cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
        node_a, size_a, first_a = np.array(nodes, np.int64), np.array(sizes, np.uint32), np.array([p[0] for p in held], np.uint64)
        cols: list[list] = [[] for _ in range(7)]
        for i in range(buckets):
            own = by[cuts[i] : cuts[i + 1]]
            if len(own):
                which, inv = np.unique(doc[own], return_inverse=True)
                for c, v in zip(cols, (i, sh[own].tobytes(), inv.astype(np.uint16).tobytes(), at[own].astype(np.uint16).tobytes(), node_a[which].tobytes(), size_a[which].tobytes(), first_a[which].tobytes())):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["bucket", *PACKED])

    return docs.select("text").mapInArrow(run, "bucket int, " + ", ".join(f"{c} binary" for c in PACKED))


PACKED = ["sh", "doc", "at", "nodes", "sizes", "firsts"]


def read_lists(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Shingle, node, size, position, first shingle of a bucket's entries, by shingle, size and position; each node once in
    a list."""
    sh, node, size, at, first = [], [], [], [], []
    for s, d, a, n, z, f in zip(*(blobs(table.column(c).combine_chunks()) for c in PACKED)):
        doc = np.frombuffer(d, np.uint16)
        sh.append(np.frombuffer(s, np.uint64))
        node.append(np.frombuffer(n, np.int64)[doc])
        size.append(np.frombuffer(z, np.uint32)[doc].astype(np.int64))
        at.append(np.frombuffer(a, np.uint16).astype(np.int64))
        first.append(np.frombuffer(f, np.uint64)[doc])
    sh, node, size, at, first = (np.concatenate(x) for x in (sh, node, size, at, first))
    order = np.argsort(sh, kind="stable")
    sh = sh[order]
    twice = np.concatenate([[False], sh[1:] == sh[:-1]])
    some = twice | np.concatenate([twice[1:], [False]])  # lists of one entry go at once
    order, sh = order[some], sh[some]
    by = np.lexsort((node[order], at[order], size[order], sh))
    order, sh = order[by], sh[by]
    node, size, at, first = node[order], size[order], at[order], first[order]
    new = runs_of(sh, node)  # the same set has the same size and position
    return sh[new], node[new], size[new], at[new], first[new]


def runs_of(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))


def expanded(lo: np.ndarray, n: np.ndarray, at_once: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, lo[i] + 0 .. n[i] - 1) for every i, in parts of about ``at_once``."""
    ends = np.cumsum(n)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + at_once, "right")))
        m = n[i:j]
        who = np.repeat(np.arange(i, j), m)
        yield who, np.repeat(lo[i:j] - np.cumsum(m) + m, m) + np.arange(len(who))
        i = j


def block_skip(run_a: np.ndarray, size_a: np.ndarray, at_a: np.ndarray, run_b: np.ndarray, size_b: np.ndarray, at_b: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) of entries of one list that may link by their sizes and positions.

    b stands by list, size and position, so a list is a row of blocks of one size. An entry's own position bounds the
    sizes it can link with, which leaves a range of blocks; in each block the entries are taken up to the largest position
    that leaves enough shingles, and the rest of the block is never looked at. The work is a step for each entry and block
    in range, and one for each pair given."""
    if not len(run_a) or not len(run_b):
        return
    start = runs_of(run_b, size_b)
    block = run_b[start] << 32 | size_b[start]
    place = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(run_b)))) << 17 | at_b
    least = -(-percent * size_a // 100)
    most = (100 + percent) * (size_a - at_a) // percent - size_a
    lo = np.searchsorted(block, run_a << 32 | least)
    hi = np.searchsorted(block, run_a << 32 | np.maximum(most, 0), "right")
    for who, blk in expanded(lo, np.maximum(hi - lo, 0)):
        z = size_b[start[blk]]
        last = z - needed(size_a[who], z, percent)
        n = np.searchsorted(place, blk << 17 | np.clip(last, 0, (1 << 17) - 1), "right") - start[blk]
        n[last < 0] = 0
        for i, j in expanded(start[blk], n):
            yield who[i], j


class Pairs:
    """Collects pairs of nodes, the smaller id first, each once."""

    def __init__(self, at_once: int = 2_000_000):
        self.parts: list[np.ndarray] = []
        self.waiting, self.at_once = 0, at_once

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.parts.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        self.waiting += len(a)
        if self.waiting > self.at_once:
            self.fold_up()

    def fold_up(self) -> np.ndarray:
        both = np.concatenate([np.zeros((2, 0), np.int64), *self.parts], axis=1)
        both = both[:, np.lexsort(both)]
        both = both[:, runs_of(*both)]
        self.parts, self.waiting = [both], 0
        return both


def list_pairs(run: np.ndarray, node: np.ndarray, size: np.ndarray, at: np.ndarray, first: np.ndarray, own: np.ndarray, percent: int, out: Pairs) -> None:
    """All pairs of the lists ``run`` that block-skip leaves. A pair whose sets start with the same shingle is left to the
    list of that shingle, which is certain to hold both (``own``: this is the list of the entry's first shingle)."""
    for i, j in block_skip(run, size, at, run, size, at, percent):
        ok = (i < j) & ((first[i] != first[j]) | (own[i] & own[j]))
        out.add(node[i[ok]], node[j[ok]])


def leaders(run: np.ndarray, node: np.ndarray, size: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the index of the leader of its list and size band, and whether the two may link. The leader has
    the smallest position: few shingles of its own, so it stands in the middle of a group of similar sets."""
    band = np.floor(np.log(size) / np.log(100 / percent)).astype(np.int64)
    by = np.lexsort((node, at, band, run))
    start = runs_of(run[by], band[by])
    lead = np.empty(len(run), np.int64)
    lead[by] = np.repeat(by[start], np.diff(np.append(start, len(run))))
    return lead, (np.minimum(size - at, size[lead] - at[lead]) >= needed(size, size[lead], percent)) & (node != node[lead])


def across_labels(run: np.ndarray, node: np.ndarray, size: np.ndarray, at: np.ndarray, first: np.ndarray, own: np.ndarray, label: np.ndarray, major: np.ndarray, both: np.ndarray, percent: int, out: Pairs) -> None:
    """Pairs of different labels in the lists ``run`` (by run, size, position) that block-skip leaves. The entries of a
    list's commonest label only meet the others, and so on with the rest until no label holds an eighth of it: pairs
    inside a group are not formed. ``major``: entries of the commonest label; ``both``: lists whose other entries also
    meet each other here."""

    def meet(i: np.ndarray, j: np.ndarray, once: bool) -> None:
        for u, v in block_skip(run[i], size[i], at[i], run[j], size[j], at[j], percent):
            u, v = i[u], j[v]
            ok = (label[u] != label[v]) & ((first[u] != first[v]) | (own[u] & own[v]))
            ok &= (u < v) | (not once)
            out.add(node[u[ok]], node[v[ok]])

    meet(np.flatnonzero(~major), np.flatnonzero(major), False)
    rest = np.flatnonzero(~major & both)
    while len(rest):
        by = np.lexsort((label[rest], run[rest]))
        start = runs_of(run[rest][by], label[rest][by])
        n = np.diff(np.append(start, len(rest)))
        of = run[rest][by][start]
        top = np.lexsort((-n, of))
        top = top[runs_of(of[top])]  # the commonest label of each list
        total = np.add.reduceat(n, runs_of(of))
        large = top[(n[top] > 1) & (8 * n[top] > total)]
        if not len(large):
            break
        taken = np.zeros(len(rest), bool)
        taken[by[next_of(start[large], n[large])]] = True
        meet(rest[~taken], rest[taken], False)
        rest = rest[~taken]
    meet(rest, rest, True)


def next_of(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(j for _, j in expanded(lo, n))])


CANDIDATES = "kind int, x long, y long, size int, at int, first long, own boolean"


def candidates(post: DataFrame, common, percent: int, all_pairs: int) -> DataFrame:
    """kind 0: x, y are the nodes of a candidate pair, the smaller first. kind 1: an entry of a long list; x names the
    list, y is the node. kind 2: x is the leader of y in a long list, ``at`` its position. kind 3: y leads a part of the
    list x, which is dealt in parts."""

    def run(table: pa.Table) -> pa.Table:
        sh, node, size, at, first = read_lists(table)
        own = sh == first
        start = runs_of(sh)
        n = np.diff(np.append(start, len(sh)))
        dealt = common.value.parts_of(sh[start]) > 1 if len(sh) else np.zeros(0, bool)
        long = np.repeat((n > all_pairs) | dealt, n)
        run_no, dealt = np.repeat(np.arange(len(n)), n), np.repeat(dealt, n)
        pairs = Pairs()
        s, l = np.flatnonzero(~long), np.flatnonzero(long)
        list_pairs(run_no[s], node[s], size[s], at[s], first[s], own[s], percent, pairs)
        sh, node, size, at, first, own, run_no, dealt = (x[l] for x in (sh, node, size, at, first, own, run_no, dealt))
        near = (run_no[1:] == run_no[:-1]) & (np.minimum(size[1:] - at[1:], size[:-1] - at[:-1]) >= needed(size[1:], size[:-1], percent))
        pairs.add(node[:-1][near], node[1:][near])
        lead, ok = leaders(run_no, node, size, at, percent)
        a, b = pairs.fold_up()
        led = np.stack([node[lead[ok]], node[ok], at[lead[ok]]])
        led = led[:, np.lexsort(led)]
        led = led[:, runs_of(*led)]
        heads = np.flatnonzero(dealt & (lead == np.arange(len(lead))))
        zero = lambda n: np.zeros(n, np.int64)
        rows = [(a, b, zero(len(a)), zero(len(a)), zero(len(a)), zero(len(a))), (sh.view(np.int64), node, size, at, first.view(np.int64), own), (*led[:2], zero(len(led[0])), led[2], zero(len(led[0])), zero(len(led[0]))), (sh.view(np.int64)[heads], node[heads], size[heads], at[heads], zero(len(heads)), zero(len(heads)))]
        kind = np.repeat(np.arange(4), [len(r[0]) for r in rows])
        x, y, size, at, first, own = (np.concatenate(c) for c in zip(*rows))
        return pa.table({"kind": pa.array(kind.astype(np.int32)), "x": pa.array(x), "y": pa.array(y), "size": pa.array(size.astype(np.int32)), "at": pa.array(at.astype(np.int32)), "first": pa.array(first), "own": pa.array(own.astype(bool))})

    return post.groupBy("bucket").applyInArrow(run, CANDIDATES)


def nodes(docs: DataFrame, k: int, wanted, bits: int) -> DataFrame:
    """doc_id, size, node, parity; and the set itself (6 bytes an element) where the filter of wanted nodes has the node."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, filt, seen = WordHashes(), wanted.value, set()
        for b in batches:
            for c in slices(b):
                out: list[list] = [[], [], [], []]
                for t in texts(c.column("text")):
                    s = shingles(t, k, known)
                    me = node_of(s) if len(s) else None
                    cell = me & ((1 << bits) - 1) if len(s) else 0
                    take = len(s) and me not in seen and filt[cell >> 6] >> np.uint64(cell & 63) & np.uint64(1)
                    if take:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(me)
                    for o, v in zip(out, (len(s), me, parity(s) if take else None, (s & _LOW48).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() if take else None)):
                        o.append(v)
                yield pa.RecordBatch.from_arrays([c.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], ["doc_id", "size", "node", "parity", "items"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, size long, node long, parity binary, items binary")


def wanted_filter(cands: DataFrame) -> tuple[np.ndarray, int]:
    """A bit filter of all nodes in pairs or long lists; at most 2**26 bits (8 MB) whatever the input. False hits only
    carry a set along in vain."""
    ids = cands.where("kind = 0").select(F.col("x").alias("node")).unionByName(cands.select(F.col("y").alias("node")))
    n = ids.agg(F.approx_count_distinct("node").alias("n")).first()["n"]
    bits = min(26, max(16, int(16 * n).bit_length()))
    cell = F.col("node").bitwiseAND(F.lit((1 << bits) - 1))
    rows = ids.groupBy(F.shiftright(cell, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((node & {(1 << bits) - 1}) & 63 as int))")).alias("v")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
    return out, bits


def bounded_pairs(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """(a, b) whose parity bitmaps allow a link."""
    side = table.where(F.col("parity").isNotNull()).select("node", "size", "parity").dropDuplicates(["node"])
    both = pairs.join(side.toDF("a", "size_a", "parity_a"), "a").join(side.toDF("b", "size_b", "parity_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            sa, sb = r.column("size_a").to_numpy(), r.column("size_b").to_numpy()
            top = np.fromiter(map(parity_bound, r.column("parity_a").to_pylist(), r.column("parity_b").to_pylist(), sa.tolist(), sb.tolist()), np.int64, r.num_rows)
            yield r.select(["a", "b"]).filter(pa.array(top >= needed(sa, sb, percent)))

    return both.mapInArrow(run, "a long, b long")


def overlaps(pairs: DataFrame, table: DataFrame, small: int = 300_000) -> DataFrame:
    """(a, b, size_a, size_b, both) with the exact intersections; each set is sent once for a and once for each pair."""
    ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = table.where(F.col("items").isNotNull()).select("node", "items")
    few = ids.count() <= small  # 8 bytes each
    sets = sets.join(F.broadcast(ids) if few else ids, "node", "left_semi").dropDuplicates(["node"])  # several tasks may have met a set first
    both = pairs.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            out = []
            last: tuple = (None, None)
            for a, x, y in zip(r.column("a").to_pylist(), blobs(r.column("items_a")), blobs(r.column("items_b"))):
                u = last[1] if last[0] == a else unpacked(x)
                last, v = (a, u), unpacked(y)
                out.append((len(u), len(v), len(u) + len(v) - len(np.unique(np.concatenate([u, v])))))
            s = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([r.column("a"), r.column("b"), *(pa.array(s[:, i]) for i in range(3))], ["a", "b", "size_a", "size_b", "both"])

    return both.mapInArrow(run, "a long, b long, size_a long, size_b long, both long")


def unpacked(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def links_of(over: DataFrame, percent: int) -> DataFrame:
    return over.where(F.col("both") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("both")) * percent)


def dealt(runs: DataFrame, part_rows: int) -> DataFrame:
    """The entries (sh, b, size, at, first, own, label) of lists that hold several labels, dealt in cells that one task
    can hold: the commonest label's entries (``major``) in parts, each part with all others of its list, and the others,
    where they are too many, in parts of which every two meet in a cell. An entry is repeated only as often as its list
    has parts of ``part_rows``. ``both``: the others of the cell also meet each other."""
    by = runs.groupBy("sh", "label").agg(F.count("*").alias("n")).groupBy("sh").agg(F.max_by("label", F.struct("n", "label")).alias("common"), F.sum("n").alias("n"), F.max("n").alias("most"))
    by = by.where("most < n").select("sh", "common", F.ceil(F.col("most") / part_rows).alias("majors"), F.ceil((F.col("n") - F.col("most")) / part_rows).alias("rests"))
    both = runs.join(by, "sh").withColumn("major", F.col("label") == F.col("common"))
    one = F.col("majors") + F.col("rests") == 2
    mine = F.pmod(F.xxhash64("b"), F.col("rests"))
    cell = lambda i, own: F.struct(i.cast("long").alias("cell"), own.alias("both"))
    with_majors = F.transform(F.sequence(F.lit(0).cast("long"), F.col("majors") - 1), lambda g: cell(g, one))
    among = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rests") - 1), lambda j: cell(-1 - F.least(mine, j) * F.col("rests") - F.greatest(mine, j), F.lit(True)))
    cells = F.when(F.col("major"), F.array(cell(F.pmod(F.xxhash64("b"), F.col("majors")), one))).when(one, with_majors).otherwise(F.concat(with_majors, among))
    return both.select("sh", "b", "size", "at", "first", "own", "label", "major", F.explode(cells).alias("c")).select("*", "c.cell", "c.both").drop("c")


def pairs_across(runs: DataFrame, percent: int, part_rows: int, rows: int) -> DataFrame:
    """(a, b): pairs of different labels that long lists hold."""

    def run(t: pa.Table) -> pa.Table:
        sh, cell, node, size, at, first, label = (t.column(c).to_numpy().astype(np.int64) for c in ("sh", "cell", "b", "size", "at", "first", "label"))
        by = np.lexsort((node, at, size, cell, sh))
        sh, cell, node, size, at, first, label = (x[by] for x in (sh, cell, node, size, at, first, label))
        own, major, both = (t.column(c).to_numpy(zero_copy_only=False).astype(bool)[by] for c in ("own", "major", "both"))
        start = runs_of(sh, cell)
        no = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(sh))))
        out = Pairs()
        across_labels(no, node, size, at, first, own, label, major, both, percent, out)
        a, b = out.fold_up()
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    buckets = max(64, rows // part_rows)
    return dealt(runs, part_rows).withColumn("bucket", F.pmod(F.xxhash64("sh", "cell"), F.lit(buckets))).groupBy("bucket").applyInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, *, k: int = 5, percent: int = 75, sample: int = 20_000, least: int = 4, all_pairs: int = 64, rounds: int = 4, bucket_postings: int = 700_000, part_rows: int = 500_000, in_one_task: int = 300_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    common = spark.sparkContext.broadcast(common_shingles(docs, k, total["n"], sample, least, part_rows))
    buckets = int(max(6, total["chars"] / 6 * 0.26 / bucket_postings))
    cands = materialise(candidates(postings(docs, common, k, percent, buckets), common, percent, all_pairs), "ngram-candidates")
    filt, bits = wanted_filter(cands)
    table = materialise(nodes(docs, k, spark.sparkContext.broadcast(filt), bits), "ngram-nodes")
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    kinds = {r["kind"]: r["count"] for r in cands.groupBy("kind").count().collect()}
    rows = total["n"] + sum(kinds.values())  # about what the largest table below has
    keep = lambda df, label: materialise(few(df, rows), label)

    def labelled(df: DataFrame, col: str, name: str) -> DataFrame:
        return df.join(labels.toDF(col, name), col, "left").withColumn(name, F.coalesce(name, col))

    # first every node against the leader of its list, or else against one candidate
    led = cands.where("kind = 2").groupBy(F.col("y").alias("b")).agg(F.min_by("x", F.struct("at", "x")).alias("a")).select("a", "b")
    heads = cands.where("kind = 3").select("x", "y", "at")
    heads = heads.join(heads.groupBy("x").agg(F.min_by("y", F.struct("at", "y")).alias("a")), "x").where("a <> y").select("a", F.col("y").alias("b"))
    pairs = cands.where("kind in (0, 2)").select(F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = keep(bounded_pairs(ordered(pairs).distinct(), table, percent), "ngram-pairs")
    star = keep(led.unionByName(heads).unionByName(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")).distinct(), "ngram-star")
    found = keep(links_of(overlaps(star, table), percent), "ngram-found")
    partner = found.groupBy(F.col("b").alias("a")).agg(F.min_by(F.struct(F.col("a").alias("p"), F.col("both").alias("a_and_p"), F.col("size_b").alias("size_of_a"), F.col("size_a").alias("size_of_p")), "a").alias("s")).select("a", "s.*")
    links, tried, spent = found.select("a", "b"), ordered(star), [cands, pairs, star, found]
    for turn in range(rounds):  # then against candidates of other groups, while that joins groups
        labels = keep(components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), in_one_task=in_one_task, rows=rows), "ngram-labels")
        across = labelled(labelled(pairs, "a", "label_a"), "b", "label_b").where("label_a <> label_b").select("a", "b").join(tried, ["a", "b"], "left_anti")
        spent.append(labels)
        if turn == rounds - 1:
            break
        more = across.groupBy("b").agg(F.min("a").alias("a"), F.max("a").alias("z"))
        more = keep(more.select("a", "b").unionByName(more.select(F.col("z").alias("a"), "b")).distinct(), "ngram-more")
        found = keep(links_of(overlaps(more, table), percent), "ngram-found")
        spent += [more, found]
        tried = tried.unionByName(more)
        if not found.limit(1).count():
            break
        links = links.unionByName(found.select("a", "b"))

    # pairs of groups that long lists still hold
    entries = cands.where("kind = 1").select(F.col("x").alias("sh"), F.col("y").alias("b"), "size", "at", "first", "own")
    again = ordered(pairs_across(labelled(entries, "b", "label"), percent, part_rows, kinds.get(1, 0)))
    across = keep(across.unionByName(bounded_pairs(again, table, percent)).distinct().join(tried, ["a", "b"], "left_anti"), "ngram-across")

    # answers of a set from those of its partner: b against a's partner p decides most pairs (a, b)
    led = across.join(partner, "a", "left")
    asked = keep(overlaps(led.where("p is not null and p <> b").select(F.col("p").alias("a"), "b").distinct(), table), "ngram-asked")
    known = led.join(asked.select(F.col("a").alias("p"), "b", F.col("both").alias("p_and_b"), F.col("size_b").alias("size_of_b")), ["p", "b"], "left")
    most = F.col("p_and_b") + F.col("size_of_a") - F.col("a_and_p")
    fewest = F.col("p_and_b") - (F.col("size_of_p") - F.col("a_and_p"))
    need = F.ceil(F.lit(percent) * (F.col("size_of_a") + F.col("size_of_b")) / F.lit(100 + percent))
    state = F.when(F.col("p_and_b").isNull(), 0).when(most < need, -1).when(fewest >= need, 1).otherwise(0)
    known = keep(known.select("a", "b", state.alias("state")), "ngram-derived")
    verified = links_of(overlaps(known.where("state = 0").select("a", "b").distinct(), table), percent)
    edges = links.unionByName(links_of(asked, percent).select("a", "b")).unionByName(known.where("state = 1").select("a", "b")).unionByName(verified.select("a", "b"))
    groups = keep(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), in_one_task=in_one_task, rows=rows), "ngram-groups")
    discard(*spent, across, asked, known)

    members = table.select("doc_id", "size", "node").join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least_id = keep(members.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("component_id")), "ngram-least")  # a table of its own: the join can split a large component
    out = members.join(least_id, "label", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
    return few(out, total["n"])
