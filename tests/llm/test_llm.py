"""Brute force, round trips and edge cases for the training-data operators."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexmill.llm import chat_collapse, components, decontamination, langid, lm_interpolation, ngram_join, packing, quality_gbdt, token_counts, topk_ball, toxicity
from lexmill.llm._common import LOWER, materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    own = [" ".join(rng.choices(vocab, k=rng.randint(1, 120))) for _ in range(60)]
    for i in range(20):  # near copies
        w = own[i].split()
        w[rng.randrange(len(w))] = "changed"
        own.append(" ".join(w))
    own += own[:5] + ["", None, "   ", "A b C d", "x" * 5000, "é, naïve Straße 12 <|endoftext|> done", "a " * 3000]
    return [(i, t, "en" if i % 2 else None, "s", 1, "clash") for i, t in enumerate(own)] + [(None, "no id here at all today", None, None, None, None), (3, own[3], "en", "s", 1, "again")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


def test_empty_tables(spark):
    e = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_gbdt.score(e, quality_gbdt.fit(e, labels)).count() == 0
    assert toxicity.score(e, toxicity.fit(e, labels)).count() == 0
    assert langid.identify(e, langid.fit(e)).count() == 0
    for f in (packing.pack, token_counts.count_tokens, ngram_join.join, lm_interpolation.score):
        assert f(e).count() == 0
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(e, b).count() == 0
    assert topk_ball.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert chat_collapse.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_quality(spark, docs):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5)).astype(float)
    trees = quality_gbdt.grow(x, y, rounds=30, depth=3)
    assert ((trees.score(x) > 0.5) == (y == 1)).mean() > 0.97
    one = [x_ for x_ in x[:20]]
    walked = []
    for r in one:  # a plain walk of each tree
        z = trees.base
        for root in trees.roots:
            n = root
            while trees.left[n] != n:
                n = trees.left[n] if r[trees.stat[n]] <= trees.cut[n] else trees.right[n]
            z += trees.value[n]
        walked.append(1 / (1 + math.exp(-z)))
    assert np.allclose(walked, trees.score(x[:20]))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_gbdt.score(docs, quality_gbdt.fit(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_statistics_and_splits_by_brute_force():
    for t in ["Buy NOW!! $$ |x| 12 café. The the the, of of", "a\n\nb b\nb b\n", "ABC abc ABCd", "   ", "é" * 30, "x" * 200_000 + " end."]:
        raw = t.encode()
        ws, ls = raw.split(), [x for x in raw.split(b"\n") if x]
        n, size, lens = len(ws) or 1, len(raw), [len(w) for w in ws] or [0]
        share = lambda test: sum(map(test, raw)) / size
        mean = sum(lens) / len(lens)
        punct = set(range(33, 127)) - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123))
        want = {
            "log_bytes": math.log1p(size), "log_words": math.log1p(len(ws)), "word_len_mean": mean, "word_len_sd": math.sqrt(sum((x - mean) ** 2 for x in lens) / len(lens)), "short_words": sum(x <= 3 for x in lens) / n, "long_words": sum(x >= 12 for x in lens) / n,
            "distinct_words": len(set(ws)) / n, "top_word": max(map(ws.count, ws), default=0) / n, "adjacent_repeats": sum(a == b for a, b in zip(ws, ws[1:])) / n, "distinct_pairs": len({(a, b) for a, b in zip(ws, ws[1:])}) / n,
            "lower": share(lambda b: 97 <= b <= 122), "upper": share(lambda b: 65 <= b <= 90), "digits": share(lambda b: 48 <= b <= 57), "space": share(lambda b: b == 32 or 9 <= b <= 13), "punct": share(punct.__contains__), "bang": raw.count(b"!") / size, "pipe": raw.count(b"|") / size,
            "marks": share(b"#$%&*^~".__contains__), "non_ascii": share(lambda b: b > 127), "log_lines": math.log1p(len(ls)), "distinct_lines": len(set(ls)) / (len(ls) or 1), "top_line": max((len(x) * ls.count(x) for x in ls), default=0) / size, "line_len": size / (len(ls) or 1), "stops": (raw.count(b",") + raw.count(b".")) / n,
        }
        got = dict(zip(quality_gbdt.STATS, quality_gbdt.statistics(t)))
        assert {k: got[k] for k in want} == pytest.approx(want) and len(got) == len(want) + 2
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, size=(80, 3)).astype(np.float32)
    y = ((x[:, 1] > 4) ^ (rng.random(80) < 0.2)).astype(float)
    t = quality_gbdt.grow(x, y, rounds=1, depth=1, rate=1.0, ridge=2.0, least=4.0)
    p = (y.sum() + 1) / 82
    g, h = y - p, np.full(80, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 2)
    best = max((gain(x[:, j] <= c) + gain(x[:, j] > c), j, c) for j in range(3) for c in range(8) if h[x[:, j] <= c].sum() > 4 and h[x[:, j] > c].sum() > 4)
    root = t.roots[0]
    assert (t.stat[root], t.cut[root]) == best[1:]
    for side, m in ((t.left[root], x[:, best[1]] <= best[2]), (t.right[root], x[:, best[1]] > best[2])):
        assert t.value[side] == pytest.approx(g[m].sum() / (h[m].sum() + 2))


def test_topk(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(-3, 4, size=(400, 8)) / 7
    v[100:180] = v[100]
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)] + [(1000, None), (1050, [1.0, None] + [0.0] * 6), (1100, [float("nan")] * 8), (1150, []), (50, [float(x) for x in v[50]]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk_ball.search(df, shard_rows=90, block_rows=3, seeds=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(256 * v).astype(int)
    want = {i: sorted(((j, int(q[i] @ q[j])) for j in range(400) if j != i), key=lambda x: (-x[1], x[0]))[:5] for i in range(0, 400, 50)}
    assert dict(got) == want
    few = topk_ball.search(df.where("vec_id in (0, 1, 2)")).collect()
    assert len(few) == 2
    odd = spark.createDataFrame([*rows[:120], *((2000 + i, [1e9, -1e7 * i]) for i in range(60))], "vec_id long, embedding array<double>").withColumns({"score": F.lit(1), "shard": F.lit("x"), "id": F.lit(None)})  # two lengths, huge components, columns that clash
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk_ball.search(odd, shard_rows=20, block_rows=2, scale=1).collect()}
    for a in (2000, 2050):
        want = sorted(((b, 10**18 + 10**14 * (a - 2000) * (b - 2000)) for b in range(2000, 2060) if b != a), key=lambda x: (-x[1], x[0]))[:5]
        assert [got[a, i] for i in range(1, 6)] == want
    assert all(j < 120 or j == 50 for (i, _), (j, _) in got.items() if i < 120)


def test_topk_prunes_shards_before_the_shuffle(spark, monkeypatch):
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(20, 6)) * 6
    v = middle[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 6)) * 0.1
    df = spark.createDataFrame([(i, [float(x) for x in e]) for i, e in enumerate(v)], "vec_id long, embedding array<double>")
    asked, written = {}, topk_ball.materialise
    monkeypatch.setattr(topk_ball, "materialise", lambda t, label, **o: asked.setdefault(label, written(t, label, **o)))
    got = defaultdict(list)
    for r in topk_ball.search(df, shard_rows=100, seeds=200).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    q = np.floor(256 * v).astype(int)
    for i in range(0, 4000, 50):
        s = q @ q[i]
        assert got[i] == sorted(((j, int(s[j])) for j in range(4000) if j != i), key=lambda x: (-x[1], x[0]))[:5]
    assert asked["topk-asked"].count() < 80 * 40 / 4  # of 80 queries and at least 40 shards


def test_packing(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs).collect()
    for r in pieces:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] and r["offset"] + r["length"] <= 1024
    by_seq = defaultdict(list)
    for r in pieces:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for o, n in sorted(by_seq[s]):
            assert o == at
            at += n
        sizes.append(at)
    assert sorted(by_seq) == list(range(len(by_seq))) and all(n == 1024 for n in sizes[:-1])
    got = Counter()
    for r in pieces:
        if r["start"] == 0:
            parts = sorted((p["start"], p["ids"]) for p in pieces if p["doc_id"] == r["doc_id"] and p["doc_tokens"] == r["doc_tokens"])
            if len({s for s, _ in parts}) == len(parts):
                got[tuple(i for _, p in parts for i in p)] += 1
    want = Counter(tuple([*t.encode(x["text"] or "", add_special_tokens=False).ids, 0]) for x in docs.where("doc_id is null or doc_id <> 3").collect())
    assert all(got[k] == n for k, n in want.items())


def test_token_counts(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in token_counts.count_tokens(docs).collect():
        assert r["n_tokens"] == len(t.encode(text[r["doc_id"]], add_special_tokens=False).ids)
        assert r["n_bytes"] == len(text[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 2048)
    bpe = token_counts.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["aaaaaaaaa", "ΑΣ ς", "İstanbul", "áb", "<|startoftext|>x<|endoftext|>", "1234 ½²", "don't WE'LL", "  \x85x", "ꟋꟜ"]
    assert bpe.count(odd) == [len(e.ids) for e in t.encode_batch(odd, add_special_tokens=False)]


def brute_links(rows):
    sets = {d: frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w := words(t)) >= 5 else frozenset([tuple(w)] if w else []) for d, t in rows}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("options", [{}, {"in_one_task": 0, "all_pairs": 2, "bucket_postings": 300, "sample": 10, "least": 2}, {"all_pairs": 3, "least": 2, "part_rows": 4}])
def test_ngram_join(docs, options):
    got = ngram_join.join(docs, **options).collect()
    want = brute_links({(r["doc_id"], r["text"]) for r in docs.where("doc_id is not null").collect()})
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), all_pairs=4, least=3).collect()}
    assert got == brute_links(rows)


def near_copies(n, seed=11):
    """Near copies of one text, from whole copies to hardly alike, each with a line that stands in every document."""
    rng = random.Random(seed)
    base, line = [f"t{i}" for i in range(120)], " ".join(f"shared{i}" for i in range(12))
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append((i, " ".join(w) + " " + line))
    return out + [(n + i, " ".join(f"o{rng.randrange(10**6)}" for _ in range(60)) + " " + line) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"part_rows": 40, "all_pairs": 8}])
def test_hot_lists(spark, options):
    rows = near_copies(150)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), least=3, **options).collect()}
    assert got == brute_links(rows)


def test_pairs_grow_with_the_rows(spark):
    made = []
    for n in (500, 2000):
        docs = spark.createDataFrame(near_copies(n), "doc_id long, text string").repartition(4)
        common = spark.sparkContext.broadcast(ngram_join.common_shingles(docs, 5, 2 * n, 20_000, 4, 500_000))
        cands = ngram_join.candidates(ngram_join.postings(docs, common, 5, 75, 6), common, 75, 64).cache()
        pairs = cands.where("kind in (0, 2)").select("x", "y").distinct().count()
        star = cands.where("kind = 2").groupBy("y").agg(F.min_by("x", F.struct("at", "x")).alias("x"))
        label = star.select(F.col("y").alias("b"), F.col("x").alias("label"))
        runs = cands.where("kind = 1").select(F.col("x").alias("sh"), F.col("y").alias("b"), "size", "at", "first", "own").join(label, "b")
        one = runs.withColumn("label", F.lit(1).cast("long"))
        assert ngram_join.pairs_across(one, 75, 500_000, 1).count() == 0  # nothing is formed inside a group
        made.append((pairs, ngram_join.dealt(runs, 500_000).count(), runs.count()))
    (small, _, _), (large, dealt, entries) = made
    assert large <= 5 * small and large < 12 * 4000 and dealt <= entries


def test_small_tables_take_few_files(spark, monkeypatch):
    files = {}

    def counted(df, label, **options):
        out = materialise(df, label, **options)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "materialise", counted)
    monkeypatch.setattr(components, "materialise", counted)
    rows, many = near_copies(150), {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), least=3, all_pairs=8)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()}
        parts = out.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_links(rows)
    assert len(files) > 8 and max(files.values()) <= 6 and parts <= 4, files  # six buckets, four cores


def test_block_skip():
    rng = np.random.default_rng(3)
    n = 400
    run, size = rng.integers(0, 6, n), rng.integers(5, 40, n)
    at, first, label = rng.integers(0, 12, n), rng.integers(0, 50, n).astype(np.uint64), rng.integers(0, 9, n) ** 2 // 9
    by = np.lexsort((at, size, run))
    run, size, at, first, label = (x[by] for x in (run, size, at, first, label))
    node, own, none = np.arange(n), np.zeros(n, bool), np.arange(n).astype(np.uint64)
    may = lambda i, j: run[i] == run[j] and min(size[i] - at[i], size[j] - at[j]) * 175 >= 75 * (size[i] + size[j])
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if may(i, j)}
    out = ngram_join.Pairs(at_once=50)
    ngram_join.list_pairs(run, node, size, at, none, own, 75, out)
    assert set(zip(*out.fold_up().tolist())) == want
    out, major = ngram_join.Pairs(), label == 0
    ngram_join.across_labels(run, node, size, at, none, own, label, major, np.ones(n, bool), 75, out)
    assert set(zip(*out.fold_up().tolist())) == {(i, j) for i, j in want if label[i] != label[j]}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (3, 10), (10, 11)], "u long, v long")
    want = {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 4: 4, 5: 4}
    for limit in (0, 100):
        assert {r["node"]: r["label"] for r in components.components(edges, in_one_task=limit).collect()} == want


def test_language_model(docs):
    got = {r["doc_id"]: r for r in lm_interpolation.score(docs, block_words=300, bucket_keys=200).collect()}
    rows = docs.collect()
    end = b" end"
    toks = [(r["doc_id"], (r["text"] or "").encode().translate(LOWER).split() + [end]) for r in rows]
    crc = lambda d: 0 if d is None else zlib.crc32(str(d).encode())
    train = [(d, t) for d, t in toks if d is None or crc(d) % 5 != 1]
    uni, bi = Counter(w for _, t in train for w in t), Counter(p for _, t in train for p in zip([end, *t], t))
    kept = [(d, t) for d, t in train if crc(d) // 5 % 8 != 0]
    tune = [(d, t) for d, t in train if crc(d) // 5 % 8 == 0]
    ku, kb = Counter(w for _, t in kept for w in t), Counter(p for _, t in kept for p in zip([end, *t], t))
    n, v, kn = sum(uni.values()), len(uni), sum(ku.values())
    cell, level = (lambda p: int(lm_interpolation.cells(np.array([p]))[0])), (lambda c: int(lm_interpolation.level(np.array([c]))[0]))
    held = Counter((level(ku[h]), cell(kb[h, w] / max(ku[h], 1)), cell(ku[w] / kn)) for _, t in tune for h, w in zip([end, *t], t))
    weights = lm_interpolation.learn_weights(np.array([(*k, c) for k, c in sorted(held.items())], np.int64).reshape(-1, 4), 1 / (v + 1))
    assert np.allclose(weights.sum(axis=1), 1)
    for d, t in toks:
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(uni[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        z = 0.0
        for h, w in zip([end, *t], t):
            a, b, c = weights[level(uni[h])]
            z += math.log10(a * bi[h, w] / max(uni[h], 1) + b * uni[w] / n + c / (v + 1))
        assert r["score"] == pytest.approx(z)


def test_chat(spark):
    log = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c"), (4, 0, None, None), (4, 0, None, None), (None, 0, "user", "x"), (5, 0, "user", "c")]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat_collapse.render(df).collect()}
    assert set(got) == {2, 4, 5} and got[2]["n_copies"] == 2 and got[2]["n_turns"] == 3 and got[2]["n_assistant"] == 1
    assert got[2]["text"] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n" and got[4]["text"] == "<|unknown|>\n<|end|>\n"


def test_decontamination(spark):
    rng = random.Random(3)
    w = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    items = [(i, " ".join(w(30))) for i in range(6)] + [(90, "one two three four five six"), (91, "too short"), (92, None), (93, "")]
    swapped = items[1][1].split()
    for p in (4, 11, 19, 26):
        swapped[p] = "other"
    rows = [(0, " ".join(w(50)) + " " + items[0][1].upper() + ", " + " ".join(w(9))), (1, " ".join(w(20) + swapped + w(20))), (2, " ".join(w(200))), (3, "x " + items[90 - 84][1] + " y"), (4, None), (5, ""), (6, " ".join(w(20) + items[2][1].split()[5:20] + w(20))), (None, items[3][1]), (7, " ".join(items[4][1].split()[:9] + w(40)))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {(0, 0), (1, 1), (3, 90), (6, 2), (None, 3)}
    for block in (500_000, 40):
        got = decontamination.contaminated(d, b, block_words=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert {r["doc_id"]: (r["matched_words"], r["overlap_words"]) for r in got}[1] == (19, 21)  # words 5 to 25, two substituted


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(9,0)", "double"])
def test_decontamination_cases(spark, kind):
    item = [f"w{j}" for j in range(20)]
    long = " ".join(f"l{j % 5000}" for j in range(200_000))
    rows = [(1, " ".join(item), 5), (1, " ".join(item), 5), (2, f"{long} {' '.join(item)} {long}", 5), (3, long, 5), (None, " ".join(item), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id long")  # a column that clashes with the benchmark's
    bench = spark.createDataFrame([(7, " ".join(item), 1), (7, " ".join(item), 1), (7, " ".join(f"z{j}" for j in range(20)), 2), (None, None, 3)], "item_id long, text string, doc_id long").withColumn("item_id", F.col("item_id").cast(kind))
    for block in (500_000, 15):
        got = decontamination.contaminated(docs, bench, block_words=block).collect()
        assert sorted((r["doc_id"] or 0, float(r["item_id"]), r["matched_words"]) for r in got) == [(0, 7.0, 20), (1, 7.0, 20), (2, 7.0, 20)]
        kept = decontamination.clean(docs, bench, block_words=block)
        assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [3]


def test_decontamination_substitutions(spark):
    rng = random.Random(8)
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in (*range(5, 21), 24, 31, 40)}

    def found(same, n):  # any stretch with at most one mismatch to four matches and enough matches
        return any(sum(same[a:b]) >= max(4 * (b - a - sum(same[a:b])), min(13, math.ceil(0.8 * n))) for a in range(n) for b in range(a + 1, n + 1))

    patterns = [(n, (p,)) for n in range(5, 21) for p in range(n)] + [(n, (p, q)) for n in range(5, 21) for p in range(n) for q in range(p)]
    patterns += [(n, tuple(rng.sample(range(n), rng.randint(n // 6, n // 4 + 1)))) for n in items for _ in range(40)]
    rows, want = [], set()
    for k, (n, out) in enumerate(patterns):
        text = [f"no{k}" if j in out else w for j, w in enumerate(items[n])]
        around = [[f"o{rng.randrange(9000)}" for _ in range(rng.choice([0, 15]))] for _ in range(2)]
        rows.append((k, " ".join(around[0] + text + around[1])))
        if found([j not in out for j in range(n)], n):
            want.add((k, n))
    assert all((k, n) in want for k, (n, out) in enumerate(patterns) if len(out) <= n // 5)
    got = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id int, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["matched_words"] >= min(13, math.ceil(0.8 * r["item_id"])) for r in got)


def test_language(spark):
    rng = random.Random(4)
    vocab = {"en": ["the", "and", "with", "house", "which"], "de": ["und", "der", "nicht", "haus", "schön"], "fr": ["les", "avec", "maison", "être", "dans"]}
    make = lambda k, n=40: " ".join(rng.choices(vocab[k], k=n))
    rows = [(i, make(k), k) for i, k in enumerate(["en", "de", "fr"] * 30)] + [(500, None, "en"), (501, "12 34 !?", None), (502, make("de"), None), (None, make("fr"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows[:90]) and got[502]["lang_pred"] == "de" and got[None]["lang_pred"] == "fr"
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und" and got[500]["score"] == 0
    share, kept = model.mixture(make("en", 60) + " " + make("de", 30))
    assert {model.names[j] for j in kept} == {"en", "de"} and share[model.names.index("en")] > share[model.names.index("de")]


def test_mixture_by_brute_force():
    rng = np.random.default_rng(6)
    prob = rng.random((langid.SIZE, 3)) + 0.01
    model = langid.Languages(["a", "b", "c"], prob / prob.sum(axis=0))
    for text in ["the cat sat on the mat", "ein Haus, zwei Häuser", "x", "日本語 text 123"]:
        count = {i: int(c) for i, c in enumerate(langid.grams(text)) if c}
        n = sum(count.values())

        def climb(share, keep):
            s = {k: share[k] / sum(share[j] for j in keep) for k in keep}
            for _ in range(8 if len(keep) > 1 else 0):
                new = dict.fromkeys(keep, 0.0)
                for i, c in count.items():
                    mix = sum(s[k] * model.prob[i, k] for k in keep)
                    for k in keep:
                        new[k] += c * s[k] * model.prob[i, k] / mix / n
                s = new
            return s, sum(c * math.log(sum(s[k] * model.prob[i, k] for k in keep)) for i, c in count.items()) / n

        keep = [0, 1, 2]
        share, fit = climb(dict.fromkeys(keep, 1 / 3), keep)
        while len(keep) > 1:
            last = min(keep, key=lambda k: share[k])
            rest = [k for k in keep if k != last]
            trial, without = climb(share, rest)
            if share[last] >= 0.02 and fit - without > 0.01:
                break
            keep, share, fit = rest, trial, without
        got, kept = model.mixture(text)
        assert kept.tolist() == keep and {k: got[k] for k in keep} == pytest.approx(share)


def test_very_long_and_repeated_rows(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(1_000_000))
    rows = [(1, long, "en", 1), (1, long, "en", 1), (2, "short text here for all of it", "en", 2), (5, "", None, None), (7, None, "de", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score long").repartition(2)  # ``score`` clashes
    count = {r["doc_id"]: r for r in token_counts.count_tokens(docs).collect()}
    want = len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(long, add_special_tokens=False).ids)
    assert count[1]["n_tokens"] == want and count[1]["n_bytes"] == len(long) and count[7]["n_tokens"] == 0
    pieces = [r for r in packing.pack(docs).drop("ids").collect() if r["doc_id"] == 1]
    total = len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(long, add_special_tokens=False).ids) + 1
    assert sum(r["length"] for r in pieces) == 2 * total and {r["doc_tokens"] for r in pieces} == {total}
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs).collect())
    w = long.split()
    size = len(set(zip(w, w[1:], w[2:], w[3:], w[4:])))
    assert got == [(1, size, 1), (1, size, 1), (2, 3, 2), (5, 0, 5), (7, 0, 7)]
    scored = sorted((r["doc_id"], r["n_tokens"], r["score"]) for r in lm_interpolation.score(docs).collect())
    assert [r[:2] for r in scored] == [(1, 1_000_001), (1, 1_000_001), (2, 8), (5, 1), (7, 1)] and all(r[2] < 0 for r in scored)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for out in (quality_gbdt.score(docs, quality_gbdt.fit(docs, labels)), toxicity.score(docs, toxicity.fit(docs, labels)), langid.identify(docs, langid.fit(docs))):
        assert sorted(r["doc_id"] for r in out.collect()) == [1, 1, 2, 5, 7]


def test_chat_cases(spark):
    log = [(1, None, "user", "a"), (1, 1, "user", "b"), *[(2, 0, "user", "hot")] * 50, (2, 1, "assistant", "x" * 300_000), (3, 0, "user", "hot"), (4, 0, "user", ""), (5, 0, "user", None)]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string").withColumns({"place": F.lit(1), "n_copies": F.lit("x")})
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], len(r["text"])) for r in chat_collapse.render(df).collect()}
    assert set(got) == {1, 2, 4} and got[2][:2] == (2, 1) and got[2][2] > 300_000 and got[1][0] == 2 and got[4][1] == 2  # a null text is an empty one


def test_toxicity(spark):
    rng = random.Random(6)
    vocab = [f"n{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(200):
        w = rng.choices(vocab, k=20)
        bad = i % 4 == 0
        if bad:
            w[3] = rng.choice(["awful", "awfully"])
        if rng.random() < (0.9 if bad else 0.1):  # a group mentioned mostly in toxic rows
            w[5] = "women"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    d, lab = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fair, plain = toxicity.fit(d, lab, fairness=5.0), toxicity.fit(d, lab, fairness=0.0)
    got = {r["doc_id"]: r for r in toxicity.score(d, fair).collect()}
    assert all(got[i]["predicted"] == t for i, _, t in labels)
    assert got[900]["score"] == got[901]["score"] and 0 < got[900]["score"] < 1
    gap = lambda m: float(np.ptp(m.score([f"n1 {g} n2" for g in ("women", "men", "girls")])))
    assert gap(fair) < gap(plain) and gap(toxicity.fit(d, lab)) < gap(plain) / 2
    neutral = [f"{' '.join(rng.choices(vocab, k=19))} women" for _ in range(100)]
    assert fair.score(neutral).mean() < plain.score(neutral).mean() and sum(fair.score(neutral) >= 0.5) <= sum(plain.score(neutral) >= 0.5)


def test_counterfactuals():
    rng = np.random.default_rng(12)
    groups = (("women", "men", "wombats"), ("black", "white"))
    texts = ["Women and men talk", "women walk; wombling on", "a black cat", "nothing here", "", "white, black and men", "wombats womb"]
    partners = toxicity.swaps(groups)
    names = sorted({f for t in texts for f in toxicity.document_features(t)} | set(partners) - {"wombats"})
    at = {n: j for j, n in enumerate(names)}
    w, bias = rng.normal(size=len(names)), 0.3
    model = toxicity.Model({n: float(w[j]) for n, j in at.items()}, bias)
    found, brute = [], []
    for i, t in enumerate(texts):
        for term, other, gained, lost, k in toxicity.counterfactuals(t, partners):
            found.append((i, k, [at[f] for f in gained if f in at], [at[f] for f in lost if f in at]))
            changed = re.sub(r"\w+", lambda m: other if m[0].lower() == term else term if m[0].lower() == other else m[0], t)  # noqa: B023
            brute.append((k, model.score([t])[0], model.score([changed])[0]))
    assert len(found) == 2 * 2 + 2 + 1 + 2 + 2 + 2
    s = toxicity.Swaps.of(found)
    x = np.array([[float(n in toxicity.document_features(t)) for n in names] for t in texts])
    value, by_doc, by_weight = s.penalty(w, x @ w + bias)
    assert value == pytest.approx(sum(k * (q - p) ** 2 for k, p, q in brute) / sum(k for k, _, _ in brute))
    still = [(i, p, q) for (i, _, gained, lost), (_, p, q) in zip(found, brute) if not gained and not lost]
    assert [i for i, _, _ in still] == [0, 0, 5, 5] and all(p == q for _, p, q in still)  # both terms named: nothing changes
    grad = x.T @ by_doc + by_weight
    for j in range(len(names)):
        e = np.zeros(len(names))
        e[j] = 1e-6
        slope = (s.penalty(w + e, x @ (w + e) + bias)[0] - s.penalty(w - e, x @ (w - e) + bias)[0]) / 2e-6
        assert slope == pytest.approx(grad[j], abs=1e-7)
