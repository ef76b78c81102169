"""Registered queries that must work on whole turns and on all rows, against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill import queries
from lexmill.operators import subword, tokenizer


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(12)] + ["été", "größe", "año"]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", " ".join(rng.choices(vocab, k=rng.randint(9, 14)))) for c in range(4) for t in range(3)]
    turns += [(9, 0, "user", ""), (9, 1, "assistant", "w1 alone"), (7, 0, "user", "w1 w2 p1 p2 p3"), (7, 1, "assistant", "q1 q2 w3 w1")]
    d = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame([(5, "b\na\nb"), (3, "x\n\ny")], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return str(d)


@pytest.fixture(scope="module")
def pairs(spark, folder):
    text = {(r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()}
    return {c * 1000 + t: (v, text[c, t + 1]) for (c, t), v in text.items() if (c, t + 1) in text}


def weights(n, j, m):
    return [math.exp(-4.0 * abs((i + 1) / n - (j + 1) / m)) for i in range(n)]


def expectation(pairs, rounds, null_prob=0.08):
    """The lexical model over whole turns, one pair after another."""
    p = defaultdict(lambda: 1.0)
    for _ in range(rounds):
        counts, totals = Counter(), Counter()
        for src, tgt in ((a.split(), b.split()) for a, b in pairs.values()):
            for j, rw in enumerate(tgt if src else []):
                w = weights(len(src), j, len(tgt))
                own = [("<eps>", null_prob * p["<eps>", rw])] + [(lw, (1 - null_prob) * x / sum(w) * p[lw, rw]) for lw, x in zip(src, w)]
                for lw, x in own:
                    counts[lw, rw] += x / sum(y for _, y in own)
        for (lw, _), c in counts.items():
            totals[lw] += c
        p = defaultdict(float, {k: c / totals[k[0]] for k, c in counts.items() if c / totals[k[0]] > 1e-7})
    return {k: v for k, v in p.items() if k[0] != "<eps>"}


def test_word_alignment_reads_whole_turns(spark, folder, pairs):
    got = {(r["lw"], r["rw"]): r["p"] for r in queries.QUERIES["word_alignment"](spark, folder).collect()}
    want = expectation(pairs, 2)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_word_links_read_whole_turns(spark, folder, pairs):
    got = {r["pair_id"]: r["links"] for r in queries.QUERIES["word_links_whole"](spark, folder).collect()}
    p = expectation(pairs, 2)
    whole = {k: (a.split(), b.split()) for k, (a, b) in pairs.items() if a and b}
    assert got.keys() == whole.keys()
    for k, (src, tgt) in whole.items():
        links = [tuple(map(int, x.split("-"))) for x in got[k].split()]
        assert [j for _, j in links] == list(range(len(tgt)))
        for i, j in links:
            w = [x * p.get((lw, tgt[j]), 1e-7) for lw, x in zip(src, weights(len(src), j, len(tgt)))]
            assert math.isclose(w[i], max(w), rel_tol=1e-9)
    assert any(i > 0 for v in got.values() for i in (int(x.split("-")[0]) for x in v.split()))


def test_lexical_weights_of_whole_phrases(spark, folder, pairs):
    got = {(r["src"], r["tgt"]): (r["w1"], r["w2"]) for r in queries.QUERIES["phrase_lexical_weights_whole"](spark, folder).collect()}
    turns = [(a.split(), b.split()) for a, b in pairs.values()]
    lines = {s: [t[s] for t in turns] for s in (0, 1)}
    on = {(s, w): frozenset(k for k, t in enumerate(lines[s]) if w in t) for s in (0, 1) for t in lines[s] for w in t}
    want = set()
    for group in {g for (s, _), g in on.items() if s == 0} & {g for (s, _), g in on.items() if s == 1}:
        for k in group:
            for own in (True, False):
                sides = [[i for i, w in enumerate(lines[s][k]) if (on[s, w] == group) == own] for s in (0, 1)]
                if all(0 < len(x) <= 7 and x[-1] - x[0] + 1 == len(x) for x in sides):
                    want.add(tuple(" ".join(lines[s][k][i] for i in sides[s]) for s in (0, 1)))
    n = [Counter(w for t in lines[s] for w in set(t)) for s in (0, 1)]
    both = Counter((x, y) for a, b in turns for x in set(a) for y in set(b))
    assert got.keys() == want and any(" " in a and " " in b for a, b in want)
    for (a, b), (w1, w2) in got.items():
        assert math.isclose(w1, math.prod(max(both[x, y] / n[0][x] for x in a.split()) for y in b.split()), rel_tol=1e-9)
        assert math.isclose(w2, math.prod(max(both[x, y] / n[1][y] for y in b.split()) for x in a.split()), rel_tol=1e-9)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("mode", ["char", "word"])
def test_edit_distance_of_all_pairs(spark, folder, pairs, mode):
    got = {r["pair_id"]: (r["distance"], r["score"]) for r in queries.QUERIES[f"levenshtein_{mode}_whole"](spark, folder).collect()}
    assert got.keys() == pairs.keys() and any(re.search(r"[^\x00-\x7f]", a + b) for a, b in pairs.values())
    for k, (a, b) in pairs.items():
        a, b = (a, b) if mode == "char" else (a.split(), b.split())
        n, d = max(len(a), len(b)), distance(a, b)
        assert got[k][0] == d and math.isclose(got[k][1], 1 - d / n if n else 1, abs_tol=1e-6)


def test_insert_line_into_all_lines(spark, folder):
    got = sorted((r["line_no"], r["value"]) for r in queries.QUERIES["insert_line_whole"](spark, folder).collect())
    lines = [*queries.SAMPLES, "x", "", "y", "b", "a", "b"]
    assert got == list(enumerate([*lines[:2], "_PAD", *lines[2:]], 1))


def plain_merges(counts, merges, least):
    """Counts all pairs again after every merge."""
    words = {w: [*w[:-1], w[-1] + subword.END] for w in counts if w}
    out = []
    while len(out) < merges:
        pairs = Counter()
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] += counts[w]
        best = min(pairs, key=lambda p: (-pairs[p], p), default=None)
        if best is None or pairs[best] < least:
            break
        out.append(best)
        words = {w: subword.merged(s, best) for w, s in words.items()}
    return out


@pytest.mark.parametrize("top", [4, 2_000])
def test_bpe_learns_from_every_word(spark, top, monkeypatch):
    rng = random.Random(2)
    text = ["".join(rng.choices("aaabcdé猫", k=rng.randint(1, 7))) for _ in range(150)]
    lines = spark.createDataFrame([(" ".join(rng.choices(text, k=20)),) for _ in range(30)], "value string")
    counts = Counter(w for r in lines.collect() for w in r["value"].split())
    want = plain_merges(counts, 40, 2)
    monkeypatch.setattr(subword, "learn_in_rounds", lambda *a, f=subword.learn_in_rounds: f(*a, top))
    assert subword.learn(lines, 40) == want
    assert subword.learn(lines, 40, max_words=10) == want
    for seed in range(20):  # batches, without Spark
        rng = random.Random(seed)
        counts = {"".join(rng.choices("abc", k=rng.randint(1, 8))): rng.randint(1, 4) for _ in range(25)}
        assert subword.learn_from(counts, 10_000, 2) == plain_merges(counts, 10_000, 2) == in_batches(counts)


def in_batches(counts):
    words, out = {w: [*w[:-1], w[-1] + subword.END] for w in counts if w}, []
    while True:
        pairs = Counter()
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] += counts[w]
        ranked = sorted(((p, n) for p, n in pairs.items() if n >= 2), key=lambda x: (-x[1], x[0]))
        if not (batch := subword.next_merges(ranked, True, {a + b for a, b in out})):
            return out
        for p in batch:
            words = {w: subword.merged(s, p) for w, s in words.items()}
        out += batch


@pytest.mark.parametrize("lang, line, want", [
    ("fr", "Le boul. Voltaire, chap. Deux, ann. Trois et Messrs. Dupont.", "Le boul. Voltaire , chap. Deux , ann. Trois et Messrs . Dupont ."),
    ("de", "Am 3. Mai evtl. Zwei, usw. Drei und Jul. Meier.", "Am 3. Mai evtl. Zwei , usw. Drei und Jul . Meier ."),
    ("pl", "Zob. nr. 5 oraz nr. Osiem i Messrs. Nowak.", "Zob. nr. 5 oraz nr . Osiem i Messrs . Nowak ."),
    ("en", "See Messrs. Smith and boul. Voltaire, No. 5.", "See Messrs. Smith and boul . Voltaire , No. 5 ."),
])
def test_abbreviations_of_the_language(spark, lang, line, want):
    assert spark.createDataFrame([(line,)], "v string").select(tokenizer.tokenize(F.col("v"), lang)).first()[0] == want


def test_all_abbreviation_lists():
    assert set(tokenizer.NONBREAKING) == set("ca cs de el en es fi fr hu is it lv nl pl pt ro ru sk sl sv ta".split())


def test_line_queries_evaluate_their_operator_once(spark, folder):
    for name, node in (("detokenize_en", "ArrowEvalPython"), ("tokenize_en", "&apos;")):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(node) == 1, name


def test_blocks_look_at_few_products_at_once(pairs, monkeypatch):
    import pyarrow as pa

    from lexmill.operators import aligner, blocks

    own = [(k, a.split(), b.split()) for k, (a, b) in pairs.items() if a and b]
    lists, n = pa.list_(pa.string()), len(own)
    cols = {"b": pa.array([0] * n), "r": pa.array([0] * n, pa.int32()), "k": pa.array([k for k, _, _ in own]), "s": pa.array([a for _, a, _ in own], lists), "m": pa.array([len(b) for _, _, b in own]),
            "j": pa.array([list(range(len(b))) for _, _, b in own]), "w": pa.array([b for _, _, b in own], lists), "v": pa.array([None] * n, pa.list_(pa.float64()))}
    batch = pa.RecordBatch.from_pydict(cols)
    want = expectation(pairs, 2)

    def counted(known, more):
        block, model = blocks.Block([batch]), aligner.Model(4.0, 0.08, 1e-7, known)
        for no, t in enumerate(more, 1):
            block.more[no] = [([block.words[w] for w in t], None, None, list(t.values()))]
        return block, model

    for at_once in (10, 100_000):  # a word's products in many slices, and all words together
        monkeypatch.setattr(blocks, "AT_ONCE", at_once)
        totals = []
        for known in (0, 1):
            block, model = counted(known, totals)
            totals.append({r["lw"]: r["v"] for x in model.totals(block) for r in x.to_pylist()})
        block, model = counted(2, totals)
        assert all(sum(c.stop - c.start for c in cuts) and all(block.n[block.who[c]].sum() + c.stop - c.start <= at_once or c.stop - c.start == 1 for c in cuts) for cuts in block.groups())
        got = {(r["lw"], r["rw"]): r["p"] for x in model.table(block) for r in x.to_pylist()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_no_row_for_each_two_words_of_a_pair(spark, folder):
    for name in ("word_alignment", "word_links_whole", "phrase_lexical_weights_whole"):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "<eps>" not in plan, name


def test_merges_of_many_words_are_learned_at_once(spark, monkeypatch):
    def rounds(*_):
        raise AssertionError("learned in rounds")

    monkeypatch.setattr(subword, "learn_in_rounds", rounds)
    lines = spark.range(1_000_001).select(F.concat_ws(" ", F.lower(F.hex("id")), F.lit("aaaaa aaaaa")).alias("value"))
    assert subword.learn(lines, 3)[:2] == [("a", "a"), ("aa", "a</w>")]


def test_merges_against_counting_every_word_anew():
    rng = random.Random(3)
    for _ in range(60):
        counts = {"".join(rng.choices("aab", k=rng.randint(1, 9))): rng.randint(1, 5) for _ in range(20)}
        words, want = {w: [*w[:-1], w[-1] + "</w>"] for w in counts}, []
        for _ in range(30):
            n = Counter()
            for w, s in words.items():
                for p in zip(s, s[1:]):
                    n[p] += counts[w]
            best = min(n, key=lambda p: (-n[p], p), default=None)
            if best is None or n[best] < 2:
                break
            want.append(best)
            words = {w: subword.merged(s, best) for w, s in words.items()}
        assert subword.learn_from(counts, 30) == want


@pytest.mark.parametrize("most", [0xB000, 3])
def test_word_distance_by_characters_and_by_rows(spark, monkeypatch, most):
    from lexmill.operators import scoring

    monkeypatch.setattr(scoring, "_CODES", most)
    rows = [("a b c", "a c b a"), ("", "x y"), ("été né", "né été né"), ("a", "a"), ("p q r s t", "q r")]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", scoring.edit_distance(F.col("a"), F.col("b"), "word").alias("n"))
    assert all(r["n"] == distance(r["a"].split(), r["b"].split()) for r in df.collect())
    assert "levenshtein" in df._jdf.queryExecution().optimizedPlan().toString()


def test_chrf_counts_rows_without_sorting(spark, folder):
    assert "sort_array" not in queries.QUERIES["chrf"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
