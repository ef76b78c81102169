"""BLEU, chrF, edit distance and fuzzy match as relational plans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.regex import let, tokens

#: Characters of the basic plane from U+2001 on, before the surrogates.
_CODES = 0xB000
#: The logarithm of zero.
LOG_ZERO = -9999999999.0


def ngrams(words: Column, n: int, glue: str = " ") -> Column:
    """The n-grams of an array, each joined by ``glue``. ``words`` is named inside a lambda: pass a column or a ``let``
    variable, not an expression that would be evaluated for every n-gram."""
    count = F.size(words) - (n - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, F.lit(n)), glue))).otherwise(F.array().cast("array<string>"))


def occurrences(grams: Column) -> Column:
    """Every occurrence as ``gram, mark, number``, so that the size of an intersection of two such arrays is the clipped
    count of their common grams, and a union keeps each gram's largest count. Sorting finds the runs: n log n a row, and
    nothing is shuffled."""

    def of(g: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: (i == 0) | (F.get(g, i) != F.get(g, i - 1)))
        runs = lambda s: F.flatten(F.transform(s, lambda at, k: F.transform(F.sequence(F.lit(1), F.coalesce(F.get(s, k + 1), F.size(g)) - at), lambda m: F.concat_ws("\x01", F.get(g, at), m.cast("string")))))
        return F.when(F.size(g) > 0, let(starts, runs)).otherwise(F.array().cast("array<string>"))

    return let(F.sort_array(grams), of)


def _log(c: Column) -> Column:
    return F.when(c > 0, F.ln(F.when(c > 0, c))).otherwise(F.lit(LOG_ZERO))


def _final(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From correct_n, total_n, hyp_len and ref_len to the score; an empty side scores 0."""
    p = [F.when(F.col(f"total_{n}") > 0, F.col(f"correct_{n}") / F.col(f"total_{n}")).otherwise(F.lit(0.0)) for n in range(1, 5)]
    bp = F.when(F.col("hyp_len") < F.col("ref_len"), F.exp(1 - F.col("ref_len") / F.when(F.col("hyp_len") > 0, F.col("hyp_len")))).otherwise(F.lit(1.0))
    logs = sum((_log(x) for x in p[1:]), _log(p[0]))
    score = F.when((F.col("ref_len") > 0) & (F.col("hyp_len") > 0), bp * F.exp(logs / 4)).otherwise(F.lit(0.0))
    return stats.select(*keys, (score * 100).alias("bleu"), *((x * 100).alias(f"p{n}") for n, x in enumerate(p, 1)), F.when((F.col("ref_len") > 0) & (F.col("hyp_len") > 0), bp).otherwise(F.lit(0.0)).alias("bp"), "hyp_len", "ref_len")


def bleu_statistics(hyp: DataFrame, ref: DataFrame, key: str = "sent_id", value: str = "value", lowercase: bool = False) -> DataFrame:
    """Per sentence: clipped and total n-gram counts (largest count over the references), hypothesis length, length of
    the closest reference (the shorter of two as close). ``ref`` may hold several rows a key. One join by key; all
    counting is inside the row."""
    low = (lambda c: F.lower(c)) if lowercase else (lambda c: c)
    side = lambda df, name: df.select(key, tokens(low(F.coalesce(value, F.lit("")))).alias(name))
    both = side(hyp, "h").join(side(ref, "r").groupBy(key).agg(F.collect_list("r").alias("rs")), key)
    orders = range(1, 5)

    def correct(n: int) -> Column:
        of_refs = F.transform("rs", lambda r: occurrences(ngrams(r, n)))
        return F.size(F.array_intersect(occurrences(ngrams(F.col("h"), n)), F.array_distinct(F.flatten(of_refs)))).cast("long").alias(f"correct_{n}")

    totals = [F.greatest(F.size("h") - (n - 1), F.lit(0)).cast("long").alias(f"total_{n}") for n in orders]
    closest = F.array_min(F.transform("rs", lambda r: F.struct(F.abs(F.size(r) - F.size("h")).alias("off"), F.size(r).alias("len"))))
    return both.select(key, *(correct(n) for n in orders), *totals, F.size("h").cast("long").alias("hyp_len"), closest["len"].cast("long").alias("ref_len"))


def sentence_bleu(hyp: DataFrame, ref: DataFrame, key: str = "sent_id", value: str = "value", lowercase: bool = False) -> DataFrame:
    return _final(bleu_statistics(hyp, ref, key, value, lowercase), [key])


def corpus_bleu(hyp: DataFrame, ref: DataFrame, key: str = "sent_id", value: str = "value", lowercase: bool = False) -> DataFrame:
    """One row over all sentences."""
    stats = bleu_statistics(hyp, ref, key, value, lowercase)
    names = [f"{name}_{n}" for n in range(1, 5) for name in ("correct", "total")] + ["hyp_len", "ref_len"]
    return _final(stats.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)), [])


def c_rounded(x: Column, digits: int) -> Column:
    """``x`` rounded as C prints it: by the exact value of the double, a true tie to the even digit. Java's formatter rounds
    the shortest decimal form, a tie up. Where the product with the power of ten looks like a tie, its exact error decides
    (the factor is cut in halves whose products are exact)."""
    m = F.lit(float(10**digits))
    y = x * m
    down = F.floor(y).cast("double")
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    error = (high * m - y) + (x - high) * m
    up = (y - down > 0.5) | ((y - down == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(down, F.lit(2.0)) == 1))))
    return (down + up.cast("double")) / m


def bleu_report(hyp: DataFrame, ref: DataFrame, key: str = "sent_id", value: str = "value") -> DataFrame:
    """order, value: the report's lines, the document line first (it starts with -1, so a numeric sort keeps it there)."""
    s, d = sentence_bleu(hyp, ref, key, value), corpus_bleu(hyp, ref, key, value)
    tail = "BLEU = %.2f, %.1f/%.1f/%.1f/%.1f (BP=%.3f, ratio=%.3f, hyp_len=%d, ref_len=%d)"
    ratio = F.when(F.col("ref_len") > 0, F.col("hyp_len") / F.col("ref_len")).otherwise(F.lit(0.0))
    args = [c_rounded(F.col("bleu"), 2), *(c_rounded(F.col(f"p{n}"), 1) for n in range(1, 5)), c_rounded(F.col("bp"), 3), c_rounded(ratio, 3), "hyp_len", "ref_len"]
    text = hyp.select(key, F.col(value).alias("_h")).join(ref.select(key, F.col(value).alias("_r")), key)
    lines = s.join(text, key).select(F.col(key).cast("long").alias("order"), F.format_string("%.2f\tline_num:%d\t%s <==> %s\t" + tail, args[0], F.col(key).cast("long"), "_h", "_r", *args).alias("value"))
    return lines.unionByName(d.select(F.lit(-1).cast("long").alias("order"), F.format_string("-1============= Document " + tail + "=============", *args).alias("value")))


def common_grams(n: int):
    """Of two texts the clipped counts of their common character n-grams of 1 to n. A row's n-grams are counted in Python:
    as sorted arrays of strings they took many times as long."""

    def common(a: str, b: str, k: int) -> int:
        x, y = (Counter(t[i : i + k] for i in range(len(t) - k + 1)) for t in (a, b))
        return sum(min(c, y[g]) for g, c in x.items() if g in y)

    @F.pandas_udf("array<long>")
    def run(h: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([[common(a, b, k) for k in range(1, n + 1)] for a, b in zip(h, r)])

    return run


def chrf(hyp: DataFrame, ref: DataFrame, key: str = "sent_id", value: str = "value", n: int = 6, beta: float = 3.0, spaces: bool = False) -> DataFrame:
    """chrf, precision, recall over all sentences: character n-grams 1 to n, orders averaged, 0 where nothing matches.
    A sentence that one side lacks only adds to the other's totals."""
    text = (lambda c: F.trim(c)) if spaces else (lambda c: F.regexp_replace(c, r"[\s\u0085 　]+", ""))
    side = lambda df, name: df.select(key, text(F.coalesce(value, F.lit(""))).alias(name))
    both = side(hyp, "h").join(side(ref, "r"), key, "full_outer").select(F.coalesce("h", F.lit("")).alias("h"), F.coalesce("r", F.lit("")).alias("r"))
    both = both.select("h", "r", common_grams(n)("h", "r").alias("_k"))
    total = lambda c, k: F.coalesce(F.sum(F.greatest(F.length(c) - (k - 1), F.lit(0)).cast("long")), F.lit(0))
    hits = lambda k: F.coalesce(F.sum(F.get("_k", F.lit(k - 1))), F.lit(0))
    orders = range(1, n + 1)
    by = both.agg(*(hits(k).alias(f"correct_{k}") for k in orders), *(total(c, k).alias(f"{c}_{k}") for k in orders for c in "hr"))
    ok = lambda k: (F.col(f"h_{k}") > 0) & (F.col(f"r_{k}") > 0)
    mean = lambda c: sum((F.when(ok(k), F.col(f"correct_{k}") / F.col(f"{c}_{k}")).otherwise(0.0) for k in orders), F.lit(0.0)) / n
    out = by.select(mean("h").alias("precision"), mean("r").alias("recall"))
    b = beta**2
    low = F.lit(b) * F.col("precision") + F.col("recall")
    return out.select(F.when(low > 0, F.lit(1 + b) * F.col("precision") * F.col("recall") / F.when(low > 0, low)).otherwise(F.lit(0.0)).alias("chrf"), "precision", "recall")


def edit_distance(a: Column, b: Column, mode: str = "char") -> Column:
    """Characters by the built-in function. Words by the same function, each word of the two sides written as a character of
    its own; where they are more than ``_CODES``, a row of the distance matrix is folded over the words of b."""
    if mode == "char":
        return F.levenshtein(a, b)
    if mode != "word":
        raise ValueError(mode)

    def matrix(x: Column, y: Column) -> Column:
        def row(prev: Column, w: Column) -> Column:
            # the new row grows from the left; its head is the row number
            def cell(acc: Column, i: Column) -> Column:
                return F.array_append(acc, F.least(F.element_at(prev, i + 1) + 1, F.element_at(acc, -1) + 1, F.element_at(prev, i) + F.when(F.element_at(x, i) == w, 0).otherwise(1)))

            steps = F.when(F.size(x) > 0, F.sequence(F.lit(1), F.size(x))).otherwise(F.array().cast("array<int>"))
            return F.aggregate(steps, F.array(F.element_at(prev, 1) + 1), cell)

        return F.element_at(F.aggregate(y, F.sequence(F.lit(0), F.size(x)), row), -1)

    def coded(words: Column, both: Column) -> Column:
        return F.array_join(F.transform(words, lambda w: F.decode(F.unhex(F.hex(F.array_position(both, w) + 0x2000)), "UTF-16BE")), "")

    def of(p: Column) -> Column:
        near = lambda both: F.when(F.size(both) < _CODES, F.levenshtein(coded(p["a"], both), coded(p["b"], both)))
        return F.coalesce(let(F.array_distinct(F.concat(p["a"], p["b"])), near), matrix(p["a"], p["b"]))

    return let(F.struct(tokens(a).alias("a"), tokens(b).alias("b")), of)


def fuzzy_match(a: Column, b: Column, mode: str = "char") -> Column:
    """1 - distance / the longer length; two empty sides match wholly."""
    longer = F.greatest(F.length(a), F.length(b)) if mode == "char" else F.greatest(F.size(tokens(a)), F.size(tokens(b)))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - edit_distance(a, b, mode) / F.when(longer > 0, longer))
