"""Phrase tables: filters with reasons, probabilities, merging, packing and output formats.

A table has src, tgt, lexw (two lexical weights), prob (two probabilities) and freq.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import chars
from lexmill.functions.regex import tokens
from lexmill.operators.blocks import word_pair_counts
from lexmill.operators.scoring import c_rounded, ngrams

# Thresholds, word and punctuation lists of the filter rules.
THRESHOLDS = {"multi_src_th": 0.5, "multi_trg_th": 0.5, "ptr_sum_th": 1.2, "ptr_src_th": 0.5, "ptr_trg_th": 0.5, "ratio_bound": 2.5}
ENGLISH_MARKS = ',.?!;:"'
START_MARKS = ",.?!;:}])" + "，。？！：；、’”》〉）…─～—·．」』〕】□→×▲●〜"
EN_BRACKETS = {"}": "{", "]": "[", ")": "(", ">": "<"}
ZH_BRACKETS = {"）": "（", "》": "《", "】": "【", "〉": "〈", "」": "「", "』": "『", "〕": "〔"}


def _any(marks: str) -> str:
    return "[" + "".join("\\" + m for m in marks) + "]"


def mismatched(c: Column, brackets: Mapping[str, str]) -> Column:
    """Brackets don't nest: a stack held as a string; a closing mark without its partner poisons it."""
    only = F.regexp_replace(c, "[^" + "".join("\\" + m for m in [*brackets, *brackets.values()]) + "]", "")
    marks = F.filter(F.split(only, ""), lambda x: x != "")

    def step(s: Column, x: Column) -> Column:
        out = F.concat(s, F.when(x.isin(list(brackets)), F.lit("!")).otherwise(x))
        for close, open_ in brackets.items():
            out = F.when((x == close) & (F.right(s, F.lit(1)) == open_), F.left(s, F.length(s) - 1)).otherwise(out)
        return F.when(F.contains(s, F.lit("!")), s).otherwise(out)

    return F.aggregate(marks, F.lit(""), step) != ""


def reasons(th: Mapping[str, float]) -> list[tuple[str, Column]]:
    """(name, condition) of the fourteen rules, in the order in which the first that holds names the reason."""
    src, tgt, p1, p2 = F.col("src"), F.col("tgt"), F.col("prob")[0], F.col("prob")[1]
    n, m = F.size(tokens(src)), F.size(tokens(tgt))
    blank = lambda c: ~c.rlike(f"[^{chars.STRIPPED}]")  # noqa: E731  no words, seen without cutting them
    multi = F.when(F.col("tgt_rows") > 1, p2 <= th["multi_trg_th"]).when(F.col("src_rows") > 1, p1 <= th["multi_src_th"]).otherwise(F.lit(False))
    return [
        ("empty", blank(src) | blank(tgt)),
        ("multi_align", multi),
        ("en_no_en", ~src.rlike("[A-Za-z]")),
        ("zh_no_zh", ~tgt.rlike(f"[{chars.CHINESE}]")),
        ("en_has_zhPunc", src.rlike(f"[{chars.CHINESE_PUNCTUATION}]")),
        ("zh_has_enPunc", tgt.rlike(_any(ENGLISH_MARKS))),
        ("start_with_Punc", src.rlike("^" + _any(START_MARKS)) | tgt.rlike("^" + _any(START_MARKS))),
        ("zh_start_with_special", tgt.rlike("^[了的]")),
        ("en_end_with_special", src.endswith("the")),
        ("en_paren_mismatch", mismatched(src, EN_BRACKETS) | mismatched(tgt, EN_BRACKETS)),
        ("zh_paren_mismatch", mismatched(tgt, ZH_BRACKETS)),
        ("ptr_sum_low", p1 + p2 < th["ptr_sum_th"]),
        ("ptr_or_low", (p1 < th["ptr_src_th"]) | (p2 < th["ptr_trg_th"])),
        ("lexicalW_zero", (F.col("lexw")[0] == 0) | (F.col("lexw")[1] == 0)),
        ("len_diff", F.greatest(n, m) / F.when(F.least(n, m) > 0, F.least(n, m)) >= th["ratio_bound"]),
    ]


def judged(table: DataFrame, rules: list[str] | None = None, **thresholds: float) -> DataFrame:
    """Adds ``reason``: the first rule that drops the row, null for rows that stay. An empty phrase is dropped. When both
    sides occur several times the target's rule decides."""
    th = THRESHOLDS | thresholds
    rows = lambda side: F.count("*").over(Window.partitionBy(side))
    sized = table.withColumn("tgt_rows", rows("tgt")).withColumn("src_rows", rows("src"))
    reason = F.coalesce(*(F.when(cond, F.lit(name)) for name, cond in reasons(th) if rules is None or name in rules or name == "empty"))
    return sized.withColumn("reason", reason).drop("src_rows", "tgt_rows")


def reason_counts(table: DataFrame) -> DataFrame:
    return table.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def length_histogram(table: DataFrame) -> DataFrame:
    """side, length, n of the rows that stay."""
    kept = table.where(F.col("reason").isNull())
    both = kept.select(F.explode(F.array(F.struct(F.lit("src").alias("side"), F.size(tokens(F.col("src"))).alias("length")), F.struct(F.lit("tgt").alias("side"), F.size(tokens(F.col("tgt"))).alias("length")))).alias("e"))
    return both.groupBy("e.side", "e.length").agg(F.count("*").alias("n"))


def with_probabilities(table: DataFrame) -> DataFrame:
    """prob = freq over the frequency of each side; rows by falling frequency when written. Windows read the table once
    (joins with the sums of a side read it three times); a phrase's rows, one for each of its partners, spill."""
    share = lambda side: F.col("freq") / F.sum("freq").over(Window.partitionBy(side))
    return table.drop("prob").where("src is not null and tgt is not null").withColumn("prob", F.array(share("src"), share("tgt")))


def merged(tables: list[DataFrame]) -> DataFrame:
    """Equal phrase pairs of several tables summed; the weights of the first table that has the pair stay."""
    out = None
    for i, t in enumerate(tables):
        own = t.select("src", "tgt", "lexw", "freq").withColumn("_no", F.lit(i))
        out = own if out is None else out.unionByName(own)
    return with_probabilities(out.groupBy("src", "tgt").agg(F.min_by("lexw", "_no").alias("lexw"), F.sum("freq").alias("freq")))


def lexical_weights(table: DataFrame, corpus: DataFrame) -> DataFrame:
    """Adds lexw from a sentence corpus (src, tgt): for each word of one side the largest p(word | word of the other
    side) from sentence co-occurrence, multiplied over the phrase."""
    numbered = corpus.select(F.lit(0).alias("k"), F.array_distinct(tokens(F.col("src"))).alias("s"), F.array_distinct(tokens(F.col("tgt"))).alias("t"))
    # only word pairs within a phrase are counted, in blocks of target words: the corpus has many more
    needed = table.select(F.explode(tokens(F.col("src"))).alias("x"), tokens(F.col("tgt")).alias("b")).select("x", F.explode("b").alias("y")).distinct()
    pairs = word_pair_counts(numbered, needed)
    fx = numbered.select(F.explode("s").alias("x")).groupBy("x").agg(F.count("*").alias("nx"))
    fy = numbered.select(F.explode("t").alias("y")).groupBy("y").agg(F.count("*").alias("ny"))
    lex = pairs.join(fx, "x").join(fy, "y").select("x", "y", (F.col("c") / F.col("nx")).alias("y_x"), (F.col("c") / F.col("ny")).alias("x_y"))

    def side(of: str, given: str, word: str, other: str, p: str) -> DataFrame:
        each = table.select("src", "tgt", F.posexplode(tokens(F.col(of))).alias("at", word)).join(table.select(F.col("src").alias("_a"), F.col("tgt").alias("_b")).distinct(), (F.col("src") == F.col("_a")) & (F.col("tgt") == F.col("_b")))
        each = each.select("src", "tgt", "at", word, F.explode(tokens(F.col(given))).alias(other)).join(lex, [word, other], "left")
        best = each.groupBy("src", "tgt", "at").agg(F.max(F.coalesce(p, F.lit(0.0))).alias("p"))
        return best.groupBy("src", "tgt").agg(F.aggregate(F.sort_array(F.collect_list("p")), F.lit(1.0), lambda a, v: a * v).alias(f"w_{of}"))

    a, b = side("src", "tgt", "x", "y", "x_y"), side("tgt", "src", "y", "x", "y_x")
    return table.drop("lexw").join(a, ["src", "tgt"], "left").join(b, ["src", "tgt"], "left").withColumn("lexw", F.array("w_tgt", "w_src")).drop("w_src", "w_tgt")


# --- post-processing --------------------------------------------------------------------------------------------------


def parsed_moses(lines: DataFrame, value: str = "value") -> DataFrame:
    """lw, rw, p (the third score) of ``a ||| b ||| s1 s2 s3 ...`` lines."""
    f = F.split(value, r"\|\|\|")
    scores = F.split(F.trim(F.get(f, 2)), r"\s+")
    return lines.where((F.size(f) >= 3) & (F.size(scores) >= 3)).select(F.trim(F.get(f, 0)).alias("lw"), F.trim(F.get(f, 1)).alias("rw"), F.get(scores, 2).cast("double").alias("p"))


def packed(table: DataFrame, max_gram: int = 4, min_prob: float = 0.0) -> DataFrame:
    """lw, n, words: for phrases of 1 to max_gram words the aligned words (sorted) that are not already aligned to a
    shorter part of the phrase; phrases all of whose words are covered go. One pass a phrase length."""
    rows = table.where(F.col("p") >= min_prob).select("lw", tokens(F.col("lw")).alias("l"), tokens(F.col("rw")).alias("r"))
    rows = rows.withColumn("n", F.size("l")).where((F.col("n") >= 1) & (F.col("n") <= max_gram))
    sets = rows.groupBy("lw", "n").agg(F.first("l").alias("l"), F.array_distinct(F.flatten(F.collect_set("r"))).alias("r"))
    done = sets.where("n = 1").select("lw", "n", F.array_sort("r").alias("words"))
    for n in range(2, max_gram + 1):
        own = sets.where(F.col("n") == n)
        parts = F.array_distinct(F.flatten(F.array(*(ngrams(F.col("l"), k) for k in range(1, n)))))
        sub = own.select("lw", F.explode(parts).alias("part")).join(done.select(F.col("lw").alias("part"), "words"), "part").groupBy("lw").agg(F.array_distinct(F.flatten(F.collect_set("words"))).alias("covered"))
        left = own.join(sub, "lw", "left").select("lw", "n", F.array_sort(F.array_except("r", F.coalesce("covered", F.array().cast("array<string>")))).alias("words"))
        done = done.unionByName(left.where(F.size("words") > 0))
    return done


def alignment_update(old: DataFrame, new: DataFrame, key: str = "lw", items: str = "words") -> DataFrame:
    """Union of two dictionaries of lists: for shared keys new items that are missing are appended in their order."""
    none = F.array().cast("array<string>")
    both = old.select(key, F.col(items).alias("_o")).join(new.select(key, F.col(items).alias("_n")), key, "full_outer")
    return both.select(key, F.when(F.col("_o").isNull(), F.col("_n")).otherwise(F.concat(F.col("_o"), F.array_except(F.coalesce("_n", none), "_o"))).alias(items))


# --- output formats ---------------------------------------------------------------------------------------------------


def printed(x: Column, digits: int) -> Column:
    """``x``, or what C prints for it where that may not be what Java prints: next to a half."""
    y = x * float(10**digits)
    return F.when(F.abs(y - F.floor(y) - 0.5) < 1e-6, c_rounded(x, digits)).otherwise(x)


def _numbers(c: str, form: str, rounded=printed) -> Column:
    """The numbers of ``c`` by blanks, each ``rounded`` to the digits of ``form`` (6 by default) before Java prints it."""
    digits = int(m[1]) if (m := re.search(r"\.(\d+)", form)) else 6
    return F.array_join(F.transform(c, lambda p: F.format_string(form, rounded(p, digits))), " ")


def half_up(x: Column, digits: int) -> Column:
    """As SQL rounds: the product with the power of ten, halves away from zero. Java's formatter and Spark's ``round`` go by
    the shortest decimal form, which calls 0.565 a half where the product is 56.49999999999999."""
    return F.round(x * float(10**digits)) / float(10**digits)


def plain_lines(table: DataFrame, form: str = "%f") -> DataFrame:
    return table.select(F.concat_ws("\t", "src", "tgt", _numbers("lexw", form), _numbers("prob", form, half_up), F.col("freq").cast("string")).alias("value"))


def moses_lines(table: DataFrame, form: str = "%f") -> DataFrame:
    """Phrases by bars, all scores in one field with e at the end; the frequency goes."""
    return table.select(F.concat(F.concat_ws(" ||| ", "src", "tgt"), F.lit(" |||"), F.when(F.size("lexw") > 0, F.concat(F.lit(" "), _numbers("lexw", form))).otherwise(F.lit("")), F.lit(" "), _numbers("prob", form, half_up), F.lit(" 2.718")).alias("value"))


def escaped(c: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def tmx_lines(table: DataFrame, languages: tuple[str, ...] = (), form: str = "%f") -> DataFrame:
    """One translation unit a row; phrases beyond the named languages get numbered names. Header and footer are rows
    ``TMX_HEAD`` and ``TMX_FOOT``."""
    names = [*languages, *(f"_lang{i}_" for i in range(len(languages) + 1, 3))]
    props = [F.concat(F.lit(f' <prop type="{k}">'), c, F.lit("</prop>")) for k, c in (("freq", F.col("freq").cast("string")), ("probas", _numbers("prob", form, half_up)), ("lexWeights", _numbers("lexw", form)))]
    units = [F.concat(F.lit(f' <tuv xml:lang="{n}"><seg>'), escaped(F.col(c)), F.lit("</seg></tuv>")) for n, c in zip(names, ("src", "tgt"))]
    return table.select(F.concat_ws("\n", F.lit("<tu>"), *props, *units, F.lit("</tu>")).alias("value"))


TMX_HEAD = '<?xml version="1.0"?>\n<tmx version="1.4">\n<header creationtool="lexmill" creationtoolversion="1" datatype="plaintext" segtype="phrase" adminlang="en-us" srclang="*all*" o-tmf="none" />\n<body>'
TMX_FOOT = "</body>\n</tmx>"


def html_rows(table: DataFrame) -> DataFrame:
    """A table row for each pair, by falling frequency: number, frequency, probabilities and weights to two decimals,
    cells coloured by the frequency's logarithm and the scores' geometric means."""
    order = [F.desc("freq"), "src", "tgt"]
    top = table.agg(F.max("freq").alias("_top"))
    numbered = table.withColumn("_no", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(top))  # one row
    mean = lambda c: F.aggregate(c, F.lit(1.0), lambda a, v: a * v, lambda a: F.pow(a, F.lit(1.0) / F.size(c)))
    red = F.floor(255 * (1 - F.when(F.col("_top") > 1, F.ln("freq") / F.ln("_top")).otherwise(F.lit(1.0)))).cast("string")
    green = F.floor(255 * (1 - mean("prob"))).cast("string")
    blue = F.floor(128 + 128 * (1 - mean("lexw"))).cast("string")
    two = lambda c: F.array_join(F.transform(c, lambda p: F.format_string("%.2f", p)), "&nbsp;")
    cell = lambda color, text: F.concat(F.lit(' <td class="n" style="background-color:rgb('), color, F.lit(')">'), text, F.lit("</td>"))
    cells = [
        F.concat(F.lit(' <td class="n">'), F.col("_no").cast("string"), F.lit("</td>")), cell(F.concat_ws(",", F.lit("255"), red, red), F.col("freq").cast("string")), cell(F.concat_ws(",", green, F.lit("255"), green), two("prob")),
        cell(F.concat_ws(",", blue, blue, F.lit("255")), two("lexw")), *(F.concat(F.lit(" <td>"), escaped(F.col(c)), F.lit("</td>")) for c in ("src", "tgt")),
    ]
    return numbered.select(F.concat_ws("\n", F.lit("<tr>"), *cells, F.lit("</tr>")).alias("value"))
