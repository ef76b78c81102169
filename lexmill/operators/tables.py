"""Operators on whole tables of lines: ordering, cutting, pairing, vocabularies, ids.

Line tables have ``value`` and a position column (``line_no`` unless named). Positions are columns, not physical order, so
positional operators are joins and windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import chars
from lexmill.functions.regex import tokens


def leading_number(c: Column) -> Column:
    """The number at the start of a line, 0 where there is none (``sort -n``)."""
    return F.coalesce(F.regexp_extract(c, r"^\s*(-?[0-9]*\.?[0-9]+)", 1).try_cast("double"), F.lit(0.0))


def sort_keys(value: str = "value", reverse: bool = False, num_sort: bool = False) -> list[Column]:
    keys = [leading_number(F.col(value)), F.col(value)] if num_sort else [F.col(value)]
    return [k.desc() if reverse else k.asc() for k in keys]


def sort(lines: DataFrame, value: str = "value", reverse: bool = False, num_sort: bool = False) -> DataFrame:
    """Whole-line order, by bytes; with ``num_sort`` by the leading number, ties by the line."""
    return lines.orderBy(*sort_keys(value, reverse, num_sort))


def uniq(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct lines: what remains of equal neighbours after a sort."""
    return lines.select(value).distinct()


def uniq_adjacent(lines: DataFrame, value: str = "value", position: str = "line_no", group: Sequence[str] = ()) -> DataFrame:
    """Drops a line equal to the one before it (within ``group``, which should be given: a window without a partition
    is one task)."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(position))
    first = F.row_number().over(Window.partitionBy(*group).orderBy(position)) == 1
    return lines.withColumn("_keep", first | ~F.col(value).eqNullSafe(before)).where("_keep").drop("_keep")


def numbered(df: DataFrame, keys: Sequence[tuple[Column, bool]], name: str = "line_no", start: int = 1, buckets: int = 0) -> DataFrame:
    """Dense global positions in the order of ``keys`` (expression, descending) without one task for all rows.

    Quantile bounds of the first key from a bounded sample cut the rows into buckets; the buckets' sizes (one row each)
    give offsets, and rows are numbered inside their bucket. Bounds are literals, so every evaluation of the plan agrees."""
    spark = df.sparkSession
    first, down = keys[0]
    keyed = df.withColumn("_k", first)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    drawn = sorted(r[0] for r in keyed.where(F.col("_k").isNotNull()).select("_k").orderBy(F.xxhash64("_k")).limit(20 * buckets).distinct().collect())
    bounds = sorted({drawn[len(drawn) * i // buckets] for i in range(1, buckets)}) if drawn else []
    place = sum((F.coalesce(F.col("_k") >= F.lit(b), F.lit(False)).cast("int") for b in bounds), F.lit(0))
    keyed = keyed.withColumn("_b", -place if down else place)
    order = [k.desc() if d else k.asc() for k, d in keys]
    sizes = keyed.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))
    local = keyed.withColumn("_row", F.row_number().over(Window.partitionBy("_b").orderBy(*order)))
    return local.join(F.broadcast(offsets), "_b").withColumn(name, (F.col("_before") + F.col("_row") + F.lit(start - 1)).cast("long")).drop("_k", "_b", "_row", "_before")


def cut_lines(lines: DataFrame, start: int, end: int, keys: Sequence[Column]) -> DataFrame:
    """Lines ``start`` to ``end`` (from 1, both kept) in the order of ``keys``, as a bounded top-k."""
    if not 1 <= start <= end:
        raise ValueError("1 <= start <= end is required")
    top = lines.orderBy(*keys).limit(end)
    if start == 1:
        return top
    return top.withColumn("_row", F.row_number().over(Window.orderBy(*keys))).where(F.col("_row") >= start).drop("_row")


def insert_line(lines: DataFrame, line_num: int, content: str, value: str = "value", position: str = "line_no") -> DataFrame:
    """``content`` before line ``line_num``; later lines move by one."""
    moved = lines.withColumn(position, F.when(F.col(position) >= line_num, F.col(position) + 1).otherwise(F.col(position)))
    row = lines.sparkSession.range(1).select(F.lit(line_num).cast(dict(lines.dtypes)[position]).alias(position), F.lit(content).alias(value))
    return moved.select(position, value).unionByName(row.select(position, value))


def shuffle(lines: DataFrame, seed: int) -> DataFrame:
    """A seeded permutation; the same rows always give the same order."""
    columns = [F.col(c).cast("string") for c in lines.columns]
    return lines.orderBy(F.xxhash64(F.lit(seed), *columns), *columns)


# --- pairs ----------------------------------------------------------------------------------------------------------------


def fields(value: str = "value", delim: str = "\t") -> Column:
    import re

    return F.split(F.col(value), re.escape(delim), -1)


def split_twin(lines: DataFrame, value: str = "value", delim: str = "\t") -> DataFrame:
    """left and right: fields 1 and 2; a line without the delimiter is both, further fields go."""
    f = fields(value, delim)
    whole = ~F.contains(value, F.lit(delim))
    return lines.withColumns({"left": F.when(whole, F.col(value)).otherwise(F.get(f, 0)), "right": F.when(whole, F.col(value)).otherwise(F.get(f, 1))})


def split_twin_strict(lines: DataFrame, value: str = "value", remove: str = "") -> DataFrame:
    """Only rows of exactly two non-empty fields; ``remove`` lists characters that go first."""
    clean = lines.withColumn(value, F.translate(value, remove, "")) if remove else lines
    f = fields(value)
    return clean.where((F.size(f) == 2) & (F.get(f, 0) != "") & (F.get(f, 1) != "")).withColumns({"left": F.get(f, 0), "right": F.get(f, 1)})


def split_twin_clean(lines: DataFrame, value: str = "value") -> DataFrame:
    """The strict split after line separators and control marks are removed."""
    return split_twin_strict(lines, value, chars.LINE_SEPARATORS)


def combine_twin(left: DataFrame, right: DataFrame, on: Sequence[str] = ("line_no",), value: str = "value", delim: str = "\t") -> DataFrame:
    """Lines of equal position joined by the delimiter. Positions without a partner are left out."""
    r = right.select(*on, F.col(value).alias("_right"))
    return left.join(r, list(on)).withColumn(value, F.concat_ws(delim, F.coalesce(value, F.lit("")), F.coalesce("_right", F.lit("")))).drop("_right")


def group_with_tags(files: Sequence[tuple[str, DataFrame]], on: Sequence[str] = ("line_no",), value: str = "value") -> DataFrame:
    """Parallel files as one: each position's lines, each after its tag, separated by line feeds, a blank line at the
    end. Positions whose first (source) line is blank are left out; a missing line raises by being absent: only full
    positions appear."""
    out = None
    for i, (_, df) in enumerate(files):
        own = df.select(*on, F.col(value).alias(f"_v{i}"))
        out = own if out is None else out.join(own, list(on))
    text = F.concat_ws("\n", *(F.concat(F.lit(tag), F.col(f"_v{i}")) for i, (tag, _) in enumerate(files)), F.lit(""))
    return out.where(F.trim("_v0") != "").select(*on, text.alias(value))


def three_way_dictionary(words: DataFrame, first: DataFrame, second: DataFrame, on: Sequence[str] = ("line_no",), value: str = "value") -> DataFrame:
    """word and translation where two translations agree and differ from the word."""
    a = words.select(*on, F.col(value).alias("word")).join(first.select(*on, F.col(value).alias("translation")), list(on)).join(second.select(*on, F.col(value).alias("_other")), list(on))
    return a.where((F.col("translation") == F.col("_other")) & (F.col("word") != F.col("translation"))).select(*on, "word", "translation")


def char_length(c: Column) -> Column:
    """Words, but each character of a word that starts with a Chinese character."""
    sizes = F.transform(tokens(c), lambda w: F.when(w.rlike(f"^[{chars.CHINESE}]"), F.length(w)).otherwise(1))
    return F.aggregate(sizes, F.lit(0), lambda a, n: a + n)


def length_balanced(pairs: DataFrame, left: str = "left", right: str = "right", min_ratio: float = 0.5, max_ratio: float = 2.0, left_mode: str = "word", right_mode: str = "word") -> DataFrame:
    """Adds ``balanced``: left * min <= right <= left * max. Rows missing a side are not balanced."""
    size = lambda c, mode: char_length(F.col(c)) if mode == "char" else F.size(tokens(F.col(c)))
    n, m = size(left, left_mode), size(right, right_mode)
    return pairs.withColumn("balanced", F.coalesce((m >= n * F.lit(min_ratio)) & (m <= n * F.lit(max_ratio)), F.lit(False)))


# --- vocabularies -----------------------------------------------------------------------------------------------------


def word_counts(lines: DataFrame, value: str = "value", skip_words: Iterable[str] = ()) -> DataFrame:
    """word, freq. Counts are summed per task before they move."""
    words = lines.select(F.explode(tokens(F.col(value))).alias("word"))
    skip = list(skip_words)
    return (words.where(~F.col("word").isin(skip)) if skip else words).groupBy("word").agg(F.count("*").alias("freq"))


def character_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """char, freq; every line adds one line feed."""
    letters = F.filter(F.split(value, ""), lambda x: x != "")
    return lines.where(F.col(value).isNotNull()).select(F.explode(F.concat(letters, F.array(F.lit("\n")))).alias("char")).groupBy("char").agg(F.count("*").alias("freq"))


def vocabulary(lines: DataFrame, size: int, headers: Sequence[str] = ("_UNK",), value: str = "value", skip_words: Iterable[str] = ()) -> DataFrame:
    """id, word, freq: the headers, then the most frequent words (ties by descending word, as ``sort -r -n`` of lines of
    count and word), ``size`` rows in all, ids from 0. Only the top of the order reaches one task."""
    spark = lines.sparkSession
    counts = word_counts(lines, value, skip_words)
    room = max(size - len(headers), 0)
    keys = [F.desc("freq"), F.desc("word")]
    top = counts.orderBy(*keys).limit(room)
    ranked = top.withColumn("id", (F.row_number().over(Window.orderBy(*keys)) + F.lit(len(headers) - 1)).cast("long"))
    head = spark.createDataFrame([(i, w, 0) for i, w in enumerate(headers)], "id long, word string, freq long")
    return head.where(F.col("id") < size).unionByName(ranked.select("id", "word", "freq"))


def words_to_ids(lines: DataFrame, vocab: DataFrame, keys: Sequence[str], value: str = "value", unknown: str = "_UNK", small: int = 64 << 20) -> DataFrame:
    """Ids of each line's words joined by blanks; unknown words take the id of ``unknown``, which must be listed."""
    unk = vocab.where(F.col("word") == unknown).agg(F.min("id")).first()[0]
    if unk is None:
        raise KeyError(unknown)
    v = vocab.groupBy("word").agg(F.max("id").alias("id"))
    return by_word(lines, v, keys, F.coalesce("id", F.lit(unk)).cast("string"), value, small)


def ids_to_words(lines: DataFrame, words: Sequence[str], value: str = "value") -> DataFrame:
    """The inverse, from a list in id order; negative ids count from the end, as list indexes do."""
    held = F.array(*map(F.lit, words))
    at = lambda i: F.when(i >= 0, i + 1).otherwise(i)
    return lines.withColumn(value, F.array_join(F.transform(tokens(F.col(value)), lambda t: F.try_element_at(held, at(t.cast("int")))), " "))


def by_word(lines: DataFrame, table: DataFrame, keys: Sequence[str], found: Column, value: str = "value", small: int = 64 << 20) -> DataFrame:
    """Each line's words replaced by ``found`` (of ``word`` and the table's other columns, null where the table lacks the
    word), joined by blanks. A table of at most ``small`` bytes, counted, is broadcast and no word moves; beyond that only
    the DISTINCT words meet the table, so a very common word is one row there, and the answers go back by word, where
    the skew join can split it."""
    words = lines.select(*keys, F.posexplode_outer(tokens(F.col(value))).alias("at", "word"))
    size = table.agg(F.coalesce(F.sum(F.octet_length("word") + 48), F.lit(0)).alias("b")).first()["b"]
    if size <= small:
        out = words.join(F.broadcast(table), "word", "left").withColumn("word", found)
    else:
        answers = words.select("word").distinct().join(table, "word", "left").select(F.col("word").alias("_own"), found.alias("_new"))
        out = words.join(answers, F.col("word") == F.col("_own"), "left").withColumn("word", F.col("_new"))
    entry = F.when(F.col("at").isNotNull(), F.struct("at", "word"))
    return out.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_w")).select(*keys, F.array_join(F.transform("_w", lambda e: e["word"]), " ").alias(value))


def break_unknown_words(lines: DataFrame, vocab: DataFrame, keys: Sequence[str], value: str = "value", entity_safe: bool = False) -> DataFrame:
    """The vocabulary break as a join, for vocabularies of any size."""
    from lexmill.operators.lines import broken, is_entity

    known = vocab.select("word").distinct().withColumn("_known", F.lit(True))
    own = F.col("word")
    return by_word(lines, known, keys, F.when(F.col("_known") | (F.lit(entity_safe) & is_entity(own)), own).otherwise(broken(own)), value)


def char_ngrams(lines: DataFrame, shortlist: DataFrame, keys: Sequence[str], n: int = 2, separator: str = "@@", value: str = "value") -> DataFrame:
    """Words outside the shortlist in pieces of n characters joined by the separator."""
    known = shortlist.select("word").distinct().withColumn("_known", F.lit(True))
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length("word") - 1) / n).cast("int")), lambda i: F.substr(F.col("word"), i * n + 1, F.lit(n)))
    return by_word(lines, known, keys, F.when(F.col("_known"), F.col("word")).otherwise(F.array_join(pieces, separator + " " if not separator.endswith(" ") else separator)), value)


def probability_lists(table: DataFrame) -> DataFrame:
    """lw, words: the right words of each left word by falling probability (ties by word). A repeated pair keeps its
    last entry, ``line_no`` deciding."""
    return _last(table).groupBy("lw").agg(F.sort_array(F.collect_list(F.struct((-F.exp("logp")).alias("p"), "rw"))).alias("_e")).select("lw", F.transform("_e", lambda e: e["rw"]).alias("words"))


def probability_maps(table: DataFrame) -> DataFrame:
    """lw, probs: map of right word to probability."""
    return _last(table).groupBy("lw").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rw", F.exp("logp").alias("p"))))).alias("probs"))


def _last(table: DataFrame) -> DataFrame:
    return table.groupBy("lw", "rw").agg(F.max_by("logp", "line_no").alias("logp"))


def file_paragraphs(lines: DataFrame, position: str = "line_no", value: str = "value", part: int = 100_000) -> DataFrame:
    """The paragraphs of one long file: position (dense, from 0) and value. Blank lines are counted inside parts of the
    positions, one row a part gives the counts before it, and only a paragraph's own lines meet in one task."""
    blank = F.trim(F.coalesce(value, F.lit(""))) == ""
    own = lines.select(position, value, blank.alias("_blank"), F.floor(F.col(position) / part).alias("_part"))
    counts = own.groupBy("_part").agg(F.sum(F.col("_blank").cast("long")).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # one row for so many lines
    running = F.sum(F.col("_blank").cast("long")).over(Window.partitionBy("_part").orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    text = own.withColumn("_in", running).join(F.broadcast(before), "_part").where("not _blank").groupBy((F.col("_in") + F.col("_before")).alias("_island"))
    joined = text.agg(F.sort_array(F.collect_list(F.struct(position, F.col(value).alias("v")))).alias("_l")).select("_island", F.array_join(F.transform("_l", lambda e: e["v"]), " ").alias(value))
    return numbered(joined, [(F.col("_island"), False)], position, start=0).select(position, value)


# --- documents of lines -----------------------------------------------------------------------------------------------


def paragraphs(lines: DataFrame, doc: str = "doc_id", position: str = "line_no", value: str = "value") -> DataFrame:
    """Runs of non-blank lines joined by blanks: doc, paragraph (from 0), value. The last paragraph needs no blank line
    after it."""
    blank = F.trim(F.coalesce(value, F.lit(""))) == ""
    island = F.sum(blank.cast("int")).over(Window.partitionBy(doc).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    own = lines.withColumn("_blank", blank).withColumn("_island", island).where("not _blank")
    text = own.groupBy(doc, "_island").agg(F.sort_array(F.collect_list(F.struct(position, F.col(value).alias("v")))).alias("_l"))
    rank = F.dense_rank().over(Window.partitionBy(doc).orderBy("_island")) - 1
    return text.select(doc, rank.cast("long").alias("paragraph"), F.array_join(F.transform("_l", lambda e: e["v"]), " ").alias(value))
