"""Queries over the driver's tables for the library's operators, each with its DuckDB oracle where SQL has one.

Line operators run over every line of ``documents`` and over ``SAMPLES``, lines made to meet the rules (the tables have no
Chinese). Pairs are neighbouring turns of ``conversations``; phrase tables are neighbouring words of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill import plans
from lexmill.functions import chars, patterns
from lexmill.functions.regex import duck_replace, sql_text, tokens
from lexmill.operators import alignment, aligner, documents, lines, phrases, replacer, scoring, subword, tables, tokenizer
from lexmill.sources import column_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SAMPLES = [
    "1. First item", "(iv) second", "a.b.c third", "• bullet", "②] odd", "①enclosed", "12. 3, hello", "2019 was", "1999.5 x", "'quoted' it's the dogs' toy 'x", "d'Or 'x' cats' a''b '' s''t", "He said ‘no’ and `yes`", "use?sanctions and a?b?c",
    "one ?.?.?. ? two . . . three ?.?.", "see http://example.com/a?b=1#c and www.test.org now foo.net/x", "tel 0123-456 789", "full ＡＢＣ１２３，．￥ width　space", "a - - b __ c -----", "x\t  ", "\tright", "left\tright", "left\t", "A", "",
    "(nested [ok] \"q\" “z”)", "(broken ]", "a(b", "no parens", "<B>w <M>o <M>r <E>d x", "lo@@ wer ne@@ west", "_low er_x", "price $5 million, USD100 and eur1,000.50 bn or rmb3m", "3kg and 1,200.5ml of 10m", "wow!!! what??? ...,, --- ——", "\"—“”《》\" - x — y",
    "1,234 people, 1 234 567 more and 12 of 3.5 bn with 1000", "5 million 6bn 70 trillion 8 tn", "Well-known state-of-the-art - test", "a <-> b", "The European Union and NATO met in Paris today", "中文 line", "纯中文句子。", "一、项目", "（二）项目", "3.5亿元", "1,000万美元和2亿 3 万亿", "5月 10 日 300 人",
    "他说：“你好。”然后走了！真的？", "内尔森?坦努尔•张·李", "注（译者注）和(abc译者注)", "图为工作人员", "试图成功", "‘s is’ ‘x’", "，，。。！！？？；；", "A B c d 中 文 e", "中文abc中文 def", "你好，world！(ok) a,b:c;d?e~...", "mixed 中 文 字 ab 词", "<N>31</N> and <X>zz</X>", "&lt; n &gt; 31 32 &lt; / n &gt; x",
    "Fish &amp; chips &lt;b&gt; &#39;x&#39;", "email me@x.org or a.b@c.de now", "U.S. troops vs. Dr. Smith met No. 5 on Jan. 3. \"Yes,\" he said.", "It's 5,300 or A,B,C's dogs' and 1990's...", "l'homme d'or", "[a] | b & c > d < e", "THE cat. the end... really? Yes.",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one of few row groups, which few tasks would read, is spread over all cores (a shuffle of 256 MB
    at most, by the size the plan knows; larger tables stay where they are)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in {"documents", "conversations"} or df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 256 << 20:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spark.createDataFrame([(-1, i, v) for i, v in enumerate(SAMPLES)], "doc_id long, line_no int, value string")
    return column_lines(table(spark, sf_dir, "documents")).unionByName(made)


_VALUES = ", ".join(f"({i}, {sql_text(v)})" for i, v in enumerate(SAMPLES))
LINES_SQL = f"""lines AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, l[i] AS value FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
UNION ALL SELECT CAST(-1 AS BIGINT), CAST(i AS INTEGER), v FROM (VALUES {_VALUES}) AS t(i, v))"""
_STRIP = f"[{chars.STRIPPED}]".replace("\\s", " \\t\\n\\f\\r\\x0b")


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, {sql_text(f'^{_STRIP}+|{_STRIP}+$')}, '', 'g')"


def tokens_sql(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {sql_text(_STRIP + '+')}), lambda w: w <> '')"


def add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def kept_lines(own: DataFrame, op: Callable[[Column], Column]) -> DataFrame:
    """The lines that ``op`` keeps. Exploding what is left evaluates ``op`` once; a filter on its column would be pushed
    below it and evaluate it again."""
    return own.select("doc_id", "line_no", F.explode(F.filter(F.array(op(F.col("value"))), lambda v: v.isNotNull())).alias("value"))


def add_line(language: str, rule: str, sql: str | None = None, **params) -> None:
    """A line operator's kept lines. ``sql`` is an expression over v."""
    name = f"line_{language}_{rule.lower()}"

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        op = lines.get(language, rule, **params)
        return kept_lines(all_lines(spark, sf_dir), op)

    add(name, query, sql and f"WITH {LINES_SQL}, own AS (SELECT doc_id, line_no, {sql} AS value FROM (SELECT doc_id, line_no, value AS v FROM lines WHERE value <> '')) SELECT doc_id, line_no, value FROM own WHERE value <> ''")


# --- line operators ---------------------------------------------------------------------------------------------------

for _language, _rule in lines.SUBSTITUTIONS:
    add_line(_language, _rule, lines.duck_substitutions(_language, _rule, "v"))


def _keep(condition: str) -> str:
    return f"CASE WHEN {condition} THEN v END"


def _map_sql(e: str, src: str, dst: str) -> str:
    return f"translate({e}, {sql_text(src)}, {sql_text(dst)})"


def _chain_sql(e: str, steps: list[tuple[str, str]]) -> str:
    return reduce(lambda x, s: duck_replace(x, s[0], s[1], False), steps, e)


_ZH = f"[{chars.CHINESE}]"
_ZH_MARK = f"[{chars.CHINESE}{chars.CHINESE_PUNCTUATION}]"
_ALLOWED = chars.ALLOWED.replace("[", "\\[")
add_line("common", "FullWidth_To_Halfwidth", _map_sql(strip_sql("v"), chars.FULL_WIDTH, chars.HALF_WIDTH))
add_line("common", "To_Lower", "lower(v)")
add_line("common", "Remove_Add_Line_Char", "replace(v, chr(8232), '')")
add_line("en", "Capitalize", "upper(v[1]) || v[2:]")
add_line("zh", "Replace_English_Punctuation", f"replace({_map_sql(strip_sql('v'), '!(),:;?~', '！（），：；？～')}, '...', '……')")
add_line("zh", "Convert_Traditional_To_Simplified", "translate(v, '項員萬億', '项员万亿')", table={"項": "项", "員": "员", "萬": "万", "億": "亿"})
add_line("common", "BPE_Recover", "replace(v, '@@ ', '')")
add_line("common", "BPE_Recover_v2", duck_replace("replace(v, ' ', '')", "_(.)", r" \1", False))
add_line("common", "Replace_Content", duck_replace("v", "([a-e])o", r"\1-", False), pattern="([a-e])o", repl=r"\1-")
add_line("en", "Remove_Contain_Chinese", _keep(f"NOT regexp_matches(v, '{_ZH}')"))
add_line("zh", "Remove_Not_Contain_Chinese", _keep(f"regexp_matches(v, '{_ZH}')"))
add_line("en", "Remove_Not_Contain_Number_Or_Aphabet", _keep("regexp_matches(v, '[A-Za-z0-9]')"))
add_line("en", "Remove_Line_With_No_Punct_Ending", _keep("regexp_matches(v, '[,.;:\"?!]$')"))
add_line("en", "Remove_Line_Less_Char", _keep("length(regexp_replace(v, '[a-zA-Z ,!?]', '', 'g')) / length(v) <= 0.5"))
add_line("zh", "Remove_Line_Less_Char", _keep(f"length(regexp_replace(v, '{_ZH}', '', 'g')) / length(v) <= 0.7"))
add_line("common", "Remove_Lines_With_Content", _keep("NOT regexp_matches(v, 'tion.*the')"), content="tion.*the")
add_line("common", "Filter_Sentence_With_Illegal_Chars", _keep(f"NOT contains({strip_sql('v')}, chr(8232)) AND NOT regexp_matches({strip_sql('v')}, {sql_text(f'[^{_ALLOWED}]')})"))
_PAIRS = "[" + ", ".join(map(sql_text, chars.PAIRS)) + "]"
add_line("common", "Pair_Punctuation_Close_Check", _keep(f"list_reduce(list_prepend('', list_filter(string_split(v, ''), lambda x: contains({sql_text(''.join(chars.PAIRS))}, x))), lambda s, x: CASE WHEN list_contains({_PAIRS}, right(s, 1) || x) THEN s[:-2] ELSE s || x END) = ''"))
add_line("common", "Remove_Single_Quotation_v2", _chain_sql(strip_sql("v"), [("([sS])'+", "\\1\ue000"), *[("([A-Za-z>])'+([A-Za-z])", "\\1\ue000\\2")] * 2, ("'", ""), ("\ue000", "'"), ("[‘’`]", "")]))
add_line("zh", "Remove_Bullet_v2", duck_replace(f"CASE WHEN regexp_matches({strip_sql('v')}, '^[0-9]+\\.[0-9]') THEN {strip_sql('v')} ELSE {duck_replace(strip_sql('v'), patterns.CHINESE_BULLETS, '')} END", patterns.CHINESE_SYMBOL_BULLETS, "", False))
add_line("zh", "Remove_Chinese_Number_Unit_After_Number_Entity", reduce(lambda e, u: duck_replace(e, rf"N\s*{u}", "N"), ("万亿", "万", "亿"), "v"))
add_line("en", "Split_Compound_Word", f"CASE WHEN contains(v, '-') THEN array_to_string(flatten(list_transform({tokens_sql('v')}, lambda w: CASE WHEN length(w) > 1 AND contains(w, '-') THEN list_filter(string_split(replace(w, '-', chr(1) || '<->' || chr(1)), chr(1)), lambda p: p <> '') ELSE [w] END)), ' ') ELSE v END", connector_tag="<->")
add_line("en", "Restore_Compound_Word", "replace(v, ' <-> ', '-')", connector_tag="<->")
add_line("zh", "Separate_Chinese_Char", f"array_to_string(list_filter(string_split(regexp_replace({strip_sql('v')}, {sql_text(f'({_ZH_MARK})')}, ' \\1 ', 'g'), ' '), lambda w: w <> ''), ' ')")
_RECOVER = f"regexp_matches(w, {sql_text(f'^{_ZH_MARK}$')})"
add_line("zh", "Recover_Separated_Chinese_Char", f"array_to_string(list_transform(list_filter(string_split({strip_sql('v')}, ' '), lambda w: w <> ''), lambda w, i: CASE WHEN i = 1 OR {_RECOVER} OR regexp_matches(list_filter(string_split({strip_sql('v')}, ' '), lambda w: w <> '')[i - 1], {sql_text(f'^{_ZH_MARK}$')}) THEN w ELSE ' ' || w END), '')")
_VOC = ["the", "of", "and", "de", "la", "in"]
_BROKEN = "array_to_string(list_transform(string_split(w, ''), lambda x, i: CASE WHEN i = 1 THEN '<B>' WHEN i = length(w) THEN '<E>' ELSE '<M>' END || x), ' ')"
add_line("common", "BD_Break_Line", f"array_to_string(list_transform({tokens_sql('v')}, lambda w: CASE WHEN list_contains({_VOC}, w) THEN w ELSE {_BROKEN} END), ' ')", voc=_VOC)
add_line("zh", "Replace_Words_Per_Dict", f"array_to_string(list_transform({tokens_sql('v')}, lambda w: CASE w WHEN 'the' THEN 'The' WHEN 'of' THEN 'OF' ELSE w END), ' ')", words=["The", "OF"])
add_line("zh", "Replace_Lower_Char_To_Upper_Word_Line", words=["The", "NATO"])
add_line("zh", "Find_Word_Entity", table={"the": "THE", "NATO": "N.A.T.O."})
add_line("common", "Replace_HTML_Entities")
add_line("en", "Catch_Contain_Upper_Character_Word")
add_line("common", "Restore_Entity", entity_tag="N")
add_line("common", "Restore_Entity_v2", duck_replace(strip_sql("v"), r"\bperson _ (\d+)\b", r"Person_\1", False), entity_tag="Person")
add_line("common", "Fix_Labels")
add_line("common", "Remove_No_Entity_Line", _keep("len(string_split(v, chr(9))) <> 2 OR (contains(split_part(v, chr(9), 1), '<N>') AND contains(split_part(v, chr(9), 2), '<N>'))"), entity_tag="N")
add_line("common", "Pair_Slot_Tag_Number")
add_line("common", "Pair_Slot_Tag_NoTrans")
add_line("common", "Segment_Jieba", dictionary={"中文": 5, "句子": 4, "项目": 3})
add_line("zh", "Seg_Chinese_Only_In_Sentence", dictionary={"中文": 5, "句子": 4, "项目": 3})
add_line("zh", "Segment_Jieba_Then_Char", dictionary={"中文": 5, "句子": 4, "项目": 3})


def tagged_sql(steps: list[tuple[str, str]], small: bool, tag: str, ignore: bool = True) -> str:
    """Fragment tagging without look-around: a match is framed by control marks, the marks decide the joining blanks."""
    e = "v"
    for i, (pattern, mode) in enumerate(steps):
        if i:  # pieces that are empty when the next pattern comes go
            e = f"regexp_replace(regexp_replace({e}, '\x02\x02+', '\x02', 'g'), '^\x02', '')"
        e = duck_replace(e, f"({pattern})", "\x02\x04\\1\x05\x03", ignore)
        e = f"replace({e}, '\x03\x02', '\x02')"
        e = f"regexp_replace({e}, '\x03$', '')"
        e = f"replace({e}, '\x03', '\x02')"
        if mode == "keep":
            e = f"regexp_replace({e}, '\x04([^\x05]*)\x05', '\\1', 'g')"
        else:
            if small:
                e = f"regexp_replace({e}, '\x04([0-9]{{1,3}})\x05', '\\1', 'g')"
            e = f"regexp_replace({e}, '\x04[^\x05]*\x05', '\x06', 'g')"
    return f"replace(replace({e}, '\x06', {sql_text(tag)}), '\x02', ' ')"


_HEX, _OWN = "0123456789ABCDEF", "".join(map(chr, range(0xE0A0, 0xE0B0)))
_ANY_TAG = "<([A-Za-z]+)>[^<]+</[A-Za-z]+>"  # RE2 has no back-references; no line here closes another tag


def frozen_sql(steps: list[tuple[str, str]], tag: str, small: bool, ignore: bool = True) -> str:
    """As ``tagged_sql`` for matches that keep their text: it is held as hexadecimal in private-use characters, which no
    later pattern matches. Modes: keep (as it is), slot (in hexadecimal between tags), tag."""
    e, own = "v", "translate(hex(encode(split_part(x, '\x05', 1))), '" + _HEX + "', '" + _OWN + "')"
    for i, (pattern, mode) in enumerate(steps):
        if i:
            e = f"regexp_replace(regexp_replace({e}, '\x02\x02+', '\x02', 'g'), '^\x02', '')"
        e = duck_replace(e, f"({pattern})", "\x02\x04\\1\x05\x03", ignore)
        e = f"replace(regexp_replace(replace({e}, '\x03\x02', '\x02'), '\x03$', ''), '\x03', '\x02')"
        kept, made = f"'\x07' || {own} || '\x08'", {"slot": f"'\x0e' || {own} || '\x0f'", "tag": "'\x06'"}.get(mode, "")
        new = kept if mode == "keep" else f"CASE WHEN regexp_full_match(split_part(x, '\x05', 1), '[0-9]{{1,3}}') THEN {kept} ELSE {made} END" if small else made
        e = f"array_to_string(list_transform(string_split({e}, '\x04'), lambda x: CASE WHEN contains(x, '\x05') THEN {new} || split_part(x, '\x05', 2) ELSE x END), '')"
    back = f"array_to_string(list_transform(string_split({e}, '\x07'), lambda x: CASE WHEN contains(x, '\x08') THEN decode(unhex(translate(split_part(x, '\x08', 1), '{_OWN}', '{_HEX}'))) || split_part(x, '\x08', 2) ELSE x END), '')"
    bare = tag.strip("<>")
    return f"replace(replace(replace(replace(translate({back}, '{_OWN}', '{_HEX}'), '\x0e', '<{bare}>'), '\x0f', '</{bare}>'), '\x06', {sql_text(tag)}), '\x02', ' ')"


for _language, _numbers, _amounts in (("en", patterns.ENGLISH_NUMBERS, patterns.ENGLISH_AMOUNTS), ("zh", patterns.CHINESE_NUMBERS, patterns.CHINESE_AMOUNTS)):
    _all = _numbers if _language == "en" else _amounts + _numbers
    add_line(_language, "Slot_Tag_Number", tagged_sql([(p, "tag") for p in _numbers], False, "N") if _language == "en" else frozen_sql([(patterns.CHINESE_MONTH, "keep"), *((p, "tag") for p in _numbers)], "N", False), number_tag="N")
    add_line(_language, "Slot_Tag_Number_v2", tagged_sql([(p, "tag") for p in _all], True, "N"), number_tag="N")
    add_line(_language, "Slot_Tag_Number_v3", frozen_sql([(_ANY_TAG, "keep"), *((p, "slot") for p in _all)], "<N>", True), number_tag="<N>")
    add_line(_language, "Slot_Tag_Number_v4", tagged_sql([(p, "tag") for p in _amounts], False, "N"), number_tag="N")
    add_line(_language, "Slot_Tag_Number_v5", frozen_sql([(_ANY_TAG, "keep"), *((p, "slot") for p in _amounts)], "<N>", False), number_tag="<N>")
add_line("en", "Slot_Tag_Notrans", frozen_sql([(_ANY_TAG, "keep"), *((p, "slot") for p in patterns.NOT_TRANSLATED)], "NOTRANS", False, False), notrans_tag="NOTRANS")

# --- tokenizer, sentences, subwords, dictionary -----------------------------------------------------------------------

_A, _AN = r"\p{L}", r"\p{L}\p{Nd}"
_TOK = [(r"\s+", " "), (r"[\x00-\x1f]", ""), (" +", " "), ("^ ", ""), (" $", ""), (rf"([^{_AN}\s.'`,\-])", r" \1 "), (r"(\.\.+)", " \\1 "), (" +", " "), (" $", ""), (r"([^\p{N}]),", r"\1 , "), (r",([^\p{N}])", r" , \1")]
_APOS = [(f"([^{_A}])'([^{_A}])", r"\1 ' \2"), (f"([^{_A}\\p{{N}}])'([{_A}])", r"\1 ' \2"), (f"([{_A}])'([^{_A}])", r"\1 ' \2"), (f"([{_A}])'([{_A}])", r"\1 '\2"), (r"([\p{N}])'(s)", r"\1 '\2")]
_APOS_FR = [(f"([^{_A}])'([^{_A}])", r"\1 ' \2"), (f"([^{_A}])'([{_A}])", r"\1 ' \2"), (f"([{_A}])'([^{_A}])", r"\1 ' \2"), (f"([{_A}])'([{_A}])", r"\1' \2")]
_stem, _next = "regexp_extract(w, '^(\\S+)\\.$', 1)", "coalesce(ws[i + 1], '')"
def tokenizer_sql(lang: str = "en", aggressive: bool = False, escape: bool = True) -> str:
    """The tokenizer without look-around, over v of ``lines``."""
    listed = lambda words: "[" + ", ".join(map(sql_text, words)) + "]::VARCHAR[]"
    stays = f"((contains({_stem}, '.') AND regexp_matches({_stem}, '\\p{{L}}')) OR list_contains({listed(tokenizer.NONBREAKING[lang])}, {_stem}) OR regexp_matches({_next}, '^\\p{{Ll}}') OR (list_contains({listed(tokenizer.NUMERIC_ONLY.get(lang, []))}, {_stem}) AND regexp_matches({_next}, '^[0-9]')) OR regexp_matches(w, '^\\.+$'))"
    joined = f"array_to_string(list_transform(ws, lambda w, i: CASE WHEN {_stem} <> '' AND NOT {stays} THEN {_stem} || ' .' ELSE w END), ' ')"
    clean = _chain_sql(joined, [(" +", " "), ("^ ", ""), (" $", "")])
    out = reduce(lambda e, s: f"replace({e}, {sql_text(s[0])}, {sql_text(s[1])})", tokenizer.ESCAPES, clean) if escape else clean
    steps = [*_TOK[:6], *([(rf"([{_AN}])-([{_AN}])", r"\1 @-@ \2")] * 2 if aggressive else []), *_TOK[6:]]
    words = f"regexp_split_to_array({_chain_sql('(chr(32) || v || chr(32))', steps + {'en': _APOS, 'fr': _APOS_FR}[lang])}, '\\s')"
    return f"WITH {LINES_SQL}, own AS (SELECT doc_id, line_no, {words} AS ws FROM (SELECT doc_id, line_no, value AS v FROM lines WHERE value <> '')), out AS (SELECT doc_id, line_no, {out} AS value FROM own) SELECT * FROM out WHERE value <> ''"


def _tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_lines(all_lines(spark, sf_dir), lines.get("common", "General_Tokenizer", lang="en"))


add("tokenize_en", _tokenized, tokenizer_sql())


def _late(language: str, rule: str, **params) -> Callable[[Column], Column]:
    """Built when it is used: vectorised functions need a session."""
    return lambda c: lines.get(language, rule, **params)(c)


for _name, _op in {
    "tokenize_fr": _late("common", "General_Tokenizer", lang="fr"), "tokenize_aggressive": _late("common", "General_Tokenizer", lang="en", aggressive=True, escape=False), "tokenize_penn": tokenizer.tokenize_penn, "detokenize_penn": lambda c: tokenizer.detokenize_penn(tokenizer.tokenize_penn(c)),
    "sentence_tokenizer": _late("common", "General_Sentence_Tokenizer"), "tokenizer_urls": _late("common", "General_Tokenizer_v2"), "detokenize_en": lambda c: tokenizer.detokenize(tokenizer.tokenize(c)), "detokenize_bracketfix": lambda c: lines.get("common", "General_Sentence_Detokenizer_Bracketfix")(tokenizer.tokenize(c)),
    "english_sentences": tokenizer.english_sentences, "chinese_sentences": tokenizer.chinese_sentences, "sentences_joined": _late("en", "Segment_EN_lines_To_Sentences_v2"),
    "bpe_apply": _late("common", "BPE_Apply_Line", codes=[("t", "h"), ("th", "e</w>"), ("o", "n"), ("i", "on"), ("on", "</w>")]),
    "replace_before": _late("common", "Pre_Replacing_Rule", rules=[("1", "of the", "<T>", "", ""), ("2", "of", "OF", "", "")]), "replace_after": _late("common", "Post_Replacing_Rule", rules=[("1", "", "", "of the", "OF_THE"), ("2", "", "", "of", "OF")]),
}.items():
    add(_name, lambda spark, sf_dir, op=_op: kept_lines(all_lines(spark, sf_dir), op))
ORACLES |= {"tokenize_fr": tokenizer_sql("fr"), "tokenize_aggressive": tokenizer_sql(aggressive=True, escape=False)}
_MERGES = [("t", "h"), ("th", "e</w>"), ("o", "n"), ("i", "on"), ("on", "</w>")]
_symbols = "chr(1) || regexp_replace(array_to_string(string_split(w, ''), chr(1)), '$', '</w>') || chr(1)"
_symbols = reduce(lambda e, p: f"replace({e}, chr(1) || '{p[0]}' || chr(1) || '{p[1]}' || chr(1), chr(1) || '{p[0]}{p[1]}' || chr(1))", [m for m in _MERGES for _ in range(2)], _symbols)  # twice: neighbours share a mark
_pieces_of = f"replace(replace(trim({_symbols}, chr(1)), '</w>', ''), chr(1), '@@ ')"
ORACLES["bpe_apply"] = f"WITH {LINES_SQL}, own AS (SELECT doc_id, line_no, array_to_string(list_transform({tokens_sql('value')}, lambda w: CASE WHEN regexp_full_match(w, '<[A-Za-z]+(:.*)?>') THEN w ELSE {_pieces_of} END), ' ') AS value FROM lines WHERE value <> '') SELECT * FROM own WHERE value <> ''"


def _phrases_sql(steps: list[tuple[str, str]]) -> str:
    """Phrases between blanks, longest first; each twice, since neighbours share a blank."""
    e = reduce(lambda x, s: f"regexp_replace({x}, '(^| ){s[0]}($| )', '\\1{s[1]}\\2', 'g')", [s for s in steps for _ in range(2)], "v")
    return f"WITH {LINES_SQL}, own AS (SELECT doc_id, line_no, {e} AS value FROM (SELECT doc_id, line_no, value AS v FROM lines WHERE value <> '')) SELECT * FROM own WHERE value <> ''"


ORACLES |= {"replace_before": _phrases_sql([("of the", "<T:1>"), ("of", "OF")]), "replace_after": _phrases_sql([("of the", "OF_THE"), ("of", "OF")])}


def _bpe_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = subword.learn(all_lines(spark, sf_dir))
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(codes)], "rank int, left string, right string")


add("bpe_learn", _bpe_learn)

# --- tables -----------------------------------------------------------------------------------------------------------

add("sort_num_reverse_cut", lambda s, d: tables.cut_lines(tables.word_counts(all_lines(s, d)).select(F.concat_ws("\t", F.col("freq").cast("string"), "word").alias("value")), 11, 60, tables.sort_keys(reverse=True, num_sort=True)),
    f"WITH {LINES_SQL}, w AS (SELECT unnest({tokens_sql('value')}) AS word FROM lines), c AS (SELECT count(*) || chr(9) || word AS value, count(*) AS n FROM w GROUP BY word) SELECT value FROM c ORDER BY n DESC, value DESC LIMIT 50 OFFSET 10")
add("sort_lines", lambda s, d: tables.sort(all_lines(s, d).select("value")), f"WITH {LINES_SQL} SELECT value FROM lines")
add("uniq", lambda s, d: tables.uniq(all_lines(s, d)), f"WITH {LINES_SQL} SELECT DISTINCT value FROM lines")
add("uniq_adjacent", lambda s, d: tables.uniq_adjacent(all_lines(s, d), group=["doc_id"]).select("doc_id", "line_no", "value"),
    f"WITH {LINES_SQL} SELECT doc_id, line_no, value FROM (SELECT *, lag(value) OVER w AS b, row_number() OVER w AS r FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)) WHERE r = 1 OR value IS DISTINCT FROM b")
add("numbered", lambda s, d: tables.numbered(tables.uniq(all_lines(s, d)), [(F.col("value"), False)], "rank"), f"WITH {LINES_SQL} SELECT value, row_number() OVER (ORDER BY value NULLS FIRST) AS rank FROM (SELECT DISTINCT value FROM lines)")
add("insert_line", lambda s, d: tables.insert_line(all_lines(s, d).where("doc_id = -1").select(F.col("line_no").cast("long").alias("line_no"), "value"), 3, "_PAD"),
    f"WITH {LINES_SQL} SELECT CASE WHEN line_no >= 3 THEN line_no + 1 ELSE line_no END::BIGINT AS line_no, value FROM lines WHERE doc_id = -1 UNION ALL SELECT 3, '_PAD'")
# All lines as one file, by document and line; the SQL of insert_line holds the sample lines.
add("insert_line_whole", lambda s, d: tables.insert_line(tables.numbered(all_lines(s, d).select("doc_id", F.col("line_no").alias("at"), "value"), [(F.col("doc_id"), False), (F.col("at"), False), (F.col("value"), False)], "line_no"), 3, "_PAD"))
add("shuffle", lambda s, d: tables.shuffle(all_lines(s, d), 7), f"WITH {LINES_SQL} SELECT * FROM lines")
_TWIN = "CASE WHEN contains(value, chr(9)) THEN split_part(value, chr(9), {i}) ELSE value END"
add("split_twin", lambda s, d: tables.split_twin(all_lines(s, d)).select("doc_id", "line_no", "left", "right"), f"WITH {LINES_SQL} SELECT doc_id, line_no, {_TWIN.format(i=1)} AS left, {_TWIN.format(i=2)} AS right FROM lines")
_strict = "SELECT doc_id, line_no, l[1] AS left, l[2] AS right FROM (SELECT doc_id, line_no, string_split({v}, chr(9)) AS l FROM lines) WHERE len(l) = 2 AND l[1] <> '' AND l[2] <> ''"
add("split_twin_strict", lambda s, d: tables.split_twin_strict(all_lines(s, d)).select("doc_id", "line_no", "left", "right"), f"WITH {LINES_SQL} {_strict.format(v='value')}")
add("split_twin_clean", lambda s, d: tables.split_twin_clean(all_lines(s, d)).select("doc_id", "line_no", "left", "right"), f"WITH {LINES_SQL} " + _strict.format(v="translate(value, chr(8232) || chr(8233) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30), '')"))
_PAIRS_SQL = "pairs AS (SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS src, b.text AS tgt FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return c.join(nxt, ["conv_id", "turn"]).select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), F.col("text").alias("src"), "tgt")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = turn_pairs(spark, sf_dir)
    return p.select(F.col("pair_id").alias("line_no"), F.col("src").alias("value")), p.select(F.col("pair_id").alias("line_no"), F.col("tgt").alias("value"))


add("combine_twin", lambda s, d: tables.combine_twin(*_sides(s, d)), f"WITH {_PAIRS_SQL} SELECT pair_id AS line_no, src || chr(9) || tgt AS value FROM pairs")
add("group_with_tags", lambda s, d: tables.group_with_tags(list(zip(("S: ", "T: "), _sides(s, d)))), f"WITH {_PAIRS_SQL} SELECT pair_id AS line_no, 'S: ' || src || chr(10) || 'T: ' || tgt || chr(10) AS value FROM pairs WHERE trim(src) <> ''")
add("three_way_dictionary", lambda s, d: tables.three_way_dictionary(_sides(s, d)[0], _sides(s, d)[1], _sides(s, d)[1]), f"WITH {_PAIRS_SQL} SELECT pair_id AS line_no, src AS word, tgt AS translation FROM pairs WHERE src <> tgt")
_len = lambda c: f"len({tokens_sql(c)})"
add("length_balanced", lambda s, d: tables.length_balanced(turn_pairs(s, d), "src", "tgt").select("pair_id", "balanced"), f"WITH {_PAIRS_SQL} SELECT pair_id, {_len('tgt')} >= {_len('src')} * 0.5 AND {_len('tgt')} <= {_len('src')} * 2.0 AS balanced FROM pairs")
add("word_vocab", lambda s, d: tables.word_counts(all_lines(s, d), skip_words=["the", "of"]), f"WITH {LINES_SQL}, w AS (SELECT unnest({tokens_sql('value')}) AS word FROM lines) SELECT word, count(*) AS freq FROM w WHERE word NOT IN ('the', 'of') GROUP BY word")
add("character_set", lambda s, d: tables.character_counts(all_lines(s, d)), f"WITH {LINES_SQL}, c AS (SELECT unnest(string_split(value, '')) AS char FROM lines WHERE value <> '' UNION ALL SELECT chr(10) FROM lines WHERE value IS NOT NULL) SELECT char, count(*) AS freq FROM c GROUP BY char")
_VOCAB_SQL = f"{LINES_SQL}, w AS (SELECT unnest({tokens_sql('value')}) AS word FROM lines), c AS (SELECT word, count(*) AS freq FROM w GROUP BY word), v AS (SELECT 0::BIGINT AS id, '_UNK' AS word, 0::BIGINT AS freq UNION ALL SELECT * FROM (SELECT row_number() OVER (ORDER BY freq DESC, word DESC) AS id, word, freq FROM c ORDER BY id LIMIT 999))"
add("vocabulary", lambda s, d: tables.vocabulary(all_lines(s, d), 1000), f"WITH {_VOCAB_SQL} SELECT * FROM v")
add("words_to_ids", lambda s, d: tables.words_to_ids(all_lines(s, d), tables.vocabulary(all_lines(s, d), 1000), ["doc_id", "line_no"]),
    f"WITH {_VOCAB_SQL}, x AS (SELECT doc_id, line_no, {tokens_sql('value')} AS ws FROM lines), u AS (SELECT doc_id, line_no, unnest(ws) AS word, unnest(range(len(ws))) AS at FROM x), j AS (SELECT u.doc_id, u.line_no, string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ' ' ORDER BY u.at) AS value FROM u LEFT JOIN v ON u.word = v.word GROUP BY ALL) SELECT x.doc_id, x.line_no, coalesce(j.value, '') AS value FROM x LEFT JOIN j ON x.doc_id = j.doc_id AND x.line_no = j.line_no")
add("ids_round_trip", lambda s, d: tables.ids_to_words(tables.words_to_ids(all_lines(s, d), s.createDataFrame([(0, "_UNK"), (1, "the"), (2, "of")], "id long, word string"), ["doc_id", "line_no"]), ["_UNK", "the", "of"]),
    f"WITH {LINES_SQL} SELECT doc_id, line_no, array_to_string(list_transform({tokens_sql('value')}, lambda w: CASE WHEN w IN ('the', 'of') THEN w ELSE '_UNK' END), ' ') AS value FROM lines")
add("break_unknown_words", lambda s, d: tables.break_unknown_words(all_lines(s, d), s.createDataFrame([(w,) for w in _VOC], "word string"), ["doc_id", "line_no"]),
    f"WITH {LINES_SQL} SELECT doc_id, line_no, array_to_string(list_transform({tokens_sql('value')}, lambda w: CASE WHEN list_contains({_VOC}, w) THEN w ELSE {_BROKEN} END), ' ') AS value FROM lines")
_pieces = "array_to_string(list_transform(range(0, (length(w) - 1) // 3 + 1), lambda i: substr(w, i * 3 + 1, 3)), '@@ ')"
add("char_ngrams", lambda s, d: tables.char_ngrams(all_lines(s, d), s.createDataFrame([(w,) for w in _VOC], "word string"), ["doc_id", "line_no"], 3),
    f"WITH {LINES_SQL} SELECT doc_id, line_no, array_to_string(list_transform({tokens_sql('value')}, lambda w: CASE WHEN list_contains({_VOC}, w) THEN w ELSE {_pieces} END), ' ') AS value FROM lines")


def _probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("line_no"), F.col("o_orderpriority").alias("lw"), F.concat(F.lit("w"), (F.col("o_custkey") % 17).cast("string")).alias("rw"), (-(F.col("o_orderkey") % 97) / 10.0).cast("double").alias("logp"))


_PROB_SQL = "t AS (SELECT o_orderpriority AS lw, 'w' || (o_custkey % 17) AS rw, arg_max(CAST(-(o_orderkey % 97) / 10.0 AS DOUBLE), o_orderkey) AS logp FROM orders GROUP BY 1, 2)"
add("probability_lists", lambda s, d: tables.probability_lists(_probabilities(s, d)), f"WITH {_PROB_SQL} SELECT lw, list(rw ORDER BY logp DESC, rw) AS words FROM t GROUP BY lw")
add("probability_maps", lambda s, d: tables.probability_maps(_probabilities(s, d)).select("lw", F.explode("probs").alias("rw", "p")).select("lw", "rw", F.round("p", 6).alias("p")), f"WITH {_PROB_SQL} SELECT lw, rw, round(exp(logp), 6) AS p FROM t")
add("paragraphs", lambda s, d: tables.paragraphs(all_lines(s, d)),
    f"WITH {LINES_SQL}, i AS (SELECT *, trim(coalesce(value, '')) = '' AS b, sum((trim(coalesce(value, '')) = '')::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM lines), p AS (SELECT doc_id, g, string_agg(value, ' ' ORDER BY line_no) AS value FROM i WHERE NOT b GROUP BY doc_id, g) SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS paragraph, value FROM p")

# --- scoring ----------------------------------------------------------------------------------------------------------


def _hyp_ref(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = turn_pairs(spark, sf_dir)
    return p.select(F.col("pair_id").alias("sent_id"), F.col("src").alias("value")), p.select(F.col("pair_id").alias("sent_id"), F.col("tgt").alias("value"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


_GRAMS = " UNION ALL ".join(f"SELECT pair_id, {n} AS n, array_to_string(ws[i:i + {n - 1}], ' ') AS g FROM (SELECT pair_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM {{side}})" for n in range(1, 5))
_BLEU_SQL = f"""{_PAIRS_SQL}, h AS (SELECT pair_id, {tokens_sql('src')} AS ws FROM pairs), r AS (SELECT pair_id, {tokens_sql('tgt')} AS ws FROM pairs),
hg AS (SELECT pair_id, n, g, count(*) AS c FROM ({_GRAMS.format(side='h')}) GROUP BY ALL), rg AS (SELECT pair_id, n, g, count(*) AS c FROM ({_GRAMS.format(side='r')}) GROUP BY ALL),
m AS (SELECT hg.pair_id, hg.n, sum(hg.c) AS total, sum(least(hg.c, coalesce(rg.c, 0))) AS correct FROM hg LEFT JOIN rg ON hg.pair_id = rg.pair_id AND hg.n = rg.n AND hg.g = rg.g GROUP BY ALL),
s AS (SELECT h.pair_id, len(h.ws) AS hyp_len, len(r.ws) AS ref_len, {', '.join(f"coalesce((SELECT correct FROM m WHERE m.pair_id = h.pair_id AND n = {n}), 0) AS c{n}, coalesce((SELECT total FROM m WHERE m.pair_id = h.pair_id AND n = {n}), 0) AS t{n}" for n in range(1, 5))} FROM h JOIN r USING (pair_id))"""
_P = [f"CASE WHEN t{n} > 0 THEN c{n} / t{n} ELSE 0.0 END" for n in range(1, 5)]
_LOG = " + ".join(f"CASE WHEN c{n} > 0 THEN ln(c{n} / t{n}) ELSE -9999999999.0 END" for n in range(1, 5))
_BP = "CASE WHEN hyp_len < ref_len THEN exp(1 - ref_len / hyp_len) ELSE 1.0 END"
_ok = "ref_len > 0 AND hyp_len > 0"
_BLEU_COLS = f"round(CASE WHEN {_ok} THEN ({_BP}) * exp(({_LOG}) / 4) ELSE 0.0 END * 100, 6) AS bleu, {', '.join(f'round({p} * 100, 6) AS p{n}' for n, p in enumerate(_P, 1))}, round(CASE WHEN {_ok} THEN {_BP} ELSE 0.0 END, 6) AS bp, CAST(hyp_len AS BIGINT) AS hyp_len, CAST(ref_len AS BIGINT) AS ref_len"
add("bleu_sentence", lambda s, d: _rounded(scoring.sentence_bleu(*_hyp_ref(s, d))), f"WITH {_BLEU_SQL} SELECT pair_id AS sent_id, {_BLEU_COLS} FROM s")
add("bleu_corpus", lambda s, d: _rounded(scoring.corpus_bleu(*_hyp_ref(s, d))), f"WITH {_BLEU_SQL}, a AS (SELECT {', '.join(f'sum({c}) AS {c}' for c in ['hyp_len', 'ref_len', *(f'{x}{n}' for n in range(1, 5) for x in 'ct')])} FROM s) SELECT {_BLEU_COLS} FROM a")
_BLEU_TAIL = "printf('BLEU = %.2f, %.1f/%.1f/%.1f/%.1f (BP=%.3f, ratio=%.3f, hyp_len=%d, ref_len=%d)', bleu, p1, p2, p3, p4, bp, CASE WHEN ref_len > 0 THEN hyp_len / ref_len ELSE 0.0 END, hyp_len, ref_len)"
_BLEU_RAW = _BLEU_COLS.replace("round(", "(").replace(", 6)", ")")
add("bleu_report", lambda s, d: scoring.bleu_report(*_hyp_ref(s, d)), f"""WITH {_BLEU_SQL}, b AS (SELECT pair_id, {_BLEU_RAW} FROM s), a AS (SELECT {', '.join(f'sum({c}) AS {c}' for c in ['hyp_len', 'ref_len', *(f'{x}{n}' for n in range(1, 5) for x in 'ct')])} FROM s), d AS (SELECT {_BLEU_RAW} FROM a)
SELECT pair_id AS "order", printf('%.2f', bleu) || chr(9) || 'line_num:' || pair_id || chr(9) || src || ' <==> ' || tgt || chr(9) || {_BLEU_TAIL} AS value FROM b JOIN pairs USING (pair_id) UNION ALL SELECT -1, '-1============= Document ' || {_BLEU_TAIL} || '=============' FROM d""")
_CG = " UNION ALL ".join(f"SELECT pair_id, {n} AS n, substr(v, i, {n}) AS g FROM (SELECT pair_id, v, unnest(range(1, length(v) - {n - 2})) AS i FROM {{side}})" for n in range(1, 7))
add("chrf", lambda s, d: _rounded(scoring.chrf(*_hyp_ref(s, d))),
    f"""WITH {_PAIRS_SQL}, h AS (SELECT pair_id, regexp_replace(src, '\\s+', '', 'g') AS v FROM pairs), r AS (SELECT pair_id, regexp_replace(tgt, '\\s+', '', 'g') AS v FROM pairs),
hg AS (SELECT pair_id, n, g, count(*) AS c FROM ({_CG.format(side='h')}) GROUP BY ALL), rg AS (SELECT pair_id, n, g, count(*) AS c FROM ({_CG.format(side='r')}) GROUP BY ALL),
b AS (SELECT n, sum(least(coalesce(hg.c, 0), coalesce(rg.c, 0))) AS k, sum(coalesce(hg.c, 0)) AS h, sum(coalesce(rg.c, 0)) AS r FROM hg FULL JOIN rg USING (pair_id, n, g) GROUP BY n), a AS (SELECT coalesce(sum(k / h) FILTER (h > 0 AND r > 0), 0) / 6 AS p, coalesce(sum(k / r) FILTER (h > 0 AND r > 0), 0) / 6 AS q FROM b)
SELECT round(CASE WHEN 9 * p + q > 0 THEN 10 * p * q / (9 * p + q) ELSE 0.0 END, 6) AS chrf, round(p, 6) AS precision, round(q, 6) AS recall FROM a""")  # fmt: skip


def _part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's description beside the next part's."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")).alias("text"))
    return p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("text").alias("next")), "p_partkey")


_coded = lambda side: f"array_to_string(list_transform({side}, lambda w: chr(64 + list_position(list_distinct(list_concat(a, b)), w)::INT)), '')"
_PART_SQL = "t AS (SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type, p_size::VARCHAR) AS text FROM part), q AS (SELECT t.p_partkey, t.text, u.text AS next FROM t JOIN t u ON u.p_partkey = t.p_partkey + 1)"
add("levenshtein_word", lambda s, d: _part_pairs(s, d).select("p_partkey", scoring.edit_distance(F.col("text"), F.col("next"), "word").alias("distance"), F.round(scoring.fuzzy_match(F.col("text"), F.col("next"), "word"), 6).alias("score")),
    f"WITH {_PART_SQL}, w AS (SELECT p_partkey, string_split(text, ' ') AS a, string_split(next, ' ') AS b FROM q), c AS (SELECT p_partkey, levenshtein({_coded('a')}, {_coded('b')}) AS n, greatest(len(a), len(b)) AS m FROM w) SELECT p_partkey, CAST(n AS INTEGER) AS distance, round(1 - n / m, 6) AS score FROM c")
add("levenshtein_char", lambda s, d: _part_pairs(s, d).select("p_partkey", scoring.edit_distance(F.col("text"), F.col("next")).alias("distance"), F.round(scoring.fuzzy_match(F.col("text"), F.col("next")), 6).alias("score")),
    f"WITH {_PART_SQL} SELECT p_partkey, CAST(levenshtein(text, next) AS INTEGER) AS distance, round(1 - levenshtein(text, next) / greatest(length(text), length(next)), 6) AS score FROM q")
# SQL's function counts bytes, so its pairs are ASCII texts; these are turns of all languages, without SQL.
for _mode in ("char", "word"):
    add(f"levenshtein_{_mode}_whole", lambda s, d, m=_mode: turn_pairs(s, d).select("pair_id", scoring.edit_distance(F.col("src"), F.col("tgt"), m).alias("distance"), F.round(scoring.fuzzy_match(F.col("src"), F.col("tgt"), m), 6).alias("score")))

# --- phrases ----------------------------------------------------------------------------------------------------------

_PHRASES = [("the cat", "猫", [0.5, 0.4], [0.9, 0.8], 5), ("a (dog", "狗", [0.5, 0.4], [0.9, 0.8], 3), ("dog", "了狗", [0.5, 0.4], [0.9, 0.8], 2), ("see the", "看", [0.1, 0.2], [0.9, 0.9], 1), ("long phrase of words", "长", [0.1, 0.2], [0.9, 0.9], 4), ("w", "（字", [0.1, 0.2], [0.9, 0.9], 1), ("p", "票", [0.0, 0.2], [0.9, 0.9], 1), ("q", "球", [0.1, 0.2], [0.6, 0.3], 1)]


def phrase_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = all_lines(spark, sf_dir).select(tokens(F.col("value")).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    pair = w.select(F.explode(F.arrays_zip(F.slice("w", F.lit(1), n).alias("src"), F.slice("w", F.lit(2), n).alias("tgt"))).alias("p")).select("p.*")
    counted = pair.groupBy("src", "tgt").agg(F.count("*").alias("freq"))
    own = phrases.with_probabilities(counted.withColumn("lexw", F.array(F.lit(0.5), F.lit(0.5))))
    made = spark.createDataFrame(_PHRASES, "src string, tgt string, lexw array<double>, prob array<double>, freq long")
    return own.select("src", "tgt", "lexw", "prob", "freq").unionByName(made)


_PH_VALUES = ", ".join(f"({sql_text(a)}, {sql_text(b)}, {x}, {p}, {f})" for a, b, x, p, f in _PHRASES)
_PH_SQL = f"""{LINES_SQL}, w AS (SELECT {tokens_sql('value')} AS ws FROM lines), g AS (SELECT ws[i] AS src, ws[i + 1] AS tgt FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM w)), c AS (SELECT src, tgt, count(*) AS freq FROM g GROUP BY ALL),
pt AS (SELECT src, tgt, [0.5::DOUBLE, 0.5] AS lexw, [freq / sum(freq) OVER (PARTITION BY src), freq / sum(freq) OVER (PARTITION BY tgt)] AS prob, freq FROM c UNION ALL SELECT a, b, x, p, f FROM (VALUES {_PH_VALUES}) AS t(a, b, x, p, f))"""
add("phrase_probabilities", lambda s, d: phrase_rows(s, d).select("src", "tgt", F.round(F.col("prob")[0], 6).alias("p1"), F.round(F.col("prob")[1], 6).alias("p2"), "freq"), f"WITH {_PH_SQL} SELECT src, tgt, round(prob[1], 6) AS p1, round(prob[2], 6) AS p2, freq FROM pt")


def _unnested(c: str, brackets: dict[str, str]) -> str:
    only = f"list_filter(string_split({c}, ''), lambda x: contains({sql_text(''.join([*brackets, *brackets.values()]))}, x))"
    closes = " ".join(f"WHEN x = {sql_text(k)} THEN CASE WHEN right(s, 1) = {sql_text(v)} THEN s[:-2] ELSE s || '!' END" for k, v in brackets.items())
    return f"list_reduce(list_prepend('', {only}), lambda s, x: CASE WHEN contains(s, '!') THEN s {closes} ELSE s || x END) <> ''"


_cls = lambda m: "[" + "".join("\\" + x if x in ",.?!;:\"}])" else x for x in m) + "]"
_RULES = [
    ("empty", f"{_len('src')} = 0 OR {_len('tgt')} = 0"), ("multi_align", "CASE WHEN tn > 1 THEN prob[2] <= 0.5 WHEN sn > 1 THEN prob[1] <= 0.5 ELSE false END"), ("en_no_en", "NOT regexp_matches(src, '[A-Za-z]')"), ("zh_no_zh", f"NOT regexp_matches(tgt, '{_ZH}')"),
    ("en_has_zhPunc", f"regexp_matches(src, '[{chars.CHINESE_PUNCTUATION}]')"), ("zh_has_enPunc", f"regexp_matches(tgt, {sql_text(_cls(phrases.ENGLISH_MARKS))})"), ("start_with_Punc", f"regexp_matches(src, {sql_text('^' + _cls(phrases.START_MARKS))}) OR regexp_matches(tgt, {sql_text('^' + _cls(phrases.START_MARKS))})"),
    ("zh_start_with_special", "regexp_matches(tgt, '^[了的]')"), ("en_end_with_special", "ends_with(src, 'the')"), ("en_paren_mismatch", f"({_unnested('src', phrases.EN_BRACKETS)}) OR ({_unnested('tgt', phrases.EN_BRACKETS)})"), ("zh_paren_mismatch", _unnested("tgt", phrases.ZH_BRACKETS)),
    ("ptr_sum_low", "prob[1] + prob[2] < 1.2"), ("ptr_or_low", "prob[1] < 0.5 OR prob[2] < 0.5"), ("lexicalW_zero", "lexw[1] = 0 OR lexw[2] = 0"), ("len_diff", f"greatest({_len('src')}, {_len('tgt')}) / least({_len('src')}, {_len('tgt')}) >= 2.5"),
]
_JUDGED = f"{_PH_SQL}, z AS (SELECT *, count(*) OVER (PARTITION BY src) AS sn, count(*) OVER (PARTITION BY tgt) AS tn FROM pt), j AS (SELECT src, tgt, freq, CASE {' '.join(f'WHEN {c} THEN {sql_text(n)}' for n, c in _RULES)} END AS reason FROM z)"
add("phrase_filter", lambda s, d: phrases.judged(phrase_rows(s, d)).select("src", "tgt", "freq", "reason"), f"WITH {_JUDGED} SELECT src, tgt, freq, reason FROM j")
add("phrase_reasons", lambda s, d: phrases.reason_counts(phrases.judged(phrase_rows(s, d))), f"WITH {_JUDGED} SELECT reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY reason")
add("phrase_lengths", lambda s, d: phrases.length_histogram(phrases.judged(phrase_rows(s, d))).withColumn("length", F.col("length").cast("long")),
    f"WITH {_JUDGED} SELECT side, length, count(*) AS n FROM (SELECT 'src' AS side, {_len('src')} AS length FROM j WHERE reason IS NULL UNION ALL SELECT 'tgt', {_len('tgt')} FROM j WHERE reason IS NULL) GROUP BY ALL")
add("phrase_merge", lambda s, d: phrases.merged([rows := phrase_rows(s, d), rows]).select("src", "tgt", "freq", F.round(F.col("prob")[0], 6).alias("p1")),
    f"WITH {_PH_SQL}, m AS (SELECT src, tgt, CAST(2 * sum(freq) AS BIGINT) AS freq FROM pt GROUP BY ALL) SELECT src, tgt, freq, round(freq / sum(freq) OVER (PARTITION BY src), 6) AS p1 FROM m")
add("phrase_moses", lambda s, d: phrases.moses_lines(phrase_rows(s, d), "%.4f"), f"WITH {_PH_SQL} SELECT src || ' ||| ' || tgt || ' ||| ' || printf('%.4f %.4f %.4f %.4f', lexw[1], lexw[2], round(prob[1], 4), round(prob[2], 4)) || ' 2.718' AS value FROM pt")
add("phrase_plain", lambda s, d: phrases.plain_lines(phrase_rows(s, d), "%.4f"), f"WITH {_PH_SQL} SELECT concat_ws(chr(9), src, tgt, printf('%.4f %.4f', lexw[1], lexw[2]), printf('%.4f %.4f', round(prob[1], 4), round(prob[2], 4)), freq::VARCHAR) AS value FROM pt")
_esc = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
add("phrase_tmx", lambda s, d: phrases.tmx_lines(phrase_rows(s, d), ("en",), "%.2f"),
    f"""WITH {_PH_SQL} SELECT '<tu>' || chr(10) || ' <prop type="freq">' || freq || '</prop>' || chr(10) || ' <prop type="probas">' || printf('%.2f %.2f', round(prob[1], 2), round(prob[2], 2)) || '</prop>' || chr(10) || ' <prop type="lexWeights">' || printf('%.2f %.2f', lexw[1], lexw[2]) || '</prop>' || chr(10)
|| ' <tuv xml:lang="en"><seg>' || {_esc('src')} || '</seg></tuv>' || chr(10) || ' <tuv xml:lang="_lang2_"><seg>' || {_esc('tgt')} || '</seg></tuv>' || chr(10) || '</tu>' AS value FROM pt""")  # fmt: skip
add("phrase_html", lambda s, d: phrases.html_rows(s.createDataFrame(_PHRASES, "src string, tgt string, lexw array<double>, prob array<double>, freq long")))
add("phrase_lexical_weights", lambda s, d: _rounded(phrases.lexical_weights(turn_pairs(s, d).select(F.element_at(tokens(F.col("src")), 1).alias("src"), F.element_at(tokens(F.col("tgt")), 1).alias("tgt")).distinct(), turn_pairs(s, d)).select("src", "tgt", F.col("lexw")[0].alias("w1"), F.col("lexw")[1].alias("w2"))),
    f"""WITH {_PAIRS_SQL}, n AS (SELECT pair_id AS id, list_distinct({tokens_sql('src')}) AS a, list_distinct({tokens_sql('tgt')}) AS b FROM pairs), x AS (SELECT id, unnest(a) AS x FROM n), y AS (SELECT id, unnest(b) AS y FROM n),
fx AS (SELECT x, count(*) AS nx FROM x GROUP BY x), fy AS (SELECT y, count(*) AS ny FROM y GROUP BY y), c AS (SELECT x, y, count(*) AS c FROM x JOIN y USING (id) GROUP BY ALL), t AS (SELECT DISTINCT {tokens_sql('src')}[1] AS src, {tokens_sql('tgt')}[1] AS tgt FROM pairs)
SELECT src, tgt, round(coalesce(c.c / nx, 0.0), 6) AS w1, round(coalesce(c.c / ny, 0.0), 6) AS w2 FROM t LEFT JOIN c ON c.x = src AND c.y = tgt LEFT JOIN fx ON fx.x = src LEFT JOIN fy ON fy.y = tgt""")  # fmt: skip


def _moses_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ["a ||| x ||| 1 1 0.5", "b ||| y ||| 1 1 0.4", "a b ||| x y ||| 1 1 0.3", "a b ||| z ||| 1 1 0.2", "a b c ||| z w ||| 1 1 0.2", "c ||| ||| 1 1 0.9", "bad ||| row", "d e f g h ||| v ||| 1 1 0.7", "b ||| z ||| 1 1 0.00001"]
    return phrases.parsed_moses(spark.createDataFrame([(r,) for r in rows], "value string"))


add("phrase_pack", lambda s, d: phrases.packed(_moses_table(s, d)).select("lw", F.col("n").cast("long").alias("n"), F.array_join("words", " ").alias("words")), "SELECT * FROM (VALUES ('a', 1::BIGINT, 'x'), ('b', 1, 'y z'), ('c', 1, ''), ('a b c', 3, 'w')) AS t(lw, n, words)")
add("alignment_update", lambda s, d: phrases.alignment_update(s.createDataFrame([("a", ["x", "y"]), ("b", ["z"])], "lw string, words array<string>"), s.createDataFrame([("a", ["y", "w"]), ("c", ["q"])], "lw string, words array<string>")).select("lw", F.array_join("words", " ").alias("words")), "SELECT * FROM (VALUES ('a', 'x y w'), ('b', 'z'), ('c', 'q')) AS t(lw, words)")
add("word_alignment", lambda s, d: aligner.word_table(turn_pairs(s, d), 2))
add("word_links_whole", lambda s, d: aligner.own_links(turn_pairs(s, d), 2))
add("phrase_lexical_weights_whole", lambda s, d: phrases.lexical_weights(aligner.phrase_candidates(p := turn_pairs(s, d)).select("src", "tgt"), p).select("src", "tgt", F.col("lexw")[0].alias("w1"), F.col("lexw")[1].alias("w2")))
add("sampled_phrases", lambda s, d: aligner.sampled_phrases(turn_pairs(s, d), rounds=12, longest=1000))  # small sub-corpora give whole turns
add("file_paragraphs", lambda s, d: tables.file_paragraphs(turn_pairs(s, d).select(F.col("pair_id").alias("line_no"), F.when(F.length("src") % 3 > 0, F.col("src")).otherwise(F.lit(" ")).alias("value")), part=5000),
    f"WITH {_PAIRS_SQL}, l AS (SELECT pair_id, CASE WHEN length(src) % 3 > 0 THEN src ELSE ' ' END AS v FROM pairs), i AS (SELECT *, sum((trim(v) = '')::INT) OVER (ORDER BY pair_id) AS g FROM l) SELECT dense_rank() OVER (ORDER BY g) - 1 AS line_no, string_agg(v, ' ' ORDER BY pair_id) AS value FROM i WHERE trim(v) <> '' GROUP BY g")

# --- alignment, case --------------------------------------------------------------------------------------------------

_CONTEXT = [("the new-york times", "The New-York Times said IPs are x", True, ["ne@@", "w", "york", "<->", "x"], ["Ne@@", "w", "York", "'s", "city"], [0, 1, 2, 3, 5])]


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(_CONTEXT, "line string, raw_line string, align_enabled boolean, tgt_array array<string>, src_array array<string>, tgt_src_mapping array<int>")


add("align_target_source", lambda s, d: _contexts(s, d).select(alignment.align_columns(F.col("align_enabled"), F.col("tgt_array"), F.col("src_array"), F.col("tgt_src_mapping"), True).alias("a")).select(F.array_join("a.target", "|").alias("target"), F.array_join("a.source", "|").alias("source"), F.array_join("a.mapping", "|").alias("mapping")),
    "SELECT 'new|york-|x' AS target, 'New|York''s|city' AS source, '0|1|3' AS mapping")
add("correct_case", lambda s, d: turn_pairs(s, d).select("pair_id", alignment.correct_case(F.lower("src"), F.col("src")).alias("value")))
add("correct_case_array", lambda s, d: _contexts(s, d).select(F.array_join(alignment.correct_case_array(F.col("align_enabled"), F.split("line", " "), F.col("raw_line")), " ").alias("value")), "SELECT 'The New-York Times' AS value")
add("restore_case_from_source", lambda s, d: turn_pairs(s, d).select("pair_id", lines.restore_case_from(F.lower("src"), F.col("tgt"), ["The"]).alias("value")))
add("context_pipeline", lambda s, d: plans.Engine(s, {"steps": [{"name": "post", "type": "context", "rules": [
    {"name": "common.BPE_Recover", "init_args": {}, "run_params": {"line": "$$line"}, "run_outputs": ["line"]}, {"name": "common.Align_Target_Source", "init_args": {}, "run_params": {"align_enabled": "$$align_enabled", "tgt_array": "$$tgt_array", "src_array": "$$src_array", "tgt_src_mapping": "$$tgt_src_mapping"}, "run_outputs": ["target", "source", "mapping"]},
    {"name": "rules_zh.Correct_En_Word_Case", "init_args": {}, "run_params": {"line": "$$line", "raw_line": "$$raw_line"}, "run_outputs": ["line"]}]}]}).context(_contexts(s, d)).select("line", F.array_join("source", "|").alias("source")), "SELECT 'The New-York Times' AS line, 'New|York''s|city' AS source")

# --- documents --------------------------------------------------------------------------------------------------------


def _json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.document_from_lines(column_lines(table(spark, sf_dir, "documents")))


_JSON_SQL = f"WITH {LINES_SQL}, own AS (SELECT doc_id, list(value ORDER BY line_no) AS p FROM lines WHERE doc_id >= 0 AND trim(coalesce(value, '')) <> '' GROUP BY doc_id)"
add("document_json", lambda s, d: _json_docs(s, d).select("doc_id", F.get_json_object("json", "$.original_doc.lang").alias("lang"), F.size(F.from_json(F.get_json_object("json", "$.original_doc.paragraphs"), "array<string>")).cast("long").alias("paragraphs")), f"{_JSON_SQL} SELECT doc_id, 'en' AS lang, len(p) AS paragraphs FROM own")
add("document_text", lambda s, d: documents.extract_text(_json_docs(s, d).withColumnRenamed("json", "value")).select("doc_id", "text"), f"{_JSON_SQL} SELECT doc_id, array_to_string(p, chr(10)) AS text FROM own")
add("document_record", lambda s, d: documents.paragraphs_of_sentences(all_lines(s, d)).select("doc_id", F.size("paragraphs").cast("long").alias("paragraphs"), F.size(F.flatten(F.transform("paragraphs", lambda p: p["sentences"]))).cast("long").alias("sentences")),
    f"WITH {LINES_SQL}, i AS (SELECT *, trim(coalesce(value, '')) = '' AS b, sum((trim(coalesce(value, '')) = '')::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM lines) SELECT doc_id, count(DISTINCT g) AS paragraphs, count(*) AS sentences FROM i WHERE NOT b GROUP BY doc_id")
add("record_id", lambda s, d: table(s, d, "pages").select("page_id", documents.record_id(F.col("url")).alias("id")), "SELECT page_id, translate(base64(url::BLOB), '+/', '-_') AS id FROM pages")
add("byte_batches", lambda s, d: documents.byte_batches(all_lines(s, d)).select("doc_id", "line_no", "batch"), f"WITH {LINES_SQL} SELECT doc_id, line_no, CAST(floor((sum(strlen(value) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - 1) / 3000) AS BIGINT) AS batch FROM lines")
add("resume_skip", lambda s, d: documents.not_done(turn_pairs(s, d).select(F.col("src").alias("value")), turn_pairs(s, d).select(F.col("tgt").alias("value"))), f"WITH {_PAIRS_SQL} SELECT src AS value FROM pairs WHERE src NOT IN (SELECT tgt FROM pairs)")
_TF = lambda t: f"len(list_filter(w, lambda x: x = '{t}'))"
_BM = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * {_TF(t)} * 2.2 / ({_TF(t)} + 1.2 * (0.25 + 0.75 * len(w) / av))" for i, t in enumerate(("that", "with")))
add("search_top", lambda s, d: _rounded(documents.search(table(s, d, "benchmark"), "with that", 10, key="item_id", value="text").select("item_id", "score")),
    f"WITH o AS (SELECT item_id, {tokens_sql('lower(text)')} AS w FROM benchmark), st AS (SELECT count(*) AS n, avg(len(w)) AS av, sum(list_contains(w, 'that')::INT) AS df0, sum(list_contains(w, 'with')::INT) AS df1 FROM o) SELECT item_id, round({_BM}, 6) AS score FROM o, st WHERE {_TF('that')} > 0 OR {_TF('with')} > 0 ORDER BY ({_BM}) DESC, item_id LIMIT 10")

# --- pipelines --------------------------------------------------------------------------------------------------------

_HEAD = ["Remove_Single_Quotation", "Norm_Ellipsis", "Remove_Square_Content", "Remove_Redundant_Spaces", "Remove_Empty_Line", "To_Lower"]


def _chain_expr(rules: list[str], language: str, e: str) -> str:
    for r in rules:
        key = (language, r) if (language, r) in lines.SUBSTITUTIONS else ("common", r)
        e = f"nullif({'lower(' + e + ')' if r == 'To_Lower' else lines.duck_substitutions(*key, e)}, '')"
    return e


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned distinct lines to a ranked vocabulary of 1000 words, through the planner."""
    spec = {"steps": [{"name": "clean", "type": "line", "replace_empty_line": "", "inputs": ["raw"], "rules": [[f"common.{r}", {}] for r in _HEAD], "outputs": ["clean", "removed"]}], "final_outputs": ["clean"]}
    raw = column_lines(table(spark, sf_dir, "documents")).select((F.col("doc_id") * 100_000 + F.col("line_no")).alias("line_no"), "value")
    clean = plans.Engine(spark, spec).run({"raw": raw})["clean"]
    keys = [F.desc("freq"), F.asc("word")]
    top = tables.word_counts(tables.uniq(clean)).orderBy(*keys).limit(1000)
    return top.select((F.row_number().over(Window.orderBy(*keys)) - 1).cast("long").alias("id"), "word", "freq")


add("flagship_vocabulary", flagship, f"""WITH {LINES_SQL}, c AS (SELECT DISTINCT {_chain_expr(_HEAD, 'common', "nullif(value, '')")} AS value FROM lines WHERE doc_id >= 0), w AS (SELECT unnest({tokens_sql('value')}) AS word FROM c WHERE value IS NOT NULL), f AS (SELECT word, count(*) AS freq FROM w GROUP BY word)
SELECT row_number() OVER (ORDER BY freq DESC, word) - 1 AS id, word, freq FROM f ORDER BY id LIMIT 1000""")  # fmt: skip
_EN = ["Remove_Single_Quotation", "Norm_Ellipsis", "Remove_Square_Content", "Remove_Redundant_Spaces", "Remove_Empty_Line", "Remove_Bullet", "Replace_Chinese_Single_Quotation", "Remove_Punctuation", "Remove_Between_QuesMark", "Remove_Redundant_Spaces", "To_Lower"]


def train_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs split, each side cleaned with its rows kept, zipped, token rows dropped, repeats dropped: the training-set shape."""
    clean = lambda i, o: {"name": i, "type": "line", "replace_empty_line": "REMOVETHISLINE", "inputs": [i], "rules": [[f"rules_en.{r}", {}] for r in _EN], "outputs": [o, "_"]}
    spec = {"inputs": ["pairs"], "final_outputs": ["final"], "steps": [
        {"name": "split", "type": "file", "inputs": ["pairs"], "rules": [["common.Split_To_Twin_Files", {}]], "outputs": ["en", "zh"]}, clean("en", "en.clean"), clean("zh", "zh.clean"),
        {"name": "final", "type": "file", "inputs": ["en.clean", "zh.clean"], "rules": [["common.Combine_Twin_Files", {}], ["common.Remove_Lines_With_Content", {"content": "REMOVETHISLINE"}], ["common.Uniq", {}]], "outputs": ["final"]}]}
    raw = turn_pairs(spark, sf_dir).select(F.col("pair_id").alias("line_no"), F.concat_ws("\t", F.regexp_replace("src", "\n", " "), F.regexp_replace("tgt", "\n", " ")).alias("value"))
    return plans.Engine(spark, spec).run({"pairs": raw})["final"].select("value")


def _cte_chain(rules: list[str], language: str, start: str, prefix: str) -> str:
    """A CTE a rule: (pair_id, v) from the table ``start``; a rule that names its argument twice doesn't double."""
    out, before = [], start
    for i, r in enumerate(rules):
        out.append(f"{prefix}{i} AS MATERIALIZED (SELECT pair_id, {_chain_expr([r], language, 'v')} AS v FROM {before})")
        before = f"{prefix}{i}"
    return ", ".join(out)


_last = len(_EN) - 1
add("pipeline_train_set", train_set, f"""WITH {_PAIRS_SQL}, s AS (SELECT pair_id, nullif(replace(src, chr(10), ' '), '') AS v FROM pairs), t AS (SELECT pair_id, nullif(replace(tgt, chr(10), ' '), '') AS v FROM pairs),
{_cte_chain(_EN, 'en', 's', 'sa')}, {_cte_chain(_EN, 'en', 't', 'tb')}, z AS (SELECT pair_id, coalesce(a.v, 'REMOVETHISLINE') || chr(9) || coalesce(b.v, 'REMOVETHISLINE') AS value FROM sa{_last} a JOIN tb{_last} b USING (pair_id)), k AS (SELECT value, lag(value) OVER (ORDER BY pair_id) AS before FROM z WHERE NOT contains(value, 'REMOVETHISLINE')) SELECT value FROM k WHERE before IS DISTINCT FROM value""")


def line_step_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = all_lines(spark, sf_dir).select(((F.col("doc_id") + 1) * 100_000 + F.col("line_no")).alias("line_no"), "value")
    return plans.run_line_step(raw, plans.line_rules([["common.Remove_Empty_Line", {}], ["rules_zh.Remove_Not_Contain_Chinese", {}]]), "")[1]


_rm = _chain_expr(["Remove_Empty_Line"], "common", "nullif(value, '')")
add("pipeline_removed_lines", line_step_removed, f"WITH {LINES_SQL}, o AS (SELECT (doc_id + 1) * 100000 + line_no AS line_no, coalesce(value, '') AS value, {_rm} AS c FROM lines) SELECT line_no, line_no || chr(9) || value AS value FROM o WHERE c IS NULL OR NOT regexp_matches(c, '{_ZH}')")


def vocab_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, sort, headers, top k, split, ids: the vocabulary shape."""
    spec = {"inputs": ["text"], "final_outputs": ["ids"], "steps": [
        {"name": "voc", "type": "file", "inputs": ["text"], "rules": [["common.Statistic_Word_Vocab", {}], ["common.Sort", {"reverse": 1, "num_sort": 1}], ["common.Insert_Line", {"line_num": 1, "content": "0\t_UNK"}], ["common.Cut_Lines", {"start": 1, "end": 500}], ["common.Split_To_Twin_Files", {}]], "outputs": ["freq", "voc"]},
        {"name": "ids", "type": "file", "inputs": ["text", "voc"], "rules": [["common.Words_To_Tokens", {}]], "outputs": ["ids"]}]}
    raw = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("line_no"), F.regexp_replace("text", "\n", " ").alias("value"))
    return plans.Engine(spark, spec).run({"text": raw})["ids"]


add("pipeline_vocab_ids", vocab_ids, f"""WITH x AS (SELECT item_id, {tokens_sql("replace(text, chr(10), ' ')")} AS ws FROM benchmark), w AS (SELECT unnest(ws) AS word FROM x), c AS (SELECT word, count(*) AS n FROM w GROUP BY word),
v AS (SELECT word, row_number() OVER (ORDER BY n DESC, n || chr(9) || word DESC) AS id FROM c QUALIFY id < 500), u AS (SELECT item_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM x)
SELECT item_id AS line_no, string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ' ' ORDER BY u.pos) AS value FROM u LEFT JOIN v ON u.word = v.word GROUP BY item_id""")  # fmt: skip
