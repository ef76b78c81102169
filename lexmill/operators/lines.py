"""Line operators: ``Column -> Column``, null for a dropped line.

An operator is looked up by language and name and built with keyword parameters; a chain of operators is one expression,
so consecutive operators become one projection. A null or empty line stays null, an empty result is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import chars, patterns
from lexmill.functions.regex import contains, duck_replace, java, let, replace, strip, tokens

Line = Callable[[Column], Column]
REGISTRY: dict[tuple[str, str], Callable[..., Line]] = {}


def empty_to_null(c: Column) -> Column:
    """One reference to ``c``: an expression that names its input twice doubles with every operator of a chain."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def rule(language: str, name: str):
    """Registers a factory of line operators; what it builds drops empty results."""

    def add(factory: Callable[..., Line]) -> Callable[..., Line]:
        def build(**params) -> Line:
            own = factory(**params)

            def guarded(c: Column) -> Column:
                return empty_to_null(own(c))

            guarded.raw = own
            return guarded

        build.__doc__, build.factory = factory.__doc__, factory
        REGISTRY[language, name] = build
        return factory

    return add


def get(language: str, name: str, **params) -> Line:
    """The operator of that language, else the common one."""
    found = REGISTRY.get((language, name)) or REGISTRY.get(("common", name))
    if found is None:
        raise KeyError(f"no line operator {name!r} for {language!r}")
    return found(**params)


def chain(operators: Iterable[Line]) -> Line:
    """One expression. An empty line stays empty or null in every operator, so the chain looks for one at its end only."""
    own = [getattr(f, "raw", f) for f in operators]

    def guarded(c: Column) -> Column:
        return empty_to_null(reduce(lambda x, f: f(x), own, c))

    guarded.raw = lambda c: reduce(lambda x, f: f(x), own, c)
    return guarded


def substitutions(steps: list[tuple[str, str]], ignore_case: bool = True) -> Line:
    return lambda c: reduce(lambda x, s: replace(x, s[0], s[1], ignore_case), steps, c)


def keep(test: Callable[[Column], Column]) -> Line:
    return lambda c: F.get(F.filter(F.array(c), test), F.lit(0))


# --- substitution lists -------------------------------------------------------------------------------------------

SUBSTITUTIONS = {("common", k): v for k, v in patterns.COMMON.items()} | {("en", k): v for k, v in patterns.ENGLISH.items()} | {("zh", k): v for k, v in patterns.CHINESE.items()}
for (_language, _name), _steps in SUBSTITUTIONS.items():
    rule(_language, _name)(lambda steps=_steps, name=_name: substitutions(steps, name not in patterns.CASE_SENSITIVE))


def duck_substitutions(language: str, name: str, expr: str) -> str:
    """The same list as a DuckDB expression."""
    return reduce(lambda e, s: duck_replace(e, s[0], s[1], name not in patterns.CASE_SENSITIVE), SUBSTITUTIONS[language, name], expr)


# --- character maps ---------------------------------------------------------------------------------------------------


@rule("common", "FullWidth_To_Halfwidth")
def full_width_to_half() -> Line:
    """Full-width forms to ASCII; the ideographic space stays. The line is stripped first."""
    return lambda c: F.translate(strip(c), chars.FULL_WIDTH, chars.HALF_WIDTH)


@rule("common", "To_Lower")
def to_lower() -> Line:
    """Character by character: a dotted capital I is an i, a final sigma like any other."""
    return lambda c: F.lower(F.translate(c, "İΣ", "iσ"))


@rule("common", "Remove_Add_Line_Char")
def remove_line_separator() -> Line:
    return lambda c: F.translate(c, "\u2028", "")


@rule("en", "Capitalize")
def capitalize() -> Line:
    """Only the first character, which stays one: where its capital form is several characters, the single one is taken
    (a sharp s has one), else it stays."""
    upper = lambda x: F.when(F.contains(F.lit(chars.LONG_UPPER), x), F.translate(x, chars.LONG_UPPER, chars.SINGLE_UPPER)).otherwise(F.upper(x))
    return lambda c: let(c, lambda x: F.concat(upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2))))


@rule("zh", "Replace_English_Punctuation")
def english_punctuation_to_chinese() -> Line:
    return lambda c: F.replace(F.translate(strip(c), "!(),:;?~", "！（），：；？～"), F.lit("..."), F.lit("……"))


@rule("zh", "Convert_Traditional_To_Simplified")
def traditional_to_simplified(table: dict[str, str] | None = None) -> Line:
    """One character for one. The table is data: pass the pairs to use (``sources.character_pairs`` reads a file)."""
    pairs = table or {}
    return lambda c: F.translate(c, "".join(pairs), "".join(pairs.values())) if pairs else c


@rule("common", "BPE_Recover")
def bpe_recover() -> Line:
    return lambda c: F.replace(c, F.lit("@@ "), F.lit(""))


@rule("common", "BPE_Recover_v2")
def bpe_recover_v2() -> Line:
    return lambda c: F.regexp_replace(F.replace(c, F.lit(" "), F.lit("")), "(?d)_(.)", " $1")


@rule("common", "Replace_Content")
def replace_content(pattern: str, repl: str) -> Line:
    """A regular expression everywhere in the line (Java syntax; groups as \\1)."""
    return lambda c: replace(c, pattern, repl, False)


# --- predicates -------------------------------------------------------------------------------------------------------


@rule("en", "Remove_Contain_Chinese")
def remove_with_chinese() -> Line:
    return keep(lambda c: ~contains(c, f"[{chars.CHINESE}]"))


@rule("zh", "Remove_Not_Contain_Chinese")
def remove_without_chinese() -> Line:
    return keep(lambda c: contains(c, f"[{chars.CHINESE}]"))


@rule("en", "Remove_Not_Contain_Number_Or_Aphabet")
def remove_without_alphanumeric() -> Line:
    return keep(lambda c: contains(c, "[A-Za-z0-9]"))


@rule("en", "Remove_Line_With_No_Punct_Ending")
def remove_without_final_mark() -> Line:
    return keep(lambda c: contains(c, '[,.;:"?!]$'))


@rule("en", "Remove_Line_Less_Char")
def remove_few_letters() -> Line:
    """Drops a line when more than half of it is other than ASCII letters, blanks, commas and ! ?."""
    return keep(lambda c: 2 * F.length(F.regexp_replace(c, "[a-zA-Z ,!?]", "")) <= F.length(c))


@rule("zh", "Remove_Line_Less_Char")
def remove_few_chinese() -> Line:
    """Drops a line when more than 70 % of its characters are not Chinese."""
    return keep(lambda c: 10 * F.length(F.regexp_replace(c, f"[{chars.CHINESE}]", "")) <= 7 * F.length(c))


@rule("common", "Remove_Lines_With_Content")
def remove_with_content(content: str = "") -> Line:
    return keep(lambda c: ~contains(c, content)) if content else lambda c: c


@rule("common", "Filter_Sentence_With_Illegal_Chars")
def allowed_characters_only() -> Line:
    return keep(is_allowed)


def is_allowed(c: Column) -> Column:
    """Only white space and the allowed classes, and no U+2028, once the line is stripped."""
    # ASCII fails the first class at once; only what passes it is compared with all ranges
    bad = f"[^ \\t\\r\\n!-~](?:(?<=\u2028)|(?<![{chars.ALLOWED.replace('[', chr(92) + '[')}]))"
    return ~strip(c).rlike(bad)


@rule("common", "Pair_Punctuation_Close_Check")
def pairs_closed(newpairs: Iterable[str] = ()) -> Line:
    """A stack of opening marks as a string: a mark that completes the pair at its end pops, any other pushes."""
    pairs = [*chars.PAIRS, *newpairs]
    marks = "".join(pairs)

    def stack(c: Column) -> Column:
        only = F.regexp_replace(c, "[^" + "".join("\\" + m for m in marks) + "]", "")
        step = lambda s, x: F.when(F.concat(F.right(s, F.lit(1)), x).isin(pairs), F.left(s, F.length(s) - 1)).otherwise(F.concat(s, x))
        return F.aggregate(F.filter(F.split(only, ""), lambda x: x != ""), F.lit(""), step)

    return keep(lambda c: stack(c) == "")


# --- quotes, numbers, compounds ---------------------------------------------------------------------------------------


@rule("common", "Remove_Single_Quotation_v2")
def remove_quotes() -> Line:
    """One ' of a run stays after s, or after another ASCII letter or a tag when a letter follows; all others go, and
    so do ‘ ’ `."""
    steps = [(r"([sS])'+", "$1\ue000"), (r"([A-Za-z>])'+(?=[A-Za-z])", "$1\ue000"), ("'", ""), ("\ue000", "'"), ("[‘’`]", "")]
    return lambda c: reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, strip(c))


@rule("zh", "Remove_Bullet_v2")
def remove_chinese_bullets() -> Line:
    """A leading number with decimals is no bullet."""

    text = lambda s: F.when(contains(s, r"^\d+\.\d"), s).otherwise(replace(s, patterns.CHINESE_BULLETS, ""))
    return lambda c: replace(let(strip(c), text), patterns.CHINESE_SYMBOL_BULLETS, "", False)


@rule("zh", "Remove_Chinese_Number_Unit_After_Number_Entity")
def remove_unit_after_tag(number_tag: str = "N") -> Line:
    return substitutions([(rf"{number_tag}\s*{unit}", number_tag) for unit in ("万亿", "万", "亿")])


@rule("en", "Split_Compound_Word")
def split_compound(connector_tag: str = "-") -> Line:
    """a-b becomes a, tag, b; white space is normalised, both only in lines with a hyphen."""

    def parts(w: Column) -> Column:
        pieces = F.flatten(F.transform(F.split(w, "-"), lambda p, i: F.filter(F.array(F.when(i > 0, F.lit(connector_tag)), F.when(p != "", p)), lambda x: x.isNotNull())))
        return F.when((F.length(w) > 1) & F.contains(w, F.lit("-")), pieces).otherwise(F.array(w))

    return lambda c: let(c, lambda x: F.when(F.contains(x, F.lit("-")), F.array_join(F.flatten(F.transform(tokens(x), parts)), " ")).otherwise(x))


@rule("en", "Restore_Compound_Word")
def restore_compound(connector_tag: str = "-") -> Line:
    return lambda c: F.replace(c, F.lit(f" {connector_tag} "), F.lit("-"))


# --- Chinese characters -----------------------------------------------------------------------------------------------

_ZH = f"[{chars.CHINESE}{chars.CHINESE_PUNCTUATION}]"


@rule("zh", "Separate_Chinese_Char")
def separate_chinese() -> Line:
    """Blanks round every Chinese character and mark."""
    return lambda c: F.array_join(F.filter(F.split(F.regexp_replace(strip(c), f"({_ZH})", " $1 "), " "), lambda w: w != ""), " ")


@rule("zh", "Recover_Separated_Chinese_Char")
def recover_chinese() -> Line:
    """Joins single Chinese characters again: a blank stays only before what is not one, after what is not one."""

    def run(c: Column) -> Column:
        words = F.filter(F.split(strip(c), " "), lambda w: w != "")
        start = F.struct(F.lit("").alias("text"), F.lit(True).alias("zh"))

        def step(a: Column, w: Column) -> Column:
            one = (F.length(w) == 1) & w.rlike(f"^{_ZH}$")
            return F.struct(F.concat(a["text"], F.when(one | a["zh"], F.lit("")).otherwise(F.lit(" ")), w).alias("text"), one.alias("zh"))

        return F.aggregate(words, start, step, lambda a: a["text"])

    return run


# --- vocabulary -------------------------------------------------------------------------------------------------------


@rule("common", "BD_Break_Line")
def break_unknown(voc: Iterable[str], entity_safe: bool = False) -> Line:
    """Words outside the vocabulary as <B>c <M>c <E>c characters; with ``entity_safe`` words like <X:...> stay whole. A
    vocabulary too large for a literal goes through ``tables.break_unknown_words``, a join."""
    known = list(dict.fromkeys(voc))

    def run(c: Column) -> Column:
        held = F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")
        return F.array_join(F.transform(tokens(c), lambda w: F.when(F.array_contains(held, w) | (F.lit(entity_safe) & is_entity(w)), w).otherwise(broken(w))), " ")

    return run


def is_entity(w: Column) -> Column:
    return F.startswith(w, F.lit("<")) & F.endswith(w, F.lit(">")) & F.contains(w, F.lit(":"))


def broken(w: Column) -> Column:
    marks = F.slice(F.concat(F.array(F.lit("<B>")), F.array_repeat(F.lit("<M>"), F.greatest(F.length(w) - 2, F.lit(0))), F.array(F.lit("<E>"))), F.lit(1), F.length(w))
    return F.array_join(F.zip_with(marks, F.split(w, ""), lambda mark, x: F.concat(mark, x)), " ")


@rule("zh", "Replace_Words_Per_Dict")
def words_by_dictionary(words: Iterable[str]) -> Line:
    """Each word whose lower-cased form is listed takes the listed form (the word itself must be in lower case)."""
    table = {w.lower(): w for w in map(str.rstrip, words)}

    def run(c: Column) -> Column:
        known = F.create_map(*(F.lit(x) for kv in table.items() for x in kv)) if table else F.create_map().cast("map<string,string>")
        return F.array_join(F.transform(tokens(c), lambda w: F.coalesce(F.try_element_at(known, w), w)), " ")

    return run


def _replacer(table: dict[str, str], source: bool = False):
    """Replaces found words everywhere in the line, in the order in which they occur. Word-by-word ``replace`` is order
    dependent, so it runs as a vectorised function."""
    import re

    word = re.compile(patterns.CASED_WORD, re.ASCII)

    def one(line: str | None, own: str | None) -> str | None:
        if not line:
            return None
        for w in word.findall(line):
            at = own.lower().find(w) if own else -1
            new = own[at : at + len(w)] if at >= 0 else table.get(w, w)
            if new != w:
                line = line.replace(w, new)
        return line

    return one


@rule("zh", "Replace_Lower_Char_To_Upper_Word_Line")
def restore_case_in_pair(words: Iterable[str] = ()) -> Line:
    """The case of words of field 1 from field 2 where they occur, else from the list; lines of more fields stay."""
    one = _replacer({w.lower(): w for w in words})

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        def of(line: str | None) -> str | None:
            f = line.split("\t") if line else [None]
            return line if len(f) > 2 else one(f[0], f[1] if len(f) == 2 else None)

        return lines.map(of, na_action=None)

    return run


def restore_case_from(line: Column, source: Column, words: Iterable[str] = ()) -> Column:
    """The same with the source text in a column of its own (a parallel file joined on the line number)."""
    one = _replacer({w.lower(): w for w in words})

    @F.pandas_udf("string")
    def run(lines: pd.Series, sources: pd.Series) -> pd.Series:
        return pd.Series([one(a, b) for a, b in zip(lines, sources)], dtype=object)

    return run(line, source)


@rule("zh", "Find_Word_Entity")
def find_word_entity(table: dict[str, str]) -> Line:
    one = _replacer(table)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: one(x, None), na_action=None)

    return run


@rule("common", "Replace_HTML_Entities")
def html_entities() -> Line:
    """Named and numeric entities; no built-in function has the table of names."""
    import html

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: html.unescape(x).strip() if x else None, na_action=None)

    return run


# --- capitalised terms ------------------------------------------------------------------------------------------------


@rule("en", "Catch_Contain_Upper_Character_Word")
def capitalised_runs() -> Line:
    """Runs of neighbouring words with a capital (of the first word: after its first letter). Each run starts with a
    blank; every other word after the first ends the run with a line feed."""

    def run(c: Column) -> Column:
        found = F.transform(F.regexp_extract_all(c, F.lit(java(r"\b[A-Za-z0-9]+[A-Za-z0-9'.:_\-&]\b", False)), F.lit(0)), lambda w: F.regexp_extract(w, r"[a-zA-Z]\S*[a-zA-Z]", 0))
        words = F.filter(found, lambda w: w != "")
        marked = F.transform(words, lambda w, i: F.struct(w.alias("w"), F.when(i == 0, F.substr(w, F.lit(2))).otherwise(w).rlike("[A-Z]").alias("up"), i.alias("i")))
        return F.array_join(F.transform(marked, lambda m: F.when(m["up"], F.concat(F.lit(" "), m["w"])).when(m["i"] == 0, F.lit("")).otherwise(F.lit("\n"))), "")

    return run
