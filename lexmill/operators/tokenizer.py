"""Sentence tokenizer and detokenizer.

The tokenizer is one expression of built-in functions. Private-use characters stand for protected spans and runs of dots,
so no text can be mistaken for a placeholder. The detokenizer keeps quote parity and looks at neighbours; it runs as a
vectorised function.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import patterns
from lexmill.functions.regex import java, let, strip, tokens
from lexmill.operators.abbreviations import NONBREAKING, NUMERIC_ONLY
from lexmill.operators.lines import Line, rule

ESCAPES = [("&", "&amp;"), ("|", "&#124;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&apos;"), ('"', "&quot;"), ("[", "&#91;"), ("]", "&#93;")]
UNESCAPES = [("&bar;", "|"), ("&#124;", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&bra;", "["), ("&ket;", "]"), ("&quot;", '"'), ("&apos;", "'"), ("&#91;", "["), ("&#93;", "]"), ("&amp;", "&")]

_ALNUM, _ALPHA, _NUM = r"\p{IsAlphabetic}\p{Nd}", r"\p{IsAlphabetic}", r"\p{N}"
_DOT, _HELD = "\ue002", "\ue003"
_APOSTROPHES = {
    "en": [(f"([^{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2"), (f"([^{_ALPHA}{_NUM}])'([{_ALPHA}])", "$1 ' $2"), (f"([{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2"), (f"([{_ALPHA}])'([{_ALPHA}])", "$1 '$2"), (f"([{_NUM}])'(s)", "$1 '$2")],
    "fr": [(f"([^{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2"), (f"([^{_ALPHA}])'([{_ALPHA}])", "$1 ' $2"), (f"([{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2"), (f"([{_ALPHA}])'([{_ALPHA}])", "$1' $2")],
}
_APOSTROPHES["it"] = _APOSTROPHES["fr"]


def prefixes(lang: str, extra: dict[str, list[str]] | None = None) -> list[str]:
    """The language's abbreviations; English where a language has none of its own (``extra`` adds lists)."""
    lists = NONBREAKING | (extra or {})
    return lists.get(lang, lists["en"])


def tokenize(c: Column, lang: str = "en", *, aggressive: bool = False, escape: bool = True, protected: str | None = None, abbreviations: dict[str, list[str]] | None = None) -> Column:
    """Tokens joined by blanks. ``protected`` is a pattern (Java) whose matches stay whole."""
    sub = lambda x, steps: reduce(lambda y, s: F.regexp_replace(y, s[0], s[1]), steps, x)
    x = F.concat(F.lit(" "), c, F.lit(" "))
    x = sub(x, [(r"\s+", " "), (r"[\x00-\x1f]", "")])
    held = F.regexp_extract_all(x, F.lit(protected), F.lit(0)) if protected else None
    if protected:
        x = F.regexp_replace(x, protected, f" {_HELD} ")
    x = F.trim(F.regexp_replace(x, " +", " "))
    x = F.regexp_replace(x, rf"([^{_ALNUM}\s.'`,\-{_HELD}])", " $1 ")
    if aggressive:
        x = F.regexp_replace(x, rf"([{_ALNUM}])-(?=[{_ALNUM}])", "$1 @-@ ")
    x = F.regexp_replace(x, r"\.(?=\.)|(?<=\.)\.", _DOT)
    x = sub(x, [(rf"({_DOT}++)(?=.)", " $1 "), (rf"(?<![ {_DOT}])({_DOT}+)$", " $1")])
    x = sub(x, [(f"([^{_NUM}]),", "$1 , "), (f",([^{_NUM}])", " , $1")])
    x = sub(x, _APOSTROPHES.get(lang, [("'", " ' ")]))
    x = _final_periods(x, lang, abbreviations)
    x = F.trim(F.regexp_replace(x, " +", " "))
    if held is not None:
        pieces = F.split(x, _HELD)
        x = F.array_join(F.zip_with(pieces, held, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), "")
    x = F.translate(x, _DOT, ".")
    return reduce(lambda y, s: F.replace(y, F.lit(s[0]), F.lit(s[1])), ESCAPES, x) if escape else x


def _final_periods(x: Column, lang: str, abbreviations: dict[str, list[str]] | None) -> Column:
    """A word's final period is split off unless the word holds another period and a letter, is an abbreviation, or the
    next word starts in lower case; numeric abbreviations keep it before a digit."""
    known = prefixes(lang, abbreviations)
    numeric = NUMERIC_ONLY.get(lang, NUMERIC_ONLY["en"] if lang not in NONBREAKING else [])

    def one(w: Column, following: Column) -> Column:
        stem = F.left(w, F.length(w) - 1)
        stays = (F.contains(stem, F.lit(".")) & stem.rlike(f"[{_ALPHA}]")) | stem.isin(known) | following.rlike(r"^\p{IsLowercase}") | (stem.isin(numeric) & following.rlike("^[0-9]"))
        return F.when(F.endswith(w, F.lit(".")) & (F.length(w) > 1) & ~stays, F.concat(stem, F.lit(" ."))).otherwise(w)

    # the next word comes as an argument: a vectorised function can't stand above a lambda that names an outer variable
    return let(F.split(x, r"\s"), lambda words: F.array_join(F.zip_with(words, F.concat(F.slice(words, F.lit(2), F.size(words)), F.array(F.lit(""))), one), " "))


@rule("common", "General_Sentence_Tokenizer")
def sentence_tokenizer(lang: str = "en", aggressive: bool = False, escape: bool = True) -> Line:
    """Web addresses stay whole."""
    return lambda c: strip(tokenize(strip(c), lang, aggressive=aggressive, escape=escape, protected=java(patterns.PROTECTED_URL)))


@rule("common", "General_Tokenizer")
def general_tokenizer(lang: str = "en", aggressive: bool = False, escape: bool = True) -> Line:
    return lambda c: tokenize(c, lang, aggressive=aggressive, escape=escape)


@rule("common", "General_Tokenizer_v2")
def general_tokenizer_urls(lang: str = "en", **_: str) -> Line:
    """Web addresses stay whole; white space is collapsed."""
    return lambda c: strip(F.regexp_replace(tokenize(c, lang, protected=java(patterns.PROTECTED_URL)), r"\s+", " "))


_PENN = [  # Fixed values: the treebank conventions
    (r"^\"", "`` "), (r"(?<=[ (\[{<])\"", "`` "), (r"\"", " '' "), (r"\.\.\.", " ... "), (r"([,;:@#$%&])", " $1 "), (r"([^.])(\.)([\])}>\"']*)\s*$", "$1 $2$3 "), (r"([?!])", " $1 "), (r"([\]\[(){}<>])", " $1 "),
    (r"--", " -- "), (r"([^'])' ", "$1 ' "), (r"'([sSmMdD]) ", " '$1 "), (r"'(ll|re|ve|LL|RE|VE) ", " '$1 "), (r"(n't|N'T) ", " $1 "), (r"(?i)\b(can)(not)\b", "$1 $2"), (r"(?i)\b(d)'(ye)\b", "$1' $2"), (r"(?i)\b(gim)(me)\b", "$1 $2"),
    (r"(?i)\b(gon)(na)\b", "$1 $2"), (r"(?i)\b(got)(ta)\b", "$1 $2"), (r"(?i)\b(lem)(me)\b", "$1 $2"), (r"(?i)\b(mor)('n)\b", "$1 $2"), (r"(?i)\b('t)(is)\b", "$1 $2"), (r"(?i)\b('t)(was)\b", "$1 $2"), (r"(?i)\b(wan)(na)\b", "$1 $2"),
]
_PENN_BRACKETS = [("(", "-LRB-"), (")", "-RRB-"), ("[", "-LSB-"), ("]", "-RSB-"), ("{", "-LCB-"), ("}", "-RCB-")]


def tokenize_penn(c: Column) -> Column:
    """Treebank tokens: directed quotes, split clitics, bracket names."""
    x = F.concat(F.regexp_replace(strip(c), r"\s+", " "), F.lit(" "))
    x = reduce(lambda y, s: F.regexp_replace(y, s[0], s[1]), _PENN, x)
    x = reduce(lambda y, s: F.replace(y, F.lit(s[0]), F.lit(s[1])), _PENN_BRACKETS, x)
    return strip(F.regexp_replace(x, " +", " "))


def detokenize_penn(c: Column) -> Column:
    """The inverse up to spacing: bracket names, quotes and clitics are joined again."""
    x = F.concat(F.lit(" "), c, F.lit(" "))
    x = reduce(lambda y, s: F.replace(y, F.lit(s[1]), F.lit(s[0])), _PENN_BRACKETS, x)
    for p, r in ((r" ('(?:[sSmMdD]|ll|re|ve|LL|RE|VE)) ", "$1 "), (r" (n't|N'T) ", "$1 "), ("`` ", '"'), (" ''", '"'), (r"([(\[{]) ", "$1"), (r" ([)\]},.;:?!%])", "$1")):
        x = F.regexp_replace(x, p, r)
    return strip(F.regexp_replace(x, " +", " "))


# --- detokenizer ------------------------------------------------------------------------------------------------------

_CJK = "[ᄀ-ᇿ⺀-꓏ꡀ-꡿가-힯豈-﫿︰-﹏･-ￜ\U00020000-\U0002ffff]"
_OPENS = regex.compile(r"^[\p{Sc}(\[{¿¡]+$")
_CLOSES = regex.compile(r"^[,.?!:;\\%}\])]+$")
_QUOTES = regex.compile("^['\"„“`]+$")
_FINNISH = regex.compile(
    "^(N|n|A|a|Ä|ä|ssa|Ssa|ssä|Ssä|sta|stä|Sta|Stä|hun|Hun|hyn|Hyn|han|Han|hän|Hän|hön|Hön|un|Un|yn|Yn|an|An|än|Än|ön|Ön|seen|Seen|lla|Lla|llä|Llä|lta|Lta|ltä|Ltä|lle|Lle|ksi|Ksi|kse|Kse|tta|Tta|ine|Ine)"
    "(ni|si|mme|nne|nsa)?(ko|kö|han|hän|pa|pä|kaan|kään|kin)?$"
)


def join_tokens(words: list[str], lang: str) -> str:
    """Decides for every token whether it leans on its left or right neighbour."""
    glue_left, glue_right = set(), set()
    parity: dict[str, int] = {}
    out, lower = list(words), set()
    cjk_start, cjk_end = re.compile("^" + _CJK), re.compile(_CJK + "$")
    alpha_first, alnum_last = regex.compile(r"^'\p{Alphabetic}"), regex.compile(r"[\p{Alphabetic}\p{Nd}]$")
    for i, w in enumerate(words):
        before, after = (words[i - 1] if i else ""), (words[i + 1] if i + 1 < len(words) else "")
        if cjk_start.search(w):
            if cjk_end.search(before):
                glue_left.add(i)
        elif _OPENS.match(w):
            glue_right.add(i)
        elif _CLOSES.match(w):
            if not (lang == "fr" and w in set("?!:;\\%")):
                glue_left.add(i)
        elif lang == "en" and i and alpha_first.match(w) and alnum_last.search(before):
            glue_left.add(i)
        elif lang == "cs" and i > 1 and words[i - 2].isdigit() and before in {".", ","} and w.isdigit():
            glue_left.add(i)
        elif lang in {"fr", "it"} and regex.search(r"\p{Alphabetic}'$", w) and regex.match(r"\p{Alphabetic}", after):
            glue_right.add(i)
        elif lang == "cs" and i + 3 < len(words) and regex.search(r"\p{Alphabetic}$", w) and after in {"-", "–"} and regex.match("(?i)li$|mail", words[i + 2]):
            glue_right.update((i, i + 1))
        elif _QUOTES.match(w):
            kind = '"' if set(w) <= set("„“”") else w
            if lang == "cs" and w in {"„", "“"}:
                parity[kind] = int(w == "“")
            if parity.get(kind, 0) % 2 == 0:
                if lang == "en" and w == "'" and before.endswith("s"):
                    glue_left.add(i)
                    continue
                glue_right.add(i)
            else:
                glue_left.add(i)
            parity[kind] = parity.get(kind, 0) + 1
        elif lang == "fi" and before.endswith(":") and _FINNISH.match(w):
            glue_left.add(i)
            lower.add(i)
    text = ""
    for i, w in enumerate(out):
        text += ("" if i == 0 or i in glue_left or (i - 1) in glue_right else " ") + (w.lower() if i in lower else w)
    return re.sub(" +", " ", text).strip(" ")


def detokenize_text(text: str, lang: str = "en") -> str:
    text = f" {text} ".replace(" @-@ ", "-")
    for old, new in UNESCAPES:
        text = text.replace(old, new)
    return join_tokens(text.split(), lang)


def detokenize(c: Column, lang: str = "en") -> Column:
    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda t: detokenize_text(t, lang) if t else None, na_action=None)

    return run(c)


@rule("common", "General_Sentence_Detokenizer")
def sentence_detokenizer(lang: str = "en") -> Line:
    return lambda c: detokenize(c, lang)


@rule("common", "General_Detokenizer")
def general_detokenizer(lang: str = "en") -> Line:
    return lambda c: detokenize(c, lang)


@rule("common", "General_Sentence_Detokenizer_Bracketfix")
def bracket_detokenizer(lang: str = "en") -> Line:
    """Blanks after opening brackets and round slashes go before joining."""
    steps = [(r"\( ", "("), (r"\{ ", "{"), ("&#91; ", "&#91;"), (r" *\\ *", r"\\\\"), (" */ *", "/")]
    return lambda c: detokenize(reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c), lang)


def detokenize_array(words: Column, lang: str = "en") -> Column:
    """Each item alone; ``<N:base64>`` items are decoded first. A falsy input is null."""
    coded = lambda w: F.coalesce(F.try_to_binary(F.substr(w, F.lit(4), F.length(w) - 4), F.lit("base64")).cast("string"), w)
    decoded = F.transform(words, lambda w: F.when(w.rlike("^<N:.*>$"), coded(w)).otherwise(w))

    @F.pandas_udf("array<string>")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda ws: None if ws is None else [detokenize_text(w or "", lang) for w in ws], na_action=None)

    return F.when(F.size(words) > 0, run(decoded))


# --- sentences --------------------------------------------------------------------------------------------------------


def english_sentences(c: Column) -> Column:
    """Array of sentences: a cut after . ? ! and closing marks before white space and a capital, digit or quote, unless
    the word before the period is an abbreviation or a single letter. A rule, not a trained model."""
    ends = F.regexp_replace(strip(c), r"(?<=[.?!][\"')\]”’]{0,3})\s+(?=[\p{Lu}\p{N}\"'(\[“‘])", "\ue004")
    pieces = F.split(ends, "\ue004")
    known = "|".join(re.escape(p) for p in [*NONBREAKING["en"], *NUMERIC_ONLY["en"]])
    open_end = rf"(?:^|[\s(\"'“])(?:{known})\.$"

    def step(done: Column, p: Column) -> Column:
        return F.when((F.size(done) > 0) & F.coalesce(F.try_element_at(done, F.lit(-1)).rlike(open_end), F.lit(False)), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat_ws(" ", F.try_element_at(done, F.lit(-1)), p)))).otherwise(F.concat(done, F.array(p)))

    return F.when(F.length(strip(c)) > 0, F.aggregate(pieces, F.array().cast("array<string>"), step))


def chinese_sentences(c: Column) -> Column:
    """Array of sentences: a cut after 。？！ and after a closing quote that follows one, but not inside “...”."""
    x = F.regexp_replace(strip(c), "(……”|。”|？”|！”)", "$1\ue004")
    pieces = F.split(x, "\ue004")

    def inner(p: Column) -> Column:
        free = F.split(p, "“[^”]+”", -1)
        quotes = F.regexp_extract_all(p, F.lit("“[^”]+”"), F.lit(0))
        cut = lambda t: F.regexp_replace(t, "([。？！])", "$1\ue004")
        return F.split(F.array_join(F.zip_with(free, quotes, lambda t, quoted: F.concat(cut(t), F.coalesce(quoted, F.lit("")))), ""), "\ue004")

    return F.filter(F.transform(F.flatten(F.transform(pieces, inner)), strip), lambda s: s != "")


@rule("en", "Segment_EN_lines_To_Sentences_v2")
def sentences_joined() -> Line:
    return lambda c: F.array_join(english_sentences(c), "\n\n")


__all__ = ["tokenize", "tokenize_penn", "detokenize", "detokenize_penn", "english_sentences", "chinese_sentences", "tokens"]
