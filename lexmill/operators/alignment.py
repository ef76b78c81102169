"""Alignment of translations: pair slots, joined pieces, restored case."""

from __future__ import annotations

import re
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import patterns
from lexmill.functions.regex import let
from lexmill.operators.lines import Line, keep, rule

_ENGLISH = [re.compile(p, re.I | re.A) for p in patterns.ENGLISH_AMOUNTS]
_CHINESE = [re.compile(p, re.I | re.A) for p in patterns.CHINESE_AMOUNTS]
#: Powers of ten of magnitude words: English by first letter.
_POWERS = {"m": 6, "b": 9, "t": 12, "万": 4, "亿": 8, "万亿": 12}


def amount(text: str) -> Decimal:
    """The value of a number with a magnitude word."""
    number, unit = re.fullmatch(r"([0-9,. ]*[0-9])\s*(\D+)", text, re.S).groups()
    return Decimal(re.sub("[, ]", "", number)).scaleb(_POWERS.get(unit) or _POWERS[unit[0].lower()]).normalize()


def _matches(text: str, shapes: list[re.Pattern]) -> list[tuple[int, int]]:
    """Spans of the shapes in order: a later shape only looks between the spans already taken."""
    taken: list[tuple[int, int]] = []
    for shape in shapes:
        free, at = [], 0
        for s, e in [*sorted(taken), (len(text), len(text))]:
            free.append((at, s))
            at = e
        taken += [(a + m.start(), a + m.end()) for a, b in free for m in shape.finditer(text[a:b])]
    return sorted(taken)


def slot_numbers(line: str, tag: str) -> str:
    """Equal amounts of both sides become the tag; each target amount is used once, first come first served."""
    sides = line.strip().split("\t")
    if len(sides) != 2:
        return line.strip()
    src, tgt = (s.strip() for s in sides)
    left, right = _matches(src, _ENGLISH), _matches(tgt, _CHINESE)
    free = {span: amount(tgt[slice(*span)]) for span in right}
    used_left, used_right = [], []
    for span in left:
        value = amount(src[slice(*span)])
        if hit := next((s for s, v in free.items() if v == value), None):
            del free[hit]
            used_left.append(span)
            used_right.append(hit)
    for text, spans in ((src, used_left), (tgt, used_right)):
        for s, e in sorted(spans, reverse=True):
            text = text[:s] + tag + text[e:]
        src, tgt = (text, tgt) if spans is used_left else (src, text)
    return f"{src}\t{tgt}"


_FIXED = [re.compile(p) for p in patterns.NOT_TRANSLATED]


def slot_not_translated(line: str, tag: str) -> str:
    """Addresses in stretches that both sides share become the tag: from each start in the target the longest stretch
    that the source holds is taken."""
    sides = line.strip().split("\t")
    if len(sides) != 2:
        return line.strip()
    src, tgt = (s.strip() for s in sides)
    i = 0
    while i < len(tgt):
        if tgt[i] == " ":
            i += 1
            continue
        end = next((j for j in range(len(tgt), i, -1) if tgt[j - 1] != " " and tgt[i:j] in src), None)
        if end is None:
            i += 1
            continue
        shared, at = tgt[i:end], src.find(tgt[i:end])
        m = next((m for p in _FIXED if (m := p.search(shared))), None)
        if m:
            src = src[: at + m.start()] + tag + src[at + m.end() :]
            tgt = tgt[: i + m.start()] + tag + tgt[i + m.end() :]
            end += len(tag) - (m.end() - m.start())
        i = end
    return f"{src}\t{tgt}"


def _vectorised(one, *args) -> Line:
    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda t: one(t, *args) if t else None, na_action=None)

    return run


@rule("common", "Pair_Slot_Tag_Number")
def pair_numbers(number_tag: str = "<N>") -> Line:
    return _vectorised(slot_numbers, number_tag)


@rule("common", "Pair_Slot_Tag_NoTrans")
def pair_not_translated(notrans_tag: str = "<NOTRANS>") -> Line:
    return _vectorised(slot_not_translated, notrans_tag)


@rule("common", "Remove_No_Entity_Line")
def remove_without_entity(entity_tag: str = "") -> Line:
    """A pair stays if both sides hold one of the tags; other shapes stay."""
    tags = [f"<{t}>" for t in entity_tag.split("|") if t]

    def test(c: Column) -> Column:
        f = F.split(c, "\t", -1)
        has = lambda x: F.exists(F.array(*map(F.lit, tags)), lambda t: F.contains(x, t))
        return (F.size(f) != 2) | (has(F.get(f, 0)) & has(F.get(f, 1))) if tags else F.lit(True)

    return keep(test)


@rule("common", "Fix_Labels")
def fix_labels() -> Line:
    """For pairs en, zh: rows with a doubled figure mark go; a dangling (Fig. is cut with its counterpart."""

    def run(f: Column) -> Column:
        en, zh = F.get(f, 0), F.get(f, 1)
        cut = F.endswith(en, F.lit("(Fig."))
        zh2 = F.when(zh.rlike(r"（图[0-9]）。\z"), F.regexp_replace(zh, r"（图[0-9]）。\z", "")).otherwise(F.regexp_replace(zh, r"（图。\z", ""))
        out = F.concat_ws("\t", F.when(cut, F.left(en, F.length(en) - 5)).otherwise(en), F.when(cut, zh2).otherwise(zh))
        return F.when((F.size(f) == 2) & ~F.contains(zh, F.lit("（图（图")) & ~F.contains(zh, F.lit("[图[图")), out)

    return lambda c: let(F.split(c, "\t", -1), run)


@rule("common", "Levenshtein_Distance")
def levenshtein(mode: str = "char") -> Line:
    from lexmill.operators.scoring import edit_distance

    return _of_pair(lambda a, b: edit_distance(a, b, mode).cast("string"))


@rule("common", "Fuzzy_Match_Score")
def fuzzy(mode: str = "char") -> Line:
    from lexmill.operators.scoring import fuzzy_match

    return _of_pair(lambda a, b: fuzzy_match(a, b, mode).cast("string"))


def _of_pair(of) -> Line:
    """Rows of other than two fields become null."""

    def run(c: Column) -> Column:
        return let(F.split(c, "\t", -1), lambda f: F.when(F.size(f) == 2, of(F.get(f, 0), F.get(f, 1))))

    return run


# --- joining pieces ---------------------------------------------------------------------------------------------------


def join_source(pieces: list[str]) -> tuple[list[str], list[int]]:
    """Words of subword pieces, and the word of each piece. ``x@@`` leans on the next piece, ``'s`` and ``<->`` on the
    word before, and what follows ``<->`` on it as well. A leaning piece with nothing before it starts a word."""
    words: list[str] = []
    at: list[int] = []
    lean = False  # the next piece belongs to the word in hand
    for p in pieces:
        text, onward = p, False
        if p.endswith("@@"):
            text, onward = p[:-2], True
        elif p == "<->":
            text, onward = "-", True
        if words and (lean or p == "<->" or (p.startswith("'") and len(pieces) > 1)):
            words[-1] += text
        else:
            words.append(text)
        at.append(len(words) - 1)
        lean = onward
    if pieces and pieces[-1].endswith("@@"):  # an unfinished word is no word
        words[-1] = words[-1][: len(words[-1]) - len(_tail(pieces))]
        if not words[-1]:
            words.pop()
    return words, at


def _tail(pieces: list[str]) -> str:
    out = ""
    for p in reversed(pieces):
        if not p.endswith("@@"):
            break
        out = p[:-2] + out
    return out


def align(tgt: list[str], src: list[str], mapping: list[int], append_space: bool) -> tuple[list[str], list[str], list[int]] | None:
    """Target words grouped by the source word they point to: (targets, source words, source index of each target)."""
    if not tgt or not src or not mapping:
        return None
    words, at = join_source(src)
    where = {i: w for i, w in enumerate(at)} | {len(src): len(words)}
    out: list[str] = []
    index: list[int] = []
    current, tight = None, False
    for p, m in zip(tgt, mapping):
        text = p[:-2] if p.endswith("@@") else "-" if p == "<->" else p
        to = where.get(m, m)
        if out and to == current:
            out[-1] += text if not append_space or tight or p.startswith("'") or p == "<->" else " " + text
        else:
            out.append(text)
            index.append(to)
            current = to
        tight = p.endswith("@@") or p == "<->"
    return out, words, index


ALIGNED = "target array<string>, source array<string>, mapping array<int>"


def align_columns(enabled: Column, tgt: Column, src: Column, mapping: Column, append_space: bool = False) -> Column:
    """struct(target, source, mapping); null when not enabled or an input is empty."""

    @F.pandas_udf(ALIGNED)
    def run(on: pd.Series, t: pd.Series, s: pd.Series, m: pd.Series) -> pd.DataFrame:
        rows = [align(list(b), list(c), [int(x) for x in d], append_space) if a and b is not None and c is not None and d is not None else None for a, b, c, d in zip(on, t, s, m)]
        return pd.DataFrame([r or (None, None, None) for r in rows], columns=["target", "source", "mapping"])

    out = run(enabled, tgt, src, mapping)
    return F.when(out["target"].isNotNull(), out)


# --- case -------------------------------------------------------------------------------------------------------------

_WORDS = re.compile(r"\b[A-Za-z0-9]+\b", re.A)


def restore_case(line: str, raw: str, plural: bool) -> str:
    """Each ASCII word takes the casing of its first occurrence in the raw text that no ASCII letter touches; with
    ``plural`` a final s may follow. A word that isn't found stays."""
    low = raw.lower()

    def of(m: re.Match) -> str:
        w = m[0]
        after = "(?=s?(?![a-z]))" if plural else "(?![a-z])"
        hit = re.search("(?<![a-z])" + re.escape(w) + after, low)
        return raw[hit.start() : hit.end()] if hit and len(low) == len(raw) else w

    return _WORDS.sub(of, line)


def correct_case(line: Column, raw: Column, plural: bool = True) -> Column:
    @F.pandas_udf("string")
    def run(lines: pd.Series, raws: pd.Series) -> pd.Series:
        return pd.Series([restore_case(a, b or "", plural) if a else None for a, b in zip(lines, raws)], dtype=object)

    return run(line, raw)


def correct_case_array(enabled: Column, words: Column, raw: Column, plural: bool = True) -> Column:
    """The same over an array of words, as one sentence split again at blanks; null when not enabled."""
    return F.when(enabled & (F.size(words) > 0), F.split(correct_case(F.array_join(words, " "), raw, plural), " ", -1))
