"""Number and entity slots by fragment splitting, in built-in functions.

A line starts as one free fragment. Every pattern, in order, cuts the free fragments into text and matches; a match is
frozen as a tag, as a tag with its text in hexadecimal, or as it is. At the end the fragments are joined by a blank, so an
earlier pattern shadows later ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import patterns
from lexmill.functions.regex import java, let, strip
from lexmill.operators.lines import Line, rule

Freeze = Callable[[Column], Column]


def fragments(c: Column, steps: list[tuple[str, Freeze]], ignore_case: bool = True) -> Column:
    """Array of struct(text, free)."""
    piece = lambda t, free: F.struct(t.alias("text"), F.lit(free).alias("free"))
    out = F.array(piece(c, True))
    none = F.array().cast("array<struct<text:string,free:boolean>>")

    def cutter(p: str, freeze: Freeze) -> Callable[[Column], Column]:
        def cut(f: Column) -> Column:
            at = lambda t, m: F.when(m.isNotNull(), F.array(piece(t, True), piece(freeze(m), False))).when(t != "", F.array(piece(t, True))).otherwise(none)
            found = F.zip_with(F.split(f["text"], p, -1), F.regexp_extract_all(f["text"], F.lit(p), F.lit(0)), at)
            return F.when(f["free"], F.flatten(found)).otherwise(F.array(f))

        return cut

    for pattern, freeze in steps:
        out = F.flatten(F.transform(out, cutter(java(pattern, ignore_case), freeze)))
    return out


def tagged_by_marks(c: Column, pattern_list: list[str], text: str, small: bool = False, ignore_case: bool = True) -> Column:
    """As ``tagged`` with one fixed tag for all matches, in one pass of the line for each pattern: a match becomes a
    private-use mark, so no later pattern sees it, and a cut mark stands where a fragment ends. With ``small``, integers
    of one to three digits stay; a cut on both sides keeps later patterns from joining them to their neighbours."""
    cut, open_, close, end, done = "\ue010", "\ue011", "\ue012", "\ue013", "\ue014"
    sub = lambda x, p, by: F.regexp_replace(x, p, by)
    for i, pattern in enumerate(pattern_list):
        if i:  # fragments that are empty by now go
            c = sub(c, f"^{cut}+|(?<={cut}){cut}+", "")
        c = sub(c, java(pattern, ignore_case), f"{cut}{open_}$0{close}{end}")
        c = F.translate(sub(sub(c, end + cut, cut), end + r"\z", ""), end, cut)
        if small:
            c = sub(c, f"{open_}([0-9]{{1,3}}){close}", "$1")
        c = sub(c, f"{open_}[^{close}]*{close}", done)
    return F.replace(F.translate(c, cut, " "), F.lit(done), F.lit(text))


def tagged(c: Column, steps: list[tuple[str, Freeze]], ignore_case: bool = True) -> Column:
    return F.array_join(F.transform(fragments(c, steps, ignore_case), lambda f: f["text"]), " ")


def tag(text: str) -> Freeze:
    return lambda m: F.lit(text)


def small_or(freeze: Freeze) -> Freeze:
    """Integers of one to three digits stay as they are."""
    return lambda m: F.when(m.rlike("^[0-9]{1,3}$"), m).otherwise(freeze(m))


def as_is(m: Column) -> Column:
    return m


def slot(name: str) -> Freeze:
    """<name>HEX</name> with the match in upper-case hexadecimal of its UTF-8 bytes."""
    own = name.strip("<>")
    return lambda m: F.concat(F.lit(f"<{own}>"), F.hex(m.cast("binary")), F.lit(f"</{own}>"))


def _register(language: str, numbers: list[str], amounts: list[str], month: list[tuple[str, Freeze]]) -> None:
    both = numbers if language == "en" else amounts + numbers

    @rule(language, "Slot_Tag_Number")
    def basic(number_tag: str = "N") -> Line:
        """Every number becomes the tag. In Chinese a month's number is cut out first and dropped with its sign."""
        if not month:
            return lambda c: tagged_by_marks(c, numbers, number_tag)
        return lambda c: tagged(c, [*month, *((p, tag(number_tag)) for p in numbers)])

    @rule(language, "Slot_Tag_Number_v2")
    def not_small(number_tag: str = "N") -> Line:
        """As the basic form, but integers below 1000 stay."""
        return lambda c: tagged_by_marks(c, both, number_tag, small=True)

    @rule(language, "Slot_Tag_Number_v3")
    def not_small_slot(number_tag: str = "N") -> Line:
        """Numbers as hexadecimal slots, existing slots protected, integers below 1000 stay."""
        return lambda c: tagged(c, [(patterns.TAGGED, as_is), *((p, small_or(slot(number_tag))) for p in both)])

    @rule(language, "Slot_Tag_Number_v4")
    def with_unit(number_tag: str = "N") -> Line:
        """Only numbers with a magnitude word."""
        return lambda c: tagged_by_marks(c, amounts, number_tag)

    @rule(language, "Slot_Tag_Number_v5")
    def with_unit_slot(number_tag: str = "N") -> Line:
        """Only numbers with a magnitude word, as hexadecimal slots."""
        return lambda c: tagged(c, [(patterns.TAGGED, as_is), *((p, slot(number_tag)) for p in amounts)])


_register("en", patterns.ENGLISH_NUMBERS, patterns.ENGLISH_AMOUNTS, [])
_register("zh", patterns.CHINESE_NUMBERS, patterns.CHINESE_AMOUNTS, [(patterns.CHINESE_MONTH, as_is)])


@rule("en", "Slot_Tag_Notrans")
def slot_not_translated(notrans_tag: str = "NOTRANS") -> Line:
    """Web addresses and e-mail addresses as hexadecimal slots; case counts."""
    return lambda c: tagged(c, [(patterns.TAGGED, as_is), *((p, slot(notrans_tag)) for p in patterns.NOT_TRANSLATED)], False)


@rule("common", "Restore_Entity")
def restore_entity(entity_tag: str = "", case_sensitive: str | bool = "False") -> Line:
    """After tokenizing: escaped tags become tags again, and <T>HEX</T> becomes <T:base64>. A slot that holds no
    hexadecimal text drops the line."""
    names = [t for t in entity_tag.split("|") if t]
    exact = str(case_sensitive).lower() == "true"

    def run(c: Column) -> Column:
        c = strip(c)
        for name in names:
            form = name if exact else name.lower()
            for old, new in (("&gt; &apos; s ", "&gt; &apos;s "), (f"&lt; {form} &gt;", f"<{name}>"), (f"&lt; / {form} &gt;", f"</{name}>")):
                c = F.replace(c, F.lit(old), F.lit(new))
        if not names:
            return c

        def base64(m: Column) -> Column:
            own = F.regexp_extract(m, "^<([A-Za-z]+)>", 1)
            raw = F.try_to_binary(F.replace(F.regexp_extract(m, ">([^<]+)<", 1), F.lit(" "), F.lit("")), F.lit("hex"))
            return F.when(own.isin(names), F.concat(F.lit("<"), own, F.lit(":"), F.base64(raw), F.lit(">"))).otherwise(m)

        texts = F.transform(fragments(c, [(patterns.TAGGED, base64)], False), lambda f: f["text"])
        return let(texts, lambda t: F.when(~F.exists(t, lambda x: x.isNull()), F.array_join(t, "")))

    return run


@rule("common", "Restore_Entity_v2")
def restore_numbered(entity_tag: str = "") -> Line:
    """``tag _ 3`` (lower-cased by earlier steps) becomes ``Tag_3``."""
    from lexmill.operators.lines import substitutions

    return lambda c: substitutions([(rf"\b{t.lower()} _ (\d+)\b", rf"{t}_\1") for t in entity_tag.split("|") if t], False)(strip(c))
