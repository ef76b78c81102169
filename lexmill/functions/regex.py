"""Regular expressions written once, in Python's notation with ASCII classes, for Java (Spark) and RE2 (DuckDB)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_W = "[A-Za-z0-9_]"
#: ``\b`` between ASCII word characters only; Java's own takes letters of every script for words.
_BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"


def java(pattern: str, ignore_case: bool = True) -> str:
    """Only a line feed ends a line; ``\\Z`` is the very end; boundaries and classes are ASCII. A boundary before a digit
    looks at the digit first, which most places fail at once."""
    pattern = re.sub(r"\\b(?=\\d)", lambda m: rf"(?=\d)(?<!{_W})", pattern)
    body = re.sub(r"\\([bZ])", lambda m: _BOUNDARY if m[1] == "b" else r"\z", pattern)
    return ("(?di)" if ignore_case else "(?d)") + body


def java_replacement(text: str) -> str:
    return re.sub(r"\\(\d)", r"$\1", text.replace("$", r"\$"))


def replace(c: Column, pattern: str, by: str, ignore_case: bool = True) -> Column:
    return F.regexp_replace(c, java(pattern, ignore_case), java_replacement(by))


def contains(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    return c.rlike(java(pattern, ignore_case))


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duck_replace(expr: str, pattern: str, by: str, ignore_case: bool = True) -> str:
    return f"regexp_replace({expr}, {sql_text(pattern)}, {sql_text(by)}, 'g{'i' if ignore_case else ''}')"


def strip(c: Column) -> Column:
    from lexmill.functions.chars import STRIPPED_CHARACTERS

    return F.btrim(c, F.lit(STRIPPED_CHARACTERS))


def tokens(c: Column) -> Column:
    """Words between runs of white space, none of them empty (``str.split()``)."""
    from lexmill.functions.chars import STRIPPED_JAVA

    return F.filter(F.split(c, f"[{STRIPPED_JAVA}]+"), lambda w: w != "")


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``c`` with ``c`` evaluated once: inside a lambda an outer expression would be evaluated for every
    element. Don't name ``c`` in a lambda inside ``body``, hand it over as an argument (``zip_with``): Spark doesn't find
    vectorised functions above such a lambda, and fails when they run."""
    return F.get(F.transform(F.array(c), body), F.lit(0))
