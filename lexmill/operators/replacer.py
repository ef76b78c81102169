"""Dictionary replacement: the longest listed phrase at each token start."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.lines import Line, rule


class Replacer:
    """A phrase matches when all of its blank-separated words follow at the start of a token, whole."""

    def __init__(self, phrases: Mapping[str, str]):
        self.root: dict = {}
        for key, value in phrases.items():
            node = self.root
            for w in key.split(" "):
                node = node.setdefault(w, {})
            node[None] = value

    def run(self, text: str) -> str:
        words, out, i = text.split(" "), [], 0
        while i < len(words):
            node, end, new = self.root, i, None
            for j in range(i, len(words) if words[i] else i):
                if (node := node.get(words[j])) is None:
                    break
                if None in node:
                    end, new = j + 1, node[None]
            if new is None:
                out.append(words[i])
                i += 1
            else:
                out.append(new)
                i = end
        return " ".join(out)


def phrases_of(rules: Iterable[tuple[str, str, str, str, str]], before: bool) -> dict[str, str]:
    """From rows (id, pre_from, pre_to, post_from, post_to). An entity tag is written with its rule's id: ``<T>`` of rule
    7 becomes ``<T:7>``, as the value before translation and as the key after it."""
    out = {}
    for rule_id, pre_from, pre_to, post_from, post_to in rules:
        key, value = (pre_from, pre_to) if before else (post_from, post_to)
        if key and value:
            tagged = lambda t, own=rule_id: f"{t[:-1]}:{own}>" if t.startswith("<") and t.endswith(">") and ":" not in t else t
            out[key if before else tagged(key)] = tagged(value) if before else value
    return out


def _operator(phrases: Mapping[str, str]) -> Line:
    trie = Replacer(phrases)

    @F.pandas_udf("string")
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda t: trie.run(t) if t else None, na_action=None)

    return run


@rule("common", "Pre_Replacing_Rule")
def before_translation(rules: Iterable[tuple] = ()) -> Line:
    phrases = phrases_of(rules, True)
    return _operator(phrases) if phrases else lambda c: c


@rule("common", "Post_Replacing_Rule")
def after_translation(rules: Iterable[tuple] = ()) -> Line:
    phrases = phrases_of(rules, False)
    return _operator(phrases) if phrases else lambda c: c


def rules_of(table: DataFrame, most: int = 1_000_000) -> list[tuple]:
    """The rule table as rows for the operators; larger tables than ``most`` rows are refused, not cut."""
    rows = table.select("rule_id", "pre_from", "pre_to", "post_from", "post_to").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} replacement rules")
    return [tuple(x or "" for x in r) for r in rows]
