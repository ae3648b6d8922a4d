"""Rules as data: ordered lists of patterns, compiled to one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first rule (pattern, label) that matches."""
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def last_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the last rule that matches."""
    return first_match(text, rules[::-1], default)


def all_matches(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Labels of all rules that match, each once, in order."""
    return F.array_distinct(F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(label)) for p, label in rules))))


def all_keywords(text: Column, rules: list[tuple[tuple[str, ...], str]], default: str | None = None) -> Column:
    """Label of the first rule all of whose keywords the text contains."""
    out = F.lit(default)
    for words, label in reversed(rules):
        hit = F.lit(True)
        for word in words:
            hit = hit & text.contains(word)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out
