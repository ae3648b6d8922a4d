"""Typed readings of answers, codes, options and statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import fold, squash

NUMBER = r"-?[0-9]+(?:[.,][0-9]+)?"
FRACTION = r"^\s*(-?[0-9]+(?:[.,][0-9]+)?)\s*/\s*(-?[0-9]+(?:[.,][0-9]+)?)\s*$"


def _double(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit(".")).try_cast("double")


def numeric_answer(x: Column) -> Column:
    """A decimal comma or point, a fraction, else the first number of a text of one line; null without one."""
    above, below = _double(F.regexp_extract(x, FRACTION, 1)), _double(F.regexp_extract(x, FRACTION, 2))
    first = _double(F.regexp_extract(x, NUMBER, 0))
    return F.when(x.rlike(FRACTION) & (below != 0), above / below).when(~x.contains("\n"), first)


def canonical_number(x: Column) -> Column:
    """A number as text: at most ten decimals, no trailing zeros."""
    value = F.round(numeric_answer(x), 10).cast("decimal(38,10)").cast("string")
    return F.regexp_replace(F.regexp_replace(value, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def answer_letter(x: Column) -> Column:
    """The letter A-D that an answer names, in upper case; null without one."""
    letter = F.upper(F.regexp_extract(fold(squash(x)), r"(?:^|[^a-z])([a-d])[^a-z]*$", 1))
    return F.when(~fold(squash(x)).isin("n/a", "null", "none") & (letter != ""), letter)


def boolean(x: Column) -> Column:
    """True for the usual spellings of yes, false for those of no, else null."""
    folded = fold(F.trim(x))
    return F.when(folded.isin("true", "yes", "1", "dung", "co"), True).when(folded.isin("false", "no", "0", "sai", "khong"), False)


def section_code(code: Column) -> Column:
    """part_i, part_ii or part_iii from a code, a roman or an arabic numeral; the numeral is anchored, so I is not read in III."""
    numeral = F.regexp_extract(fold(squash(code)), r"(?:^|[^a-z0-9])(iii|ii|i|3|2|1)$", 1)
    spaced = F.regexp_extract(F.regexp_replace(fold(squash(code)), "[_-]", " "), r"(?:^| )(iii|ii|i|3|2|1)$", 1)
    found = F.coalesce(F.nullif(spaced, F.lit("")), F.nullif(numeral, F.lit("")))
    return F.when(found.isin("i", "1"), "part_i").when(found.isin("ii", "2"), "part_ii").when(found.isin("iii", "3"), "part_iii")


def whitelisted(x: Column, allowed: tuple[str, ...], default: str | None = None) -> Column:
    return F.when(F.lower(F.trim(x)).isin(*allowed), F.lower(F.trim(x))).otherwise(F.lit(default))


def option_map(*options: Column) -> Column:
    """Options A, B, C... that are filled, as a map."""
    entries = F.array(*(F.struct(F.lit(chr(65 + k)).alias("key"), squash(x).alias("value")) for k, x in enumerate(options)))
    return F.map_from_entries(F.filter(entries, lambda e: F.coalesce(e["value"], F.lit("")) != ""))


def has_repeated_option(*options: Column) -> Column:
    filled = F.filter(F.array(*(fold(squash(x)) for x in options)), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.size(filled) != F.size(F.array_distinct(filled))


def statement_answers(statements: Column) -> Column:
    """Answers of true/false statements as D (true), S (false) and ? (unknown), in order."""
    return F.array_join(F.transform(statements, lambda s: F.when(s["answer"], "D").when(~s["answer"], "S").otherwise("?")), "")


def valid_box(box: Column) -> Column:
    """Whether a box has four numbers between 0 and 1 and positive width and height."""
    inside = F.forall(box, lambda x: x.isNotNull() & (x >= 0) & (x <= 1))
    return F.coalesce((F.size(box) == 4) & inside & (F.get(box, 2) > F.get(box, 0)) & (F.get(box, 3) > F.get(box, 1)), F.lit(False))


def mapped(x: Column, table: dict, default=None) -> Column:
    """What ``table`` has for the folded, squashed value, else ``default``."""
    key = fold(squash(x))
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def difficulty_rank(x: Column) -> Column:
    # The four levels of difficulty in order; any other ranks 99.
    levels = ("nhan biet", "thong hieu", "van dung", "van dung cao")
    rank = F.lit(99)
    for k, level in reversed(list(enumerate(levels, 1))):
        rank = F.when(fold(squash(x)) == level, k).otherwise(rank)
    return rank
