"""Column expressions over text: folding, white space, tokens, slugs, keys for natural order."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every kind of white space, in a spelling that Java and RE2 both read.
SPACE = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Words that carry no meaning in titles, folded.
STOP_WORDS = ("bai", "cac", "cho", "cua", "hai", "mot", "nhung", "the", "theo", "trong", "tren", "va", "voi", "and", "for", "with")
# Spellings of no value.
PSEUDO_NULL = ("", "null", "none", "n/a")


def _accents() -> tuple[str, str]:
    """Lower-case accented letters and the plain letters below them, from the character database."""
    accented, plain = [], []
    for code in [*range(0xDF, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "d" if letter == "đ" else unicodedata.normalize("NFD", letter)[0]
        if letter == letter.lower() and base != letter and base.isascii() and base.isalpha():
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _accents()


def fold(x: Column) -> Column:
    """Lower case without accents; null stays null.  One translate and one replacement, all in the JVM."""
    return F.translate(F.regexp_replace(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")), r"\p{M}+", ""), ACCENTED, PLAIN)


def squash(x: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(x, SPACE + "+", " "))


def optional(x: Column) -> Column:
    """Null for null, blank and pseudo-null values, else the trimmed value."""
    trimmed = squash(x)
    return F.when(~F.lower(trimmed).isin(*PSEUDO_NULL), trimmed)


def tokens(x: Column) -> Column:
    """Distinct folded words of three letters or more, without stop words and plain numbers, in order."""
    words = F.regexp_extract_all(fold(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    keep = F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*STOP_WORDS) & ~w.rlike("^[0-9]+$"))
    return F.array_sort(F.array_distinct(keep))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two arrays; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def slug(x: Column, limit: int = 50) -> Column:
    """Folded letters and digits joined by single hyphens, at most ``limit`` characters."""
    kept = F.regexp_replace(fold(x), "[^a-z0-9 -]", "")
    joined = F.regexp_replace(F.regexp_replace(F.trim(kept), "[ -]+", "-"), "^-+|-+$", "")
    return F.substring(joined, 1, limit)


def natural_key(x: Column) -> Column:
    """A string that sorts like the text with its digit runs read as numbers."""
    runs = F.regexp_extract_all(F.lower(x), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]+$"), F.lpad(r, 20, "0")).otherwise(r)), "")


def strip_tags(x: Column) -> Column:
    """Tags become spaces, then white space is squashed."""
    return squash(F.regexp_replace(x, "<[^>]+>", " "))


def without_fences(x: Column) -> Column:
    """Text without the code fences around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"^\s*```[a-zA-Z]*\s*", ""), r"\s*```\s*$", ""))


def without_lines(x: Column, pattern: str) -> Column:
    """The lines that are not blank and don't match ``pattern``."""
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda line: (F.trim(line) != "") & ~line.rlike(pattern)), "\n")


def truncated_at(x: Column, pattern: str) -> Column:
    """The text before the first line that matches ``pattern``."""
    lines = F.split(x, "\n", -1)
    hits = F.filter(F.transform(lines, lambda line, k: F.when(line.rlike(pattern), k)), lambda k: k.isNotNull())
    first = F.element_at(hits, 1)
    return F.array_join(F.when(F.size(hits) > 0, F.slice(lines, F.lit(1), first)).otherwise(lines), "\n")


def display_title(x: Column) -> Column:
    """A title without numbering, its first letter upper case."""
    bare = F.trim(F.regexp_replace(squash(x), r"^[0-9]+[.)\-]?\s*", ""))
    return F.concat(F.upper(F.substring(bare, 1, 1)), F.substring(bare, 2, 1_000_000))


def reason_set(x: Column, separator: str = ";") -> Column:
    """A delimited list as a sorted set, joined again."""
    parts = F.transform(F.split(F.coalesce(x, F.lit("")), separator, -1), lambda p: F.trim(p))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda p: p != ""))), f"{separator} ")


def escape_html(x: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(sign), F.lit(name))
    return x


def base_url(x: Column, version: str = "v1") -> Column:
    """An address without white space around it, slashes at its end and a version as its last part."""
    return F.regexp_replace(F.regexp_replace(F.trim(x), "/+$", ""), f"/{version}$", "")


def chunks(x: Column, size: int) -> Column:
    """Pieces of at most ``size`` characters, each ending at its last line break if it has one."""
    step = F.aggregate(
        F.split(x, "(?<=\n)", -1),
        F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open")),
        lambda state, line: F.when(
            F.length(state["open"]) + F.length(line) <= size, F.struct(state["done"].alias("done"), F.concat(state["open"], line).alias("open"))
        ).otherwise(F.struct(F.when(state["open"] != "", F.array_append(state["done"], state["open"])).otherwise(state["done"]).alias("done"), line.alias("open"))),
        lambda state: F.when(state["open"] != "", F.array_append(state["done"], state["open"])).otherwise(state["done"]),
    )
    # a line longer than the size is cut at the size
    return F.flatten(F.transform(step, lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length(p), F.lit(1)) - 1) / size)), lambda k: F.substr(p, k * size + 1, F.lit(size)))))
