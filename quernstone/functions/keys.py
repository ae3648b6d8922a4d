"""Fingerprints and stable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import fold, squash


def folded_signature(*parts: Column) -> Column:
    """SHA-1 of the folded, squashed parts: equal for texts that differ in case, accents or white space only."""
    return F.sha1(F.concat_ws("\n", *(squash(fold(F.coalesce(p, F.lit("")))) for p in parts)))


def lower_signature(*parts: Column) -> Column:
    """SHA-1 of the lower-case, squashed parts; accents count."""
    return F.sha1(F.concat_ws("\n", *(squash(F.lower(F.coalesce(p, F.lit("")))) for p in parts)))


def stable_id(prefix: str, file_key: Column, ordinal: Column, text: Column) -> Column:
    """prefix-<12 of the file's hash>-<ordinal, three digits>-<12 of the text's hash>."""
    return F.concat_ws("-", F.lit(prefix), F.substring(F.sha1(file_key), 1, 12), F.lpad(ordinal.cast("string"), 3, "0"), F.substring(F.sha1(text), 1, 12))


def passage_id(text: Column, least: int = 120, hashed: int = 1000) -> Column:
    """Id of a passage by its first characters; null for a text too short to be one."""
    return F.when(F.length(text) >= least, F.concat(F.lit("passage-"), F.substring(F.sha1(F.substring(text, 1, hashed)), 1, 16)))


def prefix_key(text: Column, size: int = 60, least: int = 15) -> Column:
    """First characters of the squashed lower-case text; null below ``least``."""
    key = squash(F.lower(text))
    return F.when(F.length(key) >= least, F.substring(key, 1, size))


def content_key(file: Column, number: Column, options: Column, text: Column) -> Column:
    """File, number and option signature where there are options, else the start of the text."""
    signature = F.substring(squash(F.lower(options)), 1, 600)
    return F.concat_ws("|", file, F.coalesce(number.cast("string"), F.lit("")), F.when(F.coalesce(signature, F.lit("")) != "", signature).otherwise(F.substring(squash(F.lower(text)), 1, 240)))
